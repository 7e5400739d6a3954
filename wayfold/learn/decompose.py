"""Truncated SVD, scaling and assembling of feature vectors.

``PCA`` centres its input, the truncated SVD does not.  Stacked with its mirror image (-x) a table
has mean zero and the same right singular vectors, so ``PCA`` of the two together is the SVD of
the one, all inside Spark ML.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, ElementwiseProduct, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_svd(df: DataFrame, vector: str, width: int, k: int):
    """PCA model of the table and its mirror image, and the sign that makes each axis's largest entry positive.

    The fit takes several passes over both; the vectors are made once.
    """
    x = df.select(F.col(vector).alias("x")).persist()
    try:
        mirror = ElementwiseProduct(scalingVec=Vectors.dense([-1.0] * width), inputCol="x", outputCol="m")
        both = x.unionAll(mirror.transform(x).select(F.col("m").alias("x")))
        model = PCA(k=min(k, width), inputCol="x", outputCol="c").fit(both)
    finally:
        x.unpersist()
    signs = []
    for axis in model.pc.toArray().T:
        largest = max(range(width), key=lambda i: (round(abs(axis[i]), 9), -i))
        signs.append(1.0 if axis[largest] >= 0 else -1.0)
    return model, signs


def add_components(df: DataFrame, vector: str, width: int, k: int, prefix: str, fitted_on: DataFrame | None = None) -> DataFrame:
    """``<prefix>_<i>``: the row's coordinates along the first ``k`` right singular vectors.

    The vectors come from ``fitted_on``, by default the table itself.  ``PCAModel`` multiplies
    without centring, which is what the projection needs.
    """
    model, signs = fit_svd(df if fitted_on is None else fitted_on, vector, width, k)
    placed = model.setInputCol(vector).setOutputCol("_c").transform(df).withColumn("_c", vector_to_array("_c"))
    return placed.withColumns({f"{prefix}_{i}": F.col("_c")[i] * F.lit(s) for i, s in enumerate(signs)}).drop("_c")


def profile_components(profiles: DataFrame, columns: Sequence[str], k: int = 20) -> DataFrame:
    """The profile table with components ``PID_MainComp_<i>`` beside it; give it with its sentinel row."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(profiles)
    return add_components(vectors, "_v", len(columns), k, "PID_MainComp").drop("_v")


def standardize(df: DataFrame, columns: Sequence[str], using: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation; ``using`` gives the rows that set the scale.

    A constant column only loses its mean.
    """
    source = df if using is None else using
    stats = source.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return df.withColumns({
        c: (F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0) for c in columns})


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="keep").transform(df)


def spread(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """The columns that :func:`assemble` put into one vector, as doubles again; missing values are NaN there."""
    held = df.withColumn("_x", vector_to_array(name))
    return held.withColumns({c: F.col("_x")[i] for i, c in enumerate(columns)}).drop("_x")

