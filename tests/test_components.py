"""Components: vectors are made once for a fit, and rounding per profile changes no value."""

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.learn import decompose
from wayfold.plans import features

SMALL = "/root/testdata/sf0.001"


def test_vectors_of_a_fit_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(i):
        made.add(1)
        return [float(i % 3), float(i % 5), float(i % 7)]
    df = spark.range(200).select(array_to_vector(F.udf(seen, "array<double>").asNondeterministic()("id")).alias("v"))
    model, signs = decompose.fit_svd(df, "v", 3, 2)
    assert made.value == 200
    x = np.array([[i % 3, i % 5, i % 7] for i in range(200)], float)
    axes = np.linalg.svd(x, full_matrices=False)[2][:2]
    assert np.allclose(np.abs(model.pc.toArray().T), np.abs(axes), atol=1e-9) and len(signs) == 2


def test_rounded_components_are_the_components_rounded(spark):
    raw = (B.queries_table(spark, SMALL), B.plans_table(spark, SMALL), B.clicks_table(spark, SMALL), B.profiles_table(spark, SMALL))
    whole, short = (features.features_col(*raw, components=True, digits=n) for n in (None, 6))
    parts = [c for c in whole.columns if c.startswith(("PID_MainComp", "TFIDF_clustered"))]
    assert len(parts) == 30 and whole.columns == short.columns
    own = {r.sid: r for r in whole.select("sid", *[F.round(c, 6).alias(c) for c in parts]).collect()}
    seen = short.select("sid", *parts).collect()
    assert len(seen) == len(own)
    for r in seen:
        assert all(a == b or abs(a - b) < 2e-6 for a, b in zip(r, own[r.sid]) if a is not None or b is not None)
