"""Labels, flags and fills."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vocabulary(df: DataFrame, column: str, most: int = 1000) -> list:
    """Sorted distinct values; refuses a column with more than ``most`` of them."""
    values = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values; take one_hot_vector")
    return sorted(values)


def one_hot_vector(df: DataFrame, column: str, name: str) -> DataFrame:
    """A sparse vector with a place per value, in the order of the values, and a last one for null: for columns of many values."""
    index = StringIndexer(inputCol=column, outputCol="_index", stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)
    encoder = OneHotEncoder(inputCol="_index", outputCol=name, dropLast=False)
    marked = index.transform(df)
    return encoder.fit(marked).transform(marked).drop("_index")


def one_hot(df: DataFrame, column: str, values: Iterable | None = None, prefix: str | None = None) -> DataFrame:
    """A 0/1 column per value, named ``<prefix>_<value>``.  Give ``values`` to avoid the extra job."""
    values = vocabulary(df, column) if values is None else list(values)
    prefix = column if prefix is None else prefix
    return df.withColumns({
        f"{prefix}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in values
    })


def label_response(df: DataFrame) -> DataFrame:
    """A session without a click is class 0; ``Response`` repeats the label."""
    label = F.coalesce(F.col("click_mode"), F.lit(0))
    return df.withColumns({"click_mode": label, "Response": label})


def label_shift(df: DataFrame) -> DataFrame:
    """Only clicked sessions, classes counted from 0."""
    return df.filter(F.col("click_mode") > 0).withColumn("click_mode", F.col("click_mode") - 1)


def rank_target(clicked: Column, mode: Column, gain: int = 3) -> Column:
    return F.when(clicked == mode, F.lit(gain)).otherwise(F.lit(0))


def overwrite_where(df: DataFrame, condition: Column, columns: Iterable[str], value: int = -1) -> DataFrame:
    return df.withColumns({c: F.when(condition, F.lit(value)).otherwise(F.col(c)) for c in columns})


def number(text: Column, to: str = "double") -> Column:
    """Text to number; unreadable text (also the empty one) becomes null."""
    return F.trim(text).try_cast(to)


def district_code(label: Column) -> Column:
    """Index in ``o_district_7`` (or ``o_district7``); null where there is none."""
    return F.regexp_extract(label, r"district_?(\d+)$", 1).try_cast("int")


def rename_prefixed(df: DataFrame, columns: Iterable[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    names = df.columns
    return names[names.index(first): names.index(last) + 1]


def select_features(df: DataFrame, keep: Iterable[str] | None = None, drop: Iterable[str] = (),
                    drop_range: tuple[str, str] | None = None) -> DataFrame:
    gone = set(drop)
    if drop_range:
        gone.update(column_range(df, *drop_range))
    wanted = df.columns if keep is None else list(keep)
    return df.select(*[c for c in wanted if c not in gone])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
