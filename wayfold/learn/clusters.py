"""Clusters of user profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.learn.cross_validation import dealt
from wayfold.learn.decompose import assemble, standardize
from wayfold.session import cut_lineage


def _vectors(profiles: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """``(pid, features)``, stored: the fit and the placing read them, and their attributes may be costly."""
    vectors = assemble(standardize(profiles.select(key, *columns), columns), columns).select(key, "features")
    return cut_lineage(dealt(vectors, key))


def kmeans(profiles: DataFrame, columns: Sequence[str], k: int, key: str = "pid", seed: int = 1, rounds: int = 20) -> DataFrame:
    """``(pid, cluster)`` by k-means on standardized attributes; the id is not an attribute."""
    vectors = _vectors(profiles, columns, key)
    model = KMeans(k=k, seed=seed, maxIter=rounds, predictionCol="cluster").fit(vectors)
    return model.transform(vectors).select(key, "cluster")


def hierarchy(profiles: DataFrame, columns: Sequence[str], k: int, key: str = "pid", seed: int = 1, rounds: int = 10) -> DataFrame:
    """``(pid, cluster)`` by repeated bisection down to ``k`` clusters, on the attributes as they are.

    ``BisectingKMeans`` parts a centre by noise in proportion to its length, so a centre at zero is
    never split; a constant extra attribute keeps every centre away from zero and changes no distance.
    """
    raw = profiles.select(key, *columns, F.lit(1.0).alias("_one"))
    vectors = cut_lineage(dealt(assemble(raw, [*columns, "_one"]).select(key, "features"), key))
    model = BisectingKMeans(k=k, seed=seed, maxIter=rounds, predictionCol="cluster").fit(vectors)
    return model.transform(vectors).select(key, "cluster")


def sweep(profiles: DataFrame, columns: Sequence[str], ks: Sequence[int], key: str = "pid", seed: int = 1, rounds: int = 10) -> DataFrame:
    """Mean silhouette (squared Euclidean) and cost for every number of clusters."""
    vectors = _vectors(profiles, columns, key)
    rows = []
    for k in ks:
        model = KMeans(k=k, seed=seed, maxIter=rounds, predictionCol="cluster").fit(vectors)
        placed = model.transform(vectors)
        found = ClusteringEvaluator(predictionCol="cluster").evaluate(placed)
        rows.append((k, float(found), float(model.summary.trainingCost)))
    return profiles.sparkSession.createDataFrame(rows, "k int, silhouette double, cost double")


MOST_VALUES = 100_000


def kmodes(profiles: DataFrame, columns: Sequence[str], k: int, key: str = "pid", rounds: int = 20) -> DataFrame:
    """``(pid, cluster)`` by k-modes: the centre is the commonest value per attribute, the distance the mismatches.

    The profiles are stored once, as the numbers of their values.  The modes are k rows on the driver; new ones come from
    counts per (cluster, value).
    """
    data, values = _numbered_values(profiles.select(key, *columns), columns, key)
    modes = _first_modes(data, values, k)
    for _ in range(rounds):
        # placed before the rows unfold, else once per value
        placed = data.withColumn("cluster", _closest_mode(modes))
        counted = placed.select("cluster", F.explode("row").alias("v")).groupBy("cluster", "v").agg(F.count(F.lit(1)).alias("n"))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for r in _few(counted):
            at, found = (r["cluster"], values[r["v"]]["i"]), (-r["n"], r["v"])
            best[at] = min(found, best.get(at, found))
        new = [tuple(best.get((c, i), (0, v))[1] for i, v in enumerate(m)) for c, m in enumerate(modes)]
        if new == modes:
            break
        modes = new
    return data.select(key, _closest_mode(modes).alias("cluster"))


def _few(df: DataFrame) -> list:
    rows = df.limit(MOST_VALUES + 1).collect()
    if len(rows) > MOST_VALUES:
        raise ValueError("too many clusters, attributes or values for modes on the driver")
    return rows


def _value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per ``by`` group, attribute number ``i`` and value ``v``."""
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(columns)])
    return df.select(*by, F.inline_outer(cells)).groupBy(*by, "i", "v").agg(F.count(F.lit(1)).alias("n"))


def _numbered_values(data: DataFrame, columns: Sequence[str], key: str) -> tuple[DataFrame, list]:
    """``(key, row)`` with the number of each attribute's value, stored, and the ``(i, v, n)`` that the numbers stand for.

    No two attributes share a number, and numbers follow the order of the values, null first.
    """
    values = _few(_value_counts(data, columns).orderBy("i", "v"))
    numbers: dict[int, dict] = {}
    for number, r in enumerate(values):
        numbers.setdefault(r["i"], {})[r["v"]] = number
    row = []
    for i, c in enumerate(columns):
        of = numbers.get(i, {})
        none = F.lit(of.get(None)).cast("int")
        pairs = [x for v, n in of.items() if v is not None for x in (F.lit(v), F.lit(n))]
        row.append(F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(c)), none) if pairs else none)
    parts = int(data.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(data.select(key, F.array(*row).alias("row")).repartition(parts)), values


def _first_modes(data: DataFrame, values: Sequence, k: int) -> list[tuple]:
    """Starting modes: the profile of the commonest values, then always the one that is both common and far.

    A profile's weight is the summed frequency of its values; each further mode has the largest
    smallest product of weight and mismatches to the modes so far.
    """
    often = F.array(*[F.lit(0 if r["v"] is None else r["n"]).cast("bigint") for r in values])
    weight = F.aggregate("row", F.lit(0).cast("bigint"), lambda a, v: a + F.get(often, v))
    kinds = cut_lineage(data.select("row").distinct().withColumn("_w", weight))
    modes: list[tuple] = []
    while len(modes) < k:
        far = [_mismatches(m) for m in modes]
        score = F.col("_w") * (F.least(*far) if len(far) > 1 else far[0]) if far else F.col("_w")
        (top,) = kinds.withColumn("_s", score).orderBy(F.desc("_s"), "row").limit(1).collect()
        if modes and top["_s"] == 0:
            raise ValueError(f"fewer than {k} distinct profiles")
        modes.append(tuple(top["row"]))
    return modes


def _mismatches(mode: tuple):
    return F.size("row") - F.size(F.array_intersect("row", F.array(*[F.lit(v) for v in mode])))


def _closest_mode(modes: Sequence[tuple]):
    """Number of the mode with the fewest mismatches, the first one on ties."""
    return F.array_min(F.array(*[F.struct(_mismatches(m).alias("d"), F.lit(n).alias("c")) for n, m in enumerate(modes)]))["c"]


def _smallest_reachable(links: DataFrame, cores: DataFrame) -> tuple[DataFrame, int]:
    """The smallest ``cluster`` that each core reaches over the links, and the rounds it took.

    A cluster names the core it was first the name of.  In each round a core and the core it is named after take the
    smallest name beside the former, and every name is then replaced by the name of its own core, so paths halve.
    """
    rounds = 0
    while True:
        rounds += 1
        beside = links.join(cores.select(F.col("bits").alias("other"), F.col("cluster").alias("theirs")), "other")
        best = beside.groupBy("bits").agg(F.min("theirs").alias("theirs")).join(cores, "bits")
        offered = best.select(F.explode(F.array("bits", "cluster.bits")).alias("bits"), "theirs").groupBy("bits").agg(
            F.min("theirs").alias("theirs"))
        taken = cut_lineage(cores.join(offered, "bits", "left").select(
            "bits", F.col("cluster").alias("before"), F.least("cluster", F.coalesce("theirs", "cluster")).alias("cluster")))
        named = taken.select(F.col("bits").alias("_core"), F.col("cluster").alias("_name"))
        after = cut_lineage(taken.join(named, F.col("cluster.bits") == F.col("_core")).select(
            "bits", "before", F.col("_name").alias("cluster")))
        moved = after.where("before <> cluster").limit(1).count()
        cores = after.drop("before")
        if not moved:
            return cores, rounds


def density(profiles: DataFrame, columns: Sequence[str], min_samples: int, key: str = "pid") -> DataFrame:
    """``(pid, cluster)`` by density over 0/1 profiles: neighbours differ in at most one attribute.

    Equal profiles are merged and counted first.  The possible neighbours of a profile are its
    one-attribute changes, looked up by equality, so no two profiles are ever compared.  A profile
    with ``min_samples`` users around it is a core; cores that are neighbours share a cluster, named
    after its smallest user; other profiles join the smallest cluster beside them or are noise (-1).
    """
    # one letter an attribute; null is a value of its own, and other values than 0 and 1 are an error
    letter = lambda c: F.when(F.col(c).isNull(), "-").when(F.col(c).isin(0, 1), F.col(c).cast("string")).otherwise(
        F.raise_error(F.concat(F.lit(f"not 0 or 1 in {c}: "), F.col(c).cast("string"))).cast("string"))
    bits = F.concat(*[letter(c) for c in columns])
    users = profiles.select(F.col(key).alias("_key"), bits.alias("bits"))
    kinds = cut_lineage(users.groupBy("bits").agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("first")))
    width = len(columns)
    flip = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: F.transform(
        F.array(F.lit("0"), F.lit("1"), F.lit("-")), lambda v: F.concat(
            F.substr(F.col("bits"), F.lit(1), i - 1), v, F.substr(F.col("bits"), i + 1)))))
    changed = kinds.select("bits", F.explode(flip).alias("other")).where("bits <> other")
    edges = cut_lineage(changed.join(kinds.select(F.col("bits").alias("other"), F.col("n").alias("m")), "other"))
    around = edges.groupBy("bits").agg(F.sum("m").alias("m"))
    crowd = F.col("n") + F.coalesce("m", F.lit(0))
    marked = cut_lineage(kinds.join(around, "bits", "left").select("bits", "first", (crowd >= min_samples).alias("core")))
    cores = marked.where("core").select("bits", F.struct("first", "bits").alias("cluster"))
    links = cut_lineage(edges.select("bits", "other").join(cores.select("bits"), "bits", "left_semi").join(
        cores.select(F.col("bits").alias("other")), "other", "left_semi"))
    cores, _ = _smallest_reachable(links, cores)
    cores = cores.select("bits", F.col("cluster.first").alias("cluster"))
    beside = edges.join(cores.withColumnRenamed("bits", "other"), "other").groupBy("bits").agg(F.min("cluster").alias("border"))
    named = marked.join(cores, "bits", "left").join(beside, "bits", "left").select(
        "bits", F.coalesce("cluster", "border", F.lit(-1)).alias("cluster"))
    return users.join(named, "bits").select(F.col("_key").alias(key), "cluster")


def cluster_table(labels: Mapping[str, DataFrame], key: str = "pid") -> DataFrame:
    """One row per user with a column per clustering."""
    named = [df.select(key, F.col("cluster").alias(name)) for name, df in labels.items()]
    return reduce(lambda a, b: a.join(b, key), named)
