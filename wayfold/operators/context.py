"""Context of a session: weather, holidays, nearest station, district.

The day tables have at most 366 distinct keys after de-duplication, so they may be broadcast.
Districts are a driver-side list of checked length, turned into column expressions.  Stations
are matched through grid cells with equi-joins; there is no cross join.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions.coords import planar
from wayfold.functions.encode import one_hot
from wayfold.schemas import WEATHER

MOST_CENTRES = 256
# Distinct stations that a row may look at one by one.
FEW_SITES = 1024
# Nested cells of the nearest-site search: finest side, parts of a cell a side, first coarsest level and its most cells.
FINEST, FAN, FIRST_LEVEL, MOST_TOP = 0.05, 8, 3, 256


def _days(table: DataFrame, key: str) -> DataFrame:
    """Keep real ``MM-dd`` keys, once each: at most 366 rows, hence safe to broadcast."""
    real = table.where(F.col(key).rlike(r"^(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$"))
    rest = [c for c in real.columns if c != key]
    # of days that disagree the smallest row counts, in any order of the files
    one = real.groupBy(key).agg(F.min(F.struct(*rest)).alias("_day")).select(key, *[F.col(f"_day.{c}").alias(c) for c in rest])
    return F.broadcast(one)


def add_holiday(df: DataFrame, holidays: DataFrame, date: str = "req_date") -> DataFrame:
    days = _days(holidays.select(F.col("md").alias(date), F.lit(1).alias("is_holiday")), date)
    return df.join(days, date, "left").withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))


def add_weather(df: DataFrame, calendar: DataFrame, date: str = "req_date") -> DataFrame:
    """Temperatures, wind and the weather flags of the day; a date outside the calendar is an error."""
    days = _days(calendar.select(
        F.col("md").alias(date), F.col("max_temp").try_cast("int").alias("max_temp"),
        F.col("min_temp").try_cast("int").alias("min_temp"), "weather",
        F.col("wind").try_cast("int").alias("wind"), F.lit(True).alias("_known")), date)
    joined = df.join(days, date, "left")
    missing = F.raise_error(F.concat(F.lit("no weather for date "), F.coalesce(F.col(date), F.lit("null"))))
    checked = joined.withColumn("weather", F.when(F.col("_known"), F.col("weather")).otherwise(missing.cast("string")))
    return one_hot(checked.drop("_known"), "weather", WEATHER).drop("weather")


def _nested(spots: DataFrame, level: int, finest: float) -> DataFrame:
    """The cells of a level that hold a spot, with one of their spots and their rows; a cell parts into ``FAN`` by ``FAN`` finer ones."""
    at = lambda c: F.floor(F.floor(F.col(c) / finest) / F.lit(FAN**level)).alias
    cells = spots.select(at("_sx")("cx"), at("_sy")("cy"), F.struct("_sx", "_sy").alias("spot"), "_n")
    return cells.groupBy("cx", "cy").agg(F.min("spot").alias("spot"), F.sum("_n").alias("n"))


def _box_distances(cx: Column, cy: Column, side: float) -> tuple[Column, Column]:
    """Distance from a place to the nearest and to the farthest point of a cell."""
    low = lambda v, c: F.greatest(c * F.lit(side) - v, v - (c + 1) * F.lit(side), F.lit(0.0))
    high = lambda v, c: F.greatest(F.abs(c * F.lit(side) - v), F.abs(v - (c + 1) * F.lit(side)))
    length = lambda gap: F.sqrt(gap(F.col("_x"), cx) * gap(F.col("_x"), cx) + gap(F.col("_y"), cy) * gap(F.col("_y"), cy))
    return length(low), length(high)


def _may_count(per: DataFrame, k: int) -> DataFrame:
    """Of the cells ``cs`` those not farther than the bound within which ``k`` rows lie for sure; all where there are fewer."""
    if k == 1:
        high, enough = F.array_min(F.transform("cs", lambda c: c["high"])), F.lit(True)
    else:
        by_high = F.array_sort(F.transform("cs", lambda c: F.struct(c["high"].alias("high"), c["n"].alias("n"))))
        sure = F.aggregate(by_high, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("high")), lambda a, c: F.struct(
            (a["n"] + c["n"]).alias("n"), F.when(a["n"] >= k, a["high"]).otherwise(c["high"]).alias("high")))
        high, enough = sure["high"], sure["n"] >= k
    # a little slack for the rounding of cell bounds; the bound is a column of its own, found once a place
    reach = F.when(enough, high * F.lit(1 + 1e-9) + F.lit(2e-9)).otherwise(F.lit(float("inf")))
    cells = per.select("_x", "_y", "cs", reach.alias("reach")).select("_x", "_y", "reach", F.explode("cs").alias("c"))
    return cells.where(F.col("c.low") <= F.col("reach")).select("_x", "_y", "c.cx", "c.cy")


def near_cells(places: DataFrame, spots: DataFrame, k: int = 1, finest: float = FINEST, first: int = FIRST_LEVEL) -> DataFrame:
    """``(_x, _y, cx, cy)``: for every place the finest cells that may hold one of its ``k`` nearest rows.

    ``spots`` have ``_sx``, ``_sy`` and their rows ``_n``.  The few cells of the coarsest level are looked at in the row.
    Then level by level: the farthest points of the nearest cells (for one row a spot in them) bound the distance from
    above, cells whose box is farther go, the others part.  A place only meets cells that its own distance passes through,
    however far its spots are and however many they are.
    """
    top = first
    while len(cells := _nested(spots, top, finest).limit(MOST_TOP + 1).collect()) > MOST_TOP:
        top += 1
    if not cells:
        return places.select("_x", "_y", F.lit(0).alias("cx"), F.lit(0).alias("cy")).limit(0)

    def judged(cell: Column, level: int) -> Column:
        low, high = _box_distances(cell["cx"], cell["cy"], finest * FAN**level)
        if k == 1:
            high = planar(F.col("_x"), F.col("_y"), cell["spot"]["_sx"], cell["spot"]["_sy"])
        return F.struct(low.alias("low"), high.alias("high"), cell["n"].alias("n"), cell["cx"].alias("cx"), cell["cy"].alias("cy"))
    known = F.array(*[F.struct(
        F.lit(c["cx"]).alias("cx"), F.lit(c["cy"]).alias("cy"), F.lit(c["n"]).alias("n"),
        F.struct(F.lit(c["spot"]["_sx"]).alias("_sx"), F.lit(c["spot"]["_sy"]).alias("_sy")).alias("spot")) for c in cells])
    per = places.select("_x", "_y", F.transform(known, lambda c: judged(c, top)).alias("cs"))
    for level in range(top - 1, -1, -1):
        found = _may_count(per, k)
        finer = _nested(spots, level, finest).select(
            F.floor(F.col("cx") / FAN).alias("cx"), F.floor(F.col("cy") / FAN).alias("cy"), F.struct("cx", "cy", "spot", "n").alias("f"))
        # a place has a few cells of FAN by FAN parts each
        met = found.join(finer, ["cx", "cy"]).select("_x", "_y", judged(F.col("f"), level).alias("c"))
        per = met.groupBy("_x", "_y").agg(F.collect_list("c").alias("cs"))
    return _may_count(per, k)


def nearest(points: DataFrame, x: str, y: str, sites: DataFrame, site_x: str, site_y: str) -> DataFrame:
    """Exact distance from every distinct point to its nearest distinct site: ``(x, y, dist)``.

    Repeated coordinates are merged before any join, on both sides, so the joins work on places and not on sessions.
    Sites are rounded to two decimals: a finest cell holds at most 36 of them.
    """
    places = points.select(F.col(x).alias("_x"), F.col(y).alias("_y")).dropna().distinct()
    spots = sites.select(F.round(site_x, 2).alias("_sx"), F.round(site_y, 2).alias("_sy")).dropna().distinct().withColumn("_n", F.lit(1))
    at = lambda c: F.floor(F.col(c) / FINEST)
    pairs = near_cells(places, spots).join(spots.select(at("_sx").alias("cx"), at("_sy").alias("cy"), "_sx", "_sy"), ["cx", "cy"])
    dist = planar(F.col("_x"), F.col("_y"), F.col("_sx"), F.col("_sy"))
    return pairs.groupBy("_x", "_y").agg(F.min(dist).alias("dist")).withColumnsRenamed({"_x": x, "_y": y})


def add_nearest_station(df: DataFrame, stations: DataFrame, x: str = "o_long", y: str = "o_lat",
                        name: str = "dist_nearest_sub") -> DataFrame:
    """Planar distance to the nearest station times ten, three decimals.

    Up to :data:`FEW_SITES` distinct stations are one array that every row looks at where it is, without a join; more of
    them go through nested cells.
    """
    few = stations.select(F.round("o_long", 2).alias("x"), F.round("o_lat", 2).alias("y")).dropna().distinct().limit(FEW_SITES + 1).collect()
    if 0 < len(few) <= FEW_SITES:
        # one literal: folded once, whatever its length
        sites = F.from_json(F.lit(json.dumps([{"x": r["x"], "y": r["y"]} for r in few])), "array<struct<x: double, y: double>>")
        dist = F.array_min(F.transform(sites, lambda s: planar(F.col(x), F.col(y), s["x"], s["y"])))
        return df.withColumn(name, F.round(dist * 10.0, 3))
    found = nearest(df, x, y, stations, "o_long", "o_lat")
    scaled = found.select(x, y, F.round(F.col("dist") * 10.0, 3).alias(name))
    return df.join(scaled, [x, y], "left")


def centres(districts: DataFrame) -> list[tuple[int, float, float]]:
    """District centres as (index, long, lat), at most :data:`MOST_CENTRES` of them."""
    rows = districts.select("idx", "o_long", "o_lat").orderBy("idx").limit(MOST_CENTRES + 1).collect()
    if len(rows) > MOST_CENTRES:
        raise ValueError(f"more than {MOST_CENTRES} district centres")
    return [(int(r[0]), float(r[1]), float(r[2])) for r in rows]


def district_of(x: Column, y: Column, places: Sequence[tuple[int, float, float]]) -> Column:
    """Index of the nearest centre, the first one on ties; null without coordinates."""
    candidates = F.array(*[
        F.struct(planar(x, y, F.lit(cx), F.lit(cy)).alias("dist"), F.lit(i).alias("idx")) for i, cx, cy in places])
    return F.when(x.isNotNull() & y.isNotNull(), F.array_min(candidates)["idx"])


def add_districts(df: DataFrame, districts: DataFrame, hot: bool = False, distances: bool = False) -> DataFrame:
    """``o_district`` and ``d_district`` labels, optionally their flags and the distances to each centre."""
    places = centres(districts)
    out = {}
    for end in ("o", "d"):
        code = district_of(F.col(f"{end}_long"), F.col(f"{end}_lat"), places)
        out[f"{end}_district"] = F.concat(F.lit(f"{end}_district_"), code.cast("string"))
    df = df.withColumns(out)
    if hot:
        for end in ("o", "d"):
            labels = [f"{end}_district_{i}" for i, _, _ in places]
            df = df.withColumns({v: F.coalesce((F.col(f"{end}_district") == v).cast("int"), F.lit(0)) for v in labels})
    if distances:
        df = df.withColumns(district_distances(F.col("o_long"), F.col("o_lat"), places))
    return df


def district_distances(x: Column, y: Column, places: Sequence[tuple[int, float, float]]) -> dict[str, Column]:
    return {f"o_distance_{i}": planar(x, y, F.lit(cx), F.lit(cy)) for i, cx, cy in places}
