"""Trip-log views over the given order tables.

A session is an order, its plan list is a JSON text made row by row from the order's own
columns, the clicked mode is one of the listed ones, a profile is a customer.  A second plan
table, already unfolded, comes from lineitem.  Each view is a projection of one table, so the
bindings add no shuffle to what a query measures.  ``ORACLE`` holds the same views as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfold.schemas import PROFILE_COLUMNS, WEATHER

_KNOWN = "o_orderkey % 97 <> 5"
_SIZE = "CAST(o_orderkey % 8 AS INT)"
_REQ = "o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey % 1440 AS INT)"
_PID = "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey END"


def _coord(key: str, k_long: int, k_lat: int) -> str:
    """A place: four of five in a dense centre of a tenth of a degree, the rest anywhere, a few far off to the east."""
    def part(center: str, first: int, far: int, k: int) -> str:
        dense = f"concat('{center}', lpad(CAST(({key} * {k}) % 100000 AS STRING), 5, '0'))"
        wide = f"concat(CAST({first} + ({key} * {k}) % 2 AS STRING), '.', lpad(CAST(({key} * {k} * 7) % 1000000 AS STRING), 6, '0'))"
        away = f"concat('{far}.', lpad(CAST(({key} * {k}) % 1000000 AS STRING), 6, '0'))"
        return f"CASE WHEN {key} % 97 = 3 THEN {away} WHEN {key} % 5 = 0 THEN {wide} ELSE {dense} END"
    return f"concat({part('116.3', 115, 119, k_long)}, ',', {part('39.9', 39, 40, k_lat)})"


_O = _coord("o_custkey", 7919, 6607)
_D = _coord("o_orderkey", 7907, 6599)


def _mode(i: str) -> str:
    return f"CAST((o_custkey + {i} * {i}) % 11 + 1 AS INT)"


_DISTANCE = "CAST(((o_orderkey * 37 + i * i * 101) % 40 + 1) * 250 AS INT)"
_ETA = "CAST(CAST(floor(o_totalprice / 200) AS INT) + (i * 613) % 900 AS INT)"
_PRICE_NUMBER = "CAST(CAST(floor(o_totalprice / 100) AS INT) % 3000 + 100 + i * 10 AS STRING)"
_PRICE = (
    f"CASE WHEN (o_orderkey + i) % 10 = 0 THEN '' WHEN (o_orderkey + i) % 10 = 1 THEN '0' "
    f"ELSE {_PRICE_NUMBER} END"
)
_CLICK_SLOT = f"(1 + CAST(floor(o_orderkey / 8) AS INT) % {_SIZE})"
_CLICKED = "o_orderstatus <> 'P' AND o_orderkey % 8 <> 0"
_WEATHER_CASE = "CASE (month(o_orderdate) * 31 + day(o_orderdate)) % 6 " + " ".join(
    f"WHEN {i} THEN '{w}'" for i, w in enumerate(WEATHER)
) + " END"
_CALENDAR = (
    "SELECT DISTINCT concat(lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-', "
    "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')) AS md, "
    "CAST(20 - abs(month(o_orderdate) - 7) * 4 + day(o_orderdate) % 5 AS STRING) AS max_temp, "
    "CAST(10 - abs(month(o_orderdate) - 7) * 4 + day(o_orderdate) % 5 AS STRING) AS min_temp, "
    f"{_WEATHER_CASE} AS weather, CAST(day(o_orderdate) % 4 + 1 AS STRING) AS wind FROM orders"
)


def _profile(i: int) -> str:
    return f"CASE WHEN (c_custkey * {2 * i + 3} + {i * i} + floor(c_acctbal / {i + 7})) % 7 < 2 THEN 1 ELSE 0 END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(_KNOWN).selectExpr(
        "o_orderkey AS sid", f"{_PID} AS pid", f"{_REQ} AS req_time", f"{_O} AS o", f"{_D} AS d"
    )


def plans_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    element = (
        f"concat('{{\"distance\": ', {_DISTANCE}, ', \"price\": ', "
        f"CASE WHEN (o_orderkey + i) % 10 = 0 THEN '\"\"' ELSE {_PRICE} END, "
        f"', \"eta\": ', {_ETA}, ', \"transport_mode\": ', {_mode('i')}, '}}')"
    )
    text = (
        "CASE WHEN o_orderkey % 24 = 8 THEN '[]' WHEN o_orderkey % 24 = 16 THEN 'oops' ELSE "
        f"concat('[', array_join(transform(sequence(1, {_SIZE}), i -> {element}), ', '), ']') END"
    )
    return table(spark, sf_dir, "orders").filter("o_orderkey % 24 <> 0").selectExpr(
        "o_orderkey AS sid", f"{_REQ} + INTERVAL '3' SECOND AS plan_time", f"{text} AS plans"
    )


def clicks_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(_CLICKED).selectExpr(
        "o_orderkey AS sid", f"{_REQ} + INTERVAL '30' SECOND AS click_time",
        f"{_mode(_CLICK_SLOT)} AS click_mode",
    )


def profiles_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS pid", *[f"{_profile(i)} AS {c}" for i, c in enumerate(PROFILE_COLUMNS)]
    )


_ROW_COLUMNS = [
    "l_orderkey AS sid",
    "l_linenumber AS pos",
    "CAST(l_partkey % 11 + 1 AS INT) AS transport_mode",
    "CAST(floor(l_quantity * 1000) AS INT) AS distance",
    "CAST(floor(l_extendedprice / 10) AS INT) AS eta",
    "CASE WHEN l_discount = 0 THEN '' ELSE CAST(CAST(floor(l_extendedprice / 100) AS INT) AS STRING) END AS price",
]


def plan_rows_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans already unfolded; ``pos`` may repeat, so order by :data:`SHOWN`."""
    return table(spark, sf_dir, "lineitem").selectExpr(*_ROW_COLUMNS)


# Display order of unfolded plans: position, then content where positions repeat.
SHOWN = ["pos", "transport_mode", "distance", "eta", "price"]


def calendar_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 366 rows, one per day of the year."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate")
    return spark.sql(_CALENDAR.replace("FROM orders", "FROM {orders}"), orders=orders)


def holidays_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_table(spark, sf_dir).filter("md BETWEEN '10-01' AND '10-07'").select("md")


def stations_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS subway_name",
        "39 + ((s_suppkey * 67) % 200) / CAST(100 AS DOUBLE) AS o_lat",
        "115 + ((s_suppkey * 71) % 200) / CAST(100 AS DOUBLE) AS o_long",
    )


def districts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").filter("n_nationkey < 16").selectExpr(
        "n_nationkey AS idx", "n_name AS District",
        "39 + ((n_nationkey * 29) % 200) / CAST(100 AS DOUBLE) AS o_lat",
        "115 + ((n_nationkey * 83) % 200) / CAST(100 AS DOUBLE) AS o_long",
    )


ORACLE: dict[str, str] = {
    "t_queries": f"SELECT o_orderkey AS sid, {_PID} AS pid, {_REQ} AS req_time, {_O} AS o, {_D} AS d "
                 f"FROM orders WHERE {_KNOWN}",
    "t_coords": "SELECT sid, pid, req_time, CAST(split_part(o, ',', 1) AS DOUBLE) AS o_long, "
                "CAST(split_part(o, ',', 2) AS DOUBLE) AS o_lat, CAST(split_part(d, ',', 1) AS DOUBLE) AS d_long, "
                "CAST(split_part(d, ',', 2) AS DOUBLE) AS d_lat FROM t_queries",
    "t_sessions": f"SELECT o_orderkey AS sid, {_REQ} + INTERVAL '3' SECOND AS plan_time FROM orders "
                  "WHERE o_orderkey % 24 <> 0",
    "t_listed": f"SELECT o_orderkey AS sid, CAST(i - 1 AS INT) AS pos, {_mode('i')} AS transport_mode, "
                f"{_DISTANCE} AS distance, {_ETA} AS eta, {_PRICE} AS price FROM orders, "
                f"LATERAL (SELECT CAST(unnest(range(1, 1 + {_SIZE})) AS INT) AS i) t",
    "t_clicks": f"SELECT o_orderkey AS sid, {_REQ} + INTERVAL '30' SECOND AS click_time, "
                f"{_mode(_CLICK_SLOT)} AS click_mode FROM orders WHERE {_CLICKED}",
    "t_profiles": "SELECT c_custkey AS pid, " + ", ".join(
        f"{_profile(i)} AS {c}" for i, c in enumerate(PROFILE_COLUMNS)) + " FROM customer",
    "t_rows": f"SELECT {', '.join(_ROW_COLUMNS)} FROM lineitem",
    "t_dedup": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sid, transport_mode ORDER BY "
               + ", ".join(SHOWN) + ") AS rn FROM t_rows) WHERE rn = 1",
    "t_calendar": _CALENDAR,
    "t_stations": "SELECT s_name AS subway_name, 39 + ((s_suppkey * 67) % 200) / CAST(100 AS DOUBLE) AS o_lat, "
                  "115 + ((s_suppkey * 71) % 200) / CAST(100 AS DOUBLE) AS o_long FROM supplier",
    "t_districts": "SELECT n_nationkey AS idx, n_name AS District, "
                   "39 + ((n_nationkey * 29) % 200) / CAST(100 AS DOUBLE) AS o_lat, "
                   "115 + ((n_nationkey * 83) % 200) / CAST(100 AS DOUBLE) AS o_long FROM nation "
                   "WHERE n_nationkey < 16",
}

_NEEDS = {"t_coords": ["t_queries"], "t_dedup": ["t_rows"]}


def oracle(*views: str, body: str) -> str:
    """One SELECT for the oracle: the named views as a WITH clause, then ``body``."""
    ordered: list[str] = []
    for view in views:
        for name in [*_NEEDS.get(view, []), view]:
            if name not in ordered:
                ordered.append(name)
    clauses = ", ".join(f"{name} AS ({ORACLE[name]})" for name in ordered)
    tail = body.strip()
    if not clauses:
        return tail
    if tail.upper().startswith("WITH "):
        own = tail[5:].strip()
        if own.upper().startswith("RECURSIVE "):
            return f"WITH RECURSIVE {clauses}, {own[10:]}"
        return f"WITH {clauses}, {own}"
    return f"WITH {clauses} {tail}"
