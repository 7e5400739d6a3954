"""Documents, components, scaling, hexagon cells, run summaries."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.bindings import oracle
from wayfold.catalog import register
from wayfold.catalog.scalars import coords_of, lists_of, rounded
from wayfold.functions import encode, hexgrid, planlists
from wayfold.learn import decompose, text
from wayfold.operators import runs, setops
from wayfold.plans.features import add_text_components
from wayfold.schemas import PROFILE_COLUMNS
from wayfold.session import cut_lineage


def _documents(spark, d):
    return lists_of(spark, d).select("sid", text.terms_of(planlists.mode_words(F.col("plans"))).alias("terms"))


@register("tfidf_bigrams", oracle("t_sessions", "t_listed", body="""WITH words AS (SELECT s.sid, coalesce(pos, 0) AS pos,
    coalesce('word_' || CAST(transport_mode AS VARCHAR), 'word_null') AS w FROM t_sessions s LEFT JOIN t_listed l ON s.sid = l.sid),
    terms AS (SELECT sid, w AS term FROM words UNION ALL SELECT a.sid, a.w || ' ' || b.w FROM words a JOIN words b
    ON a.sid = b.sid AND b.pos = a.pos + 1),
    tf AS (SELECT sid, term, count(*) AS tf FROM terms GROUP BY sid, term),
    idf AS (SELECT term, ln((1 + (SELECT count(*) FROM t_sessions)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term),
    raw AS (SELECT sid, term, tf * idf AS w FROM tf JOIN idf USING (term)),
    len AS (SELECT sid, sqrt(sum(w * w)) AS l FROM raw GROUP BY sid)
    SELECT sid, term, round(w / l, 6) AS weight FROM raw JOIN len USING (sid)"""))
def _(spark, d):
    docs = cut_lineage(_documents(spark, d))  # lists are parsed once, for the frequencies and for the weights
    weighed = text.weigh(docs, text.fit_idf(docs))
    return rounded(text.weight_rows(weighed, "sid"), ["weight"])


@register("mode_svd")
def _(spark, d):
    found = add_text_components(lists_of(spark, d)).drop("plans", "plan_time")
    return rounded(found, found.columns[1:])


@register("profile_svd")
def _(spark, d):
    profiles = setops.add_sentinel(B.profiles_table(spark, d))
    found = decompose.profile_components(profiles, PROFILE_COLUMNS, 20).drop(*PROFILE_COLUMNS)
    return rounded(found, found.columns[1:])


_SCALED = ["distance", "eta"]


@register("standardize", oracle("t_rows", body="SELECT sid, pos, transport_mode, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM t_rows)) / (SELECT stddev_pop({c}) FROM t_rows), 6) AS {c}" for c in _SCALED) + " FROM t_rows"))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).select("sid", "pos", "transport_mode", *_SCALED)
    return rounded(decompose.standardize(rows, _SCALED), _SCALED)


@register("assemble", oracle("t_rows", body="""SELECT sid, pos, CAST(transport_mode AS DOUBLE) AS f0, CAST(distance AS DOUBLE) AS f1,
    CAST(eta AS DOUBLE) AS f2 FROM t_rows"""))
def _(spark, d):
    rows = decompose.assemble(B.plan_rows_table(spark, d), ["transport_mode", "distance", "eta"])
    values = vector_to_array("features")
    return rows.select("sid", "pos", *[values[i].alias(f"f{i}") for i in range(3)])


def _hex_sql(end, n):
    x, y, e = f"{end}_long", f"{end}_lat", hexgrid.EDGE[n]
    q, r = f"(({math.sqrt(3) / 3!r} * {x} - {y} / 3.0) / {e})", f"(({2.0 / 3.0!r} * {y}) / {e})"
    s = f"(-{q} - {r})"
    near = lambda c: f"floor({c} + 0.5)"
    off = lambda c: f"abs({near(c)} - {c})"
    first = f"({off(q)} > {off(r)} AND {off(q)} > {off(s)})"
    cq = f"CASE WHEN {first} THEN -{near(r)} - {near(s)} ELSE {near(q)} END"
    cr = f"CASE WHEN NOT {first} AND {off(r)} > {off(s)} THEN -{near(q)} - {near(s)} ELSE {near(r)} END"
    return f"'{n}:' || CAST(CAST({cq} AS BIGINT) AS VARCHAR) || ':' || CAST(CAST({cr} AS BIGINT) AS VARCHAR)"


_CELLS_SQL = ", ".join(f"{_hex_sql(end, n)} AS {end}_cell_{n}" for n in hexgrid.EDGE for end in ("o", "d"))


@register("geo_cells", oracle("t_coords", body=f"SELECT sid, {_CELLS_SQL} FROM t_coords"))
def _(spark, d):
    cells = hexgrid.hex_cells()
    return coords_of(spark, d).withColumns(cells).select("sid", *cells)


@register("geo_cell_stats", oracle("t_coords", body=f"WITH c AS (SELECT {_CELLS_SQL} FROM t_coords) " + " UNION ALL ".join(
    f"""SELECT '{end}_cell_{n}' AS "column", count(DISTINCT {end}_cell_{n}) AS cells FROM c""" for n in hexgrid.EDGE for end in ("o", "d"))))
def _(spark, d):
    cells = hexgrid.hex_cells()
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), c.alias("cell")) for n, c in cells.items()])
    found = coords_of(spark, d).select(F.inline(pairs)).distinct()
    return found.groupBy("column").agg(F.count("cell").alias("cells"))


# Ends and resolutions whose cells are one-hot encoded.
_HOT = (("o", 4), ("d", 4), ("o", 6), ("o", 7), ("o", 8))


@register("geo_cell_one_hot", oracle("t_coords", body=f"WITH c AS (SELECT sid, {_CELLS_SQL} FROM t_coords) SELECT sid, " + ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {e}_cell_{n}) - 1 AS INT) AS {e}_{n}, CAST((SELECT count(DISTINCT {e}_cell_{n}) FROM c) + 1 AS INT) AS {e}_{n}_width"
    for e, n in _HOT) + " FROM c"))
def _(spark, d):
    cells = {f"{e}_{n}": hexgrid.hex_cell(F.col(f"{e}_long"), F.col(f"{e}_lat"), n) for e, n in _HOT}
    hot = cut_lineage(coords_of(spark, d).select("sid", *[c.alias(name) for name, c in cells.items()]))
    for name in cells:
        hot = encode.one_hot_vector(hot, name, f"hot_{name}")
    values = {name: F.unwrap_udt(F.col(f"hot_{name}")) for name in cells}
    return hot.select("sid", *[c for name, v in values.items() for c in (v["indices"][0].alias(name), v["size"].alias(f"{name}_width"))])


@register("params_to_rows", """SELECT c_custkey AS run, 'metric' AS kind, 'F1_mean' AS "key", CAST(c_nationkey AS VARCHAR) AS value FROM customer
    UNION ALL SELECT c_custkey, 'param', 'num_leaves', CAST(c_custkey % 60 AS VARCHAR) FROM customer
    UNION ALL SELECT c_custkey, 'param', 'segment', c_mktsegment FROM customer
    UNION ALL SELECT c_custkey, 'feature', '0', 'eta_1' FROM customer
    UNION ALL SELECT c_custkey, 'feature', '1', c_name FROM customer""")
def _(spark, d):
    made = B.table(spark, d, "customer").selectExpr(
        "c_custkey AS run", "c_nationkey AS F1_mean", "concat('eta_1 - ', c_name) AS features",
        "to_json(named_struct('num_leaves', c_custkey % 60, 'segment', c_mktsegment)) AS parameters")
    return runs.run_rows(made, "run", ["F1_mean"])
