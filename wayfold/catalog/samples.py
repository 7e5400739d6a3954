"""Class sampling, folds and random splits."""

from __future__ import annotations

from wayfold import bindings as B
from wayfold.bindings import oracle
from wayfold.catalog import register
from wayfold.functions.digest import BITS, digest60_sql
from wayfold.operators import folds, sampling

SEED = 7


def _clicks(spark, d):
    return B.clicks_table(spark, d).select("sid", "click_mode")


def _sids(spark, d):
    return B.table(spark, d, "orders").selectExpr("o_orderkey AS sid")


_NUMBERED = f"""sized AS (SELECT click_mode, count(*) AS n FROM t_clicks GROUP BY click_mode),
    numbered AS (SELECT sid, click_mode, row_number() OVER (PARTITION BY click_mode
    ORDER BY {digest60_sql('sid', seed=SEED)}, sid) - 1 AS idx FROM t_clicks)"""


def drawn_sql(targets: dict[int, str]) -> str:
    """With replacement; each target is an SQL expression over the class size n."""
    draws = " UNION ALL ".join(
        f"SELECT {m} AS m, n, CAST(unnest(range(CAST({t} AS BIGINT))) AS BIGINT) AS i FROM sized WHERE click_mode = {m}"
        for m, t in targets.items())
    classes = ", ".join(map(str, targets))
    return oracle("t_clicks", body=f"""WITH {_NUMBERED}, draws AS ({draws}),
        picked AS (SELECT m, {digest60_sql('m', 'i', seed=SEED)} % n AS idx FROM draws)
        SELECT sid, click_mode FROM t_clicks WHERE click_mode NOT IN ({classes})
        UNION ALL SELECT sid, click_mode FROM picked JOIN numbered ON click_mode = m AND numbered.idx = picked.idx""")


def kept_sql(mode: int, quota: str) -> str:
    return oracle("t_clicks", body=f"""WITH {_NUMBERED} SELECT sid, t.click_mode FROM numbered t
        JOIN sized s ON t.click_mode = s.click_mode WHERE t.click_mode <> {mode} OR idx < {quota}""")


@register("sample_percentage", drawn_sql({3: "floor(40 * 0.01 * n) + 1"}))
def _(spark, d):
    return sampling.sample_percentage(_clicks(spark, d), 3, 40, seed=SEED)


@register("sample_amount", drawn_sql({4: "500"}))
def _(spark, d):
    return sampling.sample_amount(_clicks(spark, d), 4, 500, seed=SEED)


@register("sample_like_mode", kept_sql(5, "(SELECT least(a.n, b.n) FROM sized a, sized b WHERE a.click_mode = 5 AND b.click_mode = 4)"))
def _(spark, d):
    clicks = _clicks(spark, d)
    sizes = sampling.class_sizes(clicks, "click_mode")
    return sampling.keep_exactly(clicks, "click_mode", {5: min(sizes[5], sizes[4])}, seed=SEED)


@register("sample_like_mode_up", drawn_sql({3: "(SELECT max(n) FROM sized) + 1"}))
def _(spark, d):
    clicks = _clicks(spark, d)
    largest = max(sampling.class_sizes(clicks, "click_mode").values())
    return sampling.draw_exactly(clicks, "click_mode", {3: largest + 1}, seed=SEED)


@register("sample_half", kept_sql(5, "floor(n / 2)"))
def _(spark, d):
    return sampling.sample_half(_clicks(spark, d), 5, seed=SEED)


@register("sample_down_pct", kept_sql(5, "floor(n * 0.3)"))
def _(spark, d):
    return sampling.sample_down(_clicks(spark, d), 5, 0.3, seed=SEED)


@register("sample_double", drawn_sql({6: "2 * n"}))
def _(spark, d):
    return sampling.sample_double(_clicks(spark, d), 6, seed=SEED)


@register("sample_up_pct", drawn_sql({6: "n + floor(n * 0.25)"}))
def _(spark, d):
    return sampling.sample_up(_clicks(spark, d), 6, 0.25, seed=SEED)


@register("rebalance_plan", drawn_sql({m: str(t) for m, t in sampling.REBALANCED.items()}))
def _(spark, d):
    return sampling.rebalance(_clicks(spark, d), seed=SEED)


@register("sample_n", oracle("t_queries", body=f"SELECT sid, pid FROM t_queries ORDER BY {digest60_sql('sid', seed=SEED)}, sid LIMIT 100"))
def _(spark, d):
    return sampling.sample_n(B.queries_table(spark, d).select("sid", "pid"), 100, seed=SEED)


@register("folds_equal", f"""SELECT sid, CAST(floor((row_number() OVER (ORDER BY {digest60_sql('sid', seed=9001)}, sid) - 1) * 5
    / (SELECT count(*) FROM orders)) AS INT) AS fold FROM (SELECT o_orderkey AS sid FROM orders)""")
def _(spark, d):
    return folds.folds_equal(_sids(spark, d), 5)


@register("folds_kfold", oracle("t_clicks", body=f"""WITH r AS (SELECT sid, row_number() OVER (ORDER BY {digest60_sql('sid', seed=SEED)}, sid) - 1
    AS rn, count(*) OVER () AS n FROM t_clicks)
    SELECT sid, CAST(CASE WHEN rn < (n % 7) * (n // 7 + 1) THEN rn // (n // 7 + 1)
    ELSE n % 7 + (rn - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INT) AS fold FROM r"""))
def _(spark, d):
    return folds.folds_shuffled(_clicks(spark, d).select("sid"), 7, seed=SEED)


@register("folds_stratified", oracle("t_clicks", body=f"""WITH {_NUMBERED} SELECT sid, click_mode, CAST(idx % 5 AS INT) AS fold
    FROM numbered"""))
def _(spark, d):
    return folds.folds_stratified(_clicks(spark, d), 5, "click_mode", seed=SEED)


@register("split_random", oracle("t_queries", body=f"""SELECT sid, CASE WHEN {digest60_sql('sid', seed=SEED)} < {int(0.75 * 2**BITS)}
    THEN 'train' ELSE 'test' END AS split FROM t_queries"""))
def _(spark, d):
    return folds.split_random(B.queries_table(spark, d), seed=SEED).select("sid", "split")
