"""Features of a session's plan list, computed inside its row.

The list is one cell (an array of structs), so every feature here is a column expression:
no explode, no regrouping by session, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.schemas import MODES, PLAN_LIST

MEASURES = {"dist": "distance", "price": "price", "eta": "eta"}


def parse_plans(text: Column) -> Column:
    """JSON text to an array of plans; null and malformed texts give an empty array."""
    return F.coalesce(F.from_json(text, PLAN_LIST), F.array().cast(PLAN_LIST))


def _price(plan: Column) -> Column:
    return plan["price"].try_cast("int")


def _if_any(plans: Column, value: Column, otherwise) -> Column:
    return F.when(F.size(plans) > 0, value).otherwise(F.lit(otherwise))


def _measured(measure: str):
    def entry(p, i):
        value = F.coalesce(_price(p), F.lit(0)) if measure == "price" else p[MEASURES[measure]]
        return F.struct(value.alias("v"), i.alias("i"), p["transport_mode"].alias("mode"))
    return entry


def summarize(df: DataFrame, plans: str = "plans", stats: bool = True, arg_modes: bool = True) -> DataFrame:
    """Per measure: largest, smallest, mean, population deviation, and the modes at the extremes.

    Sessions without a plan get -1.  Of equal smallest values the first shown counts, of equal
    largest ones the last.  The (value, position, mode) entries are built once per measure and
    referenced several times, so Catalyst keeps them as a column of their own.
    """
    entries = {f"_e_{m}": F.transform(F.col(plans), _measured(m)) for m in MEASURES}
    parts, out = {}, {}
    for m in MEASURES:
        e = F.col(f"_e_{m}")
        parts[f"_hi_{m}"], parts[f"_lo_{m}"] = F.array_max(e), F.array_min(e)
        if stats:
            parts[f"_mean_{m}"] = F.aggregate(e, F.lit(0.0), lambda a, x: a + x["v"]) / F.nullif(F.size(e), F.lit(0))
    some, n = F.col(plans), F.size(plans)
    for m in MEASURES:
        hi, lo = F.col(f"_hi_{m}"), F.col(f"_lo_{m}")
        if stats:
            out[f"max_{m}"], out[f"min_{m}"] = _if_any(some, hi["v"], -1), _if_any(some, lo["v"], -1)
            out[f"mean_{m}"] = _if_any(some, F.col(f"_mean_{m}"), -1.0)
            # from the differences, as a difference of large squares would lose them
            spread = F.aggregate(F.col(f"_e_{m}"), F.lit(0.0), lambda a, x: a + (x["v"] - F.col(f"_mean_{m}")) * (x["v"] - F.col(f"_mean_{m}")))
            out[f"std_{m}"] = _if_any(some, F.sqrt(spread / n), -1.0)
        if arg_modes:
            out[f"max_{m}_mode"] = _if_any(some, hi["mode"], -1)
            out[f"min_{m}_mode"] = _if_any(some, lo["mode"], -1)
    return df.withColumns(entries).withColumns(parts).withColumns(out).drop(*entries, *parts)


def first_mode(plans: Column) -> Column:
    return F.coalesce(F.get(plans, F.lit(0))["transport_mode"], F.lit(0))


def add_mode_flags(df: DataFrame, plans: str = "plans", modes: Sequence[int] = MODES) -> DataFrame:
    """``mode_<i>_available``; mode 0 stands for "no plan"."""
    shown = df.withColumn("_shown", F.transform(plans, lambda p: p["transport_mode"]))
    flags = {}
    for mode in modes:
        has = (F.size("_shown") == 0) if mode == 0 else F.array_contains("_shown", F.lit(mode))
        flags[f"mode_{mode}_available"] = has.cast("int")
    return shown.withColumns(flags).drop("_shown")


def mode_words(plans: Column) -> Column:
    """Words ``word_<mode>`` in display order, one ``word_null`` without a plan."""
    words = F.transform(plans, lambda p: F.concat(F.lit("word_"), p["transport_mode"].cast("string")))
    return F.when(F.size(plans) > 0, words).otherwise(F.array(F.lit("word_null")))


def wide(df: DataFrame, plans: str = "plans", keep: str = "last", missing_price: int | None = 700,
         modes: Sequence[int] = MODES, absent: int | None = 0) -> DataFrame:
    """``dist_<m>``, ``price_<m>``, ``eta_<m>`` per mode.

    ``keep`` says which plan of a repeated mode counts: the "last" or the "first" one shown.
    An empty or zero price reads ``missing_price``, a mode not shown ``absent``.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last, not {keep!r}")
    # places in the list of modes, as they are looked up in compiled code
    listed = df.withColumn("_listed", F.col(plans) if keep == "first" else F.reverse(plans))
    listed = listed.withColumn("_shown", F.transform("_listed", lambda p: p["transport_mode"]))
    place = lambda m: F.nullif(F.array_position("_shown", F.lit(m)), F.lit(0)).cast("int")
    held = {f"_m{m}": F.try_element_at("_listed", place(m)) for m in modes}
    out = {}
    for m in modes:
        plan = F.col(f"_m{m}")
        price = _price(plan)
        price = F.when(price != 0, price)
        if missing_price is not None:
            price = F.coalesce(price, F.lit(missing_price))
        for short, value in (("dist", plan["distance"]), ("price", price), ("eta", plan["eta"])):
            out[f"{short}_{m}"] = F.when(plan.isNotNull(), value).otherwise(F.lit(absent))
    return listed.withColumns(held).withColumns(out).drop("_listed", "_shown", *held)


def unfold(df: DataFrame, plans: str = "plans", missing_price: int | None = None) -> DataFrame:
    """One row per plan with its display position ``pos``; price as number or ``missing_price``."""
    # the outer form keeps Catalyst from parsing the text a second time for a size filter
    rows = df.select("*", F.posexplode_outer(plans).alias("pos", "_plan")).drop(plans).where("pos IS NOT NULL")
    price = _price(F.col("_plan"))
    if missing_price is not None:
        price = F.coalesce(price, F.lit(missing_price))
    return rows.withColumns({
        "distance_plan": F.col("_plan.distance"),
        "price": price,
        "eta": F.col("_plan.eta"),
        "transport_mode": F.col("_plan.transport_mode"),
    }).drop("_plan")
