"""The feature tables: one row per session, one row per shown plan, external context, all together.

Each input is read once.  Sessions, plans and clicks meet on ``sid``; every feature of a plan list
is computed inside its row after that, so the wide columns never cross a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.functions import clock, coords, encode, planlists
from wayfold.learn import decompose, text
from wayfold.operators import context, joins, ranks, setops
from wayfold.schemas import PROFILE_COLUMNS
from wayfold.session import cut_lineage


def plan_features(df: DataFrame, plans: str = "plans", keep: str | None = "last") -> DataFrame:
    """Statistics, modes at extremes, flags and, unless ``keep`` is None, the wide columns of a parsed list."""
    out = planlists.summarize(planlists.add_mode_flags(df, plans), plans)
    out = out.withColumn("first_mode", planlists.first_mode(F.col(plans)))
    if keep is None:
        return out
    return planlists.wide(out, plans, keep=keep, missing_price=700 if keep == "last" else 99999)


def _sessions(queries: DataFrame) -> DataFrame:
    return clock.weekday_hour(coords.split_coords(queries))


def _parsed(df: DataFrame) -> DataFrame:
    return df.withColumn("plans", planlists.parse_plans(F.col("plans")))


def add_text_components(df: DataFrame, plans: str = "plans", k: int = 10, basis: DataFrame | None = None) -> DataFrame:
    """``TFIDF_clustered_<i>`` of the mode documents.

    Weights and components are fitted on ``basis``, a cheaper table with the same lists, where one is given.
    """
    document = text.terms_of(planlists.mode_words(F.col(plans))).alias("_terms")
    docs = cut_lineage((df if basis is None else basis).select(document))
    idf = text.fit_idf(docs, terms="_terms")
    vectors = lambda table: text.weight_vectors(table, idf, terms="_terms", name="_vector").drop("_terms")
    found = decompose.add_components(vectors(df.select("*", document)), "_vector", len(idf), k, "TFIDF_clustered", vectors(docs))
    return found.drop("_vector")


def _rounded(df: DataFrame, prefix: str, digits: int | None) -> DataFrame:
    if digits is None:
        return df
    return df.withColumns({c: F.round(c, digits) for c in df.columns if c.startswith(prefix)})


def _joined_profiles(sessions: DataFrame, profiles: DataFrame, components: bool, unknown: str = "keep", k: int = 20,
                     digits: int | None = None) -> DataFrame:
    """Profile attributes, with ``PID_MainComp_<i>`` beside them if asked; one join either way.

    ``digits`` rounds the components, once per profile.
    """
    if not components:
        return joins.join_profiles(sessions, profiles, unknown=unknown)
    found = _rounded(decompose.profile_components(setops.add_sentinel(profiles), PROFILE_COLUMNS, k), "PID_MainComp_", digits)
    (sentinel,) = found.where("pid = -1").collect()
    return joins.join_profiles(sessions, found.where("pid <> -1"), unknown=unknown,
                               anonymous={c: sentinel[c] for c in found.columns if c != "pid"})


def features_col(queries: DataFrame, plans: DataFrame, clicks: DataFrame | None, profiles: DataFrame, keep: str = "last",
                 components: bool = False, share: float | None = None, digits: int | None = None) -> DataFrame:
    """One row per session, also for plan lists without a known session.

    ``components`` adds the profile and text components, rounded to ``digits`` if given, ``share`` the time-ordered ``split``.
    """
    sessions = _joined_profiles(_sessions(queries), profiles, components, digits=digits)
    if clicks is not None:
        sessions = sessions.join(clicks, "sid", "left")
    joined = _parsed(joins.join_plans_full(sessions, plans))
    if share is not None:
        # stored, as the cut takes a few passes
        times = cut_lineage(joins.join_plans_full(queries.select("sid", "req_time"), plans.select("sid")))
        joined = ranks.split_by_time(joined, share, basis=times)
    if components:
        lists = joins.join_plans_full(queries.select("sid"), plans.select("sid", "plans"))
        joined = _rounded(add_text_components(joined, basis=_parsed(lists)), "TFIDF_clustered_", digits)
    table = plan_features(joined, keep=keep).drop("plans")
    return encode.label_response(table) if clicks is not None else table


def features_row(queries: DataFrame, plans: DataFrame, clicks: DataFrame | None, profiles: DataFrame,
                 components: bool = False, share: float | None = None) -> DataFrame:
    """One row per shown plan with the features of its session; missing prices read the median.

    Sessions, lists, clicks and profiles are joined before the lists unfold, while there is one
    row per session to move.
    """
    joined = _sessions(queries).join(plans, "sid")
    if clicks is not None:
        joined = joined.join(clicks, "sid", "left").withColumn("click_mode", F.coalesce("click_mode", F.lit(0)))
    joined = _parsed(_joined_profiles(joined, profiles, components, unknown="drop"))
    if components:
        lists = queries.select("sid").join(plans.select("sid", "plans"), "sid", "left")
        joined = add_text_components(joined, basis=_parsed(lists))
    rows = planlists.unfold(plan_features(joined, keep=None))
    if share is not None:
        rows = ranks.split_sessions_by_time(rows, share)
    # the prices alone, without clicks, attributes and features
    slim = joins.join_profiles(queries.select("sid", "pid").join(plans.select("sid", "plans"), "sid"), profiles.select("pid"), unknown="drop")
    rows = ranks.fill_median(rows, "price", store=True, basis=planlists.unfold(_parsed(slim.select("plans"))))
    return encode.label_response(rows) if clicks is not None else rows


def features_external(queries: DataFrame, stations: DataFrame, holidays: DataFrame, calendar: DataFrame,
                      districts: DataFrame, hot: bool = True) -> DataFrame:
    """Coordinates, nearest station, clock, holiday, weather and districts of every session."""
    df = coords.split_coords(queries)
    df = context.add_nearest_station(df, stations)
    df = clock.clock_features(df, "req")
    df = context.add_holiday(df, holidays)
    df = context.add_weather(df, calendar)
    return context.add_districts(df, districts, hot=hot, distances=True)


def features_all(raw: DataFrame, external: DataFrame) -> DataFrame:
    """Raw and external features of the sessions that have both."""
    return joins.join_on_session(raw, external)


def feature_names(df: DataFrame, besides: Sequence[str] = ("sid", "pid", "req_time", "plan_time", "click_time",
                                                           "click_mode", "Response", "split", "fold")) -> list[str]:
    """Numeric columns usable as model input."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [n for n, t in df.dtypes if t in numeric and n not in besides]
