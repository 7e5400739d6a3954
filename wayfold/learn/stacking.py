"""Stacked models: out-of-fold tables side by side, a second model on top."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.learn.cross_validation import cv_classifier, dealt, final_fit_predict
from wayfold.operators.joins import join_many
from wayfold.operators.quality import check_columns
from wayfold.schemas import MODES
from wayfold.session import cut_lineage


def stack_features(oof: Mapping[str, DataFrame], clicks: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Probabilities of every model on ``sid`` with the label (0 without a click); folds are left out.

    ``extra`` gives further columns by ``sid``, each named ``extra_<column>``; sessions without them are left out.
    """
    wanted = ["sid", *[f"prob_{m}" for m in MODES]]
    tables = {name: check_columns(df, wanted).select(*wanted) for name, df in oof.items()}
    joined = join_many(tables).join(clicks.select("sid", "click_mode"), "sid", "left")
    if extra is not None:
        joined = joined.join(extra.select("sid", *[F.col(c).alias(f"extra_{c}") for c in extra.columns if c != "sid"]), "sid")
    return joined.withColumn("click_mode", F.coalesce("click_mode", F.lit(0)))


def _inputs(stacked: DataFrame) -> list[str]:
    return [c for c in stacked.columns if c.startswith(("prob_", "extra_"))]


def stack_fit(stacked: DataFrame, folds: DataFrame, estimator: Estimator, scaled: bool = False) -> DataFrame:
    """Cross-validate a second model on the stacked columns; ``folds`` is ``(sid, fold)``.

    The two are joined, dealt and stored once, as every fold reads them several times.
    """
    whole = cut_lineage(dealt(stacked.join(folds.select("sid", "fold"), "sid"), "sid"))
    return cv_classifier(whole, _inputs(stacked), estimator, scaled=scaled, laid=True)


def stack_final(stacked: DataFrame, test: DataFrame, estimator: Estimator, path: str, scaled: bool = True, laid: bool = False) -> DataFrame:
    """Fit the second model on all stacked rows, store it with its scale at ``path`` and predict ``test`` with the stored one.

    ``test`` holds the same columns, with the probabilities of base models that were fitted without its sessions.  Unless they
    are ``laid``, the stacked rows are joined once and stored as vectors.
    """
    return final_fit_predict(stacked, test, _inputs(stacked), estimator, path, scaled=scaled, laid=laid)
