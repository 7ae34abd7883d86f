"""Score rows against a one-row model by z-score voting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import compute_once, finite, ratio
from ..session import one_row
from .rules import ALERT_CONFIDENCE, CONFIDENCE_DIVISOR, SCORE_GROUP, VOTE_SHARE, WIDE_SCORE
from .vectors import model_side, score_vectors, z_array


def _with_model(df: DataFrame, model: DataFrame, by: str | None = None) -> DataFrame:
    """Every row beside the model row, or beside each row of a few: a broadcast of a global aggregate."""
    stats = model.select(
        *([by] if by else []),
        F.col("means").alias("__means"),
        F.transform("stds", lambda s: F.nullif(s, F.lit(0.0))).alias("__stds"),
        F.col("z_threshold").alias("__limit"),
    )
    return df.crossJoin(one_row(stats))


def _z(i: int, name: str) -> Column:
    """NULL for a feature without deviation and for a value that is not finite."""
    return F.abs(finite(F.col(name)) - F.get("__means", i)) / F.get("__stds", i)


def z_scores(df: DataFrame, model: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``z_<feature>`` for each feature."""
    named = {f"z_{f}": _z(i, f) for i, f in enumerate(features)}
    return _with_model(df, model).withColumns(named).drop("__means", "__stds", "__limit")


def _vector(features: Sequence[str]) -> Column:
    return F.array(*[F.col(f).cast("double") for f in features])


def _score_columns(
    df: DataFrame, model: DataFrame, features: Sequence[str], vote_share: float, by: str | None, keep: Sequence[str]
) -> DataFrame:
    """Each z once, then the votes and the sum of the voting z, group by group."""
    voted = _with_model(df, model, by)
    votes, sums = [], []
    for start in range(0, len(features), SCORE_GROUP):
        group = list(enumerate(features))[start : start + SCORE_GROUP]
        zs = {f"__z{i}": _z(i, f) for i, f in group}
        beyond = {z: F.col(z) > F.col("__limit") for z in zs}
        counted = reduce(add, [F.when(beyond[z], 1).otherwise(0) for z in zs])
        summed = reduce(add, [F.when(beyond[z], F.col(z)).otherwise(F.lit(0.0)) for z in zs])
        totals = {f"__votes{start}": counted, f"__sum{start}": summed}
        kept = {f"__z{i}": f"z_{f}" for i, f in group if f in keep}
        gone = [z for z in zs if z not in kept]
        voted = compute_once(voted.withColumns(zs), totals).drop(*gone).withColumnsRenamed(kept)
        votes.append(f"__votes{start}")
        sums.append(f"__sum{start}")
    n_votes = reduce(add, [F.col(v) for v in votes])
    z_sum = reduce(add, [F.col(s) for s in sums])
    confidence = F.least(z_sum / (n_votes * F.lit(CONFIDENCE_DIVISOR)), F.lit(1.0))
    return voted.withColumns(
        {
            "prediction": (n_votes > F.lit(len(features) * float(vote_share))).cast("int"),
            "confidence": F.when(n_votes > 0, confidence).otherwise(F.lit(0.0)),
        }
    ).drop("__means", "__stds", "__limit", *votes, *sums)


def score(
    df: DataFrame,
    model: DataFrame | None,
    features: Sequence[str],
    vote_share: float = VOTE_SHARE,
    by: str | None = None,
    keep_z: Sequence[str] = (),
) -> DataFrame:
    """Add ``prediction`` (0 or 1) and ``confidence`` (0..1).

    A row is anomalous if more than ``vote_share`` of all features lie beyond
    the model's threshold; features without deviation never vote but count.
    Without a model nothing is an anomaly.  With ``by`` the model has a few rows,
    told apart by that column, and each row of ``df`` comes out once for each,
    from one scan.  ``keep_z`` names features whose z stays as ``z_<feature>``.
    """
    if model is None:
        return df.withColumns({"prediction": F.lit(0), "confidence": F.lit(0.0)})
    if len(features) <= WIDE_SCORE or by or keep_z:
        return _score_columns(df, model, features, vote_share, by, keep_z)
    with_vector = df.withColumn("__v", _vector(features))
    return score_vectors(with_vector, model, "__v", vote_share).drop("__v")


def predict(
    df: DataFrame, model: DataFrame | None, features: Sequence[str], vote_share: float = VOTE_SHARE
) -> DataFrame:
    return score(df, model, features, vote_share).drop("confidence")


def select_alerts(scored: DataFrame, min_confidence: float = ALERT_CONFIDENCE) -> DataFrame:
    """Rows predicted anomalous with enough confidence."""
    return scored.where(
        (F.col("prediction") == 1) & (F.col("confidence") >= F.lit(float(min_confidence)))
    )


def score_alerts(
    df: DataFrame,
    model: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    category: str = "category",
    ts: str | None = None,
    min_confidence: float = ALERT_CONFIDENCE,
    vote_share: float = VOTE_SHARE,
    container: str | None = None,
) -> DataFrame:
    """Alerts with the row key, its category and the confidence; ``container`` says who raised them."""
    times = [F.col(ts).cast("timestamp").alias("ts")] if ts else []
    origin = [F.lit(container).alias("container")] if container else []
    return select_alerts(score(df, model, features, vote_share), min_confidence).select(
        *key,
        *times,
        F.lit("ANOMALY").alias("prediction"),
        F.coalesce(F.col(category), F.lit("Unknown")).alias("anomaly_type"),
        "confidence",
        *origin,
    )


def contributing_features(
    df: DataFrame,
    model: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    min_confidence: float = ALERT_CONFIDENCE,
    vote_share: float = VOTE_SHARE,
) -> DataFrame:
    """One row per alert and voting feature, ranked by z within the alert.

    Only alerts are looked at, and the array of an alert has one entry per
    feature, so ranking needs no shuffle.
    """
    alerts = select_alerts(score(df, model, features, vote_share), min_confidence)
    entries = F.zip_with(
        z_array("__v"), "__stats", lambda z, s: F.struct((-z).alias("neg_z"), s["feature"].alias("feature"))
    )
    hot = F.array_sort(F.filter(entries, lambda e: -e["neg_z"] > F.col("__limit")))
    return (
        alerts.select(*key, "confidence", _vector(features).alias("__v"))
        .crossJoin(model_side(model))
        .select(*key, "confidence", F.posexplode(hot).alias("pos", "entry"))
        .select(
            *key,
            "confidence",
            (F.col("pos") + 1).alias("rank"),
            F.col("entry.feature").alias("feature"),
            (-F.col("entry.neg_z")).alias("z"),
        )
    )


def alert_coverage(
    scored: DataFrame, label: str = "label", min_confidence: float = ALERT_CONFIDENCE
) -> DataFrame:
    """Share of anomalies detected and share of rows alerted, in percent."""
    positive = F.col(label) == 1
    hit = F.col("prediction") == 1
    alerted = hit & (F.col("confidence") >= F.lit(float(min_confidence)))
    return scored.agg(
        F.count("*").alias("rows"),
        F.count_if(alerted).alias("alerts"),
        F.count_if(positive & hit).alias("detected"),
        F.count_if(positive).alias("anomalies"),
    ).select(
        "rows",
        "alerts",
        (ratio(F.col("detected"), F.col("anomalies")) * 100).alias("coverage_percent"),
        (ratio(F.col("alerts"), F.col("rows")) * 100).alias("alert_rate_percent"),
    )
