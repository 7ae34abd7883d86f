"""Reports over flows: totals, histograms and top values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import percent_text, ratio
from ..session import one_row
from .evaluate import with_share
from .rules import ALERT_CONFIDENCE

# Fixed value.
TOP_VALUES = 5


def _is_alert(min_confidence: float) -> Column:
    return (F.col("prediction") == 1) & (F.col("confidence") >= F.lit(float(min_confidence)))


def flows_vs_alerts(
    scored: DataFrame, label: str = "label", min_confidence: float = ALERT_CONFIDENCE
) -> DataFrame:
    """Flow totals beside the alert total, from one pass over the scored flows."""
    totals = scored.agg(
        F.count("*").alias("total_flows"),
        F.count_if(F.col(label) == 1).alias("anomalies"),
        F.count_if(_is_alert(min_confidence)).alias("alerts"),
    )
    return totals.withColumn("normal", F.col("total_flows") - F.col("anomalies"))


def _profile_columns() -> list[Column]:
    flows, anomalies, alerts = F.col("total_flows"), F.col("anomalies"), F.col("alerts")
    return [
        flows,
        (flows - anomalies).alias("normal"),
        anomalies,
        (ratio(anomalies, flows) * 100).alias("anomaly_percent"),
        alerts,
        (ratio(alerts, flows) * 100).alias("alert_percent"),
        percent_text(ratio(alerts, anomalies)).alias("alert_ratio"),
    ]


def traffic_profile(
    scored: DataFrame, label: str = "label", min_confidence: float = ALERT_CONFIDENCE
) -> DataFrame:
    """Flow and alert totals with their percentages and the alert effectiveness."""
    return flows_vs_alerts(scored, label, min_confidence).select(*_profile_columns())


def traffic_report(
    scored: DataFrame,
    protocol: str = "proto",
    service: str = "service",
    category: str = "category",
    label: str = "label",
    k: int = TOP_VALUES,
    min_confidence: float = ALERT_CONFIDENCE,
) -> DataFrame:
    """The traffic profile with the top protocols, the top services and the attack categories as one nested row.

    The flows are read once and counted by protocol, service and category; all
    figures are sums of these counts.  The lists are arrays in order of their
    counts, ties by value.
    """
    values = {"protocol": protocol, "service": service, "category": category}
    named = {f"__{name}": F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for name, c in values.items()}
    counts = scored.withColumns(named).groupBy(*named).agg(
        F.count("*").alias("flows"),
        F.count_if(F.col(label) == 1).alias("anomalies"),
        F.count_if(_is_alert(min_confidence)).alias("alerts"),
    )
    entries = [
        F.struct(F.lit(name).alias("list"), F.col(f"__{name}").alias("value"), F.col(n).alias("n"))
        for name, n in (("protocol", "flows"), ("service", "flows"), ("category", "anomalies"))
    ]
    lists = counts.select(F.inline(F.array(*entries))).groupBy("list", "value").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("list").orderBy(F.desc("n"), "value"))
    top = lists.where("n > 0 AND list <> 'category'").withColumn("place", place).where(F.col("place") <= k)
    rest = lists.where("n > 0 AND list = 'category'").withColumn("place", place)

    def of(name: str, into: str) -> Column:
        entry = F.when(F.col("list") == name, F.struct("place", "value", "n"))
        return F.transform(
            F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["value"].alias("value"), e["n"].alias("n"))
        ).alias(into)

    ranked = top.unionByName(rest).agg(
        of("protocol", "top_protocols"), of("service", "top_services"), of("category", "attack_categories")
    )
    totals = counts.agg(
        F.coalesce(F.sum("flows"), F.lit(0)).alias("total_flows"),
        F.coalesce(F.sum("anomalies"), F.lit(0)).alias("anomalies"),
        F.coalesce(F.sum("alerts"), F.lit(0)).alias("alerts"),
    ).select(*_profile_columns())
    return totals.crossJoin(one_row(ranked))


def category_histogram(
    df: DataFrame, label: str = "label", category: str = "category"
) -> DataFrame:
    """Categories of the anomalous rows, most frequent first."""
    return (
        df.where(F.col(label) == 1)
        .groupBy(category)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), category)
    )


def top_values(df: DataFrame, col: str | Column, name: str, k: int = TOP_VALUES) -> DataFrame:
    """The ``k`` most frequent values; ties go to the smaller value."""
    value = F.col(col) if isinstance(col, str) else col
    return (
        df.groupBy(value.alias(name))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), name)
        .limit(k)
    )


def sorted_distribution(df: DataFrame, col: str) -> DataFrame:
    """Counts and percentages in the order of the value."""
    return with_share(df.groupBy(col).agg(F.count("*").alias("n"))).orderBy(col)


def dataset_composition(
    df: DataFrame, label: str = "label", category: str = "category"
) -> DataFrame:
    """Count and percentage in total, per label and per category.

    The table is first counted per (label, category); the grouping sets only
    expand those counts.
    """
    counts = df.groupBy(label, category).agg(F.count("*").alias("__n"))
    sets = counts.groupingSets(
        [[F.col(label)], [F.col(category)], []], F.col(label), F.col(category)
    ).agg(F.grouping_id().alias("__gid"), F.sum("__n").alias("n"))
    total = counts.agg(F.sum("__n").alias("__total"))
    part = F.when(F.col("__gid") == 1, "label").when(F.col("__gid") == 2, "category")
    return sets.crossJoin(one_row(total)).select(
        F.coalesce(part, F.lit("total")).alias("part"),
        F.when(F.col("__gid") == 1, F.col(label).cast("string"))
        .when(F.col("__gid") == 2, F.col(category).cast("string"))
        .alias("value"),
        "n",
        (ratio(F.col("n"), F.col("__total")) * 100).alias("percent"),
    )


def batch_anomaly_counts(
    df: DataFrame, by: Sequence[Column], label: str = "label"
) -> DataFrame:
    """Rows and anomalies per batch."""
    return df.groupBy(*by).agg(
        F.count("*").alias("flows"), F.count_if(F.col(label) == 1).alias("anomalies")
    )
