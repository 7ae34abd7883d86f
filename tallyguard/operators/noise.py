"""Label noise for robustness studies: how much do wrong labels cost a baseline?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio, uniform
from .encode import NORMAL_CATEGORY
from .ordering import CHUNK_WIDTH, with_previous, with_running_max

# Fixed values.
NOISE_TRIGGER = 3


def inject_label_noise(
    df: DataFrame,
    rate: float,
    key: Sequence[str],
    seed: int = 42,
    label: str = "label",
    category: str = "category",
    normal: str = NORMAL_CATEGORY,
    active: Column | None = None,
    flag: str | None = None,
) -> DataFrame:
    """Mark a share of the anomalous rows as normal; features stay untouched.

    Which rows are flipped depends on seed and row key only.  ``active`` limits
    the noise to some rows, for example to late cycles; ``flag`` names a column
    that tells flipped rows.
    """
    if not 0.0 <= rate <= 1.0:
        raise ValueError(f"rate {rate} is not between 0 and 1")
    chosen = (F.col(label) == 1) & (uniform(seed, *key) < F.lit(float(rate)))
    if active is not None:
        chosen = chosen & active
    flip = F.coalesce(chosen, F.lit(False))
    marked = df.withColumn("__flip", flip)
    noisy = marked.withColumns(
        {
            label: F.when(F.col("__flip"), F.lit(0)).otherwise(F.col(label)).cast("int"),
            category: F.when(F.col("__flip"), F.lit(normal)).otherwise(F.col(category)),
        }
    )
    return noisy.drop("__flip") if flag is None else noisy.withColumnRenamed("__flip", flag)


def noise_summary(noisy: DataFrame, flag: str, label: str = "label") -> DataFrame:
    """Rows flipped, rows that could have been, and the effective rate."""
    return noisy.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(flag)).alias("flipped"),
        F.count_if(F.col(flag) | (F.col(label) == 1)).alias("eligible"),
    ).withColumn("effective_rate", ratio(F.col("flipped"), F.col("eligible")))


def noise_activation(
    cycles: DataFrame,
    trigger: int = NOISE_TRIGGER,
    cycle: str = "cycle",
    enabled: str = "enabled",
    order: str | None = None,
    width: int = CHUNK_WIDTH,
) -> DataFrame:
    """Whether noise is on at each step, and the cycle in which it last went on.

    It goes on in the first enabled step at or after the trigger cycle, stays
    on while enabled and goes off when disabled.  Cycles never decrease, so on
    is the same as enabled and triggered, and the last start is the largest.
    ``order`` is the step number if one cycle has several steps.
    """
    by = order or cycle
    on = F.coalesce(F.col(enabled) & (F.col(cycle) >= trigger), F.lit(False))
    stepped = with_previous(cycles.withColumn("is_active", on), by, ["is_active"], width=width)
    was_on = F.coalesce(F.col("previous.is_active"), F.lit(False))
    started = stepped.withColumn(
        "__start", F.when(F.col("is_active") & ~was_on, F.col(cycle))
    ).drop("previous")
    return with_running_max(started, by, "__start", "started_at_cycle", width=width).drop("__start")
