"""State tables: alerts, models, snapshots, history, events and test sets.

A table is a folder of Parquet parts.  A writer that may run twice for the
same cycle, batch or version writes a part named after it and overwrites that
part, so a repeated run leaves one copy.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.accumulate import SNAPSHOT_ID
from ..operators.baseline import model_from_rows, model_rows
from ..operators.history import rounded
from ..operators.models import latest_rows
from ..operators.rules import MODEL_TYPE
from ..schema import MODEL, RETRAIN_EVENT
from ..session import join_path
from . import store

VERSION = "version"


def write_part(df: DataFrame, path: str, key: str, value: object, mode: str = "overwrite") -> None:
    df.drop(key).write.mode(mode).parquet(join_path(path, f"{key}={value}"))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table, or None if nothing was written yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        table = reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return table if schema is None else table.select(*schema.names)


# Alerts ---------------------------------------------------------------------


def append_alerts(alerts: DataFrame, path: str, batch: object, ts: str = "ts") -> None:
    """Add the alerts of one batch, partitioned by day so that a time window reads only its days.

    A batch that is written again replaces its own rows on all days, those on
    which it has none any more included, and touches no other batch.
    """
    dated = alerts.withColumn("alert_date", F.to_date(ts)).drop("batch")
    dated.write.mode("overwrite").partitionBy("alert_date").parquet(join_path(path, f"batch={batch}"))


def read_alerts(
    spark: SparkSession, path: str, since: Column | None = None, ts: str = "ts"
) -> DataFrame | None:
    alerts = read_table(spark, path)
    if alerts is None or since is None:
        return alerts
    return alerts.where((F.col("alert_date") >= F.to_date(since)) & (F.col(ts) >= since))


# Models ---------------------------------------------------------------------


def freeze_model(model: DataFrame) -> DataFrame:
    """Compute a one-row model once, so that scoring does not fit it again.

    Fetches a single row that holds two numbers per feature.
    """
    return model.sparkSession.createDataFrame([model.first()], model.schema)


def save_model(
    model: DataFrame,
    path: str,
    model_id: str,
    created_at: Column,
    model_type: str = MODEL_TYPE,
) -> DataFrame:
    """Store a version and return the frozen model; refuses one without rows."""
    frozen = freeze_model(model)
    if frozen.first()["n"] == 0:
        raise ValueError("no normal rows to fit on")
    rows = model_rows(frozen, model_id, created_at, model_type)
    write_part(rows, path, "model_id", model_id)
    return frozen


def read_models(spark: SparkSession, path: str) -> DataFrame | None:
    return read_table(spark, path, MODEL)


def load_model(
    spark: SparkSession, path: str, features: list[str] | tuple[str, ...], model_id: str | None = None
) -> DataFrame | None:
    """One-row model of the named or the newest version; None if there is none."""
    models = read_models(spark, path)
    if models is None:
        return None
    rows = latest_rows(models) if model_id is None else models.where(F.col("model_id") == model_id)
    return model_from_rows(rows, features)


# Snapshots ------------------------------------------------------------------


def capture_snapshot(rows: DataFrame, path: str, snapshot_id: object) -> bool:
    """Store the rows under a snapshot id; nothing is stored without rows."""
    if rows.isEmpty():
        return False
    write_part(rows, path, SNAPSHOT_ID, snapshot_id)
    return True


def append_training_log(summary: DataFrame, path: str, model_id: str) -> None:
    """Store the summary row of one training run; the same run again replaces it."""
    write_part(summary, path, "model_id", model_id)


# History and events ---------------------------------------------------------


def append_history(evaluated: DataFrame, path: str, iteration: int) -> None:
    """Store the row of one cycle with rates rounded to 4 places."""
    write_part(rounded(evaluated), path, "iteration", iteration)


def read_history(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    return read_table(spark, path, schema)


def log_retrain_event(
    spark: SparkSession,
    path: str,
    iteration: int,
    status: str,
    ts: Column,
    message: str = "",
    duration_seconds: float = 0.0,
    model_id: str = "",
) -> None:
    event = spark.range(1).select(
        ts.cast("timestamp").alias("ts"),
        F.lit(status).alias("status"),
        F.lit(message).alias("message"),
        F.lit(float(duration_seconds)).alias("duration_seconds"),
        F.lit(model_id).alias("model_id"),
    )
    write_part(event, path, "iteration", iteration)


def append_cycles(rows: DataFrame, path: str, cycle: str = "iteration") -> None:
    """Store rows of many cycles at once, history or events; a cycle that is there already is replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(cycle).parquet(path)


def read_retrain_events(spark: SparkSession, path: str) -> DataFrame | None:
    return read_table(spark, path, RETRAIN_EVENT)


# Test sets ------------------------------------------------------------------
#
# A version is a folder ``version=N``; its number is claimed first, by a file that
# only one writer can create.  A reset claims a number as well and stores nothing
# under it: versions before it can still be read and restored, but none is current.

CLAIMS, SET, RESET = "_claims", "set", "reset"


def _claims(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and kind of every claim, in order."""
    found = [name.split(".") for name in store.names(spark, join_path(path, CLAIMS))]
    return sorted((int(parts[0]), parts[1]) for parts in found if len(parts) == 2 and parts[0].isdigit())


def _claim(spark: SparkSession, path: str, kind: str) -> int:
    """The next number; of two writers that want the same one, the other takes the next."""
    taken = [number for number, _ in _claims(spark, path)]
    number = max([*taken, *stored_versions(spark, path)], default=0) + 1
    # The number alone decides: a set and a reset cannot both have it.
    while not store.claim(spark, join_path(path, CLAIMS, "taken", str(number))):
        number += 1
    store.claim(spark, join_path(path, CLAIMS, f"{number}.{kind}"))
    return number


def stored_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, resets aside."""
    numbers = [int(name.split("=")[1]) for name in store.names(spark, path) if name.startswith(f"{VERSION}=")]
    return sorted(n for n in numbers if store.is_complete(spark, join_path(path, f"{VERSION}={n}")))


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The current version: the newest, unless the set was reset since."""
    reset = max((number for number, kind in _claims(spark, path) if kind == RESET), default=0)
    return max((n for n in stored_versions(spark, path) if n > reset), default=None)


def add_test_set(test: DataFrame, path: str) -> int:
    """Store a new version and keep the older ones; returns its number."""
    version = _claim(test.sparkSession, path, SET)
    write_part(test, path, VERSION, version)
    return version


def read_test_set(
    spark: SparkSession, path: str, version: int | None = None
) -> DataFrame | None:
    """The named version or the current one."""
    wanted = newest_version(spark, path) if version is None else version
    if wanted not in stored_versions(spark, path):
        return None
    return spark.read.parquet(join_path(path, f"{VERSION}={wanted}"))


def restore_test_set(spark: SparkSession, path: str, version: int | None = None) -> int | None:
    """Make an older version (by default the one before the current) current again."""
    have, current = stored_versions(spark, path), newest_version(spark, path)
    older = [n for n in have if current is None or n < current]
    wanted = version if version is not None else (older[-1] if older else None)
    if wanted not in have:
        return None
    return add_test_set(read_test_set(spark, path, wanted), path)


def reset_test_set(spark: SparkSession, path: str) -> int | None:
    """From now on there is no current version, so the next ``create_once`` builds one; None if there was none."""
    if newest_version(spark, path) is None:
        return None
    return _claim(spark, path, RESET)


def create_once(spark: SparkSession, path: str, build) -> DataFrame:
    """The current test set; built and stored only if there is none.

    ``build`` returns the test set and whether it is the real one.  A fallback
    is handed back but not stored, so the next cycle tries again.
    """
    stored = read_test_set(spark, path)
    if stored is not None:
        return stored
    test, is_real = build()
    if not is_real:
        return test
    return read_test_set(spark, path, add_test_set(test, path))


def recreate_test_set(spark: SparkSession, path: str, build) -> DataFrame:
    """Reset and build anew; what was there stays as an older version."""
    reset_test_set(spark, path)
    return create_once(spark, path, build)
