"""Files: headered CSV flows, JSON log lines, alert documents, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import compute_once, time_cutoff
from ..operators.alerts import readable_alerts
from ..operators.encode import align_schema, encode_features
from ..schema import ALERT
from ..session import join_path

ALERTS_PER_FILE = 1_000
# Where the reader puts the text of a document that it cannot parse.
BROKEN = "_broken"
# A quote inside a quoted cell is doubled.
QUOTES = {"quote": '"', "escape": '"'}
# Full precision; the JSON default stops at milliseconds.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def scan_flows(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    features: Sequence[str] = (),
    label: str | None = None,
) -> DataFrame:
    """Headered CSV as text columns, with ``features`` encoded as numbers.

    Columns are found by their name in the header, spaces aside.  A cell that is
    there but empty is the empty text (a feature of 0); the cells that a short
    row does not have are NULL, and extra cells of long rows are dropped.  A
    missing file gives no rows.
    """
    try:
        header = spark.read.csv(path, header=True, **QUOTES).columns
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _encoded(spark.createDataFrame([], _text_schema(columns)), features, label)
    ragged = "_ragged"
    while ragged in header:
        ragged += "_"
    # With enforceSchema off, a file whose header differs is an error, not a mix-up.
    rows = spark.read.schema(_text_schema([*header, ragged])).csv(
        path, header=True, mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord=ragged, **QUOTES
    )
    # The reader gives NULL for both kinds, but hands over the text of each row of another length.
    rows = rows.toDF(*[f"__{i}" for i in range(len(header))], "__ragged")
    bare = F.regexp_replace("__ragged", '"(?:[^"]|"")*+"', "")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    filled = {
        c: F.coalesce(F.col(f"__{i}"), F.when(F.col("__ragged").isNull() | (cells > i), F.lit("")))
        for i, c in enumerate(header)
    }
    # Computed before any filter: the reader would judge a short row by the cells that it has not read.
    rows = compute_once(rows, filled).select(*[f"`{c}`" for c in header])
    return _encoded(align_schema(rows, {c: "string" for c in columns}), features, label)


def _encoded(rows: DataFrame, features: Sequence[str], label: str | None) -> DataFrame:
    encoded = encode_features(rows, features)
    if label:
        encoded = encoded.withColumn(label, F.col(label).try_cast("int"))
    return encoded


def write_flows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, **QUOTES)


def scan_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that hold one JSON object each; other lines are skipped."""
    lines = spark.read.text(path)
    return lines.where(F.json_object_keys("value").isNotNull())


def scan_alert_files(
    spark: SparkSession, path: str, as_of: Column | None = None, window: str | None = None
) -> DataFrame:
    """Alert files that hold an array or one alert; broken files are skipped.

    One file is one record, so files are spread over tasks, not their parts.
    """
    schema = T.StructType([*ALERT.fields, T.StructField(BROKEN, T.StringType())])
    read = spark.read.schema(schema).json(path, multiLine=True, columnNameOfCorruptRecord=BROKEN)
    alerts = readable_alerts(read, BROKEN)
    if window:
        now = F.current_timestamp() if as_of is None else as_of
        alerts = alerts.where(F.col("timestamp") >= time_cutoff(now, window))
    return alerts


def write_alert_documents(
    alerts: DataFrame, path: str, key: Sequence[str], per_file: int = ALERTS_PER_FILE
) -> None:
    """Alerts as JSON array documents of about ``per_file`` alerts, one per file.

    The number of documents follows the number of alerts.  The row key and the
    place where a row was read decide the document, so none grows with the data
    or with a repeated key.
    """
    documents = max(1, -(-alerts.count() // per_file))
    spread = F.pmod(F.xxhash64(*key, F.monotonically_increasing_id()), F.lit(documents))
    arrays = alerts.withColumn("__document", spread).groupBy("__document").agg(
        F.to_json(
            F.collect_list(F.struct(*alerts.columns)), {"timestampFormat": TIME_FORMAT}
        ).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


def write_report(report: DataFrame, path: str, report_id: object) -> None:
    """Report rows as JSON documents, NULL fields kept; a report written again replaces itself."""
    folder = join_path(path, f"report_id={report_id}")
    report.write.mode("overwrite").json(folder, ignoreNullFields=False, timestampFormat=TIME_FORMAT)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All reports below ``path``, with the columns of ``schema``."""
    reports = spark.read.schema(schema).json(path, timestampFormat=TIME_FORMAT)
    return reports.select(*schema.names)
