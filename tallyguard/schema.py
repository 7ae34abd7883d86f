"""Schemas of the tables the jobs read and write.  Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _struct(fields: str) -> T.StructType:
    """Schema from ``name type, name type``; needs no running session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column order and types of a flow file.
FLOW_COLUMNS = [
    "dur", "proto", "service", "state", "spkts", "dpkts", "sbytes", "dbytes", "rate", "sttl",
    "dttl", "sload", "dload", "sloss", "dloss", "sinpkt", "dinpkt", "sjit", "djit", "swin",
    "stcpb", "dtcpb", "dwin", "tcprtt", "synack", "ackdat", "smean", "dmean", "trans_depth",
    "response_body_len", "ct_srv_src", "ct_state_ttl", "ct_flw_http_mthd", "is_ftp_login",
    "ct_ftp_cmd", "ct_srv_dst", "ct_dst_ltm", "ct_src_ltm", "ct_src_dport_ltm",
    "ct_dst_sport_ltm", "ct_dst_src_ltm", "is_sm_ips_ports", "attack_cat", "label",
]
FLOW_DOUBLES = {
    "dur", "rate", "sload", "dload", "sinpkt", "dinpkt", "sjit", "djit", "tcprtt", "synack",
    "ackdat",
}
FLOW_STRINGS = {"proto", "service", "state", "attack_cat"}
FLOW_FEATURES = tuple(c for c in FLOW_COLUMNS if c not in ("attack_cat", "label"))


def _flow_type(name: str) -> T.DataType:
    if name in FLOW_DOUBLES:
        return T.DoubleType()
    return T.StringType() if name in FLOW_STRINGS else T.IntegerType()


FLOW = T.StructType([T.StructField(c, _flow_type(c)) for c in FLOW_COLUMNS])

MODEL = _struct(
    "model_id string, created_at timestamp, feature string, pos int, mean double, "
    "std double, n bigint, z_threshold double, model_type string"
)

# An alert file may come from the detector or from the log rules, so the
# schema is the union of both.
ALERT = _struct(
    "alert_id string, timestamp timestamp, sample_id bigint, prediction string, "
    "anomaly_type string, type string, confidence double, container string, "
    "alert_type string, severity string, description string, anomaly_score double, "
    "current_accuracy double, previous_accuracy double, degradation_percent double, "
    "component string, error_code string, message string"
)

HISTORY_METRICS = ("accuracy", "precision", "recall", "f1_score")
HISTORY_COUNTS = ("true_positives", "false_positives", "true_negatives", "false_negatives")


def history_schema(targets: dict[str, str]) -> T.StructType:
    """History columns; ``targets`` maps a short name to its category."""
    fields = [T.StructField("iteration", T.IntegerType()), T.StructField("ts", T.TimestampType())]
    fields += [T.StructField(m, T.DoubleType()) for m in HISTORY_METRICS]
    fields += [T.StructField(c, T.LongType()) for c in (*HISTORY_COUNTS, "total_samples")]
    fields += [T.StructField(rate_column(name), T.DoubleType()) for name in targets]
    return T.StructType(fields)


def rate_column(name: str) -> str:
    return f"{name}_detection_rate"


RETRAIN_EVENT = _struct(
    "iteration int, ts timestamp, status string, message string, "
    "duration_seconds double, model_id string"
)
