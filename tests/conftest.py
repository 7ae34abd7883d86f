from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyguard.schema import FLOW, FLOW_COLUMNS
from tallyguard.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(shared),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# One normal and one anomalous flow; columns that are not named hold 0.
NORMAL_FLOW = {
    "dur": 0.25, "proto": "tcp", "service": "http", "state": "FIN", "spkts": 12, "dpkts": 14,
    "sbytes": 900, "dbytes": 7200, "rate": 104.0, "sttl": 62, "dttl": 60, "sload": 28800.0,
    "dload": 230400.0, "sinpkt": 20.5, "dinpkt": 17.5, "smean": 75, "dmean": 514,
    "trans_depth": 1, "response_body_len": 6400, "ct_srv_src": 3, "ct_srv_dst": 2,
    "attack_cat": "Normal", "label": 0,
}
ANOMALY_FLOW = {
    **NORMAL_FLOW,
    "dur": 7.5, "service": "-", "spkts": 640, "dpkts": 310, "sbytes": 31000, "dbytes": 15500,
    "rate": 126.5, "ct_srv_src": 44, "ct_srv_dst": 57, "ct_dst_ltm": 120,
    "attack_cat": "Backdoors", "label": 1,
}


def _row(cells):
    zero = {"double": 0.0, "int": 0, "string": ""}
    return tuple(cells.get(f.name, zero[f.dataType.simpleString()]) for f in FLOW.fields)


@pytest.fixture
def flow_sample(spark):
    """Five equal normal rows and three equal anomalous rows."""
    rows = [_row(NORMAL_FLOW)] * 5 + [_row(ANOMALY_FLOW)] * 3
    return spark.createDataFrame(rows, FLOW)


# Ranges of generated flows, and what each attack overrides.
INT_RANGES = {
    "spkts": (1, 50), "dpkts": (1, 50), "sbytes": (40, 5000), "dbytes": (40, 5000),
    "sttl": (32, 128), "dttl": (32, 128), "ct_srv_src": (1, 20), "ct_srv_dst": (1, 20),
    "ct_dst_ltm": (1, 50), "ct_dst_sport_ltm": (1, 20), "trans_depth": (0, 5),
    "response_body_len": (0, 1000),
}
DOUBLE_RANGES = {"dur": (0.1, 300.0), "rate": (1.0, 1000.0), "sload": (100.0, 10000.0)}
OVERRIDES = {
    "Backdoors": {"spkts": (100, 1000), "dpkts": (50, 500), "sbytes": (5000, 50000),
                  "dbytes": (1000, 20000), "ct_srv_src": (50, 200), "ct_srv_dst": (50, 200),
                  "ct_dst_ltm": (100, 500)},
    "Reconnaissance": {"dur": (0.01, 5.0), "spkts": (1, 10), "dpkts": (0, 5), "sbytes": (40, 200),
                       "dbytes": (0, 100), "ct_srv_dst": (100, 500), "ct_dst_sport_ltm": (100, 1000)},
    "Generic": {"dur": (300.0, 3600.0), "sbytes": (100000, 1000000), "dbytes": (1000, 10000),
                "sload": (10000.0, 100000.0), "trans_depth": (10, 50),
                "response_body_len": (10000, 100000)},
}


@pytest.fixture(scope="session")
def flow_table(spark):
    """2,000 flows, 30 % normal, the rest split over three attack categories."""
    from tallyguard.functions import uniform

    kind = uniform(1, "id")
    category = (
        F.when(kind < 0.3, "Normal")
        .when(kind < 0.3 + 0.7 / 3, "Backdoors")
        .when(kind < 0.3 + 1.4 / 3, "Reconnaissance")
        .otherwise("Generic")
    )
    rows = spark.range(2000).withColumn("attack_cat", category)
    for seed, name in enumerate([*INT_RANGES, *DOUBLE_RANGES], start=10):
        base = INT_RANGES.get(name) or DOUBLE_RANGES[name]
        u = uniform(seed, "id")
        value = F.lit(base[0]) + u * (base[1] - base[0])
        for attack, changed in OVERRIDES.items():
            if name in changed:
                low, high = changed[name]
                value = F.when(F.col("attack_cat") == attack, F.lit(low) + u * (high - low)).otherwise(value)
        rows = rows.withColumn(name, F.floor(value).cast("int") if name in INT_RANGES else value)
    return rows.withColumn("label", (F.col("attack_cat") != "Normal").cast("int")).cache()


FLOW_TABLE_FEATURES = (*INT_RANGES, *DOUBLE_RANGES)

assert len(FLOW_COLUMNS) == 44 and set(ANOMALY_FLOW) <= set(FLOW_COLUMNS)
