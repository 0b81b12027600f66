import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("lograft-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lograft-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder."""
    import uuid

    root = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    path = f"{root}/t-{uuid.uuid4().hex}"
    os.makedirs(path, exist_ok=True)
    return path


def java_hash(s: str) -> int:
    """Reference Java String.hashCode: fold UTF-16 code units in base 31."""
    import struct

    b = s.encode("utf-16-le")
    h = 0
    for u in struct.unpack(f"<{len(b) // 2}H", b):
        h = (31 * h + u) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h
