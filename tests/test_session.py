"""The shared scratch root: read from the session, created only for local sessions."""

import os
import subprocess
import sys
import tempfile
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
builder = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
if {configured!r}:
    builder = builder.config("spark.checkpoint.dir", {configured!r})
spark = builder.getOrCreate()
from tierlake.session import shared_root, run_dir
a, b = shared_root(spark), shared_root(spark)
print("ROOT", a)
print("SAME", a == b)
print("RUN", run_dir(spark, "x").startswith(a.rstrip("/") + "/tierlake/x-"))
print("CKPT", spark.sparkContext.getCheckpointDir() is not None)
"""


def _run(configured: str) -> dict:
    empty_conf = tempfile.mkdtemp(prefix="tierlake-noconf-")
    env = dict(os.environ, SPARK_CONF_DIR=empty_conf)
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=str(ROOT), configured=configured)],
        env=env, capture_output=True, text=True, timeout=300,
    ).stdout
    return dict(line.split(" ", 1) for line in out.splitlines() if line.split(" ", 1)[0] in {"ROOT", "SAME", "RUN", "CKPT"})


def test_local_session_without_a_checkpoint_dir_gets_its_own():
    got = _run("")
    assert got["SAME"] == "True" and got["RUN"] == "True" and got["CKPT"] == "True"
    assert "tierlake-ckpt-" in got["ROOT"]


def test_configured_checkpoint_dir_is_used_as_is():
    target = tempfile.mkdtemp(prefix="tierlake-shared-")
    got = _run(target)
    assert got["ROOT"] == target and got["SAME"] == "True" and got["RUN"] == "True"
