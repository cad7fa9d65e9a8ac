"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import hashlib
import io
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tierlake", extra: dict | None = None
) -> SparkSession:
    """Session for tests and the bench. On a cluster callers bring their own.
    ``extra`` adds configs (e.g. an event log in a scratch folder)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir).
    Only a local-mode session without one gets its own folder; a cluster session
    without one is an error, since a machine-local folder is invisible to executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = current.rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running lake jobs")
        # Core configs cannot be set at runtime; the context's checkpoint dir is
        # what later calls read back (its parent is the root).
        root = tempfile.mkdtemp(prefix="tierlake-ckpt-")
        sc.setCheckpointDir(root)
        return sc.getCheckpointDir().rsplit("/", 1)[0]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared root, one per run, never reused."""
    root = shared_root(spark).rstrip("/")
    return f"{root}/tierlake/{label}-{uuid.uuid4().hex[:12]}"


#: Leaves that one task of a partitioned write holds open; rows of more are sorted.
OPEN_LEAVES = 32
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_WRITING: dict[str, int] = {}
_WRITE_LOCK = threading.Lock()


@contextmanager
def unsorted_leaves(spark: SparkSession) -> Iterator[None]:
    """Within it, a task of a partitioned write has a file open for each leaf its rows belong
    to. By default Spark sorts all rows of the task by leaf first, in its memory, to have one
    file open at a time. A setting of the session's own stays."""
    app = spark.sparkContext.applicationId
    with _WRITE_LOCK:
        own = not _WRITING.get(app) and spark.conf.get(_WRITERS, "0") != "0"
        if not own:
            _WRITING[app] = _WRITING.get(app, 0) + 1
            spark.conf.set(_WRITERS, str(OPEN_LEAVES))
    try:
        yield
    finally:
        if not own:
            with _WRITE_LOCK:
                _WRITING[app] -= 1
                if not _WRITING[app]:
                    spark.conf.unset(_WRITERS)


#: Bytes of rows after which a task's batch goes to its Python worker.
BATCH_BYTES = 1 << 22
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCHING: dict[str, int] = {}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, what runs sends its Python workers rows of about ``BATCH_BYTES`` at a time,
    or one row that is larger. By default these are 64 MB, which each task of
    an executor holds outside its heap. A setting of the session's own stays."""
    app = spark.sparkContext.applicationId
    with _WRITE_LOCK:
        own = not _BATCHING.get(app) and spark.conf.get(_BATCH, None) is not None
        if not own:
            _BATCHING[app] = _BATCHING.get(app, 0) + 1
            spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        if not own:
            with _WRITE_LOCK:
                _BATCHING[app] -= 1
                if not _BATCHING[app]:
                    spark.conf.unset(_BATCH)


def to_local(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in tests."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def _package_zip() -> bytes:
    root = Path(__file__).resolve().parent
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for f in sorted(root.rglob("*.py")):
            zf.write(f, f"{root.name}/{f.relative_to(root)}")
    return buf.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (the zip source and the
    pandas-batch writers run there): zip it once per application into the shared
    folder and ``addPyFile`` it, as ``--py-files`` would."""
    sc = spark.sparkContext
    with _SHIP_LOCK:
        if sc.applicationId in _SHIPPED:
            return
        data = _package_zip()
        digest = hashlib.sha1(data).hexdigest()[:12]
        path = f"{shared_root(spark).rstrip('/')}/tierlake/_code/tierlake-{digest}.zip"
        jvm = sc._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(jpath):
            out = fs.create(jpath, True)
            try:
                out.write(bytearray(data))
            finally:
                out.close()
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)


__all__ = ["local_session", "ship_package", "shared_root", "run_dir", "to_local", "small_batches", "unsorted_leaves"]
