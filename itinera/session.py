"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the call site of every column expression is not needed and slows plan building
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "itinera", **extra: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the one you are given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = {
        **DEFAULTS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": "8",
        **extra,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# The JVM never compiles a method of more bytes than this; Spark lets a generated one grow to 65,535, and that one is then interpreted.
METHOD_LIMIT, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Inside it, a plan whose generated method is too long to be compiled runs operator by operator, in methods that are.

    For wide projections with many rules. Only jobs that run inside it are affected; the session's own value is put back.
    """
    before = spark.conf.get(METHOD_LIMIT, None)
    spark.conf.set(METHOD_LIMIT, METHOD_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(METHOD_LIMIT)
        else:
            spark.conf.set(METHOD_LIMIT, before)


# Folders made for sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset (tests, a laptop) a fresh local folder is made and remembered for the session.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    root = root or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="itinera-ckpt-")
    return _LOCAL_ROOTS[app]


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/itinera/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the checkpoint folder, in the application's own part of it."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def cleanup(spark: SparkSession) -> bool:
    """Remove all that this application stored below the checkpoint folder; call it when no frame of its is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
