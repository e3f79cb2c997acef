"""Session helpers: a default builder and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tabwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    On a cluster the master, memory and shuffle partition count come from
    ``spark-submit``; only settings that change results or plan quality are set here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        # the split table has four partitions: write them side by side instead of sorting rows first
        .config("spark.sql.maxConcurrentOutputFileWriters", "16")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only when neither that setting nor an
    explicit checkpoint folder exists (local tests) is a temporary folder made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tabwright-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(made)
    return made


_lock = threading.Lock()
_open: dict[tuple, list] = {}  # (session, name): [how many hold it, the value before]


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the jobs of one step; threads may hold it together, the last one puts the old value back."""
    with _lock:
        held = _open.setdefault((id(spark), name), [0, None])
        if not held[0]:
            held[1] = spark.conf.get(name, None)
            spark.conf.set(name, value)
        held[0] += 1
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                del _open[id(spark), name]
                spark.conf.unset(name) if held[1] is None else spark.conf.set(name, held[1])


def ensure_checkpointing(spark: SparkSession) -> None:
    """Make sure iterative estimators (boosting) can cut their lineage."""
    folder = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back from there."""
    ensure_checkpointing(df.sparkSession)
    return df.checkpoint(eager=True)
