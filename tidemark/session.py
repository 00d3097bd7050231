"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Frozen by a query's checkpoint at its first start.
STREAM_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Upload what a batch changed, not the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Sessions are merged before the exchange, so a hot key sends sessions, not events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


# Shuffle files are removed at the end of the query that made them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BATCH_CONF, **STREAM_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session on the same application with the stream settings applied."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in STREAM_CONF.items():
        session.conf.set(key, value)
    return session


def check_streaming(spark: SparkSession) -> None:
    """Raise unless the session has the settings that bound a stream's state and hot keys."""
    wrong = [k for k, v in STREAM_CONF.items() if spark.conf.get(k, None) != v]
    if wrong:
        raise RuntimeError(f"open the stream from build_session or streaming_session; not set: {', '.join(wrong)}")


@contextmanager
def set_for(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster shares through ``spark.checkpoint.dir``.

    Every call returns another folder. Only a local session may fall back to a
    temporary one: on a cluster it would exist on a single machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
