"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings the operators are written for.  Join and partition sizes stay under
# adaptive execution; nothing here depends on the size of the data.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Per-row vector sums keep one buffer per key; the default of 128 keys
    # would turn every such hash aggregate into a sort.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}

_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; `conf` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in `spark.checkpoint.dir`; where that is unset, the
    SQL warehouse is the folder that driver and executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never reused between runs.

    The application's scratch folder is deleted when its JVM ends.
    """
    root = f"{shared_folder(spark).rstrip('/')}/tidepost-{spark.sparkContext.applicationId}"
    target = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        store.mkdirs(target)
        store.deleteOnExit(target)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


# Where `stored_within` notes what is stored.
_NOTED: ContextVar[list | None] = ContextVar("noted", default=None)


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what runs within are removed as it ends, not when the driver happens to
    collect garbage; not for plans over persisted tables."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)


@contextmanager
def stored_within() -> Iterator[None]:
    """What `materialize` stores within is deleted at the end; for work whose result is written elsewhere."""
    noted = []
    token = _NOTED.set(noted)
    try:
        yield
    finally:
        _NOTED.reset(token)
        for spark, path in noted:
            _delete(spark, path)


def materialize(df, name: str, keep_shuffles: bool = True, **options: str):
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage of a plan that is read several times or whose row order
    must stay fixed; the copy survives the loss of executors.  With `keep_shuffles` off, the
    shuffle files of this one write go with it: see `without_shuffles`.  `options` are the writer's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    noted = _NOTED.get()
    if noted is not None:
        noted.append((spark, path))
    with nullcontext() if keep_shuffles else without_shuffles(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(df) -> None:
    """Delete the files of a stored DataFrame that is not read again; the rest goes when the JVM ends."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        _delete(df.sparkSession, folder)
