"""Session settings and the shared folder that staged data is written to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants; sizes that depend on the cluster stay with the submitter.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Get a session with :data:`DEFAULTS`; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting uses a folder of its warehouse; a cluster session must name
    one, since a machine's own folder is lost with the machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staging"
        context.setCheckpointDir(root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """Unused path below :func:`shared_root`, in a folder per application.

    An application's folder may be deleted when the application is done.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/tidemill/{application}/{label}-{uuid.uuid4().hex}"


# Lists of the tables staged in the scopes that are open, innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside the block at its end, but for those staged to ``keep``.

    What the block hands out must not read them any more: it is staged itself, or a number.
    """
    own: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), own))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in own:
            remove(spark, path)


def stage(
    df: DataFrame, label: str, together: str | None = None, keep: bool = False, split: str | None = None
) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used where one costly result feeds several branches: it is computed once, survives the loss
    of executors, and gives the later joins true sizes to plan with. Rows with equal values of the
    column ``together`` go to the same file, unless they are too many for one; each value of ``split``, of which there must be few in a task,
    has files of its own, and a reader of one value opens only these. Inside
    :func:`scratch` the table goes when the block ends; with ``keep`` it belongs to the block around that.
    """
    path = new_folder(df.sparkSession, label)
    scopes = _SCOPES.get()[: -1 if keep else None]
    if scopes:
        scopes[-1].append(path)
    rows = df.hint("rebalance", together) if together else df
    (rows.write.partitionBy(split) if split else rows.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark writes to; nothing happens where there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
