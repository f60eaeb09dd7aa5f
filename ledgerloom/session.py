"""Session settings.  Only runtime SQL settings are touched, so a cluster session can be passed in."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits hot join partitions; "force" lets it do so even when the
# split costs one more shuffle, because a hot key may hold a large share of the rows.  Rows that lie by a
# part of a join's keys stay where they are, so that joins of line, shipment and distribution shuffle each once.
# Sizes of file splits and of shuffle partitions bound what a task holds, whatever the tables hold.  Shuffle files go when
# the action that wrote them ends, so that a report that writes intermediates holds the disk of one step only.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", app: str = "ledgerloom", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; on a local master (tests) a private one where none is set.

    On a cluster a folder of one machine is of no use to the others, so a missing setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not named and not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = named or tempfile.mkdtemp(prefix="ledgerloom-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_scratch: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediates that are written inside the block are dropped at its end, also after an error.

    Build, write and leave: what is still to be read of a report must be read inside the block.  Blocks may be nested; each
    drops its own.  Outside of a block intermediates stay in the checkpoint folder, whose owner clears it.
    """
    from ledgerloom.sources.sinks import Folder

    folder = f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        Folder(spark, folder).delete()


def home(spark: SparkSession) -> str:
    """The folder that intermediates are written to at this point: that of the ``scratch`` block, or the checkpoint folder."""
    return _scratch.get() or ensure_checkpoint_dir(spark)


def cut(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write an intermediate result once to the shared checkpoint folder and read it back.

    For results that several branches of a plan use and that cost many joins to build.  The copy is
    columnar, so each branch reads its own columns only, and it outlives lost executors.  It is dropped at the end of the
    ``scratch`` block it is made in, or of the one that ``folder`` belongs to.
    """
    path = os.path.join(folder or home(df.sparkSession), f"cut-{uuid.uuid4().hex}")
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def step(spark: SparkSession, build: Callable[[], DataFrame | tuple[DataFrame, ...]]) -> DataFrame | tuple[DataFrame, ...]:
    """What ``build`` returns, a frame or some, written as by ``cut``; the intermediates that it makes on the way are dropped at once.

    A report built in steps holds the shuffle files of one step and the columnar results of those before it, not the shuffle
    files of the whole plan.
    """
    folder = home(spark)
    with scratch(spark):
        made = build()
        return tuple(cut(df, folder) for df in made) if isinstance(made, tuple) else cut(made, folder)
