"""Session creation and lineage cutting.

Stage tables are written as Parquet below the shared folder the cluster names in
``spark.checkpoint.dir``. A private folder is only
chosen when nothing is configured and Spark runs in local mode (tests).
"""

from __future__ import annotations

import contextlib
import io
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size coalesced partitions by the advisory size (64 MB), not by core count
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Broadcast only on *measured* sizes: no static broadcast from plan estimates
    # (an exploded interval side is estimated at its input size), AQE converts a
    # join to broadcast when the runtime shuffle output of a side is below 32 MB.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "pavespark") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; stage tables need a shared folder on the cluster")
    path = tempfile.mkdtemp(prefix="pavespark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Removes what ``written`` wrote inside, at the end; scopes nest."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on the file system it lies on."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table below the shared checkpoint folder and read it back.

    Readers keep column pruning, filter pushdown and file statistics, which a checkpoint
    loses. Rows may come back in other partitions. The files stay until the innermost
    ``scratch`` scope ends, or else until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Cut lineage: write the stage and continue from the written copy, which survives the
    loss of executors. ``enabled=False`` leaves the stage lazy."""
    return written(df) if enabled else df


def growing(df: DataFrame) -> DataFrame:
    """``df`` as a join side that grows with the input: the join shuffles both sides by its keys,
    whatever the session's broadcast threshold. The planner knows a table's files, not its rows:
    compressed files or pruned columns of less than the threshold can be millions of rows,
    which would all pass through the driver."""
    return df.hint("merge")


def plan_text(df: DataFrame, mode: str = "extended") -> str:
    """The text ``df.explain(mode)`` prints (physical plan included)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
