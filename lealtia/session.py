"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
WAREHOUSE_KEY = "spark.sql.warehouse.dir"

#: Paths this process has made in the shared folder and not yet removed.
_own_paths: list[str] = []


def build_session(app_name: str = "lealtia", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time and adaptive execution; extra settings by keyword (dots as ``__``)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor reaches: the checkpoint folder, else the warehouse, on every master."""
    folder = (
        spark.conf.get(CHECKPOINT_KEY, None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get(WAREHOUSE_KEY)
    )
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed by ``clear_staged``."""
    path = f"{shared_dir(spark)}/lealtia/{name}-{uuid.uuid4().hex}"
    _own_paths.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop, so that any store works."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
    if path in _own_paths:
        _own_paths.remove(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete the intermediate tables of this process; call it once their results have been used."""
    for path in list(_own_paths):
        remove_path(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Used where several jobs read one expensive result. The table outlives lost executors, prunes
    columns, and gives the optimizer true sizes. The rows are first rebalanced into files of even size,
    so that iterative readers get neither many tiny nor a few huge partitions.
    """
    path = fresh_path(df.sparkSession, name)
    df.hint("rebalance").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
