"""Session setup and lineage cuts that survive executor loss."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings this library relies on. They fill gaps only: a value set by the cluster (spark-defaults,
# submit options) or passed in ``conf`` wins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app: str = "candela", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with AQE (partition coalescing, skew-join splitting) on and the web UI off.

    Shuffle width is left to the cluster: with AQE, set ``spark.sql.shuffle.partitions`` (or
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``) high enough that the widest shuffle —
    line items per order key in the bars adapter — stays near ``advisoryPartitionSizeInBytes`` per task;
    AQE merges the small post-aggregation shuffles back down.
    """
    conf = dict(conf or {})
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    cluster = spark.sparkContext.getConf()
    for key, value in DEFAULT_CONF.items():
        if key not in conf and not cluster.contains(key):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. ``fallback`` is used (and set on the session)
    only when the setting is absent, as in local tests."""
    value = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not value:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder as fallback")
        spark.conf.set("spark.checkpoint.dir", fallback)
        value = fallback
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(value)
    return value


def shared_path(spark: SparkSession, name: str, fallback_dir: str | None = None) -> str:
    """A fresh path below the checkpoint folder, deleted when the application ends. Where the setting is absent, a
    temporary folder takes its place, on a local master only."""
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    if unset and fallback_dir is None and spark.sparkContext.master.startswith("local["):
        fallback_dir = tempfile.mkdtemp(prefix="candela-")
    path = f"{checkpoint_dir(spark, fallback_dir).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialize(df: DataFrame, name: str = "table", fallback_dir: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back, cutting the lineage.

    Unlike caching, the written table outlives lost executors: a later stage that loses a task re-reads
    the files instead of recomputing the whole input. The table is deleted when the application ends.
    """
    path = shared_path(df.sparkSession, name, fallback_dir)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
