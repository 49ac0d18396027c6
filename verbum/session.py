"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "verbum",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or return) a session with the settings this library relies on.

    On a cluster the master and most resources come from spark-submit; the
    options below only pin behaviour that changes results or plans.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          # windows-1251 fallback decoding of legacy corpora
          .config("spark.sql.legacy.javaCharsets", "true"))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        b = b.config("spark.driver.memory", os.environ.get("VERBUM_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or one already set on the
    context).  Only when neither is set and the master is local, as in tests,
    a private folder is created; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="verbum-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def written(df: DataFrame) -> DataFrame:
    """``df`` as compressed Parquet in the shared checkpoint folder, read back:
    lineage ends here at a fraction of a checkpoint's bytes.  A table that this
    function returned is not written again."""
    if getattr(df, "_written_to", None):
        return df
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that no later plan reads."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def let_go(spark: SparkSession) -> None:
    """Delete the shuffle files of ended plans: Spark does so when the driver's
    garbage is collected, which a nearly empty driver seldom needs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
