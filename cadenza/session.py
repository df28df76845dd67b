"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job needs for correct and comparable results.  Everything else
# (memory, executors, shuffle service) belongs to the cluster deployment.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files are removed once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cadenza", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the base settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is.  Only when the
    session has none (a local test run) is a scratch folder created.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS / object store) "
                               "for checkpoints and intermediate tables")
        configured = tempfile.mkdtemp(prefix="cadenza-ckpt-")      # local test runs only
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df, tag: str = "cut"):
    """Cut the lineage by writing ``df`` as a parquet table into the shared
    checkpoint folder and reading it back.

    A written table survives executor loss like a reliable checkpoint, but is
    written once (a reliable RDD checkpoint computes its input twice unless it
    is cached), columnar and compressed, and later reads prune columns.
    """
    import uuid
    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/tables/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._cut_path = path
    return out


def discard(df) -> None:
    """Delete the table behind a ``cut_lineage`` result, once nothing will read it again."""
    path = df.__dict__.pop("_cut_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def tasks_for(rows: int, each: int = 500_000) -> int:
    """Partitions of at most about ``each`` rows: named in ``repartition``, adaptive execution does not merge them."""
    return max(1, -(-rows // each))


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # pragma: no cover - connect sessions
        return int(os.environ.get("BENCH_CPUS", "8"))
