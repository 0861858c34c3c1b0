"""Session settings and lineage cutting.

The library never builds its own session on a cluster: callers pass theirs.
``build_session`` exists for tests, the bench and local runs.  Checkpoints go
to the folder the cluster names in ``spark.checkpoint.dir``; a folder is only
chosen here when that setting is unset (local tests).
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes,
# splits skewed shuffle partitions and coalesces small ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, read from the session.

    Uses ``spark.checkpoint.dir`` when the cluster sets it; only when it is
    unset on a local master (tests) a scratch folder is created — on a
    cluster an unset folder is an error, never a machine-local path.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's own setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")  # local runs and tests only
        os.makedirs(configured, exist_ok=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_cleaned: set[str] = set()


def _own_folder(spark: SparkSession, root: str) -> str:
    """Folder of this application's tables, removed when the driver ends."""
    sc = spark.sparkContext
    folder = f"{root}/ledgerlens/{sc.applicationId}"
    if folder not in _cleaned:
        _cleaned.add(folder)
        jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()

        def remove() -> None:
            with contextlib.suppress(Exception):  # the JVM may be gone already
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)

        atexit.register(remove)
    return folder


def materialize(df: DataFrame, name: str = "table", wide: bool = False) -> DataFrame:
    """Cut lineage; the result lives in the shared checkpoint folder.

    * ``wide=False`` (small derived tables: vocabularies, codes, rankings):
      reliable ``checkpoint()`` — cheapest to write, keeps the plan's
      partitioning; Spark removes it when it is no longer referenced.
    * ``wide=True`` (prepared model inputs, wide and large): written as a
      parquet table in the same folder and read back, so later reads prune
      columns and push filters, and its file sizes give the planner real
      statistics for join strategies.  Such tables are removed when the
      driver ends (a plan may read them until then).

    Either survives executor loss (unlike a local checkpoint).
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    if not wide or not root:
        return df.checkpoint(eager=True)
    path = f"{_own_folder(spark, root)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a wide table of :func:`materialize` that no plan reads any more."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over as many partitions as there are cores, or shuffle partitions if these are more: tables that
    every pass of a fit reads again come from few files, and a file's rows are one task's."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def in_one_wave(df: DataFrame, name: str = "dealt") -> DataFrame:
    """``df``, written anew with as many even partitions as there are cores if it has a few more: passes of a fit that
    runs alone would take two waves of tasks, the second on some of the cores.  Few partitions, and four a core or
    more, stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return materialize(df.repartition(cores), name, wide=True) if cores < df.rdd.getNumPartitions() < 4 * cores else df


def bucketed(df: DataFrame, key: str, buckets: int | None = None, name: str = "bucketed") -> DataFrame:
    """``df`` written to the shared folder as a table bucketed and sorted by ``key`` (one file a bucket) and read
    back.  Tables with as many buckets (the shuffle partitions, if not given) are joined and grouped by ``key``
    without a shuffle, as often as they are read; writing shuffles once."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{_own_folder(spark, ensure_checkpoint_dir(spark).rstrip('/'))}/{table}"
    (df.repartition(buckets, key).write.mode("error").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return spark.table(table)
