"""Session and scratch-space helpers.

On a cluster the shared checkpoint folder comes from ``spark.checkpoint.dir``;
we only set our own when it is unset (local runs, tests)."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20
TARGET_PARTITION_BYTES = 256 * MB


def cluster_conf(input_bytes: int, executors: int = 1000, cores_per_executor: int = 4,
                 partition_bytes: int = TARGET_PARTITION_BYTES) -> dict:
    """Settings sized from the input, so that scan splits and shuffle
    partitions stay near ``partition_bytes`` and fit executor memory.

    * scan splits of ``partition_bytes`` (``maxPartitionBytes``);
    * initial shuffle partitions = input / partition size, at least two waves
      of the cluster's cores; AQE then coalesces small ones toward the
      advisory size and splits skewed join partitions (5x median and over
      the advisory size);
    * broadcast stays at the default 10 MB, measured at run time by AQE."""
    cores = max(1, executors * cores_per_executor)
    shuffle = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }


def get_spark(master: str | None = None, app: str = "textrec",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not conf_dir:
        # Only in local mode, where driver and tasks share one machine.
        conf_dir = tempfile.mkdtemp(prefix="textrec-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/textrec-tables/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str, partition_by=(), with_count: bool = False):
    """Cut the lineage of a frame that several branches reuse: write it once
    as Parquet under the shared checkpoint folder and read it back.  Reads
    then prune columns, and a lost executor re-reads the table instead of
    recomputing the whole upstream plan.  With ``with_count`` the row count
    is observed while writing (no second job) and returned as well."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"{name}-rows") if with_count else None
    if obs is not None:
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    out = spark.read.parquet(path)
    out._scratch = path
    return (out, obs.get["rows"]) if obs is not None else out


def discard(*frames) -> None:
    """Remove the tables that ``materialize`` wrote for these frames, once
    nothing reads them any more.  Frames of other kinds are left alone."""
    for df in frames:
        path = getattr(df, "_scratch", None)
        if path is not None:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
            df._scratch = None


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so that Python
    tasks can import it whatever their working folder or PYTHONPATH is."""
    sc = spark.sparkContext
    if getattr(sc, "_textrec_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="textrec-"), "textrec-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("textrec", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._textrec_shipped = True
