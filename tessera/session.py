"""Session helpers: a local session for tests/bench and the shared folder
used for checkpoints and written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "tessera", driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks. Library code never sets a master."""
    parts = 8 if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder on shared storage for checkpoints and written tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one. When it is unset
    a fresh temporary folder serves a local master (tests); any other master
    raises, because executors would write to disks that nobody else reads.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused between runs)."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table through Hadoop, wherever the shared folder is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Spark deletes a query's shuffle files when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Written intermediate tables of one run, below the shared folder.

    ``write`` stores a DataFrame as Parquet (``options`` are the writer's) and
    rereads it, which cuts lineage and survives lost executors; the shuffle
    files behind it go at once; ``drop`` deletes tables that nothing lazy
    still reads. Tables behind a returned (lazy) result stay.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, list[str]] = {}

    def write(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        conf, before = self.spark.conf, self.spark.conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")
        try:
            df.write.options(**options).parquet(path)
        finally:
            conf.set(CLEANUP, before)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            for path in self.paths.pop(name, []):
                delete_path(self.spark, path)
