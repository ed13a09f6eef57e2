"""Session settings and the shared folder for checkpoints and cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the library relies on. Everything else is left to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("touchline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without: there a temporary folder is set once. On a
    cluster a missing setting is an error, since a folder on the driver's disk is not
    visible to the executors.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="touchline-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    Cuts the lineage, so that work used several times is done once, with files that
    outlive the executors that wrote them. ``options`` are the writer's.
    """
    path = fresh_dir(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a plain scan over all cores if it has fewer splits than the cluster has cores.

    For work that is heavy per row, over a few unsplittable files. A scan of many splits
    is returned as it is. Not for frames with joins or aggregates.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


class Scratch:
    """A job's own folder below the shared folder, removed when the job ends.

    Written tables cut the lineage: they outlive the executors that wrote them. What
    the job returns goes to ``publish``, which stays for the cluster's own cleanup.
    ``options`` are the writer's, for all tables of the folder.
    """

    def __init__(self, spark: SparkSession, purpose: str, **options: str):
        self.spark = spark
        self.purpose = purpose
        self.options = options
        self.root = fresh_dir(spark, purpose)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame into the folder and read it back."""
        df.write.options(**self.options).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more, and the shuffle files behind them.

        Spark deletes a shuffle's files once the driver has collected the plan that made
        them, which a driver with memory to spare puts off; so it is asked to collect now.
        """
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for name in names:
            files.delete(path(self.path(name)), True)
        gc.collect()
        self.spark._jvm.System.gc()

    def publish(self, df: DataFrame) -> DataFrame:
        """Write a frame to a folder that outlives this one and read it back."""
        return materialise(df, self.purpose, **self.options)
