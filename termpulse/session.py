"""Session settings, shared staging folder and input spreading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def make_session(app: str = "termpulse", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # call sites of every column expression are costly to record in large plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.parquet.compression.codec", "zstd")
        # most (date, term) keys are rare, so a small first-level map in front only costs time
        .config("spark.sql.codegen.aggregate.map.twolevel.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Local sessions without the setting (tests) get a temporary folder; a cluster
    session without it is an error, since a machine-local folder would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="termpulse-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, lets later passes prune columns, and gives the optimizer real
    sizes, so it broadcasts a side only when the files are small enough.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def unstage(*staged: DataFrame) -> None:
    """Delete frames of ``stage`` that no later plan reads."""
    for df in staged:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def stage_buckets(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """``stage`` in as many buckets of ``keys`` as there are shuffle partitions, for rows that are dealt by these keys.

    Each task then writes one file, and joins and groups on the keys read the files in place, without another exchange.
    Only the plan knows the table: its entry in the catalog is dropped at once.
    """
    spark, table = df.sparkSession, f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.option("compression", "snappy").option("path", f"{shared_dir(spark)}/{table}")
    writer.bucketBy(n, *keys).sortBy(*keys).saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return found


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition by ``keys`` only when the scan has fewer splits than the cluster has cores.

    A large table already has many splits and is returned as it is, without a shuffle.
    """
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= parallelism:
        return df
    return df.repartition(parallelism, *keys)
