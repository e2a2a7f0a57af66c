"""Session settings: reliable checkpoint folder and scratch folders below it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# The JVM never compiles a method above this many bytes of code. A generated method that is larger,
# as decoding many columns makes it, runs faster split into projections.
JIT_LIMIT = "8000"
JIT_CONF = "spark.sql.codegen.hugeMethodLimit"


def local_session(app: str = "dictspark", cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config(JIT_CONF, JIT_LIMIT)
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def compile_small(spark: SparkSession) -> None:
    """Lower the limit of generated methods to :data:`JIT_LIMIT`, unless the session already has a lower one.

    Encoding or decoding a row of many cells makes one generated method that Spark's own limit of 65,535 bytes still takes, but that the
    JVM then interprets for every row.
    """
    if int(spark.conf.get(JIT_CONF)) > int(JIT_LIMIT):
        spark.conf.set(JIT_CONF, JIT_LIMIT)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a machine-local
    folder would lose data with its machine, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="dictspark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def work_dir(spark: SparkSession, label: str) -> str:
    """A new scratch path in the shared folder; never reused, never cleared."""
    return f"{shared_dir(spark).rstrip('/')}/dictspark-work/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written rows.

    A parquet table rather than an RDD checkpoint: later joins see its real size, so Catalyst
    decides on a broadcast from a measured figure, and lost executors re-read it.
    """
    path = work_dir(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
