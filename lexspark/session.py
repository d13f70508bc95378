"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "lexspark", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the one named in spark.checkpoint.dir, else (tests only) a temporary one."""
    d = spark.conf.get(CHECKPOINT_CONF, None)
    sc = spark.sparkContext
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="lexspark-")
        spark.conf.set(CHECKPOINT_CONF, d)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


_written: list[str] = []


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df to the shared folder as Parquet and read it back: cuts lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def drop(*frames: DataFrame) -> None:
    """Delete the tables behind frames that written() returned, once nothing is read from them any more."""
    for df in frames:
        _written.remove(df.written_path)
        _delete(df.sparkSession, df.written_path)


def drop_written(spark: SparkSession) -> int:
    """Delete the tables that written() made in this process; call it once no frame built on them is needed. Returns how
    many there were."""
    n = len(_written)
    while _written:
        _delete(spark, _written.pop())
    return n


def tasks_for(spark: SparkSession, rows: int, each: int) -> int:
    """How many tasks to shuffle rows into so that none gets much more than each of them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))
