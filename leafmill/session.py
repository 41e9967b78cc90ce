"""Sessions, the shared folder, and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is only ever hinted for broadcast below this many rows times columns' widths.
BROADCAST_BYTES = 32 << 20
_scratch: set[str] = set()


def get_spark(app: str = "leafmill", master: str = "local[*]", partitions: int = 8) -> SparkSession:
    """A session for local use; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or, where that is unset and all run on this machine (tests), a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="leafmill-")
        atexit.register(shutil.rmtree, own, True)
        found = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: lineage is cut and an executor's loss costs nothing already written."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, below one folder of this application's, which `clean` or the end of the driver removes."""
    base = f"{shared_dir(spark)}/leafmill-{spark.sparkContext.applicationId}"
    if base not in _scratch:
        _scratch.add(base)
        atexit.register(_remove, spark, base)
    return f"{base}/{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Removes what this application has written to the shared folder; frames that read it are of no use afterwards."""
    for base in list(_scratch):
        _remove(spark, base)


def _remove(spark: SparkSession, base: str) -> None:
    if base in _scratch and spark.sparkContext._jsc is not None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _scratch.discard(base)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after counting that the rows fit; else leave the join to a shuffle."""
    at_most = limit // max(1, row_bytes)
    return F.broadcast(df) if df.limit(at_most + 1).count() <= at_most else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
