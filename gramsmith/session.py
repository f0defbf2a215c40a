"""What every operator needs of the session: tables, checkpoints, size checks.

Nothing here starts a session of its own or changes its settings, but for the
checkpoint folder where none is named.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast or handed to the workers. A row of
#: the tables meant here takes some hundred bytes at most.
SMALL_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends the package to executors which can't import it from the driver's disk."""
    sc = spark.sparkContext
    if sc.master.startswith(("local[", "local")) and "cluster" not in sc.master:
        return
    if getattr(sc, "_gramsmith_sent", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="gramsmith-")) / "gramsmith.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, Path("gramsmith") / path.relative_to(root))
    sc.addPyFile(str(target))
    sc._gramsmith_sent = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is named."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("name a shared folder in spark.checkpoint.dir")
        named = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialises in the shared checkpoint folder, so that lost executors cost no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Writes a table to the shared checkpoint folder and reads it back, column by column as needed.

    The table goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deals rows to all cores where the scan has fewer splits than half the cores.

    With keys by their hash, which saves the sort of a round robin and a later
    exchange on them; the keys must be many.

    Only an input of a few small files is affected: a large one has more splits
    than cores and passes unchanged, without a shuffle. Meant for scans: the
    splits of a plan with shuffles are known only once it has run.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() * 2 <= cores else df


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Deals few but CPU-heavy rows of a plan with shuffles to all cores, by the hash of keys that are many.

    Adaptive execution joins small partitions into one task, which would do all
    of the work that Python has with them. Spark drops a repartition by keys that
    are those of the exchange before it, but not one by their hash.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), F.xxhash64(*keys))


def small_rows(df: DataFrame, columns: Iterable[str], limit: int = SMALL_ROWS) -> list | None:
    """The rows of a side if there are at most ``limit``, else None.

    At most ``limit + 1`` rows come to the driver, whatever the size of the side.
    """
    rows = df.select(*columns).limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def broadcast_if_small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Hints a broadcast only when a count shows that the side is small; else Spark joins by shuffle."""
    few = df.limit(limit + 1).count() <= limit
    return F.broadcast(df) if few else df


def free_name(taken: Iterable[str], wanted: str) -> str:
    """A column name that no column of the input has, case apart."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted += "_"
    return wanted
