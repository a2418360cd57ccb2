"""Session helpers: settings every operator relies on, scratch locations, staging."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FEW_ROWS = 100_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app: str = "feedline", shuffle_partitions: int | None = None) -> SparkSession:
    """A session configured the way the library expects (UTC, AQE on, no UI)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings every operator relies on.

    Timestamps are instants rendered and parsed in UTC (naive text is read as
    UTC), so the session time zone must be UTC. A JSON object that repeats a
    key keeps the last value instead of making the whole page unreadable.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and checkpoints.

    Taken from ``spark.checkpoint.dir`` as set by the cluster. Only when it is
    unset on a local master (local runs, tests) a private folder is created
    and registered; on a cluster an unset folder is an error.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="feedline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder name under the checkpoint root (never reused)."""
    return "/".join([checkpoint_root(spark), "feedline", *parts, uuid.uuid4().hex])


def run_scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fixed folder under the checkpoint root for one run's staged data:
    re-running the same run overwrites it instead of leaving copies behind."""
    return "/".join([checkpoint_root(spark), "feedline", *parts])


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty frame that the planner knows to be empty: a join with it moves
    no rows (``createDataFrame([])`` counts as a frame of unknown, huge size)."""
    fields = StructType.fromDDL(schema).fields
    return spark.range(0).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def few(df: DataFrame, rows: int = FEW_ROWS) -> DataFrame:
    """A staged frame, marked for broadcast if it is counted to be small: rows
    that share a few keys then stay where they are instead of meeting in the
    few tasks of those keys."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it ends, not when the driver
    happens to collect its garbage. For writes, whose plans run only once."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def write_packed(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """Write Parquet packed with zstd: payloads and records are text that
    repeats itself. Leaves no shuffle files behind."""
    with shuffles_removed(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def stage_packed(df: DataFrame, path: str) -> DataFrame:
    """:func:`stage` by :func:`write_packed`."""
    write_packed(df, path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder (of :func:`scratch_path`) that nothing reads any
    more; a Spark Connect client leaves it."""
    sc = _context(spark)
    if sc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def stage(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` once to a shared folder and read it back (cuts lineage).

    Used where a frame is consumed by several jobs: the later jobs read the
    written columns (pruned, pushed down) instead of re-parsing the input, and a
    lost executor costs a re-read, not a recomputation of the whole lineage.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)
