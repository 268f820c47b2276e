"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of marks at most, of 64 bits each.
SLOTS = 1 << 18
#: With this setting, the shuffle files of a query go when it ends, not whenever the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths that ``settled`` drops.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only
    where that is unset, as in tests, a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, *by: str) -> DataFrame:
    """``df`` written to a path and read back; the shuffle files that it took are dropped, since nothing reads them again."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written to the shared folder, in folders ``by`` some columns, and read back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return written(df, path, *by)


def drop_stored(df: DataFrame) -> None:
    """Drops the files of a ``stored`` table that nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        drop_path(df.sparkSession, folder)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` gives, stored; all that is stored on the way there is dropped, also if it fails."""
    passing: list[str] = []
    around = _passing.set(passing)
    try:
        df = make()
        _passing.reset(around)
        return stored(df, name)
    finally:
        if _passing.get() is passing:
            _passing.reset(around)
        for path in passing:
            drop_path(SparkSession.active(), path)


def drop_path(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def _spot(keys: tuple) -> tuple[Column, Column]:
    """Slot of a key, and its bit there."""
    own = F.xxhash64(*keys)
    return F.pmod(own, F.lit(SLOTS)), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(own, 32), F.lit(64)).cast("int"))


def key_marks(df: DataFrame, *keys: str | Column) -> DataFrame:
    """``__slot, __mask``: a bit for each key of ``df``, in SLOTS rows at most however many keys there are."""
    slot, bit = _spot(keys)
    return df.select(slot.alias("__slot"), bit.alias("__bit")).groupBy("__slot").agg(F.bit_or("__bit").alias("__mask"))


def may_hold(df: DataFrame, marks: DataFrame, *keys: str | Column, without: bool = False) -> DataFrame:
    """The rows of ``df`` whose key may be a marked one (all that are, and few others), or those ``without`` a mark; no row is moved.

    Keys are of the same types as those of the marks; nulls are equal.
    """
    slot, bit = _spot(keys)
    return df.join(F.broadcast(marks), (slot == F.col("__slot")) & (F.col("__mask").bitwiseAND(bit) != 0), "left_anti" if without else "left_semi")


def short_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Lets at most ``rows`` rows or ``size`` bytes of whole texts pass to Python at once; smaller settings stay."""
    for setting, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(setting).lower().rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(setting, most)


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def free_name(taken: Iterable[str], wish: str) -> str:
    """``wish``, with underscores appended until no column has that name (case ignored, as Spark does)."""
    low = {c.lower() for c in taken}
    while wish.lower() in low:
        wish += "_"
    return wish
