"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space, tab and the line breaks 0A-0D.
WORD = r"[^\x20\x09-\x0D]+"

_LOCAL: dict[str, str] = {}


def lean(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, whose worker gives back the memory it freed when a task ends: workers stay, and what they
    keep stands beside the executor's own memory in the stages that follow."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def give_back() -> None:
    """Freed memory of this process goes back to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table as Spark reads it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` as the session
    names it (the URI is kept).  Only a local session without the setting gets
    a folder of its own; any other master must name one."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not (sc.master.startswith("local[") or sc.master == "local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _LOCAL:
        _LOCAL[sc.applicationId] = "file:" + tempfile.mkdtemp(prefix="quarry-llm-")
    return _LOCAL[sc.applicationId]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/quarry-llm/{name}-{uuid.uuid4().hex}"


#: Spark's setting by which a finished query's shuffle files go at once, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: what follows no
    longer depends on the executors that computed it, and it is computed once.
    The shuffle files of the write are not kept."""
    spark = df.sparkSession
    path, before = scratch(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


#: Rows up to which a table may be broadcast: of a few columns, and of one column of longs (8 MB).
BROADCAST_ROWS, BROADCAST_KEYS = 50_000, 1_000_000


def small(df: DataFrame, name: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, written once and marked for broadcast if it has at most ``rows``
    rows; beyond that Spark joins by shuffle and splits skew."""
    kept = saved(df, name)
    return F.broadcast(kept) if kept.count() <= rows else kept


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column of ``taken`` has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def shuffle_key(doc_id: Column, seed: int) -> Column:
    """A pseudo-random number of 60 bits from the id alone, so that reruns and
    SQL agree: the first 15 hex digits of md5('<id>:<seed>')."""
    salted = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(salted), 1, 15), 16, 10).cast("long")


SHUFFLE_KEY_SQL = "('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{seed}'), 1, 15))::BIGINT"
