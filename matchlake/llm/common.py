"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import scratch_dir

#: ASCII white space; every operator's "word" is a maximal run of other characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: What one Arrow batch may hold.  A batch exists several times at once (in the JVM,
#: as Arrow and as Python objects), and texts reach 100 KB and more.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000


def bounded_batches(df: DataFrame) -> None:
    """Lower the size of the session's Arrow batches to the bounds above; smaller
    settings stay."""
    conf = df.sparkSession.conf
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(conf.get(rows)) <= BATCH_ROWS:
        conf.set(rows, str(BATCH_ROWS))
    now = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(size))
    if not 0 < now <= BATCH_BYTES:
        conf.set(size, str(BATCH_BYTES))


def trim() -> None:
    """Gives back to the system what earlier batches of this Python worker took, from Arrow's pool and
    from the C library's heap.  Workers stay for later stages, beside the JVM in an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet (its column names must differ) into the shared checkpoint folder and read it
    back.  Cuts the lineage: a lost executor makes later stages re-read files."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, 'llm-' + uuid.uuid4().hex)}/{name}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def free_name(names: list[str], base: str) -> str:
    """A column name that is not among ``names`` (names compare without case)."""
    taken = {c.lower() for c in names}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def col(name: str) -> Column:
    """A column by its exact name, also if it holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def small(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than one beyond."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows; otherwise
    unmarked, so that the join shuffles (and adaptive execution splits hot keys)."""
    return F.broadcast(df) if small(df, max_rows) else df


def packed(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The columns of ``df`` (all, or those named) as one struct, so that an
    operator's own columns cannot clash with the caller's."""
    names = df.columns if columns is None else columns
    return F.struct(*[col(c) for c in names]) if names else F.struct(F.lit(None).cast("int").alias("none"))


def unpacked(names: list[str], row: str = "row") -> list[Column]:
    """The caller's columns back out of the struct that :func:`packed` made."""
    return [F.col(row).getField(c).alias(c) for c in names]


def keyed(docs: DataFrame, names: list[str], doc_id: str) -> DataFrame:
    """``(row, key)``: the named columns as a struct and a number of the row's own.

    If the ids are whole numbers, distinct and not NULL, they are the keys and
    nothing is stored, so that large rows can be matched with decisions about them
    from a second scan.  Otherwise the rows are stored with a number each.
    """
    row = packed(docs, names).alias("row")
    if dict(docs.dtypes)[doc_id] in ("bigint", "int", "smallint", "tinyint"):
        n = docs.agg(F.count("*").alias("rows"), F.count_distinct(col(doc_id)).alias("ids")).first()
        if n["rows"] == n["ids"]:
            return docs.select(row, col(doc_id).cast("long").alias("key"))
    return stored(docs.select(row, F.monotonically_increasing_id().alias("key")), "keyed")
