"""Incremental ingest of newly landed payloads (once per file).

The reference re-runs a batch loader over every file and overwrites the whole
bronze table.  Here a file-source stream with an explicit schema picks up only
files it has not seen (the file log lives in the checkpoint) and flattens them;
each micro-batch is then *merged* into the partitions it touches: the existing
rows of those partitions and the new ones, the latest arrival of each key.  Rows
are never lost because another file of the same month, season or coach arrives
later, whatever the number of files per trigger.

A key may move to another partition (a postponed match).  Its older row then stays
in the old partition, marked as no longer current, so that every touched partition
is rewritten and none has to be deleted; :func:`ingested` reads the current rows.
A batch reads the key columns of the whole table, to find moved keys, and all
columns of the touched partitions only.

``availableNow`` drains what is there and stops, so the job is scheduled like a
batch job.  Spark may run a batch again after a failure; merging it twice gives
the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlake.session import drop_scratch, scratch_dir
from matchlake.sources import raw as rawmod

COACH_BUCKETS = 16


@dataclass(frozen=True)
class Kind:
    flatten: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    part: Callable[[], Column]


KINDS: dict[str, Kind] = {
    "fixtures": Kind(rawmod.bronze_fixture, ("fixture_id",), lambda: F.substring("fixture_date", 1, 7)),
    "fixture-stats": Kind(rawmod.bronze_fixture_stat, ("fixture_id", "team_id"), lambda: F.substring("_date", 1, 7)),
    "standing": Kind(rawmod.bronze_standings, ("league_id", "season", "team_id"), lambda: F.col("season").cast("string")),
    "coach": Kind(rawmod.bronze_coach, ("coach_id", "team_id", "start_date"), lambda: F.pmod(F.xxhash64("coach_id"), F.lit(COACH_BUCKETS)).cast("string")),
}
#: Beside the bronze columns: partition, arrival (time and name of the file, place
#: in it), and whether the row is its key's latest.
OWN = ["_part", "_arrived", "_file", "_current"]


def _flattened(batch: DataFrame, kind: str) -> DataFrame:
    """Bronze rows with the arrival of their file; statistics also with the date of
    their record, which is not among the bronze columns."""
    k = KINDS[kind]
    named = batch.withColumns({"_arrived": F.col("_metadata.file_modification_time"), "_file": F.col("_metadata.file_path"),
                               "_date": F.col("Date") if kind == "fixture-stats" else F.lit(None).cast("string")})
    # a letter before the value: partition folders are text, never read as a number or date
    part = F.concat(F.lit("p"), F.coalesce(k.part(), F.lit("")))
    return k.flatten(named, "_arrived", "_file", "_date").withColumn("_part", part).drop("_date")


def _existing(spark: SparkSession, out: str) -> DataFrame | None:
    try:
        return spark.read.parquet(out)
    except AnalysisException:
        return None


def _merged(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row for each key and partition, the latest; ``_current`` marks the latest
    of all; a row that moved away stays so.  Rows with a NULL in their key are told apart by all columns."""
    values = [c for c in rows.columns if c not in OWN]
    unknown = F.when(F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)), F.xxhash64(*values)).otherwise(0)
    rows = rows.withColumn("_same", unknown)
    late = [F.col(c).desc() for c in ("_arrived", "_file")] + [F.xxhash64(*values).desc()]
    within = Window.partitionBy(*keys, "_same", "_part").orderBy(*late)
    across = Window.partitionBy(*keys, "_same").orderBy(*late)
    # the wider window first: its rows are already together for the narrower one, which shuffles nothing
    return rows.withColumn("_of_all", F.row_number().over(across)).withColumn("_nth", F.row_number().over(within)) \
        .filter("_nth = 1").withColumn("_current", F.col("_current") & (F.col("_of_all") == 1)).select(*values, *OWN)


def _merge(spark: SparkSession, new: DataFrame, keys: tuple[str, ...], out: str, log: str | None = None) -> None:
    scratch = scratch_dir(spark, f"ingest-{uuid.uuid4().hex}")
    new.withColumn("_current", F.lit(True)).write.parquet(f"{scratch}/new")
    rows = spark.read.parquet(f"{scratch}/new")
    old = _existing(spark, out)
    if old is not None:
        moved = old.select(*keys, "_part").join(rows.select(*keys).distinct(), list(keys), "left_semi").select("_part")
        touched = [r[0] for r in moved.union(rows.select("_part")).distinct().collect()]  # months, seasons or buckets
        rows = rows.unionByName(old.filter(F.col("_part").isin(touched)).select(*rows.columns))
    _merged(rows, keys).write.parquet(f"{scratch}/merged")  # the partitions are read before they are replaced
    (spark.read.parquet(f"{scratch}/merged").hint("rebalance", "_part").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(out))
    if log:  # last, so that whoever reads these keys finds their rows in the table
        spark.read.parquet(f"{scratch}/new").select(*keys).distinct().write.mode("overwrite").parquet(log)
    drop_scratch(spark, scratch)


def ingested(spark: SparkSession, out: str) -> DataFrame:
    """The current bronze rows of an ingested table."""
    return _existing(spark, out).filter("_current").drop(*OWN)


def ingest_new(spark: SparkSession, source: str, kind: str, out: str, checkpoint: str,
               max_files_per_trigger: int | None = None, changes: str | None = None) -> int:
    """Merge every not-yet-seen file under ``source`` into the table at ``out``;
    returns the number of micro-batches run.  With ``changes``, a batch leaves the keys it merged
    in a folder named by its number there (a batch that runs again writes the same folder)."""
    reader = (spark.readStream.schema(rawmod.SCHEMAS[kind]).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", rawmod.CORRUPT))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = _flattened(reader.json(source), kind)
    batches = []

    def write_batch(batch: DataFrame, epoch: int) -> None:
        _merge(spark, batch, KINDS[kind].keys, out, f"{changes}/{epoch:012d}" if changes else None)
        batches.append(epoch)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)
