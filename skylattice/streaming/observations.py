"""Structured Streaming forms of landing, hourly averages and the modal condition.

The original design names a real-time path without defining it; these definitions are ours.
Rows later than ``delay`` behind the newest observation are dropped, and a window is emitted
once, after the watermark has passed its end. State per cell and window is one buffer, as tasks
combine their rows first. Large state needs ``spark.sql.streaming.stateStore.providerClass`` set to
the RocksDB provider (``session.STREAMING``); a backlog needs a bound on the files of a batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skylattice.functions.time import obs_date, obs_hour
from skylattice.operators.conditions import CONDITION, best_condition, exploded
from skylattice.operators.hourly import CELL, by_cell, cell_averages, to_city
from skylattice.schemas import RAW_WITH_CORRUPT, TABLES, Table, to_table
from skylattice.sinks.tables import write_table
from skylattice.sources.raw import json_options, land, parse_documents
from skylattice.sources.tables import FileStore, JdbcStore
from skylattice.storage import delete, exists, mark, staged


#: Files in one batch of a stream, unless the caller says otherwise.
FILES = 1000
#: Batches whose application stays on record. Only the last one can be replayed.
KEPT = 100


def read_raw_stream(
    spark: SparkSession, path: str, fmt: str = "json", schema: str = RAW_WITH_CORRUPT, **options: str
) -> DataFrame:
    """New observation files as a stream, at most ``FILES`` in a batch by default.

    A message source brings texts of its own schema: give those to ``parse_documents``.
    """
    options = {"maxFilesPerTrigger": str(FILES)} | options
    if fmt == "json":
        options = json_options() | options
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def read_document_stream(
    spark: SparkSession, path: str, multiline: bool = False, files: int = FILES
) -> DataFrame:
    """Documents of new text files, ``files`` of them in a batch at most, with their text."""
    reader = spark.readStream.option("maxFilesPerTrigger", files)
    return parse_documents(reader.text(path, wholetext=multiline))


def land_stream(
    spark: SparkSession,
    incoming_path: str,
    raw_path: str,
    checkpoint: str,
    multiline: bool = False,
    files: int = FILES,
) -> StreamingQuery:
    """Land every new JSON file, then stop; start it again for later files.

    A backlog goes in batches of ``files`` files. Documents land once (``sources.raw.land``), also where a
    batch is replayed or a document comes again under another file name.
    """
    documents = read_document_stream(spark, incoming_path, multiline, files)
    return _each_batch(documents, checkpoint, lambda batch, _: land(batch, raw_path))


def into_table(
    df: DataFrame, store: FileStore | JdbcStore, name: str, checkpoint: str, on_conflict: str = "skip"
) -> StreamingQuery:
    """Process all available input into table ``name`` of ``store`` by the checked writes.

    The table stays one that batch jobs read and write as well. A batch that is on record as applied is
    not applied again, and one that was lost before its record is written with ``skip``: rows that it had
    written already stay as they are. The record lies in the checkpoint and goes with it.
    """
    table = TABLES[name]

    def apply(batch: DataFrame, number: int) -> None:
        done = f"{checkpoint}/applied"
        if exists(batch.sparkSession, f"{done}/{number}"):
            batch.write.format("noop").mode("overwrite").save()  # the state of the batch is still to be committed
            return
        with staged(batch) as fresh:
            within = _periods(fresh, table)
            if within is not None:
                write_table(store, fresh, name, on_conflict, within, stored=True)
        mark(batch.sparkSession, f"{done}/{number}")
        delete(batch.sparkSession, f"{done}/{number - KEPT}")

    return _each_batch(to_table(df, table), checkpoint, apply)


def into_hours(
    raw: DataFrame, store: FileStore, checkpoint: str, lots: str, tz: str = "UTC", city: DataFrame | None = None
) -> StreamingQuery:
    """Keep ``weather_hour`` and ``weather_condition_day`` up to date with a stream of observations.

    Every batch is a lot of ``jobs.increment_job``, named ``lots`` and its number: the hour that is still
    running has its averages so far, and observations count however late they come. A replayed batch
    replaces its own sums. Rows are kept for the cities of the store or for those of ``city``.
    """
    from skylattice.plans.jobs import increment_job

    def apply(batch: DataFrame, number: int) -> None:
        with staged(batch) as lot:
            increment_job(lot, store, f"{lots}-{number}", tz, city)

    return _each_batch(raw, checkpoint, apply)


def _periods(rows: DataFrame, table: Table) -> Column | None:
    """A predicate for the table's partitions that ``rows`` fall into; nothing if there are no rows."""
    if not table.partition_by:
        return F.lit(True) if rows.take(1) else None
    found = rows.select(*table.partition_by).distinct().collect()  # the folders that the write makes
    each = (reduce(Column.__and__, (F.col(c) == F.lit(r[c]) for c in table.partition_by)) for r in found)
    return reduce(Column.__or__, each) if found else None


def _each_batch(df: DataFrame, checkpoint: str, apply) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).foreachBatch(apply).start()


def run_available(df: DataFrame, path: str, checkpoint: str, *partition_by: str) -> StreamingQuery:
    """Process all available input into parquet files at ``path``."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start(path)
    )


def _timed(raw: DataFrame, delay: str) -> DataFrame:
    located = by_cell(raw).filter(F.col("lon_c").isNotNull() & F.col("lat_c").isNotNull())
    return located.withColumn("event_time", F.timestamp_seconds("dt")).withWatermark(
        "event_time", delay
    )


def _to_city(closed: DataFrame, city: DataFrame) -> DataFrame:
    """The cities of closed windows, always by a merge.

    The batch that closes windows may have no new rows: Spark then takes them for nothing and would gather all
    that the state emits in the driver to broadcast it. A stream's plan is not corrected by measured sizes either.
    """
    return to_city(closed.hint("merge"), city)


def hourly_stream(raw: DataFrame, city: DataFrame, delay: str = "15 minutes") -> DataFrame:
    """``weather_hour`` rows of closed hours (UTC)."""
    timed = _timed(raw, delay).withColumn("w", F.window("event_time", "1 hour"))
    closed = cell_averages(timed, [*CELL, "w"])
    begun = F.unix_seconds("w.start")
    rows = closed.withColumns({"Date": obs_date(begun), "Hour": obs_hour(begun)})
    return to_table(_to_city(rows, city), TABLES["weather_hour"])


def condition_stream(raw: DataFrame, city: DataFrame, delay: str = "15 minutes") -> DataFrame:
    """``weather_condition_day`` rows of closed days (UTC).

    Two chained aggregates: the counts per condition, then the best of each cell and day. State
    is one count per condition seen in the cell that day, so a busy cell adds no state.
    """
    day = F.window("event_time", "1 day").alias("w")
    counts = (
        exploded(_timed(raw, delay), "event_time")
        .groupBy(*CELL, day, *CONDITION)
        .agg(F.count("*").alias("cnt"))
    )
    closed = best_condition(counts, [*CELL, F.window(F.window_time("w"), "1 day").alias("w")])
    rows = closed.select(
        *CELL,
        obs_date(F.unix_seconds("w.start")).alias("Date"),
        *(F.col(f"best.{c}") for c in CONDITION),
    )
    return to_table(_to_city(rows, city), TABLES["weather_condition_day"])
