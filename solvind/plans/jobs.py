"""Jobs a scheduler submits (`python -m solvind <job>`, see `solvind/__main__.py`)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from solvind.functions.calendar import add_time_parts, is_plausible
from solvind.operators.append import append_new
from solvind.operators.compaction import GRACE_SECONDS, TARGET_BYTES, compact, read_landed
from solvind.operators.dedup import dedup
from solvind.operators.layout import stage, write_table
from solvind.operators.merge import merge_latest
from solvind.operators.messages import CORRUPT
from solvind.operators.normalise import city_from_topic, normalise, union_sources, unwrap_envelope
from solvind.operators.pruning import value_counts
from solvind.operators.quality import require_fields, require_rows
from solvind.operators.retention import cutoff_day, drop_expired, expire_folders
from solvind.plans.gold import write_gold
from solvind.plans.refresh import only_touched, refresh_gold, touched_months, within_months
from solvind.schemas import ENVELOPE, HISTORY_PARTITIONS, HISTORY_TABLE, LANDING_STREAM, SILVER
from solvind.sources import message_source, read_json_history, read_landing, read_table
from solvind.sources.tables import load_or_empty
from solvind.streaming.ingest import landing_rows, quarantine_rows, start_ingest
from solvind.streaming.ledger import once_per_batch, stream_id
from solvind.workspace import staging

LANDING_KINDS = ("json", "avro", "stream")
# Layout of a Silver table that is updated month by month.
SILVER_BY_MONTH = ("city", "year", "month")


def landing_as_history(
    spark: SparkSession,
    path: str,
    kind: str,
    city: str | None = None,
    temp_unit: str = "C",
    since: dt.date | None = None,
) -> DataFrame:
    """Adapter from either landing shape to history columns. `kind`: `json` or `avro` for envelopes,
    `stream` for the landing table of the message stream.

    `since` skips landing data that arrived on earlier days: whole partitions of the stream table, whole
    files of envelopes. Without it every run reads all retained landing data.
    """
    if kind not in LANDING_KINDS:
        raise ValueError(f"unknown landing kind: {kind}")
    if kind == "stream":
        # The sink's log may still list files that have expired, or that compaction has replaced.
        landed = read_landed(spark, path)
        if since:
            landed = landed.filter(F.make_date("year", "month", "day") >= F.lit(since))
        rows = normalise(landed, city or city_from_topic(F.col("topic")), temp_unit)
    else:
        options = {"modifiedAfter": f"{since}T00:00:00"} if since else {}
        rows = normalise(unwrap_envelope(read_landing(spark, path, kind, ENVELOPE, **options)), city, temp_unit)
    return _history_columns(rows)


def _history_columns(rows: DataFrame) -> DataFrame:
    possible = F.when(is_plausible(F.col("dt")), F.col("dt"))  # other times have no month, and may overflow
    return add_time_parts(rows.withColumn("_possible", possible), "_possible").select(*HISTORY_TABLE.fieldNames())


def _unique_batch(
    deliveries: DataFrame, quarantine: str | None, mode: str = "append", reader: SparkSession | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Latest delivery per observation, staged, with the counts of rows read and kept.

    Rows whose time cannot be true are no observations: they are counted as `implausible` and, when a `quarantine`
    table is named, appended to it. Rows without a time stay, as they always have.
    """
    seen = Observation()
    observed = deliveries.observe(seen, F.count(F.lit(1)).alias("read"))
    unique_rows, unique = stage(dedup(observed), "batch", reader)
    possible = F.col("dt").isNull() | is_plausible(F.col("dt"))
    counts = {"read": seen.get.get("read", 0), "unique": unique}
    aside = unique_rows.filter(~possible)
    implausible = aside.count()
    if implausible:
        counts |= {"implausible": implausible}
        if quarantine:
            write_table(aside.drop(*HISTORY_PARTITIONS), quarantine, mode=mode)
    return unique_rows.filter(possible), counts


def _to_history(batch: DataFrame, history_path: str, corrections: bool) -> dict[str, int]:
    return merge_latest(batch, history_path) if corrections else append_new(batch, history_path, partition_by=HISTORY_PARTITIONS)


def consolidate(deliveries: DataFrame, history_path: str, quarantine: str | None = None, corrections: bool = False) -> dict[str, int]:
    """Move landing rows to history: latest delivery per observation, only observations history lacks.

    With `corrections`, a later delivery that differs from the stored observation replaces it, and the report has how many
    were `corrected`. Returns rows read, unique observations among them, and rows written, all counted by the run itself, and
    `implausible` when there were any.
    """
    with staging(deliveries.sparkSession):
        batch, counts = _unique_batch(deliveries, quarantine)
        return {**counts, **_to_history(batch, history_path, corrections)}


def consolidate_stream(
    spark: SparkSession,
    landing: str,
    history_path: str,
    checkpoint: str,
    every: str | None = None,
    city: str | None = None,
    temp_unit: str = "C",
    quarantine: str | None = None,
    corrections: bool = False,
    max_files: int | None = None,
    on_written: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """`consolidate` as a stream: each file that the ingest has landed goes to history once, found by the sink's log.

    Nothing that was read before is read again, so a run costs what has arrived since. `every=None` takes what is there, in
    batches of `max_files` files, and stops. Batches are repeatable: history takes rows by key, and what is set aside has a
    folder of its own for each batch (`stream=`, `batch=`), written over by a repeat. A finished batch is in the ledger beside history (`read_ledger`)
    and is not done again, so a run may die at any point. Several streams must not write to one history at a time.

    A file that compaction or retention has removed before this stream read it stops the run with an error; `consolidate` over
    `landing_as_history`, which reads compacted files too, then catches up.
    """

    def work(batch: DataFrame, batch_id: int) -> dict[str, int]:
        aside = f"{quarantine}/stream={stream_id(spark, checkpoint)}/batch={batch_id}" if quarantine else None
        with staging(spark):
            unique, counts = _unique_batch(batch, aside, "overwrite", spark)
            return {**counts, **_to_history(unique, history_path, corrections)}

    files = spark.readStream.schema(LANDING_STREAM)
    landed = (files.option("maxFilesPerTrigger", max_files) if max_files else files).parquet(landing)
    rows = _history_columns(normalise(landed, city or city_from_topic(F.col("topic")), temp_unit))
    run = once_per_batch(spark, history_path, checkpoint, work, on_written)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _with_layout(silver: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    extra = [name for name in partition_by if name not in silver.columns]
    return add_time_parts(silver).select(*SILVER.fieldNames(), *extra) if extra else silver


def build_silver(
    spark: SparkSession,
    documents: Sequence[tuple[str, str]],
    history_path: str | None,
    silver_path: str,
    partition_by: Sequence[str] = ("city",),
    temp_unit: str = "C",
    multiline: bool = True,
    gather: bool = True,
    quarantine: str | None = None,
) -> dict[str, int]:
    """History documents, given as (path, city), and the consolidated history -> Silver, one row per observation.

    An observation that both hold comes from history, the later delivery. Documents without a time that can be true,
    broken ones among them, are left out, counted as `unreadable`, and with `quarantine` appended there as text.
    `gather=False` saves the shuffle of the whole table; use it when a task meets few output folders,
    as with few sites.
    """
    with staging(spark):
        frames, unreadable = [], 0
        for path, city in documents:
            read = read_json_history(spark, path, multiline, corrupt=CORRUPT)
            aside, bad = stage(read.filter(~is_plausible(F.col("dt"))).select(F.lit(city).alias("city"), *read.columns), "unreadable")
            unreadable += bad
            if bad and quarantine:
                text = F.coalesce(CORRUPT, F.to_json(F.struct(*(name for name in read.columns if name != CORRUPT))))
                write_table(aside.select("city", text.alias("text")), quarantine, mode="append")
            frames.append(normalise(read.filter(is_plausible(F.col("dt"))), city, temp_unit))
        if history_path:
            frames.append(normalise(load_or_empty(spark, history_path, HISTORY_TABLE)))
        rows = union_sources(*frames)
        if "ingestion_timestamp" not in rows.columns:
            rows = rows.withColumn("ingestion_timestamp", F.lit(None).cast("timestamp"))
        silver = require_rows(require_fields(dedup(rows).drop("ingestion_timestamp"), SILVER), "Silver input")
        written = write_table(_with_layout(silver, partition_by), silver_path, partition_by, dynamic=False, gather=gather)
        return written | ({"unreadable": unreadable} if unreadable else {})


def build_gold(spark: SparkSession, silver_path: str, gold_root: str) -> dict[str, int]:
    return write_gold(read_table(spark, silver_path, SILVER), gold_root)


def update_from_landing(
    spark: SparkSession,
    deliveries: DataFrame,
    history_path: str,
    silver_path: str,
    gold_root: str,
    quarantine: str | None = None,
    corrections: bool = False,
) -> dict[str, int]:
    """Landing -> history -> Silver -> Gold for the site-months the deliveries touch.

    With `corrections`, later deliveries replace stored observations all the way. Work follows the size of the touched site-months, not of the lake; the files of other sites and months stay.
    Silver is laid out by site and month and holds what history holds.
    """
    with staging(spark):
        batch, counts = _unique_batch(deliveries, quarantine)
        counts |= _to_history(batch, history_path, corrections)
        touched, _ = stage(touched_months(batch), "touched")
        months = value_counts(touched, ["year", "month"])
        recent = within_months(load_or_empty(spark, history_path, HISTORY_TABLE), months)
        rows = _with_layout(normalise(recent).drop("ingestion_timestamp"), SILVER_BY_MONTH)
        silver = only_touched(rows, touched, SILVER_BY_MONTH)
        counts["silver"] = write_table(silver, silver_path, SILVER_BY_MONTH)["rows"]
        return {**counts, **refresh_gold(read_table(spark, silver_path, rows.schema), gold_root, touched)}


def run_stream(
    spark: SparkSession,
    servers: str,
    topics: str,
    path: str,
    checkpoint: str,
    every: str = "1 minute",
    retention: str | None = None,
    quarantine: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Follow topics into the landing table until stopped. Messages that cannot be read go, as text, to `quarantine`."""
    messages = message_source(spark, "kafka", servers=servers, topics=topics, **options)
    return ingest_messages(messages, path, checkpoint, every, retention, quarantine)


def ingest_messages(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "1 minute",
    retention: str | None = None,
    quarantine: str | None = None,
    ingested_at: Column | None = None,
) -> StreamingQuery:
    """Every message to one of two tables: landing rows, or with `quarantine` the text of what cannot be read.

    The second sink is a query of its own with a checkpoint of its own, so either can fail and restart alone.
    Returns the query of the landing table.
    """
    if quarantine:
        start_ingest(quarantine_rows(messages), quarantine, f"{checkpoint}-quarantine", every, ("topic",), retention)
    return start_ingest(landing_rows(messages, ingested_at), path, checkpoint, every, retention=retention)


def compact_landing(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, grace: float = GRACE_SECONDS) -> dict[str, int]:
    """Put the small files of the stream's landing table together; the stream may run meanwhile."""
    return compact(spark, path, target_bytes=target_bytes, grace=grace)


def expire_landing(spark: SparkSession, table: str, today: dt.date, days: int) -> int:
    """Drop partitions of a catalog table older than `days`; returns how many."""
    return drop_expired(spark, table, cutoff_day(today, days))


def expire_landing_folder(spark: SparkSession, path: str, today: dt.date, days: int) -> dict[str, int]:
    """Delete the arrival days of a landing folder older than `days`; returns folders, files and bytes that went."""
    return expire_folders(spark, path, cutoff_day(today, days))
