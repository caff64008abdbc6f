"""The live job: a stream of action records to the action lake and to per-user recommendations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from encore.functions.actions import REASONS, accepted_actions, decode_actions, reject_counts, rejected_records
from encore.operators.catalogue import Catalogue
from encore.plans.content import as_recommendations
from encore.plans.live import live_matches
from encore.schemas import SONGS_PER_USER
from encore.sinks.catalog import compact_lake as compact_lake_view
from encore.sinks.catalog import write_actions
from encore.sinks.files import compact_levels, newest_version, upsert, write_batch
from encore.sinks.lake import append_batch, compact_lake
from encore.storage import scratch_scope


@dataclass(frozen=True)
class LiveTables:
    """Folders the live job writes. The lake may be the name of an `action_lake` view instead. Counts of accepted and
    rejected records go to `counts`, one row per batch and reason; by default next to the rejects."""

    lake: str
    serving: str
    rejects: str
    counts: str | None = None

    @property
    def reject_counts(self) -> str:
        return self.counts or f"{self.rejects}-counts"


def process_batch(
    records: DataFrame, batch: int, stream: str, catalogue: Catalogue, tables: LiveTables, k: int = SONGS_PER_USER,
    first_version: int = 0,
) -> None:
    """Everything that happens to one micro-batch. A replay of the batch leaves the same tables.

    Versions of recommendations count up from `first_version` by batch, so no clock decides which row is newer.
    """
    if records.isEmpty():
        return
    spark = records.sparkSession
    # Records are parsed once for the lake, the rejects and the recommendations.
    decoded = decode_actions(records).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        actions = accepted_actions(decoded)
        # Counted while the rejects are written: no further pass over the records.
        counted, seen = reject_counts(decoded)
        write_batch(rejected_records(counted), tables.rejects, stream, batch)
        rows = [(reason, seen.get[reason]) for reason in ("accepted", *REASONS)]
        write_batch(spark.createDataFrame(rows, "reason string, records long").coalesce(1), tables.reject_counts, stream, batch)
        (append_batch if "/" in tables.lake else write_actions)(actions, tables.lake, stream, batch)
        with scratch_scope(spark):
            matches = as_recommendations(live_matches(actions, catalogue, k))
            upsert(matches, tables.serving, stream, batch, version=first_version + batch)
    finally:
        decoded.unpersist()
    # Both look at the list of folders first and mostly find nothing to do.
    (compact_lake if "/" in tables.lake else compact_lake_view)(spark, tables.lake)
    compact_levels(spark, tables.serving)


def on_batch(
    catalogue: Catalogue, tables: LiveTables, k: int = SONGS_PER_USER, first_version: int = 0
) -> Callable[[DataFrame, int], None]:
    def run(records: DataFrame, batch: int) -> None:
        # The query id stays the same across restarts from one checkpoint, so a replay overwrites its own
        # folder, and another query never does.
        stream = records.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        process_batch(records, batch, stream, catalogue, tables, k, first_version)

    return run


def start(
    records: DataFrame,
    catalogue: Catalogue,
    tables: LiveTables,
    checkpoint: str,
    interval_seconds: int | None = 30,
    k: int = SONGS_PER_USER,
) -> StreamingQuery:
    """Start the live job. `interval_seconds=None` handles all records that are there, then stops.

    Offsets are committed to `checkpoint` only after a batch went through, so a failed one is replayed.
    """
    # Above all versions so far, whatever batch number this query begins with.
    first_version = newest_version(records.sparkSession, tables.serving) + 1
    handle = on_batch(catalogue, tables, k, first_version)
    writer = records.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if interval_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_seconds} seconds").start()
