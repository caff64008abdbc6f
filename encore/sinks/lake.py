"""The action lake: micro-batches as live folders, merged in tiers while writers go on.

Sixteen folders of one tier become one of the next, so after n batches a reader opens about 16 folders per tier and every
row has been rewritten once per tier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from encore.schemas import USER_ACTION
from encore.sinks.snapshots import Part, add_batch, merged_covers, new_folder, newest_snapshot, swap

FANOUT = 16


def append_batch(df: DataFrame, path: str, stream: str, batch: int) -> None:
    """Add one micro-batch. A replay of it leaves no duplicates."""
    folder = new_folder()
    df.select(*USER_ACTION.names).write.parquet(f"{path}/{folder}")
    add_batch(df.sparkSession, path, [Part(folder, {stream: [batch, batch]})], stream, batch)


def _rows(spark: SparkSession, path: str, parts: list[Part]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], USER_ACTION)
    return spark.read.schema(USER_ACTION).parquet(*[f"{path}/{p.path}" for p in parts])


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches as of now."""
    return _rows(spark, path, newest_snapshot(spark, path).parts)


def compact_lake(spark: SparkSession, path: str, fanout: int = FANOUT) -> int:
    """Merge every tier of `fanout` or more folders into one folder of the next; returns how many merges went through.

    Streams may go on writing. Readers see the folders of a tier or the merged one. If a batch of the tier is replayed in
    the meantime the merge is given up, and its folder stays unread.
    """
    merges = 0
    while True:
        parts = newest_snapshot(spark, path).parts
        level = next((n for n in sorted({p.level for p in parts}) if sum(p.level == n for p in parts) >= max(fanout, 2)), None)
        if level is None:
            return merges
        tier, folder = [p for p in parts if p.level == level], new_folder()
        # Evenly sized files, whatever the batches brought.
        _rows(spark, path, tier).hint("rebalance").write.parquet(f"{path}/{folder}")
        if not swap(spark, path, tier, [Part(folder, merged_covers(tier), level + 1)]):
            return merges
        merges += 1


def folders(spark: SparkSession, path: str) -> list[str]:
    """The live folders."""
    return [f"{path}/{p.path}" for p in newest_snapshot(spark, path).parts]
