"""The daily batch: the three recommenders, each into its result table and on to its serving table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from encore.plans.collab import als_matches
from encore.plans.content import as_recommendations, content_matches
from encore.plans.popularity import popular_recommendations
from encore.sinks.catalog import copy_to_serving, insert_overwrite
from encore.storage import scratch_scope

RECOMMENDERS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "popular": lambda actions, songs: popular_recommendations(songs),
    "content": lambda actions, songs: as_recommendations(content_matches(actions, songs)),
    "als": lambda actions, songs: as_recommendations(als_matches(actions, songs)),
}


def run_daily(
    spark: SparkSession,
    actions: DataFrame,
    songs: DataFrame,
    tables: dict[str, str],
    serving: dict[str, str],
) -> None:
    """Run the recommenders named in `tables`; `serving` names the folder each result is copied to."""
    for name, table in tables.items():
        with scratch_scope(spark):
            insert_overwrite(RECOMMENDERS[name](actions, songs), table)
        if name in serving:
            copy_to_serving(spark, table, serving[name])
