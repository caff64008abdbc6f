"""Joins, filters and aggregates the jobs are put together from."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.schemas import LISTENED, MIN_LIKED_RATING
from encore.storage import materialize


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def rated_at_least(actions: DataFrame, rating: float = MIN_LIKED_RATING) -> DataFrame:
    return actions.filter(F.col("rating") >= rating)


def of_type(actions: DataFrame, action_type: str = LISTENED) -> DataFrame:
    return actions.filter(F.col("action_type") == action_type)


def weighted_score(df: DataFrame, weights: dict[str, float], name: str) -> DataFrame:
    return df.withColumn(name, reduce(add, [F.col(c) * w for c, w in weights.items()]))


def top_n(df: DataFrame, score: str, n: int, tie: str) -> DataFrame:
    """The n best rows. Spark keeps n rows per task and merges them, without a full sort."""
    return df.orderBy(F.desc(score), F.asc(tie)).limit(n)


def ranked(df: DataFrame, group: str, score: str, tie: str, k: int) -> DataFrame:
    """The k best rows of every group, with their rank. Each task cuts to k before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def null_columns(df: DataFrame) -> DataFrame:
    """One row per column of `df` that holds a null: column_name, nulls. One pass over the data."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return nulls.unpivot([], df.columns, "column_name", "nulls").filter("nulls > 0")


def without(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(seen, keys, "left_anti")


def last_per_key(df: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by `order_by`, then by all columns, so the choice never varies."""
    order_by = order_by or []
    rest = [c for c in df.columns if c != key and c not in order_by]
    kept = df.groupBy(key).agg(F.max(F.struct(*order_by, *rest)).alias("_row"))
    return kept.select(key, "_row.*").select(df.columns)


def plays_per_user(actions: DataFrame) -> DataFrame:
    """Songs each user played with how often, in place of one list per user of unbounded length."""
    return actions.groupBy("user_id", "song_id").agg(F.count("*").alias("plays"))


def frequency_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """Dense numbers from 0 for the values of `column`: most frequent first, ties by value.

    The values are sorted in ranges and numbered within each range; only the range sizes pass
    through the driver, never the values.
    """
    spark = df.sparkSession
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    # Written once, so that the ranges cannot move between counting and numbering.
    ordered = materialize(
        counts.orderBy(F.desc("_n"), F.asc(column)).select(column, F.monotonically_increasing_id().alias("_id")),
        "frequency-index",
    ).withColumn("_range", F.shiftright("_id", 33))
    sizes = ordered.groupBy("_range").agg(F.count("*").alias("n")).orderBy("_range").collect()
    starts, start = [], 0
    for row in sizes:
        # Ids within a range count up from _range * 2^33.
        starts.append((row["_range"], start - (row["_range"] << 33)))
        start += row["n"]
    shift = F.broadcast(spark.createDataFrame(starts, "_range bigint, _shift bigint"))
    return ordered.join(shift, "_range").select(column, (F.col("_id") + F.col("_shift")).alias(name))


def index_columns(df: DataFrame, indexes: dict[str, DataFrame]) -> DataFrame:
    """Add the number of each indexed column. Rows with a value the index does not know are skipped."""
    return reduce(lambda frame, item: frame.join(item[1], item[0]), indexes.items(), df)


def explode_lists(df: DataFrame, column: str) -> DataFrame:
    """One row per element of an array<struct> column, its fields as columns."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(column).alias("_element")).select(*rest, "_element.*")
