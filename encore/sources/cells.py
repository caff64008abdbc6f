"""Rows of a wide-column store: one cell per row in, one record per key out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.schemas import RECOMMENDATION

FAMILY = "details"


def rows_from_cells(cells: DataFrame, columns: list[str] = RECOMMENDATION.names[1:], family: str = FAMILY) -> DataFrame:
    """row_key, column, value cells to one row per key. A cell without a value reads as empty text.

    If the cells carry a `version`, the newest one of each key and column counts.
    """
    version = F.col("version") if "version" in cells.columns else F.lit(0)
    value = F.struct(version.alias("version"), F.coalesce("value", F.lit("")).alias("value"))
    picked = [
        F.max(F.when(F.col("column") == f"{family}:{c}", value))["value"].alias(c) for c in columns
    ]
    return cells.groupBy("row_key").agg(*picked)


def cells_from_rows(rows: DataFrame, columns: list[str] = RECOMMENDATION.names[1:], family: str = FAMILY) -> DataFrame:
    tagged = rows.select("row_key", *[F.col(c).cast("string").alias(f"{family}:{c}") for c in columns])
    return tagged.unpivot("row_key", [f"`{family}:{c}`" for c in columns], "column", "value")
