"""Raw song table to clean song table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from encore.operators.impute import columns_with_gaps, fill_with, fit_line
from encore.schemas import (
    DROPPED_SONG_COLUMNS, IMPUTE_FEATURES, IMPUTED_SONG_COLUMNS, RENAMED_SONG_COLUMNS,
)
from encore.sinks.files import overwrite_parquet


def prune(df: DataFrame, dropped: list[str], renamed: dict[str, str]) -> DataFrame:
    return df.drop(*dropped).withColumnsRenamed(renamed)


def clean_songs(
    raw: DataFrame,
    imputed: list[str] = IMPUTED_SONG_COLUMNS,
    features: list[str] = IMPUTE_FEATURES,
    dropped: list[str] = DROPPED_SONG_COLUMNS,
    renamed: dict[str, str] = RENAMED_SONG_COLUMNS,
    complete: list[str] | None = None,
) -> DataFrame:
    """Fill the imputed columns, drop the unused ones, rename, and put the filled ones last.

    A row takes part in a fit if no column of it is null or NaN. Only columns with gaps can rule a row
    out, so they are found in one pass and the fits read nothing else. `complete` names other columns.
    """
    complete = complete or columns_with_gaps(raw) or imputed
    filled = raw
    for label in imputed:
        model = fit_line(raw, label, features, complete)
        filled = fill_with(filled, model, label, features, f"{label}_filled")
    pruned = prune(filled, [*dropped, *imputed], renamed)
    return pruned.withColumnsRenamed({f"{label}_filled": label for label in imputed})


def preprocess(raw: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Write the clean song table to `path`: as the scan is split, or spread over `files` files."""
    return overwrite_parquet(clean_songs(raw), path, files)
