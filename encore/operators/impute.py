"""Fill missing values of a numeric column by linear regression on other columns."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def columns_with_gaps(df: DataFrame) -> list[str]:
    """Columns holding a null, or a NaN where the type allows one. One pass over the data."""
    counts = df.agg(*[F.count_if(_missing(f)).alias(f.name) for f in df.schema]).first()
    return [c for c in df.columns if counts[c]]


def _missing(field: T.StructField):
    value = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def fit_line(df: DataFrame, label: str, features: list[str], complete: list[str] | None = None) -> LinearRegressionModel:
    """Least squares over the rows without a null or NaN in `complete` (default: in any column)."""
    rows = df.na.drop(subset=complete or df.columns)
    # Only these columns are needed from here on, so the scan reads no others.
    assembled = _assembler(features).transform(rows.select(label, *features))
    return LinearRegression(labelCol=label, featuresCol="_features", predictionCol="_predicted").fit(assembled)


def fill_with(df: DataFrame, model: LinearRegressionModel, label: str, features: list[str], name: str) -> DataFrame:
    """Add column `name`: `label` where present, else the model's value. A null or NaN feature raises."""
    predicted = model.transform(_assembler(features).transform(df))
    return predicted.withColumn(name, F.coalesce(label, "_predicted")).drop("_features", "_predicted")


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="_features")


def impute(
    df: DataFrame, label: str, features: list[str], name: str | None = None, complete: list[str] | None = None
) -> DataFrame:
    """Fit on the complete rows, then fill the nulls of `label` into column `name`."""
    model = fit_line(df, label, features, complete)
    return fill_with(df, model, label, features, name or f"{label}_filled")
