"""Vector arithmetic on array columns and on groups of scalar columns, all inside the JVM."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def vec_dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def vec_norm(a: Column) -> Column:
    return F.sqrt(vec_dot(a, a))


def vec_add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def vec_scale(a: Column, divisor: Column) -> Column:
    return F.transform(a, lambda x: x / divisor)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two array columns; 0.0 where either has no length."""
    lengths = vec_norm(a) * vec_norm(b)
    return F.when(lengths != 0, vec_dot(a, b) / lengths).otherwise(F.lit(0.0))


def cosine_of(left: list[Column], right: list[Column]) -> Column:
    """The same for vectors held in scalar columns: plain arithmetic, so it stays in generated code."""
    dot = reduce(add, [a * b for a, b in zip(left, right)])
    lengths = F.sqrt(reduce(add, [a * a for a in left])) * F.sqrt(reduce(add, [b * b for b in right]))
    return F.when(lengths != 0, dot / lengths).otherwise(F.lit(0.0))


def register_sql_functions(spark: SparkSession) -> None:
    """Make cosine_similarity(array, array) callable from SQL text."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION cosine_similarity(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>)
        RETURNS DOUBLE
        RETURN WITH lengths AS (
            SELECT sqrt(aggregate(a, 0D, (s, x) -> s + x * x))
                 * sqrt(aggregate(b, 0D, (s, x) -> s + x * x)) AS product)
        SELECT CASE WHEN product = 0 THEN 0D
                    ELSE aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x) / product END
        FROM lengths
    """)


def feature_sql(name: str, on_missing: str) -> str:
    """SQL text of a feature as double. Null or NaN raises ("error") or counts as 0.0 ("zero")."""
    value = f"CAST(`{name}` AS DOUBLE)"
    replacements = {"zero": "0D", "error": f"raise_error('null or NaN in feature column {name}')"}
    if on_missing not in replacements:
        raise ValueError(f"on_missing must be 'error' or 'zero', not {on_missing!r}")
    return f"CASE WHEN {value} IS NULL OR isnan({value}) THEN {replacements[on_missing]} ELSE {value} END"


def with_features(df: DataFrame, features: list[str], on_missing: str = "error") -> DataFrame:
    return df.withColumns({c: F.expr(feature_sql(c, on_missing)) for c in features})


def mean_vector(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """One mean per key and feature. Map-side partial sums, so a hot key costs one row per task."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in features])


def mean_array(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The same for a wide array column, one element-wise mean array per key."""
    as_vector = array_to_vector(F.col(column).cast("array<double>"))
    return df.groupBy(*keys).agg(vector_to_array(Summarizer.mean(as_vector)).alias(column))
