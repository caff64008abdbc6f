"""One record per file: find the files, decode each into a row of a fixed schema."""

from __future__ import annotations

import json
import numbers
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.schemas import RAW_SONG
from encore.storage import materialize

Decoder = Callable[[bytes], dict]


def decode_json(content: bytes) -> dict:
    return json.loads(content)


def record_files(
    spark: SparkSession,
    folder: str,
    glob: str,
    decoder: Decoder,
    schema: T.StructType = RAW_SONG,
) -> DataFrame:
    """path, error and the columns of `schema` for every matching file below `folder`.

    A file that cannot be decoded gives its error and null columns. Fields the schema does not name
    are left out; missing ones are null.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        .load(folder).select("path", "content")
    )
    out = T.StructType([T.StructField("path", T.StringType()), T.StructField("error", T.StringType()), *schema])

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_decode_one(path, content, decoder, schema) for path, content in zip(batch.path, batch.content)]
            yield pd.DataFrame(rows, columns=out.names, dtype=object)

    return files.mapInPandas(decode, out)


def _decode_one(path: str, content: bytes, decoder: Decoder, schema: T.StructType) -> list:
    try:
        record = decoder(content)
        return [path, None, *[_plain(record.get(f.name), f.dataType) for f in schema]]
    except Exception as error:  # any bad file is reported, none stops the job
        return [path, f"{type(error).__name__}: {error}", *[None] * len(schema)]


def _plain(value, data_type: T.DataType):
    """The value as plain Python of the declared type. Anything that the type cannot hold exactly raises.

    Bytes count as text, whole numbers as doubles, and doubles without a fraction as whole numbers.
    """
    if value is None:
        return None
    if isinstance(data_type, T.ArrayType):
        if isinstance(value, (str, bytes, dict)):
            raise TypeError(f"{type(value).__name__} where an array is declared")
        return [_plain(item, data_type.elementType) for item in value]
    if isinstance(data_type, T.StringType):
        if not isinstance(value, (str, bytes)):
            raise TypeError(f"{type(value).__name__} where text is declared")
        return value.decode("utf-8") if isinstance(value, bytes) else value
    if isinstance(value, bool) or not isinstance(value, numbers.Real):
        raise TypeError(f"{type(value).__name__} where a number is declared")
    if isinstance(data_type, T.DoubleType):
        return float(value)
    whole, bits = int(value), 31 if isinstance(data_type, T.IntegerType) else 63
    if whole != value or not -(1 << bits) <= whole < 1 << bits:
        raise ValueError(f"{value!r} does not fit {data_type.simpleString()}")
    return whole


def ingest(
    spark: SparkSession, folder: str, glob: str, decoder: Decoder, schema: T.StructType = RAW_SONG
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a folder of record files. Every file is read and decoded once."""
    decoded = materialize(record_files(spark, folder, glob, decoder, schema), "records")
    return decoded.filter("error IS NULL").select(*schema.names), decoded.filter("error IS NOT NULL").select("path", "error")


def decode_utf8(column: str) -> Column:
    """array<binary> to array<string>."""
    return F.transform(column, lambda item: F.decode(item, "UTF-8"))
