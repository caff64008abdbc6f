"""User actions as JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from encore.schemas import ACTION_JSON_FIELDS, USER_ACTION

# A timestamp counts microseconds in 64 bits.
MAX_MILLIS = (2**63 - 1) // 1000
# Why a record is rejected; the first that holds counts.
REASONS = ("no_record", "user", "song", "action", "rating", "timestamp")


def encode_action(actions: DataFrame, now_ms: Column | None = None) -> DataFrame:
    """One JSON string per action, in column `value`. The rating is sent as text, as the form does."""
    sent = now_ms if now_ms is not None else F.unix_millis(F.current_timestamp())
    fields = [
        F.col("user_id"), F.col("song_id"), F.col("rating").cast("string"), F.col("action_type"), sent.cast("long"),
    ]
    record = F.struct(*[c.alias(name) for c, name in zip(fields, ACTION_JSON_FIELDS)])
    return actions.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def decode_actions(records: DataFrame, column: str = "value") -> DataFrame:
    """Add `accepted`, `reason` and the five action columns to every record; unknown fields are ignored.

    Rules: userId, songId and action must be present, and a string or null. The rating must be a number
    or numeric text, the timestamp a whole number or digits that a timestamp can hold. `action_ms` keeps it as sent.
    `reason` names the first rule that a record breaks, in the order of REASONS; accepted ones have none.
    """
    fields = [c for name in ACTION_JSON_FIELDS
              for c in (_json_type(name).alias(f"_type_{name}"), _json_text(name).alias(f"_text_{name}"))]
    # A generator of one row keeps the optimizer from copying the parsing into every later use of a field.
    parsed = records.withColumn("_json", F.try_parse_json(column)).select(
        *records.columns, F.inline(F.array(F.struct(*fields)))
    )
    rating, sent = _rating(), _whole_number()
    texts = [F.col(f"_type_{name}").isin("STRING", "VOID") for name in ("userId", "songId", "action")]
    kinds = [F.col(f"_type_{name}") for name in ACTION_JSON_FIELDS]
    # A missing field has a null type; so has every field of what is no object, or no JSON.
    broken = {
        "no_record": F.coalesce(*kinds).isNull(), "user": ~texts[0], "song": ~texts[1], "action": ~texts[2],
        "rating": rating.isNull(), "timestamp": ~sent.between(-MAX_MILLIS, MAX_MILLIS),
    }
    reason = F.coalesce(*[F.when(F.coalesce(broken[name], F.lit(True)), name) for name in REASONS])
    values = {
        "user_id": F.col("_text_userId"), "song_id": F.col("_text_songId"), "action_type": F.col("_text_action"),
        "action_ms": sent, "rating": rating,
    }
    return parsed.select(
        *records.columns,
        reason.isNull().alias("accepted"), reason.alias("reason"),
        *[value.alias(name) for name, value in values.items()],
    )


def accepted_actions(decoded: DataFrame) -> DataFrame:
    """The rows of the action table."""
    timed = decoded.filter("accepted").withColumn("action_time", F.timestamp_millis("action_ms"))
    return timed.select(*USER_ACTION.names)


def rejected_records(decoded: DataFrame, column: str = "value") -> DataFrame:
    """The rejected records as they came, and why."""
    return decoded.filter("not accepted").select(column, "reason")


def reject_counts(decoded: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that counts them by reason, and the accepted ones, while they are written."""
    counted = [F.count_if(F.col("reason") == name).alias(name) for name in REASONS]
    seen = Observation()
    return decoded.observe(seen, F.count_if("accepted").alias("accepted"), *counted), seen


def _field(name: str, as_type: str) -> Column:
    return F.try_variant_get("_json", f"$.{name}", as_type)


def _json_type(name: str) -> Column:
    """STRING, BIGINT, VOID and so on; null if the field is missing or the record is not an object."""
    return F.schema_of_variant(_field(name, "variant"))


def _json_text(name: str) -> Column:
    return _field(name, "string")


def _rating() -> Column:
    kind, text = F.col("_type_rating"), F.trim("_text_rating")
    number = text.try_cast("double")
    # Words for infinity and not-a-number count only in their one exact spelling.
    word = text.rlike("(?i)^[+-]?(inf|infinity|nan)$") & ~text.rlike("^[+-]?(Infinity|NaN)$")
    plain = (kind == "STRING") | (kind == "BIGINT") | (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL")
    return F.when(plain & ~word, number)


def _whole_number() -> Column:
    kind, text = F.col("_type_timestamp"), F.col("_text_timestamp")
    digits = (kind == "BIGINT") | ((kind == "STRING") & text.rlike("^[+-]?[0-9]+$"))
    return F.when(digits, text.try_cast("bigint"))
