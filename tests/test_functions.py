import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from encore.functions import keys
from encore.functions.actions import accepted_actions, decode_actions, encode_action, rejected_records
from encore.functions.vectors import cosine, cosine_of, feature_sql, mean_array, mean_vector, register_sql_functions, vec_add, vec_scale

NUMBERS = st.floats(-100, 100, allow_nan=False).map(lambda x: round(x, 3))
PAIRS = st.lists(st.tuples(*[st.lists(NUMBERS, min_size=3, max_size=3)] * 2), min_size=5, max_size=20)


@settings(max_examples=5, deadline=None)
@given(PAIRS)
def test_cosine_properties(spark, pairs):
    table = spark.createDataFrame(pairs, "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    flat = cosine_of([a[i] for i in range(3)], [b[i] for i in range(3)])
    rows = table.select(
        "a", "b", cosine(a, b).alias("ab"), cosine(b, a).alias("ba"), flat.alias("flat"),
        cosine(F.transform(a, lambda x: x * 4), b).alias("scaled"),
    ).collect()
    for row in rows:
        assert -1 - 1e-12 <= row.ab <= 1 + 1e-12
        assert math.isclose(row.ab, row.ba, abs_tol=1e-12)
        assert math.isclose(row.ab, row.flat, abs_tol=1e-12)
        assert math.isclose(row.ab, row.scaled, abs_tol=1e-12)
        if not any(row.a) or not any(row.b):
            assert row.ab == 0.0


def test_vector_arithmetic(spark):
    table = spark.createDataFrame([([1.0, 2.0], [3.0, 5.0])], "a array<double>, b array<double>")
    row = table.select(vec_add(F.col("a"), F.col("b")), vec_scale(F.col("b"), F.lit(2.0))).first()
    assert row[0] == [4.0, 7.0] and row[1] == [1.5, 2.5]
    register_sql_functions(spark)
    assert spark.sql("SELECT cosine_similarity(array(1D, 0D), array(0D, 0D))").first()[0] == 0.0


def test_means(spark):
    table = spark.createDataFrame([("u", 1.0, [1.0, 3.0]), ("u", 1.0, [1.0, 3.0]), ("u", 4.0, [4.0, 0.0])], "k string, x double, v array<double>")
    assert mean_vector(table, ["k"], ["x"]).first().x == 2.0
    assert mean_array(table, ["k"], "v").first().v == [2.0, 2.0]
    assert mean_vector(table.limit(0), ["k"], ["x"]).count() == 0


def test_keys(spark):
    table = spark.createDataFrame([("a#b", "s1"), ("u1", "s2"), ("u10", "s3")], "u string, s string")
    key = keys.row_key(F.col("u"), F.col("s"))
    rows = table.select("u", "s", key.alias("k")).withColumns({"u2": keys.user_of(F.col("k")), "s2": keys.song_of(F.col("k"))})
    assert all(r.u == r.u2 and r.s == r.s2 for r in rows.collect())
    assert [r.s for r in rows.filter(keys.owned_by(F.col("k"), "u1")).collect()] == ["s2"]


def record(**changes):
    fields = {"userId": '"u"', "songId": '"s"', "rating": '"4.5"', "action": '"listened"', "timestamp": "1700000000000"}
    fields.update(changes)
    return "{" + ",".join(f'"{k}":{v}' for k, v in fields.items() if v is not None) + "}"


ACCEPTED = {
    "plain": record(),
    "extra field": record(page='{"a":[1]}'),
    "null user": record(userId="null"),
    "number rating": record(rating="4"),
    "decimal rating": record(rating="4.5"),
    "exponent rating": record(rating='"45e-1"'),
    "text timestamp": record(timestamp='"1700000000000"'),
    "signed timestamp": record(timestamp='"-5"'),
    "exact not a number": record(rating='"NaN"'),
}
REJECTED = {
    "missing user": record(userId=None),
    "missing song": record(songId=None),
    "missing action": record(action=None),
    "missing rating": record(rating=None),
    "missing timestamp": record(timestamp=None),
    "number user": record(userId="5"),
    "object action": record(action="{}"),
    "empty rating": record(rating='""'),
    "null rating": record(rating="null"),
    "true rating": record(rating="true"),
    "word rating": record(rating='"inf"'),
    "exponent timestamp": record(timestamp="1.7e12"),
    "decimal timestamp": record(timestamp="1700000000000.0"),
    "spaced timestamp": record(timestamp='" 17 "'),
    "null timestamp": record(timestamp="null"),
    "huge timestamp": record(timestamp='"99999999999999999999"'),
    "broken": '{"userId":"u",',
    "array": "[1]",
    "null": "null",
    "text": '"x"',
    "empty": "",
}


def test_json_rules(spark):
    rows = [(name, text) for cases in (ACCEPTED, REJECTED) for name, text in cases.items()] + [("no value", None)]
    decoded = decode_actions(spark.createDataFrame(rows, "name string, value string")).collect()
    assert {r.name for r in decoded if r.accepted} == set(ACCEPTED)
    plain = next(r for r in decoded if r.name == "plain")
    assert (plain.user_id, plain.song_id, plain.action_type, plain.action_ms, plain.rating) == ("u", "s", "listened", 1700000000000, 4.5)


def test_accepted_and_rejected_split(spark):
    records = spark.createDataFrame([(record(),), (record(timestamp="9223372036854775807"),), ("x",)], "value string")
    decoded = decode_actions(records)
    # A time beyond what a timestamp can hold is not lost: the record goes to the rejects.
    assert [r.action_time is not None for r in accepted_actions(decoded).collect()] == [True]
    assert [tuple(r) for r in rejected_records(decoded).collect()] == [(record(timestamp="9223372036854775807"), "timestamp"), ("x", "no_record")]


def test_encode_round_trip(spark):
    actions = spark.createDataFrame([("u", "s", "listened", 3.5), (None, "s", "skipped", 0.0)], "user_id string, song_id string, action_type string, rating double")
    decoded = decode_actions(encode_action(actions, F.lit(17))).orderBy("rating").collect()
    assert [(r.user_id, r.rating, r.action_ms, r.accepted) for r in decoded] == [(None, 0.0, 17, True), ("u", 3.5, 17, True)]
    assert decode_actions(encode_action(actions)).filter("action_ms > 1600000000000").count() == 2


@pytest.mark.parametrize("wrong", ["drop", ""])
def test_unknown_policy(spark, wrong):
    with pytest.raises(ValueError):
        feature_sql("x", wrong)


def test_times_no_timestamp_can_hold_are_rejected(spark):
    line = '{"userId":"u","songId":"s","rating":"1","action":"listened","timestamp":%d}'
    sent = [0, (2**63 - 1) // 1000, -((2**63 - 1) // 1000), (2**63 - 1) // 1000 + 1, 2**63 - 1, -(2**63)]
    decoded = decode_actions(spark.createDataFrame([(line % t,) for t in sent], "value string"))
    assert [r.accepted for r in decoded.collect()] == [True] * 3 + [False] * 3
    assert accepted_actions(decoded).filter("action_time IS NULL").count() == 0
    assert rejected_records(decoded).count() == 3
