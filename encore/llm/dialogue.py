"""Repair of conversation structure: damage, faults, cheapest repair of the roles, and the repaired text's hash.

Rows are sorted once over the whole table by conversation and turn and numbered in that order, so a long conversation is
spread over many tasks. Duplicates are found by the first number of every (conversation, role, hash of the text). The
roles of a conversation are parsed in runs of at most RUN rows: a short conversation is one run, a longer one is summed up
run by run (`roles.ways`), and one row per run is walked through to choose the ways that fit together. Texts go through
one more shuffle, in which a task reads each conversation in order and keeps no more than a run's plan and the hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from encore.llm import roles
from encore.llm.words import texts_of
from encore.storage import materialize

RUN = 1 << 10
WHITE = "\t\n\x0b\x0c\r "
FAR = 1 << 60
LINKS = len(roles.LINKS)


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text) after the damage that the crc32 of `conv:turn` names; nulls of all columns read as a space."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")])
    fault = F.crc32(F.encode(name, "UTF-8")) % 20
    filled = rows.select("conv", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], fault.alias("_fault"))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_fault") == 3, 2).otherwise(1)))
    return filled.filter("_fault <> 0").select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def in_order(rows: DataFrame) -> DataFrame:
    """The rows with `pos`, which grows by conversation, turn (nulls first), role and text."""
    # The last key spreads equal rows over ranges.
    keyed = rows.withColumn("_spread", F.monotonically_increasing_id())
    order = ["conv", "turn", "role", "text", "_spread"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_spread").withColumn("pos", F.monotonically_increasing_id())


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, pos, initial, fault): the first of blank, duplicate and truncated, else none."""
    told = F.rtrim("text", F.lit(WHITE))
    facts = rows.select(
        "conv", "turn", "pos", "role", F.substring("role", 1, 1).alias("_i"), (told == "").alias("blank"),
        (~F.substring(told, -1, 1).isin(".", "!", "?")).alias("cut"), F.sha2("text", 256).alias("hash"),
    )
    firsts = facts.filter("NOT blank").groupBy("conv", "role", "hash").agg(F.min("pos").alias("first")).select("first")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise("none")
    initial = F.when(F.col("_i").isin("s", "u", "a"), F.col("_i")).otherwise("-")
    return facts.join(firsts, F.col("pos") == F.col("first"), "left").select("conv", "turn", "pos", initial.alias("initial"), fault.alias("fault"))


def _parse_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("rows").to_pylist()
        found = [roles.whole(r) for r in rows]
        yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in ("conv", "run", "start")} | {
            "cost": pa.array([c for c, _ in found], pa.int64()), "audit": pa.array([a for _, a in found], pa.string()),
            "illegal": pa.array([roles.broken(r[::2]) for r in rows], pa.int64()),
        })


def _parse_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs and ranks of audits from every link to every link of a run, and the audits by rank."""
    for batch in batches:
        out = []
        for rows in batch.column("rows").to_pylist():
            found = {(a, b): way for a in range(LINKS) for b, way in roles.ways(rows, a).items()}
            audits = sorted({audit for _, audit in found.values()})
            rank = {audit: n for n, audit in enumerate(audits)}
            costs, ranks = np.full(LINKS * LINKS, FAR), np.zeros(LINKS * LINKS, np.int64)
            for (a, b), (cost, audit) in found.items():
                costs[a * LINKS + b], ranks[a * LINKS + b] = cost, rank[audit]
            out.append((costs.tolist(), ranks.tolist(), audits, roles.broken(rows[::2]), rows[0], rows[-2]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in ("conv", "run", "start")]
            + [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(), pa.string(), pa.string()))],
            names=["conv", "run", "start", "costs", "ranks", "audits", "broken", "first", "last"],
        )


class _Chain:
    """The cheapest way through the runs of one conversation. Holds a few bytes per run."""

    def __init__(self) -> None:
        self.cost, self.rank = [FAR] * LINKS, [0] * LINKS
        self.cost[roles.NUMBER[roles.START]] = 0
        self.back: list[tuple[int, list[int], list[int]]] = []
        self.illegal, self.last = 0, ""

    def add(self, run: int, costs: list[int], ranks: list[int], broken: int, first: str, last: str) -> None:
        best = [
            min((self.cost[a] + costs[a * LINKS + b], self.rank[a], ranks[a * LINKS + b], a) for a in range(LINKS)) for b in range(LINKS)
        ]
        order = {key: n for n, key in enumerate(sorted({b[1:3] for b in best}))}
        self.cost, self.rank = [min(b[0], FAR) for b in best], [order[b[1:3]] for b in best]
        self.back.append((run, [b[3] for b in best], [b[2] for b in best]))
        self.illegal += broken + roles.broken(self.last + first)
        self.last = last

    def chosen(self) -> list[tuple[int, int, int, int, int]]:
        """(run, rank of its audit, inserts after it, cost of all, broken pairs of all) from the last run to the first."""
        cost, _, link, tail = min((self.cost[n] + e[0], self.rank[n], n, e[1]) for n in range(LINKS) if (e := roles.ending(n)))
        out = []
        for run, before, ranks in reversed(self.back):
            out.append((run, ranks[link], tail, cost, self.illegal))
            link, tail = before[link], 0
        return out


def _walk(kind: pa.DataType):
    """One row per run, in order by conversation: (conv, run, rank, inserts after it, cost, broken pairs)."""

    def emit(conv, chain: _Chain) -> pa.RecordBatch:
        found = chain.chosen()
        columns = [pa.array([conv] * len(found), kind)] + [pa.array([f[i] for f in found], pa.int64()) for i in range(5)]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "run", "rank", "tail", "cost", "illegal"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chain = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if chain is None or row["conv"] != now:
                    if chain is not None:
                        yield emit(now, chain)
                    now, chain = row["conv"], _Chain()
                chain.add(row["run"], row["costs"], row["ranks"], row["broken"], row["first"], row["last"])
        if chain is not None:
            yield emit(now, chain)

    return run


class _Repaired:
    """Hash of one conversation's repaired rows, read in order, and its audit."""

    def __init__(self) -> None:
        self.hash, self.audits, self.lines, self.expected = hashlib.sha256(), [], 0, "user"
        self.cost = self.illegal = 0

    def plan(self, audit: str, cost: int, illegal: int) -> None:
        self.audits.append(audit)
        self.left, self.at, self.end = audit, 0, len(audit.rstrip("I"))
        self.cost, self.illegal = cost, illegal

    def _line(self, role: str, text: str) -> None:
        self.hash.update(b"\n" * (self.lines > 0) + role.encode() + b":" + text.encode())
        self.lines += 1
        if role[:1] != "s":
            self.expected = "assistant" if self.expected == "user" else "user"

    def _insert(self, until: int) -> None:
        while self.at < until and self.left[self.at] == "I":
            self._line(self.expected, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insert(self.end)
        action = self.left[self.at]
        self.at += 1
        if action != "D":
            self._line(role if action == "K" else self.expected, text)
        if self.at == self.end:
            self._insert(len(self.left))


def _hashing(kind: pa.DataType):
    """Plans and rows, in order by conversation and number: (conv, cost, audit, illegal, repaired_sha256)."""

    def told(done: list) -> pa.RecordBatch:
        names = ["conv", "cost", "audit", "illegal", "repaired_sha256"]
        columns = [
            [c for c, _ in done], [r.cost for _, r in done], ["".join(r.audits) for _, r in done],
            [r.illegal for _, r in done], [r.hash.hexdigest() for _, r in done],
        ]
        types = (kind, pa.int64(), pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            done = []
            columns = [batch.column(n) for n in ("conv", "audit", "cost", "illegal", "role")]
            texts = texts_of(batch.column("text"))
            for at, (conv, audit, cost, illegal, role) in enumerate(zip(*(c.to_pylist() for c in columns), strict=True)):
                if now is None or conv != now[0]:
                    if now is not None:
                        done.append(now)
                    now = (conv, _Repaired())
                if audit is not None:
                    now[1].plan(audit, cost, illegal)
                else:
                    now[1].row(role, texts[at].as_py())
            yield told(done)
        if now is not None:
            yield told([now])

    return run


def repair_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", run_rows: int = RUN
) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    Rows are damaged (`damaged`), sorted by turn with nulls first, and repaired to initials of the form `(s?(ua)+)?` at the
    least cost; of equal repairs the audit that comes first counts. Rows of one turn are taken by role, then text.

    Edge cases: a null role or text is one space, so it is blank or no known role; a null conversation is a conversation of
    its own; null turns sort first and leave no gap. Repeated rows are duplicates. A conversation that lost all its rows
    has zeros, an empty audit and the hash of the empty text, as has one whose rows are all deleted in cost and audit of its
    own. Texts are hashed whole, whatever their length. No rows give no rows. Other columns are ignored.
    """
    given = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    field = given.schema["conv"].dataType
    kind = field.simpleString()
    arrow = to_arrow_type(field)
    turns = materialize(in_order(damaged(given)), "turns")
    faults = materialize(with_faults(turns), "faults")
    counts = faults.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)).alias("_span"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    # Distinct turns in two steps: a long conversation has one row per turn and task.
    turn_counts = faults.filter("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(F.count("*").alias("turns"))
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", "t").otherwise(".")
    coded = faults.select("conv", F.expr(f"pos div {run_rows}").alias("run"), "pos", F.concat("initial", letter).alias("code"))
    runs = coded.groupBy("conv", "run").agg(F.min("pos").alias("start"), F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("rows"))
    runs = runs.select("conv", "run", "start", F.array_join("rows.code", "").alias("rows"))
    runs = materialize(runs.withColumn("runs", F.count("*").over(Window.partitionBy("conv"))), "runs")

    schema = f"conv {kind}, run bigint, start bigint, cost bigint, audit string, illegal bigint"
    short = runs.filter("runs = 1").select("conv", "run", "start", "rows").mapInArrow(_parse_whole, schema)
    ways = runs.filter("runs > 1").select("conv", "run", "start", "rows").mapInArrow(_parse_ways, (
        f"conv {kind}, run bigint, start bigint, costs array<bigint>, ranks array<bigint>, audits array<string>, broken bigint, first string, last string"
    ))
    ways = materialize(ways, "ways")
    steps = ways.select("conv", "run", "costs", "ranks", "broken", "first", "last").repartition("conv").sortWithinPartitions("conv", "run")
    walked = steps.mapInArrow(_walk(arrow), f"conv {kind}, run bigint, rank bigint, tail bigint, cost bigint, illegal bigint")
    walked = walked.withColumnsRenamed({"conv": "c", "run": "r"})
    fits = F.col("conv").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r"))
    audit = F.concat(F.get("audits", F.col("rank").cast("int")), F.repeat(F.lit("I"), F.col("tail").cast("int")))
    long = ways.join(walked, fits).select("conv", "run", "start", "cost", audit.alias("audit"), "illegal")

    plans = short.union(long).select("conv", F.col("start").alias("pos"), F.lit(0).alias("tag"), "audit", "cost", "illegal")
    plans = plans.withColumns({"role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")})
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("audit", "string"), ("cost", "bigint"), ("illegal", "bigint"))]
    lines = turns.select("conv", "pos", F.lit(1).alias("tag"), *empty, "role", "text")
    stream = plans.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "pos", "tag")
    hashed = stream.mapInArrow(_hashing(arrow), f"conv {kind}, cost bigint, audit string, illegal bigint, repaired_sha256 string")

    def named(side: DataFrame, name: str) -> DataFrame:
        return side.withColumnRenamed("conv", name)

    known = given.select("conv").distinct()
    for side, name in ((named(counts, "_a"), "_a"), (named(turn_counts, "_b"), "_b"), (named(hashed, "_c"), "_c")):
        known = known.join(side, F.col("conv").eqNullSafe(F.col(name)), "left")
    number = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    return known.select(
        F.col("conv").alias(conv), (F.coalesce("_span", F.lit(0)) - F.coalesce("turns", F.lit(0))).cast("long").alias("gaps"), *number,
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
