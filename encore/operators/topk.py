"""Exact top-k items per user by cosine or dot product, without pairing every user with every item.

Two plans give the same rows:

* a catalogue whose size is checked against fixed limits is broadcast, and the user side streams
  past it without a shuffle;
* a larger one is cut into chunks of neighbouring items with a directory of bounds (see `chunks`), and the users
  are sorted by a tree of their own, so that neighbours follow each other. In rounds, each user asks for the
  chunks of the best bounds (2, then 32), what these hold raises the user's floor, and then for all further
  chunks whose bound reaches it, in the directory's order. Bounds are taken for a few hundred neighbouring users
  at once, and one by one only for the entries that this leaves open. Between rounds a user carries the best k and
  the few chunks asked for so far, no list of open ones. Who has nothing left to ask for is finished, is written
  apart and read again only for the result.

Users and items meet in groups of bounded size: a crowd of neighbouring users with the chunks of a run that one of
them asked for. So a user is sent once per run, not once per chunk, and a chunk once per crowd. Copies of one vector
are spread over chunks in id order, of which a user needs only the first. Items to leave out are masked inside the
chunk, so a user who has seen thousands of items still gets k rows from each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.vectors import feature_sql
from encore.operators.chunks import NUMBER_BITS, Chunks, Directory, cut_into_chunks, partitions, sort_by_place
from encore.operators.kernels import HALF_TIE, SCORES_PER_BLOCK, best_matches, vector_rows
from encore.storage import delete_folder, materialize, materialize_at, scratch_path

# Limits of a broadcast catalogue.
BROADCAST_ROWS = 1 << 16
BROADCAST_BYTES = 64 << 20
# Users in one group of the clustered plan, in one unit of planning, and those whose bounds are taken together.
CROWD, BLOCK, NEIGHBOURS = 1 << 14, 1 << 10, 1 << 8
# Chunks a user may visit in the first rounds: few while the floor is low. They choose among CHOICE entries, the most
# promising of the neighbourhood, so their cost does not grow with the directory.
VISITS, CHOICE = (2, 32), (64, 512)
# Chunks a user may ask for in any later round.
MOST_OPEN = 1 << 10


def as_vectors(df: DataFrame, key: str, features: list[str], metric: str, on_missing: str, name: str) -> DataFrame:
    """(`name`, v): the key and all features as one array, scaled to length 1 for cosine (zero stays zero)."""
    checked = df.filter(F.col(key).isNotNull()).selectExpr(
        f"`{key}` AS {name}", f"array({', '.join(feature_sql(c, on_missing) for c in features)}) AS v"
    )
    if metric == "dot":
        return checked
    if metric != "cosine":
        raise ValueError(f"metric must be 'cosine' or 'dot', not {metric!r}")
    measured = checked.selectExpr("*", "sqrt(aggregate(v, 0D, (s, x) -> s + x * x)) AS _length")
    return measured.selectExpr(name, "transform(v, x -> CASE WHEN _length > 0 THEN x / _length ELSE 0D END) AS v")


@dataclass(frozen=True)
class ItemIndex:
    """Items ready for `top_k`: build it once with `index_items` and probe it many times."""

    item: T.StructField
    features: list[str]
    metric: str
    on_missing: str
    vectors: DataFrame
    chunks: Chunks | None = None
    # Sent to the executors once per index, not once per search: (keys, matrix), or the directory.
    shared: Broadcast | None = field(default=None, repr=False)

    @property
    def directory(self) -> Directory | None:
        return self.chunks and self.chunks.directory


def index_items(
    items: DataFrame,
    item: str,
    features: list[str],
    *,
    metric: str = "cosine",
    on_missing: str = "error",
    broadcast_rows: int = BROADCAST_ROWS,
    chunk_rows: int | None = None,
    directory_entries: int | None = None,
) -> ItemIndex:
    """Prepare a catalogue for `top_k`. `broadcast_rows=0` forces the clustered plan.

    `items` is read a few times, so it should be a stored table.
    """
    vectors = as_vectors(items, item, features, metric, on_missing, "item")
    known = items.filter(F.col(item).isNotNull())
    rows, key_bytes = known.agg(F.count("*"), F.max(F.octet_length(F.col(item).cast("string")))).first()
    index = ItemIndex(items.schema[item], list(features), metric, on_missing, vectors)
    row_bytes = 8 * len(features) + (key_bytes or 0)
    context = items.sparkSession.sparkContext
    if rows == 0 or (rows <= broadcast_rows and rows * row_bytes <= BROADCAST_BYTES):
        local = vectors.toArrow().sort_by("item")
        return replace(index, shared=context.broadcast((local.column("item").combine_chunks(), vector_rows(local.column("v")))))
    chunks = cut_into_chunks(vectors, rows, len(features), chunk_rows, directory_entries)
    return replace(index, chunks=chunks, shared=context.broadcast(chunks.directory))


def top_k(
    profiles: DataFrame,
    index: ItemIndex,
    *,
    user: str = "user_id",
    k: int,
    exclude: DataFrame | None = None,
    positive_only: bool = False,
) -> DataFrame:
    """The k best items of every user: columns user, item, score, rank (from 1).

    `profiles` holds one row per user with the index's feature columns. `exclude` lists (user, item)
    pairs to leave out. Scores equal to TIE_DIGITS decimals rank by item key.
    """
    users = as_vectors(profiles, user, index.features, index.metric, index.on_missing, "user")
    seen = exclude and exclude.select(F.col(user).alias("user"), F.col(index.item.name).alias("item")).distinct()
    find = _scan if index.chunks is None else _search
    found = find(users, index, k, seen, positive_only)
    return found.withColumnsRenamed({"user": user, "item": index.item.name})


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _hidden(lists: pa.Array, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, place among `keys`) of the keys in each row's list; keys that are not there are passed over."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    rows = pc.list_parent_indices(lists).to_numpy()
    places = pc.index_in(lists.flatten(), value_set=keys)
    there = pc.is_valid(places).to_numpy(zero_copy_only=False)
    return rows[there], places.drop_null().to_numpy().astype(np.int64)


def _scan(users: DataFrame, index: ItemIndex, k: int, seen: DataFrame | None, positive_only: bool) -> DataFrame:
    """Stream the users past a broadcast catalogue."""
    catalogue, item, masked = index.shared, index.item.dataType.simpleString(), seen is not None
    if masked:
        # Only items of the catalogue count, so a user's list is bounded by it.
        known = seen.join(F.broadcast(index.vectors.select("item")), "item")
        users = users.join(known.groupBy("user").agg(F.collect_set("item").alias("seen")), "user", "left")
    spread = users.repartition(2 * partitions(users.sparkSession), "user")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, matrix = catalogue.value
        for batch in batches:
            hidden = _hidden(batch.column("seen"), keys) if masked else None
            vectors = vector_rows(batch.column("v"))
            for row, col, score, rank in best_matches(vectors, matrix, k, np.full(len(vectors), -np.inf), positive_only, hidden):
                yield pa.RecordBatch.from_pydict({
                    "user": batch.column("user").take(pa.array(row)), "item": keys.take(pa.array(col)),
                    "score": pa.array(score), "rank": pa.array(rank + 1, pa.int32()),
                })

    return spread.mapInArrow(scan, f"user {_kind(users, 'user')}, item {item}, score double, rank int")


# -- the clustered plan ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Asked:
    """Who asks for what in a round, packed: `rows` has one row per user and run of chunks, with the chunks' places in it."""

    rows: DataFrame
    chunks: Chunks

    def select(self, *columns: str) -> DataFrame:
        """The same with one row per user and `target`."""
        entry = self.chunks.entry_at(F.col("run"), F.col("place"))
        return self.rows.withColumn("place", F.explode("places")).withColumn("target", entry).select(*columns)


def _search(users: DataFrame, index: ItemIndex, k: int, seen: DataFrame | None, positive_only: bool) -> DataFrame:
    """Rounds of visits until no user has anything left to ask for."""
    chunks, item = index.chunks, index.item.dataType.simpleString()
    masks = _masks(chunks, seen)
    best = f"array<struct<loss:double,item:{item}>>"
    state = _numbered(users).withColumns({
        "best": F.expr(f"CAST(array() AS {best})"), "listed": F.expr("CAST(array() AS array<bigint>)"), "more": F.lit(0),
    })
    finished, turn, before = [], 0, None
    while True:
        path = scratch_path(users.sparkSession, "frontier")
        state = materialize_at(_planned(state, index, k, positive_only, turn), path, "finished")
        if before:
            # Who went on is in the new table; only the finished ones are read again.
            delete_folder(users.sparkSession, f"{before}/finished=false")
        before = path
        finished.append(state.filter("finished").select("user", "best"))
        active = state.filter("NOT finished").drop("finished")
        if not active.head(1):
            break
        asked = active.select("user", "v", "at", "block", "crowd", "floor", F.explode("open").alias("entry"))
        asked = Asked(asked.select("user", "v", "at", "block", "crowd", "floor", "entry.run", "entry.places"), chunks)
        state, turn = _merged(active, visited(asked, index, masks, k, positive_only, best), k), turn + 1
    done = finished[0]
    for part in finished[1:]:
        done = done.union(part)
    # A table of its own: written rows have no partitioning by user that would keep later joins from splitting a hot key.
    return done.select("user", F.posexplode("best").alias("place", "hit")).select(
        "user", "hit.item", (0.0 - F.col("hit.loss")).alias("score"), (F.col("place") + 1).alias("rank")
    )


def _masks(chunks: Chunks, seen: DataFrame | None) -> DataFrame | None:
    """Seen items per user and run; a list is bounded by the rows of a run."""
    if seen is None:
        return None
    placed = seen.join(chunks.members.select("item", chunks.run_of(F.col("target")).alias("run")), "item").select("user", "run", "item")
    if isinstance(seen.schema["user"].dataType, (T.StringType, T.IntegralType)):
        # Lists are cut from sorted rows: the engine's own list aggregate builds, packs and sorts each of them twice.
        ordered = placed.filter("user IS NOT NULL").repartition(partitions(seen.sparkSession), "user", "run").sortWithinPartitions("user", "run")
        masks = ordered.mapInArrow(_lists, f"user {_kind(placed, 'user')}, run bigint, mask array<{_kind(placed, 'item')}>")
    else:
        masks = placed.groupBy("user", "run").agg(F.collect_set("item").alias("mask"))
    # Joined by a shuffle as the members are: small files may hold a large table.
    return materialize(masks, "masks").hint("merge")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (user, run, item), sorted by the first two, to one row per user and run with the list of items."""
    kept = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if kept is None else [kept, batch]).combine_chunks().to_batches()
        if not rows:
            continue
        user, run = rows[0].column("user"), rows[0].column("run")
        change = pc.or_(pc.not_equal(user[1:], user[:-1]), pc.not_equal(run[1:], run[:-1])).to_numpy(zero_copy_only=False)
        starts = np.r_[0, np.flatnonzero(change) + 1]
        # The last list may go on in the next batch.
        if len(starts) > 1:
            yield _packed(rows[0], starts)
        kept = rows[0].slice(int(starts[-1]))
    if kept is not None:
        yield _packed(kept, np.array([0, kept.num_rows]))


def _packed(rows: pa.RecordBatch, edges: np.ndarray) -> pa.RecordBatch:
    at = pa.array(edges[:-1], pa.int64())
    lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rows.column("item").slice(0, int(edges[-1])))
    return pa.RecordBatch.from_arrays([rows.column("user").take(at), rows.column("run").take(at), lists], names=["user", "run", "mask"])


def _numbered(users: DataFrame) -> DataFrame:
    """Users in an order in which neighbours follow each other: `at` is the place, `block` and `crowd` stand for the places
    of so many in a row."""
    kind, crowd, block = _kind(users, "user"), CROWD, min(BLOCK, CROWD)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << NUMBER_BITS
        for batch in batches:
            places = at + np.arange(batch.num_rows)
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("v"), *(pa.array(places // n) for n in (1, block, crowd))],
                names=["user", "v", "at", "block", "crowd"],
            )

    stored = materialize(users.select(F.col("user").alias("item"), "v"), "users")
    rows = stored.count()
    width = stored.select(F.size("v")).head()
    placed = sort_by_place(stored, rows, width[0] if width else 1, NEIGHBOURS, max(1, -(-rows // (2 * CROWD))))
    return placed.mapInArrow(number, f"user {kind}, v array<double>, at bigint, block bigint, crowd bigint")


def _planned(state: DataFrame, index: ItemIndex, k: int, positive_only: bool, turn: int) -> DataFrame:
    """What each user asks for in the next round (`open`), from the floor: the last score of a full list.

    At an equal score only entries that start at or before the last key can hold a better item. A floor only rises, so
    what is closed once stays closed.
    """
    full, last = F.size("best") >= k, F.get("best", F.lit(k - 1))
    judged = state.withColumns({"floor": F.when(full, 0.0 - last["loss"]).otherwise(F.lit(float("-inf"))), "last": F.when(full, last["item"])})
    key, item = _kind(state, "user"), index.item.dataType.simpleString()
    schema = (
        f"user {key}, v array<double>, at bigint, block bigint, crowd bigint, best {_kind(state, 'best')}, floor double, "
        "listed array<bigint>, more int, open array<struct<run:bigint,places:array<int>>>"
    )
    columns = ["user", "v", "at", "block", "crowd", "best", "floor", "listed", "more", "last"]
    plan = _planning(index.shared, index.chunks.run_bits, positive_only, turn)
    planned = judged.select(*columns).mapInArrow(plan, schema)
    return planned.withColumn("finished", (F.size("open") == 0) & (F.col("more") < 0))


def _candidates(known: Directory, vectors: np.ndarray, floor: np.ndarray, turn: int) -> tuple[np.ndarray, float]:
    """Entries that can reach the lowest floor of these users, at first only the most promising, and the highest bound of
    those left out."""
    bounds = known.common_bounds(vectors)
    reach = np.flatnonzero(bounds >= floor.min() - 2 * HALF_TIE) if turn else np.arange(len(bounds))
    if turn >= len(CHOICE) or len(reach) <= CHOICE[turn]:
        return reach, -np.inf
    order = reach[np.argsort(-bounds[reach], kind="stable")]
    return np.sort(order[: CHOICE[turn]]), float(bounds[order[CHOICE[turn]]])


def _planning(shared: Broadcast, run_bits: int, positive_only: bool, turn: int):
    visits, open_most = VISITS[turn] if turn < len(VISITS) else None, MOST_OPEN

    def chosen(known: Directory, batch: pa.RecordBatch, ranks: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(user row, entry) by row, and where each user goes on: in the directory from there, or nowhere (-1)."""
        vectors, floor = vector_rows(batch.column("v")), batch.column("floor").to_numpy()
        more = batch.column("more").to_numpy().copy()
        going = np.flatnonzero((more >= 0) & vectors.any(axis=1)) if positive_only else np.flatnonzero(more >= 0)
        more[np.setdiff1d(np.arange(len(more)), going)] = -1
        entries, beyond = _candidates(known, vectors[going], floor[going], turn) if len(going) else (np.zeros(0, np.int64), -np.inf)
        found, few = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], known.subset(entries)
        listed = batch.column("listed")
        listed_row, listed_target = pc.list_parent_indices(listed).to_numpy(), listed.flatten().to_numpy()
        step = max(1, SCORES_PER_BLOCK // max(1, len(entries)))
        for start in range(0, len(going), step):
            rows = going[start : start + step]
            bounds = few.bounds(vectors[rows])
            tie = (bounds < (floor[rows] + HALF_TIE)[:, None]) & (ranks[entries][None] > lasts[rows][:, None])
            promising = (bounds >= (floor[rows] - HALF_TIE)[:, None]) & ~tie
            if positive_only:
                promising &= bounds > 0.0
            old = np.isin(listed_row, rows)
            place = np.searchsorted(few.target, listed_target[old])
            there = place < len(entries)
            there[there] = few.target[place[there]] == listed_target[old][there]
            promising[np.searchsorted(rows, listed_row[old][there]), place[there]] = False
            if visits is None:
                promising &= entries[None] >= more[rows][:, None]
                left = promising.sum(axis=1) > open_most
                promising &= np.cumsum(promising, axis=1) <= open_most
                furthest = np.where(promising.any(axis=1), entries[len(entries) - 1 - promising[:, ::-1].argmax(axis=1)] if len(entries) else 0, 0)
                more[rows] = np.where(left, furthest + 1, -1)
                row, col = np.nonzero(promising)
            else:
                if turn:
                    more[rows] = np.where((promising.sum(axis=1) > visits) | (beyond >= floor[rows] - 2 * HALF_TIE), 0, -1)
                bounds[~promising] = -np.inf
                most = min(visits, len(entries))
                least = np.partition(bounds, len(entries) - most, axis=1)[:, len(entries) - most] if most else np.zeros(len(rows))
                row, col = np.nonzero((bounds >= least[:, None]) & promising)
                # Of equal bounds the first entries, which hold the first of the copies of a vector.
                by = np.lexsort((col, -bounds[row, col], row))
                row, col = row[by], col[by]
                kept = np.arange(len(row)) - np.searchsorted(row, row) < visits
                row, col = row[kept], col[kept]
            by = np.lexsort((col, row))
            found.append((rows[row[by]], entries[col[by]]))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), more

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        keys = known.first_key.to_pylist()
        order = sorted(range(len(keys)), key=keys.__getitem__)
        # Entries by rank of their first key; a user's last key stands between ranks.
        ranks, ordered = np.empty(len(keys), np.int64), [keys[i] for i in order]
        ranks[order] = np.searchsorted(np.array(ordered, object), np.array(ordered, object)) if keys else []
        ordered = np.array(ordered, object)
        for whole in batches:
            last = whole.column("last").to_pylist()
            lasts = np.array([len(keys) if x is None else np.searchsorted(ordered, x, "right") - 1 for x in last], np.int64)
            for start in range(0, whole.num_rows, NEIGHBOURS):
                batch = whole.slice(start, NEIGHBOURS)
                row, entry, more = chosen(known, batch, ranks, lasts[start : start + NEIGHBOURS])
                target = known.target[entry]
                run, place = target >> run_bits, target & ((1 << run_bits) - 1)
                fresh = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (row[1:] != row[:-1])]) if len(row) else np.zeros(0, np.int64)
                places = pa.ListArray.from_arrays(pa.array(np.r_[fresh, len(row)], pa.int32()), pa.array(place, pa.int32()))
                runs = pa.StructArray.from_arrays([pa.array(run[fresh], pa.int64()), places], ["run", "places"])
                edges = pa.array(np.searchsorted(row[fresh], np.arange(batch.num_rows + 1)), pa.int32())
                names = ["user", "v", "at", "block", "crowd", "best", "floor"]
                # Chunks asked for in the directory's order are behind `more`.
                listed = batch.column("listed")
                if visits is not None:
                    parents = np.r_[pc.list_parent_indices(listed).to_numpy(), row]
                    values = np.r_[listed.flatten().to_numpy(), target]
                    by = np.argsort(parents, kind="stable")
                    listed = pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(parents[by], np.arange(batch.num_rows + 1)), pa.int32()), pa.array(values[by], pa.int64())
                    )
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in names), listed, pa.array(more, pa.int32()), pa.ListArray.from_arrays(edges, runs)],
                    names=[*names, "listed", "more", "open"],
                )

    return plan


def _merged(active: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """Users with what a round has found for them, in the order of their places."""
    own = ["v", "at", "crowd", "listed", "more"]
    rest = active.select("block", "user", "best", *own)
    blank = [F.lit(None).cast(_kind(rest, n)).alias(n) for n in own]
    both = rest.unionByName(hits.select("block", "user", "best", *blank)).repartition(partitions(active.sparkSession), "block")
    first = [F.first(n, ignorenulls=True).alias(n) for n in own]
    merged = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k)
    return both.groupBy("block", "user").agg(*first, merged.alias("best")).sortWithinPartitions("block", "at")


def visited(asked: Asked, index: ItemIndex, masks: DataFrame | None, k: int, positive_only: bool, best: str) -> DataFrame:
    """(user, block, best): for every user and run asked for, the k best items of the chunks asked for that reach the floor."""
    chunks, tasks = index.chunks, partitions(asked.rows.sparkSession)
    left = asked.rows
    if masks is not None:
        left = left.join(masks, ["user", "run"], "left")
    wanted = asked.select("crowd", "target").distinct().groupBy(F.col("target").alias("entry")).agg(F.collect_list("crowd").alias("crowds"))
    members = chunks.members.withColumn("entry", chunks.entry_of(F.col("target"))).join(wanted, "entry")
    right = members.select(F.explode("crowds").alias("crowd"), "item", "v", chunks.run(F.col("entry")).alias("run"), chunks.place(F.col("entry")).alias("place"))
    schema = f"user {_kind(left, 'user')}, block bigint, best {best}"
    return (
        left.repartition(tasks, "crowd", "run").groupBy("crowd", "run")
        .cogroup(right.repartition(tasks, "crowd", "run").groupBy("crowd", "run"))
        .applyInArrow(_matches(k, positive_only, masks is not None), schema)
    )


def _matches(k: int, positive_only: bool, masked: bool):
    """The users of a group with the items of the chunks they asked for: one row with at most k hits per user."""

    def run(_, asked: pa.Table, members: pa.Table) -> pa.Table:
        members = members.sort_by([("place", "ascending"), ("item", "ascending")])
        keys, items = members.column("item").combine_chunks(), vector_rows(members.column("v"))
        vectors, floor = vector_rows(asked.column("v")), asked.column("floor").to_numpy()
        hide = _hidden(asked.column("mask"), keys) if masked and asked.num_rows else None
        lists = asked.column("places").combine_chunks() if asked.num_rows else pa.array([], pa.list_(pa.int32()))
        who, place = pc.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy()
        by = np.lexsort((who, place))
        who, place = who[by], place[by]
        chunks, start = np.unique(place, return_index=True)
        begin, end = (np.searchsorted(members.column("place").to_numpy(), chunks, side) for side in ("left", "right"))
        if hide is not None:
            # By place: those of a chunk follow each other, by user, and are found without a look at all others.
            chunk = np.searchsorted(end, hide[1], "right")
            order = np.lexsort((hide[0], chunk))
            hide = hide[0][order], hide[1][order]
            edges = np.searchsorted(chunk[order], np.arange(len(chunks) + 1))
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for number, (first, past, low, high) in enumerate(zip(start, np.r_[start, len(who)][1:], begin, end, strict=True)):
            rows = who[first:past]
            hidden = None
            if hide is not None:
                hidden_row, hidden_col = (h[edges[number] : edges[number + 1]] for h in hide)
                mine = np.isin(hidden_row, rows) & (hidden_col >= low)
                hidden = np.searchsorted(rows, hidden_row[mine]), hidden_col[mine] - low
            for row, col, score, _ in best_matches(vectors[rows], items[low:high], k, floor[rows], positive_only, hidden):
                parts.append((rows[row], col + low, score))
        row, col, score = (np.concatenate([p[i] for p in parts]) for i in range(3))
        # Equal scores rank by key, and the items of one chunk only are in order of their keys.
        rank = np.empty(len(keys), np.int64)
        rank[pc.sort_indices(keys).to_numpy()] = np.arange(len(keys))
        order = np.lexsort((rank[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < k
        row, col, score = row[kept], col[kept], score[kept]
        found, first = np.unique(row, return_index=True)
        hits = pa.StructArray.from_arrays([pa.array(0.0 - score, pa.float64()), keys.take(pa.array(col, pa.int64()))], ["loss", "item"])
        lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(row)], pa.int32()), hits)
        told = asked.select(["user", "block"]).take(pa.array(found, pa.int64()))
        return told.append_column("best", lists)

    return run
