"""Mixing, range coder, token files, language-model scores and the pipeline."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from encore.llm import mixscore, rangecoder, tokenfiles
from encore.llm.mixing import _play, mix_sources, mixed_copies
from encore.llm.tokenfiles import token_table, tokenizer_path, write_token_files
from encore.storage import scratch_path


def plain_targets(sizes, weights=(1, 2, 3)):
    """Reshare the excess by weight until none is above three times its source."""
    names = sorted(sizes, key=lambda n: (n is None, n))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[n] for n in open_)
        above = {n for n in open_ if left * weight[n] / total > 3 * sizes[n]}
        if not above:
            target.update({n: left * weight[n] / total for n in open_})
            break
        target.update({n: 3.0 * sizes[n] for n in above})
        open_ -= above
        left -= sum(3.0 * sizes[n] for n in above)
    return target


def test_mix(spark):
    random_ = np.random.default_rng(4)
    rows = [(i, ["a", "b", "c", "d", None][min(4, int(random_.integers(0, 40)) ** 2 // 300)], int(random_.integers(0, 300))) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long")
    first = {r["doc_id"]: r for r in mix_sources(docs, size="words", leaf_rows=200, fan_in=4).collect()}
    again = {r["doc_id"]: r for r in mix_sources(docs.repartition(5), size="words", leaf_rows=200, fan_in=4).collect()}
    assert {k: r["copies"] for k, r in first.items()} == {k: r["copies"] for k, r in again.items()}
    sizes, taken = collections.Counter(), collections.Counter()
    for _, source, words in rows:
        sizes[source] += words
    want = plain_targets(sizes)
    for r in first.values():
        assert 0 <= r["copies"] <= 3 and r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-12)
        taken[r["source"]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - want[s]) <= 300 for s in sizes)


def test_mix_is_fair():
    """Every document keeps its chance on average, and the words of a leaf stay what they were."""
    random_ = np.random.default_rng(1)
    sizes = np.sort(random_.integers(1, 500, 60))[::-1].astype(float)
    chances = random_.random(60)
    total = np.zeros(60)
    for _ in range(3000):
        won, holder, left = _play(chances, sizes, random_.random(120))
        drawn = won.astype(float)
        if holder >= 0:
            drawn[holder] = left
        assert abs(drawn @ sizes - chances @ sizes) < 1e-6
        total += drawn
    assert abs(total / 3000 - chances).max() < 0.05


def test_mix_edges(edges, nothing):
    rows = mix_sources(edges).collect()
    assert len(rows) == edges.count()
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    copies = mixed_copies(edges)
    assert copies.count() == sum(r["copies"] for r in rows) and copies.schema.simpleString() == edges.schema.simpleString()
    assert {str(r) for r in copies.collect()} <= {str(r) for r in edges.collect()}
    assert mix_sources(nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 65535), st.integers(0, 3)), max_size=600))
def test_range_coder_round_trip(ids):
    assert rangecoder.decode(rangecoder.encode(np.array(ids, np.int64))).tolist() == ids


def test_range_coder_tells_ids_by_the_ones_before():
    """Every id has four followers, of which one is likelier: order 1 knows it (1.8 bits), order 0 does not (8 bits)."""
    random = np.random.default_rng(5)
    followers = random.integers(0, 256, (256, 4))
    choice, ids = random.choice(4, 200_000, p=[0.55, 0.2, 0.15, 0.1]), np.zeros(200_000, np.int64)
    for i in range(1, len(ids)):
        ids[i] = followers[ids[i - 1], choice[i]]
    block = rangecoder.encode(ids)
    assert (rangecoder.decode(block) == ids).all()
    assert 8 * len(block) / len(ids) < 3.0


def test_range_coder_beats_order_0_and_a_general_compressor(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id")
    encoder = Tokenizer.from_file(tokenizer_path())
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    ids = np.concatenate([np.array([*e.ids, 2]) for e in encoder.encode_batch(texts, add_special_tokens=False)])
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    bits = 8 * len(rangecoder.encode(ids)) / len(ids)
    assert bits < 7.0 and bits < -(share * np.log2(share)).sum() - 1.3
    assert bits < 8 * len(zstandard.compress(ids.astype("<u2").tobytes(), 9)) / len(ids)


def test_range_coder_adapts_and_checks():
    random_ = np.random.default_rng(0)
    pattern = np.tile(random_.integers(0, 49_408, 50), 4000)
    assert len(rangecoder.encode(pattern)) < len(pattern) * 2 / 8
    skewed = np.minimum(random_.zipf(1.5, 200_000), 60_000)
    block = rangecoder.encode(skewed)
    assert (rangecoder.decode(block) == skewed).all() and len(block) < 1.1 * len(skewed)
    for at in (0, 10, 30, len(block) // 2, len(block) - 1):
        with pytest.raises(ValueError):
            rangecoder.decode(block[:at] + bytes([block[at] ^ 4]) + block[at + 1 :])
    with pytest.raises(ValueError):
        rangecoder.decode(block[:-5])
    with pytest.raises(ValueError):
        rangecoder.encode(np.array([65536]))


def plain_tokens(rows):
    tokenizer, start, out = Tokenizer.from_file(tokenizer_path()), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


TEXTS = [
    "It's don't 'S abc. (x) a.b.c! U.S.A 12ab3 1,000 Éa É! e\u0301 E\u0301. J\u030c J\u030c, ǰ İstanbul ẞ ŉ \u0130. ΑΣ Σ. naïve—dash “q” …",
    "<|endoftext|>x <|startoftext|>. a<|endoftext|> \x01 a\x01b \x00 \u200d \ufeff", "ß. STRASSE. \u00a0x\u00a0 y\u2028z 日本語。テスト! 🙂🙂. 🙂a",
    "don't. we'll! x' y'' '' z's", "ﬁ ﬃ. Ǆ ǅ ǆ ª º ² ½ Ⅳ x² Å Å",
]


def test_token_files(spark, edges, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()] + [(10 + i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in token_table(docs).orderBy("start").collect()]
    assert found == plain_tokens(rows)
    assert token_table(nothing).count() == 0


def test_token_files_of_many_blocks(spark):
    rows = [(i, f"word{i % 7} and {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = scratch_path(spark, "test-tokens")
    write_token_files(docs, folder, block_ids=100)
    from encore.llm.tokenfiles import token_index

    assert [tuple(r) for r in token_index(spark, folder).orderBy("start").collect()] == plain_tokens(rows)
    assert spark.read.parquet(folder).count() > 20


def test_node_counts():
    import pyarrow as pa

    words = sorted(["a", "ab", "abc", "b", "ü", "zz", "ba", "\n"], key=str.encode)
    counts = np.arange(1, len(words) + 1)
    tokens = mixscore.Tokens.of(pa.array(words, pa.large_string()), counts)
    found = mixscore.node_counts(tokens)
    coded = [w.encode() + b"\0" for w in words]
    for row, word in enumerate(coded):
        for depth, symbol in enumerate(word):
            for bit in range(8):
                alike = [
                    (c, w) for c, w in zip(counts, coded, strict=True)
                    if len(w) > depth and w[:depth] == word[:depth] and w[depth] >> (8 - bit) == symbol >> (8 - bit)
                ]
                ones = sum(c for c, w in alike if w[depth] >> (7 - bit) & 1)
                at = tokens.starts[row] + depth
                assert found[at, bit].tolist() == [sum(c for c, _ in alike) - ones, ones]


WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_base(rows):
    texts = [(k, [*WORD.findall((t or "").translate(LOWER)), "\n"]) for k, t in rows]
    train = [w for k, words in texts if k is None or zlib.crc32(str(k).encode()) % 10 for w in words]
    counts = collections.Counter(train)
    total, distinct = len(train), len(counts)
    return collections.Counter(
        (k, len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w), 6))
        for k, w in texts
    )


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(mixscore, "RANGE_TOKENS", 3000)  # several ranges
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = mixscore.score_texts(docs).toPandas()
    want = plain_base([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = collections.Counter(zip(rows.doc_id, rows.n_tokens, rows.n_known, rows.train_tokens, rows.base_score.round(6), strict=True))
    assert got == want
    assert (rows.score < 0).all()
    assert rows.score.sum() > rows.base_score.sum()
    assert (rows.score > rows.base_score - np.log10(4) - 1e-9)[rows.n_known == rows.n_tokens].all()
    # The base gives a new token more than its letters cost.
    assert (rows.score > rows.base_score)[rows.n_known == rows.n_tokens].mean() >= 0.8


def test_scores_of_held_out_texts(spark):
    rows = mixscore.score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    held, known = rows[rows.held_out], rows[rows.n_known == rows.n_tokens]
    assert held.score.sum() > held.base_score.sum() + 0.5 * held.n_tokens.sum()
    assert (known.score > known.base_score).mean() >= 0.9


def walks(chance, count):
    """Texts in which each of 60 words has three followers."""
    texts = []
    for _ in range(count):
        word, text = chance.randrange(60), []
        for _ in range(80):
            text.append(f"w{word}")
            word = (word * 7 + chance.choice([1, 13, 29])) % 60
        texts.append(text)
    return texts


def test_word_order_counts(spark):
    """No text repeats another, yet texts in order score above the same words in another order."""
    chance = random.Random(5)
    held = [k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0][:40]
    rows = [(k, " ".join(t)) for k, t in zip([k for k in range(1000) if zlib.crc32(str(k).encode()) % 10][:200], walks(chance, 200), strict=True)]
    texts = walks(chance, 20)
    rows += [(k, " ".join(t)) for k, t in zip(held[:20], texts, strict=True)]
    rows += [(k, " ".join(chance.sample(t, len(t)))) for k, t in zip(held[20:], texts, strict=True)]
    scored = {r["doc_id"]: r for r in mixscore.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for ordered, mixed in zip(held[:20], held[20:], strict=True):
        assert scored[ordered]["base_score"] == pytest.approx(scored[mixed]["base_score"])
        assert scored[ordered]["score"] > scored[mixed]["score"] + 20
        assert scored[ordered]["score"] > scored[ordered]["base_score"] + 40
    # Three followers of equal chance: near half a digit a word.
    assert np.mean([scored[k]["score"] / scored[k]["n_tokens"] for k in held[:20]]) > -0.6


def block_of(number, texts, held):
    import pyarrow as pa
    import zstandard

    words = sorted({w for t in texts for w in t})
    codes = np.array([c for t in texts for c in [*(words.index(w) for w in t), len(words)]], np.int32)
    return pa.RecordBatch.from_pydict({
        "block": pa.array([number]), "tokens": pa.array([[*words, "\n"]]), "held": pa.array([held]),
        "lengths": pa.array([[len(t) + 1 for t in texts]]), "codes": pa.array([zstandard.compress(codes.tobytes())], pa.binary()),
    })


def test_pairs_of_all_blocks_are_counted():
    import pyarrow as pa

    chance = random.Random(6)
    texts = [[f"v{chance.randrange(9)}" for _ in range(chance.randrange(12))] for _ in range(40)]
    held = [chance.random() < 0.3 for _ in texts]
    plain = collections.Counter(
        pair for text, out in zip(texts, held, strict=True) if not out for pair in zip(["", *text], [*text, "\n"], strict=True)
    )
    blocks = [block_of(n, texts[n * 10 : n * 10 + 10], held[n * 10 : n * 10 + 10]) for n in range(4)]
    table = pa.Table.from_batches(list(mixscore._pairs(3)(iter(blocks))))
    summed = pa.concat_tables([mixscore._sum_pairs(table.filter(pa.compute.equal(table["part"], p))) for p in range(8)])
    for n, block in enumerate(blocks):
        mine = summed.filter(pa.compute.equal(summed["block"], n)).sort_by("part")
        totals = np.concatenate([mixscore.unpacked_planes(v.as_py(), 8) for v in mine["totals"]])
        names, edges, _ = mixscore._names_of(block, 0)
        got = totals[np.unique(names, return_inverse=True)[1]]
        want = [plain[pair] for text in texts[n * 10 : n * 10 + 10] for pair in zip(["", *text], [*text, "\n"], strict=True)]
        assert got.tolist() == want and len(edges) == 11


def test_every_token_is_counted_after_three_others():
    """Predictions of all tokens of all texts, against plain counts of all tokens of training's other texts."""
    import pyarrow as pa

    chance = random.Random(8)
    texts = [[f"v{chance.randrange(3)}" for _ in range(chance.randrange(14))] for _ in range(40)]
    held = [chance.random() < 0.3 for _ in texts]
    words = np.array(["v0", "v1", "v2", "\n"])
    codes = dict(zip(words, mixscore.word_hashes(pa.array(words, pa.large_string())), strict=True))
    told = {w: max(int(codes[w]) >> 48, 1) for w in words}
    padded = [["<3", "<2", "<1", *t, "\n"] for t in texts]
    plain = collections.defaultdict(collections.Counter)
    for text, out in zip(padded, held, strict=True):
        for at in range(3, len(text)):
            plain[tuple(text[at - 3 : at])][text[at]] += not out
    blocks = [block_of(n, texts[n * 10 : n * 10 + 10], held[n * 10 : n * 10 + 10]) for n in range(4)]
    table = pa.Table.from_batches(list(mixscore._grams(3)(iter(blocks))))
    summed = pa.concat_tables([mixscore._sum_grams(table.filter(pa.compute.equal(table["part"], p))) for p in set(table["part"].to_pylist())])
    for n, block in enumerate(blocks):
        mine = summed.filter(pa.compute.equal(summed["block"], n)).sort_by("part")
        followers = np.concatenate([mixscore.unpacked_planes(v.as_py(), 8).reshape(3, -1) for v in mine["totals"]], axis=1)
        hashes, edges, out = mixscore._hashes_of(block, 0)
        grams = mixscore.grams_of(hashes, edges)
        found = followers[:, mixscore.in_order(grams >> np.uint64(16))]
        cell, hit = mixscore.continued(found, grams, np.repeat(~out, np.diff(edges)), edges)
        want_cell, want_hit = [], []
        for text, is_held in zip(padded[n * 10 : n * 10 + 10], out, strict=True):
            run, before = 0, 0
            for at in range(3, len(text)):
                counts = plain[tuple(text[at - 3 : at])] - (collections.Counter() if is_held else collections.Counter([text[at]]))
                best, times = max(counts.items(), key=lambda c: (c[1], told[c[0]]), default=("", 0))
                share = times / max(counts.total(), 1)
                kind = min(int(math.log2(max(times, 1))), 3) * 4 + sum(share >= s for s in (0.999, 0.5, 0.15))
                want_cell.append((kind * mixscore.RUN + run) * 3 + before if times else -1)
                want_hit.append(times > 0 and best == text[at])
                run, before = min(run + 1, mixscore.RUN - 1) if want_hit[-1] else 0, (times > 0) + want_hit[-1]
        assert hit.tolist() == want_hit and cell.tolist() == want_cell


def test_short_copies_are_predicted(spark):
    """Words follow each other by chance, so only the three words before tell the next one, and only in a copy. Half of the
    training texts occur twice. All lie in one block, which is scored in several slices."""
    chance = random.Random(9)
    texts = [" ".join(f"w{chance.randrange(25)}" for _ in range(11)) for _ in range(250)]
    train = [k for k in range(5000) if zlib.crc32(str(k).encode()) % 10][:200]
    held = [k for k in range(5000) if zlib.crc32(str(k).encode()) % 10 == 0][:100]
    rows = [*zip(train, [*texts[:100], *texts[:50], *texts[:50]], strict=True), *zip(held, [*texts[:50], *texts[200:]], strict=True)]
    rows += [(k, "") for k in range(5000, 5000 + 2 * mixscore.SLICE_TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    scored = {r["doc_id"]: r for r in mixscore.score_texts(docs).collect()}
    gains = [scored[k]["score"] - scored[k]["base_score"] for k in held]
    assert min(gains[:50]) > max(gains[50:])


def test_followers():
    cell, hit, share = mixscore.followed(np.array([2, 0, 3, 1, 5]), np.array([4, 0, 3, 2, 8]), np.array([0, 3, 5]))
    assert hit.tolist() == [True, False, True, True, True]
    assert cell.tolist() == [2 * 4, -1, 1 * 4 + 1, 1 * 4, 3 * 4 + 2]
    assert share[hit] == pytest.approx(np.log10([2 / 4, 1, 1 / 2, 5 / 8]))


def test_planes():
    values = np.array([0, 1, 255, 256, (1 << 48) - 1], np.uint64)
    assert (mixscore.unpacked_planes(mixscore.packed_planes(values, 6), 6) == values).all()
    assert len(mixscore.unpacked_planes(mixscore.packed_planes(values[:0], 6), 6)) == 0


def test_scores_do_not_depend_on_blocks(spark):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    source = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10)
    text = " ".join(f"w{i * i % 701}" for i in range(600))
    parts = [spark.createDataFrame([(k, text)], "doc_id long, text string").coalesce(1) for k in (source, held)]
    apart = parts[0].union(parts[1])
    scores = [{r["doc_id"]: r["score"] for r in mixscore.score_texts(d).collect()} for d in (apart, apart.coalesce(1))]
    assert scores[0] == pytest.approx(scores[1], abs=1e-6)
    assert scores[0][held] > scores[0][source]  # the copy is predicted, the source is not


def test_probabilities_of_all_continuations_add_up():
    import pyarrow as pa

    words = sorted(["the", "then", "than", "a", "\n"], key=str.encode)
    tokens = mixscore.Tokens.of(pa.array(words, pa.large_string()), np.array([5, 9, 2, 1, 4]))
    table = np.zeros((mixscore.ORDERS, 1 << mixscore.TABLE_BITS, 2), np.float32)
    counts = mixscore.by_bit(mixscore.node_counts(tokens))
    mixer, _ = mixscore.fit(tokens, counts, table, 1)
    # A bit and its opposite at one node share all inputs, so the chances of both add up to one.
    odds = mixscore.log_odds(table[:, :, 0], table[:, :, 1])
    x, gate, _ = mixscore.inputs_of(tokens, counts, odds, np.arange(len(tokens.symbols)), mixscore.contexts(tokens), 3, None)
    p = mixer.refine(np.clip(mixer.mix(x, gate), 1e-7, 1 - 1e-7), gate)
    assert ((p > 0) & (p < 1)).all()


def test_score_edges(edges, nothing):
    rows = mixscore.score_texts(edges).collect()
    assert len(rows) == edges.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {1}
    assert all(np.isfinite(r["score"]) for r in rows)
    assert mixscore.score_texts(nothing).count() == 0


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, folder)
        assert after.columns == docs.columns, name
        before = corpus_pipeline.materialize(after, "test")
    want = plain_tokens([(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()])
    assert [tuple(r) for r in corpus_pipeline.run(spark, folder).orderBy("start").collect()] == want


def test_pipeline_edges(spark, edges, nothing, labels, tmp_path):
    """Every stage hands on whole rows of its input, columns of clashing names included; the last one equals plain tokens."""
    clashing = edges.withColumns({"target": F.col("text"), "_size": F.lit("s"), "_key": F.lit(1.5), "row": F.lit("r"), "told": F.lit(2), "_source": F.lit(None).cast("string")})
    for docs, name in ((clashing, "edges"), (nothing, "nothing")):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "over the lazy dog near the river")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        before = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, function in corpus_pipeline.STAGES[:-1]:
            after = corpus_pipeline.materialize(function(spark, before, folder), "test")
            assert after.schema.simpleString() == docs.schema.simpleString(), stage
            given, got = (collections.Counter(map(str, f.collect())) for f in (before, after))
            times = 3 if stage.startswith("mixing") else 1
            assert all(got[r] <= times * given[r] for r in got), stage
            if stage.startswith("SimHash"):
                assert len(got) == before.select(F.coalesce("text", F.lit(""))).distinct().count() - (name == "edges" and given.total() > 2)
            if stage.startswith("mixing"):
                before_words = before.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
                after_words = after.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
                assert after_words <= 3 * before_words
            before = after
        want = plain_tokens([(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect() if r["doc_id"] is not None])
        got = [tuple(r) for r in corpus_pipeline.run(spark, folder).orderBy("start").collect() if r["doc_id"] is not None]
        assert sorted(r[0] for r in got) == sorted(r[0] for r in want)
        assert corpus_pipeline.run(spark, folder).count() == before.count()


def test_mix_of_equal_rows(spark):
    """Two thirds of all rows have no key and one size: they are spread over leaves, and the words come out right."""
    rows = [(None, "a", 7)] * 4000 + [(i, "b", i % 90) for i in range(1500)] + [(i, None, 11) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long")
    mixed = mix_sources(docs, size="words", leaf_rows=100, fan_in=4)
    assert mixed.count() == 6000
    taken = {r["source"]: (r["n"], r["target"]) for r in mixed.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("n"), F.first("target").alias("target")).collect()}
    assert all(abs(n - target) <= 90 for n, target in taken.values())
    assert mixed.agg(F.max("copies")).first()[0] <= 3


def test_one_query_per_operator():
    from encore.llm.queries import QUERIES

    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_known_words_are_looked_up_once_for_words_and_marks(monkeypatch):
    asked, look_up = [], tokenfiles._ids_of_words
    monkeypatch.setattr(tokenfiles, "_ids_of_words", lambda words, path: asked.append(len(words)) or look_up(words, path))
    path = tokenfiles.tokenizer_path()
    texts = ["plain words, and marks!", "", "!? (more) words."]
    edges, ids = tokenfiles.token_ids(pa.array(texts, pa.large_string()), path)
    whole = [tokenfiles._tokenizer(path).encode(t, add_special_tokens=False).ids + [tokenfiles.END_ID] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == whole
    assert len(asked) == 1


def test_tokens_of_blocks_travel_as_lists():
    """A block's tokens get their numbers in training and their costs back in the order of its list, one row per part."""
    import pyarrow as pa

    chance = random.Random(10)
    blocks = []
    for number in range(3):
        words = [*{f"v{chance.randrange(400)}" for _ in range(200)}, "\n"]
        counts = [chance.randrange(4) for _ in words]
        blocks.append(pa.RecordBatch.from_pydict({"block": pa.array([number]), "tokens": pa.array([words]), "counts": pa.array([counts])}))
    plain = collections.Counter()
    for block in blocks:
        plain.update(dict(zip(block["tokens"][0].as_py(), block["counts"][0].as_py(), strict=True)))
    dealt = pa.Table.from_batches(list(mixscore._words(3)(iter(blocks))))
    assert len(dealt) <= 3 * 8
    seen, priced = set(), []
    for part in range(8):
        numbered = mixscore._number_words(dealt.filter(pa.compute.equal(dealt["part"], part)))
        words, counts = numbered["words"][0].as_py(), numbered["counts"][0].as_py()
        assert dict(zip(words, counts, strict=True)) == {w: plain[w] for w in words} and not seen & set(words)
        seen |= set(words)
        place = chance.sample(range(len(words)), len(words))  # costs come back in any order
        scored = pa.table({"place": pa.array(place, pa.int32()), "count": [counts[p] for p in place], "cost": [-float(words[p][1:] or 0.5) for p in place]})
        priced.append(mixscore._price_words(numbered.slice(1), scored))
    assert seen == set(plain)
    priced = pa.concat_tables(priced)
    for number, block in enumerate(blocks):
        mine = priced.filter(pa.compute.equal(priced["block"], number)).sort_by("part")
        values = np.concatenate([mixscore.unpacked_planes(v.as_py(), 8).reshape(2, -1) for v in mine["totals"]], axis=1)
        order, _ = mixscore.dealt(block["tokens"][0].values, 3)
        words = [block["tokens"][0].values[int(i)].as_py() for i in order]
        assert values[0].tolist() == [plain[w] for w in words]
        assert values[1].view(np.float64).tolist() == [-float(w[1:] or 0.5) for w in words]


def test_blocks_are_small(spark):
    """Two tasks with a block each must leave room in an executor of 3 GB."""
    docs = spark.range(24, numPartitions=1).selectExpr("id AS key", "false AS held", "repeat(concat('w', id, ' '), 400000) AS text")
    schema = "block long, tokens array<string>, distinct long, trained long, counts array<long>, keys array<long>, held array<boolean>, lengths array<long>, codes binary"
    rows = docs.mapInArrow(mixscore._blocks, schema).select("trained", "lengths").collect()
    assert max(r["trained"] for r in rows) <= 5_500_000 and sum(len(r["lengths"]) for r in rows) == 24


def test_names_in_order():
    """Names that differ only in the bits that give way for places, among many that differ above."""
    chance = np.random.default_rng(4)
    for names in (
        (chance.integers(0, 1 << 20, 300_000).astype(np.uint64) << np.uint64(28)) | chance.integers(0, 8, 300_000).astype(np.uint64),
        chance.integers(0, 1 << 48, 70_000).astype(np.uint64), np.full(9, 7, np.uint64), np.zeros(0, np.uint64),
        chance.integers(0, 1 << 63, 5_000).astype(np.uint64),
    ):
        order, ordered = mixscore.ordered_names(names)
        assert (ordered == np.sort(names)).all() and (names[order] == ordered).all() and len(set(order.tolist())) == len(names)
        assert (mixscore.in_order(names) == np.unique(names, return_inverse=True)[1]).all()


def test_workers_return_memory_after_a_group():
    def rss():
        return int(next(line for line in open("/proc/self/status") if line.startswith("VmRSS")).split()[1]) / 1024

    def run(group, other):
        pieces = [np.full(1 << 14, 1.0) for _ in range(1500)]  # 188 MB
        held.append(pieces[-1].copy())  # lies above them, so they are not returned by themselves
        return group

    held = []
    run(None, None)
    mixscore.given_back(run)(None, None)
    before = rss()
    mixscore.given_back(run)(None, None)
    assert rss() < before + 40
