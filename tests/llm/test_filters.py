"""URL rules, secrets, decontamination, quality and toxicity."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from encore.llm.decontaminate import MASKS, contaminated, decontaminate, needed, short_masks
from encore.llm.quality import score_quality, train
from encore.llm.secrets import CONTEXT, find_secrets
from encore.llm.sql import ORACLE
from encore.llm.toxicity import fit_ordinal, graded, score_toxicity
from encore.llm.urls import RULES, judge_urls, rules_frame
from tests.compare import difference, duck_connection

FOLDER = "/root/testdata/sf0.001"


def test_masks_find_any_two_substitutions():
    for a in range(13):
        for b in range(a):
            assert any(
                not {a, b} & {at + i for i, used in enumerate(mask) if used == "1"}
                for mask in MASKS for at in range(13 - len(mask) + 1)
            )


def plain_rule(host, path):
    fits = [
        (len(h + p), len(h), v == "block", h + p, v) for h, p, v in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[3:] if fits else (None, "allow")


URLS = [
    None, "", "no scheme", "http://", "http://NET/", "http://a.NET/x", "https://example.net/en/1?q#f", "https://www.example.net/en", "ftp://example.com/de/x",
    "http://xexample.com/de/", "http://a.org/fr/", "http://org/fr/x?y", "http://a.org#/fr/", "http://b.net?x", "://net/", "http://É.net/", "http://a..net/",
    "http://" + "a." * 3000 + "net/" + "x/" * 3000, "http://u@h.net:80/", "x://y://net/z", "http://net./",
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string, verdict string")
    rows = judge_urls(pages, rules_frame(spark)).collect()
    assert len(rows) == len(URLS) + 3
    for r in rows:
        rest = re.split("://", r["url"], maxsplit=1)[1] if r["url"] and "://" in r["url"] else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, *plain_rule(host, path))
    assert judge_urls(pages.filter("false"), rules_frame(spark)).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, rules_frame(spark).filter("false")).collect()} == {"allow"}


def test_url_query_equals_sql(spark):
    from encore.llm.queries import QUERIES

    rows = QUERIES["op7_url_rules"](spark, FOLDER).toPandas()
    assert difference(rows, duck_connection(FOLDER).execute(ORACLE["op7_url_rules"]).df()) == ""


def plain_spans(text):
    spans = []
    for m in re.finditer(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 12:
            spans.append((m.start(), 0, m.end(), "assign"))
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)]


SECRETS = [
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "PASSWORD:short", "api_key='abcdefghijkl'", "apikey=abcdefghijk", "toKen=abcdefghijkl",
    "AKIAABCDEFGHIJKLMN AKIA12", "xAKIAABCDEFGHIJKLMNa", "ééé secret  :  abcdefghijklmnop ünd 0123456789abcdef", "0123456789abcdeg", "to\u212aen=abcdefghijklmnop",
    "passwd=token=abcdefghijklmnopqrstuvwxyz", "secret: token : abcdefghijklmnop", "a" * 100_000, "",
]


def test_base_spans(spark, edges, nothing):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(SECRETS)] + [(99, None)], "doc_id long, text string")
    for r in find_secrets(docs).collect():
        text = (SECRETS + [""])[min(r["doc_id"], len(SECRETS))]
        base = plain_spans(text)
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("novel")] == base
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")]
    assert find_secrets(edges).count() == edges.count()
    assert find_secrets(nothing).count() == 0


def test_novel_strings(spark):
    prose = "auth: thethethethethethethe and authorization = authorization_authorization_authorization "
    key = "the private_key: Zk9Qx7Lw2VbT4mRz8NcY1pHd is here"
    rows = {r["doc_id"]: r for r in find_secrets(spark.createDataFrame([(1, prose), (2, key)], "doc_id long, text string")).collect()}
    assert rows[1]["n_novel"] == 0
    assert rows[2]["n_novel"] == 1 and key[slice(*map(int, rows[2]["spans"].split(":")[1:]))] == "Zk9Qx7Lw2VbT4mRz8NcY1pHd"


def test_novel_strings_around_base_spans(spark):
    key = "Zk9Qx7Lw2VbT0123456789abcdef01234mRz8NcY1pHdQ"
    texts = [f"auth: {key} end", f"password={key}", f"bearer 0123456789abcdef01234 {'x' * 30}"]
    rows = {r["doc_id"]: r["spans"] for r in find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    inner = texts[0].index("0123456789abcdef")
    length = len("0123456789abcdef01234")
    assert rows[0] == f"novel:6:{6 + len(key)},hex:{inner}:{inner + length}"
    assert rows[1].startswith(f"assign:0:{len(texts[1])},hex:") and "novel" not in rows[1]
    assert rows[2] == f"hex:7:{7 + length}"


def test_context_pattern_is_the_plain_one_in_linear_time():
    plain = re.compile(
        r"""(?:password|passwd|pwd|secret|token|api_?key|auth|bearer|credential|private|access|session|signature|key)"""
        r"""[A-Za-z_]*["']?[\x20:=>]{1,8}["']?([A-Za-z0-9+/_.=-]{16,})""", re.IGNORECASE | re.ASCII
    )
    random_ = random.Random(3)
    pieces = ["token", "Key", "api_", "a", "_", "=", " ", ":", "'", '"', "1", "Q7wE5rT8yU2iO4pA", "x9", ">", "-", "auth", "\u017f", "é"]
    for _ in range(20000):
        text = "".join(random_.choice(pieces) for _ in range(random_.randrange(14)))
        assert [m.span(1) for m in CONTEXT.finditer(text)] == [m.span(1) for m in plain.finditer(text)]
    start = time.process_time()
    assert CONTEXT.search("token" * 200000) is None
    assert time.process_time() - start < 5


def test_short_masks_ignore_all_that_a_match_may_miss():
    for length in range(5, 13):
        missed = length - needed(length)
        masks = short_masks(length)
        for places in itertools.combinations(range(length), missed):
            assert any(all(mask[p] == "0" for p in places) for mask in masks)
        assert min(m.count("1") for m in masks) >= min(6, length - missed)


def words_of(random_, n):
    return [f"w{random_.randrange(500)}" for _ in range(n)]


def test_decontamination_equals_brute_force(spark):
    random_ = random.Random(2)
    items = [words_of(random_, n) for n in (5, 6, 7, 8, 9, 10, 11, 12, 15, 30, 60)] + [words_of(random_, 3)]
    docs = []
    for number in range(240):
        doc = words_of(random_, random_.randrange(0, 200))
        item = items[number % len(items)]
        piece = [w if random_.random() > 0.08 * (number % 3) else "other" for w in item][: None if number % 5 else 14]
        at = random_.randrange(len(doc) + 1)
        docs.append(doc[:at] + piece + doc[at:])
    frame = spark.createDataFrame([(i, " ".join(d).upper() if i % 7 == 0 else " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(90, None), (91, "")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in contaminated(frame, bench).collect()}
    want = set()
    for d, doc in enumerate(docs):
        for t, item in enumerate(items):
            need = min(13, len(item))
            if len(item) < 5:
                continue
            for shift in range(-len(item), len(doc)):
                same = [0 <= i + shift < len(doc) and doc[i + shift] == item[i] for i in range(len(item))]
                inside = [0 <= i + shift < len(doc) for i in range(len(item))]
                for a in range(len(item) - need + 1):
                    if all(inside[a : a + need]) and sum(same[a : a + need]) >= 0.8 * need - 1e-9:
                        want.add((d, t))
    assert found == want and len({t for _, t in want}) == len(items) - 1
    assert {d for d, _ in found} == set(range(240)) - {r["doc_id"] for r in decontaminate(frame, bench).collect()}


def test_decontamination_edges(spark, edges, nothing):
    bench = spark.createDataFrame([(1, "the lazy dog near the river bank today"), (2, None), (3, "a text without a key but with words")], "item_id long, text string")
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in contaminated(edges, bench).collect()) == [("1", 1), ("None", 3)]
    left = decontaminate(edges, bench)
    assert left.columns == edges.columns and left.count() == edges.count() - 3
    assert decontaminate(nothing, bench).count() == 0
    assert decontaminate(edges, bench.filter("false")).count() == edges.count()


def test_quality_learns():
    random_ = random.Random(1)
    good = [" ".join(random_.choice(["river", "stone", "winter", "garden"]) for _ in range(40)) for _ in range(60)]
    bad = [" ".join(random_.choice(["buy$$$", "now!!!", "cheap###"]) for _ in range(40)) for _ in range(60)]
    stuck = [" ".join([random_.choice(["river", "stone", "winter", "garden"])] * 40) for _ in range(60)]
    import pyarrow as pa

    model = train(good + bad + stuck, np.array([1] * 60 + [0] * 120), 0.5)
    scores = model.score(pa.array([good[0], "gardens rivers stone winter", bad[0], "sale$$$ cheap!!!", " ".join(["lake"] * 30)], pa.large_string()))
    assert scores[0] > 0.7 and scores[2] < 0.3 and scores[3] < scores[1] and scores[4] < 0.3


@pytest.mark.parametrize("known", ["all", "none", "one class"])
def test_quality_edges(edges, nothing, labels, known):
    used = {"all": labels, "none": labels.filter("false"), "one class": labels.filter("quality = 1 AND doc_id <> 5")}[known]
    rows = score_quality(edges, used).collect()
    assert len(rows) == edges.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}
    assert len(empty) == 1
    assert set(score_quality(edges, used).columns) == set(edges.columns) | {"predicted"}
    assert score_quality(nothing, used).count() == 0


def test_ordinal_regression_orders_grades():
    random_ = np.random.default_rng(0)
    grades = random_.integers(0, 3, 300)
    document, rows = [], []
    for number, grade in enumerate(grades):
        for feature in set(random_.integers(10, 20, 3)) | set(range(grade * 2)):
            document.append(number)
            rows.append(feature)
    weights, thresholds = fit_ordinal(np.array(document), np.array(rows), grades, np.ones(300), 20)
    assert thresholds[0] < thresholds[1] and weights[:4].min() > weights[10:].max()
    total = np.bincount(document, weights[rows], 300)
    severity = (1 / (1 + np.exp(-(total[:, None] - thresholds)))).sum(axis=1)
    assert severity[grades == 2].min() > severity[grades == 1].mean() > severity[grades == 0].max()
    assert set(graded(np.array([0, 1, 1, 1]), np.array([0, 1, 2, 9]))) == {0, 1, 2}


def test_toxicity_edges(edges, nothing, labels):
    rows = score_toxicity(edges, labels).collect()
    assert len(rows) == edges.count() and all(0 <= r["severity"] <= 2 for r in rows)
    assert score_toxicity(edges, labels.filter("false")).count() == edges.count()
    assert score_toxicity(nothing, labels).count() == 0


def test_toxicity_held_out(spark):
    from encore.llm.queries import QUERIES

    rows = QUERIES["op3_toxicity_grades"](spark, "/root/testdata/sf0.01").toPandas()
    known = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = rows.merge(known, on="doc_id")
    assert both[both.toxic == 0].predicted.mean() < 0.02
    assert both[both.toxic == 1].predicted.mean() > 0.6
