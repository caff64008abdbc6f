"""Secrets in texts: three fixed patterns, and strings that dictionary-primed zstandard finds novel.

A candidate of the method is a long string of code letters after a word that speaks of credentials, unless a base span
holds all of it; one that only overlaps a base span, say a key around a run of hex letters, is judged. It is compressed
after its surroundings with a dictionary of the identifiers that surround candidates anywhere in the corpus. What the
candidate adds to the compressed size, against its length, says how novel it is: prose, repeated tokens and identifiers
add little, keys add nearly their entropy.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.words import slices, texts_of
from encore.storage import materialize

KINDS = ["assign", "access", "hex", "novel"]
# The base patterns, and the least length of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
# Words that make a context sensitive, and the strings looked at there. A run of letters is read once, from its start.
CONTEXT = re.compile(
    r"""(?<![A-Za-z_])(?>[A-Za-z_]*?(?:password|passwd|pwd|secret|token|api_?key|auth|bearer|credential|private|access|session"""
    r"""|signature|key))[A-Za-z_]*+["']?[\x20:=>]{1,8}["']?([A-Za-z0-9+/_.=-]{16,})""", re.IGNORECASE | re.ASCII
)
FILTERS = {
    "assign": r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]",
    "access": r"AKIA[A-Z0-9]{14}",
    "hex": r"[0-9a-f]{16}",
    "novel": r"(?i)(pass|pwd|secret|token|key|auth|bearer|credential|private|access|session|signature)[A-Za-z_]*[\"']?[ :=>]{1,8}[\"']?[A-Za-z0-9+/_.=-]{16}",
}
AROUND = 160
DICTIONARY_WORDS = 4096
NOVEL_SHARE = 0.55


def base_spans(text: str, wanted=(True, True, True)) -> list[tuple[int, int, int]]:
    """(kind, start, end) by start, then kind, in code points."""
    spans = []
    if wanted[0]:
        spans += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if wanted[1]:
        spans += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if wanted[2]:
        spans += [(2, *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], s[0]))


def _candidates(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    found = []
    for match in CONTEXT.finditer(text):
        start, end = match.span(1)
        if not any(s <= start and end <= e for _, s, e in base):
            found.append({
                "start": start, "end": end, "before": text[max(0, start - AROUND) : start], "after": text[end : end + AROUND],
            })
    return found


def _find(column: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, column):
                texts = texts_of(batch.column(column))
                hits = {kind: pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False) for kind, pattern in FILTERS.items()}
                rows = hits["assign"] | hits["access"] | hits["hex"] | hits["novel"]
                base, candidates = [[]] * len(rows), [[]] * len(rows)
                for row in rows.nonzero()[0]:
                    text = texts[int(row)].as_py()
                    spans = base_spans(text, (hits["assign"][row], hits["access"][row], hits["hex"][row]))
                    base[row] = [{"kind": k, "start": s, "end": e} for k, s, e in spans]
                    if hits["novel"][row]:
                        candidates[row] = [c | {"text": text[c["start"] : c["end"]]} for c in _candidates(text, spans)]
                out = {name: batch.column(name) for name in keep}
                out["_base"] = pa.array(base, pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])))
                out["_candidates"] = pa.array(candidates, pa.list_(pa.struct([
                    ("start", pa.int64()), ("end", pa.int64()), ("before", pa.string()), ("after", pa.string()), ("text", pa.string()),
                ])))
                yield pa.RecordBatch.from_pydict(out)

    return run


def novelty(before: str, text: str, after: str, dictionary: zstandard.ZstdCompressionDict) -> float:
    """Bytes that `text` adds to its compressed surroundings, per byte of it."""
    compressor = zstandard.ZstdCompressor(level=9, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False)
    around = f"{before}\n{after}".encode()
    return (len(compressor.compress(around + b"\n" + text.encode())) - len(compressor.compress(around))) / max(1, len(text.encode()))


def _judge(words, share: float):
    raw = words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        for batch in batches:
            table = batch.to_pydict()
            columns = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel")}
            for base, candidates in zip(table.pop("_base"), table.pop("_candidates"), strict=True):
                spans = [(s["kind"], s["start"], s["end"]) for s in base]
                told = [f"{KINDS[k]}:{s}:{e}" for k, s, e in spans]
                novel = [
                    (3, c["start"], c["end"]) for c in candidates
                    if novelty(c["before"], c["text"], c["after"], dictionary) >= share
                ]
                every = sorted(spans + novel, key=lambda s: (s[1], s[0]))
                for kind in range(3):
                    columns[f"n_{KINDS[kind]}"].append(sum(s[0] == kind for s in spans))
                columns["n_novel"].append(len(novel))
                columns["base_sha256"].append(hashlib.sha256(",".join(told).encode()).hexdigest())
                columns["spans"].append(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in every))
            names = [n for n in batch.schema.names if n not in ("_base", "_candidates")]
            out = {n: batch.column(n) for n in names}
            out |= {k: pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k, v in columns.items()}
            yield pa.RecordBatch.from_pydict(out)

    return run


def find_secrets(
    docs: DataFrame, column: str = "text", keep: tuple[str, ...] = ("doc_id",), share: float = NOVEL_SHARE,
    dictionary_words: int = DICTIONARY_WORDS,
) -> DataFrame:
    """One row per document: the `keep` columns, counts of base spans per kind, their SHA-256, and all spans as text.

    `spans` holds `kind:start:end`, code points, end exclusive, by start and then kind, the method's as `novel`. The
    dictionary holds the `dictionary_words` most frequent identifiers around candidates of all documents, so its size is
    bounded, and only that list reaches the driver.

    Edge cases: null and empty texts have no spans (SHA-256 of the empty string). Overlapping spans of different kinds
    are all told. Repeated rows each get a row. Other columns of docs are left out. An empty table gives an empty result.
    """
    docs = docs.select(*keep, F.col(column).alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "_text")
    span = "array<struct<kind:int,start:bigint,end:bigint>>"
    candidate = "array<struct<start:bigint,end:bigint,before:string,after:string,text:string>>"
    found = materialize(docs.mapInArrow(_find("_text", list(keep)), f"{kept}, _base {span}, _candidates {candidate}"), "spans")
    words = (
        found.select(F.explode("_candidates").alias("c"))
        .select(F.explode(F.regexp_extract_all(F.concat_ws(" ", "c.before", "c.after"), F.lit("[A-Za-z_]{3,}"), 0)).alias("word"))
        .groupBy("word").count().orderBy(F.desc("count"), "word").limit(dictionary_words)
    )
    # zstandard reaches nearest content most cheaply, so frequent words come last.
    raw = " ".join(r["word"] for r in reversed(words.collect())).encode() or b"identifier"
    result = f"{kept}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_novel bigint"
    return found.mapInArrow(_judge(raw, share), result)
