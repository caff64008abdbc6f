"""Conversation repair against enumeration of all repairs, and against the same steps in plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from encore.llm import roles
from encore.llm.dialogue import repair_conversations

GOOD = re.compile(r"(s?(ua)+)?")


def enumerated(rows):
    """(cost, audit) by trying every action for every row and up to two inserts at every place."""
    acts = []
    for initial, fault in rows:
        stay = 5 if fault == "t" else 0
        own = [("D", "", 2)]
        if fault != "x":
            own += [("K", initial, stay), ("R", "u", stay + 1), ("R", "a", stay + 1)]
        acts.append(own)
    inserts = [("", "", 0)] + [("I" * n, "".join(p), 5 * n) for n in (1, 2) for p in itertools.product("ua", repeat=n)]
    best = None
    for chosen in itertools.product(*acts):
        for put in itertools.product(inserts, repeat=len(rows) + 1):
            cost = sum(c[2] for c in chosen) + sum(p[2] for p in put)
            if best and cost > best[0]:
                continue
            final = "".join(p[1] + c[1] for p, c in zip(put, chosen, strict=False)) + put[-1][1]
            if GOOD.fullmatch(final):
                audit = "".join(p[0] + c[0] for p, c in zip(put, chosen, strict=False)) + put[-1][0]
                best = min(best or (cost, audit), (cost, audit))
    return best


@pytest.mark.parametrize("length", [0, 1, 2])
def test_every_short_conversation(length):
    kinds = list(itertools.product("sua-", ".xt"))
    for rows in itertools.product(kinds, repeat=length):
        assert roles.whole("".join(i + f for i, f in rows)) == enumerated(rows), rows


def test_longer_conversations():
    chance = random.Random(5)
    for _ in range(25):
        rows = [(chance.choice("sua-"), chance.choice("...xt")) for _ in range(3)]
        assert roles.whole("".join(i + f for i, f in rows)) == enumerated(rows), rows


def plain(rows):
    """The contract row by row; `rows` are (conv, turn, role, text)."""
    def told(value):
        return " " if value is None else str(value)

    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            fault = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20
            role, text = "user" if fault == 4 else told(role), told(text)
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            mine += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in mine:
            core = text.rstrip("\t\n\x0b\x0c\r ")
            faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in mine]
        code = {"blank": "x", "duplicate": "x", "truncated": "t", "": "."}
        cost, audit = roles.whole("".join((i if i in ("s", "u", "a") else "-") + code[f] for i, f in zip(initials, faults, strict=True)))
        lines, left, want = [], iter(mine), "user"
        for letter in audit:
            role, text = (want, "") if letter == "I" else next(left)[1:]
            if letter == "D":
                continue
            role = role if letter == "K" else want
            lines.append(f"{role}:{text}")
            if role[:1] != "s":
                want = "assistant" if want == "user" else "user"
        turns = {r[0] for r in mine if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out[conv] = (
            gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def repaired(rows, spark, **options):
    kept = spark.createDataFrame(
        [(*r, "fault", 7) for r in rows], "conv_id long, turn long, role string, text string, fault string, pos int"
    ) if isinstance(rows, list) else rows
    return {r[0]: tuple(r)[1:] for r in repair_conversations(kept, **options).collect()}


def test_edges(spark):
    """Nulls in every column, odd roles, repeated rows, blank and long texts, columns with the names used inside."""
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate([("system", "Be kind."), ("user", "Why?"), ("assistant", "So. \n"), ("user", "and")])]
    rows += [(50, None, "user", "First."), (50, None, None, None), (50, 3, "", " \t"), (50, 9, "tool", "Out."), (None, 1, "user", "A."), (None, None, "assistant", "B.")]
    rows += [(51, 1, "user", "Same.")] * 3 + [(52, t, "user", "x" * 300_000 + ".") for t in range(3)] + [(53, 0, "assistant", "a.b!c?")]
    rows += [(n, n, "user", "Gone.") for n in range(1000, 1040)]  # some of these lose their only row
    want = plain(rows)
    assert repaired(rows, spark) == want
    assert any(zlib.crc32(f"{n}:{n}".encode()) % 20 == 0 and want[n] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for n in range(1000, 1040))


def test_long_conversation_in_runs(spark):
    """One conversation holds most rows, and is parsed in many runs on several tasks."""
    chance = random.Random(3)
    rows = [(1, t, chance.choice(["user", "assistant", "user", "assistant", "system", "bot"]), chance.choice(["Yes.", "no", "", f"Text {t}.", f"cut {t}"])) for t in range(700)]
    rows += [(2, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for t in range(60)]
    want = plain(rows)
    assert repaired(rows, spark, run_rows=8) == want
    assert repaired(rows, spark) == want


def test_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    found = repair_conversations(rows)
    assert found.count() == 0 and found.schema["conv_id"].dataType.simpleString() == "string"
