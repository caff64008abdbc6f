"""Generalised LR repair of role sequences over the grammar `(s? (ua)+)?`: the helper of `dialogue` inside tasks.

A row is two characters: the initial of its role (`-` for any but s, u, a) and its fault (`.` none, `x` must go, `t`
truncated). Repairs are weighted actions on a graph-structured stack: keep, rerole, delete and insert. A link is an LR
state on top of the link below it, so parses share what lies below, and parses with the same top and the same link below
become one, the one of the smallest (cost, audit). Complete rules are reduced at once, which leaves few links, so a run of
rows is summed up by the cheapest way from every link to every other, and runs follow one another by adding these up.

Inserts come only before a row's own action, or at the end of all rows. So no audit of the same rows is the beginning of
another one, and comparing audits is comparing at the first difference: minima may be taken row by row and run by run.
"""

from __future__ import annotations

from functools import lru_cache

RULES = (("C", ""), ("C", "sB"), ("C", "B"), ("B", "BP"), ("B", "P"), ("P", "ua"))
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
MEMO = 1 << 15

Link = tuple  # (state, link below or None)


def _closure(items: frozenset) -> frozenset:
    items = set(items)
    while True:
        wanted = {RULES[rule][1][dot] for rule, dot in items if dot < len(RULES[rule][1])}
        more = {(number, 0) for number, (left, _) in enumerate(RULES) if left in wanted} - items
        if not more:
            return frozenset(items)
        items |= more


def _tables() -> tuple[dict, dict, set]:
    """(goto by (state, symbol), rule to reduce by state, states that accept at the end) of the grammar, goal C."""
    start = _closure(frozenset((n, 0) for n, (left, _) in enumerate(RULES) if left == "C"))
    states, goto = [start], {}
    for state in states:
        for symbol in sorted({RULES[r][1][d] for r, d in state if d < len(RULES[r][1])}):
            after = _closure(frozenset((r, d + 1) for r, d in state if RULES[r][1][d : d + 1] == symbol))
            if after not in states:
                states.append(after)
            goto[states.index(state), symbol] = states.index(after)
    done = {n: [r for r, d in state if d == len(RULES[r][1])] for n, state in enumerate(states)}
    accepts = {n for n, rules in done.items() if any(RULES[r][0] == "C" for r in rules)}
    reduces = {n: rule for n, rules in done.items() for rule in rules if RULES[rule][0] != "C"}
    return goto, reduces, accepts


GOTO, REDUCES, ACCEPTS = _tables()
START: Link = (0, None)


@lru_cache(maxsize=None)
def pushed(link: Link, symbol: str) -> Link | None:
    """The link after a symbol and all reductions; None if the grammar has no such step."""
    if (link[0], symbol) not in GOTO:
        return None
    link = (GOTO[link[0], symbol], link)
    while link[0] in REDUCES:
        left, right = RULES[REDUCES[link[0]]]
        for _ in right:
            link = link[1]
        link = (GOTO[link[0], left], link)
    return link


def _links() -> list[Link]:
    found = [START]
    for link in found:
        found += [n for n in (pushed(link, s) for s in "sua") if n and n not in found]
    return found


LINKS = _links()
NUMBER = {link: n for n, link in enumerate(LINKS)}
FINAL = [n for n, link in enumerate(LINKS) if link[0] in ACCEPTS]


def _add(tops: dict, link: Link | None, cost: int, audit: str) -> bool:
    """Put a parse on its top, or merge it with the one there; whether it is the better one."""
    if link is None or (link in tops and tops[link] <= (cost, audit)):
        return False
    tops[link] = (cost, audit)
    return True


def _inserted(tops: dict) -> dict:
    """The tops with any roles inserted before what follows."""
    tops, open_ = dict(tops), list(tops)
    while open_:
        link = open_.pop()
        cost, audit = tops[link]
        open_ += [after for role in "ua" if _add(tops, after := pushed(link, role), cost + INSERT, audit + "I")]
    return tops


@lru_cache(maxsize=MEMO)
def ways(rows: str, start: int) -> dict[int, tuple[int, str]]:
    """{link number: (cost, audit)} of the cheapest repair of `rows` from one link to each that can be reached."""
    tops = {LINKS[start]: (0, "")}
    for at in range(0, len(rows), 2):
        role, fault = rows[at], rows[at + 1]
        after: dict = {}
        for link, (cost, audit) in _inserted(tops).items():
            _add(after, link, cost + DELETE, audit + "D")
            if fault != "x":
                stay = cost + (TRUNCATED if fault == "t" else 0)
                _add(after, pushed(link, role), stay + KEEP, audit + "K")
                for other in "ua":
                    _add(after, pushed(link, other), stay + REROLE, audit + "R")
        tops = after
    return {NUMBER[link]: way for link, way in tops.items()}


@lru_cache(maxsize=None)
def ending(link: int) -> tuple[int, int] | None:
    """(cost, inserts) to end at a link."""
    tops = _inserted({LINKS[link]: (0, "")})
    best = min((tops[LINKS[n]] for n in FINAL if LINKS[n] in tops), default=None)
    return best and (best[0], len(best[1]))


def whole(rows: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a whole conversation; of equal ones the least audit."""
    found = ways(rows, NUMBER[START])
    return min((cost + e[0], audit + "I" * e[1]) for n, (cost, audit) in found.items() if (e := ending(n)))


def broken(initials: str) -> int:
    """Adjacent initials that the grammar does not have."""
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:], strict=False)))
