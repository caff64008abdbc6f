"""Small numpy helpers that run inside Spark tasks on bounded blocks of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SCORES_PER_BLOCK = 1 << 20
TIE_DIGITS = 9
HALF_TIE = 0.5 * 10.0**-TIE_DIGITS


def vector_rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _cut(reach: np.ndarray, scores: np.ndarray, most: int) -> None:
    """Leave the `most` best in each row of `reach`: by rounded score, then by place. A low floor, or copies of a vector, let a
    whole block through, and sorting all of that costs far more than the scores."""
    rows = np.flatnonzero(np.count_nonzero(reach, axis=1) > most)
    if not len(rows):
        return
    rounded = np.where(reach[rows], np.round(scores[rows], TIE_DIGITS), -np.inf)
    cut = np.partition(rounded, rounded.shape[1] - most, axis=1)[:, -most, None]
    above, equal = rounded > cut, rounded == cut
    left = most - np.count_nonzero(above, axis=1)
    reach[rows] = above | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= left[:, None]))


def best_matches(
    users: np.ndarray, items: np.ndarray, k: int, floor: np.ndarray, positive_only: bool,
    hidden: tuple[np.ndarray, np.ndarray] | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (user row, item row, score, rank) of each user's `k` best items that reach its `floor`.

    Rows of `items` must be in key order: scores equal after rounding rank by item row. Rows come out per user, best first;
    rank counts from 0. `hidden` lists (user rows, item rows), by user row, of pairs that never match: they are masked
    before the cut, so however many they are, a user gets `k` others.
    """
    if not len(items):
        return
    step, most = max(1, SCORES_PER_BLOCK // len(items)), min(k, len(items))
    for start in range(0, len(users), step):
        block = slice(start, start + step)
        scores = users[block] @ items.T
        if hidden is not None:
            first, last = np.searchsorted(hidden[0], (start, start + step))
            scores[hidden[0][first:last] - start, hidden[1][first:last]] = -np.inf
        # Everything that can round to at least the cut: ties are settled below, by key. A floor is cut enough.
        least = floor[block]
        if not np.isfinite(least).all():
            least = np.maximum(least, np.partition(scores, len(items) - most, axis=1)[:, len(items) - most])
        least = least - 2 * HALF_TIE
        least = np.maximum(least, np.nextafter(0.0, 1.0) if positive_only else np.finfo(np.float64).min)
        reach = scores >= least[:, None]
        _cut(reach, scores, most)
        row, item = np.nonzero(reach)
        score = np.round(scores[row, item], TIE_DIGITS) + 0.0
        order = np.lexsort((item, -score, row))
        row, item, score = row[order], item[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        chosen = rank < k
        yield row[chosen] + start, item[chosen], score[chosen], rank[chosen]
