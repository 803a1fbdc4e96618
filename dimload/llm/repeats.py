"""Periodic runs of words, found by branching squares in an enhanced suffix array.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical)
of at least ``max(LEAST, TIMES * q)`` words that no neighbouring word extends.

Words are numbered apart for each document of a slice, so one suffix array serves all of them and no
match leaves a document. For each interval of the LCP array with depth ``d``, the suffixes ``i`` of
all children but the largest are tested: a square of period ``d`` stands at ``i`` (or at ``i - d``) if
the inverse array puts ``i + d`` (``i - d``) into the same interval. It is branching if the word after
it differs from the one ``d`` before, so each stretch of period ``d`` has one branching square, at its
end. Squares are rotated to the left as far as the words allow, which merges a stretch's squares into
a run. Periods that are multiples of the smallest one end at the same word and are dropped with it.
No tree is built; everything is numpy but the stack that finds the intervals' ends.

A text is read as a whole and by one task, however long: it takes about 250 bytes a word, and 4 more
for each doubling up to its longest repeated stretch. Null and empty texts have no words and no
runs. Rows that repeat a doc_id are documents of their own; one without an id is read as it is, never
rewritten (see ``queries``). Ties for the highest exponent go to the smallest start, then period.
Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.textbatch import slices

LEAST, TIMES = 6, 4
STEP = 64  # words a square is rotated by at first; twice as many each time


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of ``s`` by doubling, and the ranks by the first 1, 2, 4, ... symbols.

    A rank is the first place of its group; only suffixes whose group holds others are sorted again."""
    n = len(s)
    sa = np.argsort(s, kind="stable")
    levels, h = [], 1
    first = np.empty(n, bool)
    first[:1] = True
    first[1:] = s[sa[1:]] != s[sa[:-1]]
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels.append(rank)
    while True:
        alone = first & np.append(first[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            return sa, levels
        i = sa[slots]
        after = np.where(i + h < n, rank[np.minimum(i + h, n - 1)], -1)
        order = np.argsort(rank[i].astype(np.int64) * (n + 1) + after, kind="stable")
        i, after = i[order], after[order]
        mine = rank[i]
        sa[slots] = i
        split = np.ones(len(i), bool)
        split[1:] = (mine[1:] != mine[:-1]) | (after[1:] != after[:-1])
        first[slots] = split
        rank = rank.copy()
        rank[i] = np.maximum.accumulate(np.where(split, slots, 0))
        levels.append(rank)
        h *= 2


def lcp_array(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Common symbols of each suffix with the one before it in ``sa`` (the first: 0)."""
    n = len(sa)
    out = np.zeros(n, np.int64)
    a, b = sa[:-1], sa[1:]
    more = np.arange(n - 1)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a[more] + out[1:][more], b[more] + out[1:][more]
        inside = (x < n) & (y < n)
        same = np.zeros(len(more), bool)
        same[inside] = levels[k][x[inside]] == levels[k][y[inside]]
        out[1:][more[same]] += 1 << k
    return out


def interval_ends(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest ones before and after it with a smaller value (-1, n: none)."""
    n = len(lcp)
    before, after = np.empty(n, np.int64), np.full(n, n, np.int64)
    values, stack, lo, hi = lcp.tolist(), [], [-1] * n, [n] * n
    for k, d in enumerate(values):
        while stack and values[stack[-1]] > d:
            hi[stack.pop()] = k
        if stack:
            top = stack[-1]
            lo[k] = lo[top] if values[top] == d else top
        stack.append(k)
    before[:], after[:] = lo, hi
    return before, after


def branching_squares(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends (exclusive) and periods of all branching squares of ``s``, sorted by both."""
    n = len(s)
    none = np.empty(0, np.int64)
    if n < 2:
        return none, none
    sa, levels = suffix_array(s)
    lcp = lcp_array(sa, levels)
    del levels
    inverse = np.empty(n, np.int64)
    inverse[sa] = np.arange(n)
    # intervals without depth hold no squares: only the stretches of places between them matter
    inner = np.flatnonzero(lcp > 0)
    if not len(inner):
        return none, none
    places = _with_edges(inner)
    values = np.append(lcp, 0)[places]  # nothing follows the last suffix
    left, right = interval_ends(values)
    mine = np.searchsorted(places, inner)
    lo, hi, depth = places[left[mine]], places[right[mine]], lcp[inner]
    # children: places of one depth and interval cut it; the first child starts at the interval's start
    order = np.lexsort((inner, lo))
    order = order[np.argsort(depth[order], kind="stable")]
    k, lo, hi, depth = inner[order], lo[order], hi[order], depth[order]
    new = np.ones(len(k), bool)
    new[1:] = (lo[1:] != lo[:-1]) | (depth[1:] != depth[:-1])
    group = np.cumsum(new) - 1
    begin = np.concatenate([lo[new], k])
    stop = np.concatenate([k[new], np.where(np.append(new[1:], True), hi, np.append(k[1:], 0))])
    owner = np.concatenate([np.arange(group[-1] + 1), group])
    size = stop - begin
    rank = np.lexsort((begin, -size, owner))  # the largest child of each interval comes first
    small = np.ones(len(rank), bool)
    small[np.unique(owner[rank], return_index=True)[1]] = False
    chosen = rank[small]
    low, high, deep = lo[new], hi[new], depth[new]
    found = []
    for piece in _pieces(size[chosen]):
        c = chosen[piece]
        of = np.repeat(owner[c], size[c])
        at = np.repeat(begin[c] - (np.cumsum(size[c]) - size[c]), size[c]) + np.arange(len(of))
        i, d = sa[at], deep[of]
        for start, other in ((i, i + d), (i - d, i - d)):
            ok = (other >= 0) & (other < n)
            ok[ok] = (inverse[other[ok]] >= low[of[ok]]) & (inverse[other[ok]] < high[of[ok]])
            q = d[ok]
            end = start[ok] + 2 * q
            open_ = end < n
            branching = ~open_
            branching[open_] = s[end[open_]] != s[end[open_] - q[open_]]
            found.append(np.stack([end[branching], q[branching]]))
    ends, periods = np.unique(np.hstack(found), axis=1) if found else (none, none)
    return ends, periods


def _with_edges(inner: np.ndarray) -> np.ndarray:
    """The places, and those right before and right after each stretch of them."""
    gap = np.diff(inner) > 1
    return np.unique(np.concatenate([inner, inner[np.append(True, gap)] - 1, inner[np.append(gap, True)] + 1]))


def _pieces(sizes: np.ndarray, limit: int = 1 << 20) -> Iterator[slice]:
    """Slices of about ``limit`` in total."""
    block = (np.cumsum(sizes) - sizes) // limit
    cuts = np.flatnonzero(np.diff(block)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)], strict=True):
        if b > a:
            yield slice(a, b)


def rotated(s: np.ndarray, start: int, period: int) -> int:
    """The first word from which on the square at ``start`` can be rotated to the left."""
    step = STEP
    while start > 0:
        lo = max(0, start - step)
        differ = np.flatnonzero(s[lo:start] != s[lo + period : start + period])
        if len(differ):
            return lo + int(differ[-1]) + 1
        start, step = lo, 2 * step
    return start


def runs(s: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, end, period) of all runs of ``s``, sorted by start and period."""
    ends, periods = branching_squares(s)
    out = []
    # a run of four periods has a square two rotations before its last one: look no further otherwise
    if times >= 3 and len(ends):
        begin = ends - 3 * periods
        fit = (begin >= 0) & (ends - times * periods >= 0)
        fit[fit] = s[begin[fit]] == s[begin[fit] + periods[fit]]
        ends, periods = ends[fit], periods[fit]
    of_end: list[tuple[int, int]] = []  # (start, period) of the runs with the end at hand
    last = -1
    for end, q in zip(ends.tolist(), periods.tolist(), strict=True):
        if end != last:
            of_end, last = [], end
        if any(q % p == 0 and a <= end - 2 * q for a, p in of_end):
            continue  # a multiple of a smaller period
        start = rotated(s, end - 2 * q, q)
        of_end.append((start, q))
        if end - start >= max(least, times * q):
            out.append((start, end, q))
    return np.array(sorted(out, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]
    + [("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
)


def _described(doc_id: int | None, words: list[bytes], found: np.ndarray) -> dict:
    """A document's row, given its runs in words of its own."""
    best = None
    lines = []
    for start, end, q in found.tolist():
        length = end - start
        lines.append(f"{start},{length},{q}\n")
        if best is None or length * best[2] > best[1] * q:
            best = (start, length, q)
    if len(found):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, found[:, 0] + found[:, 2], 1)
        np.add.at(edge, found[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    start, length, q = best or (None, None, None)
    return {
        "doc_id": doc_id,
        "n_runs": len(found),
        "start": start,
        "length": length,
        "period": q,
        "exponent_milli": 1000 * length // q if best else None,
        "runs_sha256": sha256("".join(lines).encode()).hexdigest(),
        "collapsed_sha256": sha256(b" ".join(words)).hexdigest(),
    }


def described(ids: list, texts: list[str | None], rewrite: Callable | None = None) -> list[dict]:
    """The rows of a slice of documents: one suffix array for all of them."""
    words = [(t or "").encode().split() for t in texts]
    if rewrite is not None:
        words = [rewrite(i, w) for i, w in zip(ids, words, strict=True)]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    s, base = np.empty(int(bounds[-1]), np.int64), 0
    for k, w in enumerate(words):
        number: dict[bytes, int] = {}
        s[bounds[k] : bounds[k + 1]] = [number.setdefault(x, base + len(number)) for x in w]
        base += len(number)
    found = runs(s)
    cut = np.searchsorted(found[:, 0], bounds)
    shift = np.array([1, 1, 0])
    return [_described(i, w, found[cut[k] : cut[k + 1]] - bounds[k] * shift) for k, (i, w) in enumerate(zip(ids, words, strict=True))]


def scan(docs: DataFrame, rewrite: Callable | None = None) -> DataFrame:
    """doc_id, n_runs, the highest exponent's run and the digests of all rows of ``docs`` (doc_id, text).

    ``rewrite(doc_id, words)`` may replace a document's words (bytes) first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = described(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), rewrite)
            yield pa.RecordBatch.from_pylist(rows, schema=_OUT)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
