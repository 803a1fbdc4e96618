"""Periodic runs (op11) against all periods of all places."""

import random
import re
import time
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

from dimload.llm import queries, repeats

from .conftest import HARD


def brute_runs(s, least=6, times=4):
    """All maximal stretches of each period, without those that have a smaller one."""
    n, out = len(s), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            if j + q - i >= max(least, times * q) and not any(all(s[k] == s[k + p] for k in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, j + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, plant=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    dropped = {i for a, b, q in found for i in range(a + q, b)}
    best = max(found, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]), default=None)
    first = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return (doc_id, len(found), *first, sha256(lines.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def rows_of(df):
    return [tuple(r[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")) for r in df.collect()]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_sequences(seed):
    rng = random.Random(seed)
    for _ in range(150):
        letters = rng.choice([1, 2, 2, 3, 6])
        s = [rng.randrange(letters) for _ in range(rng.randrange(0, 60))]
        while rng.random() < 0.7:  # stretches with planted periods, also inside one another
            at, part = rng.randrange(len(s) + 1), [rng.randrange(letters) for _ in range(rng.randrange(1, 8))]
            s[at:at] = (part * rng.randrange(2, 9))[: rng.randrange(3, 60)]
        got = [tuple(r) for r in repeats.runs(np.array(s, np.int64)).tolist()]
        assert got == brute_runs(s), s


def test_suffix_array_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(60):
        s = [rng.randrange(3) for _ in range(rng.randrange(1, 50))] * rng.randrange(1, 3)
        sa, levels = repeats.suffix_array(np.array(s, np.int64))
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        common = [0] + [next((k for k in range(len(s)) if s[a + k : a + k + 1] != s[b + k : b + k + 1] or b + k >= len(s)), 0) for a, b in zip(sa[:-1], sa[1:], strict=True)]
        assert repeats.lcp_array(sa, levels).tolist() == common


def test_other_bounds():
    s = np.array([1, 2, 1, 2, 1, 3, 3, 3, 4], np.int64)
    assert repeats.runs(s, least=2, times=2).tolist() == [[0, 5, 2], [5, 8, 1]]


def test_documents_against_brute_force(spark, hard):
    long = [r for r in HARD if len(r[1] or "") < 10_000]
    want = [brute(r[0], r[1]) for r in long]
    n = 30_000
    want.append((11, 1, 0, n, 1, 1000 * n, sha256(f"0,{n},1\n".encode()).hexdigest(), sha256(b"word").hexdigest()))
    got = rows_of(repeats.scan(hard, queries.planted_repeats))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_slices_do_not_change_results(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        w = [rng.choice("ab cd ef g h".split()) for _ in range(rng.randrange(0, 40))]
        rows.append((i, " ".join(w) + " x y" * rng.randrange(0, 9)))
    got = rows_of(repeats.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), queries.planted_repeats))
    assert sorted(got) == sorted(brute(*r) for r in rows)


def test_an_empty_table(spark, empty):
    assert repeats.scan(empty).collect() == []


def test_long_texts_take_linear_work():
    """A text beyond a slice, with a period of a third of it, and one word alone."""
    rng = random.Random(1)
    part = [rng.randrange(5000) for _ in range(50_000)]
    for s, want in ((part * 5, [[0, 250_000, 50_000]]), ([7] * 200_000, [[0, 200_000, 1]])):
        t0 = time.time()
        assert repeats.runs(np.array(s, np.int64)).tolist() == want
        assert time.time() - t0 < 30


def test_the_query_reads_the_table(spark):
    sf = "/root/testdata/sf0.001"
    got = rows_of(queries.op11_periodic_runs(spark, sf))
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, sf, "documents").collect()}
    short = {i for i, t in texts.items() if len(t or "") < 4000}
    assert len(got) == len(texts) and len(short) > 100
    assert sorted(r for r in got if r[0] in short) == sorted(brute(i, texts[i]) for i in short)
