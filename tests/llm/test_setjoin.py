"""The Jaccard join (op2) against all pairs."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimload.llm import setjoin

from .conftest import HARD, LOW


def sets_of(rows):
    out = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        s = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        out[doc_id] = s
    return out


def brute(rows):
    sets = sets_of(rows)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def corpus(seed, groups=12, copies=40):
    """Groups of near copies at all distances around the threshold, and passages many share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(20)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([5, 8, 30, 80, 150]))]
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(text) // 25)):
                text[rng.randrange(len(text))] = rng.choice(words)
            text = text[: len(text) - rng.randrange(0, 1 + len(text) // 8)]
            if rng.random() < 0.3:
                text += passage
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return [(i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(setjoin.groups(df)) == brute(rows)


@pytest.mark.parametrize("small", [2, 12])
def test_lists_longer_than_a_block(spark, monkeypatch, small):
    for name, value in (("FIRST_BLOCK", 2), ("BLOCK_GROWTH", 2), ("PARTNERS", 3), ("SMALL", small), ("BLOCK", 3)):
        monkeypatch.setattr(setjoin, name, value)
    rows = corpus(3, groups=5, copies=60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(setjoin.groups(df)) == brute(rows)


@pytest.mark.parametrize("mixed", [False, True])
def test_long_list_in_bounded_memory(mixed):
    """One list of 8,000 sets: one component and a single other set, or no two sets of one component."""
    n, odd, lo = 8000, 5000, 1024
    comp = np.arange(n) if mixed else np.where(np.arange(n) == odd, odd, 0)
    columns = {"token": np.zeros(n, np.int64), "sid": np.arange(n), "place": np.full(n, 10 << 32), "comp": comp}
    batches = pa.table(columns).to_batches(max_chunksize=4000)
    got, seen = 0, set()
    tracemalloc.start()
    for out in setjoin._list_pairs(lo, 16_384, False)(iter(batches)):
        got += out.num_rows
        if not mixed:
            seen |= set(zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    if mixed:
        assert got == sum(n - 1 - i for i in range(lo, n))
    else:
        assert seen == {(odd, i) for i in range(odd + 1, n)} | {(i, odd) for i in range(lo, odd)}


def test_blocks_are_skipped_by_size_and_position(spark):
    """Of pairs of blocks exactly those are left of which some pair of sets can link."""
    rng = random.Random(4)
    sets = {sid: rng.choice([rng.randrange(5, 12), rng.randrange(30, 60)]) for sid in range(60)}
    entries = [(t, sid, (n << 32) | rng.randrange(n - setjoin.least_overlap(n) + 1)) for t in range(4) for sid, n in sets.items() if rng.random() < 0.4]
    block = {sid: k // 4 for k, sid in enumerate(sorted(sets, key=lambda s: (sets[s], s)))}
    members = spark.createDataFrame(entries, "token long, sid long, place long")
    blocks = setjoin.list_blocks(members, spark.createDataFrame(list(block.items()), "sid long, block long"))
    got = {(r["x"], r["y"]) for lo, hi in ((0, 1), (1, 4), (4, 64)) for r in setjoin.block_pairs(blocks, lo, hi).collect()}
    can, near = set(), set()
    for t, a, x in entries:
        for u, b, y in entries:
            if t == u and block[a] <= block[b]:
                near.add((block[a], block[b]))
                if setjoin._possible(np.int64(x >> 32), np.int64(x & setjoin.LOW), np.int64(y >> 32), np.int64(y & setjoin.LOW)):
                    can.add((block[a], block[b]))
    assert can <= got < near


def test_repeated_ids_with_different_texts_are_documents_of_their_own(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    other = text.replace("one", "ten")
    rows = [(5, "a b c d e f g"), (5, text), (3, text + " x"), (9, "a b c d e f g"), (9, "z y x w v u"), (None, text), (7, other), (7, other)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.monotonically_increasing_id())
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in setjoin.groups(df).collect())
    assert got == [(0, 8, 0), (3, 9, 3), (5, 3, 5), (5, 8, 3), (7, 8, 7), (7, 8, 7), (9, 2, 9), (9, 3, 5)]
    kept = setjoin.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted([(0, text), (3, text + " x"), (5, "a b c d e f g"), (7, other), (9, "z y x w v u")])


def test_hard_rows(spark, hard):
    rows = setjoin.groups(hard).collect()
    assert len(rows) == len(HARD)
    want = brute([(r[0], r[1]) for r in HARD if r[0] is not None])
    for r in rows:
        assert (r["n_shingles"], r["component_id"]) == (want[r["doc_id"]] if r["doc_id"] is not None else (1, None))
    assert want[1] == (8, 1) and want[2] == (8, 1) and want[3] == (0, 3) and want[7] == (1, 6)


def test_keep_one_of_each_group(hard):
    kept = setjoin.keep_one(hard)
    assert kept.columns == hard.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 3, 4, 5, 6, 8, 9, 10, 11, 12] and ids.count(None) == 1


def test_empty_table(empty):
    assert setjoin.groups(empty).collect() == [] and setjoin.keep_one(empty).collect() == []


def test_components_of_a_long_chain(spark):
    n = 200
    links = spark.range(1, n).selectExpr("id as a", "id + 1 as b")
    got = {r["node"]: r["comp"] for r in setjoin.components(links).collect()}
    assert got == {i: 1 for i in range(1, n + 1)}


def test_bitmaps_rule_out_no_link():
    """Whatever their sizes, linked sets stay and most others go; the smaller of two sizes of bitmaps counts."""
    rng, kept, others = np.random.default_rng(5), 0, 0
    for n in (1, 2, 5, 30, 63, 64, 65, 120, 200, 500, 3000):
        for share in (0.0, 0.3, 0.5, 0.78, 0.8, 0.82, 0.9, 1.0):
            for m in {n, max(1, int(0.85 * n)), int(1.2 * n) + 1}:
                both = rng.integers(0, 1 << 63, n + m, dtype=np.uint64)
                same = int(share * (n + m) / (1 + share))
                a, b = both[:n], np.r_[both[: min(same, n, m)], both[n : n + m - min(same, n, m)]]
                may = setjoin.may_link(len(a), len(b), setjoin.parities(a), setjoin.parities(b))
                assert may == setjoin.may_link(len(b), len(a), setjoin.parities(b), setjoin.parities(a))
                if setjoin.linked(len(np.intersect1d(a, b)), len(a), len(b)):
                    assert may
                    kept += 1
                elif share <= 0.5 and n >= 30:
                    assert not may
                    others += 1
    assert kept > 50 and others > 50


def test_texts_move_for_likely_pairs_only(spark, monkeypatch):
    """Sets that share their rarest shingles only are candidates, but are dropped before their texts move."""
    rng = random.Random(6)
    rows = []
    for i in range(40):
        shared = [f"s{i // 2}x{k}" for k in range(12)]
        own = [f"o{rng.randrange(10**9)}" for _ in range(40)] if i < 30 else [f"z{i // 2}y{k}" for k in range(40)]
        rows.append((i + 1, " ".join([*shared, *own, f"e{i}"])))
    seen, verify = [], setjoin.verify
    monkeypatch.setattr(setjoin, "verify", lambda pairs, texts: seen.append({tuple(r) for r in pairs.collect()}) or verify(pairs, texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(setjoin.groups(df)) == brute(rows)
    assert {tuple(sorted(p)) for p in set().union(*seen)} == {(i, i + 1) for i in range(31, 41, 2)}


def test_a_round_moves_blocks_in_parts(spark, monkeypatch):
    """Every pair of blocks comes in one part, and a part moves about as many bytes as there is room for."""
    weights = {x: 10 + x for x in range(60)}
    both = [(x, y) for x in weights for y in weights if x <= y]
    pairs = spark.createDataFrame(both, "x long, y long")
    parts = [[tuple(r) for r in part.collect()] for part in setjoin.in_parts(pairs, spark.createDataFrame(list(weights.items()), "block long, bytes long"), 20_000)]
    assert sorted(p for part in parts for p in part) == both
    moved = [sum(weights[x] + (weights[y] if x != y else 0) for x, y in part) for part in parts]
    assert len(parts) == -(-sum(moved) // 20_000) > 3 and max(moved) < 30_000
    for name, value in (("FIRST_BLOCK", 2), ("BLOCK_GROWTH", 2), ("SMALL", 2), ("BLOCK", 3), ("ROUND_BYTES", 1500), ("ROUND_SHARE", 10**9)):
        monkeypatch.setattr(setjoin, name, value)
    rows = corpus(3, groups=4, copies=40)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(setjoin.groups(df)) == brute(rows)
