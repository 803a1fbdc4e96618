"""b-bit MinHash near duplicates (op13) against all pairs."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimload.llm import bitminhash, queries, tables
from dimload.session import sub_folders_or_files

from .conftest import HARD, LOW

SCHEMA = "doc_id long, text string"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of each row, each row a document."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        comp = least.get(root(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), comp, doc_id == comp))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=repr)


def corpus(seed, groups=14, copies=40):
    """Groups of near copies at all distances around the threshold, and passages many share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    passage = [rng.choice(words) for _ in range(12)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 5, 30, 80, 150]))]
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(text) // 12)):
                text[rng.randrange(len(text))] = rng.choice(words)
            text = text[: len(text) - rng.randrange(0, 1 + len(text) // 7)]
            if rng.random() < 0.3:
                text += passage
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_against_all_pairs(spark, seed):
    rows = corpus(seed)
    assert found(bitminhash.groups(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_rounds_and_pieces_lose_nothing(spark, monkeypatch):
    """Many rounds of small blocks give the same groups."""
    for name, value in (("FIRST", 1), ("LATER", 7), ("BLOCK", 4), ("GROWTH", 2), ("PARTNERS", 3), ("SMALL", 5)):
        monkeypatch.setattr(bitminhash, name, value)
    rows = corpus(5, groups=5, copies=90)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(bitminhash.groups(df)) == brute(rows)


def test_blocks_alone_find_all_links(spark, monkeypatch):
    """Also if no set is compared with a leading one first."""
    monkeypatch.setattr(bitminhash, "nearest_pairs", lambda members: members.select(F.col("sid").alias("a"), F.col("sid").alias("b")).limit(0))
    monkeypatch.setattr(bitminhash, "SMALL", 2)
    rows = corpus(6, groups=6, copies=70)
    assert found(bitminhash.groups(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)


def test_every_pair_of_a_bucket_s_blocks_meets_once(spark):
    df = spark.createDataFrame([(1, [2, 3, 5, 8, 9, 11]), (2, [4])], "key long, blocks array<long>")
    got = []
    for lo, hi in ((0, 1), (1, 4), (4, 16)):
        got += [(r["x"], r["y"]) for r in bitminhash.block_pairs(df.where(F.size("blocks") > lo), lo, hi).collect()]
    want = [(a, b) for a in (2, 3, 5, 8, 9, 11) for b in (2, 3, 5, 8, 9, 11) if a <= b] + [(4, 4)]
    assert sorted(got) == sorted(want)


def test_hard_rows(spark, hard):
    assert found(bitminhash.groups(hard)) == brute([(r[0], r[1]) for r in HARD])


def test_null_ids_and_repeated_ids(spark):
    rows = [(None, "a b c"), (None, "a b c"), (7, "A b C"), (None, "lonely words here"), (3, "x y z"), (3, "q r s"), (9, "q r s")]
    got = found(bitminhash.groups(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert (None, 2, 7, False) in got and (None, 2, None, True) in got and (9, 2, 3, False) in got


def test_an_empty_table(spark, empty):
    assert bitminhash.groups(empty).collect() == []


def test_estimates_are_corrected_for_chance():
    rng = np.random.default_rng(0)
    off = []
    for share in (0.0, 0.3, 0.6, 0.8, 1.0):
        for _ in range(20):
            n = 400
            common = round(2 * n * share / (1 + share))
            both = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
            a, b = both[:n], np.concatenate([both[:common], both[n : 2 * n - common]])
            bits = bitminhash.planes(bitminhash.minima([np.sort(a), np.sort(b)]))
            off.append((bitminhash.estimates(bits[:1], bits[1:])[0, 0] - common / (2 * n - common)) / 0.06)
    assert abs(np.mean(off)) < 0.4 and max(map(abs, off)) < 3.5


def test_bands_find_pairs_at_the_threshold():
    """Of 2,000 pairs of similarity 0.8 none is missed by bands and estimate."""
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(2000):
        both = rng.integers(0, 2**63, 100, dtype=np.uint64)  # 80 common, 10 in each alone
        sets += [np.sort(both[:90]), np.sort(np.concatenate([both[:80], both[90:]]))]
    low = bitminhash.minima(sets)
    keys, bits = bitminhash.band_keys(low), bitminhash.planes(low)
    assert (keys[::2] == keys[1::2]).any(axis=1).all()
    assert all(bitminhash.estimates(bits[i : i + 1], bits[i + 1 : i + 2])[0, 0] >= bitminhash.SURE for i in range(0, 4000, 2))


def test_shingle_sets_of_short_texts():
    sizes = [len(s) for s in bitminhash.shingle_sets(pa.array([None, "", " ", "one", "one two", "a a a a"]))]
    assert sizes == [0, 0, 0, 1, 1, 1]


def test_the_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, sf, "documents").collect()]
    assert found(queries.op13_bit_minhash(spark, sf)) == brute(rows)


def _shuffle_files(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles().iterator()
    count = 0
    while files.hasNext():
        count += files.next().getName().startswith("shuffle_")
    return count


def test_a_saved_table_leaves_no_shuffle_files(spark):
    conf = "spark.sql.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(conf), _shuffle_files(spark)
    got = tables.saved(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert sorted(r["count"] for r in got.collect()) == [142, 143, 143, 143, 143, 143, 143]
    until = time.time() + 20  # they are removed in the background
    while _shuffle_files(spark) > files and time.time() < until:
        time.sleep(0.1)
    assert _shuffle_files(spark) <= files and spark.conf.get(conf) == before


def test_signatures_go_and_bands_are_shuffled_once(spark, monkeypatch):
    plans = {}

    def saved(df, name, path=None):
        plans[name] = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        out = tables.saved(df, name, path)
        plans["path"] = path or plans.get("path")
        return out

    monkeypatch.setattr(bitminhash, "saved", saved)
    rows = corpus(3, groups=2, copies=20)
    assert found(bitminhash.groups(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert plans["buckets"].count("REPARTITION_BY_COL") == 2 and "hashpartitioning(key" in plans["buckets"]
    assert plans["buckets"].count("Exchange hashpartitioning(key") == 2  # the same one, which runs once
    assert not sub_folders_or_files(spark, plans["path"])
