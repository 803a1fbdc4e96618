"""WARC archives (op7) and the hypergeometric shuffle (op10)."""

import base64
import gzip
import hashlib
import os
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimload.llm import hypergeometric, warc

from .conftest import HARD

PAGES = [
    (1, "http://a.example/x", "<p>same</p>"),
    (2, "http://a.example/y", "<p>same</p>"),
    (3, None, "<p>same</p>"),
    (4, "http://a.example/ b\r\nX: y", "größe \U0001f600\r\n\r\nWARC/1.1"),
    (5, "http://e.example/", None),
    (6, "http://e.example/", ""),
    (7, "http://long.example/", "x" * 300_000),
    (8, "u", "once"),
    (8, "u", "once"),
    (None, "u", "<p>same</p>"),
    (None, "v", "nobody"),
]
SCHEMA = "page_id long, url string, html string"


def sha(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least=0):
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = max(same, default=None)
        refers = first if len(raw) >= least and first is not None and page_id != first else None
        out.append((page_id, len(raw), sha(html), "response" if refers is None else "revisit", refers))
    return Counter(out)


def records(df):
    return Counter(tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_out, least):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3).withColumns({"_digest": F.lit(1), "refers_to": F.lit(2), "file": F.lit("f")})
    warc.write_archive(pages, tmp_out, min_bytes=least)
    index = warc.read_index(spark, tmp_out)
    assert records(warc.read_archive(index, tmp_out)) == expected(PAGES, least)
    some = warc.read_archive(index.where("record_type = 'response' and page_id in (4, 7)"), tmp_out).collect()
    assert {r["page_id"]: r["html"] for r in some} == {4: PAGES[3][2], 7: PAGES[6][2]}


def test_archives_are_plain_warc(spark, tmp_out):
    warc.write_archive(spark.createDataFrame(PAGES[:4], SCHEMA).coalesce(1), tmp_out)
    index = warc.read_index(spark, tmp_out).collect()
    for r in index:
        with open(f"{tmp_out}/archives/{r['file']}", "rb") as f:
            f.seek(r["offset"])
            raw = gzip.decompress(f.read(r["length"]))
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and f"sha1:{r['payload_digest']}".encode() in raw
    whole = b"".join(gzip.decompress(open(f"{tmp_out}/archives/{n}", "rb").read()) for n in os.listdir(f"{tmp_out}/archives"))
    assert whole.count(b"WARC-Record-ID") == len(PAGES[:4])


def test_damage_is_found():
    raw = warc.record_bytes(1, "u", b"payload", warc.base32_sha1(b"payload"), None, "2000-01-01T00:00:00Z")
    assert warc.parse_record(raw)["html"] == "payload"
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))


def test_reading_follows_the_bytes(spark, tmp_out, monkeypatch):
    """Pieces of bounded bytes are read by tasks of their own, whatever the rows are."""
    monkeypatch.setattr(warc, "TASK_BYTES", 2_000)
    rng = np.random.default_rng(0)
    rows = [(i, f"http://x/{i}", rng.bytes(int(rng.integers(1, 900))).hex()) for i in range(120)]
    warc.write_archive(spark.createDataFrame(rows, SCHEMA).repartition(4), tmp_out)
    index = warc.read_index(spark, tmp_out)
    out = warc.read_archive(index, tmp_out)
    per_task = out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    total = index.agg(F.sum("length")).head()[0]
    assert len(per_task) > total / 2_000 / 2 and max(r["n"] for r in per_task) < 30
    assert {r["page_id"]: r["html"] for r in out.collect()} == {i: h for i, _, h in rows}
    assert warc.read_archive(index.where("page_id % 40 = 3"), tmp_out).count() == 3


def test_empty_archive(spark, tmp_out):
    warc.write_archive(spark.createDataFrame([], SCHEMA), tmp_out)
    assert warc.read_archive(warc.read_index(spark, tmp_out), tmp_out).collect() == []


# --- sharding


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=12), st.integers(1, 7), st.integers(1, 20), st.integers(0, 99))
def test_matrix_has_its_margins(counts, shards, target_rows, seed):
    counts = np.array(counts)
    _, _, room = hypergeometric.shard_targets(int(counts.sum()), shards, target_rows)
    rows = np.array([hypergeometric.matrix_row(counts, room, p, seed) for p in range(len(counts))])
    assert rows.sum(axis=1).tolist() == counts.tolist()
    assert rows.sum(axis=0).tolist() == room.tolist() and (rows >= 0).all()


@pytest.mark.parametrize("limit", [10**9, 10])
def test_draws_have_the_right_mean_and_spread(monkeypatch, limit):
    monkeypatch.setattr(hypergeometric, "NUMPY_LIMIT", limit)
    rng = np.random.default_rng(1)
    got = [hypergeometric.hypergeometric(rng, 60, 40, 30) for _ in range(20_000)]
    assert np.mean(got) == pytest.approx(18, abs=0.1)
    assert np.var(got) == pytest.approx(30 * 0.6 * 0.4 * 70 / 99, rel=0.05)
    assert sum(hypergeometric.split(rng, np.array([5, 0, 7, 8]), 9)) == 9


def test_rows_of_large_matrices_are_drawn_quickly():
    """8,000 partitions by 400,000 targets of 50,000 rows each."""
    import time

    targets = np.full(400_000, 50_000)
    counts = np.full(8_000, 400_000 * 50_000 // 8_000)
    t0 = time.time()
    row = hypergeometric.matrix_row(counts, targets, 5_432, 1)
    assert row.sum() == counts[0] and time.time() - t0 < 5
    assert row.var() == pytest.approx(6.25, rel=0.05)  # nearly Poisson


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=20), st.integers(0, 99), st.integers(1, 30))
def test_splits_in_halves_are_exact(targets, seed, limit):
    targets = np.array(targets)
    draws = int(np.random.default_rng(seed).integers(0, targets.sum() + 1))
    old, hypergeometric.NUMPY_LIMIT = hypergeometric.NUMPY_LIMIT, limit
    try:
        got = hypergeometric.split(np.random.default_rng(seed), targets, draws)
    finally:
        hypergeometric.NUMPY_LIMIT = old
    assert got.sum() == draws and (got >= 0).all() and (got <= targets).all()


def test_targets_hold_bounded_text(spark, monkeypatch):
    monkeypatch.setattr(hypergeometric, "TARGET_BYTES", 10_000)
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x" * 990).alias("text")).repartition(4)
    out = hypergeometric.shuffle_into_shards(df, shards=4)
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) <= 10 and sum(per_task) == 500
    assert sorted((r["shard"], r["slot"]) for r in out.collect()) == [(k, i) for k in range(4) for i in range(125)]


def test_huge_populations_are_drawn():
    got = hypergeometric.hypergeometric(np.random.default_rng(2), 6 * 10**10, 4 * 10**10, 10**9)
    assert abs(got - 6 * 10**8) < 10**6


@pytest.mark.parametrize("target_rows", [3, 50_000])
def test_shards_are_exact_and_gapless(spark, target_rows):
    df = spark.range(1001).select(F.col("id").alias("doc_id"), F.lit("t").alias("slot")).repartition(5)
    out = hypergeometric.shuffle_into_shards(df, shards=16, target_rows=target_rows).collect()
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(by) == list(range(16)) and {len(v) for v in by.values()} == {62, 63}
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sorted(r["doc_id"] for r in out) == list(range(1001))


def test_places_are_uniform(spark):
    df = spark.range(8).repartition(2)
    seen = Counter()
    for seed in range(60):
        for r in hypergeometric.shuffle_into_shards(df, shards=2, seed=seed, target_rows=2).collect():
            seen[r["id"], r["shard"]] += 1
    assert max(abs(n - 30) for n in seen.values()) < 20


def test_hard_rows_keep_their_columns(spark, hard, empty):
    out = hypergeometric.shuffle_into_shards(hard, shards=3)
    assert set(hard.columns) == set(out.columns) and out.where("_target = 'kept' and _order = 'kept'").count() == len(HARD)
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((r[0], r[1]) for r in HARD)
    assert hypergeometric.shuffle_into_shards(empty).collect() == []
    few = hypergeometric.shuffle_into_shards(spark.range(3), shards=16).collect()
    assert sorted(r["shard"] for r in few) == [0, 1, 2]


def test_matrix_without_rows():
    room = np.zeros(0, np.int64)
    assert hypergeometric.matrix_row(np.array([0, 0]), room, 1, 0).tolist() == []
