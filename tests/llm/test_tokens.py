"""Token ids, rANS blocks, the token store (op1) and Hilbert packing (op4) against whole-text encoding."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimload.llm import hilbert_pack, rans, token_store
from dimload.llm.tokens import WordTokenizer, ids_crc32, with_end

from .conftest import HARD, tokenizer_path, whole_ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def tokenizer():
    return WordTokenizer(tokenizer_path())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text("aAé .,'ßΣ1\ń\x1c<|>", max_size=60)), max_size=6))
def test_words_give_the_ids_of_whole_texts(texts):
    tokenizer = test_words_give_the_ids_of_whole_texts.__dict__.setdefault("t", WordTokenizer(tokenizer_path()))
    ids, bounds = tokenizer.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        want = tokenizer.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want


def test_end_ids(tokenizer):
    ids, bounds = with_end(*tokenizer.encode(pa.array(["a b", None, "c"])), 7)
    assert [ids[a:b].tolist()[-1] for a, b in zip(bounds, bounds[1:])] == [7, 7, 7]
    assert ids_crc32(ids) == crc(ids)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000, 300_000])
def test_rans_round_trip_from_every_checkpoint(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, 49_000).astype(np.uint16)
    table = rans.Table(rans.frequencies(np.bincount(ids, minlength=1 << 16)))
    assert table.freq.sum() == 1 << rans.BITS
    block = rans.encode(ids, table)
    assert rans.decode(block, table).tolist() == ids.tolist()
    for k, (step, _, _) in enumerate(block["checkpoints"]):
        assert rans.decode(block, table, k).tolist() == ids[step * block["lanes"] :].tolist()


def test_rans_keeps_rare_ids_and_finds_damage():
    counts = np.zeros(1 << 16, np.int64)
    counts[:50_000] = 1
    counts[0] = 10**12
    freq = rans.frequencies(counts)
    assert freq.sum() == 1 << rans.BITS and (freq[:50_000] > 0).all()
    row = rans.packed(rans.encode(np.arange(2000, dtype=np.uint16), rans.Table(freq)))
    fields = [row[c][0] for c in ("steps", "words", "states", "crc32")]
    table = rans.Table(freq)
    assert rans.decode_stored(row["n"], row["lanes"], *fields, table).tolist() == list(range(2000))[: row["lanes"] * rans.CHECKPOINT_STEPS]
    fields[1] = bytes([fields[1][0] ^ 1]) + fields[1][1:]
    with pytest.raises(ValueError):
        rans.decode_stored(row["n"], row["lanes"], *fields, table)


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=300), st.binary(max_size=5000))
def test_checksums_of_pieces_join(a, b):
    assert rans.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def stored(spark, docs, tmp_out, **kw):
    token_store.write_tokens(docs, f"{tmp_out}/store", tokenizer_path(), **kw)
    return token_store.read_tokens(spark, f"{tmp_out}/store")


def test_store_returns_all_ids_in_doc_order(spark, hard, tmp_out, monkeypatch):
    rows = stored(spark, hard, tmp_out).orderBy("start").collect()
    order = sorted(HARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for row, (doc_id, text, *_) in zip(rows, order, strict=True):
        ids = whole_ids(text) + [1]
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc_id, at, len(ids))
        assert np.frombuffer(row["ids"], "<u2").tolist() == ids
        at += len(ids)
    digests = token_store.read_tokens(spark, f"{tmp_out}/store", digests=True).orderBy("start").collect()
    assert [r["ids_crc32"] for r in digests] == [crc(whole_ids(t) + [1]) for _, t, *_ in order]


@pytest.mark.parametrize("block_tokens", [1, 50, 7000])
def test_store_cuts_blocks_inside_documents(spark, hard, tmp_out, block_tokens):
    """A document of several blocks and checkpoints comes back whole, digests and all."""
    long = " ".join(f"word{i % 997}" for i in range(9000 if block_tokens > 1 else 30))
    rows = [(7, "short one"), (8, long), (8, "again"), (9, None), (10, long[::-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    out = stored(spark, docs, tmp_out, block_tokens=block_tokens).orderBy("start").collect()
    at = 0
    order = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    for row, (doc_id, text) in zip(out, order, strict=True):
        ids = whole_ids(text) + [1]
        assert (row["doc_id"], row["start"], np.frombuffer(row["ids"], "<u2").tolist()) == (doc_id, at, ids)
        at += len(ids)
    digests = token_store.read_tokens(spark, f"{tmp_out}/store", digests=True).orderBy("start").collect()
    assert [r["ids_crc32"] for r in digests] == [crc(whole_ids(t) + [1]) for _, t in order]
    blocks = spark.read.parquet(f"{tmp_out}/store/blocks")
    assert blocks.where(f"n > {block_tokens}").isEmpty() and blocks.where("skip > 0").count() >= 3
    pieces = token_store.read_pieces(spark, f"{tmp_out}/store")
    assert pieces.where("doc_id = 10").count() >= 2


def test_store_cuts_blocks_between_documents(spark, tmp_out):
    docs = spark.createDataFrame([(i, f"word number {i} " * (i % 7)) for i in range(200)], "doc_id long, text string").repartition(5)
    rows = stored(spark, docs, tmp_out, block_tokens=50).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == list(range(200))
    assert [r["start"] for r in rows] == list(np.cumsum([0] + [r["n_tokens"] for r in rows[:-1]]))


def test_empty_store(spark, empty, tmp_out):
    assert stored(spark, empty, tmp_out).collect() == []


def pieces_of(rows):
    out = {}
    for r in rows:
        out.setdefault(r["sequence_id"], []).append(r)
    return {k: sorted(v, key=lambda r: r["offset"]) for k, v in out.items()}


def test_packing_places_every_id_once_without_padding(spark, hard):
    rows = hilbert_pack.pack(hard, tokenizer_path(), size=64).collect()
    for pieces in pieces_of(rows).values():
        at = 0
        for r in pieces:
            assert r["offset"] == at and r["length"] == len(r["tokens"]) // 2
            at += r["length"]
        assert at == 64 or at & (at - 1) == 0
    want = {i: [] for i in {r[0] for r in HARD}}
    for doc_id, text, *_ in HARD:
        want[doc_id].append(whole_ids(text) + [2])
    for doc_id, texts in want.items():
        mine = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: (r["doc_tokens"], r["start"]))
        got = [i for r in mine for i in np.frombuffer(r["tokens"], "<u2").tolist()]
        if len(texts) == 1:
            assert got == texts[0]
        assert sorted(got) == sorted(i for ids in texts for i in ids)
        assert all(r["ids_crc32"] == crc(np.frombuffer(r["tokens"], "<u2")) for r in mine)


def test_packing_an_empty_table(empty):
    assert hilbert_pack.pack(empty, tokenizer_path()).collect() == []


def test_few_documents_lie_on_the_edge_of_the_grid(spark):
    """At every length the cells spread over the grid, and like documents are neighbours."""
    rng = np.random.default_rng(2)
    kinds = rng.dirichlet(np.full(3000, 0.05), 6)
    sizes = np.repeat([50, 1000, 10_000], 100)
    ids = [rng.choice(3000, n, p=kinds[i % 6]).astype(np.uint16) for i, n in enumerate(sizes)]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    sums = hilbert_pack.vector_sums(np.concatenate(ids), bounds)
    cells = hilbert_pack.cells(sums, sizes, sums.sum(axis=0) / sizes.sum())
    edge = ((cells <= 0) | (cells >= (1 << hilbert_pack.GRID_BITS) - 1)).any(axis=1)
    for n in (50, 1000, 10_000):
        assert edge[sizes == n].mean() < 0.01
    order = np.argsort(hilbert_pack.hilbert_keys(cells[sizes == 10_000]))
    assert (np.diff(np.arange(100)[order] % 6) == 0).mean() > 0.8  # one kind after the other
    middle = hilbert_pack.cells(np.zeros((1, 4)), np.array([1]), np.zeros(4))
    assert (middle == 1 << (hilbert_pack.GRID_BITS - 1)).all()


def test_hilbert_neighbours_are_adjacent_cells():
    bits = 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * 2, indexing="ij"), -1).reshape(-1, 2)
    order = np.argsort(hilbert_pack.hilbert_keys(cells, bits))
    keys = hilbert_pack.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_powers_of_two():
    assert hilbert_pack.powers_of_two(0) == [] and hilbert_pack.powers_of_two(13) == [8, 4, 1]
