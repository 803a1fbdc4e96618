"""The Merkle manifest (op12) against a tree hashed level by level."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from dimload.llm import merkle, queries

from .conftest import HARD, SCHEMA


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def folded(nodes):
    """Each node's siblings level by level, as (left, right), and the root."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i - i % 2 : i - i % 2 + 2]
            paths[k].append((run[: i % 2], run[i % 2 + 1 :]))
        nodes = [H(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return paths, nodes[0]


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = [sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for lang in langs]
    inner = [folded([leaf(r) for r in t]) for t in trees]
    upper, root = folded([x[1] for x in inner])
    out = []
    for k, tree in enumerate(trees):
        for i, row in enumerate(tree):
            path = inner[k][0][i] + upper[k]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            digest = leaf((*row[:4], row[4] + 1)) if tampered and row[4] is not None else leaf(row)
            for left, right in path:
                digest = H(*left, digest, *right)
            out.append((row[0], leaf(row), inner[k][1], root, H(*(x for left, right in path for x in left + right)), digest, digest == root))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in df.collect()), key=repr)


def manifest(df, **kw):
    seventh = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(df, seventh, {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}, **kw)


@pytest.mark.parametrize("height", [1, 2, 12])
def test_trees_of_several_stages(spark, height):
    rng = random.Random(height)
    rows = [(rng.randrange(500), rng.choice(["a", "ü", "", None]), rng.choice(["en", "de", None, "", "Zü", "x"]), "s", rng.choice([None, 5, 2**63 - 1])) for _ in range(150)]
    got = found(manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), height=height))
    assert got == brute(rows) and {r[6] for r in got} == {True, False}


def test_hard_rows(spark, hard):
    assert found(manifest(hard)) == brute(HARD)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_small_trees(spark, n):
    rows = [(i, "t", "en", None, 1) for i in range(n)]
    assert found(manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    rows = [(i, "t", f"l{i}", None, 1) for i in range(n)]
    assert found(manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_an_empty_table(spark, empty):
    out = manifest(empty)
    assert out.collect() == [] and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_nothing_is_tampered_without_being_asked_for(spark, hard):
    assert all(r["verified"] for r in merkle.manifest(hard).collect())


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_folding_resumes_the_state_of_the_slot(arity):
    """Folded tops are those of a tree built anew, also for wider parents."""
    nodes = [H(str(i)) for i in range(23)]
    height = merkle.levels_above(len(nodes), arity)
    block = merkle.Block(nodes, height, arity)
    for i in range(len(nodes)):
        changed = nodes[:i] + [H("new")] + nodes[i + 1 :]
        assert block.fold(i, H("new")) == merkle.Block(changed, height, arity).top
        assert block.fold(i, nodes[i]) == block.top
        digest = nodes[i]
        for before, after in block.path(i):
            digest = H(before, digest, after)
        assert digest == block.top


def test_the_query_reads_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in queries.table(spark, sf, "documents").collect()]
    assert found(queries.op12_merkle_manifest(spark, sf)) == brute(rows)
