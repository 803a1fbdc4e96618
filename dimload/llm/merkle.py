"""Merkle manifest of a table, with proofs folded from copied hash states.

A row's leaf is the SHA-256 of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and
its value (integers decimal). The leaves of a tree, in order, are hashed in runs of ``ARITY`` into
parents, the last run holding what is left, until one node remains; a lone leaf stays as it is.
Digests go into hashes as lower-case hex. Each language is a tree, and the trees' roots, ordered by
language (null first, then bytewise), are the leaves of the tree above them.

Parents keep a copy of their hash state before each child slot. Folding a changed leaf resumes the
copied state of its slot with the new digest and hashes the right siblings only; nothing left of it
is hashed again. Trees are cut into blocks of ``ARITY ** HEIGHT`` nodes, one Spark group each: blocks
give the nodes of the next stage until each tree has one, and then hand the paths above their nodes
down to the blocks below, one row a block. States do not leave a task: a path holds the text that
leads to each state, and a task brings it back once for all the leaves of its block.

Order in a tree is (doc_id, leaf), null ids first. Rows that repeat a doc_id are leaves of their own,
and equal rows are equal leaves. A null lang is a language, an empty one is another. Empty and very
long texts are hashed like any other, by Spark; only digests reach Python. Other columns are not
looked at. An empty table gives no rows.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload.llm.tables import numbered, saved

ARITY, HEIGHT = 2, 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "tree string, n long, idx long, hash string"
_OUT = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
_PATH = "tree string, idx long, path array<struct<before:string,after:string>>, subroot string, root string"


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*(field(columns[c]) for c in FIELDS)).cast("binary"), 256)


def levels_above(n: int, arity: int = ARITY) -> int:
    """Levels of parents above ``n`` nodes."""
    out = 0
    while n > 1:
        n, out = -(-n // arity), out + 1
    return out


class Block:
    """Consecutive nodes and ``height`` levels of parents above them, which keep their states."""

    def __init__(self, nodes: list[str], height: int, arity: int = ARITY):
        self.arity, self.levels, self.states = arity, [nodes], []
        for _ in range(height):
            parents, copies = [], []
            for lo in range(0, len(nodes), arity):
                state, before = sha256(), []
                for child in nodes[lo : lo + arity]:
                    before.append(state.copy())
                    state.update(child.encode())
                parents.append(state.hexdigest())
                copies.append(before)
            self.levels.append(parents)
            self.states.append(copies)
            nodes = parents

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def fold(self, i: int, digest: str) -> str:
        """The top with node ``i`` replaced: each parent resumes its state before the changed slot."""
        for nodes, copies in zip(self.levels, self.states, strict=False):
            parent, slot = divmod(i, self.arity)
            state = copies[parent][slot].copy()
            state.update("".join((digest, *nodes[i + 1 : (parent + 1) * self.arity])).encode())
            digest, i = state.hexdigest(), parent
        return digest

    def path(self, i: int) -> list[tuple[str, str]]:
        """Level by level, the siblings left of and right of the way up from node ``i``."""
        out = []
        for nodes in self.levels[:-1]:
            lo = i - i % self.arity
            out.append(("".join(nodes[lo:i]), "".join(nodes[i + 1 : lo + self.arity])))
            i //= self.arity
        return out


def _block(rows: pd.DataFrame, height: int) -> Block:
    return Block(rows["hash"].tolist(), min(height, levels_above(int(rows["n"].iloc[0]))))


def _blocked(nodes: DataFrame, height: int):
    return nodes.groupBy("tree", F.expr(f"idx div {ARITY**height}").alias("block"))


def _top(height: int, key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("idx")
    n = -(-int(rows["n"].iloc[0]) // ARITY**height)
    return pd.DataFrame([(key[0], n, key[1], _block(rows, height).top)], columns=["tree", "n", "idx", "hash"])


def _paths(height: int, key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """The whole paths of a block's nodes: their own, then the block's."""
    rows, up = rows.sort_values("idx"), above.iloc[0]
    block, rest = _block(rows, height), [dict(x) for x in up["path"]]
    paths = [[{"before": b, "after": a} for b, a in block.path(i)] + rest for i in range(len(rows))]
    return pd.DataFrame({"tree": key[0], "idx": rows["idx"], "path": paths, "subroot": up["subroot"], "root": up["root"]})


def _folded(height: int, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Proofs and folded roots of a block's leaves."""
    rows, up = rows.sort_values("idx"), above.iloc[0]
    block = _block(rows, height)
    states = [(sha256(x["before"].encode()), x["after"].encode()) for x in up["path"]]
    upper = "".join(x["before"] + x["after"] for x in up["path"])
    proofs, roots = [], []
    for i, (own, changed) in enumerate(zip(rows["hash"], rows["tampered"], strict=True)):
        proofs.append(sha256(("".join(b + a for b, a in block.path(i)) + upper).encode()).hexdigest())
        digest = block.fold(i, changed if isinstance(changed, str) else own)
        for before, after in states:
            state = before.copy()
            state.update(digest.encode() + after)
            digest = state.hexdigest()
        roots.append(digest)
    return pd.DataFrame(
        {"doc_id": rows["doc_id"], "leaf": rows["hash"], "subroot": up["subroot"], "root": up["root"], "proof_sha256": proofs, "folded_root": roots}
    )


def stages(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The nodes, then the tops of their blocks, and so on, until every tree has one node."""
    out = [nodes]
    while out[-1].agg(F.max("n")).head()[0] > 1:
        out.append(saved(_blocked(out[-1], height).applyInPandas(lambda key, rows: _top(height, key, rows), _NODE), "merkle-nodes"))
    return out


def _handed_down(below: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """The paths of the nodes of the first stage, given those of the last one."""
    for nodes in reversed(below[:-1]):
        above = tops.groupBy("tree", F.col("idx").alias("block"))
        tops = saved(_blocked(nodes, height).cogroup(above).applyInPandas(lambda key, rows, above: _paths(height, key, rows, above), _PATH), "merkle-paths")
    return tops


def manifest(docs: DataFrame, tampered: Column | None = None, changed: dict[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of all rows of ``docs``.

    Where ``tampered`` holds, the folded root comes from a leaf whose fields are ``changed``. ``height``
    is that of a block; results do not depend on it."""
    columns = {c: F.col(f"`{c}`") for c in FIELDS}
    other = F.when(tampered, leaf({**columns, **(changed or {})})) if tampered is not None else F.lit(None).cast("string")
    tree = F.coalesce(F.concat(F.lit("+"), columns["lang"]), F.lit(""))
    rows = docs.select(columns["doc_id"].cast("long").alias("doc_id"), tree.alias("tree"), leaf(columns).alias("hash"), other.alias("tampered"))
    leaves = numbered(rows, "tree", F.col("doc_id"), F.col("hash")).withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas has no null integers
    leaves = saved(leaves, "leaves")
    if leaves.isEmpty():
        return leaves.sparkSession.createDataFrame([], _OUT.replace("doc_id string", "doc_id long") + ", verified boolean")
    trees = stages(leaves, height)
    subroots = trees[-1].select(F.lit("").alias("above"), F.col("tree").alias("lang"), "hash")
    subroots = saved(numbered(subroots, "above", F.col("lang")), "subroots")
    upper = stages(subroots.select(F.col("above").alias("tree"), "n", "idx", "hash"), height)
    none = F.array().cast("array<struct<before:string,after:string>>")
    top = upper[-1].select("tree", "idx", none.alias("path"), F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    paths = _handed_down(upper, top, height).drop("subroot", "tree")
    of_tree = subroots.join(paths, "idx").select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("idx"), "path", F.col("hash").alias("subroot"), "root")
    of_block = _handed_down(trees[1:], saved(of_tree, "tree-paths"), height) if len(trees) > 1 else of_tree
    above = of_block.groupBy("tree", F.col("idx").alias("block"))
    out = _blocked(leaves, height).cogroup(above).applyInPandas(lambda rows, above: _folded(height, rows, above), _OUT)
    return out.withColumns({"doc_id": F.col("doc_id").cast("long"), "verified": F.col("folded_root") == F.col("root")})
