"""N-gram Jaccard join: near-duplicate groups with skipping by set relations.

A document's set holds its distinct five-word shingles (lower-cased; fewer words: the whole
sequence as one). Two documents link when ``100 * intersection >= 80 * union``. ``groups`` returns
each document's set size and its component, the smallest doc_id reachable by links. Every link
between different sets is found or is implied by others; none is lost:

* Equal sets are one set (grouped by size and a 128-bit signature), so copies never meet in a list.
* Shingles are ordered from rare to frequent, by counts over all documents in ``2 ** 20`` hash
  buckets (4 MB at any size of the corpus; any order is right, this one keeps lists short). Linked
  sets share a shingle within their first ``n - ceil(0.8 n) + 1``; index lists are made of those,
  with each entry's position, and a pair is only looked at where its first shared shingle can be.
* A list is ordered by a hash of the set, alike in all lists. First its leading sets (``FIRST_BLOCK``) are
  compared with all sets after them, then all pairs of lists of ``SMALL`` sets or fewer. A pair is skipped
  if size or positions rule it out, or if both sets already belong to one component: a set that is highly
  similar to another one takes over its answers.
* The sets of longer lists that still hold several components are put into blocks of ``BLOCK``, by leader
  and size. Round by round, a list's next blocks (1, then up to 16, 256, ...) meet its later ones. A pair of
  blocks is skipped as a whole if, by the range of their sizes and the most that their positions in the
  list leave to share, no pair of their sets can link. Spark deals pairs of blocks to tasks one by one. In
  a task, sets whose first shared shingles come early enough are compared; a set takes over all answers
  of one that it links with, so that only links between components are looked for and returned. The
  rounds end when every list is used up or holds one component.
  Pairs of blocks that would move more than a ``ROUND_SHARE``-th of all sets' bytes go in several parts, one after
  the other, so that a round's disk stays in proportion to the input.
* Compared pairs are verified on the whole sets. Pairs of short lists are dealt by their first set; a set
  with many partners is split into salted groups. Before texts move, a pair is dropped if bitmaps of its sets
  show that they differ by more shingles than linked sets do: each shingle flips a bit, so that two bitmaps
  differ by no more bits than their sets do by shingles, and no link is lost.

Components come from label propagation with pointer jumping in Spark; nothing is gathered in the
driver but the bucket counts. Shingles are 64-bit hashes; a false match would need two shingles of
one compared pair to collide.

A null or empty text has an empty set, n_shingles 0, and is linked with nothing. Rows that repeat a
doc_id with different texts are documents of their own, told apart by a hash of both. Rows without a
doc_id take part in nothing and have a null component. Very long texts are read whole, in one task each.
Ties do not arise: links are exact, and a component's smallest doc_id names it. Other columns are not
looked at, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.tables import numbered, saved, without_leftovers
from dimload.llm.textbatch import BLANKS, Words, byte_table, fresh_name, mix, release_memory, slices, window_hashes, word_hashes

WIDTH, PERCENT = 5, 80
BUCKET_BITS, CHUNKS = 20, 256
FIRST_BLOCK, SMALL = 4, 64
BLOCK, BLOCK_GROWTH = 64, 16
BUFFER = 400_000  # pairs a task holds to drop repeated ones
LIST_ROWS = 50_000  # entries of lists of one component that a group of lists may hold
LOW = 0xFFFFFFFF  # a place holds a set's size above the entry's position
LEAD, LATER = 256, 4096  # entries of a list compared with each other at once
PARTNERS = 512  # of one set in one verification group
MIN_BITS = 64  # of a set's bitmap; larger sets have as many as shingles, up to twice
ROUND_SHARE, ROUND_BYTES = 4, 64 << 20  # a part of a round moves this share of all sets' bytes, or so many if that is more
_TABLE = byte_table(BLANKS, lower=True)


def least_overlap(n):
    """Shingles that a set of ``n`` shares with any linked set, at least."""
    return (PERCENT * n + 99) // 100


def linked(inter, n_a, n_b):
    return 100 * inter >= PERCENT * (n_a + n_b - inter)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(column, _TABLE)
    hashes = word_hashes(words.vocabulary)
    key, owner = window_hashes(words, hashes, WIDTH)
    bounds = np.searchsorted(owner, np.arange(len(words.counts) + 1))
    out = []
    for i, n in enumerate(words.counts.tolist()):
        if 0 < n < WIDTH:
            acc = np.full(1, np.uint64(n), dtype=np.uint64)
            for code in words.codes[words.bounds[i] : words.bounds[i + 1]]:
                acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[code])
            out.append(acc)
        else:
            out.append(np.unique(key[bounds[i] : bounds[i + 1]]))
    return out


def signature(hashes: np.ndarray) -> tuple[int, int]:
    """A 128-bit signature of a set, by two different mixed sums."""
    a = mix(hashes ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    b = mix(hashes + np.uint64(0xE7037ED1A0B428DB)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def parities(hashes: np.ndarray) -> bytes:
    """A bitmap of a set, a power of two bits, of which each shingle flips one."""
    size = max(MIN_BITS, 1 << max(0, len(hashes) - 1).bit_length())
    flips = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> int:
    """The bitmap of the same set that has ``size`` bytes, not more than ``bits`` has."""
    x, n = int.from_bytes(bits, "little"), 8 * len(bits)
    while n > 8 * size:
        n //= 2
        x = (x >> n) ^ (x & ((1 << n) - 1))
    return x


def may_link(n_a: int, n_b: int, bits_a: bytes, bits_b: bytes) -> bool:
    """Whether sets of these sizes can be linked though they differ by as many shingles as their bitmaps by bits."""
    size = min(len(bits_a), len(bits_b))
    differ = (folded(bits_a, size) ^ folded(bits_b, size)).bit_count()
    return 100 * (n_a + n_b - differ) >= PERCENT * (n_a + n_b + differ)


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


# --- counts in hash buckets, summed by chunks of buckets -------------------------------------------

_CHUNK = "chunk int, counts binary"


def _chunk_rows(counts: np.ndarray) -> tuple[list[int], list[bytes]]:
    parts = counts.reshape(CHUNKS, -1)
    used = np.flatnonzero(parts.any(axis=1)).tolist()
    return used, [zlib.compress(parts[c].astype("<i8").tobytes(), 1) for c in used]


def _summed_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for c, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            part = np.frombuffer(zlib.decompress(raw), "<i8")
            sums[c] = sums[c] + part if c in sums else part
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())], names=["chunk", "counts"]
    )


def total_counts(rows: DataFrame) -> np.ndarray:
    """The counts of all buckets from rows of chunks; 256 rows of 32 KB come to the driver."""
    out = np.zeros((CHUNKS, (1 << BUCKET_BITS) // CHUNKS), np.int64)
    with without_leftovers(rows.sparkSession):
        sums = rows.select("chunk", "counts").repartition("chunk").mapInArrow(_summed_chunks, _CHUNK).collect()
    for r in sums:
        out[r["chunk"]] += np.frombuffer(zlib.decompress(r["counts"]), "<i8")
    return out.ravel()


def _id_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        counts += np.bincount(id_bucket(batch.column(0).to_numpy(zero_copy_only=False)), minlength=len(counts))
    used, raw = _chunk_rows(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(raw, pa.binary())], names=["chunk", "counts"])


def id_bucket(ids: np.ndarray) -> np.ndarray:
    return buckets(mix(ids.astype(np.int64).view(np.uint64)))


# --- sets and index lists --------------------------------------------------------------------------

_SIGNED = "doc_id long, n int, sig1 long, sig2 long, bits binary, chunk int, counts binary"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and at the end of a partition its bucket counts in rows of chunks."""
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in slices(batches):
        sets = shingle_sets(batch.column("text"))
        counts += np.bincount(buckets(np.concatenate(sets)), minlength=len(counts))
        signs = [signature(s) for s in sets]
        empty = pa.nulls(len(sets))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int32()), pa.array([a for a, _ in signs], pa.int64()), pa.array([b for _, b in signs], pa.int64())]
            + [pa.array([parities(s) for s in sets], pa.binary()), empty.cast(pa.int32()), empty.cast(pa.binary())],
            names=["doc_id", "n", "sig1", "sig2", "bits", "chunk", "counts"],
        )
    used, raw = _chunk_rows(counts)
    empty = pa.nulls(len(used))
    yield pa.RecordBatch.from_arrays(
        [*(empty.cast(t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())), pa.array(used, pa.int32()), pa.array(raw, pa.binary())],
        names=["doc_id", "n", "sig1", "sig2", "bits", "chunk", "counts"],
    )


def _prefixes(levels: np.ndarray):
    """The first shingles of each set in the order of (bucket's level, hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, n, sig1, sig2, out = [], [], [], [], []
            for doc_id, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text")), strict=True):
                if doc_id is None or not len(s):
                    continue
                first = len(s) - least_overlap(len(s)) + 1
                order = np.argsort(levels[buckets(s)], kind="stable")[:first]
                a, b = signature(s)
                ids.append(doc_id), n.append(len(s)), sig1.append(a), sig2.append(b), out.append(s[order].tobytes())
            columns = [pa.array(x, t) for x, t in ((ids, pa.int64()), (n, pa.int32()), (sig1, pa.int64()), (sig2, pa.int64()), (out, pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "sig1", "sig2", "prefix"])

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column("prefix").to_pylist()
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        n = np.repeat(batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64), size)
        sid = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), size)
        columns = [pa.array(np.frombuffer(b"".join(raw), "<i8")), pa.array(sid), pa.array((n << 32) | place)]
        yield pa.RecordBatch.from_arrays(columns, names=["token", "sid", "place"])


def _possible(na, pa_, nb, pb):
    """Whether sets of these sizes can be linked with their first shared shingle at these positions:
    as many shingles as they need to share must be left in both from there on. A linked pair passes
    in the list of its first shared shingle, if not in others."""
    need = -(-PERCENT * (na + nb) // (100 + PERCENT))
    return (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)) & (np.minimum(na - pa_, nb - pb) >= need)


_PAIR = pa.schema([(c, pa.int64()) for c in ("token", "rank", "sid", "place", "a", "b")])


def _list_pairs(lo: int, hi: int, keep_long: bool):
    """Pairs of each list's sets of ranks lo to hi with all later sets of other components.

    Rows come sorted by list and rank order. With ``keep_long``, entries of lists beyond ``hi`` are
    returned too (token not null), for the next rounds. A task holds a block of a list, compares
    ``LEAD`` of its entries with ``LATER`` others at once, and holds pairs up to ``BUFFER``, since lists
    with common sets repeat them.
    """

    def packed_pairs(both: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(both.shape[1], pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(both[0]), pa.array(both[1])], schema=_PAIR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, rank = None, 0  # the list that is open, and its entries so far
        block: list[np.ndarray] = []  # its entries of ranks below hi: (rank, sid, place, comp)
        pairs: list[np.ndarray] = []
        held_pairs = 0

        def overflow() -> list[pa.RecordBatch]:
            nonlocal pairs, held_pairs
            if sum(x.shape[1] for x in pairs) > 2 * held_pairs + BUFFER // 4:
                pairs = [distinct_pairs(np.hstack(pairs))]
                held_pairs = pairs[0].shape[1]
                if held_pairs > BUFFER:
                    out, pairs, held_pairs = packed_pairs(pairs[0]), [], 0
                    return [out]
            return []

        for batch in batches:
            t = batch.column("token").to_numpy(zero_copy_only=False)
            cols = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("sid", "place", "comp")])
            if not len(t):
                continue
            start = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            stop = np.r_[start[1:], len(t)]
            longs = []
            whole = (t[start] != token) & (stop < len(t))  # lists that begin and end here
            if lo == 0:  # most lists hold two sets: all of them at once
                two = start[whole & (stop - start == 2)]
                place = cols[1]
                ok = (cols[2][two] != cols[2][two + 1]) & _possible(place[two] >> 32, place[two] & LOW, place[two + 1] >> 32, place[two + 1] & LOW)
                pairs.append(np.stack([cols[0][two[ok]], cols[0][two[ok] + 1]]))
            rest = ~(whole & (stop - start <= (2 if lo == 0 else 1)))
            for s, e in zip(start[rest].tolist(), stop[rest].tolist(), strict=True):
                if t[s] != token:
                    token, rank, block = t[s], 0, []
                rows = np.vstack([np.arange(rank, rank + e - s), cols[:, s:e]])
                before = rank
                rank += e - s
                fresh = rows[:, rows[0] < hi]
                if fresh.shape[1]:
                    block.append(fresh)
                held = np.hstack(block) if len(block) > 1 else block[0]
                block = [held]
                lead = held[:, held[0] >= lo]
                if keep_long and rank > hi:
                    kept = np.hstack([held, rows[:, rows[0] >= hi]]) if before <= hi else rows
                    longs.append(np.vstack([np.full(kept.shape[1], token), kept[:3]]))
                if not lead.shape[1]:
                    continue
                for i in range(0, rows.shape[1], LATER):
                    later = rows[:, i : i + LATER]
                    for j in range(0, lead.shape[1], LEAD):
                        some = lead[:, j : j + LEAD]
                        ok = (some[0][:, None] < later[0]) & (some[3][:, None] != later[3])
                        ok &= _possible(some[2][:, None] >> 32, some[2][:, None] & LOW, later[2] >> 32, later[2] & LOW)
                        a, b = np.nonzero(ok)
                        if len(a):
                            pairs.append(np.stack([some[1][a], later[1][b]]))
                            yield from overflow()
            yield from overflow()
            if longs:
                rows = np.hstack(longs)
                none = pa.nulls(rows.shape[1], pa.int64())
                yield pa.RecordBatch.from_arrays([*map(pa.array, rows), none, none], schema=_PAIR)
        if pairs:
            yield packed_pairs(distinct_pairs(np.hstack(pairs)))
        del block, pairs
        release_memory()

    return run


def distinct_pairs(both: np.ndarray) -> np.ndarray:
    """The different columns of two rows of ids."""
    order = np.lexsort(both)
    both = both[:, order]
    new = np.ones(both.shape[1], bool)
    new[1:] = (both[:, 1:] != both[:, :-1]).any(axis=0)
    return both[:, new]


# --- verification ----------------------------------------------------------------------------------


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b")]
        kept = pa.array([may_link(*row) for row in zip(*columns, strict=True)], pa.bool_())
        yield batch.select(["a", "b"]).filter(kept)


def likely(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (a, b) that the bitmaps of their sets (doc_id, n, bits) leave possible: all links, and few others."""
    one = bits.groupBy("doc_id").agg(F.any_value(F.struct("n", "bits")).alias("s")).select("doc_id", "s.n", "s.bits")
    a, b = (one.select(*(F.col(c).alias(d) for c, d in (("doc_id", x), ("n", f"n_{x}"), ("bits", f"bits_{x}")))) for x in ("a", "b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(_likely, "a long, b long")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of groups whose first row holds the set that the others are compared with."""
    mine = np.empty(0, np.uint64)
    for batch in slices(batches):
        out = []
        for a, b, s in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), shingle_sets(batch.column("text")), strict=True):
            if b is None:
                mine = s
                continue
            at = np.minimum(np.searchsorted(mine, s), len(mine) - 1)
            if linked(int((mine[at] == s).sum()), len(mine), len(s)):
                out.append((a, b))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _in_buckets(seen: bytes):
    """Rows whose doc_id falls in a marked bucket (a superset of the wanted ones), signed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(zlib.decompress(seen), np.uint8)
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            wanted = marks[id_bucket(batch.column("doc_id").to_numpy(zero_copy_only=False))] > 0
            for part in slices([batch.filter(pa.array(wanted))]):
                sets = shingle_sets(part.column("text"))
                signs = [signature(s) for s in sets]
                columns = [[len(s) for s in sets], [a for a, _ in signs], [b for _, b in signs]]
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "text", "n", "sig1", "sig2"])

    return run


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The links (a, b) among distinct candidate pairs of ids of ``texts`` (doc_id, text)."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    marks = (total_counts(ids.mapInArrow(_id_buckets, _CHUNK)) > 0).astype(np.uint8)
    wanted = texts.mapInArrow(_in_buckets(zlib.compress(marks.tobytes(), 1)), "doc_id long, text string, n long, sig1 long, sig2 long")
    wanted = wanted.groupBy("doc_id").agg(F.max_by("text", F.struct("n", "sig1", "sig2")).alias("text"))  # the row that stands for its doc_id
    partners = pairs.groupBy("a").agg(F.count("*").alias("_m"))
    pairs = pairs.join(partners, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("_m") / PARTNERS))).select("a", "salt", "b")
    firsts = pairs.select("a", "salt").distinct().join(wanted.withColumnRenamed("doc_id", "a"), "a")
    others = pairs.join(wanted.withColumnRenamed("doc_id", "b"), "b")
    rows = firsts.select("a", "salt", F.lit(None).cast("long").alias("b"), "text").unionByName(others.select("a", "salt", "b", "text"))
    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()).mapInArrow(_verified, "a long, b long")


# --- blocks of long lists ----------------------------------------------------------------------------

_OPEN = "doc_id long, n long, prefix binary, shingles binary"


def _open_sets(seen: bytes, levels: np.ndarray):
    """Size, first shingles and all of them, of rows whose doc_id falls in a marked bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(zlib.decompress(seen), np.uint8)
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            wanted = marks[id_bucket(batch.column("doc_id").to_numpy(zero_copy_only=False))] > 0
            for part in slices([batch.filter(pa.array(wanted))]):
                sets = shingle_sets(part.column("text"))
                first = [s[np.argsort(levels[buckets(s)], kind="stable")[: len(s) - least_overlap(len(s)) + 1]] if len(s) else s for s in sets]
                columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array([p.tobytes() for p in first]), pa.array([s.tobytes() for s in sets])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n", "prefix", "shingles"])

    return run


def in_blocks(members: DataFrame) -> DataFrame:
    """(sid, block): the sets of open lists; those of one leader and of like sizes lie together."""
    leader = members.groupBy("token").agg(F.min(F.struct(F.xxhash64("sid").alias("h"), "sid")).alias("leader"))
    of = members.join(leader, "token").groupBy("sid").agg(F.min("leader").alias("leader"), F.max("place").alias("n"))
    rows = of.select(F.lit("").alias("all"), "sid", F.shiftright("n", 32).alias("n"), F.col("leader.h").alias("u"), F.col("leader.sid").alias("v"))
    return numbered(rows, "all", *(F.col(c) for c in ("u", "v", "n", "sid"))).select("sid", F.expr(f"idx div {BLOCK}").alias("block"))


def list_blocks(members: DataFrame, block: DataFrame) -> DataFrame:
    """(token, blocks): of each list its blocks in order, with the range of their sets' sizes and the most
    shingles that a set has left from its position in the list on."""
    n, place = F.shiftright("place", 32), F.col("place").bitwiseAND(LOW)
    of = members.join(block, "sid").groupBy("token", "block").agg(F.min(n).alias("least"), F.max(n).alias("most"), F.max(n - place).alias("left"))
    return of.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("block", "least", "most", "left"))).alias("blocks"))


def block_pairs(blocks: DataFrame, lo: int, hi: int) -> DataFrame:
    """(x, y): of each list its blocks lo to hi - 1 with themselves and all later ones, but for those whose
    sizes or positions leave no pair that can link."""
    lead = blocks.select("blocks", F.posexplode(F.slice("blocks", lo + 1, hi - lo)).alias("i", "x"))
    both = lead.select("x", F.explode(F.slice("blocks", F.col("i") + F.lit(lo + 1), F.size("blocks"))).alias("y"))
    sizes = 100 * F.least("x.most", "y.most") >= PERCENT * F.greatest("x.least", "y.least")
    need = F.ceil(PERCENT * (F.col("x.least") + F.col("y.least")) / (100 + PERCENT))
    return both.where(sizes & (F.least("x.left", "y.left") >= need)).select(F.col("x.block").alias("x"), F.col("y.block").alias("y")).distinct()


def in_parts(pairs: DataFrame, weights: DataFrame, room: int) -> Iterator[DataFrame]:
    """The pairs (x, y) of blocks in parts whose blocks (block, bytes) hold about ``room`` bytes; in one if all do."""
    both = pairs.select(F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    moved = both.join(weights, "block").agg(F.sum("bytes")).first()[0] or 0
    parts = max(1, -(-moved // room))
    for part in range(parts):
        yield pairs.where(F.pmod(F.xxhash64("x", "y"), F.lit(parts)) == part) if parts > 1 else pairs


def _met(first: list[tuple], second: list[tuple]) -> Iterator[tuple[int, int]]:
    """Indices of pairs of (sid, n, comp, prefix, ...) that can link, by their first shared shingle."""
    sides = []
    for rows in (first, second):
        tokens = [np.frombuffer(r[3], np.uint64) for r in rows]
        owner = np.repeat(np.arange(len(rows)), [len(t) for t in tokens])
        place = np.concatenate([np.arange(len(t)) for t in tokens])
        flat = np.concatenate(tokens)
        order = np.argsort(flat, kind="stable")
        sides.append((flat[order], owner[order], place[order], np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)))
    (ta, oa, pa_, na, ca), (tb, ob, pb, nb, cb) = sides
    lo, hi = np.searchsorted(tb, ta), np.searchsorted(tb, ta, "right")
    i = np.repeat(np.arange(len(ta)), hi - lo)
    j = np.arange(len(i)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
    a, b, x, y = oa[i], ob[j], pa_[i], pb[j]
    ok = (ca[a] != cb[b]) & _possible(na[a], x, nb[b], y)
    return zip(*np.unique(np.stack([a[ok], b[ok]]), axis=1).tolist(), strict=True) if ok.any() else iter(())


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join components, of the sets of two blocks (or of one with itself); rows of a pair of
    blocks come together. A set that links with another takes over its component, and its later answers."""

    def links(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        first, second = ([r for r in rows if r[5] == r[side]] for side in (6, 7))
        root: dict[int, int] = {}

        def of(comp: int) -> int:
            while comp in root:
                comp = root[comp]
            return comp

        out = []
        for p, q in _met(first, second) if first and second else ():
            a, b = first[p], second[q]
            u, v = of(a[2]), of(b[2])
            if u == v:
                continue
            s, t = np.frombuffer(a[4], np.uint64), np.frombuffer(b[4], np.uint64)
            at = np.minimum(np.searchsorted(s, t), len(s) - 1)
            if linked(int((s[at] == t).sum()), len(s), len(t)):
                root[max(u, v)] = min(u, v)
                out.append((min(a[0], b[0]), max(a[0], b[0])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    pair, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("sid", "n", "comp", "prefix", "shingles", "block", "x", "y")]
        for row in zip(*columns, strict=True):
            if row[6:] != pair and rows:
                yield from links(rows)
                rows = []
            pair = row[6:]
            rows.append(row)
    yield from links(rows)
    release_memory()


# --- components ------------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable by ``links`` (a, b), for all nodes with a link."""
    edges = saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = saved(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).select(F.col("a").alias("node"), "comp"), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        lower = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("comp").alias("root"))
        step = saved(lower.join(jump, "new").select("node", "comp", F.least("new", "root").alias("new")), "labels")
        if step.where("new <> comp").isEmpty():
            return labels
        labels = step.select("node", F.col("new").alias("comp"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links: only the components that they join are looked at."""
    ends = links.select(F.col("a").alias("u"), F.col("b").alias("v"), F.explode(F.array("a", "b")).alias("node"))
    ends = saved(ends.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "link-ends")
    joined = components(ends.groupBy("u", "v").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("a", "b").distinct())
    known = labels.unionByName(ends.select("node", "comp").distinct()).distinct()
    new = joined.select(F.col("node").alias("comp"), F.col("comp").alias("lower"))
    return saved(known.join(new, "comp", "left").select("node", F.coalesce("lower", "comp").alias("comp")), "labels")


# --- the join --------------------------------------------------------------------------------------


def _groups(texts: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of all rows of ``texts`` (doc_id, text); a doc_id has one text."""
    signed = saved(texts.mapInArrow(_signed, _SIGNED), "signatures")
    counts = total_counts(signed.where("chunk is not null"))
    levels = (np.log2(np.maximum(counts, 1)) * 4).astype(np.uint8)
    rows = signed.where("chunk is null").select("doc_id", "n", "sig1", "sig2")
    one = rows.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.struct("n", "sig1", "sig2")).alias("s")).select("doc_id", "s.*")
    sets = saved(one.where("n > 0").groupBy("n", "sig1", "sig2").agg(F.min("doc_id").alias("sid"), F.count("*").alias("copies")), "sets")
    keys = ["n", "sig1", "sig2"]
    reps = sets.select(F.col("sid").alias("doc_id"), *keys)
    prefixes = texts.mapInArrow(_prefixes(levels), "doc_id long, n int, sig1 long, sig2 long, prefix binary")
    prefixes = prefixes.join(reps, ["doc_id", *keys], "left_semi")
    entries = prefixes.mapInArrow(_entries, "token long, sid long, place long")
    schema = "token long, rank long, sid long, place long, a long, b long"
    listed = entries.repartition("token").sortWithinPartitions("token", F.xxhash64("sid")).withColumn("comp", F.col("sid"))
    found = saved(listed.mapInArrow(_list_pairs(0, FIRST_BLOCK, True), schema), "lists")
    long_lists = found.where("token is not null").select("token", "rank", "sid", "place")
    pairs = found.where("token is null").select("a", "b").distinct()
    bits = signed.where("chunk is null and doc_id is not null").select("doc_id", "n", "bits")
    pairs = saved(likely(saved(pairs, "pairs"), bits), "likely-pairs")
    labels = components(saved(verify(pairs, texts), "links"))

    def open_lists(short: bool) -> DataFrame:
        """Entries of the lists with sets of different components, and their components."""
        labelled = long_lists.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
        mixed = labelled.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.max("rank").alias("r"), F.count("*").alias("m"))
        mixed = mixed.where((F.col("x") != F.col("y")) & ((F.col("r") < SMALL) if short else (F.col("r") >= SMALL)))
        return labelled.join(mixed.select("token", "x", "m"), "token")

    # short lists of one component have many sets in common: together, they yield a pair once
    left = open_lists(True)
    parts = left.groupBy("x").agg(F.ceil(F.count("*") / LIST_ROWS).alias("_parts"))
    left = left.join(parts, "x").withColumn("part", F.pmod(F.xxhash64("token"), F.col("_parts")))
    left = left.repartition("x", "part").sortWithinPartitions("token", "rank")
    pairs = saved(left.mapInArrow(_list_pairs(FIRST_BLOCK, SMALL, False), schema).select("a", "b").distinct(), "pairs")
    if not pairs.isEmpty():
        pairs = saved(likely(pairs, bits), "likely-pairs")
        more = saved(verify(pairs, texts), "links")
        if not more.isEmpty():
            labels = merged(labels, more)
    members = saved(open_lists(False).select("token", "sid", "place"), "open-lists")
    if not members.isEmpty():
        block = saved(in_blocks(members), "block-numbers")
        blocks = saved(list_blocks(members, block), "list-blocks")
        marks = (total_counts(block.select("sid").mapInArrow(_id_buckets, _CHUNK)) > 0).astype(np.uint8)
        found = texts.mapInArrow(_open_sets(zlib.compress(marks.tobytes(), 1), levels), _OPEN)
        one_each = found.groupBy(F.col("doc_id").alias("sid")).agg(F.any_value(F.struct("n", "prefix", "shingles")).alias("s"))
        blocked = saved(one_each.join(block, "sid").select("block", "sid", "s.n", "s.prefix", "s.shingles"), "blocks")
        weights = saved(blocked.groupBy("block").agg(F.sum(F.length("prefix") + F.length("shingles")).alias("bytes")), "block-bytes")
        room = max(ROUND_BYTES, 8 * (sets.agg(F.sum("n")).first()[0] or 0) // ROUND_SHARE)
        lo, hi, done = 0, 1, None
        while True:
            pairs = block_pairs(blocks.where(F.size("blocks") > lo).join(members.select("token").distinct(), "token", "left_semi"), lo, hi)
            pairs = saved(pairs if done is None else pairs.join(done, ["x", "y"], "left_anti"), "block-pairs")
            done = pairs if done is None else done.unionByName(pairs)
            for part in in_parts(pairs, weights, room):
                sides = part.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block")).join(blocked, "block")
                sides = sides.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
                sides = sides.repartition("x", "y").sortWithinPartitions("x", "y")
                more = saved(sides.mapInArrow(_block_links, "a long, b long").distinct(), "links")
                if not more.isEmpty():
                    labels = merged(labels, more)
            lo, hi = hi, hi * BLOCK_GROWTH
            members = saved(open_lists(False).join(blocks.where(F.size("blocks") > lo).select("token"), "token").select("token", "sid", "place"), "open-lists")
            if members.isEmpty():
                break
    of_set = sets.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select(*keys, "sid", F.coalesce("comp", "sid").alias("comp"))
    of_doc = one.join(of_set, keys).select("doc_id", F.col("comp").alias("component_id"))
    out = rows.join(of_doc, "doc_id", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def with_nodes(docs: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with a column that tells texts apart: the doc_id, or, for a doc_id that has several texts, a
    hash of both. And the doc_ids of such hashes (node, id), ``None`` where no doc_id has several texts."""
    doc_id, text = F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    ids = docs.select(doc_id.alias("id"), text.alias("t")).where("id is not null").groupBy("id").agg(F.min("t").alias("u"), F.max("t").alias("v"))
    several = saved(ids.where("u <> v").select(F.col("id").alias(name)), "repeated-ids")
    if several.isEmpty():
        return docs.withColumn(name, doc_id), None
    flag = fresh_name([*docs.columns, name], "_several")
    marked = docs.withColumn(name, doc_id).join(several.withColumn(flag, F.lit(True)), name, "left")
    hashed = F.when(F.col(flag), F.xxhash64(F.col(name), text)).otherwise(F.col(name))
    names = marked.where(F.col(flag)).select(hashed.alias("node"), F.col(name).alias("id")).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return marked.select(*columns, hashed.alias(name)), saved(names, "node-names")


def _members(noded: DataFrame, name: str, names: DataFrame | None) -> DataFrame:
    """doc_id, n_shingles, component_id, node and first (the node that stands for the component) of all rows."""
    rows = _groups(noded.select(F.col(name).alias("doc_id"), F.col("text").cast("string").alias("text")))
    rows = rows.select(F.col("doc_id").alias("node"), "n_shingles", F.col("component_id").alias("comp"))
    if names is None:
        return rows.select(F.col("node").alias("doc_id"), "n_shingles", F.col("comp").alias("component_id"), "node", F.col("comp").alias("first"))
    rows = rows.join(names, "node", "left").withColumn("doc_id", F.coalesce("id", "node")).drop("id")
    least = rows.where("comp is not null").groupBy("comp").agg(F.min(F.struct("doc_id", "node")).alias("s"))
    rows = rows.join(least, "comp", "left")
    return rows.select("doc_id", "n_shingles", F.col("s.doc_id").alias("component_id"), "node", F.col("s.node").alias("first"))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of all rows of ``docs`` (doc_id, text)."""
    return _members(*_noded(docs)).select("doc_id", "n_shingles", "component_id")


def _noded(docs: DataFrame) -> tuple[DataFrame, str, DataFrame | None]:
    name = fresh_name(docs.columns, "_node")
    noded, names = with_nodes(docs, name)
    return noded, name, names


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates, with all their columns: of each group a row of its
    smallest doc_id stays, and all rows without a doc_id. Of rows with the same doc_id and text the one
    stays whose columns, as JSON, come first."""
    noded, name, names = _noded(docs)
    member = saved(_members(noded, name, names), "members")
    gone = fresh_name(noded.columns, "_gone")
    others = saved(member.where("node <> first").select(F.col("node").alias(gone)).distinct(), "duplicates")
    kept = noded.join(others, F.col(name) == F.col(gone), "left_anti")
    repeated = saved(member.where("node is not null").groupBy("node").count().where("count > 1").select(F.col("node").alias(gone)), "repeated")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if repeated.isEmpty():
        return kept.select(*columns)
    whole = F.struct(*columns)
    some = kept.join(repeated, F.col(name) == F.col(gone), "left_semi").groupBy(name).agg(F.min_by(whole, F.to_json(whole)).alias(gone))
    rest = kept.join(repeated, F.col(name) == F.col(gone), "left_anti").select(*columns)
    return rest.unionByName(some.select(*[F.col(f"{gone}.`{c}`").alias(c) for c in docs.columns]))
