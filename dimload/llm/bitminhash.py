"""Near duplicates by b-bit MinHash.

A document's set holds its distinct two-word shingles (lower-cased; fewer words: the whole sequence
as one). Two documents link when ``100 * intersection >= 80 * union``; ``groups`` returns each row's
set size, its component (the smallest doc_id reachable by links) and whether it stays.

* Equal sets are one set (grouped by size and a 128-bit signature), so copies are never compared.
* A set has ``BANDS * ROWS`` minima. A band's key is a hash of its minima; of the minima themselves
  only ``BITS`` low bits are retained, packed into one plane a bit. A pair of similarity 0.8 shares no
  band with a chance of (1 - 0.8 ** ROWS) ** BANDS, 1.1e-6; that is all the method can miss.
* Sets with a band in common are candidates. Their similarity is estimated from the packed planes by
  bit counts: of minima that differ, 2 ** -BITS agree by chance, and the estimate is corrected for
  that. Pairs estimated below ``SURE`` are dropped; 0.8 lies over five standard deviations above it.
* The others are compared on their whole sets, as 64-bit hashes. Only those are links.

A bucket (the sets of a band's key) may hold a large group of near copies, so it isn't opened into all
pairs. First, each set is compared with one other: of the few leading sets of its buckets (the order is
by a hash that is alike in all buckets; places follow from hash and bucket size, no bucket is sorted) the
most similar one. That joins most of what belongs together, and a bucket of one component is done. In
the others that hold ``SMALL`` sets at most, all pairs that look similar are compared. The sets of larger
ones are put into blocks of ``BLOCK``, sets of the same leader together. Round by round, the next
leading blocks of each open bucket (1, then up to 16, 256, ...) meet its later ones; Spark deals pairs
of blocks to tasks one by one. A task compares the pairs of sets of different components that look
similar on their whole sets, the most similar ones first, and returns only links that join components.
The rounds end when no bucket is open: every pair with a common bucket has then been estimated and, if it
looks similar, compared, or lies in one component.

Each row is a document, also if rows repeat a doc_id. A null or empty text has an empty set,
n_shingles 0, and is linked with nothing: it stays. A row without a doc_id takes part, but names no
component; its component_id is null if no other row of it has an id, and only then it stays. Very
long texts are read whole; a set takes 8 bytes a shingle, and a task holds two blocks of them. Other columns are not looked at. An empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.setjoin import _CHUNK, _id_buckets, id_bucket, merged, signature, total_counts
from dimload.llm.tables import numbered, saved
from dimload.llm.textbatch import BLANKS, Words, byte_table, mix, slices, window_hashes, word_hashes
from dimload.session import remove_path, scratch_path

WIDTH, PERCENT = 2, 80
BANDS, ROWS, BITS = 45, 6, 2
SURE = 0.65
FIRST = 4  # leading sets of a bucket that others are compared with first
LATER = 2048  # sets of a bucket that meet them at once
SMALL = 32  # sets of a bucket whose pairs are compared one by one
BLOCK, GROWTH = 64, 16
PARTNERS = 512  # of one set in one verification group
_TABLE = byte_table(BLANKS, lower=True)
_SEED = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XOR, _FACTOR = (x.astype(np.uint32) for x in (_SEED[::2], _SEED[1::2] | np.uint64(1)))
_KEY = "n int, sig1 long, sig2 long"


def linked(inter, n_a, n_b):
    return 100 * inter >= PERCENT * (n_a + n_b - inter)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(column, _TABLE)
    hashes = word_hashes(words.vocabulary)
    key, owner = window_hashes(words, hashes, WIDTH)
    bounds = np.searchsorted(owner, np.arange(len(words.counts) + 1))
    out = [np.unique(key[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    for i in np.flatnonzero(words.counts == 1).tolist():
        out[i] = mix(hashes[words.codes[words.bounds[i] : words.bounds[i] + 1]] ^ np.uint64(1))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of all functions (columns) for each set (rows); no set is empty."""
    flat = mix(np.concatenate(sets)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(_XOR), len(sets)), np.uint32)
    for k, (x, f) in enumerate(zip(_XOR, _FACTOR, strict=True)):
        np.minimum.reduceat((flat ^ x) * f, starts, out=out[k])
    return out.T


def band_keys(low: np.ndarray) -> np.ndarray:
    """A hash of each band's minima, and of the band's number (sets by bands)."""
    parts = low.reshape(len(low), BANDS, ROWS).astype(np.uint64)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for r in range(ROWS):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return acc.view(np.int64)


def planes(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima: a packed row of bytes for each set, one plane a bit."""
    low = mix(low.astype(np.uint64))  # a minimum's own low bits are those of few shingles
    packed = [np.packbits((low >> np.uint64(b)) & np.uint64(1) > 0, axis=1) for b in range(BITS)]
    return np.concatenate(packed, axis=1)


_ONES = np.array([bin(x).count("1") for x in range(256)], np.uint16)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The similarity of all sets of ``a`` with all of ``b``, by their planes, without chance matches."""
    k = BANDS * ROWS
    width = a.shape[1] // BITS
    differ = np.zeros((len(a), len(b), width), np.uint8)
    for p in range(BITS):
        at = slice(p * width, (p + 1) * width)
        differ |= a[:, None, at] ^ b[None, :, at]
    agree = 1 - _ONES[differ].sum(axis=2, dtype=np.int32) / k
    chance = 2.0**-BITS
    return (agree - chance) / (1 - chance)


# --- sets and buckets ------------------------------------------------------------------------------

_SIGNED = f"doc_id long, {_KEY}, bits binary, bands array<long>"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, signature, planes and band keys of each document."""
    for batch in slices(batches):
        sets = shingle_sets(batch.column("text"))
        signs = [signature(s) for s in sets]
        full = [i for i, s in enumerate(sets) if len(s)]
        bits, bands = [None] * len(sets), [None] * len(sets)
        if full:
            low = minima([sets[i] for i in full])
            for i, x, y in zip(full, planes(low), band_keys(low), strict=True):
                bits[i], bands[i] = x.tobytes(), y
        columns = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int32())]
        columns += [pa.array([s[k] for s in signs], pa.int64()) for k in (0, 1)]
        columns += [pa.array(bits, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "sig1", "sig2", "bits", "bands"])


def _sets_of(marks: bytes):
    """The sets of the documents whose signature is marked (a superset of the wanted ones)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(zlib.decompress(marks), bool)
        for batch in slices(batches):
            out = [(len(s), *signature(s), s.tobytes()) for s in shingle_sets(batch.column("text")) if len(s)]
            hit = wanted[id_bucket(np.array([x[1] for x in out], np.int64))] if out else []
            out = [x for x, ok in zip(out, hit, strict=True) if ok]
            types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], names=["n", "sig1", "sig2", "shingles"])

    return run


def sets_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """sid and shingles of the sets ``wanted`` (sid and key), once each, from whole texts."""
    marks = total_counts(wanted.select("sig1").mapInArrow(_id_buckets, _CHUNK)) > 0
    keys = ["n", "sig1", "sig2"]
    found = texts.mapInArrow(_sets_of(zlib.compress(marks.tobytes(), 1)), f"{_KEY}, shingles binary")  # a million marks
    return found.groupBy(*keys).agg(F.any_value("shingles").alias("shingles")).join(wanted, keys).select("sid", "shingles")


# --- candidates ------------------------------------------------------------------------------------


def _similar(a: list, b: list) -> np.ndarray:
    """Estimates of all pairs of two lists of (sid, n, comp, bits, ...), -1 where they can't or needn't link."""
    (_, na, ca), (_, nb, cb) = (np.array([x[:3] for x in side], np.int64).T for side in (a, b))
    bits = [np.stack([np.frombuffer(x[3], np.uint8) for x in side]) for side in (a, b)]
    likely = np.concatenate([estimates(bits[0], bits[1][lo : lo + 256]) for lo in range(0, len(b), 256)], axis=1)
    ok = (ca[:, None] != cb) & (100 * np.minimum(na[:, None], nb) >= PERCENT * np.maximum(na[:, None], nb))
    return np.where(ok & (likely >= SURE), likely, -1.0)


def _pieces(batches: Iterator[pa.RecordBatch], key: list[str], columns: list[str]) -> Iterator[list[tuple]]:
    """The rows of each key, which come together."""
    last, rows = None, []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in key), strict=True)
        for k, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in columns), strict=True), strict=True):
            if k != last and rows:
                yield rows
                rows = []
            last = k
            rows.append(row)
    if rows:
        yield rows


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each set ``b`` of a piece of a bucket the leading set ``a`` that looks most similar."""
    for rows in _pieces(batches, ["key", "y"], ["sid", "n", "comp", "bits", "leads"]):
        lead, later = ([x for x in rows if x[4] is flag] for flag in (True, False))
        if lead and later:
            likely = _similar(lead, later)
            at, j = likely.argmax(axis=0), np.arange(len(later))
            best = likely[at, j]
            hit = np.flatnonzero(best >= SURE).tolist()
            if hit:
                columns = [pa.array([lead[at[k]][0] for k in hit]), pa.array([later[k][0] for k in hit]), pa.array(best[hit])]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "likely"])


def nearest_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each set with the most similar one of the leading sets of its buckets, if it looks similar.
    ``members`` are key, sid, n, comp, bits, place and m (the bucket's size)."""
    chunk = F.floor(F.col("place") / LATER).cast("int")
    lead = members.where(F.col("place") < FIRST).withColumn("y", F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / LATER).cast("int"))))
    columns = ["key", "y", "leads", "sid", "n", "comp", "bits"]
    both = lead.withColumn("leads", F.lit(True)).select(*columns)
    both = both.unionByName(members.withColumn("y", chunk).withColumn("leads", F.lit(False)).select(*columns))
    near = both.repartition("key", "y").sortWithinPartitions("key", "y").mapInArrow(_nearest, "a long, b long, likely double")
    best = near.groupBy("b").agg(F.max(F.struct("likely", "a")).alias("best"))
    return best.select(F.least("best.a", "b").alias("a"), F.greatest("best.a", "b").alias("b")).distinct()


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of sets of a bucket that look similar."""
    for rows in _pieces(batches, ["key"], ["sid", "n", "comp", "bits"]):
        i, j = np.nonzero(np.triu(_similar(rows, rows), 1) >= SURE)
        if len(i):
            sid = np.array([x[0] for x in rows], np.int64)
            pairs = np.sort(np.stack([sid[i], sid[j]]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def alike_pairs(members: DataFrame) -> DataFrame:
    """(a, b): all pairs of other components that look similar, of buckets that hold a few sets each."""
    return members.repartition("key").sortWithinPartitions("key").mapInArrow(_alike, "a long, b long").distinct()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join components, of the sets of two blocks (or of one with itself)."""
    for rows in _pieces(batches, ["x", "y"], ["sid", "n", "comp", "bits", "shingles", "block", "x", "y"]):
        first, second = ([r for r in rows if r[5] == r[side]] for side in (6, 7))
        if not first or not second:
            continue
        likely = _similar(first, second)
        i, j = np.nonzero(likely >= SURE)
        order = np.argsort(-likely[i, j], kind="stable")
        root: dict[int, int] = {}

        def of(comp: int, root: dict[int, int] = root) -> int:
            while comp in root:
                comp = root[comp]
            return comp

        out = []
        for p, q in zip(i[order].tolist(), j[order].tolist(), strict=True):
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


def in_blocks(members: DataFrame) -> DataFrame:
    """(sid, block): the sets of open buckets, those that have the same leader in one block if it holds them."""
    leader = members.groupBy("key").agg(F.min(F.struct("h", "sid")).alias("leader"))
    of = members.join(leader, "key").groupBy("sid").agg(F.min("leader").alias("leader"), F.first("h").alias("h"))
    rows = of.select(F.lit("").alias("all"), "sid", "h", F.col("leader.h").alias("u"), F.col("leader.sid").alias("v"))
    return numbered(rows, "all", *(F.col(c) for c in ("u", "v", "h", "sid"))).select("sid", F.expr(f"idx div {BLOCK}").alias("block"))


def block_pairs(blocks: DataFrame, lo: int, hi: int) -> DataFrame:
    """(x, y): of each bucket (key, blocks sorted) its blocks lo to hi - 1 with themselves and all later ones."""
    lead = blocks.select("blocks", F.posexplode(F.slice("blocks", lo + 1, hi - lo)).alias("i", "x"))
    later = F.slice("blocks", F.col("i") + F.lit(lo + 1), F.size("blocks"))
    return lead.select("x", F.explode(later).alias("y")).distinct()


# --- verification ----------------------------------------------------------------------------------


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of groups whose first row holds the set that the others are compared with."""
    mine = np.empty(0, np.uint64)
    for batch in slices(batches, "shingles"):
        out = []
        for a, b, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "shingles")), strict=True):
            s = np.frombuffer(raw, np.uint64)
            if b is None:
                mine = s
                continue
            at = np.minimum(np.searchsorted(mine, s), len(mine) - 1)
            if linked(int((mine[at] == s).sum()), len(mine), len(s)):
                out.append((a, b))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (a, b) among distinct candidate pairs of ``sets`` (sid, shingles)."""
    partners = pairs.groupBy("a").agg(F.count("*").alias("_m"))
    pairs = pairs.join(partners, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("_m") / PARTNERS))).select("a", "salt", "b")
    firsts = pairs.select("a", "salt").distinct().join(sets.withColumnRenamed("sid", "a"), "a")
    others = pairs.join(sets.withColumnRenamed("sid", "b"), "b")
    rows = firsts.select("a", "salt", F.lit(None).cast("long").alias("b"), "shingles").unionByName(others.select("a", "salt", "b", "shingles"))
    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()).mapInArrow(_verified, "a long, b long")


# --- groups ----------------------------------------------------------------------------------------


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of all rows of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = scratch_path(docs.sparkSession, "minhash")
    signed = saved(texts.mapInArrow(_signed, _SIGNED).withColumn("row", F.monotonically_increasing_id()), "minhash", path)
    keys = ["n", "sig1", "sig2"]
    rows = saved(signed.select("doc_id", *keys), "keys")
    # a set's number is that of one of its rows: no other set has it
    ids = signed.where("n > 0").groupBy(*keys).agg(F.min("row").alias("sid"), F.min("doc_id").alias("least"))
    sets = saved(ids, "sets")
    whole = signed.join(sets.select(F.col("sid").alias("row")), "row", "left_semi").withColumnRenamed("row", "sid")
    band = whole.select("sid", F.explode("bands").alias("key")).repartition("key")
    # most keys are alone; both sides of the join read the same columns, so that the bands are shuffled once
    shared = band.groupBy("key").agg(F.count("*").alias("m"), F.min("sid").alias("u"), F.max("sid").alias("v")).where("u < v").select("key", "m")
    h = F.shiftrightunsigned(F.xxhash64("sid"), 11)  # 53 bits, exact as a double
    placed = band.join(shared, "key").select("key", "m", "sid", h.alias("h"))
    place = F.least(F.floor(F.col("h") / F.lit(float(1 << 53)) * F.col("m")), F.col("m") - 1)
    placed = saved(placed.withColumn("place", place.cast("long")), "buckets")
    wanted = saved(whole.join(placed.select("sid").distinct(), "sid", "left_semi").select("sid", *keys, "bits"), "bucketed")
    remove_path(docs.sparkSession, path)
    contents = saved(sets_of(texts, wanted.drop("bits")), "shingles")
    labels = wanted.select(F.col("sid").alias("node"), F.col("sid").alias("comp"))

    def still_open() -> DataFrame:
        """Members of buckets with sets of different components."""
        labelled = placed.join(labels.withColumnRenamed("node", "sid"), "sid")
        mixed = labelled.groupBy("key").agg(F.min("comp").alias("u"), F.max("comp").alias("v")).where("u <> v").select("key")
        return labelled.join(mixed, "key")

    compared = None
    for step in (nearest_pairs, alike_pairs):
        members = placed.withColumn("comp", F.col("sid")) if compared is None else still_open().where(F.col("m") <= SMALL)
        pairs = step(members.join(wanted.select("sid", "n", "bits"), "sid"))
        pairs = saved(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti"), "pairs")
        compared = pairs
        links = saved(verify(pairs, contents), "links")
        if not links.isEmpty():
            labels = merged(labels, links)
    members = saved(still_open().where(F.col("m") > SMALL).drop("comp"), "open-buckets")
    if not members.isEmpty():
        block = saved(in_blocks(members), "block-numbers")
        blocked = saved(block.join(wanted, "sid").join(contents, "sid").select("block", "sid", "n", "bits", "shingles"), "blocks")
        blocks = saved(members.join(block, "sid").groupBy("key").agg(F.sort_array(F.collect_set("block")).alias("blocks")), "bucket-blocks")
        lo, hi, done = 0, 1, None
        while True:
            pairs = block_pairs(blocks.where(F.size("blocks") > lo).join(members.select("key").distinct(), "key"), lo, hi)
            pairs = saved(pairs if done is None else pairs.join(done, ["x", "y"], "left_anti"), "block-pairs")
            done = pairs if done is None else done.unionByName(pairs)
            sides = pairs.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block")).join(blocked, "block")
            sides = sides.join(labels.withColumnRenamed("node", "sid"), "sid").repartition("x", "y").sortWithinPartitions("x", "y")
            links = saved(sides.mapInArrow(_linked, "a long, b long").distinct(), "links")
            if not links.isEmpty():
                labels = merged(labels, links)
            lo, hi = hi, hi * GROWTH
            members = saved(still_open().drop("comp").join(blocks.where(F.size("blocks") > lo).select("key"), "key"), "open-buckets")
            if members.isEmpty():
                break
    of_set = sets.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    least = of_set.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_set = of_set.join(least, "comp").select(*keys, "component_id")
    out = rows.join(of_set, keys, "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))
