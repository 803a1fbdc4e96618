"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is found in a document that holds at least 80 % of the item's distinct five-word shingles
(lower-cased words; an item with fewer words is one shingle of all of them). Items are partitioned
by the size of their shingle set. Each partition has a sketch size, and an item's sketch is that
many of its smallest shingle hashes. A document may lack ``n - ceil(0.8 n)`` shingles of an item,
so one that holds the item holds all but so many of the sketch's hashes: documents with fewer hits
are passed over without losing a match, however long they are. The others are candidates, and their
whole texts are read again for the exact containment of shingles, compared as texts.

Only DataFrame functions are used. Sketches and candidates are written as tables, so Spark knows
their sizes when it picks the joins: small ones are broadcast below its threshold, larger ones are
shuffled. Documents' shingles meet nothing but sketches in the first pass, so they are not shuffled
while the sketches are small.

Tables and the result have at most as many files as the inputs' splits call for, however many partitions
a shuffle has: a file costs its task a process or two (Hadoop without its native library sets modes by
``chmod``), and many small files seem larger to Spark than their rows are. Splits are counted from the plans
of the inputs; one that shuffles without being saved is shuffled once more for it.

A null or empty text holds nothing, and an item without a word is found nowhere. Very long texts are
read whole. Rows that repeat a doc_id (or an item_id) are one document (item) with the shingles of all
of them. ``contaminated`` reports pairs of ids, so it passes over rows without one; ``keep`` searches
them too: rows without an id and of the same text are one document (item) of their own, by a 64-bit hash
in place of the id. Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload.llm.textbatch import fresh_name
from dimload.session import scratch_path

WIDTH, PERCENT = 5, 80
#: Files of shingles and of sketches for each split of the items; splits of the documents for each file of pairs.
FILES_A_SPLIT, SPLITS_A_FILE = 8, 8
_BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The lower-cased words of a text, an empty array without any."""
    low = F.btrim(F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase), F.lit(_BLANKS))
    return F.when(low == "", F.array().cast("array<string>")).otherwise(F.split(low, r"[\x20\x09-\x0D]+"))


def shingles(rows: DataFrame, width: int, *keep: str) -> DataFrame:
    """A row for each window of ``width`` words of the array ``w``, in columns w1, w2, ..."""
    windows = F.arrays_zip(*(F.slice("w", k + 1, F.greatest(F.size("w"), F.lit(1))).alias(f"w{k + 1}") for k in range(width)))
    names = [f"w{k + 1}" for k in range(width)]
    return rows.where(F.size("w") >= width).select(*keep, F.inline(windows).alias(*names)).where(F.col(names[-1]).isNotNull())


def all_shingles(rows: DataFrame, widths: list[int], shingle: Callable[[list[str]], Column], *keep: str) -> DataFrame:
    """The shingles of all ``widths`` (of the words of columns w1, w2, ...) in one pass over ``rows``."""
    names = [f"w{k + 1}" for k in range(max(widths))]
    windows = F.arrays_zip(*(F.slice("w", k + 1, F.greatest(F.size("w"), F.lit(1))).alias(n) for k, n in enumerate(names)))
    places = rows.select(*keep, F.inline(windows).alias(*names))
    if len(widths) == 1:
        return places.where(F.col(names[-1]).isNotNull()).select(*keep, F.lit(widths[0]).alias("width"), shingle(names).alias("shingle"))
    of = [F.when(F.col(names[w - 1]).isNotNull(), F.struct(F.lit(w).alias("width"), shingle(names[:w]).alias("shingle"))) for w in widths]
    return places.select(*keep, F.explode(F.array(*of)).alias("s")).where("s is not null").select(*keep, "s.width", "s.shingle")


def slack(n: Column) -> Column:
    """Shingles that a document may lack of an item of ``n``."""
    return n - F.ceil(n * PERCENT / 100).cast("int")


def _splits(df: DataFrame, column: str) -> int:
    """Tasks that read ``df``."""
    return max(1, df.select(column).rdd.getNumPartitions())


def _saved(df: DataFrame, name: str, files: int) -> DataFrame:
    """``df`` as a table of at most so many files."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.coalesce(files).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _pair_files(docs: DataFrame) -> int:
    """Files for rows of ids found in ``docs``, far smaller than their texts."""
    return -(-_splits(docs, "doc_id") // SPLITS_A_FILE)


def item_shingles(items: DataFrame) -> DataFrame:
    """item_id, width, n (distinct shingles), h and gram of all shingles of all items."""
    rows = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("w"))
    out = None
    for width in range(1, WIDTH + 1):
        some = rows.where(F.size("w") >= width if width == WIDTH else F.size("w") == width)
        names = [f"w{k + 1}" for k in range(width)]
        part = shingles(some, width, "item_id").select("item_id", F.lit(width).alias("width"), F.xxhash64(*names).alias("h"), F.concat_ws(" ", *names).alias("gram"))
        out = part if out is None else out.unionByName(part)
    out = out.distinct()
    return out.join(out.groupBy("item_id").agg(F.count("*").cast("int").alias("n")), "item_id")


def sketches(grams: DataFrame) -> DataFrame:
    """item_id, width, shingle (its hash) and least (hits that a document holding the item has) of all sketches."""
    n = F.col("n")
    upper = F.expr("shiftleft(1, length(bin(n))) - 1")  # the largest size of the item's partition
    size = F.least(n, 2 * slack(upper) + 1)
    hashes = grams.groupBy("item_id", "n").agg(F.sort_array(F.collect_set(F.struct("h", "width"))).alias("s"))
    cut = hashes.select("item_id", (size - slack(n)).alias("least"), F.explode(F.slice("s", F.lit(1), size)).alias("x"))
    return cut.select("item_id", "least", F.col("x.h").alias("shingle"), "x.width")


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_shingles, n_found and containment of all items found in ``docs``."""
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("w"))
    files = _splits(items, "item_id") * FILES_A_SPLIT
    grams = _saved(item_shingles(items), "item-shingles", files)
    sketch = _saved(sketches(grams), "sketches", files)
    widths = sorted(r["width"] for r in grams.select("width").distinct().collect())  # five values at most
    if not widths:
        return rows.sparkSession.createDataFrame([], "doc_id long, item_id long, n_shingles long, n_found long, containment double")
    files = _pair_files(rows)
    hashed = all_shingles(rows, widths, lambda names: F.xxhash64(*names), "doc_id")
    hits = hashed.join(sketch, ["width", "shingle"]).select("doc_id", "item_id", "least", "shingle")
    pairs = hits.distinct().groupBy("doc_id", "item_id", "least").agg(F.count("*").alias("k")).where("k >= least").select("doc_id", "item_id")
    pairs = _saved(pairs, "candidates", files)
    again = rows.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    seen = all_shingles(again, widths, lambda names: F.concat_ws(" ", *names), "doc_id")
    found = seen.join(grams.select("item_id", "n", "width", F.col("gram").alias("shingle")), ["width", "shingle"])
    found = found.join(pairs, ["doc_id", "item_id"], "left_semi").select("doc_id", "item_id", "n", "width", "shingle")
    exact = found.distinct().groupBy("doc_id", "item_id", "n").agg(F.count("*").alias("n_found")).where(F.col("n_found") * 100 >= F.col("n") * PERCENT)
    out = exact.select("doc_id", "item_id", F.col("n").cast("long").alias("n_shingles"), "n_found", (F.col("n_found") / F.col("n")).alias("containment"))
    return out.coalesce(files)


def keep(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    name = fresh_name(docs.columns, "_found")

    def key(column: str) -> Column:
        return F.coalesce(F.col(column).cast("long"), F.xxhash64(F.col("text").cast("string"), F.lit("without an id")))

    rows = docs.select(key("doc_id").alias("doc_id"), "text")
    found = contaminated(rows, items.select(key("item_id").alias("item_id"), "text"))
    found = _saved(found.select(F.col("doc_id").alias(name)).distinct(), "contaminated", _pair_files(rows))
    return docs.join(found, key("doc_id") == F.col(name), "left_anti")
