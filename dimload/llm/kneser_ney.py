"""Language identification with interpolated Kneser-Ney character models.

One model for each language: interpolated Kneser-Ney over the characters of lower-cased words, each
word between boundary marks, with contexts of up to ``ORDER - 1`` characters. Counts come from all
training documents: tasks count each distinct word's n-grams once, weighted by the word's
frequency, and Spark adds them up. A fitted model is two arrays sorted by 64-bit hash, n-grams with
their discounted shares and contexts with their back-off weights, looked up by binary search.

A document takes the language with the lowest cross-entropy per character. ``score`` is the chance
that the best language beats the second, from the difference of their cross-entropies times the
text's length; its steepness is calibrated on all training documents. ``rejected`` marks documents
whose cross-entropy lies beyond what ``REJECT`` of the training documents of that language reach (of
all languages, for one of which no training document is told right). The models have seen the training
documents, so these bounds are somewhat tight; fitting models on halves for them would cost as much
again as all of the rest.

Models hold all n-grams of the training documents. Spark computes them and writes them to the shared
folder in shards by ranges of hashes, and nothing but two numbers a language comes to the driver.
Tasks score ``GROUP_BYTES`` of text at a time: they read one shard after the other and keep what
those texts' n-grams need, so a task holds no more of a model than that and one shard (``CACHE_BYTES``
of shards stay in memory, which saves reading them again). A text that is null or has no letter is ``und`` with score 0. Without
training rows all documents are ``und``. Languages tied in cross-entropy are taken in alphabetical
order; repeated rows count as often as they occur; very long texts are read whole, a slice by itself;
other columns than doc_id, text and lang are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.textbatch import Words, as_string, mix, slices
from dimload.session import scratch_path

ORDER = 4
SHARD_ROWS = 1 << 20  # entries of a shard
GROUP_BYTES, CACHE_BYTES = 8 << 20, 64 << 20
REJECT = 0.999
STEEPNESS = (0.003, 0.01, 0.03, 0.1, 0.3, 1.0, 3.0)
#: gK: hash of the K characters up to here; cK: of the K characters before; depth: the longest.
_CHAIN = [f"g{k}" for k in range(1, ORDER + 1)] + [f"c{k}" for k in range(1, ORDER)]
_COUNTS = "lang string, gram long, depth int, " + ", ".join(f"{c} long" for c in _CHAIN) + ", n long"


def positions(vocabulary: pa.Array) -> dict[str, np.ndarray]:
    """All predicted places (characters and closing marks) of words: the word, the length of the
    longest n-gram that ends there, and the hashes of the n-grams and contexts of each length."""
    words = as_string(vocabulary).to_pylist()
    text = "\0" + "".join(w.replace("\0", "�") + "\0" for w in words)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    mark = chars == 0
    at = np.arange(len(chars))
    opened = np.maximum.accumulate(np.where(mark, at, 0))
    opened = np.concatenate([[0], opened[:-1]])  # the last mark before each place
    depth = np.minimum(ORDER, at - opened + 1)
    grams = [mix(chars + np.uint64(1 << 40))]
    for k in range(2, ORDER + 1):
        before = np.concatenate([grams[-1][:1], grams[-1][:-1]])
        grams.append(mix(before * np.uint64(0x9E3779B97F4A7C15) + chars + np.uint64(k << 40)))
    out = {f"g{k}": g[1:] for k, g in enumerate(grams, 1)}
    out |= {f"c{k}": np.concatenate([g[:1], g[:-1]])[1:] for k, g in enumerate(grams[:-1], 1)}
    out["depth"] = depth[1:]
    out["word"] = (np.cumsum(mark) - mark)[1:] - 1
    out["gram"] = np.choose(out["depth"] - 1, [out[f"g{k}"] for k in range(1, ORDER + 1)])
    return out


def _lowered(column: pa.Array) -> Words:
    return Words(pc.utf8_lower(as_string(column)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "gram", "depth", *_CHAIN, "n"]
    for batch in slices(batches):
        langs = batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            words = _lowered(batch.filter(pc.equal(langs, lang)).column("text"))
            if not len(words.codes):
                continue
            weight = np.bincount(words.codes, minlength=len(words.vocabulary))
            p = positions(words.vocabulary)
            _, first, inverse = np.unique(p["gram"], return_index=True, return_inverse=True)
            n = np.bincount(inverse, weights=weight[p["word"]], minlength=len(first)).astype(np.int64)
            longs = [pa.array(p[c][first].view(np.int64)) for c in ("gram", *_CHAIN)]
            columns = [pa.array([lang] * len(first)), longs[0], pa.array(p["depth"][first].astype(np.int32)), *longs[1:], pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def gram_counts(training: DataFrame) -> DataFrame:
    """Counts of the longest n-grams of all places, by language, over all of ``training``."""
    rows = training.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = rows.where("text is not null and lang is not null").mapInArrow(_counted, _COUNTS)
    same = [F.first(c).alias(c) for c in ("depth", *_CHAIN)]  # equal n-grams have equal chains
    return counts.groupBy("lang", "gram").agg(*same, F.sum("n").alias("n"))


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def log_chances(model: dict[str, np.ndarray], p: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Interpolated Kneser-Ney log probability of each place in ``rows``."""
    depth = p["depth"][rows]
    chance = _looked_up(model["grams"], model["gram_values"], p["g1"][rows], 0.0) + model["root"][0] / model["characters"][0]
    for k in range(2, ORDER + 1):
        share = _looked_up(model["grams"], model["gram_values"], p[f"g{k}"][rows], 0.0)
        back = _looked_up(model["contexts"], model["context_values"], p[f"c{k - 1}"][rows], 1.0)
        chance = np.where(depth >= k, share + back * chance, chance)
    return np.log(np.maximum(chance, 1e-12))


# --- models of all n-grams, in shards ---------------------------------------------------------------

_ENTRY = "lang string, kind string, key long, value float"


@dataclass(frozen=True, eq=False)
class Models(Mapping):
    """Models by language. ``files`` are the shards; ``heads`` has each language's number of
    characters and the weight that an empty context leaves to unseen ones. Looking a language up
    brings its whole arrays to the caller, which scoring never does."""

    table: DataFrame
    files: tuple[str, ...]
    heads: dict[str, tuple[float, float]]

    def __getitem__(self, lang: str) -> dict[str, np.ndarray]:
        characters, root = self.heads[lang]
        rows = self.table.where(F.col("lang") == lang).select("kind", "key", "value").toPandas()
        out = {"characters": np.array([characters]), "root": np.array([root])}
        for kind in ("grams", "contexts"):
            of_kind = rows[rows["kind"] == kind]
            keys = of_kind["key"].to_numpy(np.int64).view(np.uint64)
            order = np.argsort(keys)
            out[kind], out[kind[:-1] + "_values"] = keys[order], of_kind["value"].to_numpy(np.float32)[order]
        return out

    def __iter__(self) -> Iterator[str]:
        return iter(sorted(self.heads))

    def __len__(self) -> int:
        return len(self.heads)


def _saved(df: DataFrame, name: str) -> DataFrame:
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _level(grams: DataFrame, k: int) -> DataFrame:
    """The n-grams of ``k`` characters with their contexts: how often they occur where no longer one
    does, and the number of different characters seen before them elsewhere."""
    same = [F.col(f"g{k}").alias("key"), (F.col(f"c{k - 1}") if k > 1 else F.lit(0).cast("long")).alias("context")]
    here = grams.where(F.col("depth") == k).select("lang", *same, "n")
    if k < ORDER:
        longer = grams.where(F.col("depth") > k).select("lang", f"g{k + 1}", *same).distinct()
        here = here.unionByName(longer.select("lang", "key", "context", F.lit(1).cast("long").alias("n")))
    counts = here.groupBy("lang", "key").agg(F.first("context").alias("context"), F.sum("n").alias("n"))
    return counts.select("lang", F.lit(k).alias("k"), "key", "context", "n")


def fit(training: DataFrame) -> Models:
    """Models by language, from all n-grams of ``training`` (text, lang)."""
    spark = training.sparkSession
    grams = _saved(gram_counts(training), "gram-counts")
    levels = _saved(reduce(DataFrame.unionByName, (_level(grams, k) for k in range(1, ORDER + 1))), "gram-levels")
    n, once, twice = F.col("n"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    discount = F.least(F.lit(0.95), F.greatest(F.lit(0.1), once / F.greatest(once + 2 * twice, F.lit(1))))
    discounts = levels.groupBy("lang", "k").agg(discount.alias("discount"))  # ORDER rows for each language
    contexts = levels.groupBy("lang", "k", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    weight = F.least(F.lit(1.0), F.col("discount") * F.col("kinds") / F.col("total"))
    contexts = _saved(contexts.join(F.broadcast(discounts), ["lang", "k"]).withColumn("weight", weight), "contexts")
    share = (n - F.least(F.col("discount"), n.cast("double"))) / F.col("total")
    entries = levels.join(contexts, ["lang", "k", "context"]).select("lang", F.lit("grams").alias("kind"), "key", share.cast("float").alias("value"))
    backs = contexts.where("k > 1").select("lang", F.lit("contexts").alias("kind"), F.col("context").alias("key"), F.col("weight").cast("float").alias("value"))
    shards = -(-(levels.count() + contexts.count()) // SHARD_ROWS)
    path = scratch_path(spark, "language-models")
    entries.unionByName(backs).repartitionByRange(max(shards, 1), "key").write.parquet(path)
    table = spark.read.schema(_ENTRY).parquet(path)
    heads = {r["lang"]: (r["kinds"] + 1.0, r["weight"]) for r in contexts.where("k = 1").collect()}  # a row for each language
    return Models(table, tuple(sorted(table.inputFiles())), heads)


_cached: dict[str, dict[tuple[str, str], tuple[np.ndarray, np.ndarray]]] = {}


def _shard(file: str, model: frozenset[str]) -> dict[tuple[str, str], tuple[np.ndarray, np.ndarray]]:
    """The sorted hashes and values of each language and kind in one of the files of ``model``."""
    for other in _cached.keys() - model:
        del _cached[other]
    if file in _cached:
        return _cached[file]
    import pyarrow.fs
    import pyarrow.parquet as pq

    system, path = pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", file))
    rows = pq.read_table(path, filesystem=system).to_pandas()
    out = {}
    for name, part in rows.groupby(["lang", "kind"]):
        keys = part["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        out[name] = keys[order], part["value"].to_numpy(np.float32)[order]
    if sum(k.nbytes + v.nbytes for shard in (out, *_cached.values()) for k, v in shard.values()) <= CACHE_BYTES:
        _cached[file] = out
    return out


def _needed(files: tuple[str, ...], langs: list[str], wanted: dict[str, np.ndarray]) -> dict[str, dict[str, np.ndarray]]:
    """What the models hold of the ``wanted`` sorted hashes of each kind."""
    found: dict[tuple[str, str], list[tuple[np.ndarray, np.ndarray]]] = {(lang, kind): [] for lang in langs for kind in wanted}
    model = frozenset(files)
    for file in files:
        for name, (keys, values) in _shard(file, model).items():
            some = wanted[name[1]]
            some = some[np.searchsorted(some, keys[0]) : np.searchsorted(some, keys[-1], "right")]
            at = np.searchsorted(keys, some)
            hit = at[keys[at] == some]
            found[name].append((keys[hit], values[hit]))
    out: dict[str, dict[str, np.ndarray]] = {lang: {} for lang in langs}
    for (lang, kind), parts in found.items():
        keys = np.concatenate([np.empty(0, np.uint64), *(k for k, _ in parts)])
        order = np.argsort(keys)
        out[lang][kind] = keys[order]
        out[lang][kind[:-1] + "_values"] = np.concatenate([np.empty(0, np.float32), *(v for _, v in parts)])[order]
    return out


class _Placed:
    """A slice's words and the distinct n-grams of their places."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch.drop_columns(["text"])
        text = as_string(batch.column("text"))
        words = _lowered(text)
        self.codes, self.counts, self.size = words.codes, words.counts, len(words.vocabulary)
        self.letters = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False)
        self.grams: dict[str, np.ndarray] = {}
        if len(words.codes):
            p = positions(words.vocabulary)
            _, first, self.inverse = np.unique(p["gram"], return_index=True, return_inverse=True)
            self.word, self.grams = p["word"], {c: p[c][first] for c in ("depth", *_CHAIN)}

    def entropies(self, models: list[dict[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropies by model and text, and the texts' numbers of places."""
        n = len(self.counts)
        entropy, length = np.full((len(models), n), np.inf), np.zeros(n)
        if self.grams:
            owner = np.repeat(np.arange(n), self.counts)
            rows = np.arange(len(self.grams["depth"]))
            length = np.bincount(owner, weights=np.bincount(self.word, minlength=self.size)[self.codes], minlength=n)
            for k, model in enumerate(models):
                at_place = log_chances(model, self.grams, rows)[self.inverse]
                of_word = np.bincount(self.word, weights=at_place, minlength=self.size)
                entropy[k] = -np.bincount(owner, weights=of_word[self.codes], minlength=n) / np.maximum(length, 1)
        return entropy, length


def _scored(files: tuple[str, ...], heads: dict[str, tuple[float, float]]):
    langs = sorted(heads)

    def group_rows(group: list[_Placed]) -> Iterator[pa.RecordBatch]:
        wanted = {}
        for kind, columns in (("grams", _CHAIN[:ORDER]), ("contexts", _CHAIN[ORDER:])):
            wanted[kind] = np.unique(np.concatenate([np.empty(0, np.uint64), *(np.unique(s.grams[c]) for s in group if s.grams for c in columns)]))
        parts = _needed(files, langs, wanted) if langs else {}
        for lang, (characters, root) in heads.items():
            parts[lang] |= {"characters": np.array([characters]), "root": np.array([root])}
        for s in group:
            n = s.batch.num_rows
            entropy, length = s.entropies([parts[lang] for lang in langs])
            best = entropy.argmin(axis=0) if langs else np.zeros(n, np.int64)
            ordered = np.sort(entropy, axis=0)
            own = ordered[0] if langs else np.zeros(n)
            gap = (ordered[1] - ordered[0]) * length if len(langs) > 1 else np.full(n, 1e3)
            known = s.letters & (length > 0) & bool(langs)
            yield pa.RecordBatch.from_arrays(
                [s.batch.column("doc_id"), pa.array([langs[b] if ok else None for b, ok in zip(best, known, strict=True)], pa.string())]
                + [pa.array(np.where(known, own, 0.0)), pa.array(np.where(known, gap, 0.0)), s.batch.column("lang")],
                names=["doc_id", "best", "entropy", "gap", "lang"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = [], 0
        for batch in slices(batches):
            group.append(_Placed(batch))
            held += batch.column("text").nbytes
            if held >= GROUP_BYTES:
                yield from group_rows(group)
                group, held = [], 0
        if group:  # an empty partition reads no model
            yield from group_rows(group)

    return run


def predict(docs: DataFrame, models: Models | dict, calibration) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy and rejected of all ``docs`` (doc_id, text, lang).

    ``models`` may be an empty dict. ``calibration`` is a condition on doc_id and lang that selects training documents; their lang
    serves only to set the score's steepness and the rejection bounds.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    path = scratch_path(spark, "language-scores")
    scored = rows.mapInArrow(_scored(models.files, models.heads) if models else _scored((), {}), "doc_id long, best string, entropy double, gap double, lang string")
    scored.write.parquet(path)  # numbers only: calibration and the result read them again
    scored = spark.read.schema("doc_id long, best string, entropy double, gap double, lang string").parquet(path)
    seen = scored.where(calibration).where("best is not null")
    right = F.col("best") == F.col("lang")
    chance = [F.least(F.lit(1 - 1e-6), 1 / (1 + F.exp(-F.least(F.lit(50.0), F.col("gap") * s)))) for s in STEEPNESS]
    loss = seen.agg(*(F.avg(-F.log(F.when(right, c).otherwise(1 - c))).alias(f"s{k}") for k, c in enumerate(chance))).head()
    steepness = STEEPNESS[min(range(len(STEEPNESS)), key=lambda k: loss[k] if loss[k] is not None else k)]
    bounds = seen.where(right).groupBy("best").agg(F.percentile_approx("entropy", REJECT, 10_000).alias("bound"))  # a row for each language
    pooled = seen.where(right).agg(F.percentile_approx("entropy", REJECT, 10_000)).head()[0]
    out = scored.join(F.broadcast(bounds), "best", "left").withColumn("bound", F.coalesce("bound", F.lit(pooled).cast("double")))
    return out.select(
        "doc_id",
        F.coalesce("best", F.lit("und")).alias("lang_pred"),
        F.when(F.col("best").isNull(), 0.0).otherwise(1 / (1 + F.exp(-F.least(F.lit(50.0), F.col("gap") * steepness)))).alias("score"),
        F.col("entropy").alias("cross_entropy"),
        (F.col("best").isNull() | F.coalesce(F.col("entropy") > F.col("bound"), F.lit(False))).alias("rejected"),
    )
