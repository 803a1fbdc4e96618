"""Document quality by Bradley-Terry pairwise ranking.

Documents are features; a preferred document (label 1) beats another (label 0) with the logistic of
the difference of their scores. Scores are linear in the features and are fitted by logistic loss
on feature differences of preference pairs. A score's threshold is a quantile of the scores of all
documents: of ``CUTS`` quantiles the one that tells the labels apart best (highest balanced accuracy
over all labelled documents, counted by Spark; the middle one of several). The reported score is the
chance of beating a document at the threshold, so 0.5 is the threshold.

Only the weights come from a sample: ``fit`` takes at most ``max_rows`` documents of each label (those
with the smallest hashes of their doc_id, so the choice does not depend on order) and draws ``pairs``
preference pairs from them. Whole texts are read, very long ones too; a task holds one slice of them.
A null text counts as empty and has features like any other. Repeated label rows count once, rows that
repeat a doc_id each count with its label. Documents tied at the threshold score 0.5 and are predicted
1. Without labels of both kinds nothing can be learned: every document then scores 0.5 and is
predicted 1. Other columns are not looked at, whatever their names; ``keep`` returns them. Empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.rule_ledger import _class_counts, measured
from dimload.llm.tables import saved
from dimload.llm.textbatch import Words, as_string, buffers, slices, word_hashes

MAX_ROWS, PAIRS, SHAPES = 4_000, 60_000, 32
CUTS = 9_999  # quantiles of all scores that the threshold is chosen from


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float


def features(column: pa.Array) -> np.ndarray:
    """One row of features for each text: ratios of measurements, and shares of word shapes."""
    text = as_string(column)
    words = Words(text)
    m = {k: v.astype(np.float64) for k, v in measured(text, words).items()}
    offsets, raw = buffers(text)
    n = len(words.counts)
    per_word, per_char, per_line = (1 / np.maximum(m[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    owner = words.owners()
    pair = np.unique(owner * max(len(words.vocabulary), 1) + words.codes) // max(len(words.vocabulary), 1)
    dense = [
        np.log1p(m["n_words"]),
        m["word_chars"] * per_word,
        m["n_symbols"] * per_char,
        m["n_marks"] * per_char,
        m["n_upper"] / np.maximum(m["n_letters"], 1),
        m["n_letters"] * per_char,
        m["n_dup_lines"] * per_line,
        m["n_repeat_words"] * per_word,
        m["n_words"] * per_line / 100,
        np.bincount(pair, minlength=n) * per_word,
        _class_counts(offsets, raw, b".,;:") * per_word,
        _class_counts(offsets, raw, b"0123456789") * per_char,
        _class_counts(offsets, raw, b"@/\\_=~") * per_char,
    ]
    dense += [x / (x + 0.05) for x in dense[2:5] + dense[6:8]]  # faults that count the same once they are plain
    shape = pc.replace_substring_regex(words.vocabulary, r"\p{Ll}+", "a")
    shape = pc.replace_substring_regex(pc.replace_substring_regex(shape, r"\p{Lu}+", "A"), r"\d+", "0").dictionary_encode()
    bucket = (word_hashes(shape.dictionary) % np.uint64(SHAPES)).astype(np.int64) if len(shape) else np.zeros(0, np.int64)
    of_word = bucket[shape.indices.to_numpy(zero_copy_only=False)] if len(shape) else bucket
    counts = np.bincount(owner * SHAPES + of_word[words.codes], minlength=n * SHAPES).reshape(n, SHAPES)
    return np.column_stack([*dense, counts * per_word[:, None]])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        x = features(batch.column("text"))
        lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("quality"), lists], names=["quality", "x"])


def learned(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, seed: int = 5, ridge: float = 1e-2) -> Ranking:
    """Fit scores on preference pairs drawn from the two kinds of documents (Newton's method)."""
    both = np.concatenate([good, bad])
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    rng = np.random.default_rng(seed)
    d = (good[rng.integers(0, len(good), pairs)] - bad[rng.integers(0, len(bad), pairs)]) / scale
    w = np.zeros(d.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # the chance that the wrong one wins
        gradient = d.T @ p / pairs - ridge * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return Ranking(mean, scale, w, 0.0)


def threshold(scores: DataFrame, known: DataFrame) -> float:
    """The best quantile of all ``scores`` (doc_id, score), by the labels ``known`` (doc_id, quality)."""
    shares = np.linspace(0, 1, CUTS + 2)[1:-1].tolist()
    cuts = np.array(scores.agg(F.percentile_approx("score", shares, 100_000)).head()[0])

    @F.arrow_udf("int")
    def passed(score: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, score.to_numpy(zero_copy_only=False), "right"), pa.int32())

    counted = scores.join(known, "doc_id").groupBy("quality", passed("score").alias("passed")).count().collect()  # 2 * (CUTS + 1) rows at most
    counts = np.zeros((2, CUTS + 1))
    for r in counted:
        counts[r["quality"], r["passed"]] += r["count"]
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:] / np.maximum(counts.sum(axis=1, keepdims=True), 1)  # shares at or above each cut
    balanced = above[1] + 1 - above[0]
    best = np.flatnonzero(np.isclose(balanced, balanced.max()))
    return float(cuts[best[(len(best) - 1) // 2]])


def _learned_from(docs: DataFrame, labels: DataFrame, max_rows: int, pairs: int) -> tuple[Ranking | None, DataFrame]:
    """The weights from a bounded sample, without a threshold, and all usable labels."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    known = known.where("quality in (0, 1)").join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    chosen = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for q in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])  # 2 * max_rows rows at most, so broadcasting is safe
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("quality", "text").mapInArrow(_featured, "quality int, x array<double>").collect()
    kinds = [np.array([r["x"] for r in rows if r["quality"] == q]) for q in (1, 0)]
    return learned(*kinds, pairs=pairs) if all(map(len, kinds)) else None, known


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, pairs: int = PAIRS) -> Ranking | None:
    """Learn from ``labels`` (doc_id, quality 0 or 1) of ``docs`` (doc_id, text)."""
    model, known = _learned_from(docs, labels, max_rows, pairs)
    return model and replace(model, threshold=threshold(saved(_raw(docs, model), "quality-scores"), known))


def rank(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, pairs: int = PAIRS) -> DataFrame:
    """doc_id and score of all ``docs``, learned from ``labels`` of them: texts are scored once."""
    model, known = _learned_from(docs, labels, max_rows, pairs)
    if model is None:
        return score(docs, None)
    raw = saved(_raw(docs, model), "quality-scores")
    over = F.least(F.lit(30.0), F.greatest(F.lit(-30.0), F.col("score") - threshold(raw, known)))
    return raw.select("doc_id", (1 / (1 + F.exp(-over))).alias("score"))


def _raw(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id and the linear score of all ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = (features(batch.column("text")) - model.mean) / model.scale @ model.weights
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def scores(column: pa.Array, model: Ranking | None) -> np.ndarray:
    """Chances of beating a document at the threshold."""
    if model is None:
        return np.full(len(column), 0.5)
    s = (features(column) - model.mean) / model.scale @ model.weights - model.threshold
    return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def score(docs: DataFrame, model: Ranking | None) -> DataFrame:
    """doc_id and score of all ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(batch.column("text"), model))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: Ranking | None) -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(scores(batch.column("text"), model) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
