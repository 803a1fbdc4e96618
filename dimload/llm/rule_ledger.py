"""Quality rules as a bitmask ledger.

``ledger`` measures every document once and sets bit ``k`` of ``failed`` where rule ``k`` fails.
Policies are versioned sets of rules; applying one is a bitwise test on the stored bits, so a
policy can change without reading a text again, and ``ablations`` counts what each rule of a policy
decides alone by aggregating the bits.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words and fails ``few_words``; all
other measurements are then 0 and all ratio rules pass, since they compare products, never
quotients. Repeated rows get a ledger row each. An empty table gives an empty ledger. ``keep`` passes all columns of its input through unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload.llm.textbatch import Words, as_string, buffers, mix, slices, window_hashes, word_hashes

MEASURES = "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_upper n_letters n_marks".split()
#: Rule k fails where the left side is larger than the right side (integers only).
RULES = {
    "few_words": lambda m: (10 + 0 * m["n_words"], m["n_words"]),
    "repeated_words": lambda m: (100 * m["n_repeat_words"], 20 * m["n_words"]),
    "symbols": lambda m: (100 * m["n_symbols"], 8 * m["word_chars"]),
    "repeated_lines": lambda m: (100 * m["n_dup_lines"], 50 * m["n_lines"]),
    "upper_case": lambda m: (100 * m["n_upper"], 60 * m["n_letters"]),
    "marks": lambda m: (100 * m["n_marks"], 10 * m["word_chars"]),
    "long_words": lambda m: (m["word_chars"], 30 * m["n_words"]),
}
BASE = ("few_words", "repeated_words")
POLICIES = {
    1: BASE,
    2: (*BASE, "symbols", "repeated_lines", "upper_case", "marks"),
    3: tuple(RULES),
}
VERSION = 3
_LEDGER = "doc_id long, " + ", ".join(f"{c} long" for c in MEASURES) + ", failed long"


def mask(policy: int) -> int:
    """The bits of a policy's rules."""
    return sum(1 << k for k, name in enumerate(RULES) if name in POLICIES[policy])


def _class_counts(offsets: np.ndarray, raw: bytes, members: bytes) -> np.ndarray:
    """For each text, how many of its bytes are members."""
    table = np.zeros(256, np.int64)
    table[list(members)] = 1
    sums = np.concatenate([[0], np.cumsum(table[np.frombuffer(raw, np.uint8)])])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _line_counts(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those equal to an earlier line of their text."""
    lines = pc.split_pattern(text, "\n")
    owner = np.repeat(np.arange(len(text)), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    encoded = lines.flatten().dictionary_encode()
    worded = pc.not_equal(pc.ascii_trim_whitespace(encoded.dictionary), "").to_numpy(zero_copy_only=False)
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keep = worded[codes] if len(codes) else np.zeros(0, bool)
    owner, codes = owner[keep], codes[keep]
    total = np.bincount(owner, minlength=len(text))
    distinct = np.unique(owner * max(len(worded), 1) + codes) // max(len(worded), 1)
    return total, total - np.bincount(distinct, minlength=len(text))


def repeated_words(words: Words, hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """For each text, its words in windows of ``width`` words that it holds twice or more."""
    n = len(words.counts)
    if len(words.codes) < width:
        return np.zeros(n, np.int64)
    key, owner = window_hashes(words, hashes, width)
    at = np.flatnonzero((lambda o: o[: len(o) - width + 1] == o[width - 1 :])(words.owners()))
    key = mix(key + mix(owner.astype(np.uint64)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    size = len(words.codes) + 1
    step = np.bincount(at[twice], minlength=size) - np.bincount(at[twice] + width, minlength=size)
    covered = np.cumsum(step)[:-1] > 0
    sums = np.concatenate([[0], np.cumsum(covered)])
    return sums[words.bounds[1:]] - sums[words.bounds[:-1]]


def measured(column: pa.Array, words: Words | None = None) -> dict[str, np.ndarray]:
    """All measurements of a column of texts."""
    text = as_string(column)
    words = words or Words(text)
    offsets, raw = buffers(text)
    lengths = pc.utf8_length(words.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = np.concatenate([[0], np.cumsum(lengths[words.codes])])
    n_lines, n_dup = _line_counts(text)
    upper = _class_counts(offsets, raw, bytes(range(65, 91)))
    return {
        "n_words": words.counts,
        "word_chars": chars[words.bounds[1:]] - chars[words.bounds[:-1]],
        "n_symbols": _class_counts(offsets, raw, b"#*$%&|<>"),
        "n_lines": n_lines,
        "n_dup_lines": n_dup,
        "n_repeat_words": repeated_words(words, word_hashes(words.vocabulary)),
        "n_upper": upper,
        "n_letters": upper + _class_counts(offsets, raw, bytes(range(97, 123))),
        "n_marks": _class_counts(offsets, raw, b"!?"),
    }


def failures(m: dict[str, np.ndarray]) -> np.ndarray:
    """The failure bits of all rules."""
    out = np.zeros(len(m["n_words"]), np.int64)
    for k, rule in enumerate(RULES.values()):
        left, right = rule(m)
        out |= np.where(left > right, 1 << k, 0)
    return out


def _ledger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        m = measured(batch.column("text"))
        columns = [batch.column("doc_id"), *(pa.array(m[c].astype(np.int64)) for c in MEASURES), pa.array(failures(m))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *MEASURES, "failed"])


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, measurements and failure bits of all ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_ledger, _LEDGER)


def passes(policy: int = VERSION, failed: str = "failed") -> Column:
    """Whether a ledger row passes a policy."""
    return F.col(failed).bitwiseAND(F.lit(mask(policy))) == 0


def keep(docs: DataFrame, policy: int = VERSION) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, in one pass and without a join."""
    bits = mask(policy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array((failures(measured(batch.column("text"))) & bits) == 0))

    return docs.mapInArrow(run, docs.schema)


def ablations(rows: DataFrame, policies: dict[int, tuple[str, ...]] | None = None) -> DataFrame:
    """For each policy and rule: the documents that fail the rule, and those kept if the policy
    dropped the rule (they fail no other rule of it). Bits are counted before anything else, so
    the work after one pass follows the number of bit patterns, 2 ** rules at most."""
    counted = rows.groupBy("failed").agg(F.count("*").alias("n"))
    sums = []
    for policy in policies or POLICIES:
        bits = mask(policy)
        for k, name in enumerate(RULES):
            if bits >> k & 1:
                fails = F.col("failed").bitwiseAND(F.lit(1 << k)) != 0
                alone = F.col("failed").bitwiseAND(F.lit(bits)) == (1 << k)
                total = F.coalesce(F.sum(F.when(fails, F.col("n"))), F.lit(0))
                only = F.coalesce(F.sum(F.when(alone, F.col("n"))), F.lit(0))
                sums.append(F.struct(F.lit(policy).alias("policy"), F.lit(name).alias("rule"), total.alias("n_failed"), only.alias("n_only_rule")))
    return counted.agg(F.array(*sums).alias("r")).select(F.inline("r"))
