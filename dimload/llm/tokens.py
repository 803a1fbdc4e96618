"""Token ids of whole texts with a public tokenizer file, each distinct word encoded once.

The tokenizer drops white space between words, so a text's ids are its words' ids in order. Words
are found with Arrow, each distinct one is encoded once per slice (a bounded store keeps those of
earlier slices), and numpy strings the ids together. Plain Latin words go straight to the tokenizer's model;
all other words take its full path. Tests compare the ids with those of whole-text encoding.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from dimload.llm.textbatch import Words, as_string, buffers, rebuilt

WORDS_A_CALL = 200
#: Texts (or blocks of words) encoded in one call: the tokenizer's own rows, far larger than ids, are let go after each.
TEXTS_A_CALL = 64
#: Text bytes encoded together: distinct words are encoded once in each slice.
TOKEN_SLICE = 2 << 20
#: Distinct words whose ids a worker keeps; those met later are encoded again in each slice.
KNOWN_WORDS = 400_000
#: ASCII punctuation without the apostrophe, which opens contractions: after letters, one piece.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = f"^[{_LETTERS}]+[" + "".join("\\" + c for c in _MARKS) + "]*$"


def _byte_chars() -> str:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow from 256.
    The blank stays a blank, since it only stands between words here."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return "".join(" " if b == 32 else chr(b if b in shown else 256 + rest.index(b)) for b in range(256))


class WordTokenizer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept as 16-bit numbers; the vocabulary is larger")
        self.chars = _byte_chars()
        # the model alone, over blank-separated words; a word's last id is marked as such by its suffix
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.bare = Tokenizer(self.tokenizer.model) if suffix else None
        if suffix:
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.last = np.zeros(1 << 16, dtype=bool)
            self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

        self.known = pa.array([], pa.string())
        self.known_ids, self.known_bounds = np.empty(0, np.uint16), np.zeros(1, np.int64)

    def _looked_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_letters``, but words seen before are not encoded again."""
        at = pc.index_in(words, value_set=self.known)
        new = words.filter(pc.is_null(at))
        ids, bounds = self._letters(new)
        at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = len(self.known) + np.arange(len(new))
        all_ids = np.concatenate([self.known_ids, ids])
        all_bounds = np.concatenate([self.known_bounds, bounds[1:] + self.known_bounds[-1]])
        out = gathered(all_ids, all_bounds[at], all_bounds[at + 1] - all_bounds[at])
        if len(self.known) + len(new) <= KNOWN_WORDS:
            self.known = pa.concat_arrays([self.known, new])
            self.known_ids, self.known_bounds = all_ids, all_bounds
        return out

    def _full(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts by the tokenizer's whole path, strung together, and their bounds."""
        done = [e.ids for e in _encoded(self.tokenizer, texts.to_pylist())]
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, done), np.int64, len(done)))])
        return np.fromiter(chain.from_iterable(done), np.uint16, int(bounds[-1])), bounds

    def _letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for lower-case words of Latin letters, many words in one call."""
        if self.bare is None or not len(words):
            return self._full(words)
        cuts = np.append(np.arange(0, len(words), WORDS_A_CALL), len(words)).astype(np.int32)
        blocks = pc.binary_join(pa.ListArray.from_arrays(cuts, words), " ").to_pylist()
        blocks = [x if x.isascii() else x.encode().decode("latin-1").translate(self.chars) for x in blocks]
        ids = np.concatenate([np.asarray(e.ids, np.uint16) for e in _encoded(self.bare, blocks)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return self._full(words)
        return ids, np.concatenate([[0], ends])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint16) of all texts of a column in order, and each text's bounds in them."""
        words = Words(column)
        vocabulary = words.vocabulary
        plain = pc.match_substring_regex(vocabulary, _PLAIN)
        lower = pc.utf8_lower(vocabulary.filter(plain))
        core = pc.utf8_rtrim(lower, characters=_MARKS)
        sizes = pc.binary_length(core).to_numpy(zero_copy_only=False)
        offsets, raw = buffers(as_string(lower))
        marks = _tails(offsets, raw, sizes)
        core, marks, rest = core.dictionary_encode(), marks.dictionary_encode(), vocabulary.filter(pc.invert(plain))
        a_flat, a_bounds = self._looked_up(core.dictionary)
        b_flat, b_bounds = self._full(marks.dictionary)
        c_flat, c_bounds = self._full(rest)
        flat = np.concatenate([a_flat, b_flat, c_flat])
        # each distinct word is up to two ranges of ``flat``
        first = np.zeros((2, len(vocabulary)), np.int64)
        size = np.zeros((2, len(vocabulary)), np.int64)
        is_plain = plain.to_numpy(zero_copy_only=False)
        for row, bounds, at, base, mask in (
            (0, a_bounds, core.indices.to_numpy(zero_copy_only=False), 0, is_plain),
            (1, b_bounds, marks.indices.to_numpy(zero_copy_only=False), len(a_flat), is_plain),
            (0, c_bounds, np.arange(len(rest)), len(a_flat) + len(b_flat), ~is_plain),
        ):
            first[row, mask] = bounds[at] + base
            size[row, mask] = bounds[at + 1] - bounds[at]
        flat, bounds = gathered(flat, first.T.ravel(), size.T.ravel())
        bounds = bounds[::2]
        ids, ends = gathered(flat, bounds[words.codes], (bounds[1:] - bounds[:-1])[words.codes])
        return ids, ends[words.bounds]


def _encoded(tokenizer, texts: list[str]):
    """The tokenizer's rows of all texts in order, a few at a time."""
    for lo in range(0, len(texts), TEXTS_A_CALL):
        yield from tokenizer.encode_batch_fast(texts[lo : lo + TEXTS_A_CALL], add_special_tokens=False)


def gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges ``[first, first + size)`` of ``flat`` strung together, and their bounds."""
    bounds = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(first - bounds[:-1], size)
    at += np.arange(len(at))
    return flat[at], bounds


def _tails(offsets: np.ndarray, raw: bytes, skip: np.ndarray) -> pa.Array:
    """What follows the first ``skip`` bytes of each string."""
    data, bounds = gathered(np.frombuffer(raw, np.uint8), offsets[:-1] + skip, np.diff(offsets) - skip)
    return rebuilt(bounds, data.tobytes())


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer for each worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text, and the new bounds."""
    return np.insert(ids, bounds[1:], end_id).astype("<u2"), bounds + np.arange(len(bounds))


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
