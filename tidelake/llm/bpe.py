"""BPE encoding and decoding by batched numpy merge rounds.

A tokenizers file with word ends (``end_of_word_suffix``) is read as tables: the ids of the 256 byte symbols inside and at the
end of a word, the merges as sorted pair keys ``left * size + right`` with rank and result, and the text of every id.

Encoding a run of texts:

1. Special strings are found first, in the text as it is. What lies between them is normalised and split into words:
   Latin text by one expression, everything else by the library's own normaliser and splitter, so that words
   agree for every code point, also for those that are assigned in one Unicode version only.
2. Each distinct word is merged once; a worker keeps the words it has seen, ``KNOWN_WORDS`` at most.
3. The symbols of all new words lie in one flat array. Ranks of neighbouring pairs come from a binary search in the sorted keys.
   A round merges, in every word at once, all pairs that no other merge can disturb: pairs below the lowest rank at
   which any symbol still to be made takes part (``horizon``), that have a lower rank than both neighbours, ties to the left;
   of a run of equal pairs every other one. This gives what merging the lowest pair one by one gives, in far fewer
   rounds. Only ranks next to a merge are looked up again, and finished words leave the array.
4. Ids are gathered per text.

Decoding writes the texts of the ids, with a blank between them, by one gather over a flat byte table.

Texts are read whole; a long one is worked on in runs cut in front of a blank, which no word crosses. Ids are binary: unsigned
32-bit little-endian integers. NULL and empty texts have no ids, no ids decode to the empty text, ids that the file does
not know are left out, as in the library. Rows are independent, so repeated rows, NULL ids of documents, ties and other columns
are of no account; an empty table gives none. A tokenizer of another make (a decoder, unknown-word token, byte fallback,
special tokens that strip) is refused with ``ValueError``.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidelake.llm.common import as_text_array

#: Code points of a run of texts that is encoded at once, and words a worker keeps.
RUN_CHARS = 1 << 20
KNOWN_WORDS = 1 << 19
#: Words longer than this are not kept.
KEPT_LENGTH = 64
NO_RANK = np.int64(1) << 40

# The normalisers and the split for which Latin text has a fast way. Latin is what is below U+0250, where
# classes are settled, composed forms are in use and lower case maps code points one by one, and general punctuation.
KNOWN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NOT_LATIN = re.compile("[^\x00-\u024f\u2010-\u2027]")
SPACES = "\t-\r \x85\xa0"


def latin_split() -> re.Pattern:
    """``KNOWN_SPLIT`` for Latin text in lower case."""
    letters, numbers = ("".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == k) for k in "LN")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{SPACES}{letters}{numbers}]+")


def byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself where it is visible, else from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all runs ``starts[i], starts[i] + 1, ...`` of the given lengths, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class WordBpe:
    """The tables of one tokenizers file, and the words that a worker has already merged."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, added = spec["model"], spec["added_tokens"]
        split, symbols = (spec["pre_tokenizer"] or {}).get("pretokenizers", [None, None])
        if (model["type"] != "BPE" or spec["decoder"] or model.get("unk_token") or model.get("byte_fallback") or model.get("dropout")
                or model.get("continuing_subword_prefix") or model.get("ignore_merges")
                or not split or (split["type"], symbols["type"]) != ("Split", "ByteLevel") or symbols["use_regex"] or symbols["add_prefix_space"]
                or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError(f"{path} is not a plain BPE with word ends")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in added)])
        self._merges(model["merges"], vocab, suffix)

        # Ids of the bytes inside and at the end of a word.
        self.inside, self.at_end = (np.array([vocab[c + end] for c in byte_symbols()]) for end in ("", suffix))

        texts = [b""] * self.size
        known = np.zeros(self.size, dtype=bool)
        for token, i in [*vocab.items(), *((t["content"], t["id"]) for t in added)]:
            texts[i], known[i] = token.encode() + b" ", True
        self.known, self.text_bytes = known, np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.text_lengths = np.array([len(t) for t in texts])
        self.text_starts = np.cumsum(self.text_lengths) - self.text_lengths

        self.special = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), split["behavior"].lower(), split["invert"])
        known_way = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == KNOWN_NORMALIZERS
        self.latin_split = latin_split() if known_way and split["pattern"].get("Regex") == KNOWN_SPLIT else None
        self._forget()

    def _merges(self, merges: list, vocab: dict, suffix: str) -> None:
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        self.result = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        key = left * self.size + right
        self.rank_at = np.argsort(key)
        self.keys = key[self.rank_at]
        rank = np.arange(len(pairs))
        first_use = np.full(self.size, NO_RANK)
        np.minimum.at(first_use, left, rank)
        np.minimum.at(first_use, right, rank)
        # The lowest rank of a pair that holds the result of a merge; never below the merge itself.
        self.next_rank = first_use[self.result]
        if (self.next_rank <= rank).any():
            raise ValueError("a merge uses a symbol that is made later")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_at[at], NO_RANK)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has. No word is empty."""
        encoded = [w.encode() for w in words]
        lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        symbols = self.inside[data]
        last = np.cumsum(lengths) - 1
        symbols[last] = self.at_end[data[last]]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(symbols), NO_RANK)  # of each symbol with the next one of its word
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.ranks(symbols[inner], symbols[inner + 1])
        done_symbols, done_words = [], []
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(first, len(word)))
            alive = np.repeat(np.minimum.reduceat(rank, first) < NO_RANK, size)
            if not alive.all():
                done_symbols.append(symbols[~alive])
                done_words.append(word[~alive])
                symbols, word, rank = symbols[alive], word[alive], rank[alive]
                continue
            after = np.where(rank < NO_RANK, self.next_rank[np.minimum(rank, len(self.next_rank) - 1)], NO_RANK)
            horizon = np.repeat(np.minimum.reduceat(after, first), size)
            before, behind = np.append(NO_RANK, rank[:-1]), np.append(rank[1:], NO_RANK)
            place = np.arange(len(rank))
            run = np.maximum.accumulate(np.where(rank != before, place, 0))
            chosen = (rank < horizon) & (rank < NO_RANK) & (before > rank)[run] & ((place - run) % 2 == 0) & (behind >= rank)
            at = np.flatnonzero(chosen)
            symbols[at] = self.result[rank[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            at -= np.arange(len(at))
            touched = np.unique(np.concatenate([at, np.maximum(at - 1, 0)]))
            rank[touched] = NO_RANK
            touched = touched[touched + 1 < len(symbols)]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched] = self.ranks(symbols[touched], symbols[touched + 1])
        if not done_symbols:
            return np.zeros(0, dtype=np.int64), lengths
        word = np.concatenate(done_words)
        return np.concatenate(done_symbols)[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def _forget(self) -> None:
        ids = list(self.special.values())
        self.place_of = {i: k for k, i in enumerate(ids)}  # a word, or the id of a special string, to its place
        self.ids, self.lengths = np.array(ids, dtype=np.int64), np.ones(len(ids), dtype=np.int64)

    def words(self, text: str) -> Iterator:
        """Lists of words of one text, in order; a special string is its id."""
        parts = self.special_split.split(text) if self.special_split else [text]
        for part in parts:
            special = self.special.get(part)
            if special is not None:
                yield [special]
            elif self.latin_split and not NOT_LATIN.search(part):
                yield self.latin_split.findall(part.lower())
            elif part:
                normal = self.normalizer.normalize_str(part) if self.normalizer else part
                yield [word for word, _ in self.split.pre_tokenize_str(normal)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        words, bounds = [], [0]
        for text in texts:
            for some in self.words(text):
                words.extend(some)
            bounds.append(len(words))
        if len(self.lengths) > KNOWN_WORDS or len(self.ids) > 8 * KNOWN_WORDS:
            self._forget()
        new = list(set(words).difference(self.place_of))
        if new:
            ids, lengths = self.merge(new)
            self.place_of.update(zip(new, range(len(self.lengths), len(self.lengths) + len(new))))
            self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        starts = np.cumsum(self.lengths) - self.lengths
        at = np.fromiter(map(self.place_of.__getitem__, words), dtype=np.int64, count=len(words))
        count = self.lengths[at]
        flat = self.ids[ragged(starts[at], count)].astype("<u4")
        ends = np.append(0, np.cumsum(count))[bounds]
        for word in new:
            if not isinstance(word, int) and len(word) > KEPT_LENGTH:
                del self.place_of[word]
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def decode(self, ids: np.ndarray) -> str:
        """The texts of all known ids with a blank between them."""
        ids = ids[ids < self.size].astype(np.int64)
        ids = ids[self.known[ids]]
        data = self.text_bytes[ragged(self.text_starts[ids], self.text_lengths[ids])]
        return data[:-1].tobytes().decode("utf-8")


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """The tables of a file; loaded once a worker."""
    return WordBpe(path)


def runs(texts: list[str], limit: int = RUN_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Texts as lists of ``(number, part)`` of about ``limit`` code points; long texts are cut in front of a blank."""
    out, held = [], 0
    for number, text in enumerate(texts):
        at = 0
        while len(text) - at > limit:
            cut = text.find(" ", at + limit)
            if cut < 0:
                break
            yield [(number, text[at:cut])]
            at = cut
        out.append((number, text[at:]))
        held += len(text) - at
        if held > limit:
            yield out
            out, held = [], 0
    if out:
        yield out


def encoder(path: str):
    """A function ``text column -> ids`` (binary: unsigned 32-bit little-endian) for the tokenizers file at ``path``."""
    @F.arrow_udf("binary")
    def encode(column: pa.Array) -> pa.Array:
        bpe, out = load(path), [b""] * len(column)
        for run in runs(as_text_array(column).to_pylist()):
            for (number, _), ids in zip(run, bpe.encode([part for _, part in run])):
                out[number] += ids.tobytes()
        return pa.array(out, pa.binary())

    return encode


def decoder(path: str):
    """A function ``ids column -> text`` for ids as ``encoder`` gives them; NULL is no ids."""
    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        bpe = load(path)
        return pa.array([bpe.decode(np.frombuffer(ids, dtype="<u4")) for ids in column.to_pylist()], pa.string())

    # With a function of the JVM in between, ids that an encoder has just made are not made a second time for the decoder.
    return lambda column: decode(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(b"")))
