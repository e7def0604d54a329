"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

A batch of texts is cut into words with the tokenizer's pattern.  Every word
that a task has not met before goes into one flat array of symbols (its bytes
at first).  A round looks up all neighbouring pairs at once by binary search
in the sorted pair keys of the merge table, takes in each word the pair of the
lowest rank, and merges its occurrences from the left; words without a known
pair are finished.  Texts are then gathered from the words' tokens, and decoded
by gathering the tokens' bytes.  Spark spreads the texts; nothing is shuffled.

Defined results: a null text encodes as the empty text (no ids), null ids
decode to the empty text; repeated rows give repeated results; added columns
replace columns of the same name, all others are kept.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tomewise.llm.batches import clashes, gather, numbered, quoted, schema_of, slices, texts_of

# The pattern that cuts a text into words before the merges (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A task keeps the tokens of at most about this many words between slices.
MAX_WORDS = 400_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself if printable, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


class Vocabulary:
    """Merge table, token bytes and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE file without normaliser is needed")
        chars = byte_characters()
        to_byte = {c: b for b, c in enumerate(chars)}
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.byte_ids = np.array([ids[c] for c in chars], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)[order]
        token = [b""] * self.size
        for t, i in ids.items():
            token[i] = bytes(to_byte[c] for c in t)
        for t, i in self.special.items():
            token[i] = t.encode()
        self.token_bytes = np.frombuffer(b"".join(token), np.uint8)
        self.token_len = np.array([len(t) for t in token], np.int64)
        self.token_start = np.cumsum(self.token_len) - self.token_len
        self.words = regex.compile(PATTERN)
        self.split_special = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        self._tokenizer_path = path

    @cached_property
    def _library(self):
        from tokenizers import Tokenizer
        unassigned = np.array([unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)])
        edges = np.flatnonzero(np.diff(np.r_[False, unassigned, False])).reshape(-1, 2).tolist()
        ranges = "".join(f"{chr(a)}-{chr(b - 1)}" for a, b in edges)
        return Tokenizer.from_file(self._tokenizer_path).pre_tokenizer, regex.compile(f"[{ranges}]")

    def cut(self, text: str) -> list[str]:
        """The words of ``text``, special strings whole.

        Character classes differ between Unicode versions only for code points
        that were unassigned in the older one; a text with such a character is
        cut by the tokenizer library itself."""
        if self.split_special is not None and any(s in text for s in self.special):
            return [w for part in self.split_special.split(text) if part
                    for w in ([part] if part in self.special else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or max(text) < "\u0530":
            return self.words.findall(text)
        library, unassigned = self._library
        if unassigned.search(text):
            return [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]
        return self.words.findall(text)

    def _rank(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pair that begins at each of ``at`` (the number of
        merges if there is none within the word) and its place in the table."""
        nxt = np.minimum(at + 1, len(symbol) - 1)
        key = symbol[at] * self.size + symbol[nxt]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[place] == key) & (word[at] == word[nxt]) & (nxt > at)
        return np.where(known, self.ranks[place], len(self.keys)), place

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all ``words`` in one array, and each word's number of tokens."""
        none = len(self.keys)
        length = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), length)
        rank, place = self._rank(symbol, word, np.arange(len(symbol)))
        done = [(word[:0], symbol[:0])]
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(symbol)]))
            over = lowest == none
            if over.any():
                done.append((word[over], symbol[over]))
            pick = np.flatnonzero((rank == lowest) & ~over)
            if not len(pick):
                break
            # of pairs that overlap (aaa) every second one counts, from the left
            run = np.flatnonzero(np.r_[True, np.diff(pick) != 1])
            behind = np.arange(len(pick)) - np.repeat(run, np.diff(np.r_[run, len(pick)]))
            pick = pick[behind % 2 == 0]
            symbol[pick] = self.merged[place[pick]]
            stay = ~over
            stay[pick + 1] = False
            pick = (np.cumsum(stay) - 1)[pick]
            symbol, word, rank, place = symbol[stay], word[stay], rank[stay], place[stay]
            changed = np.r_[pick, pick[pick > 0] - 1]
            rank[changed], place[changed] = self._rank(symbol, word, changed)
        word, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbol[order].astype(np.int32), np.bincount(word, minlength=len(words))


class _Seen(dict):
    """Word -> its number; a new word gets the next one."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at


class Codec:
    """Encodes and decodes batches of texts, remembering words between them."""

    def __init__(self, vocabulary: Vocabulary, max_words: int = MAX_WORDS):
        self.vocabulary, self.max_words = vocabulary, max_words
        self._forget()

    def _forget(self) -> None:
        self.seen = _Seen()
        self.tokens = np.zeros(0, np.int32)
        self.count = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)

    def _learn(self) -> None:
        special = self.vocabulary.special
        new, self.seen.new = self.seen.new, []
        tokens, count = self.vocabulary.merge([b"" if w in special else w.encode() for w in new])
        if any(s in self.seen for s in special):
            parts = np.split(tokens, np.cumsum(count)[:-1])
            parts = [np.array([special[w]], np.int32) if w in special else p for w, p in zip(new, parts)]
            tokens, count = np.concatenate(parts), np.array([len(p) for p in parts])
        self.tokens = np.concatenate([self.tokens, tokens])
        self.count = np.concatenate([self.count, count])
        self.start = np.cumsum(self.count) - self.count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the end of each text in it."""
        if len(self.seen) > self.max_words:
            self._forget()
        words = [self.vocabulary.cut(t) for t in texts]
        number = [np.fromiter(map(self.seen.__getitem__, w), np.int64, len(w)) for w in words]
        if self.seen.new:
            self._learn()
        flat = np.concatenate(number) if number else np.zeros(0, np.int64)
        ids = gather(self.tokens, self.start[flat], self.count[flat])
        ends = np.cumsum(np.r_[0, self.count[flat]])[np.cumsum([len(w) for w in words], dtype=np.int64)]
        return ids, ends

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The text of each run of ids, special tokens included; bytes that
        are not UTF-8 become replacement characters."""
        v = self.vocabulary
        raw = gather(v.token_bytes, v.token_start[ids], v.token_len[ids]).tobytes()
        cut = np.cumsum(np.r_[0, v.token_len[ids]])[np.r_[0, ends].astype(np.int64)].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:])]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a vocabulary file, one per worker process."""
    return Codec(Vocabulary(path))


_ADDED = {
    "ids": T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
    "n_tokens": T.StructField("n_tokens", T.LongType(), False),
    "ids_sha256": T.StructField("ids_sha256", T.StringType(), False),
    "decoded": T.StructField("decoded", T.StringType(), False),
    "decoded_sha256": T.StructField("decoded_sha256", T.StringType(), False),
}
_ARROW = {"ids": pa.list_(pa.field("element", pa.int32(), False)), "n_tokens": pa.int64(),
          "ids_sha256": pa.string(), "decoded": pa.string(), "decoded_sha256": pa.string()}


def encode(df: DataFrame, vocabulary_path: str, text_col: str = "text",
           outputs: tuple[str, ...] = ("ids",), keep: list[str] | None = None) -> DataFrame:
    """``df`` with the wanted ``outputs`` of its texts.

    ``ids``, ``n_tokens``, ``ids_sha256`` (of little-endian unsigned 32-bit
    ids), ``decoded`` (the ids decoded again) and ``decoded_sha256``.  ``keep``
    names the columns to carry along (default: all)."""
    outputs = tuple(outputs)
    keep = clashes(df.select(*map(quoted, keep)) if keep is not None else df, list(outputs))
    schema = schema_of(df, keep, [_ADDED[o] for o in outputs])
    needed = list(dict.fromkeys([*keep, text_col]))
    at, kept = needed.index(text_col), [needed.index(c) for c in keep]

    def run(batches):
        c = codec(vocabulary_path)
        for batch in batches:
            texts = texts_of(batch.column(at))
            for a, b in slices(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(a, b - a) for k in kept]
                    + _outputs(c, texts[a:b], outputs),
                    names=[*keep, *outputs])

    return numbered(df, needed).mapInArrow(run, schema)


def _outputs(c: Codec, texts: list[str], outputs: tuple[str, ...]) -> list[pa.Array]:
    ids, ends = c.encode(texts)
    starts = np.r_[0, ends[:-1]].astype(np.int64) if len(ends) else ends
    made = {"n_tokens": pa.array(ends - starts, pa.int64())}
    if "ids" in outputs:
        made["ids"] = pa.ListArray.from_arrays(
            pa.array(np.r_[0, ends], pa.int32()), pa.array(ids, pa.int32()), type=_ARROW["ids"])
    if "ids_sha256" in outputs:
        raw, cut = memoryview(ids.astype("<u4").tobytes()), (4 * np.r_[0, ends]).tolist()
        made["ids_sha256"] = pa.array([hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(cut, cut[1:])],
                                      pa.string())
    if "decoded" in outputs or "decoded_sha256" in outputs:
        decoded = c.decode(ids, ends)
        made["decoded"] = pa.array(decoded, pa.string())
        made["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string())
    return [made[o] for o in outputs]


def decode(df: DataFrame, vocabulary_path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids; an id outside the vocabulary fails."""
    keep = clashes(df, [name])
    schema = schema_of(df, keep, [T.StructField(name, T.StringType(), False)])
    at, kept = df.columns.index(ids_col), [df.columns.index(c) for c in keep]

    def run(batches):
        c = codec(vocabulary_path)
        for batch in batches:
            column = batch.column(at)
            ids = [np.asarray(x or [], np.int64) for x in column.to_pylist()]
            ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in kept] + [pa.array(c.decode(flat, ends), pa.string())],
                names=[*keep, name])

    return numbered(df, df.columns).mapInArrow(run, schema)
