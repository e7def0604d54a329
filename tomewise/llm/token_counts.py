"""Token counts of whole texts, encoded in overlapping chunks.

Every text is encoded in chunks of ``chunk_chars`` characters that overlap; a
short text is the case of one chunk.  Neighbouring chunks are spliced where both
begin a word at the same place.  Such a place is stable: the pattern that cuts
words reads from left to right, never looks behind, and looks at most at the
character that follows a word.  So once two encodings begin a word at the same
place, with the next character in sight of the left one, they agree from there
on, up to the left one's end.  Places nearer to a chunk's edge than the longest
special token is long do not count, because a special token cut by the edge
would look like ordinary text.  Where the overlap has no such place it is
widened, at last to the whole left chunk, which gives one longer chunk.

A chunk's ids come from the quick encoder of ``ids``, the places of its words
from the pattern and those of its tokens from the lengths of the tokens; a
vocabulary file or a chunk that the quick encoder does not take goes to the
file's own library, which gives all three.

Defined results: a null text counts as the empty text (0 bytes, 0 tokens);
repeated rows give repeated results; added columns replace columns of the same
name, all others are kept.
"""

from __future__ import annotations

import os
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tomewise.llm.batches import clashes, numbered, quoted, schema_of, texts_of
from tomewise.llm.bpe import PATTERN
from tomewise.llm.ids import id_encoder

CHUNK_CHARS = 2_048
OVERLAP_CHARS = 192
MAX_TOKENS = 512


class Chunk:
    """The encoding of ``text[start:end]``: its ids and, when asked for, the
    places (characters of the text) where its words begin."""

    def __init__(self, encoder: Chunked, text: str, start: int, end: int):
        self.encoder, self.text, self.start, self.end = encoder, text, start, end
        part = text[start:end]
        self.ids, self.edges = encoder.quick_ids(part)
        if self.ids is None:
            e = encoder.tokenizer.encode(part, add_special_tokens=False)
            self.ids = np.array(e.ids, np.int64)
            self._begins = np.array([a for a, _ in e.offsets], np.int64) + start
            word = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
            self.words = self._begins[np.r_[True, word[1:] != word[:-1]][:len(word)]]

    @cached_property
    def words(self) -> np.ndarray:
        return np.array(self.encoder.word_places(self.text[self.start:self.end]), np.int64) + self.start

    def split(self, at: int) -> int:
        """How many ids lie before the word that begins at ``at``."""
        if self.edges is None:
            return int(np.searchsorted(self._begins, at))
        return int(np.searchsorted(self.edges, len(self.text[self.start:at].encode()), "right"))

    def cut(self, at: int) -> None:
        """Forget what lies before the word that begins at ``at``."""
        k, words = self.split(at), self.words
        if self.edges is None:
            self._begins = self._begins[k:]
        else:
            self.edges = self.edges[k:] - (self.edges[k - 1] if k else 0)
        self.ids, self.words, self.start = self.ids[k:], words[np.searchsorted(words, at):], at


class Chunked:
    """Encodes texts with a tokenizer of byte-level kind, chunk by chunk."""

    def __init__(self, path: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS):
        import json
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cutter = spec.get("pre_tokenizer") or {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # the splicing proof holds for this way of cutting words
        self.stable = (spec.get("normalizer") is None and cutter.get("type") == "ByteLevel"
                       and cutter.get("use_regex", True) and not cutter.get("add_prefix_space"))
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.margin = max([1, *map(len, special)])
        self.chunk, self.overlap = chunk_chars, overlap_chars
        self.quick = id_encoder(path).quick
        if self.quick is not None:
            known = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
            self.size = np.zeros(max(known.values()) + 1, np.int64)
            for token, i in known.items():  # a character of a token stands for a byte
                self.size[i] = len(token.encode()) if token in special else len(token)
            self.pattern = regex.compile(PATTERN)
            self.special = regex.compile("|".join(
                regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None

    def quick_ids(self, part: str):
        """Ids and the bytes at which the tokens end, or nothing."""
        if self.quick is not None:
            try:
                ids = self.quick.encode_to_numpy(part, allowed_special="all").astype(np.int64)
                return ids, np.cumsum(self.size[ids])
            except ValueError:
                pass
        return None, None

    def word_places(self, part: str) -> list[int]:
        """Where words and special tokens begin."""
        out, at = [], 0
        for m in self.special.finditer(part) if self.special else ():
            out += [at + w.start() for w in self.pattern.finditer(part[at:m.start()])]
            out.append(m.start())
            at = m.end()
        return out + [at + w.start() for w in self.pattern.finditer(part[at:])]

    def counts(self, texts: list[str]) -> list[int]:
        return [sum(map(len, self.pieces(t))) for t in texts]

    def pieces(self, text: str):
        """The ids of ``text`` in consecutive arrays, chunk by chunk."""
        step = self.chunk if self.stable else len(text)
        left = Chunk(self, text, 0, min(len(text), step))  # begins at a sure word start
        while left.end < len(text):
            far = min(len(text), left.end + step)
            overlap, cut = self.overlap, None
            while cut is None:
                right = Chunk(self, text, max(left.start, left.end - overlap), far)
                if right.start == left.start:
                    break
                common = np.intersect1d(left.words, right.words[right.words < left.end])
                common = common[(common > left.start) & (common >= right.start + self.margin)
                                & (common <= left.end - self.margin)]
                if len(common):
                    cut = int(common[-1])
                overlap *= 2
            if cut is not None:
                yield left.ids[:left.split(cut)]
                right.cut(cut)
            left = right
        yield left.ids


@lru_cache(maxsize=2)
def _chunked(path: str, chunk_chars: int, overlap_chars: int) -> Chunked:
    return Chunked(path, chunk_chars, overlap_chars)


def token_counts(df: DataFrame, vocabulary_path: str, text_col: str = "text", max_tokens: int = MAX_TOKENS,
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
                 keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    (more than ``max_tokens``) of its texts; ``keep`` names the columns to
    carry along (default: all)."""
    added = ["n_bytes", "n_tokens", "over_limit"]
    keep = clashes(df.select(*map(quoted, keep)) if keep is not None else df, added)
    schema = schema_of(df, keep, [T.StructField("n_bytes", T.LongType(), False),
                                  T.StructField("n_tokens", T.LongType(), False),
                                  T.StructField("over_limit", T.BooleanType(), False)])
    needed = list(dict.fromkeys([*keep, text_col]))
    at, kept = needed.index(text_col), [needed.index(c) for c in keep]

    def run(batches):
        c = _chunked(vocabulary_path, chunk_chars, overlap_chars)
        for batch in batches:
            texts = texts_of(batch.column(at))
            n = c.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in kept]
                + [pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                   pa.array([x > max_tokens for x in n], pa.bool_())],
                names=[*keep, *added])

    return numbered(df, needed).mapInArrow(run, schema)
