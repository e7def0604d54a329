"""Ids of whole texts under a public byte-level BPE file, the quick way.

The file's own vocabulary and merge order are handed to a library that merges
by rank; this gives the same ids as the file's own library if ranks follow the
order of the merges, which is checked when a file is opened.  Files of another
kind, and texts on which the quick library gives up (very long runs of white
space), go to the file's own library.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

from tomewise.llm.bpe import PATTERN, byte_characters


class IdEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.quick = _by_rank(spec)

    def __call__(self, text: str) -> np.ndarray:
        """Ids of ``text`` as unsigned 32-bit integers, no special tokens added."""
        if self.quick is not None:
            try:
                return self.quick.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
            except ValueError:
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


def _by_rank(spec: dict):
    model, cutter = spec["model"], spec.get("pre_tokenizer") or {}
    if (model["type"] != "BPE" or spec.get("normalizer") or cutter.get("type") != "ByteLevel"
            or cutter.get("add_prefix_space") or not cutter.get("use_regex", True)
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])):
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in merges]
    if any(x >= y for x, y in zip(made, made[1:])) or made and made[0] < 256:
        return None
    import tiktoken
    to_byte = {c: b for b, c in enumerate(byte_characters())}
    return tiktoken.Encoding(
        "byte-bpe", pat_str=PATTERN,
        mergeable_ranks={bytes(to_byte[c] for c in t): i for t, i in model["vocab"].items()},
        special_tokens={t["content"]: t["id"] for t in spec["added_tokens"]})


@lru_cache(maxsize=2)
def id_encoder(path: str) -> IdEncoder:
    """The encoder of a vocabulary file, one per worker process."""
    return IdEncoder(path)
