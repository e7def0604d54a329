"""Text scalar functions as native ``Column`` expressions (no Python UDF).

All of them run inside whole-stage code generation; regular expressions are
Java ones, written so that RE2 (the oracle) reads them the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tomewise.functions.constants import (
    CLEAN_FILTER_CHARS,
    CONTRACTIONS,
    USELESS_WORDS,
    WHITESPACE_RUN,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# TX1 + TX2 ------------------------------------------------------------------

def collapse_whitespace(c) -> Column:
    """Python's ``' '.join(x.split())``: any whitespace run to one space, trimmed."""
    return F.trim(F.regexp_replace(_col(c), WHITESPACE_RUN, " "))


def normalise(c) -> Column:
    """Lower-case, then collapse whitespace (null in, null out)."""
    return collapse_whitespace(F.lower(_col(c)))


# TX3, TX4 -------------------------------------------------------------------

def full_length(c) -> Column:
    """Characters (code points) of the text."""
    return F.length(_col(c))


def mean_word_length(c) -> Column:
    """Mean length of space-separated words of a normalised text; NaN if none."""
    c = _col(c)
    words = F.size(F.split(c, " "))
    letters = F.length(F.replace(c, F.lit(" "), F.lit("")))
    return F.when(F.length(c) == 0, F.lit(float("nan"))).otherwise(letters / words)


# TX5 .. TX10 ----------------------------------------------------------------

def remove_digits(c) -> Column:
    return F.regexp_replace(_col(c), "[0-9]+", "")


def strip_html(c) -> Column:
    """Remove tags, shortest match, never across a newline."""
    return F.regexp_replace(_col(c), "<[^\\n]*?>", "")


def remove_quotes(c) -> Column:
    """Drop backslashes and double quotes."""
    return F.translate(_col(c), '\\"', "")


def remove_non_ascii(c) -> Column:
    return F.regexp_replace(_col(c), "[^\\x00-\\x7f]", "")


def strip_urls(c) -> Column:
    """``http`` and the non-whitespace run after it."""
    return F.regexp_replace(_col(c), "http[^\\x09-\\x0d\\x1c-\\x20]+", "")


def punctuation_to_space(c) -> Column:
    return collapse_whitespace(
        F.translate(_col(c), CLEAN_FILTER_CHARS, " " * len(CLEAN_FILTER_CHARS)))


def clean(c) -> Column:
    """Tags, quotes, non-ASCII, URLs, punctuation, in that order."""
    c = strip_html(c)
    c = remove_quotes(c)
    c = remove_non_ascii(c)
    c = strip_urls(c)
    return punctuation_to_space(c)


# TX11 -----------------------------------------------------------------------

def _replacement(found: Column, pairs: list[tuple[str, str]]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in pairs for x in pair]), found)


# Marks the keys found in a text while they are replaced.
_MARK = "\x01"


def _expand_substrings(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Every leftmost match of the keys' alternation, the first key that fits
    at its place, replaced: one pass of the alternation puts marks around the
    matches, and of the parts between marks every second one is a key.  A text
    that holds the mark itself is cut at the matches and its keys are extracted.

    Keys are letters and apostrophes.  A look at the letters up to the next
    apostrophe spares most places the alternation, and a text without a key's
    apostrophe or a key that has none is not searched at all."""
    plain = [k for k, _ in pairs if "'" not in k]
    reach = max((k.index("'") for k, _ in pairs if "'" in k), default=0)
    ahead = "|".join([f"[A-Za-z]{{0,{reach}}}+'", *plain])  # possessive: letters read once are not given back
    keys = f"(?={ahead})(?:{'|'.join(k for k, _ in pairs)})"

    def put(parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 1, _replacement(x, pairs)).otherwise(x)), "")

    def cut(text: Column) -> Column:
        between, found = F.split(text, keys, -1), F.regexp_extract_all(text, F.lit(keys), 0)
        both = F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda x, y: F.array(x, y))
        return F.flatten(both)

    def one(text: Column) -> Column:
        some = F.contains(text, F.lit("'"))
        for k in plain:
            some = some | F.contains(text, F.lit(k))
        marked = F.split(F.regexp_replace(text, keys, f"{_MARK}$0{_MARK}"), _MARK, -1)
        parts = F.when(F.contains(text, F.lit(_MARK)), F.slice(cut(text), 1, F.size(cut(text)) - 1)).otherwise(marked)
        return F.when(some, put(parts)).otherwise(text)

    return F.transform(F.array(c), one)[0]  # the text is computed once, not once per use


def expand_contractions(c, mode: str = "substrings") -> Column:
    """Expand English contractions.

    ``substrings``: wherever a key of the table occurs, as written, also inside
    a word; the first key of the table that fits at a place wins (``he'd``
    before ``he'd've``).  Meant for raw texts.
    ``cleaned``: the same for a cleaned text, which has no apostrophes left, so
    only keys without one are looked for.
    ``tokens``: whole-token look-up with lower-cased keys (no shadowing by
    shorter keys), meant to run before cleaning.
    """
    c = _col(c)
    if mode == "substrings":
        return _expand_substrings(c, list(CONTRACTIONS.items()))
    if mode == "cleaned":
        pairs = [(k, v) for k, v in CONTRACTIONS.items() if "'" not in k]
        return F.regexp_replace(c, *pairs[0]) if len(pairs) == 1 else _expand_substrings(c, pairs)
    if mode == "tokens":
        # A map look-up scans the map's keys; the hash-set test (``InSet``)
        # in front sends only real contractions to it.
        pairs = [(k.lower(), v.lower()) for k, v in CONTRACTIONS.items()]
        keys = [k for k, _ in pairs]
        return F.array_join(F.transform(
            F.split(c, " "), lambda w: F.when(w.isin(*keys), _replacement(w, pairs)).otherwise(w)), " ")
    raise ValueError(f"unknown mode {mode!r}")


# TX12, TX13 -----------------------------------------------------------------

def remove_stopwords(c, stopwords: list[str] | None = None) -> Column:
    """Drop listed tokens from a space-separated text.

    ``isin`` over a literal list becomes a hash-set look-up (``InSet``).
    """
    stop = USELESS_WORDS if stopwords is None else stopwords
    kept = F.filter(F.split(_col(c), " "), lambda w: ~w.isin(*stop))
    return F.array_join(kept, " ")


def tokenize_filtered(c, order: str = "reference", stopwords: list[str] | None = None) -> Column:
    """The heavy EDA cleaner: digits, clean, contractions, stop words.

    ``order='contractions_first'`` expands whole-token contractions before
    the cleaner turns apostrophes into spaces.
    """
    x = remove_digits(c)
    if order == "reference":
        x = expand_contractions(clean(x), mode="cleaned")
    elif order == "contractions_first":
        x = clean(expand_contractions(collapse_whitespace(F.lower(x)), mode="tokens"))
    else:
        raise ValueError(f"unknown order {order!r}")
    return remove_stopwords(x, stopwords)


# TX14, TX15 -----------------------------------------------------------------

def word_tokens(c) -> Column:
    """Words of two or more word characters, lower-cased."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit("\\b\\w\\w+\\b"), 0)


def ngrams(tokens, n: int) -> Column:
    """Contiguous n-grams of a token array, joined by single spaces."""
    t = _col(tokens)
    grams = F.transform(F.sequence(F.lit(1), F.size(t) - n + 1),
                        lambda i: F.array_join(F.slice(t, i, n), " "))
    return F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))


def contains_phrase(c, phrase: str) -> Column:
    """Literal substring test, case as stored."""
    return F.contains(_col(c), F.lit(phrase))
