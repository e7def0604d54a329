"""BPE codec, token counts and packing against the public libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tomewise.llm import bpe, ids, packing, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
HARD = [None, "", " ", "\n\n\t x  y ", "<|endoftext|>", "a<|endoftext|> b  <|endoftext|>c", "<|endof", "aaaaaaa" * 300,
        "it's I'll we've 12 345", "é" * 50, "日本語 テキスト", "😀😀 ok 👩‍👩‍👧", "  x\u0085y", "\x1c\x1d a",
        "\U0001d6a6x ࢏ y ՘z ⃁", "ẞ" * 9, " " * 5000 + "x", "Ünïcödé " * 400, "abc " * 40000]


def want(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def noise(n, seed=3):
    rng = random.Random(seed)
    bits = ["a", "  ", "\n", "the ", "'s", "'ll", " 123", "é", "日本", "<|endoftext|>", "<|end", "text|>", "!!", "   x",
            "\t", "foo bar", "abcdefg" * 3, " ", "zz" * 9]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 200))) for _ in range(n)]


def table(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_codec_gives_the_librarys_ids_and_texts():
    codec = bpe.Codec(bpe.Vocabulary(PATH), max_words=500)
    texts = [t or "" for t in HARD] + noise(300)
    for k in range(0, len(texts), 40):  # the remembered words are dropped several times
        part = texts[k:k + 40]
        got, ends = codec.encode(part)
        assert [x.tolist() for x in np.split(got, ends[:-1])] == [want(t) for t in part]
        assert codec.decode(got, ends) == [LIBRARY.decode(want(t), skip_special_tokens=False) for t in part]


def test_merge_takes_overlapping_pairs_from_the_left():
    v = bpe.Vocabulary(PATH)
    for word in ["aaa", "aaaa", "aaaaaaaaaaa", "ababababa", "zzzzzz", "====" * 7]:
        tokens, count = v.merge([word.encode(), b"", word.encode()])
        assert tokens.tolist() == want(word) * 2 and count.tolist() == [len(want(word)), 0, len(want(word))]


def test_every_code_point_is_cut_like_the_library_does():
    v = bpe.Vocabulary(PATH)
    step = 37  # every class of characters, in a run time fit for a test
    for c in [*range(0, 0x3000), *range(0x3000, 0xD800, step), *range(0xE000, 0x110000, 11 * step)]:
        text = f"a{chr(c)}b1{chr(c)}1{chr(c)} !{chr(c)}"
        assert v.cut(text) == [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)], hex(c)


def test_encode_and_decode_dataframes(spark):
    df = table(spark, HARD + noise(50)).selectExpr("*", "'kept' as `x.y`", "1 as IDS")
    out = bpe.encode(df, PATH, outputs=("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"))
    assert out.columns == ["doc_id", "text", "x.y", "ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"]
    for r in out.collect():
        w = want(r.text)
        assert r.ids == w and r.n_tokens == len(w) and r["x.y"] == "kept"
        assert r.ids_sha256 == hashlib.sha256(np.array(w, "<u4").tobytes()).hexdigest()
        assert r.decoded == (r.text or "")
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    back = bpe.decode(out.select("doc_id", "text", "ids"), PATH)
    assert all(r.decoded == (r.text or "") for r in back.collect())
    nothing = bpe.decode(spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>"), PATH)
    assert [r.decoded for r in nothing.collect()] == ["", ""]


@pytest.mark.parametrize("op", [
    lambda d: bpe.encode(d, PATH), lambda d: token_counts.token_counts(d, PATH), lambda d: packing.pack(d, PATH)])
def test_empty_tables(spark, op):
    assert op(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chunks_are_spliced_where_both_agree():
    rng = random.Random(1)
    whole = token_counts.Chunked(PATH, 10**9)
    for text in noise(400, 5) + ["x" * 900, " " * 900, "<|endoftext|>" * 60]:
        c = token_counts.Chunked.__new__(token_counts.Chunked)
        c.__dict__.update(whole.__dict__, chunk=rng.randint(15, 60), overlap=rng.randint(1, 20))
        assert [int(x) for part in c.pieces(text) for x in part] == want(text)


def test_token_counts(spark):
    texts = HARD + noise(20) + ["word soup " * 30000]
    out = token_counts.token_counts(table(spark, texts + texts).selectExpr("*", "5 as n_bytes"), PATH, chunk_chars=2000,
                                    overlap_chars=50)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    for r in out.collect():
        n = len(want(r.text))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 512)


def test_quick_ids_equal_the_librarys():
    encode = ids.IdEncoder(PATH)
    assert encode.quick is not None
    for text in [t or "" for t in HARD] + noise(200, 9) + [" " * 1_000_000]:
        assert encode(text).tolist() == want(text)
    other = ids.IdEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.quick is None and other("Some words").tolist() == Tokenizer.from_file(
        public_tokenizers.path("word_bpe_49k.json")).encode("Some words", add_special_tokens=False).ids


def test_quick_ids_on_every_code_point():
    encode = ids.IdEncoder(PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 20_000):
        texts = [f"a{chr(c)}b1{chr(c)}1{chr(c)} !{chr(c)}" for c in points[k:k + 20_000]]
        for text, e in zip(texts, LIBRARY.encode_batch_fast(texts, add_special_tokens=False)):
            assert encode(text).tolist() == e.ids, text


def check_packing(rows, texts, size, end_id=2):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in texts.items():
        own = want(text) + [end_id]
        got = sorted(by_doc.pop(i), key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(-(-len(own) // size)))
        at = 0
        for r in got:
            assert r.start == at and 0 < r.length <= size and (r.piece == 0 or r.length == size)
            assert r.ids_crc32 == zlib.crc32(np.array(own[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(own)
    assert not by_doc
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence)


def test_packing_keeps_every_id_once(spark):
    texts = dict(enumerate(HARD + noise(300, 2)))
    df = table(spark, list(texts.values())).selectExpr("*", "'s' as sequence_id", "0 as piece")
    out = packing.pack(df, PATH, sequence_tokens=64, group_rows=100, with_ids=True)
    rows = out.collect()
    n = check_packing(rows, texts, 64)
    total = sum(r.length for r in rows)
    assert n <= 1.03 * total / 64 + 4
    assert all(list(r.ids) == (want(texts[r.doc_id]) + [2])[r.start:r.start + r.length] for r in rows)


def test_placing_follows_the_sum_of_squares():
    def brute(lengths, capacity):
        """The rule as stated: compare the full sums of squares."""
        gaps, where = [], []
        for n in sorted(lengths, reverse=True):
            best = None
            for gap in sorted({g for g in gaps if g >= n}):
                after = [*gaps]
                after.remove(gap)
                after.append(gap - n)
                count = {g: after.count(g) for g in after if g}
                cost = sum(x * x for x in count.values())
                if best is None or cost < best[0]:
                    best = (cost, gap)
            if best is None:
                gaps.append(capacity - n)
                where.append(capacity)
            else:
                gaps.remove(best[1])
                gaps.append(best[1] - n)
                where.append(best[1])
        return len(gaps), where

    rng = np.random.default_rng(4)
    for capacity in (10, 24):
        for _ in range(40):
            lengths = rng.integers(1, capacity, rng.integers(1, 60))
            sequence, offset = packing.place(lengths, capacity)
            n, where = brute(lengths.tolist(), capacity)
            order = np.argsort(-lengths, kind="stable")
            assert len(set(sequence.tolist())) == n
            assert (capacity - offset[order]).tolist() == where


def test_packing_real_rows_close_to_the_bound(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    n = check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, 1024)
    assert n <= 1.01 * sum(r.length for r in rows) / 1024 + 2
