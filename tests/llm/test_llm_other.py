"""Chat formatting, WARC, exact search, the pipeline and the registered queries."""

import gzip
import hashlib
import random

import numpy as np
import pytest
from pyarrow import fs as pafs
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from scripts.check_oracle import compare, duck_con
from tomewise.llm import chat, queries, topk, warc
from tomewise.session import scratch_dir

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# chat ---------------------------------------------------------------------

TURNS = "array<struct<role:string,text:string>>"


def plain(turns):
    return [(r or "", t or "") for r, t in (x or (None, None) for x in turns or [])]


def formatted(chosen, rejected):
    a, b = plain(chosen), plain(rejected)
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1

    def show(ts):
        return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in ts)

    def mask(ts):
        return "".join("0" * (len(r) + 5) + ("1" if r == "assistant" else "0") * (len(t) + 8) for r, t in ts)

    return n, show(a[:n]), show(a[n:]), mask(a[n:]), show(b[n:]), mask(b[n:])


def test_preference_format(spark):
    u, a, a2 = ("user", "hé?"), ("assistant", "yes\n"), ("assistant", "no")
    rng = random.Random(1)
    rows = [([u, a], [u, a2]), ([u, a], [u, a]), ([u, a, u, a2], [u, a]), (None, [u]), ([], []), (None, None),
            ([(None, None), a], [("", ""), a2]), ([u, None], [u, ("", "")]), ([u, a] * 500 + [a], [u, a] * 500 + [a2])]
    rows += [([rng.choice([u, a, a2]) for _ in range(rng.randint(0, 6))], [rng.choice([u, a]) for _ in range(rng.randint(0, 6))])
             for _ in range(40)]
    rows += rows[:2]
    df = spark.createDataFrame([(i, c, r, "mine") for i, (c, r) in enumerate(rows)],
                               f"id long, chosen {TURNS}, rejected {TURNS}, PROMPT string").selectExpr("*", "1 as `x.y`")
    out = chat.format_preferences(df)
    assert out.columns == ["id", "chosen", "rejected", "x.y", *chat._ADDED]
    for r in out.collect():
        masks = ["".join(("1" if s.train else "0") * s.chars for s in m) for m in (r.chosen_mask, r.rejected_mask)]
        got = (r.n_prompt_turns, r.prompt, r.chosen_completion, masks[0], r.rejected_completion, masks[1])
        assert got == formatted(*rows[r.id])
        assert r.usable == ("1" in masks[0] and "1" in masks[1])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert chat.format_preferences(df.limit(0)).count() == 0


def test_conversations_and_mirrored_replies(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"),
            (1, 3, "assistant", "b"), (2, 1, "assistant", "only"), (2, 0, "user", "ask"), (3, 0, "assistant", "x"),
            (4, None, None, None), (None, 0, "user", "lost"), (5, 0, "assistant", "1"), (5, 1, "assistant", "2"),
            (5, 2, "assistant", "3")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as turns")
    got = {r.conv_id: (plain(r.turns), plain(r.m)) for r in chat.conversations_as_turns(df)
           .withColumn("m", chat.mirrored_replies(F.col("turns"))).collect()}
    assert [t for _, t in got[1][0]] == ["q", "a", "r", "b"] and [t for _, t in got[1][1]] == ["q", "b", "r", "a"]
    assert [t for _, t in got[2][1]] == ["ask", "ask"] and got[3][1] == [("assistant", "")]
    assert got[4] == ([("", "")],) * 2 and got[None][0] == [("user", "lost")]
    lost = chat.conversations_as_turns(spark.createDataFrame(
        [(None, 0, "user", "a"), (None, 0, "user", "a"), (None, 1, "assistant", "b"), (None, None, None, None)],
        "conv_id long, turn long, role string, text string"))
    assert sorted(plain(r.turns) for r in lost.collect()) == [[("", "")], [("assistant", "b")], [("user", "a")]]
    assert lost.columns == ["conv_id", "turns"]
    assert [t for _, t in got[5][1]] == ["3", "1", "1"]


# WARC ---------------------------------------------------------------------

PAGES = ([(i, f"http://www.h{i % 7}.example.com:80/p/{i}?q=A b#f", f"<p>page {i}</p>" * 20) for i in range(60)]
         + [(100 + i, "https://copy.example.org/x", "<p>the same payload</p>" * 30) for i in range(40)]
         + [(200, "http://a.b/", "tiny"), (201, "http://a.b/", "tiny"), (202, None, None), (203, "no url at all", ""),
            (204, "http://[bad/", "é" * 80), (None, "http://a.b/", "é" * 80), (205, "http://big.example", "x" * 3_000_000),
            (206, "http://a.b/", "é" * 80)])


@pytest.fixture(scope="module")
def archives(spark):
    root = scratch_dir(spark, "warc-test")
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(4).selectExpr(
        "*", "1 as page", "2 as digest", "3 as `k.k`")
    captures = warc.write_archives(df, root, archive_bytes=5_000)
    return df, root, captures, warc.write_index(captures, root, block_lines=7)


def test_warc_round_trip(spark, archives):
    df, root, captures, ranges = archives
    asked = df.select("url", F.col("page_id").alias("page"))
    got = {r.page: r for r in warc.look_up(asked, ranges, root).collect()}
    assert len(got) == len(PAGES) == warc.look_up(asked.union(asked), ranges, root).count()
    first = {}
    for i, _, body in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        raw = (body or "").encode()
        r, digest = got[i], hashlib.sha256(raw).hexdigest()
        again = len(raw) >= 100 and i is not None and digest in first
        assert (r.payload_bytes, r.payload_digest) == (len(raw), digest)
        assert (r.record_type, r.refers_to) == (("revisit", first[digest]) if again else ("response", None))
        assert r.payload == (None if again else raw)
        if i is not None:
            first.setdefault(digest, i)


def test_warc_look_up_by_url_alone(spark, archives):
    df, root, captures, ranges = archives
    asked = spark.createDataFrame([("https://copy.example.org/x",), ("http://a.b",), ("http://none.example/",), (None,)],
                                  "url string")
    got = warc.look_up(asked, ranges, root, payloads=False).collect()
    want = [p[0] for p in PAGES if p[1] in ("https://copy.example.org/x", "http://a.b/", None)]
    assert sorted((r.page for r in got), key=str) == sorted(want, key=str)


def test_warc_files_are_gzip_records_in_sorted_blocks(spark, archives):
    df, root, captures, ranges = archives
    fs, folder = pafs.FileSystem.from_uri(root)
    names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(f"{folder}/archive"))]
    rows = captures.collect()
    assert {r.file for r in rows} == set(names) and len(names) > 4 and not any(n.endswith(".part") for n in names)
    for name in names:
        with fs.open_input_stream(f"{folder}/archive/{name}", compression=None) as f:
            raw = f.read()
        own = sorted((r.at, r.size) for r in rows if r.file == name)
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) == len(raw)
        assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == len(own)
    keys = [(r.key, r.page if r.page is not None else -(1 << 63)) for r in rows]
    reader = warc._Reader(root, [tuple(r)[:4] for r in ranges.collect()])
    listed = [k for x in reader.ranges for b in reader._directory(x[3])[0] for k in reader._lines(x[2], *b[2:])[1]]
    assert listed == sorted(keys)


def test_url_keys():
    assert warc.url_key("HTTP://www.Shop.Example.com:80/A?b=C#d") == "com,example,shop)/a?b=c"
    assert warc.url_key("https://x.org:8080") == "org,x:8080)/" and warc.url_key(None) == ""


def test_warc_empty_table(spark):
    root = scratch_dir(spark, "warc-empty")
    df = spark.createDataFrame([], "page_id long, url string, html string")
    ranges = warc.write_index(warc.write_archives(df, root), root)
    assert warc.look_up(df.select("url"), ranges, root).count() == 0


# exact search ---------------------------------------------------------------

def brute_search(rows, queries_, k):
    rows = [(i, w) for i, w in rows if i is not None and w is not None and None not in w]
    out = {}
    for q, qw in queries_:
        if q is None or qw is None or None in qw:
            continue
        scored = sorted((-min(max(sum(a * b for a, b in zip(qw, w)), -2**63), 2**63 - 1), i) for i, w in rows if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


@pytest.mark.parametrize("size", [3, 1000])
def test_top_k_matches_brute_force(spark, size):
    rng = random.Random(7)
    rows = [(i, [rng.choice([0, 0, 0, 1, -2, 3]) for _ in range(8)]) for i in range(120)]
    rows += [(200 + i, [1, 0, 3, 0, 1, 0, 0, 1]) for i in range(50)]  # ties
    rows += [(300, []), (301, None), (302, [1, None]), (None, [1] * 8), (303, [2**62] * 8), (304, [5])]
    df = spark.createDataFrame(rows, "vec long, w array<bigint>").selectExpr("*", "1 as id", "2 as terms").repartition(3)
    asked = df.where("vec % 10 = 0 or vec = 303")
    out = topk.top_k(asked.union(asked), df, 4, "vec", "w", candidate_block=size, small_block=size, query_block=size)
    got = {}
    for r in sorted(out.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.id, r.score))
        assert r["rank"] == len(got[r.query_id])
    assert got == brute_search(rows, [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] == 303)], 4)
    assert topk.top_k(asked.limit(0), df, 4, "vec", "w").count() == 0
    assert topk.top_k(asked, df.limit(0), 4, "vec", "w").count() == 0


def test_top_k_with_terms_and_repeated_candidates(spark):
    rows = [(1, [3, 9], [2, 5]), (2, [9], [7]), (2, [9], [7]), (3, [4, 3, 3], [1, 1, 1]), (50, [9, 3], [1, 10])]
    df = spark.createDataFrame(rows, "id long, terms array<int>, weights array<bigint>")
    got = [(r.query_id, r["rank"], r.id, r.score) for r in topk.top_k(df.where("id = 50"), df, 5, terms_col="terms")
           .orderBy("rank").collect()]
    assert got == [(50, 1, 1, 25), (50, 2, 3, 20), (50, 3, 2, 7), (50, 4, 2, 7)]


def test_top_k_of_an_id_in_many_rows(spark):
    rng = random.Random(3)
    rows = [(rng.choice([7, 7, 7, 8, i]), [rng.randint(-3, 3) for _ in range(6)]) for i in range(20, 420)]
    rows += [(9, [1, 2, 3, 3, 2, 1])] * 300
    df = spark.createDataFrame(rows, "id long, weights array<bigint>").repartition(3)
    asked = df.where("id < 60")
    dealt = topk._dealt(asked, df, 5, "id", "weights", None, 50, 50, 50).groupBy("q", "c", "asks").count()
    assert max(r["count"] for r in dealt.collect()) < 100
    for size in (50, 10_000):
        got = {}
        for r in sorted(topk.top_k(asked, df, 5, candidate_block=size, small_block=size, query_block=size).collect(),
                        key=lambda r: r["rank"]):
            got.setdefault(r.query_id, []).append((r.id, r.score))
        want = {}
        for q in {i for i, _ in rows if i < 60}:
            own = {tuple(w) for i, w in rows if i == q}
            best = sorted((-max(sum(a * b for a, b in zip(o, w)) for o in own), i) for i, w in rows if i != q)
            want[q] = [(i, -s) for s, i in best[:5]]
        assert got == want


def test_the_rows_of_one_query_are_scored_in_parts(monkeypatch):
    import pyarrow as pa
    rows = [(True, 1, [i, -i], 0, 0) for i in range(30)] + [(False, 2 + i, [i, 5 - i], i, 0) for i in range(10)]
    group = pa.table([*map(list, zip(*[(a, i, None, w, key, copy) for a, i, w, key, copy in rows]))],
                     schema=pa.schema([("asks", pa.bool_()), ("id", pa.int64()), ("terms", pa.list_(pa.int64())),
                                       ("weights", pa.list_(pa.int64())), ("key", pa.int64()), ("copy", pa.int64())]))
    whole, sizes, scores = topk._search(group, 4), [], topk.Postings.scores
    monkeypatch.setattr(topk, "_SCORES", 70)
    monkeypatch.setattr(topk.Postings, "scores", lambda *a: sizes.append(a[-1]) or scores(*a))
    assert topk._search(group, 4).equals(whole) and sizes == [7, 7, 7, 7, 2]


def test_quantised(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([None],), ([float("nan")],), ([float("inf")],), (None,), ([],)],
                               "e array<float>")
    assert [r[0] for r in df.select(topk.quantised("e")).collect()] == [[128, -1], None, None, None, None, []]


def test_selection_breaks_ties_to_the_left():
    rng = np.random.default_rng(0)
    for _ in range(50):
        scores = rng.integers(0, 4, (5, int(rng.integers(1, 30)))).astype(float)
        for row, got in zip(scores, topk.select(scores, 5)):
            assert got.tolist() == sorted(range(len(row)), key=lambda i: (-row[i], i))[:5]


# queries and pipeline --------------------------------------------------------

@pytest.fixture(scope="module")
def con():
    return duck_con(SF01)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_duckdb(spark, con, name):
    msg = compare(spark, con, name, queries.QUERIES[name], queries.ORACLE[name], SF01)
    assert ": OK" in msg, msg


def test_queries_are_registered():
    names = E.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names) and set(queries.ORACLE) <= set(E.oracle_sql())


def test_chat_query_stays_native(spark):
    plan = queries.op1_preference_format(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_matches_a_plain_version(spark):
    from test_llm_simhash import fingerprint, groups
    from test_llm_text import brute_lines, brute_rules
    from test_llm_tokens import check_packing
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()]
    docs = [d for d in docs if brute_rules(d[1])["kept"]]
    docs = [(key[0], text) for key, (text, _) in brute_lines(docs).items()]
    root = groups([fingerprint(t) for _, t in docs])
    docs = {d[0]: d[1] for i, d in enumerate(docs) if root[i] == i}
    rows = corpus_pipeline.run(spark, SF001).collect()
    check_packing(rows, docs, 1024)


def test_pipeline_stages_keep_the_columns(spark, scratch):
    rows = [(i, t, "en", "s", 3) for i, t in enumerate(
        [None, "", "short", *[" ".join(f"w{k}x{i}" for i in range(70)) for k in range(3)]] * 2)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, columns), spark.createDataFrame([], columns)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            docs = stage(spark, docs, SF001)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            path = f"{scratch}/{k}-{'full' if rows else 'empty'}"
            docs.write.mode("overwrite").parquet(path)
            docs = spark.read.parquet(path)
        rows = []
    assert docs.count() == 0


def test_near_dedup_decides_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(1, a, "first"), (2, a, "copy"), (1, b, "same id, other text"), (3, b, "copy"), (None, c, "no id"),
            (None, c, "no id"), (None, a, "no id, text of 1"), (None, a, "no id, text of 1"), (4, None, "null"),
            (5, "", "no words"), (None, None, "null, no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    for parts in (1, 4):
        out = corpus_pipeline.near_dedup(spark, docs.repartition(parts), SF001)
        assert out.columns == docs.columns
        assert sorted(map(tuple, out.collect()), key=str) == sorted(
            [rows[0], rows[2], rows[4], rows[6], rows[8], rows[10]], key=str)


def test_near_dedup_of_rows_that_differ_in_other_columns(spark):
    """Which of several rows of one id and text stays does not depend on their order."""
    rows = [(1, "one two three four", "en", f"src{i}", 10 + i) for i in range(20)] + [(2, "else", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .withColumn("more", F.create_map(F.lit("k"), F.col("source")))
    stays = set()
    for parts, desc in ((1, False), (7, True), (3, False)):
        d = docs.repartition(parts, F.col("source")).sortWithinPartitions(F.col("source").desc() if desc else "source")
        out = corpus_pipeline.near_dedup(spark, d, SF001)
        assert out.columns == docs.columns
        stays.add(tuple(sorted((r.doc_id, r.source, r.n_chars, r.more["k"]) for r in out.collect())))
    (kept,) = stays
    assert [r[0] for r in kept] == [1, 2] and kept[0][1] == kept[0][3]


def test_pipeline_stages_with_odd_rows_and_columns(spark):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(1, words, None, None, None, "x"), (1, words, None, None, None, "x"), (2, words, "en", "s", 9, "y"),
            (None, words, "en", "s", 9, "z"), (3, None, None, "s", 1, "u"), (4, words + " more and more", "en", None, 2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    docs = docs.selectExpr("*", "kept as n_lines", "kept as `a.b`", "kept as _first", "kept as fingerprint")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_out = stage(spark, docs, SF001)
        assert docs_out.columns == docs.columns
        docs = docs_out
    got = sorted(((r.doc_id, r.kept, r.n_lines, r["a.b"], r._first, r.fingerprint) for r in docs.collect()), key=str)
    assert [g[0] for g in got] == [1, 4, None] and all(len(set(g[1:])) == 1 for g in got)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert sorted((r.doc_id for r in packed), key=str) == [1, 4, None]
