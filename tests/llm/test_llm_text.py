"""Repetition rules, line windows and main text against plain versions."""

import random
import re

import numpy as np
import pytest

from tomewise.llm import line_windows, main_text, repetition

EDGE = [None, "", "   ", "\n\n\n", "one", "a b " * 40, "same line here\n" * 60, "é ñ ü " * 30, "#$% *** |a| <b> &c"]


def brute_repeats(words):
    n, best = len(words), [0] * len(words)
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            best[i] = max(best[i], k)
    return best


def brute_rules(text):
    text = text or ""
    words = text.encode().split()
    best = brute_repeats(words)

    def covered(least, width):
        return len({i + k for i, b in enumerate(best) if b >= least for k in range(width or b)})

    n, lines = len(words), [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    window, cover, longest = covered(3, 3), covered(5, 0), max(best, default=0)
    failed = n < 50 or 100 * window > 50 * n
    return {"n_words": n, "word_chars": len(b"".join(words).decode()), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": window, "n_covered_words": cover,
            "longest_repeat": longest, "base_failed": failed,
            "kept": not failed and 100 * cover <= repetition.MAX_COVERED_PERCENT * n and (
                longest <= repetition.MAX_REPEAT_WORDS or 100 * longest <= repetition.MAX_REPEAT_PERCENT * n)}


def test_longest_repeats_match_brute_force():
    rng = random.Random(0)
    for _ in range(200):
        docs = [[rng.choice("abcd"[:rng.randint(1, 4)]) for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(0, 6))]
        token = np.array([ord(w) + 1000 * d for d, ws in enumerate(docs) for w in ws], np.int64)
        assert repetition.longest_repeats(token).tolist() == [x for ws in docs for x in brute_repeats(ws)]


def test_repetition_rules(spark):
    rng = random.Random(2)
    prose = [" ".join(rng.choice([f"w{i}" for i in range(k)]) for _ in range(rng.randint(40, 250)))
             for k in (5, 30, 80, 3000) for _ in range(12)]
    half = " ".join(f"u{i}" for i in range(140))
    texts = EDGE + prose + [half + " " + half + " " + " ".join(f"v{i}" for i in range(300)), half + " x " + half] + prose[:3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'q' as KEPT", "1 as `a.b`")
    out = repetition.repetition_rules(df.repartition(4))
    assert out.columns[:3] == ["doc_id", "text", "a.b"]
    for r in out.collect():
        want = brute_rules(r.text)
        assert {k: r[k] for k in want} == want
        assert 0 <= r.n_maximal_repeats <= r.n_words
    assert repetition.repetition_rules(spark.createDataFrame([], "text string")).count() == 0


def test_the_longest_repeat_decides_by_itself(spark):
    def pasted(block, others):
        words = [f"b{i}" for i in range(block)]
        return " ".join(words + [f"v{i}" for i in range(others)] + words)

    texts = [pasted(1500, 7000), pasted(25, 200), pasted(21, 300), pasted(20, 300), pasted(40, 2000), pasted(13, 70),
             pasted(50, 2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = sorted(repetition.repetition_rules(df).collect())
    assert [r.longest_repeat for r in out] == [1500, 25, 21, 20, 40, 13, 50]
    assert not any(r.base_failed or 100 * r.n_covered_words > repetition.MAX_COVERED_PERCENT * r.n_words for r in out)
    assert [r.kept for r in out] == [False, False, False, True, True, True, False]


def test_the_covered_share_decides_by_itself(spark):
    def phrases(n, others):
        each = [[f"p{k}_{i}" for i in range(6)] for k in range(n)]
        fill = [f"v{i}" for i in range(others)]
        return " ".join(w for k in range(2) for j, p in enumerate(each) for w in [*p, fill[2 * j + k]]) + " " + " ".join(
            fill[2 * n:])

    texts = [phrases(3, 64), phrases(3, 84), phrases(3, 85), phrases(20, 400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = sorted(repetition.repetition_rules(df).collect())
    assert [(r.n_covered_words, r.n_words, r.longest_repeat) for r in out] == [
        (36, 100, 6), (36, 120, 6), (36, 121, 6), (240, 640, 6)]
    assert not any(r.base_failed for r in out)
    assert [r.kept for r in out] == [False, True, True, False]


def test_repetition_of_a_very_long_text():
    text = ("alpha beta gamma delta epsilon " * 40_000).strip()
    m = repetition.measure([text, "short one"])
    assert m["n_words"].tolist() == [200_000, 2] and m["longest_repeat"].tolist() == [199_995, 0]
    assert m["n_covered_words"].tolist() == [200_000, 0] and m["n_maximal_repeats"][0] >= 1


def brute_lines(rows, window=3):
    """rows: (id, text), sorted with null ids last; equal rows once."""
    first, out = set(), {}
    for key in rows:
        if key in out:
            continue
        lines, gone = (key[1] or "").split("\n"), set()
        bare = [x.strip(" ") for x in lines]
        for i in range(len(lines) - window + 1):
            w = tuple(bare[i:i + window])
            if any(x.split() for x in w):
                if w in first:
                    gone |= set(range(i, i + window))
                first.add(w)
        out[key] = ("\n".join(x for k, x in enumerate(lines) if k not in gone) if key[1] is not None else None, len(gone))
    return out


def test_line_windows(spark):
    rng = random.Random(5)
    pool = ["", " ", "alpha", " alpha ", "beta", "gamma", "delta x", "é"]
    texts = EDGE + ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(60)]
    texts += ["\n".join(f"unique {k} {i}" for i in range(5)) for k in range(3)] * 2 + ["a\nb\nc\na\nb\nc\na\nb"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, EDGE[6]), (3, "a\nb\nc"), (None, "a\nb\nc"), (None, "x\ny\nz")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    df = df.selectExpr("*", "'k' as `_lines`", "1 as N_LINES", "2 as _id", "3 as `d.e`")
    out = line_windows.remove_repeated_windows(df)
    assert out.columns == ["doc_id", "text", "_lines", "_id", "d.e", "n_lines", "n_removed"]
    # rows with one id are ordered by a hash of the text, so those ids must not compete for a window here
    want = brute_lines(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)))
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_removed))
    for (i, text), w in want.items():
        assert w in got[i], (i, text)
    assert sum(map(len, got.values())) == len(rows)
    assert line_windows.remove_repeated_windows(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_windows_on_a_very_long_text_and_a_hot_passage(spark):
    long = "\n".join(f"line {i % 5000}" for i in range(20_000))
    hot = "\n".join(["hot one", "hot two", "hot three", "hot four"])
    rows = [(0, long)] + [(i, f"start {i}\n{hot}\nend {i}") for i in range(1, 400)]
    out = {r.doc_id: r for r in line_windows.remove_repeated_windows(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert out[0].n_removed == 15_000 and out[0].text == "\n".join(f"line {i}" for i in range(5000))
    assert out[1].text == rows[1][1] and all(out[i].text == f"start {i}\nend {i}" for i in range(2, 400))


PARAGRAPH = "Some long article paragraph text with many words in it. " * 4


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("Just text &amp; more", "Just text & more"),
    ("<article><h1>T&eacute;</h1><p>a  b\n c<br>d<p>e &lt;p&gt;&nbsp;f</article>", "Té\na b c d\ne <p> f"),
    ("<article><p>x<script>if(a<b){'</p>'}</script>y</p><style>p{}</style><!-- <p>no</p> --></article>", "xy"),
    ("<article><ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>end", "x\ny\n1\n2\n3\nend"),
    ("<nav><a href=x>Home</a></nav><article><p>Body.</p><aside>side</aside></article><footer>f</footer>", "Body."),
    ("<main><h1>Head</h1><article><p>Body.</p></article><div class=comments><p>Hi</p></div></main>", "Head\nBody."),
    ("<article><header><h1>T</h1></header><p>P.</p><form><input><button>Go</button></form>"
     "<section id='reader-comments'><article><p>me</p></article></section></article>", "T\nP."),
    (f"<div id=top-menu><a href=x>Home</a> <a href=y>News</a></div><div class=cookie-notice>We use cookies, yes.</div>"
     f"<div class='page has-sidebar'><h2>Title</h2><p>{PARAGRAPH}</p><div class='ad'>Buy this now</div><p>{PARAGRAPH}</p>"
     f"<p>Short end.</p></div><div class=footer>(c) 2024</div>",
     f"Title\n{PARAGRAPH.strip()}\n{PARAGRAPH.strip()}\nShort end."),
    (f"<div>Home | About</div><div><p>{PARAGRAPH}</p></div><div>2020 Foo Inc</div>", PARAGRAPH.strip()),
    (f"<div id=header>Site</div><div class=wrap><div class=menu>Home</div><div class=story><div class=article-header>"
     f"<div>The headline</div></div><p>{PARAGRAPH}</p><ul><li>one</li><li>two</li></ul></div><div>Related links here</div>"
     f"</div>", f"The headline\n{PARAGRAPH.strip()}\none\ntwo"),
    (f"<table><tr><td><a href=a>Menu</a><td><p>{PARAGRAPH}<p>{PARAGRAPH}<p>End</table>",
     f"{PARAGRAPH.strip()}\n{PARAGRAPH.strip()}\nEnd"),
    ("<nav>x</nav><div class=ad><p>All is an advert, by name.</p></div><footer>f</footer>", ""),
    (f"<div class=comments><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>", f"{PARAGRAPH.strip()}\n{PARAGRAPH.strip()}"),
    ("<p style='display: none'>hidden</p><p hidden>gone</p><p>shown</p>", "shown"),
    ("<article><b>bold<p>one</b> two</p><p>three", "bold\none two\nthree"),
    ("<script>only()</script>", ""),
])
def test_main_text(page, want):
    assert main_text.main_text(page) == want


def test_surge_and_dive_points():
    assert main_text.spans([0, 0, 5, 0, 0, 0, 90, 0, 100, 0, 0, 0, 7], 3, 80) == [(6, 9)]
    assert main_text.spans([], 3, 80) == [] and main_text.spans([500], 3, 80) == [(0, 1)]


def brute_spans(lengths, window, rise):
    """Each line's window is summed by itself and written as a letter: S where
    it surges, p where it holds any text, z where it holds none; a range is a
    surge and what follows up to the dive, without its empty ends."""
    sums = [sum(lengths[i:i + window]) for i in range(len(lengths))]
    letters = "".join("S" if s >= rise else "p" if s else "z" for s in sums)
    out = []
    for m in re.finditer("S[Sp]*", letters):
        full = [i for i in range(m.start(), m.end()) if lengths[i]]
        out.append((full[0], full[-1] + 1))
    return out


def test_spans_match_brute_force():
    rng = random.Random(11)
    for _ in range(2000):
        lengths = [rng.choice([0, 0, 0, 3, 20, 60, 200]) for _ in range(rng.randint(0, 40))]
        window, rise = rng.randint(1, 6), rng.randint(1, 150)
        assert main_text.spans(lengths, window, rise) == brute_spans(lengths, window, rise)


def test_spans_of_all_pages_match_brute_force():
    import duckdb
    pages = duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    some = 0
    for (page,) in pages:
        for by_name in (True, False):
            lengths = main_text.Lines(page, by_name).plain
            found = main_text.spans(lengths, main_text.WINDOW_LINES, main_text.RISE_CHARS)
            assert found == brute_spans(lengths, main_text.WINDOW_LINES, main_text.RISE_CHARS)
            some += bool(found)
    assert len(pages) == 250 and some > 400


def test_marked_pages_are_cut_by_their_surges():
    teaser, end = "<article><p>Read on</p></article>", "Short end."
    for body, want in [(f"<div><p>{PARAGRAPH}</p><p>{end}</p></div>" + "<p></p>" * 3 + "<div class=ad></div>" * 3 + teaser,
                        f"{PARAGRAPH.strip()}\n{end}"),
                       (f"<div>Home</div><main><p>Head</p><p>{PARAGRAPH}</p><p>{end}</p></main><div>Foot</div>",
                        f"Head\n{PARAGRAPH.strip()}\n{end}")]:
        assert main_text.main_text(body) == want


@pytest.mark.parametrize("page, want", [
    *((f"<h1>Title</h1><div {name}><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><p>End.</p></div><p>Home</p>", ["End."])
      for name in ("class=elementor-widget", "id=discussion-article", "class='popular rail'", "class=legal")),
    ("<h1>Title</h1>" + f"<div class=elementor-widget><p>{PARAGRAPH}</p></div>" * 4, []),
    (f"<p>{PARAGRAPH[:120]}</p><div class=widget><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><div class=ad>Buy</div></div>", []),
])
def test_an_article_is_not_lost_to_names(page, want):
    lines = main_text.main_text(page).split("\n")
    assert lines.count(PARAGRAPH.strip()) == page.count(f">{PARAGRAPH}<") and set(want) <= set(lines) and "Buy" not in lines


def test_long_comments_and_small_boxes_still_go_by_name():
    comments = f"<div class=comments><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>"
    assert main_text.main_text(f"<p>{PARAGRAPH}</p>{comments}") == PARAGRAPH.strip()
    box = "<div class=widget><p>Some text in a box beside the article, of no use at all.</p></div>"
    assert main_text.main_text(f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>{box}") == "\n".join([PARAGRAPH.strip()] * 2)


def test_a_mark_must_hold_most_of_the_text():
    own, card = PARAGRAPH.strip(), "<article class=card><p>A teaser of a few words only.</p></article>"
    body = f"<p>{PARAGRAPH}</p>" * 3
    for page in (f"<main>{body}{card}</main>", f"<div class=content>{body}</div>" + card * 2,
                 f"<div class=content>{body}</div><article><p>{PARAGRAPH}</p></article>"):
        assert main_text.main_text(page).split("\n").count(own) == page.count(PARAGRAPH)
    assert main_text.main_text(f"<main><p>{PARAGRAPH}</p><article>{body}</article></main>") == "\n".join([own] * 3)
    assert main_text.main_text("<p>Menu</p><article><p>Short but most.</p></article>") == "Short but most."


def test_main_text_takes_hostile_markup():
    for page in ["<a " * 30_000, '<a "' * 30_000, "<div>" * 50_000, "<!--" * 9_000, "a<" * 50_000, "<p x='" * 20_000,
                 "<b>" * 9_000 + "</b>" * 9_000, "<div>" * 3_000 + f"<p>{PARAGRAPH}</p>" * 300, "<p>word word</p>" * 60_000]:
        assert isinstance(main_text.main_text(page), str)


def test_main_text_of_real_pages(spark):
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = main_text.extract(pages.selectExpr("*", "'old' as text", "2 as `p.q`"))
    assert out.columns == ["page_id", "url", "html", "p.q", "text", "n_chars"]
    for r in out.collect():
        body = r.html[r.html.index("<article>") + 9:].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
    assert main_text.extract(pages.limit(0)).count() == 0
