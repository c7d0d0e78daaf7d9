"""Malformed and unusual markup; rows that share an id; whole documents against brute force."""

import random
import time

import pytest
from pyspark.sql import functions as F

from dimforge.llm import html_extraction, quality_classifier, simhash, substring_dedup, suffix_dedup
from dimforge.llm import _anchors
from tests.llm import brute
from tests.llm.conftest import SCHEMA, row

SF = "/root/testdata/sf0.001"
N = 1_000_000


# -- markup -----------------------------------------------------------------------
@pytest.mark.parametrize("page", [
    "<a " * (N // 3), '<a "' * (N // 4), "<b>" * (N // 8) + "</x>" * (N // 8), "<b>" * (N // 12) + "<p></p>" * (N // 12),
    '<a ">" ' * (N // 7) + "'", '<a ">" ' * (N // 7) + "'>", "<a '\">\"' " * (N // 10) + '"', "<script>" + "</script " * (N // 9),
    "<script></script x" * (N // 18), "<b><td>" + "<i>" * (N // 8) + "</b>" * (N // 8), "<!-" * (N // 3), "<!--" * (N // 4), "<" * N,
    "&#" + "9" * N + ";", "&#x" * (N // 3), "&" * N, "<a " + 'x="' * (N // 3) + ">", "<a class" + " " * N + ">", "<li>" * (N // 4),
    "<div>" * (N // 5), "<article>" * (N // 9) + "</p>" * (N // 8), '<p style="' + "display " * (N // 8) + '">x'],
    ids=lambda p: p[:12])
def test_malformed_pages_take_linear_time(page):
    began = time.process_time()
    html_extraction.ordered_blocks(page)
    assert time.process_time() - began < 12  # a quadratic scan of these takes minutes


def test_growth_is_linear():
    def took(n):
        page = "<b>" * n + "</x>" * n
        began = time.process_time()
        html_extraction.ordered_blocks(page)
        return time.process_time() - began
    took(1000)
    assert took(80_000) < 24 * took(10_000) + 0.5


def inside(page):
    found = html_extraction.ordered_blocks(page)
    return [t for m, t in found if m]


def test_article_text_is_not_lost_to_words():
    page = ('<article><h1 id="search">Search</h1><h2 id="related-work" class="menu">Related work</h2><p class="share-price">It rose.</p>'
            '<p id="notice">Text.</p><div id="intro"><p>More.</p></div><div id="comment-list"><p>gone</p></div><table><tr><td id="search">Cell</td></tr></table><label>Fig. 1</label> <math><mi>x</mi></math>'
            '<ul class="menu"><li>gone</li></ul><p class="advert">gone</p><div class="social-links">gone</div><form><label>gone</label></form>'
            '<aside>gone</aside><section class="reader comments"><p>gone</p></section></article>')
    assert inside(page) == ["Search", "Related work", "It rose.", "Text.", "More.", "Cell", "Fig. 1 x"]


def test_articles_are_judged():
    page = '<div class="content"><p>The text of the page.</p></div><article class="comment"><p>Nice.</p></article>'
    assert html_extraction.ordered_blocks(page) == [(False, "The text of the page.")]
    assert inside('<main class="no-sidebar"><p>a</p></main><article hidden>b</article><div role="main">c</div>') == ["a", "c"]
    # a teaser is not the page
    long = "word " * 100
    assert not html_extraction.is_marked(html_extraction.ordered_blocks(f"<article>Read on</article><div><p>{long}</p></div>"))
    assert html_extraction.is_marked(html_extraction.ordered_blocks(f"<article>{long}</article><div><p>Read on</p></div>"))


def test_teaser_pages_go_to_the_host_step(spark):
    boiler = " ".join(f"menu{k}" for k in range(20))
    rows = [(i, "http://h.org/1", f"<article>Teaser {i}</article><p>{boiler}</p><p>{' '.join(f'own{i}x{k}' for k in range(60))}</p>") for i in range(4)]
    got = {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Teaser {i}\n" + " ".join(f"own{i}x{k}" for k in range(60)) for i in range(4)}


def test_references_and_quotes():
    assert html_extraction.blocks("<p>&#65;&#0000000000065;&#x41;&#99999999999;&amp;lt;</p>")[1] == ["AAA�&lt;"]
    assert html_extraction.blocks('<p title="a>b">x</p><img alt=\'>\'>y<!-->z--><!--->w')[1] == ["x", "yz-->w"]
    assert html_extraction.blocks("<xmp><p>raw")[1] == [] and html_extraction.blocks("t<noframes>raw")[1] == ["t"]
    assert html_extraction.blocks("a < b <c <p>d")[1]


# -- rows that share an id ------------------------------------------------------------
def texts(seed=11):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    return [" ".join(word() for _ in range(90)) for _ in range(8)]


def versions_expected(docs, units, length):
    """Covered symbols per row, where rows of one id do not precede each other at equal starts."""
    out = []
    for d, u in zip(docs, units):
        cov = [False] * len(u)
        for p in range(len(u) - length + 1):
            k = u[p:p + length]
            if any(v[q:q + length] == k for e, v in zip(docs, units) for q in range(len(v) - length + 1) if (e, q) < (d, p)):
                cov[p:p + length] = [True] * length
        out.append(sum(cov))
    return out


@pytest.mark.parametrize("operator,length,cut", [(suffix_dedup, 100, lambda t: t.encode()), (substring_dedup, 20, lambda t: t.split())])
def test_versions_of_an_id(spark, operator, length, cut):
    """Two texts of one id that hold the same earlier passage lose it alike."""
    a, b, c, d, *_ = texts()
    shared = a[:200]
    rows = [(1, shared + " " + b[:150]), (5, c[:120] + " " + shared + " " + d[:100]), (5, c[:120] + " " + shared + " end of it all"),
            (6, shared[10:] + " tail"), (6, shared[10:] + " tail"), (None, d)]
    docs = spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA).repartition(2)
    got = {(r.row.doc_id, r.row.text): r.n_removed for r in operator.remove_repeats(docs).collect()}
    distinct = sorted({(-1 if i is None else i, t) for i, t in rows})
    want = versions_expected([i for i, _ in distinct], [cut(t) for _, t in distinct], length)
    assert got == {(None if i == -1 else i, t): n for (i, t), n in zip(distinct, want)}
    assert got[rows[1]] > 0 and got[rows[2]] > 0


def test_keep_one_row_per_component(spark):
    """An id loses the text that repeats another, and only that; of identical rows one stays."""
    a, b, c, d, e, *_ = texts()
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (4, d), (None, d), (None, e), (None, e), (7, None), (8, "")]
    docs = spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA).repartition(3)
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (2, b), (3, c), (4, d), (None, e), (7, None)], key=str)
    # rows of one id in one component that differ in another column: one of them
    two = spark.createDataFrame([row(1, a, 1), row(1, a, 2), row(2, a, 3)], SCHEMA)
    assert [r.doc_id for r in simhash.keep_one(two).collect()] == [1]


def test_classifier_sample_is_bounded_in_rows(spark):
    """Many rows under graded ids: at most max_rows reach the fit, the same ones each time."""
    good, bad = "the of and to in a is that " * 5, "%% ## $$ ** " * 10
    docs = spark.createDataFrame([(i % 4, (good if i % 2 else bad) + f" n{i}") for i in range(400)], "doc_id long, text string").repartition(5)
    grades = spark.createDataFrame([(i, i % 2 * 2) for i in range(4)], "doc_id long, grade int")
    seen = []
    real = quality_classifier.fit
    try:
        quality_classifier.fit = lambda rows, *a, **k: (seen.append(int(rows.max()) + 1), real(rows, *a, **k))[1]
        one = quality_classifier.train(docs, grades, max_rows=50, steps=5)
        two = quality_classifier.train(docs.repartition(2), grades, max_rows=50, steps=5)
    finally:
        quality_classifier.fit = real
    assert seen == [50, 50] and (one.weights == two.weights).all()


# -- whole documents --------------------------------------------------------------------
def test_suffix_array_on_whole_documents(spark):
    """Every text of the small table, long ones included, by a dictionary of all windows."""
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    seen, want = set(), {}
    for i, t in rows:
        cov = bytearray(len(t))
        for p in range(len(t) - 99):
            k = t[p:p + 100]
            if k in seen:
                cov[p:p + 100] = b"\1" * 100
            else:
                seen.add(k)
        kept = bytes(b for b, x in zip(t, cov) if not x)
        want[i] = (len(t), sum(cov), sum(1 for k in range(len(cov)) if cov[k] and not (k and cov[k - 1])), brute.sha256(kept))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op5_suffix_array_dedup(spark, SF).collect()}
    assert got == want


def test_segments_cover_every_window():
    """Each window of each text lies in one segment, whose anchor depends on the window only."""
    r = random.Random(5)
    unit = _anchors.Unit(30, 8, words=False)
    batch = [bytes(r.choice(b"abc") for _ in range(n)) for n in (0, 29, 30, 31, 500, 70_000, 64, 200)]
    text, h, start, count, offset, digest = unit.segments(batch, digests=True)
    anchors = {}
    for k in range(len(batch)):
        own = [(s, c, o, int(x)) for s, c, o, x in zip(start[text == k].tolist(), count[text == k].tolist(), offset[text == k].tolist(), h[text == k])]
        assert [p for s, c, _, _ in own for p in range(s, s + c)] == list(range(max(0, len(batch[k]) - 29)))
        for s, c, o, x in own:
            for p in range(s, s + c):
                assert anchors.setdefault(batch[k][p:p + 30], (s + o - p, x)) == (s + o - p, x)
    by = {}
    for k, s, c, d in zip(text.tolist(), start.tolist(), count.tolist(), digest.tolist()):
        by.setdefault(d, set()).add(batch[k][s:s + c + 29])
    assert all(len(v) == 1 for v in by.values())
