"""Operators on single documents and pages, and those with models."""

import math
from collections import Counter

import numpy as np
import pytest

from dimforge.llm import bpe, decontamination, html_extraction, lm_scoring, quality_classifier, quality_rules, url_reputation
from tests.llm import brute
from tests.llm.conftest import SCHEMA

SF = "/root/testdata/sf0.001"


# -- quality rules -----------------------------------------------------------
def test_quality_metrics(spark, edge_docs, edge_rows, odd_docs, no_docs):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in quality_rules.measure(edge_docs).collect()}
    assert got == {i: brute.quality(t) for i, t in edge_rows}
    assert quality_rules.measure(odd_docs).count() == odd_docs.count()
    assert quality_rules.measure(no_docs).collect() == []


def test_quality_keeps_rows_and_columns(spark, edge_docs):
    kept = quality_rules.keep_clean(edge_docs)
    assert kept.columns == edge_docs.columns and kept.schema == edge_docs.schema
    want = {r.doc_id for r in quality_rules.measure(edge_docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want and want
    assert kept.filter("text is null").count() == 0


# -- BPE -----------------------------------------------------------------------
@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(str(bpe.tokenizer_path()))


def test_bpe_round_trip(spark, edge_docs, edge_rows, odd_docs, no_docs, tokenizer, tables):
    more = ["Ünïcode ﬁne ΣΑΣ İstanbul", "don't we'll I'm", "a<|endoftext|>b <|startoftext|>", "\x1d\x85\u2028x\u00a0y", "12345 ½ 三", "😀😀!!"]
    rows = [*edge_rows, *[(100 + i, t) for i, t in enumerate(more)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = bpe.encode(docs, bpe.tokenizer_path())
    exp = {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    assert {r.doc_id: r.ids for r in got.collect()} == exp
    text = {i: tokenizer.decode(x, skip_special_tokens=False) for i, x in exp.items()}
    assert {r.doc_id: r.decoded for r in got.collect()} == text
    assert {r.doc_id: r.decoded for r in bpe.decode(got, bpe.tokenizer_path()).collect()} == text
    q = bpe.op8_bpe(spark, tables(documents=docs)).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in q} == \
        {i: (len(x), brute.ids_sha256(x), brute.sha256(text[i])) for i, x in exp.items()}
    assert bpe.encode(odd_docs, bpe.tokenizer_path()).count() == odd_docs.count()
    assert bpe.encode(no_docs, bpe.tokenizer_path()).collect() == []


def test_bpe_small_tables(tokenizer, monkeypatch):
    """Clearing the word and pair tables changes nothing."""
    monkeypatch.setattr(bpe, "MAX_WORDS", 30)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 20)
    coder = bpe.Coder(bpe.WordBpe(bpe.tokenizer_path()))
    texts = ["the tokenization of unbelievable antidisestablishmentarianism words " + str(i) * i for i in range(40)]
    for t, (ids, _) in zip(texts, coder.code(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


# -- benchmark decontamination ----------------------------------------------------
ITEM = "Anna has 12 apples and gives 5 apples to Bob every day so how many apples does she keep after 3 days of this trade"


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, ITEM), (2, "too short"), (3, None), (4, "the quick brown fox jumps"), (None, "no id " * 10), (1, ITEM)]
    return spark.createDataFrame([(i, t, "k") for i, t in items], "item_id long, text string, key string")


def test_decontamination(spark, benchmark, odd_docs, no_docs):
    other = ITEM.replace("Bob", "Carol").replace("12", "97")
    broken = "so Anna has 12 apples and gives 5 apples to Anna every day so how many apples does she keep after 12 days of this trade"
    # two different numbers of the item become one: 12 -> 12, 5 -> 12
    merged = ITEM.replace("gives 5", "gives 12")
    docs = [(1, f"Intro text here. {ITEM} And more."), (2, other), (3, "Nothing to see in this text at all, it is clean and long enough."),
            (4, "we saw the quick brown fox jumps over it"), (5, None), (6, ""), (7, merged), (8, ITEM.upper()), (None, ITEM)]
    df = spark.createDataFrame([(i, t, *[None] * 3, *["z"] * 19) for i, t in docs], SCHEMA)
    got = {(r.doc_id, r.item_id): r for r in decontamination.find(df, benchmark).collect()}
    assert {(1, 1), (2, 1), (4, 4)} <= set(got)
    assert not {d for d, _ in got} & {3, 5, 6, 7, None}
    assert got[1, 1].changed == 0 and got[2, 1].changed >= 1
    clean = decontamination.clean(df, benchmark)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in docs} - {d for d, _ in got}
    assert decontamination.find(no_docs, benchmark).collect() == []
    assert decontamination.find(df, benchmark.limit(0)).collect() == []
    assert decontamination.clean(odd_docs, benchmark).count() == odd_docs.count()
    del broken


DENSE = ["Compute 12 + 7 - 3 * 4 / 2 = 20", "THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG AND RUNS FAR AWAY", "What is 12 + 7?",
         "The Old Man And The Sea Was Written By Ernest Hemingway", "Mitochondria", "Who wrote Hamlet?", "2 km 3 km 5 km 7 km 11 km 13 km"]


def test_decontamination_few_literals(spark):
    """Number-dense, all-caps, title-case and short items are found in verbatim copies, and only there."""
    bench = spark.createDataFrame(list(enumerate(DENSE)), "item_id long, text string")
    docs = [(i, f"We read here: {t} And then it goes on.") for i, t in enumerate(DENSE)]
    docs += [(10 + i, f"we read here {t.lower()} and then") for i, t in enumerate(DENSE)]
    docs += [(20, "Compute 13 + 8 - 4 * 5 / 3 = 21"), (21, "What is 13 + 8?"), (22, "A SLOW GREEN CAT JUMPS UNDER SOME OTHER DOG BUT STAYS"),
             (23, "2 km 3 km 5 km 8 km 12 km 14 km"), (24, "Who wrote Macbeth?")]
    df = spark.createDataFrame([(i, t, *[None] * 3, *["z"] * 19) for i, t in docs], SCHEMA)
    got = {(r.doc_id, r.item_id): r for r in decontamination.find(df, bench).collect()}
    assert set(got) == {(d + i, i) for i in range(len(DENSE)) for d in (0, 10)}
    assert all(r.changed == 0 and r.n_matched >= min(r.n_windows, decontamination.MIN_WINDOWS) for r in got.values())
    assert {r.doc_id for r in decontamination.clean(df, bench).collect()} == {20, 21, 22, 23, 24}


def test_decontamination_template_beside_dense(spark):
    """An item with template windows and dense ones: found re-parameterised, and by its dense part alone."""
    item = "please add up all of the numbers here now 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15"
    other = item.replace("15", "99").replace(" 2 ", " 77 ")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item), (2, other), (3, "so 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 end"), (4, "1 2 3 5 8 13 21 34 55 89 144 233 377")],
                                 "doc_id long, text string")
    assert {r.doc_id: r.changed for r in decontamination.find(docs, bench).collect()} == {1: 0, 2: 1, 3: 0}


# -- URL reputation -----------------------------------------------------------------
def test_url_rules_and_reputation(spark):
    urls = [None, "", "no scheme", "http://Example.COM/en/x?q#f", "https://www.example.com/en/1", "https://a.example.com/de/",
            "http://shop.net/es/", "http://net/fr/a", "http://x.net/en", "http://example.com", "ftp://bad.org/a", "a://b://c/d"]
    pages = [(i, u, "<p>", "h") for i, u in enumerate(urls)] + [(None, "http://bad.org/z", None, "h")]
    pages += [(100 + k, f"http://bad.org/{k}", None, "h") for k in range(200)] + [(400 + k, f"http://good.org/{k}", None, "h") for k in range(200)]
    labels = [(100 + k, 0, 0) for k in range(150)] + [(400 + k, 1, 0) for k in range(150)] + [(None, 0, 0), (101, None, 1), (102, 1, 1)]
    p = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_reputation.judge(p, lab).collect()}
    assert (got[0].host, got[0].path, got[0].rule) == ("", "", None) and got[2].host == ""
    assert (got[3].host, got[3].path, got[3].rule, got[3].verdict) == ("example.com", "/en/x", "example.com/en/", "block")
    assert (got[4].rule, got[4].verdict) == ("www.example.com/en/", "allow")
    assert got[5].rule == "com/" and got[6].rule == "net/es/" and got[7].rule == "net/fr/"
    assert got[8].rule is None and got[9].rule is None and got[9].path == ""
    assert got[10].verdict == got[None].verdict == got[199].verdict == "block" and got[450].verdict == "allow"
    assert url_reputation.judge(p.limit(0), lab).collect() == []
    assert {r.verdict for r in url_reputation.judge(p, lab.limit(0)).collect() if r.rule is None} == {"allow"}
    assert url_reputation.judge(p, lab).count() == len(pages)


def test_url_suffixes(spark):
    hosts = {"a.co.uk": ("a.co.uk", "co.uk"), "www.b.com.au:8080": ("b.com.au", "com.au"), "co.uk": ("co.uk", "co.uk"),
             "x.example.com:8080": ("example.com", "com"), "example.com": ("example.com", "com"), "localhost:80": ("localhost", "localhost")}
    urls = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(hosts)], "page_id long, url string")
    got = {r.host: (r.domain, r.suffix) for r in url_reputation.split_url(urls).collect()}
    assert got == hosts


# -- HTML ------------------------------------------------------------------------------
MARKED = ('<html><body class="has-sidebar"><header>H</header><nav><ul><li>m</ul></nav><div class="ad">buy</div>'
          '<article><h1>T &eacute;&nbsp; &amp; a</h1><div id="cookie-notice">no</div><p>a<b>b</b> c<p>d<br>e<form>f<input></form>'
          '<section class="comments"><p>c</p></section><ul><li>x<li>y</ul><script>if(a<b)"</p>"</script><!-- x --></article><footer>z')


def test_html_marked():
    assert html_extraction.blocks(MARKED) == (["T é & a", "ab c", "d e", "x", "y"], [])
    assert html_extraction.blocks(None) == html_extraction.blocks("") == ([], [])
    assert html_extraction.blocks("<p>plain <i>x</i></p><p class=ad>z</p>t")[1] == ["plain x", "t"]
    assert html_extraction.blocks("a < b <c <p>d")[1]


def test_html_repeats(spark):
    boiler = " ".join(f"menu{k}" for k in range(20))
    pages = [(i, "http://h.org/1", f"<div><p>{boiler}</p><p>p{i} has its own words {i} and more of them {i}</p></div>") for i in range(5)]
    pages += [(10, "http://other.org/", f"<p>{boiler}</p>"), (None, "http://h.org/1", f"<p>{boiler} tail</p>"), (11, None, None),
              (12, "http://h.org/2", "<article></article>"), (13, "http://h.org/3", MARKED), (13, "http://h.org/3", MARKED),
              (14, "http://solo.org/", "<p>" + "word " * 40), (14, "http://solo.org/", "<p>" + "word " * 40)]
    df = spark.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, html string, text string")
    out = html_extraction.extract(df).collect()
    got = {r.page_id: r for r in out}
    assert len(out) == len(pages)
    assert all(got[i].text == f"p{i} has its own words {i} and more of them {i}" for i in range(5))
    assert got[10].text == boiler and got[None].text == "tail" and got[11].text == got[12].text == ""
    assert got[13].text == "T é & a\nab c\nd e\nx\ny" and got[13].n_chars == len(got[13].text)
    assert got[14].text == " ".join(["word"] * 40)
    assert html_extraction.extract(df.limit(0)).collect() == []


# -- LM scoring ------------------------------------------------------------------------
def _lm_brute(rows, good, size, cells, mu):
    toks = [(i, (t or "").translate(brute.LOW).encode().split()) for i, t in rows]
    c = Counter(w for _, x in toks for w in x)
    voc = {w: k for k, (w, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:size], 1)}
    n = len(voc) + 1

    def cell(a, b):
        x = (a << 32) | b
        x = ((x ^ (x >> 29)) * 0x9E3779B97F4A7C15) % 2**64
        return (x ^ (x >> 32)) % cells

    def model(pick):
        u, ctx, big = Counter(), Counter(), Counter()
        for i, x in toks:
            if pick(i):
                p = n
                for w in x:
                    k = voc.get(w, 0)
                    u[k] += 1
                    ctx[p] += 1
                    big[cell(p, k)] += 1
                    p = k
        total = sum(u.values())
        return lambda p, k: -math.log((big[cell(p, k)] + mu * (u[k] + 1) / (total + n)) / (ctx[p] + mu))

    t, b = model(lambda i: i in good), model(lambda i: True)
    out = {}
    for i, x in toks:
        p, s = n, 0.0
        for w in x:
            k = voc.get(w, 0)
            s += t(p, k) - b(p, k)
            p = k
        out[i] = (len(x), s / max(1, len(x)))
    return out


def test_lm_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 and toxic = 0").collect()}
    exp = _lm_brute(rows, good, None, 2**64, lm_scoring.MU)
    for r in lm_scoring.op1_lm_scoring(spark, SF).collect():
        assert r.n_tokens == exp[r.doc_id][0] and abs(r.score - exp[r.doc_id][1]) < 1e-9


@pytest.mark.parametrize("chunk,bucket,fan_in", [(lm_scoring.CHUNK, lm_scoring.BUCKET, lm_scoring.FAN_IN), (40, 1 << 9, 512), (40, 1 << 12, 4)])
def test_lm_counts_every_word_and_bigram(spark, edge_docs, edge_rows, no_docs, odd_docs, chunk, bucket, fan_in):
    """More words than 65,536 and more bigrams than 2^20: each has its own count, whatever the chunks and levels."""
    rows = [*edge_rows, *[(1000 + i, " ".join(f"w{i}x{k} w{k}" for k in range(1200))) for i in range(60 if chunk > 40 else 2)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(6, 1, 0), (9, 1, 0), (1001, 1, 0), (12, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    exp = _lm_brute(rows, {6, 9, 1001}, None, 2**64, lm_scoring.MU)
    got = lm_scoring.cross_entropy_difference(docs, labels, chunk=chunk, bucket=bucket, fan_in=fan_in).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    for r in got:
        assert r.n_tokens == exp[r.doc_id][0] and abs(r.score - exp[r.doc_id][1]) < 1e-9
    assert lm_scoring.cross_entropy_difference(no_docs, labels).collect() == []
    assert lm_scoring.cross_entropy_difference(odd_docs, labels.limit(0)).count() == odd_docs.count()


# -- quality classifier ----------------------------------------------------------------
def test_classifier_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    grades = quality_classifier.grades_of(spark.read.parquet(f"{d}/labels.parquet"))
    model = quality_classifier.train(docs, grades.filter("doc_id % 5 <> 0"), max_rows=2500, steps=300)
    assert np.all(np.diff(model.thetas) >= 0)
    held = quality_classifier.classify(docs, model).join(grades.filter("doc_id % 5 = 0"), "doc_id").toPandas()
    kept = held.groupby("grade").kept.mean()
    assert kept[2] > 0.97 and kept[0] < 0.3
    mean = held.groupby("grade").expected_grade.mean()
    assert mean[0] < mean[1] < mean[2]


def test_classifier_edges(spark, edge_docs, odd_docs, no_docs):
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (9, 1, 1), (10, 1, 0), (12, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    g = {r.doc_id: r.grade for r in quality_classifier.grades_of(labels).collect()}
    assert g == {6: 0, 9: 1, 10: 2}
    model = quality_classifier.train(edge_docs, quality_classifier.grades_of(labels), buckets=1 << 12, steps=20)
    assert quality_classifier.classify(edge_docs, model).count() == edge_docs.count()
    assert quality_classifier.classify(odd_docs, model).count() == odd_docs.count()
    assert quality_classifier.classify(no_docs, model).collect() == []
    none = quality_classifier.train(edge_docs, quality_classifier.grades_of(labels.limit(0)), buckets=64)
    probs = quality_classifier.classify(edge_docs, none).select("tail_probability").distinct().collect()
    assert len(probs) == 1 and abs(probs[0][0] - 1 / 3) < 1e-9


def test_fit_gradient():
    """The fit lowers the penalised loss to where small changes do not help."""
    r = np.random.default_rng(0)
    rows, at = np.repeat(np.arange(60), 3), r.integers(0, 8, 180)
    value, grade = r.random(180), r.integers(0, 3, 60)
    m = quality_classifier.fit(rows, at, value, grade, buckets=8, steps=3000, l1=1e-3)

    def loss(w, t):
        s = np.bincount(rows, value * w[at], minlength=60)
        e = np.hstack([np.zeros((60, 1)), 1 / (1 + np.exp(-(t[None] - s[:, None]))), np.ones((60, 1))])
        return -np.log(e[np.arange(60), grade + 1] - e[np.arange(60), grade]).mean() + 1e-3 * np.abs(w).sum()

    best = loss(m.weights, m.thetas)
    for k in range(8):
        for d in (-0.05, 0.05):
            w = m.weights.copy()
            w[k] += d
            assert loss(w, m.thetas) >= best - 1e-6


# -- edits and evidence -----------------------------------------------------------------
EDITED = "A shop sold 48 clips to Bob and then it sold half as many in May"


def test_decontamination_edits(spark):
    """One inserted or dropped word does not hide an item of sixteen words."""
    bench = spark.createDataFrame([(1, EDITED), (2, EDITED + " and she kept the other half for herself in Rome")], "item_id long, text string")
    w = EDITED.split()
    docs = [(0, EDITED)] + [(10 + k, " ".join([*w[:k], "really", *w[k:]])) for k in range(len(w) + 1)]
    docs += [(100 + k, " ".join(w[:k] + w[k + 1:])) for k in (0, 1, 2, 3, len(w) - 1)] + [(300, " ".join(w[:8] + ["but", "nothing", "else"])),
             (301, "we saw " + " ".join(w[8:]) + " and so it goes"), (302, "no word of it here or anywhere else in this text at all")]
    got = {(r.doc_id, r.item_id): r for r in decontamination.find(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert {d for d, i in got if i == 1} == {d for d, _ in docs if d < 300}
    whole = got[0, 1]
    assert whole.n_matched == whole.n_windows == 9 and got[18, 1].n_matched == 2 and got[15, 1].n_matched == 4
    # a name of another length, in an item with windows on both sides
    other = bench.filter("item_id = 2").first().text.replace("Bob", "Mary Ann")
    named = {r.item_id: r.n_matched for r in decontamination.find(spark.createDataFrame([(1, other)], "doc_id long, text string"), bench).collect()}
    assert set(named) == {1, 2} and 2 <= named[1] < 5 <= named[2]
    # alignments far apart do not count together
    far = " ".join(w[:8]) + " x y z" * 5 + " " + " ".join(w[8:])
    assert decontamination.find(spark.createDataFrame([(1, far)], "doc_id long, text string"), bench).collect() == []


def test_url_evidence(spark):
    """The counts and the bound behind a verdict."""
    pages = [(k, f"http://bad.org/{k}") for k in range(60)] + [(100 + k, f"http://good.org/{k}") for k in range(60)] + [(500, "http://new.org/")]
    labels = [(k, 0, 0) for k in range(40)] + [(100 + k, 1, 0) for k in range(50)]
    got = {r.page_id: r for r in url_reputation.judge(spark.createDataFrame(pages, "page_id long, url string"),
                                                      spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert (got[0].n, got[0].k, got[0].verdict) == (40, 40, "block") and (got[100].n, got[100].k, got[100].verdict) == (50, 0, "allow")
    assert (got[500].n, got[500].k, got[500].verdict) == (0, 0, "allow")
    assert got[0].lower > 0.5 > max(got[500].lower, got[100].lower)
