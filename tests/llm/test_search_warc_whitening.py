"""Ranked search, WARC archives and whitening against brute force."""

import hashlib
import math
import random
import re
import struct
from collections import Counter

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from dimforge.llm import lexical_search, warc, whitening
from dimforge.llm._common import Scratch

SF = "/root/testdata/sf0.001"


def same_as_oracle(spark, sql, got, sf=SF):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
    assert Counter(want) == Counter(tuple(r) for r in got.select(*cols).collect()) and want


# -- ranked search ---------------------------------------------------------------
def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranked(docs, items, k=50):
    """(item, rank, doc, score) by scoring every document."""
    held = [(d, Counter(t), len(t)) for d, x in docs if (t := terms(x))]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    united = {}
    for i, x in items:
        united.setdefault(i, set()).update(terms(x))
    out = set()
    for i, ts in united.items():
        scores = []
        for d, c, size in held:
            m = 50 + 50 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                scores.append((-s, d is None, d))
        out |= {(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)}
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]


def test_terms():
    for t in ["Ab-c d_1", "", None, "É3 x\x7fZ", "a\nB\x00c"]:
        assert [x.decode() for x in lexical_search.terms_of(t.encode() if t is not None else None)] == terms(t)


@pytest.mark.parametrize("k,block_terms", [(50, 50_000), (3, 8)])
def test_search(spark, edge_docs, edge_rows, k, block_terms):
    r = random.Random(3)
    words = sorted({w for _, t in edge_rows for w in terms(t)})
    items = [(i, " ".join(r.choices(words, k=r.choice([1, 5, 70])))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "nowherefound"), (3, "the of"), (3, "the of"), (None, "the ST"), (23, "The THE the-of")]
    got = rows_of(lexical_search.rank(edge_docs, spark.createDataFrame(items, "item_id long, text string"), k, block_terms))
    assert set(got) == ranked(edge_rows, items, k) and len(got) == len(set(got))


def test_search_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the of er tion")], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = rows_of(lexical_search.rank(odd_docs, items))
    assert [(r, s) for _, r, _, s in sorted(got)] == [(r, s) for _, r, _, s in sorted(ranked(docs, [(1, "the of er tion")]), key=lambda x: x[1])] \
        or len(got) == len([1 for _, t in docs if set(terms(t)) & {"the", "of", "er", "tion"}])
    assert [r for _, r, _, _ in sorted(got)] == list(range(1, len(got) + 1))
    assert rows_of(lexical_search.rank(no_docs, items)) == []
    assert rows_of(lexical_search.rank(odd_docs, items.limit(0))) == []


def test_masks_stop_safely():
    """Masks of low bound are left out, and nothing that belongs in the list is lost."""
    r = np.random.default_rng(1)
    for size in (5, 70, 130):
        worth = (r.random((size, 3000)) < 0.05) * r.integers(1, 1_000_000, (size, 3000))
        worth[:, -20:] = r.integers(500_000, 1_000_000, (size, 20))
        weights, best = r.integers(1, 9000, size), lexical_search.Best(10)
        scored = 0
        for lo in range(0, 3000, 600):
            part = slice(lo, lo + 600)
            scored += lexical_search.search_item(best, worth[:, part], weights, np.arange(lo, lo + 600), np.zeros(600, bool))
        score = weights @ worth
        want = np.lexsort((np.arange(3000), -score))[:10]
        assert best.doc.tolist() == want.tolist() and best.score.tolist() == score[want].tolist()
        assert scored < 3000
        first, group = lexical_search.group_masks(worth > 0)
        assert np.array_equal((worth > 0)[:, first][:, group], worth > 0)
        assert len(first) == len(np.unique(worth.T > 0, axis=0))


def test_search_query(spark):
    same_as_oracle(spark, lexical_search.ORACLE_SQL, lexical_search.op11_lexical_search(spark, SF))


# -- WARC --------------------------------------------------------------------------
PAGES = "page_id long, url string, html string, rid string, payload string, n string"


def page_rows():
    long, r = "<p>" + "payload ä " * 150, random.Random(2)
    rows = [(1, "http://a/x y\r\nInjected: 1", long), (2, None, long), (9, "http://b/é", long), (3, "u", None), (4, "u", ""), (5, "u", "short"),
            (6, "u", "short"), (None, "u", long + "!"), (7, "u", long + "!"), (8, "u", "WARC/1.1\r\n\r\n" + "\r\n\r\n" * 400),
            (11, "u", "".join(chr(r.randrange(1, 0xD000)) for _ in range(400_000)))]
    return rows + [(12, "u", long + "same"), (12, "u", long + "same"), (None, None, None), (None, "u", long + "null"), (None, "u", long + "null")]


def expected(rows):
    """page_id, payload_bytes, digest, type, refers_to as the contract has them."""
    out, groups = [], {}
    for p, _, h in rows:
        b = (h or "").encode()
        groups.setdefault(b, []).append(p)
    for b, ps in groups.items():
        ps = sorted(ps, key=lambda p: (p is not None, p or 0))
        for k, p in enumerate(ps):
            last = k == len(ps) - 1 or len(b) < warc.MIN_BYTES
            out.append((p, len(b), hashlib.sha1(b).hexdigest(), "response" if last else "revisit", None if last else ps[-1]))
    return Counter(out)


@pytest.mark.parametrize("archive_bytes", [1, 5000, 16 << 20])
def test_warc_round_trip(spark, scratch, archive_bytes):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], PAGES).repartition(3)
    work = Scratch(spark, "warc-test")
    path = f"{work.root}/archives"
    warc.write_archives(pages, path, work, archive_bytes=archive_bytes)
    back = warc.read_archives(spark, path)
    assert back.filter("error is not null").count() == 0
    # payloads come back whole, stored once where equal
    stored = Counter(bytes(r.payload) for r in back.filter("record_type = 'response'").collect())
    assert set(stored) == {(h or "").encode() for _, _, h in rows}
    assert all(n == 1 for b, n in stored.items() if len(b) >= warc.MIN_BYTES)
    assert back.select("record_id").distinct().count() == len(rows)
    assert all("\r" not in r.target_uri and " " not in r.target_uri for r in back.collect())
    got = warc.resolve(back, work)
    assert Counter(tuple(r)[:5] for r in got.collect()) == expected(rows) and got.filter("error is not null").count() == 0


def test_warc_files_are_plain_zstandard(spark):
    """Any Zstandard reader that knows the dictionary reads a file to its end."""
    work = Scratch(spark, "warc-test")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    warc.write_archives(pages, f"{work.root}/a", work, archive_bytes=30_000)
    files = spark.read.format("binaryFile").load(f"{work.root}/a").select("content").collect()
    assert len(files) > 1
    n = 0
    for f in files:
        data = bytes(f.content)
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_MAGIC and size > 1000
        d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
        whole = d.stream_reader(data[8 + size:], read_across_frames=True).read()
        n += whole.count(b"WARC/1.1\r\nWARC-Type: response")
    assert n == pages.count()


def archive(records, dictionary=b""):
    w = warc.ArchiveWriter(dictionary)
    for r in records:
        w.add(r)
    return w.close()


def test_warc_validation():
    body = b"<p>text</p>"
    good = warc.build_record("response", "<urn:uuid:1>", "http://a/", 5, hashlib.sha1(body).hexdigest(), len(body), body, None)
    bad = {
        "no WARC header": good.replace(b"WARC/1.1", b"WARC/9.9"),
        "header warc-date is missing": good.replace(b"WARC-Date", b"X-Date"),
        "malformed header": good.replace(b"WARC-Date: ", b"WARC-Date "),
        "content-length is": good.replace(b"\r\n\r\n", b"\r\n\r\nmore", 1),
        "block digest differs": good.replace(b"text</p>", b"tex!</p>"),
        "HTTP content-length is 11, the payload has": re.sub(rb"WARC-Block-Digest: [^\r]*\r\n", b"", good).replace(b"</p>", b"<p>").replace(
            b"Content-Length: %d" % (len(body) + 80), b"").replace(b"\r\n\r\n\r\n", b"\r\n\r\n"),
        "payload digest differs": re.sub(rb"WARC-Block-Digest: [^\r]*\r\n", b"", good).replace(b"text</p>", b"tex!</p>"),
    }
    size = re.search(rb"Content-Length: (\d+)\r\nX-Page", good)[1]
    bad["HTTP content-length is 11, the payload has"] = re.sub(rb"WARC-Block-Digest: [^\r]*\r\n", b"", good).replace(
        b"<p>text</p>", b"<p>tex</p>").replace(b"Content-Length: " + size, b"Content-Length: %d" % (int(size) - 1))
    for why, record in bad.items():
        out = list(warc.read_archive(archive([good, record, good])))
        assert [bool(r.get("error")) for r in out] == [False, True, False], why
        assert why in out[1]["error"], (why, out[1]["error"])
    whole = archive([good] * 3)
    assert [r["payload"] for r in warc.read_archive(whole)] == [body] * 3
    for cut in (len(whole) - 1, len(whole) - 5, len(whole) - 30):
        out = list(warc.read_archive(whole[:cut]))
        assert [bool(r.get("error")) for r in out] == [False, False, True] and "cut short" in out[2]["error"]
    damaged = bytearray(whole)
    damaged[-40] ^= 0xFF
    assert [bool(r.get("error")) for r in warc.read_archive(bytes(damaged))][-1]
    assert "no frame" in list(warc.read_archive(b"not an archive"))[0]["error"]
    assert list(warc.read_archive(b"")) == []


def test_warc_compressed_dictionary():
    samples = [(f"<html><body><p>common words of page {i} " * 20).encode() for i in range(100)]
    d = warc.train_dictionary(samples, 2000)
    body = samples[3]
    record = warc.build_record("response", "<urn:uuid:1>", None, None, hashlib.sha1(body).hexdigest(), len(body), body, None)
    data = archive([record], d)
    packed = zstandard.compress(d)
    again = struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed + data[8 + len(d):]
    assert [r["payload"] for r in warc.read_archive(again)] == [body] == [r["payload"] for r in warc.read_archive(data)]
    lost = struct.pack("<II", 0x184D2A50, 0) + data[8 + len(d):]
    assert list(warc.read_archive(lost))[0]["error"]


def test_warc_lost_response(spark):
    work = Scratch(spark, "warc-test")
    rows = [("a", "response", 1, None, "d1", 9), ("b", "revisit", 2, "a", "d1", 9), ("c", "revisit", 3, "a", "d2", 9), ("d", "revisit", 4, "zz", "d1", 9)]
    df = spark.createDataFrame([(*r, None, None) for r in rows], "record_id string, record_type string, page_id long, "
                               "refers_to_record string, payload_digest string, payload_bytes long, payload binary, error string")
    got = {r.page_id: (r.refers_to, r.error is None) for r in warc.resolve(df, work).collect()}
    assert got == {1: (None, True), 2: (1, True), 3: (1, False), 4: (None, False)}


def test_warc_empty(spark, tables):
    none = spark.createDataFrame([], PAGES)
    assert warc.op12_warc(spark, tables(pages=none)).collect() == []


def test_warc_query(spark):
    same_as_oracle(spark, warc.ORACLE_SQL, warc.op12_warc(spark, SF))


# -- whitening ------------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<float>, size string, x string, n string"


def whitened(x, k):
    """Eigenvalues and whitened rows of integer vectors by a full eigendecomposition."""
    fit = np.unique(x, axis=0)
    c = fit - fit.mean(axis=0)
    e, v = np.linalg.eigh(c.T @ c / len(fit))
    e, v = e[::-1], v[:, ::-1]
    return e, (x - fit.mean(axis=0)) @ v[:, :k] / np.sqrt(e[:k]), fit


def check_whitening(got, ids, x, k=16, vectors=True):
    e, w, fit = whitened(x, k)
    s = fit.astype(object).sum(axis=0)
    deviation = [int(sum((len(fit) * a - b) ** 2 for a, b in zip(row.tolist(), s))) for row in x]
    rows = {}
    for r in got.collect():
        rows.setdefault(r.vec_id, []).append(r)
    assert sorted(rows) == sorted(set(ids))
    for i, row in enumerate(x):
        own = sorted(rows[ids[i]], key=lambda r: r.component)
        assert [r.component for r in own] == list(range(1, k + 1))
        assert {(r.n, r.deviation) for r in own} == {(len(fit), deviation[i])}
        assert all(r.identity_error < 1e-9 for r in own)
        assert np.allclose([r.explained for r in own], e[:k] / e.sum(), rtol=1e-9, atol=0)
        if vectors:
            assert np.allclose(np.abs([r.whitened for r in own]), np.abs(w[i]), atol=1e-8)
    if vectors:  # one sign a component for all rows
        got_w = np.array([[r.whitened for r in sorted(rows[i], key=lambda r: r.component)] for i in ids])
        assert np.allclose(np.abs((got_w * w).sum(axis=0)), (w * w).sum(axis=0), rtol=1e-7)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], VECTORS).repartition(3)


def quantised(vectors):
    return np.floor(64 * np.array(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64)


def test_whitening_rows(spark):
    r = np.random.default_rng(4)
    v = (r.standard_normal((300, 20)) @ np.diag(np.linspace(3, 0.2, 20))).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(1000 + i, v[0].tolist()) for i in range(100)]
    odd = [(2000, None), (2001, [None] + v[1].tolist()[1:]), (2002, [float("nan")] * 20), (2003, [float("inf")] + v[1].tolist()[1:]),
           (2004, []), (2005, [1.0, 2.0]), (2006, [3e38] * 20)]
    got = whitening.whiten(frame(spark, rows + odd))
    assert [f.name for f in got.schema] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    x = quantised([e for _, e in rows])
    check_whitening(got, [i for i, _ in rows], x)


def test_whitening_few_directions(spark):
    """Rank below the width, equal eigenvalues, constant dimensions."""
    r = np.random.default_rng(5)
    v = (r.integers(-50, 50, (120, 3)) @ r.integers(-3, 4, (3, 9))) / 8.0
    got = whitening.whiten(frame(spark, [(i, x.tolist()) for i, x in enumerate(v)]))
    check_whitening(got, list(range(120)), quantised(v), k=3)
    cube = [[float(4 * a), float(4 * b), float(4 * c), 1.0] for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    got = whitening.whiten(frame(spark, list(enumerate(cube))))
    check_whitening(got, list(range(8)), quantised(cube), k=3, vectors=False)


def test_whitening_large_entries(spark):
    v = [[float(2 ** 30 + i * 65536), float(i % 7)] for i in range(60)]
    got = whitening.whiten(frame(spark, list(enumerate(v))))
    x = quantised(v)
    s, n = x.astype(object).sum(axis=0), len(np.unique(x, axis=0))
    want = {i: d if (d := sum((n * a - b) ** 2 for a, b in zip(row.tolist(), s))) < 2 ** 63 else None for i, row in enumerate(x)}
    assert {r.vec_id: r.deviation for r in got.collect()} == want and None in want.values()


def test_whitening_one_or_no_vector(spark):
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None)])).collect() == []
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []


def test_whitening_query(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet").filter(F.col("vec_id") >= 0).collect()
    check_whitening(whitening.op13_embedding_whitening(spark, SF), [r.vec_id for r in emb], quantised([r.embedding for r in emb]))
