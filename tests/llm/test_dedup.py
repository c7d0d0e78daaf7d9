"""SimHash, suffix-array and substring dedup against brute force."""

import pytest
from pyspark.sql import functions as F

from dimforge.llm import simhash, substring_dedup, suffix_dedup
from dimforge.llm._graph import components
from dimforge.llm._common import Scratch
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 150)] + [(7, 7)] + [(200, 199), (199, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 150)}, 199: 199, 200: 199}


def _simhash_expected(rows):
    fp, groups = brute.near([t for _, t in rows])
    return {i: (f"{f:016x}", min(rows[j][0] for j in g)) for (i, _), f, g in zip(rows, fp, groups)}


def test_simhash(spark, edge_docs, edge_rows, no_docs, odd_docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.link(edge_docs).collect()}
    assert got == _simhash_expected(edge_rows)
    assert simhash.link(no_docs).collect() == []
    odd = simhash.link(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    zero = [r for r in odd if r.fingerprint == "0" * 16]
    assert len(zero) == 2 and {r.component_id for r in zero} == {4}
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in got.items() if i == c}


def test_simhash_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op6_simhash_near_dedup(spark, SF).collect()}
    assert got == _simhash_expected(rows)


def test_simhash_links_of_every_distance(spark):
    """Fingerprints with planted distances, many under the same keys."""
    import numpy as np
    r = np.random.default_rng(3)
    fps = [int(x) for x in r.integers(0, 2**64, 40, dtype=np.uint64)]
    fps += [f ^ (1 << int(a)) ^ (1 << int(b)) for f in fps[:30] for a, b in r.integers(0, 64, (4, 2))]
    fps += [f ^ 0b111 for f in fps[30:40]] + [fps[0] ^ k for k in range(600)]
    fps = sorted(set(fps))
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    keys = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3).mapInArrow(simhash.index_rows(2), "combo int, key long, fp long")
    links = keys.repartition(4, "combo", "key").sortWithinPartitions("combo", "key").mapInArrow(simhash.key_links(2), "a long, b long").distinct()
    par = {s: s for s in signed}

    def root(x):
        while par[x] != x:
            x = par[x]
        return x

    for x, y in links.collect():
        assert ((x ^ y) & (2**64 - 1)).bit_count() <= 2
        a, b = root(x), root(y)
        par[max(a, b)] = min(a, b)
    got = {s: root(s) for s in signed}
    par.update({s: s for s in signed})
    for i, x in enumerate(signed):
        for y in signed[:i]:
            if ((x ^ y) & (2**64 - 1)).bit_count() <= 2:
                a, b = root(x), root(y)
                par[max(a, b)] = min(a, b)
    assert got == {s: root(s) for s in signed}


def test_suffix_array(spark, edge_docs, edge_rows, tables):
    exp = brute.suffix_rows(edge_rows)
    done = suffix_dedup.remove_repeats(edge_docs)
    got = {r.row.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in done.collect()}
    assert got == exp
    q = suffix_dedup.op5_suffix_array_dedup(spark, tables(documents=edge_docs.select("doc_id", "text"))).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in q} == \
        {i: (*e[:3], brute.sha256(e[3])) for i, e in exp.items()}


def test_suffix_array_other_length(spark, edge_docs, edge_rows):
    unit = suffix_dedup.Unit(31, 7, words=False)
    got = {r.row.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(edge_docs, unit).collect()}
    assert got == {i: e[3] for i, e in brute.suffix_rows(edge_rows, 31).items()}
    with pytest.raises(ValueError):
        suffix_dedup.step_of(5)


def test_suffix_array_keeps_characters(spark, edge_docs):
    for r in suffix_dedup.remove_repeats(edge_docs, characters=True).collect():
        bytes(r.kept).decode("utf-8")


def test_suffix_array_odd_rows(spark, odd_docs, no_docs):
    assert suffix_dedup.remove_repeats(no_docs).collect() == []
    rows = [(r.row.doc_id, r.row.text, r.n_removed) for r in suffix_dedup.remove_repeats(odd_docs).collect()]
    assert len(rows) == odd_docs.count()
    by = {}
    for i, t, n in rows:
        by.setdefault((i, t), set()).add(n)
    assert all(len(v) == 1 for v in by.values())  # identical rows, identical results
    full = next(t for i, t, _ in rows if i == 2)
    assert by[(1, full)] == {0} and by[(2, full)] == {len(full.encode())}  # copies of row 1 are one document
    shared = next(t for i, t, _ in rows if i is None and t)
    assert by[(None, shared)] == {0} and by[(3, shared)] == {len(shared.encode())}  # a null id sorts first


def test_substring(spark, edge_docs, edge_rows, no_docs, odd_docs, tables):
    exp = brute.substring_rows(edge_rows)
    got = {r.row.doc_id: (r.n_words, r.n_removed, bytes(r.kept).decode()) for r in substring_dedup.remove_repeats(edge_docs).collect()}
    assert got == exp
    q = substring_dedup.op10_substring_dedup(spark, tables(documents=edge_docs.select("doc_id", "text"))).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in q} == {i: (*e[:2], brute.sha256(e[2])) for i, e in exp.items()}
    assert substring_dedup.remove_repeats(no_docs).collect() == []
    assert substring_dedup.remove_repeats(odd_docs).count() == odd_docs.count()


def test_substring_query(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    exp = {i: (n, k, brute.sha256(t)) for i, (n, k, t) in brute.substring_rows(rows).items()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.op10_substring_dedup(spark, SF).collect()} == exp


def test_suffix_query(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
                  .where(F.length("text") < 4000).collect())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.row.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == brute.suffix_rows(rows)
