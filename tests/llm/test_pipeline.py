"""The pipeline against its stages done one after the other in plain Python."""

import corpus_pipeline
from dimforge.llm import bpe, decontamination, quality_rules
from tests.llm import brute
from tests.llm.conftest import row


def _snap(text, cov):
    """Characters stay unless all their bytes are covered."""
    out, at = [], 0
    for c in text:
        n = len(c.encode())
        if not all(cov[at:at + n]):
            out.append(c)
        at += n
    return "".join(out)


def test_pipeline(spark, edge_docs, edge_rows, tables):
    from tokenizers import Tokenizer
    good = {r.doc_id for r in quality_rules.measure(edge_docs).filter("kept").collect()}
    rows = [(i, t) for i, t in edge_rows if i in good]
    _, groups = brute.near([t for _, t in rows])
    rows = [rows[k] for k, g in enumerate(groups) if k == min(g)]
    assert len(rows) > 2
    covers = brute.covered([t.encode() for _, t in rows], 100)
    rows = [(i, _snap(t, c)) for (i, t), c in zip(rows, covers)]
    longest = max(rows, key=lambda r: len(r[1]))
    bench = spark.createDataFrame([(1, "Unrelated words that no document of this table holds anywhere at all"),
                                   (2, " ".join(longest[1].split()[100:140]))], "item_id long, text string")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, tables(documents=edge_docs, benchmark=bench)).collect()}
    left = spark.createDataFrame(rows, "doc_id long, text string")
    bad = {r.doc_id for r in decontamination.find(left, bench).collect()}
    assert longest[0] in bad and len(bad) < len(rows)
    tk = Tokenizer.from_file(str(bpe.tokenizer_path()))
    exp = {i: tk.encode(t, add_special_tokens=False).ids for i, t in rows if i not in bad}
    assert {i: r.ids for i, r in got.items()} == exp


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs, tables):
    bench = spark.createDataFrame([(1, "some words of a benchmark item that nobody has in a text")], "item_id long, text string")
    d = tables(benchmark=bench)
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, d)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
    nulls = spark.createDataFrame([row(None, None)] * 2, odd_docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, nulls, d).collect()


def test_clean_documents_stay(spark):
    """Documents that no stage has a reason to touch come out with their text's tokens."""
    sf = "/root/testdata/sf0.001"
    assert 0 < corpus_pipeline.run(spark, sf).count() <= spark.read.parquet(f"{sf}/documents.parquet").count()
