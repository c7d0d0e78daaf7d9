"""The host step of op 2 runs over all pages: against brute force, and where it decides."""

import os
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from dimforge.llm import _anchors, html_extraction
from dimforge.llm._common import Scratch

SCHEMA = "page_id long, url string, html string"
SIZE = html_extraction.MIN_RUN


def line(r, n):
    return " ".join(f"w{r.randrange(40)}" for _ in range(n))


def test_repeats_of_all_pages(spark):
    r = random.Random(3)
    common = [line(r, 30).split() for _ in range(4)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(0, 6)):
            k = r.randint(0, 10)
            parts.append(line(r, r.randint(0, 30)) if r.random() < .6 else " ".join(r.choice(common)[k:k + r.randint(5, 25)]))
        html = "".join(f"<p>{p}</p>" if r.random() < .5 else f"<article>{p}</article>" for p in parts)
        rows.append((r.choice([None, i, i, i - 1]), r.choice([None, "http://a.org/x", "https://B.org"]), html))
    rows += rows[:4] + [(None, "http://a.org/", f"<article>{' '.join(common[0])}</article>")] * 2
    scratch = Scratch(spark, "test")
    parsed = html_extraction.parse(spark.createDataFrame(rows, SCHEMA).repartition(3))
    parsed = scratch.write(parsed.withColumn("row", F.monotonically_increasing_id()), "parsed")
    got = {x.row: x.ranges for x in html_extraction.find_repeats(parsed, scratch).collect()}
    pages = [(p.row, p.host, -p.row - 1 if p.page_id is None else p.page_id, [w for b in p.blocks for w in b.text.split(" ")])
             for p in parsed.collect()]
    where = defaultdict(set)
    for _, host, own, t in pages:
        for i in range(len(t) - SIZE + 1):
            where[host, tuple(t[i:i + SIZE])].add(own)
    total = 0
    for row, host, own, t in pages:
        want = {j for i in range(len(t) - SIZE + 1) if len(where[host, tuple(t[i:i + SIZE])]) > 1 for j in range(i, i + SIZE)}
        assert {j for s in got.get(row) or () for j in range(s.lo, s.hi)} == want
        total += len(want)
    assert total > 500


def test_marked_pages_take_part_in_the_host_step(spark):
    links = " ".join(f"link{k}" for k in range(25))
    own = [" ".join(f"own{i}x{k}" for k in range(60)) for i in range(5)]
    twice = " ".join(f"twice{k}" for k in range(40))
    rows = [
        # what marked pages hold outside of their article is boilerplate of the host's only unmarked page
        (10, "http://mixed.org/", f"<article>{own[3]}</article><div>{links}</div>"),
        (11, "http://mixed.org/", f"<div>{own[4]}</div><div>{links}</div>"),
        # an article that a host publishes twice stays; boilerplate does not outweigh a short one
        (20, "http://twice.org/", f"<article>{twice}</article><p>{own[0]}</p>"), (21, "http://twice.org/", f"<article>{twice}</article>"),
        (30, "http://short.org/", f"<article>Short.</article><p>{links}</p>"), (31, "http://short.org/", f"<p>{links}</p>")]
    got = {x.page_id: x.text for x in html_extraction.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {10: own[3], 11: own[4], 20: twice, 21: twice, 30: "Short.", 31: ""}


def test_tables_are_deleted_before_later_steps_shuffle(spark):
    class Watched(Scratch):
        def write(self, df, tag):
            if os.path.isdir(self.root.removeprefix("file:")):
                there[tag] = {x.split("-")[0] for x in os.listdir(self.root.removeprefix("file:"))}
            out = super().write(df, tag)
            rows[tag] = out.count()
            return out

    there, rows = {}, {}
    r = random.Random(4)
    lines = [line(r, 40) for _ in range(8)]
    data = [(i, "http://a.org/", f"<p>{r.choice(lines)} {line(r, 20)}</p>") for i in range(40)]
    scratch = Watched(spark, "test")
    parsed = scratch.write(html_extraction.parse(spark.createDataFrame(data, SCHEMA)).withColumn("row", F.monotonically_increasing_id()), "parsed")
    assert html_extraction.find_repeats(parsed, scratch).count() == 40
    # the ordered suffixes are gone when the occurrences are shuffled again, these when the runs are joined
    assert rows["suffixes-0"] and rows["occurrences-0"]
    assert not {"suffixes", "repeated", "classes", "open"} & there["partly"]
    assert there["ranges"] == {"parsed", "whole", "partly"}
    assert set(os.listdir(scratch.root.removeprefix("file:"))) == {"parsed", "ranges"}


def test_word_hashes():
    unit = _anchors.Unit(SIZE, html_extraction.GRAM, words=True)
    r = random.Random(5)
    pieces = [b"a", b"b", b"ab", b"ba", b"\x1c", "é\u2003".encode(), b"v" * 64, b"v" * 65, b"v" * 40000, b"u" * 40000]
    gaps = [b" ", b"\t", b"\n", b"\x0b", b"\f", b"\r", b"  "]
    hashes = {}
    for _ in range(60):
        texts = [b"".join(r.choice(pieces if r.random() < .6 else gaps) for _ in range(r.randint(0, 30))) for _ in range(r.randint(0, 5))]
        symbols, size = unit._symbols(texts)
        words = [w for t in texts for w in t.split()]
        assert size.tolist() == [len(t.split()) for t in texts]
        got = symbols(0, 0, len(words))
        assert got.dtype == np.uint64 and len(got) == len(words)
        for w, h in zip(words, got.tolist()):
            assert hashes.setdefault(w, h) == h
    assert len(hashes) > 100 and len(set(hashes.values())) == len(hashes)
