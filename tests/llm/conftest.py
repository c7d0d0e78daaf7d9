import random

import pytest

#: Names the operators use inside: none of them may clash.
EXTRA = ["row", "text2", "h", "s", "did", "ver", "x", "p", "w", "kept", "spans", "ranges", "at", "value", "tmpl", "fp", "root",
         "one", "n_words"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def row(doc_id, text, k=0):
    return (doc_id, text, None if k % 3 else "en", f"src{k % 2}", None if text is None else len(text), *[str(k)] * len(EXTRA))


def texts():
    r = random.Random(5)
    syl = "the of and ing er tion ñra éau keit st ou ha".split()
    word = lambda: "".join(r.choice(syl) for _ in range(r.randint(1, 3)))
    sent = lambda n: " ".join(word() for _ in range(n))
    shared = sent(60)
    base = sent(150)
    near = base.split()
    near[70] = "changed"
    long = sent(4000)
    return [None, "", " \n\t ", "one", "The Of", shared, "start " + shared + " end", sent(30) + " " + shared, base, base,
            " ".join(near), "a" * 400, "ab " * 200, long, long[5000:9000], shared.replace(" ", "\n"), shared.replace(" ", "  "),
            "x " + base[30:400], "\n".join(["same line of words here ok"] * 6), "%%% ###" * 30, sent(40) + "\n" + sent(40)]


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): null and empty texts, long texts, copies, near copies, shared passages."""
    return list(enumerate(texts(), 1))


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame([row(i, t, i) for i, t in edge_rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids, repeated rows, ids with two texts."""
    t = texts()
    rows = [row(None, t[5]), row(None, None), row(1, t[8]), row(1, t[8]), row(2, t[8]), row(3, t[5]), row(3, t[6]), row(3, t[6]), row(4, "")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Writes given tables to a new folder and returns its path."""
    def write(**frames):
        d = str(tmp_path_factory.mktemp("tables"))
        for name, df in frames.items():
            df.write.parquet(f"{d}/{name}.parquet")
        return d
    return write
