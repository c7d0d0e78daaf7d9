"""Table-driven cases for the key and text functions, plus a brute-force
check of the text rules on whole documents."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimforge import functions as X

NULL = None

KEY_CASES = [  # raw, prefix, id
    ("c:1", "c", 1), ("c:", "c", NULL), ("c:1:2", "c", 1), ("c: 3 ", "c", 3), ("c:+4", "c", 4),
    ("c:-4", "c", -4), ("c:4.0", "c", NULL), (":7", "", 7), ("7", NULL, NULL), ("", NULL, NULL),
    (NULL, NULL, NULL), ("c:1_0", "c", NULL), ("c:9999999999", "c", NULL),
]
TICKER_CASES = [("NYSE:JNPR", "NYSE", "JNPR"), ("078340", NULL, NULL), ("OTC:A:B", "OTC", "A"), (NULL, NULL, NULL)]

TEXT_INPUTS = [NULL, "", "   ", "!!!", "CafÃ© Bar", "Café Bar", "½ price™", "中国 Inc.", "VP, Sales/Ops & R&D  (2)",
               " O'Reilly_AlphaTech\xa0Ventures ", "a\tb\n c", "ß-Straße"]
CLEAN_TEXT = [NULL, "", "", "!!!", "Cafe Bar", "Cafe Bar", "12 priceTM", "Inc.", "VP, Sales/Ops & R&D  (2)",
              "O'Reilly_AlphaTech Ventures", "a\tb\n c", "-Strae"]
NORMALIZE = [NULL, NULL, NULL, "", "cafã bar", "café bar", "½ price", "中国 inc", "vp sales ops r d 2",
             "oreilly_alphatech ventures", "a b c", "ßstraße"]
CLEAN_ALPHA = [NULL, NULL, "", "", "CafÃ Bar", "Café Bar", "½ price", "中国 Inc", "VP SalesOps  RD  2",
               "OReilly_AlphaTech\xa0Ventures", "a\tb\n c", "ßStraße"]


def _one_col(spark, values, schema="v string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")


def _apply(spark, values, fn):
    df = _one_col(spark, values)
    return [r.o for r in df.select("i", fn("v").alias("o")).orderBy("i").collect()]


def test_entity_keys(spark):
    raws = [c[0] for c in KEY_CASES]
    assert _apply(spark, raws, X.entity_prefix) == [c[1] for c in KEY_CASES]
    assert _apply(spark, raws, X.entity_id) == [c[2] for c in KEY_CASES]


def test_tickers(spark):
    raws = [c[0] for c in TICKER_CASES]
    assert _apply(spark, raws, X.stock_market) == [c[1] for c in TICKER_CASES]
    assert _apply(spark, raws, X.stock_symbol) == [c[2] for c in TICKER_CASES]


def test_clean_integer(spark):
    vals = ["c:12", "x:7abc", "12", "cc:1", "", NULL]
    assert _apply(spark, vals, lambda c: X.clean_integer(c, "string")) == [12, 7, NULL, NULL, NULL, NULL]
    ints = spark.createDataFrame([(5,), (None,)], "v int")
    assert [r.o for r in ints.select(X.clean_integer("v").alias("o")).collect()] == [5, None]


@pytest.mark.parametrize("fn,expected", [(X.clean_text, CLEAN_TEXT), (X.normalize_text, NORMALIZE),
                                         (X.clean_alpha_text, CLEAN_ALPHA)])
def test_text_golden(spark, fn, expected):
    assert _apply(spark, TEXT_INPUTS, fn) == expected


def test_fix_encoding(spark):
    vals = ["Zürich, 3", "Straße", "Łódź", "plain", NULL, "中国"]
    assert _apply(spark, vals, X.fix_encoding) == ["Zurich, 3", "Strasse", "Lodz", "plain", NULL, ""]


def test_small_helpers(spark):
    df = spark.createDataFrame([("a", None, "c", "http://x"), (None, None, "f", "ftp://y"), (None, "b", None, None)],
                               "f string, l string, t string, u string")
    out = df.select(X.full_name("f", "l").alias("n"), X.normalize_entity_type("t").alias("t"),
                    X.url_or_default("u").alias("u")).collect()
    assert [tuple(r) for r in out] == [("a", "c", "http://x"), ("", "c", "Unknown"), ("b", "c", "Unknown")]


def test_safe_casts(spark):
    df = spark.createDataFrame([("2010-10-01 00:00:00.000", "12", "123456.789"), ("abc", "x", "1e99")],
                               "d string, i string, m string")
    r = df.select(X.parse_date("d").alias("d"), X.parse_timestamp("d").alias("t"), X.to_int("i").alias("i"),
                  X.to_decimal("m", 9, 2).alias("m")).collect()
    assert str(r[0].d) == "2010-10-01" and r[0].i == 12 and str(r[0].m) == "123456.79"
    assert r[1].d is None and r[1].t is None and r[1].i is None and r[1].m is None


# ---- brute force: the rules written directly in Python, run on whole documents
WS = r"\s"


def py_clean_text(v):
    if not v:
        return v
    try:
        v = v.encode("latin1").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        pass
    v = unicodedata.normalize("NFKD", v)
    return re.sub(r"[^\x00-\x7F]+", "", v).strip()


def py_normalize(v):
    if v is None or not v.strip():
        return None
    v = re.sub(r"[^\w\s,&/]", "", v.lower())
    v = re.sub(r"[/,&]", " ", v)
    return re.sub(r"\s+", " ", v).strip()


def py_clean_alpha(v):
    return re.sub(r"[^\w\s]", "", v).strip() if v else None


@pytest.mark.parametrize("fn,py", [(X.clean_text, py_clean_text), (X.normalize_text, py_normalize),
                                   (X.clean_alpha_text, py_clean_alpha)])
def test_text_rules_on_documents(spark, fn, py):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r.o for r in docs.select("doc_id", fn("text").alias("o")).collect()}
    want = {r.doc_id: py(r.text) for r in docs.select("doc_id", "text").collect()}
    bad = [k for k in want if got[k] != want[k]]
    assert not bad, f"{len(bad)} documents differ, e.g. {bad[:3]}"


LINE_ENDS = ["caf\u00e9\u2028", "abc\u0085", "abc\u2029", "\u00a0x\u00a0", "ﬁne ①²", "CafÃ©\u0085", "x\n", "\u0085"]


def _python_clean_text(v):
    try:
        v = v.encode("latin-1").decode("utf-8")
    except UnicodeError:
        pass
    return unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii").strip()


def test_clean_text_line_ends(spark):
    assert _apply(spark, LINE_ENDS, X.clean_text) == [_python_clean_text(v) for v in LINE_ENDS]


def test_entity_id_unicode_blanks(spark):
    assert _apply(spark, ["c:5\u0085", "c:\u00a05\u2003", "c:5\n", "c:5x"], X.entity_id) == [5, 5, 5, None]


def test_fix_encoding_alphabets(spark):
    cases = {"Москва": "Moskva", "Щука": "Shchuka", "Ёлка": "Iolka", "Αθήνα": "Athena", "Київ": "Kiyiv", "Łódź": "Lodz", "x\u2028": "x"}
    assert _apply(spark, list(cases), X.fix_encoding) == list(cases.values())


def test_ascii_values_take_the_same_rules(spark):
    """Values in ASCII go another way than the rest; both give what the rules say."""
    import random
    r = random.Random(4)
    values = ["".join(r.choice(pool) for _ in range(r.randint(0, 9))) for pool in (
        [chr(i) for i in range(128)], list(" \t\n\x0b\x0c\r\x1c\x1f,&/aZ_9"), list("aé ß_٣\u2003\x85,&/")) for _ in range(700)]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select("s", X.normalize_text("s").alias("n"), X.clean_alpha_text("s").alias("a"), X.clean_text("s").alias("c")).collect()
    assert len(got) == len(values)
    for row in got:
        lower = re.sub(r"[/,&]", " ", re.sub(r"[^\w\s,&/]", "", row.s.lower()))
        assert row.n == (re.sub(r"\s+", " ", lower).strip() if row.s.strip() else None), repr(row.s)
        assert row.a == (re.sub(r"[^\w\s]", "", row.s).strip() if row.s else None), repr(row.s)
        if row.s.isascii():
            assert row.c == row.s.strip(), repr(row.s)
    keys = ["c:5", "c:05", "c:+5", "c:-5", "c:-0", "c: 5\x85", "c:\x005", "c:5.0", "c:", "c::5", "5", "c:5:6", "c:2147483648", "c:-2147483648"]
    ids = {x.s: x.i for x in spark.createDataFrame([(k,) for k in keys], "s string").select("s", X.entity_id("s").alias("i")).collect()}
    assert ids == dict(zip(keys, [5, 5, 5, -5, 0, 5, None, None, None, None, None, 5, None, -2147483648]))
