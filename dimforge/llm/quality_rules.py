"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a native array or string expression over one row, so the
operator is a single narrow stage: no shuffle, no user function, and the
cost of a document depends on its own length only.

Defined results
  * null or empty text: no words, all counts 0, ``base_failed`` (too few words);
  * null ``doc_id``: kept as null, the row is judged like any other;
  * repeated rows: every row is judged on its own;
  * very long texts: counted whole (repeats are found through 64-bit window
    hashes, sorted inside the row);
  * empty table: empty result with the same columns;
  * extra columns: ignored by ``measure`` (only id and text are read) and
    passed through by ``keep_clean``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.llm._common import read, text_or_empty, words_of

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that for it with as was on are by this be from or an at "
    "de la le et les des en un une du que est pour qui dans par sur pas au avec "
    "der die und das den von zu mit sich auf für ist im dem nicht ein eine als auch "
    "el y los se del las por con no su para es al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """``100 * numerator (<= or >=) percent * denominator`` must hold for
    documents of at least ``min_words`` words."""

    name: str
    numerator: str
    op: str
    percent: int
    denominator: str
    min_words: int = 0


#: Rules every document must pass before the others are looked at.
BASE = (
    Rule("enough words", "n_words", ">=", 1000, "one"),
    Rule("few repeated windows", "n_repeat_words", "<=", 20, "n_words"),
)
#: Length, symbol, stop-word and line ratios.
THRESHOLDS = (
    Rule("mean word length, low", "word_chars", ">=", 250, "n_words"),
    Rule("mean word length, high", "word_chars", "<=", 1200, "n_words"),
    Rule("symbols per word", "n_symbols", "<=", 20, "n_words"),
    Rule("stop words", "n_stop_words", ">=", 8, "n_words", 50),
    Rule("repeated lines", "n_dup_lines", "<=", 50, "n_lines"),
)


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """The table as one boolean column (true: every rule holds)."""
    verdict = F.lit(True)
    for r in rules:
        left, right = F.col(r.numerator) * 100, F.col(r.denominator) * r.percent
        holds = left <= right if r.op == "<=" else left >= right
        verdict = verdict & ((F.col("n_words") < r.min_words) | holds)
    return verdict


def _repeat_words(windows: str) -> Column:
    """Words covered by windows whose hash occurs at least twice, from the
    array of (hash, start) sorted by hash: an entry counts when a neighbour
    has its hash; covered words are the union of [start, start + WINDOW)."""
    starts = F.array_sort(F.filter(
        F.transform(windows, lambda s, k: F.when(
            (s.g == F.get(F.col(windows), k - 1).g) | (s.g == F.get(F.col(windows), k + 1).g), s.i)),
        lambda i: i.isNotNull()))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(starts, zero, lambda a, i: F.struct(
        (i + WINDOW).alias("end"), (a.n + i + WINDOW - F.greatest(i, a.end)).alias("n")), lambda a: a.n)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the metrics, ``base_failed`` and ``kept``."""
    t = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    t = t.withColumn("w", words_of("t"))
    t = t.withColumn("hw", F.transform("w", lambda w: F.xxhash64(w)))
    n = F.size("w")
    # 64-bit hashes of the windows, then (hash, start) sorted, only where a hash repeats
    t = t.withColumn("g", F.when(n >= WINDOW, F.transform(
        F.slice("hw", F.lit(1), n - (WINDOW - 1)),
        lambda x, i: F.xxhash64(x, *[F.get(F.col("hw"), i + k) for k in range(1, WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")))
    t = t.withColumn("s", F.when(
        F.size(F.array_distinct("g")) < F.size("g"),
        F.array_sort(F.transform("g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    t = t.withColumn("l", lines)
    long = lambda c: c.cast("long")
    t = t.select(
        "doc_id",
        long(n).alias("n_words"),
        long(F.length(F.regexp_replace("t", r"[\x20\x09-\x0D]+", ""))).alias("word_chars"),
        long(F.length(F.regexp_replace("t", f"[^{SYMBOLS}]+", ""))).alias("n_symbols"),
        long(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        long(F.when(F.col("s").isNull(), 0).otherwise(_repeat_words("s"))).alias("n_repeat_words"),
        long(F.size("l")).alias("n_lines"),
        long(F.size(F.filter("w", lambda w: F.rtrim(w, F.lit(".,")).isin(STOP_WORDS)))).alias("n_stop_words"),
        F.lit(1).alias("one"),
        # a row number among the metrics keeps the optimizer from copying their
        # expressions into a later filter, where lambdas would build whole
        # arrays again for every element
        F.monotonically_increasing_id().alias("at"),
    )
    computed = F.col("at") >= 0
    base = compile_rules(BASE) & computed
    return t.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(computed, F.col("n_repeat_words")).alias("n_repeat_words"),
        (~base).alias("base_failed"), (base & compile_rules(THRESHOLDS)).alias("kept"),
        "n_lines", "n_stop_words")


def keep_clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    The rules run on a struct of the whole row, so no join is needed and no
    column name of the input can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    packed = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    judged = measure(packed, "row", "text")
    return judged.filter("kept").select(*[F.col("doc_id").getField(c).alias(c) for c in docs.columns])


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return measure(read(spark, sf_dir, "documents"))


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), m AS (
  SELECT doc_id, words, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(list_filter(words, lambda x: rtrim(x, '.,') IN ({_STOP_SQL}))) AS BIGINT) AS n_stop_words
  FROM w
), win AS (
  SELECT doc_id, unnest(range(1, n_words - 3)) AS i, words FROM m WHERE n_words >= 5
), g AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram FROM win
), rep AS (
  SELECT doc_id, i FROM g
  QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), cov AS (
  SELECT doc_id, CAST(count(DISTINCT p) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id
), j AS (
  SELECT m.*, coalesce(c.n_repeat_words, 0) AS n_repeat_words
  FROM m LEFT JOIN cov c USING (doc_id)
), b AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM j
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND 100 * word_chars >= 250 * n_words AND 100 * word_chars <= 1200 * n_words
        AND 100 * n_symbols <= 20 * n_words AND (n_words < 50 OR 100 * n_stop_words >= 8 * n_words)
        AND 100 * n_dup_lines <= 50 * n_lines) AS kept,
       n_lines, n_stop_words
FROM b
"""
