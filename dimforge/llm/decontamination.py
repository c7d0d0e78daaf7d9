"""Benchmark decontamination by template canonicalisation (native).

Words lose surrounding punctuation; numbers, units and names become typed
placeholders, other words are lower-cased.  Windows of ``WINDOW`` template
tokens of every document are hash-joined with those of the benchmark.  A
document contains an item when enough of the item's windows match on
neighbouring alignments (shifts at most ``MAX_SHIFT`` apart, so that an inserted or
dropped word, or a name of another length, does not split the count), or when
only windows that one edit can touch are missing there (at most ``WINDOW`` in
a row; a short item has few others) and the rest cover more than half of the item, and the
placeholders are filled consistently: within a type each item value stands
for exactly one document value and the other way round.  A verbatim passage
fills every slot with itself; a re-parameterised question renames its values
one to one.

A window with fewer than ``MIN_LITERALS`` literal tokens (number-dense, title-case
or all-caps text, short items) says too little as a template; it counts where a
document has its exact lower-cased values.  An item is found by enough of its
windows of either kind, or of its template windows alone.

Plan: the benchmark's window keys are written, so the planner knows their
size: below ``spark.sql.autoBroadcastJoinThreshold`` they are broadcast and
documents are filtered in the scan stage, beyond it Spark shuffles both
sides.  Only matches go on; texts are read again only to check the words of
matched alignments, gathered per document (bounded by its length times the
items it holds).

Defined results
  * null or empty text (document or item): no tokens, never matches;
  * null ids: the row cannot be named, it is not compared (``clean`` keeps it);
  * items shorter than ``WINDOW`` tokens: compared by one window of their
    whole length, so an item of one to three words is found wherever these
    stand in a row;
  * capitals differ between copies: windows that count by their values match,
    template windows do not where a capital makes a name of a literal;
  * repeated documents or items: every (doc_id, item_id) pair once; rows
    that share a doc_id count as one document in the result;
  * empty tables: no pairs; extra columns are not read, and ``clean`` passes
    them through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm._common import Scratch, read, words_of

WINDOW = 8
MIN_LITERALS = 4
#: Windows of an item that must match on one alignment (all, if it has fewer).
MIN_WINDOWS = 5
#: Alignments whose windows count together differ by so many words at most.
MAX_SHIFT = 2
STRIP = ".,;:!?()[]{}\"'#*$%&|<>_-"
NUMBER, UNIT, NAME = "<num>", "<unit>", "<name>"
#: Words that name a unit.
UNITS = (
    "km cm mm mi ft kg mg lb lbs oz ml mile miles meter meters metre metres foot feet inch inches "
    "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees"
).split()


def tokens(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """id, ``value`` (stripped words) and ``tmpl`` (template tokens)."""
    strip = F.lit(STRIP)
    t = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), words_of(text_col).alias("w"))
    t = t.withColumn("w", F.filter("w", lambda w: F.btrim(w, strip) != ""))
    t = t.withColumn("value", F.transform("w", lambda w: F.btrim(w, strip)))
    inside = lambda i: ~F.coalesce(F.get(F.col("w"), i - 1).rlike("[.!?]$"), F.lit(True))
    tmpl = F.transform("value", lambda s, i: F.when(s.rlike(r"^[0-9]"), NUMBER)
                       .when(F.lower(s).isin(UNITS), UNIT)
                       .when(s.rlike(r"^\p{Lu}") & inside(i), NAME)
                       .otherwise(F.lower(s)))
    return t.select("id", "value", tmpl.alias("tmpl"))


def windows(tok: DataFrame, lengths: list[int], exact: list[int] = ()) -> DataFrame:
    """(id, key, pos) of every template window of the given lengths, and of
    every window of lower-cased values of the lengths ``exact``."""
    def keys(h: str, n: int, kind: int):
        rolled = F.transform(F.slice(h, F.lit(1), F.size(h) - (n - 1)), lambda x, i: F.xxhash64(
            F.lit(kind), x, *[F.get(F.col(h), i + k) for k in range(1, n)]))
        return F.when(F.size(h) >= n, rolled).otherwise(F.array().cast("array<bigint>"))

    t = tok.select("id", F.transform("tmpl", lambda x: F.xxhash64(x)).alias("h"))
    v = tok.select("id", F.transform("value", lambda x: F.xxhash64(F.lower(x))).alias("h"))
    parts = [t.select("id", F.posexplode(keys("h", n, n)).alias("pos", "key")) for n in lengths]
    parts += [v.select("id", F.posexplode(keys("h", n, -n)).alias("pos", "key")) for n in exact]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _is_slot(t):
    return t.isin(NUMBER, UNIT, NAME)


def _item_windows(bench: DataFrame) -> DataFrame:
    """item_id, key, pos, len, exact, n_windows, n_templates, n_tokens of all
    windows; those with too few literals are ``exact``."""
    n = F.size("tmpl")
    b = bench.select("id", "tmpl", F.transform("value", F.lower).alias("value"), F.least(n, F.lit(WINDOW)).alias("len")).filter("len > 0")
    b = b.withColumn("pos", F.explode(F.sequence(F.lit(0), n - F.col("len"))))
    b = b.withColumn("win", F.slice("tmpl", F.col("pos") + 1, F.col("len")))
    b = b.withColumn("exact", F.size(F.filter("win", lambda t: ~_is_slot(t))) < MIN_LITERALS)
    b = b.withColumn("win", F.when(F.col("exact"), F.slice("value", F.col("pos") + 1, F.col("len"))).otherwise(F.col("win")))
    # the same key as windows(): the length, negative for values, and the token hashes
    key = F.lit(None).cast("bigint")
    for k in range(1, WINDOW + 1):
        key = F.when(F.col("len") == k, F.xxhash64(F.when(F.col("exact"), F.lit(-k)).otherwise(F.lit(k)),
                                                   *[F.xxhash64(F.get(F.col("win"), i)) for i in range(k)])).otherwise(key)
    b = b.select(F.col("id").alias("item_id"), key.alias("key"), "pos", "len", "exact").distinct()
    per_item = b.groupBy("item_id").agg(F.count("*").alias("n_windows"), F.count(F.when(~F.col("exact"), 1)).alias("n_templates"),
                                      F.max(F.col("pos") + F.col("len")).alias("n_tokens"))
    return b.join(per_item, "item_id")


def find(docs: DataFrame, benchmark: DataFrame, min_windows: int = MIN_WINDOWS) -> DataFrame:
    """One row per (doc_id, item_id): the document contains the item.

    ``n_matched`` windows of ``n_windows`` on the best alignment and its
    neighbours, ``n_slots`` distinct slot values there, ``changed`` of them with another value."""
    scratch = Scratch(docs.sparkSession, "decontamination")
    bench_tokens = scratch.write(tokens(benchmark, "item_id"), "items")
    iw = scratch.write(_item_windows(bench_tokens), "item-windows")
    keys = scratch.write(iw.select("key").distinct(), "keys")
    # at most 2 * WINDOW rows
    found = sorted((r["len"], r["exact"]) for r in iw.select("len", "exact").distinct().collect()) or [(WINDOW, False)]
    hits = windows(tokens(docs, "doc_id"), [n for n, e in found if not e], [n for n, e in found if e]).join(keys, "key", "left_semi")
    hits = scratch.write(hits.select(F.col("id").alias("doc_id"), F.col("pos").alias("at"), "key").distinct(), "hits")
    runs = (hits.join(iw, "key")
            .groupBy("doc_id", "item_id", "n_windows", "n_templates", "n_tokens", (F.col("at") - F.col("pos")).alias("shift"))
            .agg(F.collect_set("pos").alias("windows"), F.collect_set(F.when(~F.col("exact"), F.col("pos"))).alias("templates"),
                 F.min("pos").alias("lo"), F.max(F.col("pos") + F.col("len")).alias("hi"), F.max("len").alias("len")))
    # a pair of document and item has at most as many alignments as the document has words
    near = Window.partitionBy("doc_id", "item_id").orderBy("shift").rangeBetween(-MAX_SHIFT, MAX_SHIFT)
    together = lambda c: F.array_distinct(F.flatten(F.collect_list(c).over(near)))
    runs = runs.withColumn("all", together("windows")).withColumn("named", together("templates"))
    runs = runs.withColumn("lost", F.array_except(F.sequence(F.lit(0), F.col("n_windows").cast("int") - 1), "all"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("all", lambda p: F.sequence(p, p + F.col("len") - 1)))))
    n = F.size("all")
    enough = ((n >= F.least(F.col("n_windows"), F.lit(min_windows)))
              | (F.col("n_templates") > 0) & (F.size("named") >= F.least(F.col("n_templates"), F.lit(min_windows)))
              | (n >= 2) & (F.array_max("lost") - F.array_min("lost") < WINDOW) & (2 * covered > F.col("n_tokens")))
    runs = runs.filter(enough).select("doc_id", "item_id", "n_windows", "shift", n.cast("long").alias("n_matched"), "lo", "hi")
    runs = scratch.write(runs, "runs")
    # words of the matched stretches
    per_doc = runs.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(
        F.struct("item_id", "shift", "lo", "hi", "n_matched", "n_windows")).alias("m"))
    dt = docs.select("doc_id", "text").join(per_doc.select(F.col("id").alias("doc_id"), "m"), "doc_id")
    doc_tok = (tokens(dt.select(F.struct("doc_id", "m").alias("idm"), "text"), "idm")
               .select("id.doc_id", "id.m", "value", "tmpl"))
    parts = doc_tok.select("doc_id", F.explode(F.transform("m", lambda m: F.struct(
        m.alias("m"),
        F.slice(F.col("value"), F.greatest(m["lo"] + m["shift"] + 1, F.lit(1)), m["hi"] - m["lo"]).alias("dv"),
        F.slice(F.col("tmpl"), F.greatest(m["lo"] + m["shift"] + 1, F.lit(1)), m["hi"] - m["lo"]).alias("dt")))).alias("x"))
    parts = parts.select("doc_id", "x.m.*", "x.dv", "x.dt")
    both = parts.join(bench_tokens.select(F.col("id").alias("item_id"), "value", "tmpl"), "item_id")
    iv, it = F.slice("value", F.col("lo") + 1, F.col("hi") - F.col("lo")), F.slice("tmpl", F.col("lo") + 1, F.col("hi") - F.col("lo"))
    zipped = F.arrays_zip(F.col("dv"), F.col("dt"), iv.alias("iv"), it.alias("it"))
    both = both.withColumn("z", F.filter(zipped, lambda z: z["dt"] == z["it"]))
    slots = F.array_distinct(F.transform(F.filter("z", lambda z: _is_slot(z["it"])),
                                         lambda z: F.struct(z["it"].alias("t"), F.lower(z["iv"]).alias("a"), F.lower(z["dv"]).alias("b"))))
    both = both.withColumn("slots", slots)
    one_way = lambda f: F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["t"], s[f]))))
    n = F.size("slots")
    both = both.filter((n == one_way("a")) & (n == one_way("b")))
    changed = F.size(F.filter("slots", lambda s: s["a"] != s["b"]))
    best = F.max(F.struct("n_matched", (-changed).alias("c"), n.alias("n_slots"), "n_windows"))
    return (both.groupBy("doc_id", "item_id").agg(best.alias("x"))
            .select("doc_id", "item_id", "x.n_matched", "x.n_windows", F.col("x.n_slots").cast("long").alias("n_slots"),
                    (-F.col("x.c")).cast("long").alias("changed")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    scratch = Scratch(docs.sparkSession, "decontamination")
    bad = scratch.write(find(docs, benchmark).select("doc_id").distinct(), "contaminated")
    return docs.join(bad, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_UNITS_SQL = ", ".join(f"'{u}'" for u in UNITS)
_STRIP_SQL = STRIP.replace("'", "''")


def _tokens_sql(table: str, key: str) -> str:
    return f"""
  SELECT id, pos, value,
    CASE WHEN regexp_matches(value, '^[0-9]') THEN '{NUMBER}'
         WHEN lower(value) IN ({_UNITS_SQL}) THEN '{UNIT}'
         WHEN regexp_matches(value, '^\\p{{Lu}}') AND NOT coalesce(regexp_matches(before, '[.!?]$'), true) THEN '{NAME}'
         ELSE lower(value) END AS tmpl
  FROM (SELECT id, trim(w[pos], '{_STRIP_SQL}') AS value, pos - 1 AS pos,
               CASE WHEN pos > 1 THEN w[pos - 1] END AS before
        FROM (SELECT id, w, unnest(range(1, len(w) + 1)) AS pos
              FROM (SELECT {key} AS id, list_filter(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'),
                                                    lambda x: trim(x, '{_STRIP_SQL}') <> '') AS w
                    FROM {table})))"""


def _windows_sql(table: str, size: str) -> str:
    return f"""
  SELECT id, pos, list(tmpl) OVER win AS k, len(list_filter(list(tmpl) OVER win, lambda t: t NOT IN ('{NUMBER}', '{UNIT}', '{NAME}'))) AS lits
  FROM {table} WINDOW win AS (PARTITION BY id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {size} FOLLOWING)"""


# every benchmark item of the data has at least WINDOW tokens
ORACLE_SQL = f"""
WITH d AS ({_tokens_sql('documents', 'doc_id')}
), b AS ({_tokens_sql('benchmark', 'item_id')}
), dw AS (SELECT * FROM ({_windows_sql('d', str(WINDOW - 1))}) WHERE len(k) = {WINDOW}
), bw AS (SELECT * FROM ({_windows_sql('b', str(WINDOW - 1))}) WHERE len(k) = {WINDOW} AND lits >= {MIN_LITERALS}
), nw AS (SELECT id, count(*) AS n_windows FROM bw GROUP BY id
), hit AS (
  SELECT dw.id AS doc_id, bw.id AS item_id, n_windows, dw.pos - bw.pos AS shift, bw.pos AS pos
  FROM dw JOIN bw ON dw.k = bw.k JOIN nw ON nw.id = bw.id
), one AS (
  SELECT doc_id, item_id, n_windows, shift, min(pos) AS lo, max(pos) + {WINDOW} AS hi FROM hit GROUP BY ALL
), near AS (
  SELECT o.*, h.pos FROM one o JOIN hit h ON h.doc_id = o.doc_id AND h.item_id = o.item_id AND abs(h.shift - o.shift) <= {MAX_SHIFT}
), n AS (
  SELECT doc_id, item_id, n_windows, shift, lo, hi, count(DISTINCT pos) AS n_matched,
         len(list_distinct(flatten(list(range(pos, pos + {WINDOW}))))) AS covered, list(DISTINCT pos) AS ps
  FROM near GROUP BY ALL
), size AS (SELECT id AS item_id, count(*) AS n_tokens FROM b GROUP BY id
), runs AS (
  SELECT doc_id, item_id, n_windows, shift, lo, hi, n_matched FROM (
    SELECT n.*, n_tokens, list_filter(range(n_windows), lambda x: NOT list_contains(ps, x)) AS lost FROM n JOIN size USING (item_id))
  WHERE n_matched >= least(n_windows, {MIN_WINDOWS})
     OR n_matched >= 2 AND list_max(lost) - list_min(lost) < {WINDOW} AND 2 * covered > n_tokens
), al AS (
  SELECT r.*, b.tmpl AS t, lower(b.value) AS x, lower(d.value) AS y
  FROM runs r JOIN b ON b.id = r.item_id AND b.pos >= lo AND b.pos < hi
  JOIN d ON d.id = r.doc_id AND d.pos = b.pos + shift AND d.tmpl = b.tmpl
), s AS (
  SELECT doc_id, item_id, shift, n_matched, n_windows,
         count(DISTINCT CASE WHEN slot THEN t || ' ' || x || ' ' || y END) AS n_slots,
         count(DISTINCT CASE WHEN slot THEN t || ' ' || x END) AS xs,
         count(DISTINCT CASE WHEN slot THEN t || ' ' || y END) AS ys,
         count(DISTINCT CASE WHEN slot AND x <> y THEN t || ' ' || x || ' ' || y END) AS changed
  FROM (SELECT *, t IN ('{NUMBER}', '{UNIT}', '{NAME}') AS slot FROM al) GROUP BY ALL
)
SELECT doc_id, item_id, n_matched, n_windows, n_slots, changed FROM s
WHERE n_slots = xs AND n_slots = ys
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id
                           ORDER BY n_matched DESC, changed, n_slots DESC, n_windows DESC) = 1
"""
