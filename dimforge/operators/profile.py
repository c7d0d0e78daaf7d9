"""Column profiling: narrow scans, and one shuffle of each column's distinct values.

Per column: data type, null count, exact distinct count (NULL counted as a
value), min, max, percent missing, percent valid date (date/timestamp
columns only) and, optionally, the k smallest distinct non-NULL values.

* Row and null counts come from one aggregate without keys: a scan that
  shuffles one row per task.
* The rest needs the distinct values.  The columns of one type are unpivoted
  to ``(ordinal, value)`` in that type and made distinct by a hash aggregation
  (partially before its shuffle).  A row holds one value, and columns of
  different types never share a task, so a task's memory follows the values
  of its own partition.  Count, minimum and maximum per column are then an
  object hash aggregation, which (unlike a plain minimum of texts) sorts nothing.
* The k smallest values need an order, which is not made for all of them:
  the k-th smallest value among the first ``BOUND_ROWS`` rows bounds them, and
  only values up to it (all, where a column has no such bound) are ordered.
  Every value is compared, so the bound decides how much is ordered, never
  the result.

So the frame is read several times.  Unless the caller says that it is
``stored`` (read from files), it is first written to the checkpoint folder
and read back.

Percentages are rounded half-up to two decimals from the exact ratio,
computed with integer arithmetic (no binary floating-point artefacts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DataType, DateType, DoubleType, FloatType, MapType, StringType,
                               StructType, TimestampNTZType, TimestampType)

from dimforge.operators.refcheck import written

PROFILE_COLUMNS = ["table_name", "column_name", "ordinal", "data_type", "n_rows", "n_cols", "null_count",
                   "unique_count", "percentage_missing_value", "min_value", "max_value",
                   "percentage_valid_date"]


#: Rows that the bounds of the smallest values are taken from.
BOUND_ROWS = 10_000


def _orderable(t: DataType) -> bool:
    if isinstance(t, (MapType, BinaryType)):
        return False
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def _is_datetime(t: DataType) -> bool:
    return isinstance(t, (DateType, TimestampType, TimestampNTZType))


def pct(part: str, whole: str):
    """round(100 * part / whole, 2) half-up, 0.0 when whole is 0 (SQL
    expressions over long counts; exact integer division)."""
    return F.expr(f"CASE WHEN {whole} > 0 THEN CAST((({part}) * 20000 + {whole}) div (2 * {whole}) AS DOUBLE) / 100 "
                  f"ELSE 0.0D END")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _value(f) -> F.Column:
    """A column's values as they are compared: unorderable ones by their JSON
    text, zeros without a sign."""
    c = F.col(_q(f.name))
    if isinstance(f.dataType, (FloatType, DoubleType)):
        return F.when(c == 0, F.lit(0).cast(f.dataType)).otherwise(c)
    return c if _orderable(f.dataType) else F.to_json(c)


def _values(df: DataFrame) -> list[DataFrame]:
    """``(ordinal, v)`` of all non-NULL values, a frame for each type."""
    by_type: dict[DataType, list] = {}
    for i, f in enumerate(df.schema.fields):
        by_type.setdefault(f.dataType if _orderable(f.dataType) else StringType(), []).append(
            F.struct(F.lit(i).alias("ordinal"), _value(f).alias("v")))
    return [df.select(F.inline(F.array(*items))).where(F.col("v").isNotNull()) for items in by_type.values()]


def value_stats(df: DataFrame, k: int = 0) -> DataFrame:
    """``(ordinal, n_distinct, min_value, max_value)`` of each column that has a
    non-NULL value; with ``k`` also ``smallest``, the texts of its ``k`` smallest values in order."""
    out = None
    up = Window.partitionBy("ordinal").orderBy("v")
    for values, some in zip(_values(df), _values(df.limit(BOUND_ROWS))):
        distinct = values.distinct()
        none = F.size(F.collect_set(F.lit(None).cast("int")))   # 0; with it Spark hashes objects instead of sorting
        part = distinct.groupBy("ordinal").agg(
            (F.count(F.lit(1)) + none).alias("n_distinct"), F.min("v").cast("string").alias("min_value"),
            F.max("v").cast("string").alias("max_value"))
        if k:
            bounds = (some.distinct().withColumn("at", F.row_number().over(up)).where(F.col("at") == k)
                      .select("ordinal", F.col("v").alias("bound")))   # a row per column at most
            low = distinct.join(F.broadcast(bounds), "ordinal", "left").where(F.col("bound").isNull() | (F.col("v") <= F.col("bound")))
            smallest = (low.withColumn("at", F.row_number().over(up)).where(F.col("at") <= k).groupBy("ordinal")
                        .agg(F.sort_array(F.collect_list(F.struct("at", F.col("v").cast("string").alias("text")))).alias("s"))
                        .select("ordinal", F.col("s.text").alias("smallest")))
            part = part.join(smallest, "ordinal")
        out = part if out is None else out.unionByName(part)
    return out


def _columns(df: DataFrame) -> DataFrame:
    """Literal relation of the column metadata (built in the JVM)."""
    rows = [F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.lit(_is_datetime(f.dataType)).alias("is_date"))
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def profile(df: DataFrame, table_name: str, exact: bool = True, sample_k: int = 0, stored: bool = False) -> DataFrame:
    """One row per column (see ``PROFILE_COLUMNS``).  With ``sample_k > 0`` a
    ``sample_values`` array (the k smallest distinct values, in order; NULL
    if there is none) is added.  ``exact=False`` uses HyperLogLog distinct
    counts and one global aggregate instead (no shuffle of values; samples are
    then not available).  ``stored``: ``df`` is read from files."""
    fields = df.schema.fields
    if exact and not stored:
        df = written(df)
    out = _columns(df).join(_stats(df, exact), "ordinal", "left")
    if exact:
        out = out.join(value_stats(df, sample_k), "ordinal", "left").withColumn(
            "unique_count", F.coalesce("n_distinct", F.lit(0)) + F.when(F.col("null_count") > 0, 1).otherwise(0))
        unordered = [i for i, f in enumerate(fields) if not _orderable(f.dataType)]   # have no min and max
        for c in ("min_value", "max_value") if unordered else ():
            out = out.withColumn(c, F.when(~F.col("ordinal").isin(unordered), F.col(c)))
    cols = [F.lit(table_name).alias("table_name"), "column_name", "ordinal", "data_type", F.col("n_rows").cast("long").alias("n_rows"),
            F.lit(len(fields)).alias("n_cols"),
            F.coalesce(F.col("null_count"), F.lit(0)).cast("long").alias("null_count"),
            F.coalesce(F.col("unique_count"), F.lit(0)).cast("long").alias("unique_count"),
            pct("coalesce(null_count, 0)", "n_rows").alias("percentage_missing_value"),
            "min_value", "max_value",
            F.when(F.col("is_date"), pct("n_rows - coalesce(null_count, 0)", "n_rows"))
             .alias("percentage_valid_date")]
    if sample_k and exact:
        cols.append(F.col("smallest").alias("sample_values"))
    return out.select(*cols)


def _stats(df: DataFrame, exact: bool = True) -> DataFrame:
    """Row and null counts of every column from one aggregate; with
    ``exact=False`` minimum, maximum and estimated distinct counts too."""
    fields = df.schema.fields
    aggs, names = [F.count(F.lit(1)).alias("n")], ["null_count"]
    if not exact:
        names += ["unique_count", "min_value", "max_value"]
    for i, f in enumerate(fields):
        c = F.col(_q(f.name))
        lo, hi = (F.min(c), F.max(c)) if _orderable(f.dataType) else (F.lit(None), F.lit(None))
        found = [F.count_if(c.isNull()), F.approx_count_distinct(c) + F.max(c.isNull().cast("int")), lo.cast("string"), hi.cast("string")]
        aggs += [x.alias(f"{n}{i}") for n, x in zip(names, found)]
    per_col = F.explode(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), *[F.col(f"{n}{i}").alias(n) for n in names]) for i in range(len(fields))]))
    return df.agg(*aggs).select(F.col("n").alias("n_rows"), per_col.alias("s")).select("n_rows", "s.*")


def samples(df: DataFrame, table_name: str, k: int = 5, stored: bool = False) -> DataFrame:
    """The ``k`` smallest distinct non-NULL values per column, long format:
    ``(table_name, column_name, sample_rank, sample_value)``."""
    names = F.array(*[F.lit(f.name) for f in df.schema.fields])
    return (value_stats(df if stored else written(df), k)
            .select("ordinal", F.posexplode("smallest").alias("at", "sample_value"))
            .select(F.lit(table_name).alias("table_name"),
                    F.element_at(names, F.col("ordinal") + 1).alias("column_name"),
                    (F.col("at") + 1).cast("int").alias("sample_rank"), "sample_value"))
