"""File sources: CSV, JSON records (landed API responses), Parquet.

Readers take an explicit schema so no inference pass runs over the data
and every column has the declared type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             multiline: bool = False) -> DataFrame:
    """Header CSV.  Quotes inside quoted fields are doubled (``""``), which
    is the common CSV convention.  Without a schema every column is a
    string.  ``multiline=True`` allows line breaks inside quoted fields but
    makes each file one task (such files are not splittable)."""
    r = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
         .option("multiLine", multiline).option("mode", "PERMISSIVE"))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


CORRUPT = "_corrupt_record"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
                     multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, bad rows) of a CSV.  A line with too few or too many columns, or
    with a value that its column's type cannot hold, is no row: it is
    returned whole, with its first value and a reason.

    Every column is read whatever a query needs: a scan that leaves a column
    out would not see that its value is bad, and the same line would be a row in
    one query and a bad row in another."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    every = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    lines = (spark.read.schema(every).option("header", header).option("quote", '"').option("escape", '"')
             .option("multiLine", multiline).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
             .csv(path))
    names = schema.fieldNames()
    # always true, but needs every column: a scan converts (and so judges) only the columns a query needs
    read = F.hash(*[F.col(f"`{n}`") for n in names]).bitwiseAND(F.lit(0)) == 0
    rows = lines.where(F.col(CORRUPT).isNull() & read).select(*[F.col(f"`{n}`") for n in names])
    # commas outside quotes; doubled quotes are two quoted parts side by side
    bare = F.regexp_replace(CORRUPT, r'"[^"]*"', "")
    n_fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    text = F.from_csv(CORRUPT, ", ".join(f"c{i} string" for i in range(len(names))), {"quote": '"', "escape": '"'})
    wrong = F.array_compact(F.array(*[
        F.when(F.col(f"__t.c{i}").isNotNull() & F.col(f"__t.c{i}").try_cast(f.dataType).isNull(),
               F.lit(f"{f.name} is no {f.dataType.simpleString()}")) for i, f in enumerate(schema.fields)]))
    reason = (F.when(n_fields < len(names), F.concat(F.lit("too few columns: "), n_fields.cast("string")))
              .when(n_fields > len(names), F.concat(F.lit("too many columns: "), n_fields.cast("string")))
              .when(F.size(wrong) > 0, F.array_join(wrong, "; ")).otherwise("malformed"))
    bad = (lines.where(F.col(CORRUPT).isNotNull() & read).withColumn("__t", text)
           .select(F.col("__t.c0").alias("first_value"), F.col(CORRUPT).alias("line"), reason.alias("reason"),
                   F.input_file_name().alias("file")))
    return rows, bad


def read_json_records(spark: SparkSession, path: str, schema: StructType | str,
                      date_column: str | None = None, start: str | None = None, end: str | None = None,
                      multiline: bool = False) -> DataFrame:
    """Landed API responses: JSON records (one per line, or arrays when
    ``multiline``), with an optional inclusive date range on ``date_column``
    (the request parameters of the original API call)."""
    df = spark.read.schema(schema).option("multiLine", multiline).json(path)
    if date_column and (start or end):
        d = F.col(date_column).try_cast("date")
        if start:
            df = df.where(d >= F.lit(start).cast("date"))
        if end:
            df = df.where(d <= F.lit(end).cast("date"))
    return df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
