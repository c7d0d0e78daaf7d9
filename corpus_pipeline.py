"""Corpus pipeline: five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run``
writes each result as Parquet into the shared checkpoint folder and reads it
back as the next stage's documents, as the check tool does.  All stages but
the last return the columns of ``documents``.

1. quality rules: documents that the rules reject go;
2. SimHash near-dedup: one document of each group stays (smallest doc_id);
3. suffix-array dedup: bytes under a 100-byte string that starts earlier go
   (a character goes if all its bytes do); ``n_chars`` is counted anew;
4. benchmark decontamination: documents that contain a benchmark item go;
5. BPE encoding and decoding: token ids and decoded text of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm import bpe, decontamination, quality_rules, simhash, suffix_dedup
from dimforge.llm._common import Scratch, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, size=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(docs, characters=True)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept").cast("string"))
    new = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    return done.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, bpe.tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_bytes),
    ("benchmark_decontamination", benchmark_leaks),
    ("bpe", tokens),
]

#: SimHash components and byte-wise suffix matches are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
