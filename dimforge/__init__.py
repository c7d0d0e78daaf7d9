"""dimforge — a Spark-native toolkit for building a dimensional warehouse
from messy multi-source entity data (companies, people, funds and the money
that moves between them).

Layout:
    functions/  column expressions (key parsing, text cleaning, safe casts)
    operators/  DataFrame -> DataFrame building blocks (cleaning, dedupe,
                reference checks, profiling, constraint checks, upsert)
    sources/    readers (CSV, JSON, Parquet, JDBC, staged-layer extract)
    sinks/      writers (tables, run log, quarantine, dead letter, profile JSON)
    plans/      the staged fixtures and the nine warehouse transforms + jobs
"""

__version__ = "0.1.0"
