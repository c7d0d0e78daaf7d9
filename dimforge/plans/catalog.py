"""Named queries: each takes ``(spark, data_dir)`` and returns a DataFrame
built from the driver's base tables (through the staged fixtures)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimforge.operators.refcheck import key_set, written
from dimforge.plans import warehouse as W
from dimforge.plans.fixtures import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


class Warehouse:
    """Lazily built transforms over one data dir (dims are shared plans).
    Queries over several tables first write what these share (``entity``,
    ``keys_of``), as ``jobs.build_warehouse`` does; the tables then read it."""

    def __init__(self, spark: SparkSession, data_dir: str, mode: str = "compat"):
        self.st = staged(spark, data_dir)
        self.mode = mode
        self._cache: dict[str, W.Built] = {}
        self._keys: W.Keys | None = None
        self._rows: dict[str, DataFrame] = {}
        self._sets: dict[tuple[str, str], DataFrame] = {}

    def keys_of(self, table: str, column: str) -> DataFrame:
        """The distinct non-NULL values of a referenced column, written once."""
        if (table, column) not in self._sets:
            self._sets[table, column] = key_set(self.get(table).valid, column)
        return self._sets[table, column]

    def rows(self, name: str) -> DataFrame:
        """A staged relation whose recipe shuffles, written once (its transform reads it twice)."""
        if name not in self._rows:
            self._rows[name] = written(self.st[name])
        return self._rows[name]

    def entity(self, name: str) -> W.Built:
        """A dimension with its valid rows written; call it before what refers to it."""
        built = self.get(name)
        self._cache[name] = W.Built(built.table, written(built.valid), built.key)
        return self._cache[name]

    def get(self, name: str) -> W.Built:
        if name not in self._cache:
            self._cache[name] = self._build(name)
        return self._cache[name]

    def _build(self, name: str) -> W.Built:
        st, m = self.st, self.mode
        if name == "dim_company":
            return W.transform_company(st["company"], mode=m)
        if name == "dim_people":
            return W.transform_people(st["people"], mode=m)
        company, people = self.get("dim_company").valid, self.get("dim_people").valid
        if self._keys is None:
            self._keys = W.Keys(company, people, m)
        k = self._keys
        if name == "dim_milestones":
            return W.transform_milestones(st["milestones"], company, mode=m, keys=k)
        if name == "fact_acquisition":
            return W.transform_acquisition(st["acquisition"], company, mode=m, keys=k)
        if name == "fact_ipo":
            return W.transform_ipo(st["ipo"], company, mode=m, keys=k)
        if name == "dim_funding_rounds":
            return W.transform_funding_rounds(st["funding_rounds"], company, people, mode=m, keys=k)
        if name == "fact_relationship":
            return W.transform_relationship(self.rows("relationship"), company, people, mode=m, keys=k)
        if name == "fact_investments":
            rounds = self._sets.get(("dim_funding_rounds", "funding_round_id"))
            rounds = self.get("dim_funding_rounds").valid if rounds is None else rounds
            return W.transform_investments(self.rows("investments"), company, people, rounds, mode=m, keys=k)
        if name == "dim_funds":
            return W.transform_funds(st["funds"], mode=m)
        raise KeyError(name)


WAREHOUSE_TABLES = ("dim_company", "dim_people", "dim_milestones", "fact_acquisition", "dim_funding_rounds",
                    "fact_relationship", "fact_ipo", "fact_investments", "dim_funds")
QUARANTINED = {"dim_milestones": "milestones", "fact_acquisition": "acquisition",
               "dim_funding_rounds": "funding_rounds", "fact_relationship": "relationship",
               "fact_ipo": "ipo", "fact_investments": "investments"}


def _table_query(t: str):
    return lambda spark, d: Warehouse(spark, d).get(t).valid


def _quarantine_query(t: str):
    return lambda spark, d: Warehouse(spark, d).get(t).quarantine


for _t in WAREHOUSE_TABLES:
    QUERIES[_t] = _table_query(_t)
for _t, _q in QUARANTINED.items():
    QUERIES[f"quarantine_{_q}"] = _quarantine_query(_t)


def _strict_query(t: str):
    return lambda spark, d: Warehouse(spark, d, mode="strict").get(t).valid


for _t in ("dim_milestones", "fact_relationship", "fact_ipo", "dim_funding_rounds", "fact_investments"):
    QUERIES[f"{_t}_strict"] = _strict_query(_t)
