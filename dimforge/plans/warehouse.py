"""The nine warehouse transforms: staged relation -> dimension / fact.

Each follows the same shape — clean, project, fill, dedupe, filter,
validate references — and returns a :class:`Built` with the valid rows
and, where references are checked, the rejected rows in quarantine layout.

``mode``:
    ``"compat"`` (default) matches the established warehouse: entity keys
    are compared by their numeric id only, so ``c:5`` and ``f:5`` meet.
    ``"strict"`` compares the typed key (prefix and id).

Survivor rule for every dedupe: newest ``updated_at``, then the largest
record id, then the remaining columns (see ``operators.dedupe``).
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge import functions as X
from dimforge.operators.cleaning import blank_to_null, drop_null_rows, fill_defaults
from dimforge.operators.dedupe import keep_one, keep_one_record
from dimforge.operators.refcheck import flag_matches, key_set, lookup, packed, quarantine, written


def _same(df: DataFrame) -> DataFrame:
    return df


@dataclass
class Built:
    """A transform's result.  ``classified`` holds every cleaned row with its
    check flags; ``valid`` and ``quarantine`` are projections of it, so a job
    can write ``classified`` once and split the written rows."""
    table: str
    classified: DataFrame
    key: str
    to_valid: Callable[[DataFrame], DataFrame] = _same
    to_quarantine: Callable[[DataFrame], DataFrame] | None = None

    @property
    def valid(self) -> DataFrame:
        return self.to_valid(self.classified)

    @property
    def quarantine(self) -> DataFrame | None:
        return None if self.to_quarantine is None else self.to_quarantine(self.classified)


def _check_mode(mode: str) -> None:
    if mode not in ("compat", "strict"):
        raise ValueError(f"mode must be 'compat' or 'strict', not {mode!r}")


class Keys:
    """The key sets of the two entity dimensions, each written once however
    many checks use it (transforms of one load share an instance)."""

    def __init__(self, company: DataFrame, people: DataFrame | None = None, mode: str = "compat"):
        self._dims = {"company": company, "people": people}
        self.mode = mode
        self._made: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        with self._lock:
            if name not in self._made:
                self._made[name] = make()
            return self._made[name]

    def _of(self, dim: str) -> DataFrame:
        cols = [f"{dim}_object_id"] if self.mode == "compat" else [f"{dim}_entity_type", f"{dim}_object_id"]
        return self._once(dim, lambda: key_set(self._dims[dim], *cols))

    def packed(self, name: str, *flags: str) -> DataFrame:
        """The set of that name, packed for the checks."""
        return self._once(f"{name} packed", lambda: packed(getattr(self, name)(), flags))

    def company(self) -> DataFrame:
        """compat: company ids; strict: typed company ids."""
        return self._of("company")

    def people(self) -> DataFrame:
        return self._of("people")

    def entities(self) -> DataFrame:
        """``(entity_type, object_id)`` of known entities, distinct.  compat:
        every company counts as type ``c`` and every person as ``p`` (whatever
        their own prefix), so the two written sets never meet; strict: each keeps
        its own prefix."""
        if self.mode == "compat":
            parts = [keys.select(F.lit(t).alias("entity_type"), F.col(keys.columns[0]).cast("int").alias("object_id"))
                     for t, keys in (("c", self.company()), ("p", self.people()))]
            return parts[0].unionByName(parts[1])
        both = self.company().toDF("entity_type", "object_id").unionByName(self.people().toDF("entity_type", "object_id"))
        return self._once("entities", lambda: key_set(both, "entity_type", "object_id"))

    def types_by_id(self) -> DataFrame:
        """``(object_id, has_c, has_p)``: which types a bare id has (compat)."""
        return self._once("types_by_id", lambda: written(self.entities().groupBy("object_id").agg(
            F.max(F.col("entity_type") == "c").alias("has_c"), F.max(F.col("entity_type") == "p").alias("has_p"))))


# ---------------------------------------------------------------- T1 company
def company_deduped(df: DataFrame, mode: str = "compat") -> DataFrame:
    """Cleaned, projected, filled and deduplicated companies (before the
    coordinate filter)."""
    d = blank_to_null(df)
    d = d.select(
        F.col("office_id").alias("company_id"),
        X.entity_prefix("object_id").alias("company_entity_type"),
        X.entity_id("object_id").alias("company_object_id"),
        X.clean_text("description").alias("description"),
        X.clean_text("address1").alias("address"),
        X.clean_text("region").alias("region"),
        "city",
        X.clean_text("zip_code").alias("zip_code"),
        "state_code", "country_code",
        X.to_decimal("latitude", 9, 6).alias("latitude"),
        X.to_decimal("longitude", 9, 6).alias("longitude"),
        X.parse_timestamp("created_at").alias("created_at"),
        X.parse_timestamp("updated_at").alias("updated_at"),
    )
    d = fill_defaults(d, {c: "Unknown" for c in (
        "description", "address", "region", "city", "zip_code", "state_code", "country_code")})
    keys = ["company_object_id"] if mode == "compat" else ["company_entity_type", "company_object_id"]
    return keep_one(d, keys, prefer=[F.col("updated_at"), F.col("company_id")])


def transform_company(df: DataFrame, mode: str = "compat") -> Built:
    _check_mode(mode)
    d = company_deduped(df, mode)
    # dedupe first, then the coordinate filter (a survivor with 0/NULL coordinates drops the key)
    d = d.where((F.col("latitude") != 0) & (F.col("longitude") != 0))
    return Built("dim_company", d, "company_id")


# ---------------------------------------------------------------- T2 people
def people_deduped(df: DataFrame) -> DataFrame:
    """Cleaned and deduplicated people (before the unknown-name filter)."""
    d = blank_to_null(df)
    d = d.select(
        "people_id",
        X.entity_prefix("object_id").alias("people_entity_type"),
        X.clean_integer(X.entity_id("object_id")).alias("people_object_id"),
        X.clean_alpha_text(X.full_name("first_name", "last_name")).alias("full_name"),
        X.fix_encoding("birthplace").alias("birthplace"),
        X.clean_alpha_text("affiliation_name").alias("affiliation_name"),
    )
    d = fill_defaults(d, {"full_name": "Unknown", "birthplace": "Unknown", "affiliation_name": "Unknown"})
    return keep_one(d, ["people_entity_type", "people_object_id"],
                    prefer=[F.col("people_id").try_cast("bigint"), F.col("people_id")])


def transform_people(df: DataFrame, company: DataFrame | None = None, mode: str = "compat") -> Built:
    _check_mode(mode)
    d = people_deduped(df)
    d = d.where(F.col("full_name") != "Unknown")
    if company is None:
        return Built("dim_people", d, "people_id")
    # optional: people must also be known companies (by id)
    on = ["people_object_id"] if mode == "compat" else ["people_entity_type", "people_object_id"]
    flagged = flag_matches(d, Keys(company, mode=mode).packed("company"), on, "in_company")
    return Built("dim_people", flagged, "people_id",
                 lambda c: c.where("in_company").drop("in_company"),
                 lambda c: quarantine(c.where(~F.col("in_company")), "people", "people_id", "people_entity_type",
                                      "people_object_id", reason="no match in dim_company"))


# ---------------------------------------------------------------- T3 milestones
def milestones_prepared(df: DataFrame) -> DataFrame:
    """Cleaned milestones, one per entity, with a non-NULL id (before the company check)."""
    d = blank_to_null(df, "", "NaN")
    d = d.select(
        "milestone_id",
        X.entity_prefix("object_id").alias("milestone_entity_type"),
        X.clean_integer(X.entity_id("object_id")).alias("milestone_object_id"),
        X.parse_date("milestone_at").alias("milestone_date"),
        X.clean_alpha_text("description").alias("description"),
        X.url_or_default("source_url").alias("source_url"),
        X.clean_alpha_text("source_description").alias("source_description"),
        X.parse_timestamp("created_at").alias("created_at"),
        X.parse_timestamp("updated_at").alias("updated_at"),
    )
    d = fill_defaults(d, {"source_url": "Unknown", "description": "No Description",
                          "source_description": "Unknown"})
    prefer = [F.col("updated_at"), F.col("milestone_id")]
    d = keep_one_record(d, "milestone_id", prefer)
    d = keep_one(d, ["milestone_entity_type", "milestone_object_id"], prefer)  # one milestone per entity
    return d.where(F.col("milestone_object_id").isNotNull())


def transform_milestones(df: DataFrame, company: DataFrame, mode: str = "compat",
                         keys: Keys | None = None) -> Built:
    _check_mode(mode)
    d = milestones_prepared(df)
    on = ["milestone_object_id"] if mode == "compat" else ["milestone_entity_type", "milestone_object_id"]
    flagged = flag_matches(d, (keys or Keys(company, mode=mode)).packed("company"), on, "in_company")
    return Built("dim_milestones", flagged, "milestone_id",
                 lambda c: c.where("in_company").drop("in_company"),
                 lambda c: quarantine(c.where(~F.col("in_company")), "milestones", "milestone_id",
                                      "milestone_entity_type", "milestone_object_id",
                                      reason="no match in dim_company"))


# ---------------------------------------------------------------- T4 acquisition
def _acquisition_clean(df: DataFrame) -> DataFrame:
    d = blank_to_null(df)
    d = d.select(
        "acquisition_id",
        X.entity_prefix("acquiring_object_id").alias("acquiring_entity_type"),
        X.entity_id("acquiring_object_id").alias("acquiring_object_id"),
        X.entity_prefix("acquired_object_id").alias("acquired_entity_type"),
        X.entity_id("acquired_object_id").alias("acquired_object_id"),
        X.to_decimal("price_amount", 15, 2).alias("price_amount"),
        "price_currency_code",
        X.parse_date("acquired_at").alias("acquired_at"),
        "source_url",
        X.parse_timestamp("created_at").alias("created_at"),
        X.parse_timestamp("updated_at").alias("updated_at"),
    )
    d = fill_defaults(d, {"price_amount": 0, "price_currency_code": "Unknown", "source_url": "Unknown"})
    d = keep_one_record(d, "acquisition_id", [F.col("updated_at")])
    d = d.where(F.col("price_amount") != 0)
    return drop_null_rows(d, ["acquired_at"])


def transform_acquisition(df: DataFrame, company: DataFrame, mode: str = "compat",
                          keys: Keys | None = None) -> Built:
    _check_mode(mode)
    d = _acquisition_clean(df)
    known = (keys or Keys(company, mode=mode)).packed("company")
    if mode == "compat":
        on_a, on_b = ["acquiring_object_id"], ["acquired_object_id"]
    else:
        on_a = ["acquiring_entity_type", "acquiring_object_id"]
        on_b = ["acquired_entity_type", "acquired_object_id"]
    flagged = flag_matches(flag_matches(d, known, on_a, "acquiring_ok"), known, on_b, "acquired_ok")
    ok = F.col("acquiring_ok") & F.col("acquired_ok")

    def to_valid(c: DataFrame) -> DataFrame:
        return c.where(ok).select(
            "acquisition_id", "acquiring_entity_type", "acquired_entity_type", "price_amount",
            "price_currency_code", "acquired_at", "source_url", "created_at", "updated_at",
            "acquiring_object_id", "acquired_object_id")

    def to_quarantine(c: DataFrame) -> DataFrame:
        reason = (F.when(~F.col("acquiring_ok") & ~F.col("acquired_ok"), "no match in dim_company: both sides")
                   .when(~F.col("acquiring_ok"), "no match in dim_company: acquiring")
                   .otherwise("no match in dim_company: acquired"))
        return quarantine(c.where(~ok), "acquisition", "acquisition_id", "acquiring_entity_type",
                          "acquiring_object_id", "acquired_entity_type", "acquired_object_id", reason)

    return Built("fact_acquisition", flagged, "acquisition_id", to_valid, to_quarantine)


# ---------------------------------------------------------------- T5 funding rounds
def _rounds_clean(df: DataFrame, mode: str = "compat") -> DataFrame:
    d = blank_to_null(df)
    d = d.select(
        "funding_round_id",
        X.entity_prefix("object_id").cast("string").alias("funding_entity_type"),
        X.entity_id("object_id").alias("funding_object_id"),
        F.col("funding_round_type").alias("round_type"),
        X.parse_date("funded_at").alias("funding_date"),
        F.col("raised_currency_code").alias("raised_currency"),
        "raised_amount", "raised_amount_usd",
        F.col("pre_money_currency_code").alias("pre_money_currency"),
        "pre_money_valuation", "pre_money_valuation_usd",
        F.col("post_money_currency_code").alias("post_money_currency"),
        "post_money_valuation", "post_money_valuation_usd",
        X.to_int("participants").alias("participants"),
        "source_url", "source_description",
        X.parse_timestamp("created_at").alias("created_at"),
        X.parse_timestamp("updated_at").alias("updated_at"),
    )
    d = fill_defaults(d, {"round_type": "Unknown", "raised_currency": "USD", "pre_money_currency": "USD",
                          "post_money_currency": "USD", "raised_amount_usd": 0,
                          "source_description": "Unknown", "source_url": "Unknown"})
    d = keep_one_record(d, "funding_round_id", [F.col("updated_at")])
    d = d.where(F.col("round_type") != "Unknown")
    if mode == "strict":
        return d
    return d.withColumn("funding_entity_type", X.normalize_entity_type("funding_entity_type"))


def transform_funding_rounds(df: DataFrame, company: DataFrame, people: DataFrame,
                             mode: str = "compat", keys: Keys | None = None) -> Built:
    _check_mode(mode)
    d = _rounds_clean(df, mode)
    known = (keys or Keys(company, people, mode)).packed("entities")
    flagged = flag_matches(d, known, ["funding_entity_type", "funding_object_id"], "entity_ok")

    def to_quarantine(c: DataFrame) -> DataFrame:
        reason = F.concat(F.lit("no match in "),
                          F.when(F.col("funding_entity_type") == "p", "dim_people").otherwise("dim_company"))
        return quarantine(c.where(~F.col("entity_ok")), "funding_rounds", "funding_round_id",
                          "funding_entity_type", "funding_object_id", reason=reason)

    return Built("dim_funding_rounds", flagged, "funding_round_id",
                 lambda c: c.where("entity_ok").drop("entity_ok"), to_quarantine)


# ---------------------------------------------------------------- T6 relationship
def relationship_prepared(df: DataFrame) -> DataFrame:
    """Cleaned relationships, one per relationship_id (before the checks)."""
    d = blank_to_null(df)
    d = d.select(
        "relationship_id",
        X.entity_prefix("person_object_id").alias("people_entity_type"),
        X.entity_id("person_object_id").alias("people_object_id"),
        X.entity_prefix("relationship_object_id").alias("relationship_entity_type"),
        X.entity_id("relationship_object_id").alias("relationship_object_id"),
        X.parse_date("start_at").alias("start_at"),
        X.parse_date("end_at").alias("end_at"),
        X.normalize_text("title").alias("title"),
        X.parse_timestamp("created_at").alias("created_at"),
        X.parse_timestamp("updated_at").alias("updated_at"),
    )
    d = fill_defaults(d, {"title": "Unknown"})
    return keep_one_record(d, "relationship_id", [F.col("updated_at")])


def transform_relationship(df: DataFrame, company: DataFrame, people: DataFrame,
                           mode: str = "compat", keys: Keys | None = None) -> Built:
    _check_mode(mode)
    d = relationship_prepared(df)
    keys = keys or Keys(company, people, mode)
    if mode == "compat":
        p_on, c_on = ["people_object_id"], ["relationship_object_id"]
    else:
        p_on = ["people_entity_type", "people_object_id"]
        c_on = ["relationship_entity_type", "relationship_object_id"]
    flagged = flag_matches(flag_matches(d, keys.packed("people"), p_on, "person_ok"), keys.packed("company"), c_on, "company_ok")
    ok = F.col("person_ok") & F.col("company_ok")

    def to_valid(c: DataFrame) -> DataFrame:
        return c.where(ok).select("people_object_id", "relationship_id", "people_entity_type",
                                  "relationship_entity_type", "relationship_object_id", "start_at", "end_at",
                                  "title", "created_at", "updated_at")

    def to_quarantine(c: DataFrame) -> DataFrame:
        reason = (F.when(~F.col("person_ok") & ~F.col("company_ok"), "no match in dim_people and dim_company")
                   .when(~F.col("person_ok"), "no match in dim_people")
                   .otherwise("no match in dim_company"))
        return quarantine(c.where(~ok), "relationship", "relationship_id", "people_entity_type",
                          "people_object_id", "relationship_entity_type", "relationship_object_id", reason)

    return Built("fact_relationship", flagged, "relationship_id", to_valid, to_quarantine)


# ---------------------------------------------------------------- T7 ipo
def ipo_prepared(df: DataFrame, mode: str = "compat") -> DataFrame:
    """Cleaned, filled, deduplicated IPOs (before the company filter and check).

    strict keeps a ticker without a market as the symbol; compat gives N/A."""
    d = blank_to_null(df)
    symbol = X.stock_symbol("stock_symbol")
    if mode == "strict":
        symbol = F.when(F.col("stock_symbol").contains(":"), symbol).otherwise(F.col("stock_symbol"))
    d = d.select(
        "ipo_id",
        X.entity_prefix("object_id").alias("ipo_entity_type"),
        X.entity_id("object_id").alias("ipo_object_id"),
        F.col("valuation_currency_code").alias("valuation_currency"),
        "valuation_amount",
        F.col("raised_currency_code").alias("raised_currency"),
        "raised_amount",
        X.parse_date("public_at").alias("public_at"),
        X.stock_market("stock_symbol").alias("stock_market"),
        symbol.alias("stock_symbol"),
        "source_url", "source_description",
        X.parse_timestamp("created_at").alias("created_at"),
        X.parse_timestamp("updated_at").alias("updated_at"),
    )
    d = fill_defaults(d, {"valuation_amount": 0, "valuation_currency": "USD", "raised_amount": 0,
                          "raised_currency": "USD", "stock_market": "N/A", "stock_symbol": "N/A",
                          "source_url": "Unknown", "source_description": "Unknown"})
    return keep_one_record(d, "ipo_id", [F.col("updated_at")])


def transform_ipo(df: DataFrame, company: DataFrame, mode: str = "compat",
                  keys: Keys | None = None) -> Built:
    _check_mode(mode)
    d = ipo_prepared(df, mode)
    is_company = F.coalesce(F.col("ipo_entity_type") == "c", F.lit(False))
    on = ["ipo_object_id"] if mode == "compat" else ["ipo_entity_type", "ipo_object_id"]
    flagged = flag_matches(d, (keys or Keys(company, mode=mode)).packed("company"), on, "in_company")
    ok = is_company & F.col("in_company")

    def to_quarantine(c: DataFrame) -> DataFrame:
        reason = F.when(~is_company, "not a company").otherwise("no match in dim_company")
        return quarantine(c.where(~ok), "ipo", "ipo_id", "ipo_entity_type", "ipo_object_id", reason=reason)

    return Built("fact_ipo", flagged, "ipo_id", lambda c: c.where(ok).drop("in_company"), to_quarantine)


# ---------------------------------------------------------------- T8 investments
def investments_prepared(df: DataFrame) -> DataFrame:
    """Deduplicated investments with parsed keys (before the checks)."""
    d = blank_to_null(df)
    d = keep_one_record(d, "investment_id", [X.parse_timestamp(F.col("updated_at"))])
    d = d.select(
        "investment_id",
        X.to_int("funding_round_id").alias("funding_round_id"),
        X.entity_prefix("funded_object_id").alias("funded_prefix"),
        X.entity_id("funded_object_id").alias("funded_object_id"),
        X.entity_prefix("investor_object_id").alias("investor_entity_type"),
        X.entity_id("investor_object_id").alias("investor_object_id"),
    )
    return d


def resolve_funded_type(d: DataFrame, company: DataFrame, people: DataFrame, keys: Keys | None = None) -> DataFrame:
    """Compat rule for the funded side: look the bare id up in companies and
    people; a company match wins.  Adds ``funded_entity_type`` (NULL when
    neither matches) — one join against the combined key set."""
    by_id = (keys or Keys(company, people)).packed("types_by_id", "has_c", "has_p")
    d = lookup(d, by_id, ["funded_object_id"], ["has_c", "has_p"])
    return (d.withColumn("funded_entity_type",
                         F.when(F.col("has_c"), F.lit("c")).when(F.col("has_p"), F.lit("p")))
             .drop("has_c", "has_p"))


def transform_investments(df: DataFrame, company: DataFrame, people: DataFrame, rounds: DataFrame,
                          mode: str = "compat", keys: Keys | None = None) -> Built:
    _check_mode(mode)
    d = investments_prepared(df)
    keys = keys or Keys(company, people, mode)
    typed = keys.packed("entities")
    if mode == "compat":
        d = resolve_funded_type(d, company, people, keys)
        d = d.withColumn("funded_ok", F.col("funded_entity_type").isNotNull())
    else:
        d = d.withColumn("funded_entity_type", F.col("funded_prefix"))
        d = flag_matches(d, typed, ["funded_entity_type", "funded_object_id"], "funded_ok")
    d = flag_matches(d, typed, ["investor_entity_type", "investor_object_id"], "investor_ok")
    d = flag_matches(d, packed(key_set(rounds, "funding_round_id")), ["funding_round_id"], "round_ok")
    ok = F.col("funded_ok") & F.col("investor_ok") & F.col("round_ok")

    def to_valid(c: DataFrame) -> DataFrame:
        return c.where(ok).select("funding_round_id", "investment_id", "funded_entity_type", "funded_object_id",
                                  "investor_entity_type", "investor_object_id")

    def to_quarantine(c: DataFrame) -> DataFrame:
        reason = (F.when(~F.col("funded_ok"), "funded entity not found")
                   .when(~F.col("investor_ok"), "investor not found")
                   .otherwise("no match in dim_funding_rounds"))
        return quarantine(c.where(~ok), "investments", "investment_id", "funded_prefix", "funded_object_id",
                          "investor_entity_type", "investor_object_id", reason)

    return Built("fact_investments", d, "investment_id", to_valid, to_quarantine)


# ---------------------------------------------------------------- T9 funds
def transform_funds(df: DataFrame, mode: str = "compat") -> Built:
    _check_mode(mode)
    d = blank_to_null(df)
    d = d.select(
        "fund_id",
        X.entity_prefix("object_id").alias("fund_entity_type"),
        X.entity_id("object_id").alias("fund_object_id"),
        F.col("name").alias("fund_name"),
        X.parse_date("funded_at").alias("funding_date"),
        F.col("raised_currency_code").alias("raised_currency"),
        "raised_amount", "source_url", "source_description",
        X.parse_timestamp("created_at").alias("created_at"),
        X.parse_timestamp("updated_at").alias("updated_at"),
    )
    d = fill_defaults(d, {"raised_currency": "USD", "raised_amount": 0, "source_url": "Unknown",
                          "source_description": "Unknown"})
    d = keep_one_record(d, "fund_id", [F.col("updated_at")])
    d = drop_null_rows(d, ["funding_date"])
    d = (d.withColumn("source_url", X.url_or_default("source_url"))
          .withColumn("source_description", X.clean_alpha_text("source_description")))
    return Built("dim_funds", d, "fund_id")
