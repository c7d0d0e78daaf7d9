"""Single-operator queries over the staged fixtures and base tables.

Each exercises one building block on whole relations, so it can be
checked on its own against the independent SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge import functions as X
from dimforge import schemas as S
from dimforge.operators import checks as C
from dimforge.operators.cleaning import blank_to_null, drop_null_rows, fill_defaults
from dimforge.operators.dedupe import distinct_keys, keep_one
from dimforge.operators.profile import profile, samples
from dimforge.operators.refcheck import keep_matching, keep_missing, key_set, typed_key_set
from dimforge.operators.upsert import merge
from dimforge.plans import warehouse as W
from dimforge.plans.catalog import QUERIES, WAREHOUSE_TABLES, Warehouse, query
from dimforge.plans.fixtures import STAGED, fixture, register_base_tables, staged
from dimforge.sinks import tables as T
from dimforge.sources.files import read_csv, read_json_records
from dimforge.sources.jdbc import extract_all
from dimforge.session import scratch_path

# (fixture, column) pairs that hold prefixed entity keys
KEY_COLUMNS = [("st_company", "object_id"), ("st_people", "object_id"),
               ("st_acquisition", "acquiring_object_id"), ("st_acquisition", "acquired_object_id"),
               ("st_funding_rounds", "object_id"), ("st_investments", "funded_object_id"),
               ("st_investments", "investor_object_id"), ("st_relationship", "person_object_id"),
               ("st_relationship", "relationship_object_id"), ("st_ipo", "object_id"),
               ("st_funds", "object_id"), ("st_milestones", "object_id")]


def key_strings(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for fx, col in KEY_COLUMNS:
        part = fixture(spark, d, fx).select(F.lit(f"{fx}.{col}").alias("source"), F.col(col).alias("raw"))
        out = part if out is None else out.unionByName(part)
    return out


def documents(spark: SparkSession, d: str) -> DataFrame:
    register_base_tables(spark, d, ("documents",))
    return spark.table("documents")


# ------------------------------------------------------------------ U1-U9 scalar functions
@query("entity_prefix")
def q_entity_prefix(spark, d):
    return key_strings(spark, d).select("source", "raw", X.entity_prefix("raw").alias("entity_type"))


@query("entity_id")
def q_entity_id(spark, d):
    return key_strings(spark, d).select("source", "raw", X.entity_id("raw").alias("object_id"))


@query("clean_integer")
def q_clean_integer(spark, d):
    return key_strings(spark, d).select("source", "raw", X.clean_integer("raw", "string").alias("object_id"))


@query("stock_market")
def q_stock_market(spark, d):
    return fixture(spark, d, "ipo").select("ipo_id", X.stock_market("stock_symbol").alias("stock_market"))


@query("stock_symbol")
def q_stock_symbol(spark, d):
    return fixture(spark, d, "ipo").select("ipo_id", X.stock_symbol("stock_symbol").alias("stock_symbol"))


def _doc_fn(fn, name):
    def q(spark, d):
        return documents(spark, d).select("doc_id", fn("text").alias(name))
    return q


QUERIES["clean_text"] = _doc_fn(X.clean_text, "clean_text")
QUERIES["normalize_text"] = _doc_fn(X.normalize_text, "normalize_text")
QUERIES["clean_alpha_text"] = _doc_fn(X.clean_alpha_text, "clean_alpha_text")
QUERIES["fix_encoding"] = _doc_fn(X.fix_encoding, "fix_encoding")


@query("clean_text_company")
def q_clean_text_company(spark, d):
    c = fixture(spark, d, "company")
    return c.select("office_id", *[X.clean_text(n).alias(n) for n in ("description", "address1", "zip_code",
                                                                        "region")])


# ------------------------------------------------------------------ P1-P15 projections, casts, nulls
@query("project_rename")
def q_project_rename(spark, d):
    return fixture(spark, d, "ipo").select(
        "ipo_id", F.col("object_id").alias("ipo_object_key"),
        F.col("valuation_currency_code").alias("valuation_currency"),
        F.col("raised_currency_code").alias("raised_currency"))


@query("empty_to_null")
def q_empty_to_null(spark, d):
    return blank_to_null(fixture(spark, d, "company"))


@query("nan_to_null")
def q_nan_to_null(spark, d):
    return blank_to_null(fixture(spark, d, "milestones"), "", "NaN")


@query("cast_decimal")
def q_cast_decimal(spark, d):
    a = fixture(spark, d, "acquisition")
    return a.select("acquisition_id", X.to_decimal("price_amount", 7, 2).alias("price_7_2"),
                    X.to_decimal(F.col("acquisition_id").cast("string"), 9, 6).alias("id_9_6"))


@query("cast_int")
def q_cast_int(spark, d):
    r = fixture(spark, d, "relationship")
    return r.select("relationship_id", X.to_int("relationship_id").alias("relationship_int"),
                    X.to_int("sequence").alias("sequence_int"), X.to_int("title").alias("title_int"))


@query("parse_date")
def q_parse_date(spark, d):
    r = fixture(spark, d, "relationship")
    return r.select("relationship_id", X.parse_date("start_at").alias("start_date"),
                    X.parse_date("end_at").alias("end_date"), X.parse_date("title").alias("title_date"))


@query("parse_timestamp")
def q_parse_timestamp(spark, d):
    r = fixture(spark, d, "relationship")
    return r.select("relationship_id", X.parse_timestamp("created_at").alias("created_ts"),
                    X.parse_timestamp("end_at").alias("end_ts"))


@query("fill_defaults")
def q_fill_defaults(spark, d):
    i = blank_to_null(fixture(spark, d, "ipo"))
    return fill_defaults(i, {"valuation_amount": 0, "valuation_currency_code": "USD", "raised_amount": 0,
                             "raised_currency_code": "USD", "source_url": "Unknown", "public_at": "1970-01-01"})


@query("drop_null_rows")
def q_drop_null_rows(spark, d):
    return drop_null_rows(fixture(spark, d, "acquisition"), ["acquired_at", "price_amount"])


@query("full_name")
def q_full_name(spark, d):
    p = blank_to_null(fixture(spark, d, "people"))
    return p.select("people_id", X.full_name("first_name", "last_name").alias("full_name"))


@query("normalize_entity_type")
def q_normalize_entity_type(spark, d):
    r = blank_to_null(fixture(spark, d, "funding_rounds"))
    return r.select("funding_round_id", X.normalize_entity_type(X.entity_prefix("object_id")).alias("entity_type"))


@query("valid_url")
def q_valid_url(spark, d):
    m = fixture(spark, d, "milestones")
    return m.select("milestone_id", X.url_or_default("source_url").alias("source_url"))


# ------------------------------------------------------------------ F1-F7 filters
@query("filter_geo")
def q_filter_geo(spark, d):
    return fixture(spark, d, "company").where((F.col("latitude") != 0) & (F.col("longitude") != 0))


@query("filter_neq")
def q_filter_neq(spark, d):
    return fixture(spark, d, "acquisition").where(F.col("price_amount") != 0)


@query("filter_eq")
def q_filter_eq(spark, d):
    return fixture(spark, d, "ipo").where(X.entity_prefix("object_id") == "c")


@query("filter_notnull")
def q_filter_notnull(spark, d):
    return fixture(spark, d, "acquisition").where(F.col("acquired_at").isNotNull() & F.col("price_amount").isNotNull())


@query("filter_null_or")
def q_filter_null_or(spark, d):
    return fixture(spark, d, "acquisition").where(F.col("acquired_at").isNull() | F.col("price_amount").isNull())


@query("filter_date_range")
def q_filter_date_range(spark, d):
    m = fixture(spark, d, "milestones")
    return m.where(X.parse_date("milestone_at").between(F.lit("2024-01-08").cast("date"),
                                                        F.lit("2024-01-21").cast("date")))


# ------------------------------------------------------------------ J1-J8 joins
def _company(spark, d) -> DataFrame:
    return Warehouse(spark, d).get("dim_company").valid


@query("fk_valid_milestones")
def q_fk_valid_milestones(spark, d):
    m = W.milestones_prepared(fixture(spark, d, "milestones"))
    return keep_matching(m, key_set(_company(spark, d), "company_object_id"), ["milestone_object_id"])


@query("fk_invalid_milestones")
def q_fk_invalid_milestones(spark, d):
    m = W.milestones_prepared(fixture(spark, d, "milestones"))
    return keep_missing(m, key_set(_company(spark, d), "company_object_id"), ["milestone_object_id"])


@query("fk_valid_ipo")
def q_fk_valid_ipo(spark, d):
    i = W.ipo_prepared(fixture(spark, d, "ipo")).where(F.col("ipo_entity_type") == "c")
    return keep_matching(i, key_set(_company(spark, d), "company_object_id"), ["ipo_object_id"])


@query("fk_invalid_ipo")
def q_fk_invalid_ipo(spark, d):
    i = W.ipo_prepared(fixture(spark, d, "ipo")).where(F.col("ipo_entity_type") == "c")
    return keep_missing(i, key_set(_company(spark, d), "company_object_id"), ["ipo_object_id"])


QUERIES["fk_two_sided_acquisition"] = QUERIES["fact_acquisition"]
QUERIES["fk_relationship"] = QUERIES["fact_relationship"]
QUERIES["poly_fk_funding"] = QUERIES["dim_funding_rounds"]


@query("poly_fk_untyped")
def q_poly_fk_untyped(spark, d):
    wh = Warehouse(spark, d)
    i = W.investments_prepared(wh.rows("investments"))
    r = W.resolve_funded_type(i, wh.get("dim_company").valid, wh.get("dim_people").valid)
    return r.select("investment_id", "funded_object_id", "funded_entity_type")


@query("poly_fk_typed_investor")
def q_poly_fk_typed_investor(spark, d):
    wh = Warehouse(spark, d)
    i = W.investments_prepared(wh.rows("investments"))
    typed = typed_key_set(c=(wh.get("dim_company").valid, "company_object_id"),
                          p=(wh.get("dim_people").valid, "people_object_id"))
    return keep_matching(i, typed, ["investor_entity_type", "investor_object_id"]).select(
        "investment_id", "investor_entity_type", "investor_object_id")


@query("fk_funding_round")
def q_fk_funding_round(spark, d):
    wh = Warehouse(spark, d)
    i = W.investments_prepared(wh.rows("investments"))
    return keep_matching(i, key_set(wh.get("dim_funding_rounds").valid, "funding_round_id"),
                         ["funding_round_id"]).select("investment_id", "funding_round_id")


# ------------------------------------------------------------------ D1-D5 dedupe, distinct, union
@query("dedupe_company")
def q_dedupe_company(spark, d):
    return W.company_deduped(fixture(spark, d, "company"))


@query("dedupe_company_strict")
def q_dedupe_company_strict(spark, d):
    return W.company_deduped(fixture(spark, d, "company"), mode="strict")


@query("dedupe_people")
def q_dedupe_people(spark, d):
    return W.people_deduped(fixture(spark, d, "people"))


@query("dedupe_milestones_entity")
def q_dedupe_milestones_entity(spark, d):
    return W.milestones_prepared(fixture(spark, d, "milestones"))


@query("dedupe_relationship")
def q_dedupe_relationship(spark, d):
    return W.relationship_prepared(Warehouse(spark, d).rows("relationship"))


@query("dedupe_lineitem")
def q_dedupe_lineitem(spark, d):
    register_base_tables(spark, d, ("lineitem",))
    li = spark.table("lineitem")
    return keep_one(li, ["l_orderkey", "l_linenumber"], prefer=[F.col("l_shipdate")])


@query("distinct_keys")
def q_distinct_keys(spark, d):
    r = fixture(spark, d, "relationship")
    return distinct_keys(r.select(X.entity_id("relationship_object_id").alias("object_id")), "object_id")


@query("union_by_name")
def q_union_by_name(spark, d):
    wh = Warehouse(spark, d)
    return typed_key_set(c=(wh.get("dim_company").valid, "company_object_id"),
                         p=(wh.get("dim_people").valid, "people_object_id"))


# ------------------------------------------------------------------ A1-A7 profiling
@query("profile_counts")
def q_profile_counts(spark, d):
    out = None
    for name, df in staged(spark, d).items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))
        out = part if out is None else out.unionByName(part)
    return out


@query("distinct_count")
def q_distinct_count(spark, d):
    return profile(fixture(spark, d, "relationship"), "relationship").select(
        "table_name", "column_name", "unique_count")


def _profile_query(name):
    return lambda spark, d: profile(fixture(spark, d, name), name)


for _name in STAGED:
    QUERIES[f"profile_{_name}"] = _profile_query(_name)


def _profile_base(table):
    def q(spark, d):
        register_base_tables(spark, d, (table,))
        return profile(spark.table(table), table, stored=True)
    return q


for _t in ("orders", "lineitem", "customer", "events"):
    QUERIES[f"profile_{_t}"] = _profile_base(_t)


@query("profile_samples")
def q_profile_samples(spark, d):
    return samples(fixture(spark, d, "company"), "company").unionByName(
        samples(fixture(spark, d, "funding_rounds"), "funding_rounds"))


@query("profile_all")
def q_profile_all(spark, d):
    out = None
    for name, df in staged(spark, d).items():
        p = profile(df, name)
        out = p if out is None else out.unionByName(p)
    return out


# ------------------------------------------------------------------ C1-C5 declared constraints
def _with_entities(spark, d) -> Warehouse:
    wh = Warehouse(spark, d)
    for dim in ("dim_company", "dim_people"):
        wh.entity(dim)
    return wh


def _warehouse(spark, d) -> dict[str, DataFrame]:
    wh = _with_entities(spark, d)
    return {t: wh.get(t).valid for t in WAREHOUSE_TABLES}


@query("check_not_null")
def q_check_not_null(spark, d):
    tb = _warehouse(spark, d)
    return C.union_all([C.not_null(tb[t], t, cols) for t, cols in S.NOT_NULL.items()])


@query("check_unique")
def q_check_unique(spark, d):
    tb = _warehouse(spark, d)
    return C.union_all([C.unique(tb[t], t, k) for t, ks in S.UNIQUE.items() for k in ks])


@query("check_length")
def q_check_length(spark, d):
    tb = _warehouse(spark, d)
    return C.union_all([C.max_length(tb[t], t, b) for t, b in S.MAX_LENGTH.items()])


@query("check_decimal")
def q_check_decimal(spark, d):
    tb = _warehouse(spark, d)
    return C.union_all([C.numeric_fits(tb[t], t, cols) for t, cols in S.NUMERIC_15_2.items()])


@query("check_fk")
def q_check_fk(spark, d):
    wh = _with_entities(spark, d)
    for _, _, table, column in S.FOREIGN_KEYS:
        wh.keys_of(table, column)
    tables = {t: wh.get(t).valid for t, _, _, _ in S.FOREIGN_KEYS}
    return C.foreign_keys(tables, S.FOREIGN_KEYS, lambda table, column: wh.keys_of(table, column))


# ------------------------------------------------------------------ S1/S5/S6 sources, K1/K2 sinks
def _scratch(spark, *parts) -> str:
    import uuid
    return scratch_path(spark, "dimforge", *parts, uuid.uuid4().hex)


@query("src_csv")
def q_src_csv(spark, d):
    path = _scratch(spark, "csv_people")
    fixture(spark, d, "people").write.option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path)


@query("src_json_records")
def q_src_json_records(spark, d):
    path = _scratch(spark, "json_milestones")
    fixture(spark, d, "milestones").write.json(path)
    return read_json_records(spark, path, S.staged_schema("milestones"), "milestone_at", "2024-01-08",
                             "2024-01-21")


@query("src_all_tables")
def q_src_all_tables(spark, d):
    root = _scratch(spark, "staging")
    for name, df in staged(spark, d).items():
        T.write_table(df, f"{root}/{name}")
    tables = extract_all(list(STAGED) + ["not_staged"], lambda n: T.read_parquet_checked(spark, f"{root}/{n}"))
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


@query("sink_overwrite")
def q_sink_overwrite(spark, d):
    path = _scratch(spark, "sink")
    f = fixture(spark, d, "funds")
    T.write_table(f, path)
    T.write_table(f, path, mode="overwrite")
    return spark.read.parquet(path)


@query("sink_append")
def q_sink_append(spark, d):
    path = _scratch(spark, "sink")
    f = fixture(spark, d, "funds")
    T.write_table(f, path)
    T.write_table(f, path, mode="append")
    return spark.read.parquet(path)


def _funds_incoming(spark, d) -> DataFrame:
    f = keep_one(blank_to_null(fixture(spark, d, "funds")), ["fund_id"], [F.col("updated_at")])
    return f.select("fund_id", F.col("name").alias("fund_name"), F.lit("EUR").alias("raised_currency"),
                    (F.col("raised_amount") * 2).cast("decimal(15,2)").alias("raised_amount"))


@query("upsert_merge")
def q_upsert_merge(spark, d):
    target = W.transform_funds(fixture(spark, d, "funds")).valid
    return merge(target, _funds_incoming(spark, d), "fund_id")


@query("upsert_versioned")
def q_upsert_versioned(spark, d):
    path = _scratch(spark, "dim_funds")
    T.upsert(W.transform_funds(fixture(spark, d, "funds")).valid, path, "fund_id")
    T.upsert(_funds_incoming(spark, d), path, "fund_id")
    return T.read_table(spark, path)


# ------------------------------------------------------------------ T10-T12 jobs
@query("stage_all")
def q_stage_all(spark, d):
    from dimforge.plans.jobs import stage_all
    root = _scratch(spark, "stage_job")
    stage_all(spark, d, root)
    return extract_counts(spark, root)


def extract_counts(spark, root) -> DataFrame:
    out = None
    for name in STAGED:
        part = spark.read.parquet(f"{root}/{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


@query("profile_job")
def q_profile_job(spark, d):
    from dimforge.plans.jobs import profile_all, stage_all
    root = _scratch(spark, "profile_job")
    stage_all(spark, d, f"{root}/staging")
    return profile_all(spark, f"{root}/staging", f"{root}/data_profiling").drop("sample_values")


@query("warehouse_counts")
def q_warehouse_counts(spark, d):
    from dimforge.plans.jobs import build_warehouse, stage_all, warehouse_table_counts
    root = _scratch(spark, "warehouse_job")
    stage_all(spark, d, f"{root}/staging")
    build_warehouse(spark, f"{root}/staging", f"{root}/warehouse", enforce=False)
    return warehouse_table_counts(spark, f"{root}/warehouse")


# ------------------------------------------------------------------ K3/K4/K6 dead letter, run log, profile JSON
@query("dead_letter")
def q_dead_letter(spark, d):
    """A load that fails (key column missing) leaves its rows, with the
    error text and time, in the dead-letter table."""
    path = _scratch(spark, "dead_letter")
    rows = fixture(spark, d, "funds")
    try:
        T.upsert(rows, _scratch(spark, "never"), "fund_key")
    except ValueError as e:
        T.dead_letter(rows, path, str(e))
    return spark.read.parquet(path).drop("etl_date")


@query("etl_log")
def q_etl_log(spark, d):
    from dimforge.plans.jobs import stage_all
    root = _scratch(spark, "log_job")
    stage_all(spark, d, f"{root}/staging", f"{root}/etl_logs")
    return spark.read.parquet(f"{root}/etl_logs").drop("etl_date")


@query("profile_json")
def q_profile_json(spark, d):
    from dimforge.plans.jobs import profile_all, stage_all
    root = _scratch(spark, "json_job")
    stage_all(spark, d, f"{root}/staging")
    profile_all(spark, f"{root}/staging", f"{root}/data_profiling")
    doc = spark.read.json(f"{root}/data_profiling/json")
    r = doc.select("profiling_result.*")
    return r.select("table_name", "format_file", "n_rows", F.col("n_cols").cast("int").alias("n_cols"),
                    F.size(F.map_keys(F.from_json(F.to_json("report"), "map<string,string>"))).alias("n_report"))


# ------------------------------------------------------------------ strict keys, optional people check
@query("dim_company_strict")
def q_dim_company_strict(spark, d):
    return W.transform_company(fixture(spark, d, "company"), mode="strict").valid


@query("fact_acquisition_strict")
def q_fact_acquisition_strict(spark, d):
    company = W.transform_company(fixture(spark, d, "company"), mode="strict").valid
    return W.transform_acquisition(fixture(spark, d, "acquisition"), company, mode="strict").valid


@query("dim_people_company_check")
def q_dim_people_company_check(spark, d):
    company = Warehouse(spark, d).get("dim_company").valid
    return W.transform_people(fixture(spark, d, "people"), company).valid


def _funds_batch(spark, d) -> DataFrame:
    """The clean funds, a second row for every key (a longer name), and every row again without its key."""
    f = W.transform_funds(fixture(spark, d, "funds")).valid
    longer = f.withColumn("fund_name", F.concat("fund_name", F.lit("~")))
    return f.unionByName(longer).unionByName(f.withColumn("fund_id", F.lit(None).cast(f.schema["fund_id"].dataType)))


@query("upsert_rerun")
def q_upsert_rerun(spark, d):
    """One batch with NULL and repeated keys, loaded three times: one row per key."""
    path = _scratch(spark, "dim_funds")
    for _ in range(3):
        T.upsert(_funds_batch(spark, d), path, "fund_id")
    return T.read_table(spark, path)


@query("col_defaults")
def q_col_defaults(spark, d):
    """Columns the incoming rows lack take their load-time default on insert,
    and keep their old value on update."""
    path = _scratch(spark, "dim_funds")
    defaults = {"source_description": F.lit("none given")}
    T.upsert(W.transform_funds(fixture(spark, d, "funds")).valid.drop("source_description"), path, "fund_id", defaults)
    new = _funds_incoming(spark, d)
    T.upsert(new.unionByName(new.withColumn("fund_id", F.concat(F.lit("n"), "fund_id"))), path, "fund_id",
             {"source_description": F.lit("second load")})
    return T.read_table(spark, path)


@query("upsert_rejected")
def q_upsert_rejected(spark, d):
    """The rows of that batch that are not merged, with their reason."""
    from dimforge.operators.upsert import split_incoming
    return split_incoming(_funds_batch(spark, d), "fund_id")[1].select("fund_id", "fund_name", "reason")
