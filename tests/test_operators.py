"""Dedupe, reference checks, cleaning, upsert, checks: properties and small cases."""

import decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from dimforge.operators import checks as C
from dimforge.operators.cleaning import blank_to_null, drop_null_rows, fill_defaults
from dimforge.operators.dedupe import distinct_keys, keep_one
from dimforge.operators.refcheck import flag_matches, keep_matching, keep_missing, key_set, split
from dimforge.operators.upsert import merge
from dimforge.plans.catalog import Warehouse
from dimforge.plans.fixtures import fixture


def test_keep_one_partition_independent(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    a = keep_one(li.repartition(7), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate")])
    b = keep_one(li.repartition(3, "l_partkey"), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate")])
    assert a.count() == b.count() == li.select("l_orderkey", "l_linenumber").distinct().count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.groupBy("l_orderkey", "l_linenumber").count().where("count > 1").count() == 0


def test_keep_one_survivor_brute_force(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    got = keep_one(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate")]).toPandas()
    pdf = li.toPandas()
    rest = [c for c in pdf.columns if c not in ("l_orderkey", "l_linenumber")]
    order = ["l_shipdate"] + rest
    want = (pdf.sort_values(order, ascending=False, na_position="first")
               .drop_duplicates(["l_orderkey", "l_linenumber"], keep="first"))
    key = ["l_orderkey", "l_linenumber"]
    m = got.merge(want, on=key, suffixes=("_g", "_w"))
    assert len(m) == len(want) == len(got)
    for c in rest:
        assert (m[f"{c}_g"] == m[f"{c}_w"]).all(), c


def test_keep_one_hot_key(spark):
    # one key holds a third of the rows; the result must still be exact
    df = spark.range(30000).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))).alias("k"),
                                   F.col("id").alias("v"))
    out = keep_one(df, ["k"], [F.col("v")])
    assert out.count() == df.select("k").distinct().count()
    assert out.where("k = 0").first().v == 29997


def test_keep_one_null_key_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 5), (1, 2)], "k int, v int")
    got = {r.k: r.v for r in keep_one(df, ["k"], [F.col("v")]).collect()}
    assert got == {None: 5, 1: 2}


def test_blank_fill_drop(spark):
    df = spark.createDataFrame([("", "NaN", None), ("x", "y", decimal.Decimal("1.5"))], "a string, b string, c decimal(15,2)")
    b = blank_to_null(df, "", "NaN")
    assert [tuple(r) for r in b.collect()][0] == (None, None, None)
    f = fill_defaults(b, {"a": "U", "c": 0})
    assert f.schema["c"].dataType.simpleString() == "decimal(15,2)"
    assert drop_null_rows(b, ["a"]).count() == 1


def test_valid_and_quarantine_partition_input(spark):
    wh = Warehouse(spark, SF_SMALL)
    for t in ("fact_acquisition", "fact_relationship", "fact_ipo", "fact_investments", "dim_milestones",
              "dim_funding_rounds"):
        b = wh.get(t)
        n = b.classified.count()
        assert b.valid.count() + b.quarantine.count() == n, t
        assert b.valid.select(b.key).distinct().count() == b.valid.count(), t


def test_semi_anti_flags_agree(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (3,)], "k int")
    dim = spark.createDataFrame([(1,), (1,), (3,), (None,)], "d int")
    keys = key_set(dim, "d")
    assert sorted(r.k for r in keep_matching(fact, keys, ["k"]).collect()) == [1, 3]
    assert sorted((r.k is None, r.k) for r in keep_missing(fact, keys, ["k"]).collect()) == [(False, 2), (True, None)]
    flagged = flag_matches(fact, keys, ["k"], "ok")
    good, bad = split(flagged, "ok")
    assert good.count() == 2 and bad.count() == 2 and flagged.count() == 4
    assert distinct_keys(dim, "d").count() == 2


def test_merge_semantics(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    incoming = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    out = {r.k: (r.v, r.w) for r in merge(target, incoming, "k").collect()}
    assert out == {1: ("a", "x"), 2: (None, "y"), 3: ("c", None)}
    again = merge(merge(target, incoming, "k"), incoming, "k")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, merge(target, incoming, "k").collect()), key=str)


def test_checks(spark):
    df = spark.createDataFrame([(1, "abc", 1.0), (1, None, 12345678901234.0), (2, "abcdef", None)],
                               "k int, s string, m double")
    assert C.not_null(df, "t", ["s"]).first().violations == 1
    assert C.unique(df, "t", "k").first().violations == 1
    assert C.max_length(df, "t", {"s": 3}).first().violations == 1
    assert C.numeric_fits(df, "t", ["m"]).first().violations == 1
    ref = spark.createDataFrame([(1,)], "k int")
    assert C.foreign_key(df, "t", "k", ref, "k").first().violations == 1


def test_flag_matches_hot_key_sort_merge(spark):
    """A foreign key holding a third of the rows, with broadcast disabled
    (sort-merge join, AQE skew handling): flags stay exact."""
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(60000).select(F.col("id").alias("fid"),
                                         F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
                                          .cast("int").alias("k"))
        dim = spark.range(0, 1000, 2).select(F.col("id").cast("int").alias("d"))
        flagged = flag_matches(fact, key_set(dim, "d"), ["k"], "ok")
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        got = flagged.groupBy("ok").count().collect()
        want_ok = fact.where((F.col("k") % 2) == 0).count()
        assert {r.ok: r["count"] for r in got} == {True: want_ok, False: 60000 - want_ok}
        assert flagged.count() == 60000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_hot_key_is_split(spark):
    """80 % of the fact on one key, no broadcast: AQE splits the hot partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    prev = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 400000, 1, 8).select(
            F.col("id").alias("fid"), F.when(F.col("id") % 5 != 0, 7).otherwise(F.col("id") % 1000).cast("int").alias("k"))
        flagged = flag_matches(fact, key_set(spark.range(1000).select(F.col("id").cast("int").alias("d")), "d"), ["k"], "ok")
        assert len(flagged.where("ok").select("fid", "ok").toPandas()) == 400000
        rows = flagged.select("fid", "ok")
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_split_incoming(spark):
    from dimforge.operators.upsert import split_incoming
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, None), (2, None), (3, "c"), (None, "x"), (None, "x")]
    unique, rejected = split_incoming(spark.createDataFrame(rows, "k int, v string"), "k")
    assert sorted(map(tuple, unique.collect())) == [(1, "b"), (2, None), (3, "c")]
    assert sorted(map(repr, map(tuple, rejected.collect()))) == sorted(map(repr, [
        (1, "a", "duplicate key"), (1, "b", "duplicate key"), (2, None, "duplicate key"), (None, "x", "NULL key"), (None, "x", "NULL key")]))


def test_keep_one_record(spark):
    """The rows that ``keep_one`` keeps; only rows of repeated ids are shuffled and sorted."""
    from dimforge.operators.dedupe import keep_one, keep_one_record
    rows = [(i, f"r{i}", i) for i in range(50)] + [(7, "newer", 99), (7, "older", 1), (None, "a", 1), (None, "b", 2), (9, "r9", 9)]
    df = spark.createDataFrame(rows, "k int, v string, at int").repartition(5)
    got = keep_one_record(df, "k", ["at"])
    assert sorted(map(str, got.collect())) == sorted(map(str, keep_one(df, ["k"], ["at"]).collect()))
    unique = df.where("k < 7")
    assert keep_one_record(unique, "k", ["at"]) is unique


def test_foreign_keys_share_keys_and_tables(spark):
    from dimforge.operators import checks as C
    from dimforge.operators.refcheck import key_set
    ref = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    fact = spark.createDataFrame([(1, 1), (1, 3), (None, 4), (5, None)], "a int, b int")
    declared = [("t", "a", "r", "id"), ("u", "a", "r", "id"), ("t", "b", "r", "id")]
    made = key_set(ref, "id")
    got = C.foreign_keys({"t": fact, "u": fact}, declared, lambda table, column: made)
    want = C.union_all([C.foreign_key(fact, t, c, ref, rc) for t, c, _, rc in declared])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.dtypes == want.dtypes


def test_warehouse_writes_shared_dimensions_once(spark):
    """Tables read the written company dimension: its text cleaning is in none of their plans."""
    from conftest import SF_SMALL
    from dimforge.plans.operator_queries import _warehouse
    plans = {t: df._jdf.queryExecution().optimizedPlan().toString() for t, df in _warehouse(spark, SF_SMALL).items()}
    assert "nfkd_ascii" not in plans["dim_company"] + plans["fact_acquisition"]


def test_packed_keys_give_the_same_flags(spark):
    """64 neighbouring ids are one row, and each is found as in the plain set."""
    from dimforge.operators.blocks import MEMBERS
    from dimforge.operators.refcheck import lookup, packed
    dense = key_set(spark.range(-3200, 3200).select(F.col("id").cast("int").alias("d")), "d")
    assert packed(dense).count() == 100 and packed(dense).columns[-1] == MEMBERS
    fact = spark.createDataFrame([(i,) for i in (None, -2147483648, -3201, -3200, -64, -1, 0, 63, 64, 3199, 3200, 2147483647)], "k int")
    odd = key_set(spark.createDataFrame([(-2147483648,), (-1,), (64,), (64,), (None,), (2147483647,)], "d int"), "d")
    for keys in (dense, odd):
        plain, small = (sorted(map(repr, flag_matches(fact, x, ["k"], "ok").collect())) for x in (keys, packed(keys)))
        assert plain == small
    typed = key_set(spark.createDataFrame([("c", 5), ("p", 5), ("c", 6), ("p", 70)], "t string, d int"), "t", "d")
    rows = spark.createDataFrame([(t, i) for t in ("c", "p", "f", None) for i in (5, 6, 7, 70, None)], "t string, k int")
    plain, small = (sorted(map(repr, flag_matches(rows, x, ["t", "k"], "ok").collect())) for x in (typed, packed(typed)))
    assert plain == small
    table = spark.createDataFrame([(5, True, False), (6, True, True), (900, False, True)], "d int, a boolean, b boolean")
    ids = spark.createDataFrame([(5,), (6,), (7,), (900,), (None,)], "k int")
    got = {r.k: (bool(r.a), bool(r.b)) for r in lookup(ids, packed(table, ["a", "b"]), ["k"], ["a", "b"]).collect()}
    assert got == {5: (True, False), 6: (True, True), 7: (False, False), 900: (False, True), None: (False, False)}
    words = key_set(spark.createDataFrame([("x",)], "d string"), "d")
    assert packed(words) is words


@pytest.mark.parametrize("limit,join", [("10MB", "BroadcastHashJoin"), ("4000", "BroadcastHashJoin"), ("-1", "ShuffledHashJoin")])
def test_repeated_records_need_no_sort_merge(spark, limit, join):
    """Rows of repeated ids are told apart without a sort of all rows, however many ids repeat."""
    from dimforge.operators.dedupe import keep_one, keep_one_record
    from dimforge.operators.upsert import split_incoming
    ids = spark.range(6000)
    df = (ids.select(F.col("id").cast("string").alias("k"), F.lit(1).alias("at"))
          .unionByName(ids.where("id % 6 = 0").select(F.col("id").cast("string").alias("k"), F.lit(2).alias("at")))
          .unionByName(spark.createDataFrame([(None, 1), (None, 3)], "k string, at int")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = keep_one_record(df, "k", ["at"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = sorted(map(repr, got.collect()))
        unique, rejected = split_incoming(df, "k")
        sizes = unique.count(), rejected.where("reason = 'duplicate key'").count(), rejected.where("k IS NULL").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert join in plan and "SortMergeJoin" not in plan
    assert rows == sorted(map(repr, keep_one(df, ["k"], ["at"]).collect())) and len(rows) == 6001
    assert sizes == (6000, 1000, 2)
