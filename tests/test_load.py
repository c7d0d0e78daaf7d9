"""Constraints at load, key splitting, shared key sets."""

from pyspark.sql import functions as F

from dimforge.operators.enforce import VIOLATIONS, Constraints, classify, declared, split_violations
from dimforge.operators.upsert import split_incoming
from dimforge.plans import warehouse as W
from dimforge.sinks import tables as T

RULES = Constraints(not_null=("a",), max_length={"b": 3}, numeric={"m": (5, 2)}, unique=(("u",),), foreign=(("f", "dim", "id"),))
SCHEMA = "k int, a string, b string, m string, u int, f int"


def broken(df):
    return {r.k: list(r[VIOLATIONS]) for r in df.collect()}


def test_row_checks(spark):
    rows = [(1, "x", "abc", "999.99", 1, 7), (2, None, "abcd", "1000", 2, None), (3, "x", None, None, None, 8),
            (4, "x", "é" * 3, "-1000", 4, 7), (5, "x", "ab", "no number", 5, 7)]
    dim = spark.createDataFrame([(7,), (7,), (None,)], "id int")
    got = classify(spark.createDataFrame(rows, SCHEMA), RULES, "k", refs={"dim": dim})
    assert broken(got) == {
        1: [], 2: ["a is NULL", "b is longer than 3", "m exceeds numeric(5,2)"], 3: ["f is not in dim.id"],
        4: ["m exceeds numeric(5,2)"], 5: ["m exceeds numeric(5,2)"]}
    good, bad = split_violations(got)
    assert good.columns == SCHEMA.replace(" int", "").replace(" string", "").split(", ") and good.count() == 1
    assert bad.where("k = 2").first().reason == "a is NULL; b is longer than 3; m exceeds numeric(5,2)"


def test_unique_in_batch_and_table(spark):
    only = Constraints(not_null=("a",), unique=(("u",),))
    batch = [(1, "x", "", "", 10, 1), (2, "x", "", "", 10, 1), (3, None, "", "", 10, 1), (4, "x", "", "", None, 1),
             (5, "x", "", "", None, 1), (6, "x", "", "", 20, 1), (7, "x", "", "", 30, 1), (9, "x", "", "", 40, 1), (9, "x", "y", "", 40, 1)]
    df = spark.createDataFrame(batch, SCHEMA)
    got = {(r.k, r.b): list(r[VIOLATIONS]) for r in classify(df, only, "k").collect()}
    assert got == {(1, ""): ["u is not unique"], (2, ""): [], (3, ""): ["a is NULL"], (4, ""): [], (5, ""): [],
                   (6, ""): [], (7, ""): [], (9, ""): [], (9, "y"): []}
    # the table holds 20 under its own key, 30 and 10 under others (30 even under two)
    target = spark.createDataFrame([(6, 20), (8, 30), (7, 30), (100, 10), (101, None)], "k int, u int")
    got = broken(classify(df, only, "k", target))
    assert got[6] == [] and got[7] == ["u is not unique in the table"]
    assert got[1] == got[2] == ["u is not unique in the table"] and got[4] == got[9] == []


def test_declared():
    c = declared("dim_company", "company_id")
    assert c.unique == (("company_object_id",),) and c.not_null == ("company_entity_type", "company_object_id")
    assert declared("dim_company", "company_id", "strict").unique == (("company_entity_type", "company_object_id"),)
    assert declared("fact_investments", "investment_id").foreign == (("funding_round_id", "dim_funding_rounds", "funding_round_id"),)
    assert declared("fact_relationship", "relationship_id") == Constraints()


def test_rejected_rows_partition_the_input(spark, scratch):
    """Every row of a batch is merged or quarantined, once."""
    rules = Constraints(not_null=("a",), max_length={"b": 2}, unique=(("u",),))
    rows = [(k % 50 if k % 7 else None, None if k % 11 == 0 else "x", "b" * (k % 4), "1", k % 30, 1) for k in range(400)]
    batch = spark.createDataFrame(rows, SCHEMA)
    T.upsert(batch, f"{scratch}/t", "k", None, f"{scratch}/q", rules)
    table = T.read_table(spark, f"{scratch}/t")
    assert table.count() + spark.read.parquet(f"{scratch}/q").count() == 400
    assert table.select("k").distinct().count() == table.count()
    assert table.where("a is null or length(b) > 2 or k is null").count() == 0
    # values are unique from then on, whatever comes
    T.upsert(batch.withColumn("k", F.col("k") + 25), f"{scratch}/t", "k", None, f"{scratch}/q", rules)
    table = T.read_table(spark, f"{scratch}/t")
    assert table.groupBy("u").count().where("count > 1").count() == 0


def test_first_load_without_constraints_is_as_before(spark, scratch):
    batch = spark.createDataFrame([(1, None, "long text", "x", 1, 1)], SCHEMA)
    T.upsert(batch, f"{scratch}/t", "k")
    assert T.read_table(spark, f"{scratch}/t").count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unique_batch_is_not_shuffled(spark):
    """Rows of a batch without repeated keys reach the merge as they are."""
    batch = spark.range(1000).withColumn("v", F.lit("x"))
    rows, rejected = split_incoming(batch, "id")
    assert "Exchange" not in plan(rows) and "Exchange" not in plan(rejected)
    assert rows.count() == 1000 and rejected.count() == 0


def test_key_sets_are_written_once(spark):
    company = spark.createDataFrame([("c", 1), ("f", 1), ("c", 2), ("c", None)], "company_entity_type string, company_object_id int")
    people = spark.createDataFrame([("p", 1), ("p", 3)], "people_entity_type string, people_object_id int")
    keys = W.Keys(company, people)
    assert keys.company() is keys.company() and keys.types_by_id() is keys.types_by_id()
    assert sorted(map(tuple, keys.entities().collect())) == [("c", 1), ("c", 2), ("p", 1), ("p", 3)]
    assert sorted(map(tuple, keys.types_by_id().collect())) == [(1, True, True), (2, True, False), (3, False, True)]
    strict = W.Keys(company, people, "strict")
    assert sorted(map(tuple, strict.entities().collect())) == [("c", 1), ("c", 2), ("f", 1), ("p", 1), ("p", 3)]


# -- targets laid out by key -------------------------------------------------------
def test_bucketed_target_is_not_shuffled(spark, scratch):
    from dimforge.sinks.keyed import BucketedTable
    t = BucketedTable(spark, f"{scratch}/t", "k", 8)
    old = spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit("kept").alias("w"))
    t.upsert(old)
    new = spark.range(1500, 2500).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    again = BucketedTable(spark, f"{scratch}/t", "k", 8)
    text = plan(again.merged(new))
    sides = text[text.index("SortMergeJoin"):]
    assert sides.count("Exchange") == 1 and "Bucketed: true" in sides
    # the exchange is on the incoming side (a range), not above the files of the target
    assert "FileScan" not in sides[sides.index("Exchange"):]
    again.upsert(new)
    rows = {r.k: (r.v, r.w) for r in again.read().collect()}
    assert rows == {k: ("new" if k >= 1500 else "old", "kept" if k < 2000 else None) for k in range(2500)}
    files = {f.rpartition("/")[2] for f in again.read().inputFiles()}
    assert len(files) == 8  # one file a bucket
    import pytest
    with pytest.raises(ValueError):
        BucketedTable(spark, f"{scratch}/t", "k", 16)


def test_bucketed_target_in_a_new_session(spark, scratch):
    """A session whose catalog does not know the table registers its folder."""
    from dimforge.sinks.keyed import BucketedTable
    t = BucketedTable(spark, f"{scratch}/t", "k", 4)
    t.upsert(spark.range(100).withColumnRenamed("id", "k"))
    spark.sql(f"DROP TABLE {t._catalog_name(1)}")  # external: the files stay
    again = BucketedTable(spark, f"{scratch}/t", "k", 4)
    assert again.read().count() == 100
    again.upsert(spark.range(50, 150).withColumnRenamed("id", "k"))
    assert again.read().count() == 150


def test_partial_rewrite(spark, scratch):
    """Untouched partitions keep their files."""
    from dimforge.sinks.keyed import PartitionedTable
    t = PartitionedTable(spark, f"{scratch}/t", "k", width=100)
    t.upsert(spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("w")))

    def files():
        return {f for f in spark.read.parquet(t.path).inputFiles()}

    before = files()
    batch = spark.createDataFrame([(350, "new"), (399, None), (1050, "new"), (None, "x"), (350, "dup")], "k long, v string")
    again = PartitionedTable(spark, f"{scratch}/t", "k", width=100)
    assert again.upsert(batch, {"w": F.lit(7)}, f"{scratch}/q") == [3, 10]
    after = files()
    same = before & after
    assert {f.split("key_part=")[1].split("/")[0] for f in same} == {"0", "1", "2", "4", "5", "6", "7", "8", "9"}
    assert {f.split("key_part=")[1].split("/")[0] for f in after - before} == {"3", "10"}
    rows = {r.k: (r.v, r.w) for r in again.read().collect()}
    assert rows == {**{k: ("old", 1) for k in range(1000)}, 350: ("new", 1), 399: (None, 1), 1050: ("new", 7)}
    assert spark.read.parquet(f"{scratch}/q").count() == 2
    # the same batch again changes nothing
    again.upsert(batch, {"w": F.lit(7)})
    assert {r.k: (r.v, r.w) for r in again.read().collect()} == rows
    # a first load that died after its layout was written is simply loaded
    dead = PartitionedTable(spark, f"{scratch}/dead", "k", parts=4)
    dead._remember_layout()
    PartitionedTable(spark, f"{scratch}/dead", "k", parts=4).upsert(spark.range(5).withColumnRenamed("id", "k"))
    assert PartitionedTable(spark, f"{scratch}/dead", "k", parts=4).read().count() == 5
    # a hashed layout, with constraints
    h = PartitionedTable(spark, f"{scratch}/h", "k", parts=16)
    h.upsert(spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("u")))
    rules = Constraints(unique=(("u",),))
    touched = h.upsert(spark.createDataFrame([(5, 5), (6, 7), (2000, 2000)], "k long, u long"), constraints=rules)
    assert len(touched) <= 2 and h.read().count() == 1001 and h.read().where("k = 6 and u = 6").count() == 1


def test_interrupted_replacement_is_finished(spark, scratch, monkeypatch):
    """A driver that dies while partitions are replaced loses nothing: the next load replaces them again."""
    import shutil
    from dimforge.sinks.keyed import PartitionedTable
    t = PartitionedTable(spark, f"{scratch}/t", "k", width=100)
    t.upsert(spark.range(300).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    with monkeypatch.context() as m:
        real, calls = PartitionedTable.finish, []
        m.setattr(PartitionedTable, "finish", lambda self: calls.append(1) or (real(self) if len(calls) == 1 else None))
        t.upsert(spark.createDataFrame([(150, "new")], "k long, v string"))
    shutil.rmtree(f"{scratch}/t/key_part=1")  # as far as the move came: the old partition is gone
    again = PartitionedTable(spark, f"{scratch}/t", "k", width=100)
    assert again.read().count() == 200
    again.upsert(spark.createDataFrame([(7, "later")], "k long, v string"))
    rows = {r.k: r.v for r in again.read().collect()}
    assert rows == {**{k: "old" for k in range(300)}, 150: "new", 7: "later"}
    assert not again.finish()
    # a batch without rows to merge changes nothing
    again.upsert(spark.createDataFrame([(None, "x")], "k long, v string"))
    assert again.read().count() == 300


def test_merged_partitions_are_moved(spark, scratch):
    """A merge writes each file once: the files it wrote are the table's files."""
    from dimforge.sinks import keyed
    t = keyed.PartitionedTable(spark, f"{scratch}/t", "k", width=10)
    t.upsert(spark.range(100).withColumnRenamed("id", "k"))
    seen = []
    real = keyed.PartitionedTable.finish

    class Seen(keyed.PartitionedTable):
        def finish(self):
            seen.extend(f.rpartition("/")[2] for f in (spark.read.parquet(self.merge_path).inputFiles() if keyed.T._exists(spark, self.merge_path) else []))
            return real(self)

    Seen(spark, f"{scratch}/t", "k", width=10).upsert(spark.range(55, 120).withColumnRenamed("id", "k"))
    files = {f.rpartition("/")[2] for f in spark.read.parquet(t.path).inputFiles()}
    assert seen and set(seen) <= files and t.read().count() == 120
    assert keyed._among([1, 2, 3, 7]) == "key_part BETWEEN 1 AND 3 OR key_part BETWEEN 7 AND 7"
    assert keyed._among(list(range(0, 400, 2))).startswith("key_part IN (0, 2,")
