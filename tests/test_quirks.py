"""Pinned semantics from the quirk list, on tiny hand-made staged rows."""

import decimal

from pyspark.sql import functions as F

from dimforge.plans import warehouse as W
from dimforge.schemas import staged_schema

D = decimal.Decimal


def _company(spark, rows):
    return spark.createDataFrame(rows, staged_schema("company"))


def _crow(office, oid, lat, lon, updated):
    return (office, oid, "d", "r", "a", "", "c", "z", "s", "cc", lat, lon, "2007-01-01 00:00:00", updated)


def test_q1_survivor_decides_the_coordinate_filter(spark):
    rows = [_crow(1, "c:5", D("1.0"), D("2.0"), "2007-01-01 00:00:00"),
            _crow(2, "c:5", D("0"), D("2.0"), "2009-01-01 00:00:00"),     # newest copy has lat 0
            _crow(3, "c:6", D("1.0"), D("2.0"), "2007-01-01 00:00:00")]
    got = [r.company_object_id for r in W.transform_company(_company(spark, rows)).valid.collect()]
    assert got == [6]


def test_q2_compat_collapses_prefixes_strict_keeps_them(spark):
    rows = [_crow(1, "c:5", D("1.0"), D("2.0"), "2007-01-01 00:00:00"),
            _crow(2, "f:5", D("1.0"), D("2.0"), "2008-01-01 00:00:00")]
    compat = W.transform_company(_company(spark, rows)).valid.collect()
    strict = W.transform_company(_company(spark, rows), mode="strict").valid.collect()
    assert [(r.company_entity_type, r.company_id) for r in compat] == [("f", 2)]
    assert sorted((r.company_entity_type, r.company_id) for r in strict) == [("c", 1), ("f", 2)]


def test_q6_null_ids(spark):
    company = _company(spark, [_crow(1, "c:5", D("1.0"), D("2.0"), "2007-01-01 00:00:00")])
    comp = W.transform_company(company).valid
    acq = spark.createDataFrame(
        [(1, "c:x", "c:5", "cash", D("10.00"), "USD", None, "http://a", "", "2013-01-01 00:00:00", "2013-01-01 00:00:00")],
        staged_schema("acquisition")).withColumn("acquired_at", F.lit("2010-01-01").cast("date"))
    b = W.transform_acquisition(acq, comp)
    assert b.valid.count() == 0 and b.quarantine.first().object_id is None
    ms = spark.createDataFrame([(1, "c:x", "2009-06-23", "other", "d", "http://m", "s", "2010-01-01 00:00:00",
                                 "2010-01-01 00:00:00")], staged_schema("milestones"))
    m = W.transform_milestones(ms, comp)
    assert m.valid.count() == 0 and m.quarantine.count() == 0      # NULL ids are dropped, not quarantined


def test_q7_cleaning_can_leave_empty_names(spark):
    people = spark.createDataFrame([("1", "p:1", "!!!", "", "", "x"), ("2", "p:2", "", "", "", "y")],
                                   staged_schema("people"))
    got = {r.people_object_id: r.full_name for r in W.transform_people(people).valid.collect()}
    assert got == {1: ""}


def test_q8_bare_ticker(spark):
    ipo = spark.createDataFrame([("1", "c:1", None, "", None, "", None, "078340", "", "", "2009-01-01 00:00:00",
                                  "2009-01-01 00:00:00")], staged_schema("ipo"))
    r = W.ipo_prepared(ipo).first()
    assert (r.stock_market, r.stock_symbol) == ("N/A", "N/A")


def test_q15_missing_price_is_dropped(spark):
    company = _company(spark, [_crow(1, "c:5", D("1.0"), D("2.0"), "2007-01-01 00:00:00")])
    acq = spark.createDataFrame(
        [(1, "c:5", "c:5", "cash", None, "USD", None, "", "", "2013-01-01 00:00:00", "2013-01-01 00:00:00")],
        staged_schema("acquisition")).withColumn("acquired_at", F.lit("2010-01-01").cast("date"))
    b = W.transform_acquisition(acq, W.transform_company(company).valid)
    assert b.classified.count() == 0
