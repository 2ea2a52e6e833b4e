"""Payload parsing, pivot, file round trip, dimensions."""

import json

import pytest
from pyspark.sql import functions as F

from cadence.sources import files as FS
from cadence.sources import indicators as IN


def _payload(records):
    meta = {"page": 1, "pages": 1, "per_page": 1000, "total": len(records)}
    return json.dumps([meta, records])


def _rec(code, iso, name, year, value):
    return {"indicator": {"id": code, "value": "x"}, "countryiso3code": iso, "country": {"value": name},
            "date": str(year), "value": value}


def test_parse_success_empty_and_error(spark):
    texts = [
        _payload([_rec("NY.GDP.MKTP.KD.ZG", "NGA", "Nigeria", 2020, 1.5),
                  _rec("NY.GDP.MKTP.KD.ZG", "NGA", "Nigeria", 2021, None),
                  _rec("NY.GDP.MKTP.KD.ZG", "KEN", "Kenya", 2020, 2.5)]),
        json.dumps([{"page": 0, "pages": 0, "per_page": 1000, "total": 0}]),  # empty
        "<html>502 Bad Gateway</html>",  # error body
        json.dumps([{"message": [{"id": "120", "key": "Invalid value"}]}]),  # API error form
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = IN.parse_payloads(df).orderBy("entity", "period").collect()
    assert [(r["entity"], r["period"], r["value"]) for r in rows] == [
        ("KEN", 2020, 2.5), ("NGA", 2020, 1.5), ("NGA", 2021, None)]
    status = {r["status"]: r["n"] for r in IN.classify_payloads(df).groupBy("status").count()
              .withColumnRenamed("count", "n").collect()}
    assert status == {"ok": 1, "empty": 2, "invalid": 1}


def test_rename_and_pivot(spark):
    rows = [("NGA", "Nigeria", 2020, "NY.GDP.MKTP.KD.ZG", 1.5), ("NGA", "Nigeria", 2020, "FP.CPI.TOTL.ZG", 12.0),
            ("KEN", "Kenya", 2020, "FP.CPI.TOTL.ZG", 5.0), ("KEN", "Kenya", 2021, "XX.UNKNOWN", 1.0)]
    long = spark.createDataFrame(rows, "entity string, entity_name string, period int, indicator_code string, value double")
    named = IN.rename_indicators(long, IN.catalogue(spark))
    assert {r["indicator"] for r in named.collect()} == {"gdp_growth", "inflation", "XX.UNKNOWN"}
    wide = {(r["entity"], r["period"]): r for r in IN.pivot_wide(named, ["gdp_growth", "inflation"]).collect()}
    assert wide[("NGA", 2020)]["gdp_growth"] == 1.5 and wide[("NGA", 2020)]["inflation"] == 12.0
    assert wide[("KEN", 2020)]["gdp_growth"] is None
    assert set(IN.pivot_wide(named, ["gdp_growth"]).columns) == {"entity", "period", "entity_name", "gdp_growth"}


def test_build_then_parse_round_trip(spark):
    rows = [("A", "Alpha", p, "inflation", float(p)) for p in range(30)]
    long = spark.createDataFrame(rows, "entity string, entity_name string, period int, indicator string, value double")
    texts = IN.build_payloads(long, IN.catalogue(spark), per_page=12)
    assert texts.count() == 3  # pages of 12 periods
    back = IN.parse_payloads(texts).orderBy("period").collect()
    assert [r["value"] for r in back] == [float(p) for p in range(30)]


def test_csv_round_trip_and_declared_schema(spark):
    df = spark.createDataFrame([("A", 1, 1.5), ("B", 2, None)], "entity string, period int, v double")
    path = FS.write_table(df, FS.scratch_path(spark, "t-csv"), "csv")
    back = FS.read_table(spark, path, df.schema, "csv").orderBy("entity").collect()
    assert [tuple(r) for r in back] == [("A", 1, 1.5), ("B", 2, None)]
    with pytest.raises(ValueError):
        FS.read_table(spark, path, None, "csv")


def test_group_filter_with_fallback(spark):
    df = spark.createDataFrame([("A", 1), ("B", 1), ("C", 1)], "entity string, period int")
    groups = spark.createDataFrame([("g1", "A"), ("default", "A"), ("default", "B")], "group_name string, entity string")
    assert {r["entity"] for r in FS.group_filter(df, groups, "g1").collect()} == {"A"}
    assert {r["entity"] for r in FS.group_filter(df, groups, "missing").collect()} == {"A", "B"}


def test_name_precedence(spark):
    df = spark.createDataFrame([("A", "Data A"), ("B", None), ("C", None)], "entity string, entity_name string")
    static = spark.createDataFrame([("B", "Static B")], "entity string, static_name string")
    out = {r["entity"]: (r["display_name"], r["name_source"]) for r in FS.resolve_names(df, static).collect()}
    assert out == {"A": ("Data A", "data"), "B": ("Static B", "static"), "C": ("C", "code")}


def test_stream_ingest_matches_batch(spark):
    from cadence.streaming.landing import ingest_available
    rows = [("A", "Alpha", p, "inflation", float(p)) for p in range(20)]
    long = spark.createDataFrame(rows, "entity string, entity_name string, period int, indicator string, value double")
    landing = FS.scratch_path(spark, "t-landing")
    IN.build_payloads(long, IN.catalogue(spark)).write.text(landing)
    out = ingest_available(spark, landing, FS.scratch_path(spark, "t-records"))
    assert out.count() == 20
    assert out.agg(F.sum("value")).first()[0] == pytest.approx(sum(range(20)))
