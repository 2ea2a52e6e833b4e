"""Indicator records: landed JSON payloads -> long rows -> wide panel.

The reference downloads one payload per (country, indicator) over HTTP.  Here
payloads are landed text (one JSON document per line, the API's shape
``[metadata, [record, ...]]``) and parsing is a projection: the records array is
cut out with ``get_json_object``, typed with ``from_json`` and exploded.  A
payload without a second element (empty) yields no rows; text that is not
JSON yields NULL and is counted, never raised.

Long -> wide is one conditional aggregate keyed by (entity, period) — the
shuffle a pivot does — instead of a chain of outer joins.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = ("array<struct<indicator:struct<id:string,value:string>,countryiso3code:string,"
                 "country:struct<value:string>,date:string,value:double>>")

# The public indicator catalogue (code, short name, description).
INDICATOR_CATALOGUE = (
    ("NY.GDP.MKTP.KD.ZG", "gdp_growth", "GDP growth (annual %)"),
    ("FP.CPI.TOTL.ZG", "inflation", "Inflation, consumer prices (annual %)"),
    ("NE.TRD.GNFS.ZS", "trade_openness", "Trade (% of GDP)"),
    ("NE.GDI.TOTL.ZS", "investment", "Gross capital formation (% of GDP)"),
    ("TX.VAL.FUEL.ZS.UN", "fuel_exports_pct", "Fuel exports (% of merchandise exports)"),
    ("TX.VAL.MMTL.ZS.UN", "metals_exports_pct", "Ores and metals exports (% of merchandise exports)"),
    ("TX.VAL.AGRI.ZS.UN", "agri_exports_pct", "Agricultural raw materials exports (% of merchandise exports)"),
    ("TX.VAL.FOOD.ZS.UN", "food_exports_pct", "Food exports (% of merchandise exports)"),
    ("PA.NUS.FCRF", "exchange_rate", "Official exchange rate (LCU per US$)"),
    ("PX.REX.REER", "real_eff_exchange_rate", "Real effective exchange rate index"),
    ("CC.EST", "control_corruption", "Control of Corruption: Estimate (-2.5 to 2.5)"),
    ("GE.EST", "govt_effectiveness", "Government Effectiveness: Estimate (-2.5 to 2.5)"),
    ("PV.EST", "political_stability", "Political Stability: Estimate (-2.5 to 2.5)"),
    ("RQ.EST", "regulatory_quality", "Regulatory Quality: Estimate (-2.5 to 2.5)"),
    ("RL.EST", "rule_of_law", "Rule of Law: Estimate (-2.5 to 2.5)"),
    ("VA.EST", "voice_accountability", "Voice and Accountability: Estimate (-2.5 to 2.5)"),
    ("NE.EXP.GNFS.ZS", "exports_gdp", "Exports of goods and services (% of GDP)"),
    ("NE.IMP.GNFS.ZS", "imports_gdp", "Imports of goods and services (% of GDP)"),
    ("BN.CAB.XOKA.GD.ZS", "current_account_gdp", "Current account balance (% of GDP)"),
    ("DT.DOD.DECT.GN.ZS", "external_debt_gni", "External debt stocks (% of GNI)"),
)
PAGE_PERIODS = 12  # records per landed payload: one page per entity, indicator and 12 periods


def catalogue(spark: SparkSession) -> DataFrame:
    """The indicator dimension (20 rows, fixed)."""
    return spark.createDataFrame(list(INDICATOR_CATALOGUE), "code string, name string, description string")


def build_payloads(long_df: DataFrame, cat: DataFrame, per_page: int = PAGE_PERIODS) -> DataFrame:
    """Land long rows as API-shaped JSON text, one payload per (indicator, entity, page).

    A page holds at most ``per_page`` periods, so no payload grows with the
    data.  Returns ``(value string)`` like ``spark.read.text``.
    """
    rows = long_df.join(F.broadcast(cat), long_df.indicator == cat.name)  # 20-row fixed dimension
    rec = F.struct(F.struct(F.col("code").alias("id"), F.col("description").alias("value")).alias("indicator"),
                   F.col("entity").alias("countryiso3code"),
                   F.struct(F.col("entity_name").alias("value")).alias("country"),
                   F.col("period").cast("string").alias("date"), F.col("value").alias("value"))
    page = F.floor(F.col("period") / per_page)
    grouped = rows.groupBy("code", "entity", page.alias("page")).agg(
        F.collect_list(rec).alias("records"), F.count(F.lit(1)).alias("total"))
    meta = F.struct(F.lit(1).alias("page"), F.lit(1).alias("pages"), F.lit(per_page).alias("per_page"),
                    F.col("total").alias("total"))
    return grouped.select(F.concat(F.lit("["), F.to_json(meta), F.lit(","), F.to_json("records"),
                                   F.lit("]")).alias("value"))


def empty_and_bad_payloads(entities: DataFrame) -> DataFrame:
    """One empty payload (metadata only) and one non-JSON error text per entity."""
    empty = entities.select(F.concat(F.lit('[{"page":0,"pages":0,"per_page":12,"total":0,"entity":"'),
                                     F.col("entity"), F.lit('"}]')).alias("value"))
    bad = entities.select(F.concat(F.lit("<error>service unavailable for "), F.col("entity"),
                                   F.lit("</error>")).alias("value"))
    return empty.unionByName(bad)


def classify_payloads(texts: DataFrame, col: str = "value") -> DataFrame:
    """Tag each payload text as ``ok``, ``empty`` or ``invalid``."""
    root = F.get_json_object(F.col(col), "$[0]")
    second = F.get_json_object(F.col(col), "$[1]")
    return texts.withColumn("status", F.when(root.isNull(), "invalid").when(second.isNull(), "empty")
                            .otherwise("ok"))


def parse_payloads(texts: DataFrame, col: str = "value") -> DataFrame:
    """Payload text -> (entity, entity_name, period, indicator_code, value).

    Only projections and an explode: it runs unchanged on a stream.
    """
    recs = F.from_json(F.get_json_object(F.col(col), "$[1]"), RECORD_SCHEMA)
    return (texts.select(F.explode(recs).alias("r"))
            .select(F.col("r.countryiso3code").alias("entity"), F.col("r.country.value").alias("entity_name"),
                    F.col("r.date").cast("int").alias("period"), F.col("r.indicator.id").alias("indicator_code"),
                    F.col("r.value").alias("value")))


def rename_indicators(long_df: DataFrame, cat: DataFrame) -> DataFrame:
    """S3: code -> short name and description through the (fixed, 20-row) catalogue."""
    return (long_df.join(F.broadcast(cat), long_df.indicator_code == cat.code, "left")
            .select(*[c for c in long_df.columns], F.coalesce(F.col("name"), F.col("indicator_code")).alias("indicator"),
                    F.col("description")))


def pivot_wide(long_df: DataFrame, names: Sequence[str], strict_names: bool = False,
               indicator: str = "indicator") -> DataFrame:
    """Long rows -> one row per (entity, period) with one column per name.

    One conditional aggregate (what ``pivot`` plans to) over an explicit name
    list, so the schema is fixed.  The entity name is the row's name
    (``max``; ``strict_names`` keeps it in the key as the reference's merge does).
    """
    keys = ["entity", "entity_name", "period"] if strict_names else ["entity", "period"]
    aggs = [] if strict_names else [F.max("entity_name").alias("entity_name")]
    aggs += [F.max(F.when(F.col(indicator) == n, F.col("value"))).alias(n) for n in names]
    return long_df.groupBy(*keys).agg(*aggs)


def fetch_range(texts: DataFrame, cat: DataFrame, names: Sequence[str], start: int, end: int) -> DataFrame:
    """Parse, rename, keep periods in [start, end], pivot."""
    long_df = rename_indicators(parse_payloads(texts), cat)
    return pivot_wide(long_df.filter(F.col("period").between(start, end)), names)
