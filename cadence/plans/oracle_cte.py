"""DuckDB text of the derived panels, for the oracle side of each query.

These strings restate FIXTURES.md section 2 in plain SQL so the oracle never
calls into the library.  ``with_panel(body)`` prefixes a query with them.
"""

from __future__ import annotations

_COMMODITY = [("fuel_exports_pct", "STANDARD"), ("metals_exports_pct", "ECONOMY"),
              ("agri_exports_pct", "MEDIUM"), ("food_exports_pct", "PROMO")]
_MEASURES = ["gdp_level", "fuel_exports_pct", "metals_exports_pct", "agri_exports_pct",
             "food_exports_pct", "exchange_rate", "inflation", "trade_openness", "investment",
             "control_corruption", "govt_effectiveness", "political_stability",
             "regulatory_quality", "rule_of_law", "voice_accountability"]


def _share(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


_VALUES = {
    "gdp_level": "(CAST(gdp_dec AS DOUBLE) / 1000000.0)",
    **{m: f"(CAST(100 AS DOUBLE) * {_share(m + '_dec', 'rev_dec')})" for m, _ in _COMMODITY},
    "exchange_rate": _share("ext_dec", "qty"),
    "inflation": f"(CAST(100 AS DOUBLE) * {_share('tax_dec', 'n_lines')})",
    "trade_openness": f"(CAST(100 AS DOUBLE) * {_share('foreign_dec', 'rev_dec')})",
    "investment": f"(CAST(100 AS DOUBLE) * {_share('urgent_dec', 'gdp_dec')})",
    "control_corruption": f"(5.0 * {_share('n_flag_n', 'n_lines')} - 2.5)",
    "govt_effectiveness": f"(5.0 * {_share('n_status_f', 'n_lines')} - 2.5)",
    "political_stability": f"(5.0 * {_share('n_low', 'n_orders')} - 2.5)",
    "regulatory_quality": f"(5.0 * {_share('n_low_disc', 'n_lines')} - 2.5)",
    "rule_of_law": f"(5.0 * {_share('n_big_qty', 'n_lines')} - 2.5)",
    "voice_accountability": f"(5.0 * {_share('n_building', 'n_orders')} - 2.5)",
}

_MASKED = ",\n    ".join(
    f"CASE WHEN (entity_no * 7 + period * 3 + {m}) % 13 = 0 THEN CAST(NULL AS DOUBLE) "
    f"ELSE {_VALUES[name]} END AS {name}"
    for m, name in enumerate(_MEASURES, start=1))

_COMMODITY_SUMS = ",\n      ".join(
    f"SUM(CASE WHEN p_class = '{t}' THEN rev ELSE 0 END) AS {m}_dec" for m, t in _COMMODITY)

_W = "PARTITION BY entity ORDER BY period"

PANEL_MONTH = f"""
of AS (
  SELECT o_orderkey, c_nationkey, n_name AS entity, n_nationkey AS entity_no,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS period,
         CAST(o_totalprice AS DECIMAL(18,2)) AS price,
         o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent,
         o_orderpriority = '5-LOW' AS low_priority,
         c_mktsegment = 'BUILDING' AS building
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
oa AS (
  SELECT entity, entity_no, period, SUM(price) AS gdp_dec,
         SUM(CASE WHEN urgent THEN price ELSE 0 END) AS urgent_dec,
         count_if(low_priority) AS n_low, count_if(building) AS n_building, count(*) AS n_orders
  FROM of WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey
                                JOIN supplier ON l_suppkey = s_suppkey)
  GROUP BY entity, entity_no, period),
lf AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
         split_part(p_type, ' ', 1) AS p_class, s_nationkey, of.c_nationkey,
         of.entity, of.entity_no, of.period,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS rev
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN of ON l_orderkey = o_orderkey),
la AS (
  SELECT entity, entity_no, period, SUM(rev) AS rev_dec,
      {_COMMODITY_SUMS},
      SUM(CASE WHEN s_nationkey <> c_nationkey THEN rev ELSE 0 END) AS foreign_dec,
      SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS ext_dec, SUM(l_quantity) AS qty,
      SUM(CAST(l_tax AS DECIMAL(4,2))) AS tax_dec, count(*) AS n_lines,
      count_if(l_returnflag = 'N') AS n_flag_n, count_if(l_linestatus = 'F') AS n_status_f,
      count_if(l_discount <= 0.05) AS n_low_disc, count_if(l_quantity > 25) AS n_big_qty
  FROM lf GROUP BY entity, entity_no, period),
pm_raw AS (
  SELECT entity, entity_no, replace(entity, '_', ' ') AS entity_name, period,
    {_MASKED}
  FROM oa JOIN la USING (entity, entity_no, period)),
panel_month AS (
  SELECT *, (last_value(gdp_level IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             / NULLIF(last_value(gdp_level IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             - 1.0) * 100.0 AS gdp_growth
  FROM pm_raw)"""

PANEL_DAY = """
panel_day AS (
  SELECT user_id AS entity, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS period,
         CAST(SUM(CAST(value AS DECIMAL(20,6))) AS DOUBLE) AS value, count(*) AS n,
         count_if(event_type = 'view') AS n_view, count_if(event_type = 'signup') AS n_signup,
         count_if(event_type = 'error') AS n_error, count_if(event_type = 'click') AS n_click,
         count_if(event_type = 'purchase') AS n_purchase
  FROM events GROUP BY 1, 2)"""

PANEL_CUSTOMER = """
panel_customer AS (
  SELECT o_custkey AS entity, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) AS INTEGER) AS period,
         count(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend,
         CAST(100 AS DOUBLE) * (CAST(count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS DOUBLE)
                                / NULLIF(CAST(count(*) AS DOUBLE), 0)) AS urgent_pct
  FROM orders GROUP BY 1, 2)"""

LONG_INDICATORS = """
long_indicators AS (
  FROM (SELECT entity, entity_no, entity_name, period, gdp_level, fuel_exports_pct, metals_exports_pct,
               agri_exports_pct, food_exports_pct, exchange_rate, inflation, trade_openness, investment,
               control_corruption, govt_effectiveness, political_stability, regulatory_quality,
               rule_of_law, voice_accountability, gdp_growth FROM panel_month)
  UNPIVOT INCLUDE NULLS (value FOR indicator IN (gdp_level, fuel_exports_pct, metals_exports_pct, agri_exports_pct, food_exports_pct, exchange_rate, inflation, trade_openness, investment, control_corruption, govt_effectiveness, political_stability, regulatory_quality, rule_of_law, voice_accountability, gdp_growth)))"""


def with_panel(body: str, *extra: str, month: bool = True) -> str:
    parts = ([PANEL_MONTH] if month else []) + list(extra)
    return "WITH " + ",".join(parts) + "\n" + body


def rounded(inner: str, keep: str, digits: int = 6, shift: float = 0.0) -> str:
    """Round every non-key column of ``inner`` (``keep`` = comma list of columns left as is); ``shift`` as in ``finish``."""
    return (f"SELECT {keep}, round(COLUMNS(* EXCLUDE ({keep})) + {shift!r}, {digits}) + 0 FROM ({inner}) AS q")


def _gov_mean(cols=("control_corruption", "govt_effectiveness", "political_stability",
                    "regulatory_quality", "rule_of_law", "voice_accountability")) -> str:
    s = " + ".join(f"COALESCE({c}, 0)" for c in cols)
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    return f"(CAST({s} AS DOUBLE) / NULLIF(CAST({n} AS DOUBLE), 0))"


CDI_RAW = ("LEAST(CAST(100 AS DOUBLE), COALESCE(fuel_exports_pct, 0) + COALESCE(metals_exports_pct, 0)"
           " + COALESCE(agri_exports_pct, 0) + COALESCE(food_exports_pct, 0))")
GOV_INDEX = _gov_mean()


def pad_pct(c: str, w: str = _W) -> str:
    return (f"((last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
            f" / NULLIF(last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
            f" - 1.0) * 100.0)")


def roll(fn: str, c: str, size: int, min_periods: int, w: str = _W) -> str:
    frame = f"{w} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW"
    return f"(CASE WHEN count({c}) OVER ({frame}) >= {min_periods} THEN {fn}({c}) OVER ({frame}) END)"


# S5 ingest derivations on the panel, then the F11 feature set.
INGEST = f"""
ing0 AS (SELECT *, {CDI_RAW} AS cdi_raw, {pad_pct('exchange_rate')} AS exchange_rate_change,
                {GOV_INDEX} AS governance_index FROM panel_month),
ingest AS (SELECT *, {roll('stddev_samp', 'exchange_rate_change', 3, 2)} AS exchange_rate_volatility FROM ing0)"""

FEATURES = INGEST + f""",
feat0 AS (SELECT *, {roll('avg', 'cdi_raw', 3, 1)} AS cdi_smooth,
                 {roll('stddev_samp', 'gdp_growth', 5, 3)} AS gdp_volatility FROM ingest),
features AS (
  SELECT *, CASE WHEN gdp_volatility + 0.01 > 0 THEN ln(gdp_volatility + 0.01) END AS log_gdp_volatility,
         lag(cdi_smooth) OVER ({_W}) AS cdi_smooth_lag1, lag(inflation) OVER ({_W}) AS inflation_lag1,
         lag(trade_openness) OVER ({_W}) AS trade_openness_lag1, lag(investment) OVER ({_W}) AS investment_lag1,
         lag(governance_index) OVER ({_W}) AS governance_index_lag1,
         lag(exchange_rate_volatility) OVER ({_W}) AS exchange_rate_volatility_lag1
  FROM feat0)"""
