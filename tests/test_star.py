"""The monthly panel: exact sums of any doubles, repeated and null keys, and a plan of plain numbers."""

import itertools
from collections import defaultdict
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest

from cadence.sources import star

PRICES = [901.82, 1.005, 0.125, -3.335, 104997.88, 1e13 + 0.37, 9.9e15, 2.0 ** -40, 0.0, None]
RATES = [0.0, 0.05, 0.045, 0.1, -0.07, 12.345, 99.99, -99.99, None]


def _hundredths(x):
    """As a cast of the double to a decimal of two places rounds."""
    return None if x is None else int(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP) * 100)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    pick = lambda values: values[int(rng.integers(len(values)))]
    money = lambda: pick(PRICES) if rng.random() < 0.5 else round(float(rng.uniform(1, 1e5)), int(rng.integers(0, 5)))
    t = {
        "nation": [(0, "ZULU", 0), (1, "ALPHA", 0), (2, None, 0), (3, "MIKE", 0)],  # names not in the order of the numbers
        "customer": [(k, k % 4, pick(["BUILDING", "AUTO", None])) for k in range(12)] + [(3, 0, "BUILDING"), (None, 1, "AUTO")],
        "supplier": [(k, pick([0, 1, 2, 3, None])) for k in range(8)] + [(5, 2)],
        "part": [(k, pick(["STANDARD TIN", "ECONOMY TIN", "MEDIUM", "PROMO X Y", "LARGE TIN", None])) for k in range(20)],
        "orders": [(k, pick([*range(12), None]), money(), datetime(1995, 1 + k % 5, 3), pick(["1-URGENT", "2-HIGH", "5-LOW", None])) for k in range(150)],
        "lineitem": [(pick([*range(140), None]), int(rng.integers(20)), int(rng.integers(8)), pick([1.0, 30.0, 50.0, None]), money(), pick(RATES), pick(RATES),
                      pick(["N", "R", None]), pick(["F", "O"])) for _ in range(900)],
    }
    t["orders"] += [(k, int(rng.integers(12)), money(), datetime(1995, 6, 3), "2-HIGH") for k in range(0, 150, 10)]  # repeated keys
    schemas = {
        "nation": "n_nationkey int, n_name string, n_regionkey int", "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
        "supplier": "s_suppkey long, s_nationkey int", "part": "p_partkey long, p_type string",
        "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                    "l_returnflag string, l_linestatus string",
    }
    d = str(tmp_path_factory.mktemp("star"))
    for name, rows in t.items():
        spark.createDataFrame(rows, schemas[name]).write.parquet(f"{d}/{name}.parquet")
    return d, t


def _expected(t):
    """The panel without its mask, row by row with Python's exact numbers."""
    top = lambda values: max((v for v in values if v is not None), default=None)
    names = {n: name for n, name, _ in t["nation"]}
    facts = defaultdict(list)
    for k, cust, price, date, prio in t["orders"]:
        for c, n, segment in t["customer"]:
            if cust is not None and c == cust:
                facts[k].append((names[n], n, date.year * 12 + date.month, _hundredths(price), None if prio is None else prio in ("1-URGENT", "2-HIGH"),
                                 None if prio is None else prio == "5-LOW", None if segment is None else segment == "BUILDING"))
    lines = defaultdict(list)
    for row in t["lineitem"]:
        lines[row[0]] += [(row, p_type, n) for (p, p_type), (s, n) in itertools.product(t["part"], t["supplier"]) if p == row[1] and s == row[2]]
    groups = defaultdict(lambda: defaultdict(int))
    for k in facts:
        if not lines[k]:
            continue
        o = [top(f[i] for f in facts[k]) for i in range(7)]
        g = groups[tuple(o[:3])]
        g["gdp"] += o[3] or 0
        g["urgent"] += (o[3] or 0) if o[4] else 0
        g["low"] += bool(o[5])
        g["building"] += bool(o[6])
        g["orders"] += 1
        for f, ((_, _, _, qty, ext, disc, tax, flag, status), p_type, n) in itertools.product(facts[k], lines[k]):
            e, r, x = _hundredths(ext), _hundredths(disc), _hundredths(tax)
            rev = 0 if e is None or r is None else e * (100 - r)
            g["rev"] += rev
            g[(p_type or "").split(" ")[0]] += rev
            g["foreign"] += rev if n is not None and n != f[1] else 0
            g["ext"] += e or 0
            g["tax"] += x or 0
            g["qty"] += qty or 0
            g["lines"] += 1
            g["n"] += flag == "N"
            g["f"] += status == "F"
            g["disc"] += disc is not None and disc <= 0.05
            g["big"] += qty is not None and qty > 25
    real = lambda v, places: float(Decimal(v).scaleb(-places))
    share = lambda a, b: a / b if b else None
    out = {}
    for (name, n, period), g in groups.items():
        rev, gdp = real(g["rev"], 4), real(g["gdp"], 2)
        of = lambda a, b, f=lambda s: 100.0 * s: None if share(a, b) is None else f(share(a, b))
        gov = lambda a, b: of(g[a], g[b], lambda s: 5.0 * s - 2.5)
        out[name, n, period] = (
            gdp / 1e6, *[of(real(g[c], 4), rev) for c in star.COMMODITY_TYPES.values()], share(real(g["ext"], 2), g["qty"]),
            of(real(g["tax"], 2), g["lines"]), of(real(g["foreign"], 4), rev), of(real(g["urgent"], 2), gdp),
            gov("n", "lines"), gov("f", "lines"), gov("low", "orders"), gov("disc", "lines"), gov("big", "lines"), gov("building", "orders"))
    return out


def test_the_monthly_panel_is_exact(spark, tables):
    d, t = tables
    got = {(r["entity"], r["entity_no"], r["period"]): tuple(r[m] for m in star.MONTH_MEASURES) for r in star.panel_month(spark, d, mask=False).collect()}
    want = _expected(t)
    assert len(want) > 20 and any(k[0] is None for k in want)
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k] == pytest.approx(w, rel=1e-15, abs=0), k


def test_the_panel_build_aggregates_plain_numbers(spark, tables):
    """An aggregate with a string buffer sorts row by row, wide decimals make an object per row: the panel's lines do neither."""
    plan = star.panel_month(spark, tables[0])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    lines = [x for x in plan.splitlines() if "keys=[o_orderkey" in x]
    assert lines and not any("decimal" in x.lower() for x in lines)


@pytest.mark.parametrize("precision", [4, 18])
def test_units_round_as_the_cast(spark, precision):
    rng = np.random.default_rng(3)
    xs = [None if v is None else float(v) for v in PRICES + RATES] + [-0.0, 0.015, 2.675, 1e12 + 0.01, 9007199254740993.0, 1e-300]
    xs += [float(x) for x in rng.uniform(-1e4, 1e4, 300)] + [round(float(x), 2) for x in rng.uniform(-1e6, 1e6, 300)]
    xs = [x for x in xs if x is None or abs(x) < 10 ** (precision - 2) - 1]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select("i", star._units("x", precision).alias("u")).orderBy("i").select("u").collect()]
    assert got == [_hundredths(x) for x in xs]
