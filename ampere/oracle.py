"""Reference SQL for every registered query, written for DuckDB over the same tables.

Each statement derives the same records as ``ampere.sources.bindings`` and then
applies the pipeline's SQL semantics directly (no JSON round trip is needed: the
typed values survive it unchanged). Shared steps are named CTEs; a query lists
the CTEs it needs and they are emitted in dependency order.
"""

from __future__ import annotations

from ampere.sources.bindings import BACKFILL_AT, BOUND_FUEL_CODES, LOOKBACK_MONTHS, REVISION_AT

# Fixed values, stated here again and not imported from the engine, so that a slip in either
# place shows: aggregate fuel codes, and the category of each detailed code.
AGGREGATE_FUEL_CODES = ("ALL", "FOS", "REN", "COW", "AOR", "BIS", "SUN", "TSN",
                        "TPV", "DPV", "NG", "WND", "COL")
FUEL_CATEGORIES = (
    ("Natural Gas", ("NGO",)),
    ("Wind", ("WNT", "WNS")),
    ("Solar & Geothermal", ("SPV", "STH", "GEO")),
    ("Nuclear", ("NUC",)),
    ("Coal", ("SUB", "LIG", "BIT", "ANT", "RC", "WOC")),
    ("Hydro", ("HYC", "HPS")),
)

_CODES = "[" + ", ".join(f"'{c}'" for c in BOUND_FUEL_CODES) + "]"
_AGG = ", ".join(f"'{c}'" for c in AGGREGATE_FUEL_CODES)


def _month_idx(p: str) -> str:
    return f"(TRY_CAST(substr({p}, 1, 4) AS INTEGER) * 12 + TRY_CAST(substr({p}, 6, 2) AS INTEGER) - 1)"


def _fuel_case(code: str) -> str:
    parts = " ".join(
        f"WHEN {code} IN ({', '.join(repr(c) for c in codes)}) THEN '{name}'"
        for name, codes in FUEL_CATEGORIES)
    return f"CASE {parts} ELSE 'Other' END"


def _retail_rec(load: str) -> str:
    amount = ("CAST(l_extendedprice AS DECIMAL(18,2))" if load == "b" else
              "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))")
    window = "" if load == "b" else f"""
      AND {_month_idx("strftime(o.o_orderdate, '%Y-%m')")} BETWEEN
          (SELECT max({_month_idx("strftime(o_orderdate, '%Y-%m')")}) FROM orders) - {LOOKBACK_MONTHS}
          AND (SELECT max({_month_idx("strftime(o_orderdate, '%Y-%m')")}) FROM orders)"""
    at = BACKFILL_AT if load == "b" else REVISION_AT
    return f"""
    SELECT period,
           lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_id,
           n_name AS state_name,
           CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'ALL' ELSE o_orderpriority END AS sector_id,
           CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'all sectors'
                ELSE 'priority ' || o_orderpriority END AS sector_name,
           CAST(SUM(amount) AS DOUBLE) / NULLIF(SUM(qty), 0) AS price_cents_kwh,
           SUM(qty) AS sales_mwh,
           COUNT(DISTINCT o_custkey) AS customers,
           TIMESTAMP '{at}' AS ingested_at
    FROM (
      SELECT strftime(o.o_orderdate, '%Y-%m') AS period, n.n_nationkey, n.n_name,
             o.o_orderpriority, o.o_custkey, lo.amount, lo.qty
      FROM (SELECT l_orderkey, SUM({amount}) AS amount, SUM(l_quantity) AS qty
            FROM lineitem GROUP BY l_orderkey) lo
      JOIN orders o ON lo.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey
      WHERE TRUE {window}
    ) base
    GROUP BY GROUPING SETS ((period, n_nationkey, n_name, o_orderpriority),
                            (period, n_nationkey, n_name))"""


def _generation_rec(load: str) -> str:
    qty = ("CAST(l_quantity AS DECIMAL(18,2))" if load == "b" else
           "CAST(l_quantity AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))")
    window = "" if load == "b" else f"""
      WHERE {_month_idx("strftime(l.l_shipdate, '%Y-%m')")} BETWEEN
          (SELECT max({_month_idx("strftime(l_shipdate, '%Y-%m')")}) FROM lineitem) - {LOOKBACK_MONTHS}
          AND (SELECT max({_month_idx("strftime(l_shipdate, '%Y-%m')")}) FROM lineitem)"""
    at = BACKFILL_AT if load == "b" else REVISION_AT
    return f"""
    SELECT period, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS state_id,
           fuel_type_code, 'fuel ' || lower(fuel_type_code) AS fuel_type_desc,
           CAST(SUM(q) AS DOUBLE) AS generation_mwh,
           TIMESTAMP '{at}' AS ingested_at
    FROM (
      SELECT strftime(l.l_shipdate, '%Y-%m') AS period, s.s_nationkey,
             ({_CODES})[((l.l_partkey % 20) + 20) % 20 + 1] AS fuel_type_code,
             {qty} AS q
      FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey {window}
    ) x
    GROUP BY period, s_nationkey, fuel_type_code"""


def _demand_rows(load: str) -> str:
    window = "" if load == "b" else f"""
      WHERE {_month_idx("strftime(ts, '%Y-%m')")} BETWEEN
          (SELECT max({_month_idx("strftime(ts, '%Y-%m')")}) FROM events) - {LOOKBACK_MONTHS}
          AND (SELECT max({_month_idx("strftime(ts, '%Y-%m')")}) FROM events)"""
    at = BACKFILL_AT if load == "b" else REVISION_AT
    return f"""
    SELECT date_trunc('hour', ts) AS period, event_id, ts,
           event_type AS region_id, upper(event_type) || ' GRID' AS region_name, value,
           ((TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 5) + 5) % 5 AS kmod,
           TIMESTAMP '{at}' AS ingested_at
    FROM events {window}"""


def _demand_stage(rows: str, all_series: bool = False) -> str:
    series = "" if all_series else "AND (kmod IS NULL OR kmod IN (0, 4))"
    return f"""
    SELECT period, region_id, max(region_name) AS region_name, avg(value) AS demand_mwh,
           max(ingested_at) AS ingested_at
    FROM {rows}
    WHERE period IS NOT NULL AND region_id IS NOT NULL {series}
    GROUP BY period, region_id"""


def _upsert(t: str, s: str, keys) -> str:
    cond = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return f"""
    SELECT t.* FROM {t} t WHERE NOT EXISTS (SELECT 1 FROM {s} s WHERE {cond})
    UNION ALL SELECT * FROM {s}"""


def _keep_latest(src: str, keys, cols) -> str:
    k = ", ".join(keys)
    return f"""
    SELECT {", ".join(cols)} FROM (
      SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY ingested_at DESC) AS rn FROM {src}
    ) WHERE rn = 1"""


RETAIL_COLS = ("period", "state_id", "state_name", "sector_id", "sector_name",
               "price_cents_kwh", "sales_mwh", "customers", "ingested_at")
GEN_COLS = ("period", "state_id", "fuel_type_code", "fuel_type_desc", "generation_mwh",
            "ingested_at")

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "r_raw_b": (_retail_rec("b"), ()),
    "r_raw_v": (_retail_rec("v"), ()),
    "r_b": ("SELECT * FROM r_raw_b WHERE period IS NOT NULL", ("r_raw_b",)),
    "r_v": ("SELECT * FROM r_raw_v WHERE period IS NOT NULL", ("r_raw_v",)),
    "r_stg": (_upsert("r_b", "r_v", ("period", "state_id", "sector_id")), ("r_b", "r_v")),
    "r_hist": (_keep_latest("(SELECT * FROM r_b UNION ALL SELECT * FROM r_v)",
                            ("period", "state_id", "sector_id"), RETAIL_COLS), ("r_b", "r_v")),
    "g_raw_b": (_generation_rec("b"), ()),
    "g_raw_v": (_generation_rec("v"), ()),
    "g_b": ("SELECT * FROM g_raw_b WHERE period IS NOT NULL", ("g_raw_b",)),
    "g_v": ("SELECT * FROM g_raw_v WHERE period IS NOT NULL", ("g_raw_v",)),
    "g_stg": (_upsert("g_b", "g_v", ("period", "state_id", "fuel_type_code")), ("g_b", "g_v")),
    "g_hist": (_keep_latest("(SELECT * FROM g_b UNION ALL SELECT * FROM g_v)",
                            ("period", "state_id", "fuel_type_code"), GEN_COLS), ("g_b", "g_v")),
    "d_rows_b": (_demand_rows("b"), ()),
    "d_rows_v": (_demand_rows("v"), ()),
    "d_b": (_demand_stage("d_rows_b"), ("d_rows_b",)),
    "d_v": (_demand_stage("d_rows_v"), ("d_rows_v",)),
    "d_stg": (_upsert("d_b", "d_v", ("period", "region_id")), ("d_b", "d_v")),
    "f_retail": ("""
    WITH numbered AS (
      SELECT *, row_number() OVER (PARTITION BY state_id ORDER BY period) AS n
      FROM r_stg WHERE sector_id = 'ALL' AND price_cents_kwh IS NOT NULL),
    near AS (
      -- Each row with itself and up to 11 rows before it.
      SELECT x.state_id, x.n, avg(y.price_cents_kwh) AS mean, stddev_samp(y.price_cents_kwh) AS spread
      FROM numbered x JOIN numbered y
        ON x.state_id IS NOT DISTINCT FROM y.state_id AND x.n - y.n BETWEEN 0 AND 11
      GROUP BY x.state_id, x.n)
    SELECT period, CAST(try_strptime(period || '-01', '%Y-%m-%d') AS DATE) AS period_date,
           numbered.state_id, state_name, sector_id, sector_name, price_cents_kwh, sales_mwh, customers,
           mean AS rolling_avg_12m, spread AS rolling_std_12m,
           coalesce((price_cents_kwh - mean) / nullif(spread, 0), 0.0) AS z_score,
           coalesce(abs((price_cents_kwh - mean) / nullif(spread, 0)), 0.0) > 2.5 AS is_anomaly
    FROM numbered JOIN near
      ON numbered.n = near.n AND numbered.state_id IS NOT DISTINCT FROM near.state_id""", ("r_stg",)),
    "f_gen": (f"""
    SELECT period, CAST(try_strptime(period || '-01', '%Y-%m-%d') AS DATE) AS period_date,
           state_id, fuel_type_code, fuel_type_desc, {_fuel_case("fuel_type_code")} AS fuel_category,
           generation_mwh,
           generation_mwh / NULLIF(sum(generation_mwh) OVER (PARTITION BY period, state_id), 0)
             AS generation_share
    FROM g_stg
    WHERE generation_mwh IS NOT NULL AND fuel_type_code NOT IN ({_AGG})""", ("g_stg",)),
    "f_heat": ("""
    SELECT CAST(date_trunc('month', period) AS DATE) AS month,
           CAST(hour(period) AS INTEGER) AS hour_of_day, region_id, region_name,
           avg(demand_mwh) AS avg_demand_mwh
    FROM d_stg GROUP BY 1, 2, 3, 4""", ("d_stg",)),
    "f_reg": ("""
    SELECT CAST(date_trunc('month', period) AS DATE) AS month, region_id, region_name,
           avg(demand_mwh) AS avg_demand_mwh, max(demand_mwh) AS peak_demand_mwh
    FROM d_stg GROUP BY 1, 2, 3""", ("d_stg",)),
    "f_dim": ("""
    SELECT DISTINCT state_id, state_name FROM r_stg WHERE length(state_id) = 2""", ("r_stg",)),
    "f_lead": ("""
    SELECT state_id, state_name, count(*) AS anomaly_count
    FROM f_retail WHERE is_anomaly AND length(state_id) = 2 GROUP BY 1, 2""", ("f_retail",)),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][1]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(needs, select: str) -> str:
    order = _closure(needs)
    body = ",\n".join(f"{n} AS ({CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{select}"


def rounded(cols, digits: int = 6) -> str:
    """Select list that rounds the named double columns like ``published``."""
    return ", ".join(f"round({c}, {digits}) AS {c}" if c in _DOUBLE_COLS else c for c in cols)


_DOUBLE_COLS = {"price_cents_kwh", "sales_mwh", "generation_mwh", "demand_mwh",
                "rolling_avg_12m", "rolling_std_12m", "z_score", "generation_share",
                "avg_demand_mwh", "peak_demand_mwh"}

F_RETAIL_COLS = ("period", "period_date", "state_id", "state_name", "sector_id", "sector_name",
                 "price_cents_kwh", "sales_mwh", "customers", "rolling_avg_12m",
                 "rolling_std_12m", "z_score", "is_anomaly")
F_GEN_COLS = ("period", "period_date", "state_id", "fuel_type_code", "fuel_type_desc",
              "fuel_category", "generation_mwh", "generation_share")
D_COLS = ("period", "region_id", "region_name", "demand_mwh", "ingested_at")

ORACLE = {
    "stg_retail": with_ctes(["r_b"], f"SELECT {rounded(RETAIL_COLS)} FROM r_b"),
    "stg_generation": with_ctes(["g_b"], f"SELECT {rounded(GEN_COLS)} FROM g_b"),
    "stg_rto": with_ctes(["d_b"], f"SELECT {rounded(D_COLS)} FROM d_b"),
    "keep_latest_retail": with_ctes(["r_hist"], f"SELECT {rounded(RETAIL_COLS)} FROM r_hist"),
    "keep_latest_generation": with_ctes(["g_hist"], f"SELECT {rounded(GEN_COLS)} FROM g_hist"),
    "upsert_retail": with_ctes(["r_stg"], f"SELECT {rounded(RETAIL_COLS)} FROM r_stg"),
    "upsert_generation": with_ctes(["g_stg"], f"SELECT {rounded(GEN_COLS)} FROM g_stg"),
    "upsert_rto": with_ctes(["d_stg"], f"SELECT {rounded(D_COLS)} FROM d_stg"),
    "fact_retail_prices": with_ctes(["f_retail"], f"SELECT {rounded(F_RETAIL_COLS)} FROM f_retail"),
    "fact_generation": with_ctes(["f_gen"], f"SELECT {rounded(F_GEN_COLS)} FROM f_gen"),
    "dim_state": with_ctes(["f_dim"], "SELECT * FROM f_dim ORDER BY state_id, state_name"),
    "fact_rto_heatmap": with_ctes(["f_heat"], f"""SELECT {rounded(("month", "hour_of_day",
        "region_id", "region_name", "avg_demand_mwh"))} FROM f_heat"""),
    "fact_rto_regional": with_ctes(["f_reg"], f"""SELECT {rounded(("month", "region_id",
        "region_name", "avg_demand_mwh", "peak_demand_mwh"))} FROM f_reg"""),
    "fact_anomaly_leaderboard": with_ctes(["f_lead"], """SELECT * FROM f_lead
        ORDER BY anomaly_count DESC, state_id, state_name"""),
}


# ---------------------------------------------------------------- second batch

_SHAPE_TEXT = """CASE ((event_id % 4) + 4) % 4
      WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M')
      WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%dT%HZ') END"""
_TYPE = "CASE kmod WHEN 0 THEN 'D' WHEN 1 THEN 'DF' WHEN 2 THEN 'NG' WHEN 3 THEN 'TI' END"
_CLEAN = "('Hydro', 'Wind', 'Solar & Geothermal', 'Nuclear')"
_GROUP = """CASE WHEN fuel_category IN ('Coal', 'Natural Gas') THEN 'Fossil'
      WHEN fuel_category = 'Nuclear' THEN 'Nuclear'
      WHEN fuel_category IN ('Hydro', 'Wind', 'Solar & Geothermal') THEN 'Renewable'
      ELSE 'Other' END"""

CTES.update({
    "d_text_b": (f"SELECT {_SHAPE_TEXT} AS period_text, * FROM d_rows_b", ("d_rows_b",)),
    "f_roll": ("""
    SELECT *, generation_mwh / NULLIF(sum(generation_mwh) OVER (PARTITION BY period, state_id), 0)
             AS generation_share
    FROM (SELECT period, period_date, state_id, fuel_category, sum(generation_mwh) AS generation_mwh
          FROM f_gen GROUP BY 1, 2, 3, 4)""", ("f_gen",)),
    "f_dim_sorted": ("SELECT * FROM f_dim", ("f_dim",)),
    "recs": ("""
    SELECT 'retail' AS dataset, substr(period, 1, 7) AS ym FROM r_raw_b WHERE length(period) >= 7
    UNION ALL
    SELECT 'generation', substr(period, 1, 7) FROM g_raw_b WHERE length(period) >= 7
    UNION ALL
    SELECT 'demand', strftime(ts, '%Y-%m') FROM d_rows_b WHERE ts IS NOT NULL""",
             ("r_raw_b", "g_raw_b", "d_rows_b")),
})


def _float_cell(c: str) -> str:
    t = (f"regexp_replace(regexp_replace(CAST(CAST(round({c}, 6) AS DECIMAL(38,6)) AS VARCHAR),"
         f" '0+$', ''), '\\.$', '')")
    return f"CASE WHEN {t} = '-0' THEN '0' ELSE {t} END"


def _cells(spec) -> str:
    out = []
    for name, kind in spec:
        if name in ("period", "state_id", "sector_id", "region_id"):
            e = f"'''' || CAST({name} AS VARCHAR)"
        elif kind == "bool":
            e = f"CASE WHEN {name} THEN 'TRUE' WHEN NOT {name} THEN 'FALSE' END"
        elif kind == "double":
            e = _float_cell(name)
        elif kind == "date":
            e = f"strftime({name}, '%Y-%m-%d')"
        else:
            e = f"CAST({name} AS VARCHAR)"
        out.append(f"coalesce({e}, '') AS \"{name.upper()}\"")
    return ", ".join(out)


_RETAIL_SPEC = (("period", "s"), ("period_date", "date"), ("state_id", "s"), ("state_name", "s"),
                ("sector_id", "s"), ("sector_name", "s"), ("price_cents_kwh", "double"),
                ("sales_mwh", "double"), ("customers", "int"), ("rolling_avg_12m", "double"),
                ("rolling_std_12m", "double"), ("z_score", "double"), ("is_anomaly", "bool"))
_ROLL_SPEC = (("period", "s"), ("period_date", "date"), ("state_id", "s"),
              ("fuel_category", "s"), ("generation_mwh", "double"), ("generation_share", "double"))
_HEAT_SPEC = (("month", "date"), ("hour_of_day", "int"), ("region_id", "s"),
              ("region_name", "s"), ("avg_demand_mwh", "double"))
_REG_SPEC = (("month", "date"), ("region_id", "s"), ("region_name", "s"),
             ("avg_demand_mwh", "double"), ("peak_demand_mwh", "double"))

_TABS = (("fact_retail_prices", "f_retail", "M"), ("fact_generation", "f_roll", "F"),
         ("dim_state", "f_dim", "B"), ("fact_rto_heatmap", "f_heat", "E"),
         ("fact_rto_regional", "f_reg", "E"), ("fact_anomaly_leaderboard", "f_lead", "C"))
_MARTS = (("fact_retail_prices", "f_retail"), ("fact_generation", "f_gen"),
          ("dim_state", "f_dim"), ("fact_rto_heatmap", "f_heat"),
          ("fact_rto_regional", "f_reg"), ("fact_anomaly_leaderboard", "f_lead"))


def _window_counts(dataset: str, cte: str, period: str) -> str:
    return f"""
    SELECT '{dataset}' AS dataset,
           'year=' || substr({period}, 1, 4) || '/month=' || substr({period}, 6, 2) AS partition,
           count(*) AS n_records, TIMESTAMP '{REVISION_AT}' AS ingested_at
    FROM {cte}
    WHERE {period} IS NOT NULL AND {_month_idx(period)} >=
          (SELECT max({_month_idx(period)}) FROM {cte}) - {LOOKBACK_MONTHS}
    GROUP BY 1, 2"""


_HEALTH = (("staging.retail_prices", "r_stg", "max(period)"),
           ("staging.generation", "g_stg", "max(period)"),
           ("staging.rto_demand", "d_stg", "CAST(max(period) AS VARCHAR)"),
           ("marts.fact_retail_prices", "f_retail", "max(period)"),
           ("marts.fact_generation", "f_gen", "max(period)"),
           ("marts.fact_rto_heatmap", "f_heat", "CAST(max(month) AS VARCHAR)"),
           ("marts.fact_rto_regional", "f_reg", "CAST(max(month) AS VARCHAR)"),
           ("marts.fact_anomaly_leaderboard", "f_lead", "'-'"),
           ("marts.dim_state", "f_dim", "'-'"))

ORACLE.update({
    "json_extract_rto": with_ctes(["d_text_b"], f"""
    SELECT period_text, region_id, region_name, value, {_TYPE} AS type FROM d_text_b"""),
    "parse_period": with_ctes(["d_text_b"], """
    SELECT period_text, min(date_trunc('hour', ts)) AS period, count(*) AS n_rows
    FROM d_text_b GROUP BY period_text"""),
    "split_by_month": with_ctes(["recs"], """
    SELECT dataset, ym, count(*) AS n_records FROM recs GROUP BY 1, 2"""),
    "landing_roundtrip": with_ctes(["recs"], """
    SELECT dataset, substr(ym, 1, 4) AS year, substr(ym, 6, 2) AS month, count(*) AS n_records
    FROM recs GROUP BY 1, 2, 3"""),
    "raw_window": with_ctes(["r_raw_b", "g_raw_b", "d_text_b"],
                            _window_counts("retail", "r_raw_b", "period") + " UNION ALL "
                            + _window_counts("generation", "g_raw_b", "period") + " UNION ALL "
                            + _window_counts("demand", "d_text_b", "period_text")),
    "generation_by_category": with_ctes(["f_roll"], f"""
    SELECT {rounded(("period", "period_date", "state_id", "fuel_category", "generation_mwh",
                     "generation_share"))} FROM f_roll"""),
    "headline": with_ctes(["f_gen", "f_retail", "d_stg"], f"""
    SELECT round((SELECT sum(CASE WHEN fuel_category IN {_CLEAN} THEN generation_mwh END)
                         / NULLIF(sum(generation_mwh), 0) FROM f_gen), 6) AS clean_share,
           round((SELECT avg(price_cents_kwh) FROM f_retail), 6) AS avg_price_cents_kwh,
           (SELECT count_if(z_score > 2.0) FROM f_retail) AS price_spikes,
           round((SELECT avg(demand_mwh) FROM d_stg), 6) AS avg_hourly_demand_mwh"""),
    "avg_price_by_state": with_ctes(["f_retail"], """
    SELECT state_id, state_name, round(avg(price_cents_kwh), 6) AS avg_price_cents_kwh
    FROM f_retail WHERE length(state_id) = 2 GROUP BY 1, 2"""),
    "spikes_by_state": with_ctes(["f_retail"], """
    SELECT state_id, state_name, count_if(z_score > 2.0) AS spike_months
    FROM f_retail WHERE length(state_id) = 2 GROUP BY 1, 2"""),
    "fuel_mix": with_ctes(["f_gen"], """
    SELECT period, fuel_category, round(mwh, 6) AS mwh,
           round(mwh / NULLIF(sum(mwh) OVER (PARTITION BY period), 0), 6) AS share
    FROM (SELECT period, fuel_category, sum(generation_mwh) AS mwh FROM f_gen GROUP BY 1, 2)"""),
    "fossil_nuclear_renewable": with_ctes(["f_gen"], f"""
    SELECT period, source_group, round(mwh, 6) AS mwh,
           round(mwh / NULLIF(sum(mwh) OVER (PARTITION BY period), 0), 6) AS share
    FROM (SELECT period, {_GROUP} AS source_group, sum(generation_mwh) AS mwh
          FROM f_gen GROUP BY 1, 2)"""),
    "zscore_series": with_ctes(["f_retail"], """
    SELECT state_id, period, period_date, round(z_score, 6) AS z_score, 2.0::DOUBLE AS threshold,
           z_score > 2.0 AS above_threshold FROM f_retail"""),
    "demand_by_operator": with_ctes(["d_stg"], """
    SELECT region_id, max(region_name) AS region_name, round(avg(demand_mwh), 6) AS avg_demand_mwh
    FROM d_stg GROUP BY region_id ORDER BY avg(demand_mwh) DESC NULLS LAST, region_id LIMIT 7"""),
    "validate_marts": with_ctes(["f_retail", "f_gen", "f_reg", "f_heat"], """
    SELECT 'fact_retail_prices' AS table_name, count(*) AS n_rows, max(period) AS latest FROM f_retail
    UNION ALL SELECT 'fact_generation', count(*), max(period) FROM f_gen
    UNION ALL SELECT 'fact_rto_regional', count(*), CAST(max(month) AS VARCHAR) FROM f_reg
    UNION ALL SELECT 'fact_rto_heatmap', count(*), CAST(max(month) AS VARCHAR) FROM f_heat"""),
    "health_report": with_ctes([c for _, c, _ in _HEALTH], "SELECT check_name, CASE WHEN n > 0 "
        "THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS VARCHAR) || ' rows up to ' || "
        "coalesce(latest, 'nothing') AS detail FROM (" + " UNION ALL ".join(
            f"SELECT '{name}' AS check_name, count(*) AS n, {latest} AS latest FROM {cte}"
            for name, cte, latest in _HEALTH) + ")"),
    "coverage_months": with_ctes(["recs"], """
    SELECT dataset, count(DISTINCT ym) AS n_months, max(ym) AS latest,
           CASE WHEN count(DISTINCT ym) >= 70 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM recs GROUP BY dataset"""),
    "demand_coverage": with_ctes(["d_stg"], """
    SELECT count(DISTINCT region_id) AS regions, min(period) AS first_hour,
           CASE WHEN count(DISTINCT region_id) >= 50 AND year(min(period)) = 2020
                THEN 'PASS' ELSE 'FAIL' END AS status FROM d_stg"""),
    "type_histogram": with_ctes(["d_rows_b"], f"""
    SELECT {_TYPE} AS type, count(*) AS n FROM d_rows_b GROUP BY 1 ORDER BY n DESC, type"""),
    "parse_rates": with_ctes(["d_rows_b"], """
    SELECT count(*) AS raw_rows,
           count_if(ts IS NOT NULL AND ((event_id % 4) + 4) % 4 = 0) AS parsed_strict,
           count_if(region_id IS NOT NULL) AS has_respondent,
           count_if(value IS NOT NULL) AS has_value FROM d_rows_b"""),
    "top_regions": with_ctes(["d_stg"], """
    SELECT region_id, count(*) AS n, round(avg(demand_mwh)) AS avg_mwh FROM d_stg
    GROUP BY region_id ORDER BY avg_mwh DESC NULLS LAST, region_id LIMIT 5"""),
    "staging_guard": with_ctes(["r_raw_b", "r_b", "g_raw_b", "g_b", "d_rows_b", "d_b"], """
    SELECT table_name, raw_rows, staging_rows,
           CASE WHEN raw_rows > 0 AND staging_rows = 0 THEN 'FAIL' ELSE 'PASS' END AS status
    FROM (SELECT 'retail_prices' AS table_name, (SELECT count(*) FROM r_raw_b) AS raw_rows,
                 (SELECT count(*) FROM r_b) AS staging_rows
          UNION ALL SELECT 'generation', (SELECT count(*) FROM g_raw_b), (SELECT count(*) FROM g_b)
          UNION ALL SELECT 'rto_demand', (SELECT count(*) FROM d_rows_b),
                           (SELECT count(*) FROM d_b))"""),
    "row_counts": with_ctes(["r_stg", "g_stg", "d_stg"] + [c for _, c in _MARTS],
        " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {c}" for n, c in
                           (("staging.retail", "r_stg"), ("staging.generation", "g_stg"),
                            ("staging.demand", "d_stg"))
                           + tuple((f"marts.{m}", c) for m, c in _MARTS))),
    "export_prices": with_ctes(["f_retail"], f"SELECT {_cells(_RETAIL_SPEC)} FROM f_retail"),
    "export_generation": with_ctes(["f_roll"], f"SELECT {_cells(_ROLL_SPEC)} FROM f_roll"),
    "export_dim_state": with_ctes(["f_dim"], f"""SELECT {_cells((("state_id", "s"),
        ("state_name", "s")))} FROM f_dim"""),
    "export_heatmap": with_ctes(["f_heat"], f"SELECT {_cells(_HEAT_SPEC)} FROM f_heat"),
    "export_regional": with_ctes(["f_reg"], f"SELECT {_cells(_REG_SPEC)} FROM f_reg"),
    "export_leaderboard": with_ctes(["f_lead"], f"""SELECT {_cells((("state_id", "s"),
        ("state_name", "s"), ("anomaly_count", "int")))} FROM f_lead"""),
    "export_chunks": with_ctes([c for _, c, _ in _TABS], """
    SELECT tab, chunk, chunk * 20000 + 1 AS first_line,
           least((chunk + 1) * 20000, n + 1) AS last_line,
           '''' || tab || '''!A' || CAST(chunk * 20000 + 1 AS VARCHAR) || ':' || letter
             || CAST(least((chunk + 1) * 20000, n + 1) AS VARCHAR) AS a1_range
    FROM (""" + " UNION ALL ".join(f"SELECT '{t}' AS tab, '{letter}' AS letter, count(*) AS n "
                                  f"FROM {c}" for t, c, letter in _TABS) + """) t,
         range(0, n // 20000 + 1) r(chunk)"""),
    "reconcile_export": with_ctes([c for _, c in _MARTS] + ["f_roll"], """
    SELECT m.table_name, m.mart_rows, e.export_rows,
           m.mart_rows IS NOT DISTINCT FROM e.export_rows AS counts_equal
    FROM (""" + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS mart_rows FROM {c}"
                                  for t, c in _MARTS) + """) m
    FULL OUTER JOIN (""" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS export_rows FROM {c}" for t, c, _ in _TABS)
        + ") e USING (table_name)"),
    "fact_with_state": with_ctes(["f_retail", "f_dim"], f"""
    SELECT {rounded(F_RETAIL_COLS)}, dim_state_name
    FROM f_retail LEFT JOIN (SELECT state_id AS d_id, state_name AS dim_state_name FROM f_dim) d
      ON f_retail.state_id = d.d_id"""),
    "legacy_distinct_dedup": with_ctes(["r_b", "r_v"], f"""
    SELECT {rounded(RETAIL_COLS[:-1])}, max(ingested_at) AS ingested_at
    FROM (SELECT * FROM r_b UNION ALL SELECT * FROM r_v)
    GROUP BY {", ".join(RETAIL_COLS[:-1])}"""),
    "legacy_all_series_demand": with_ctes(["d_rows_b"], f"""
    SELECT {rounded(D_COLS)} FROM ({_demand_stage("d_rows_b", all_series=True)})"""),
    "hourly_export": with_ctes(["d_stg"], """
    SELECT date_trunc('hour', period) AS hour, CAST(hour(period) AS INTEGER) AS hour_of_day,
           CAST(month(period) AS INTEGER) AS month, CAST(dayofweek(period) AS INTEGER) AS day_of_week,
           region_id, region_name, round(demand_mwh, 6) AS demand_mwh
    FROM d_stg WHERE demand_mwh IS NOT NULL"""),
})


def _half_up(expr: str, digits: str) -> str:
    return (f"CAST(round(TRY_CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) "
            f"AS DECIMAL(38,18)), {digits}) AS DOUBLE)")


def spark_round(sql: str) -> str:
    """Rewrite ``round(expr, d)`` to the published rounding: first to 10 places, then
    to ``d``, each half-up on the shortest decimal text of the double, which is how
    Spark rounds (DuckDB rounds the binary value, so a decimal tie such as 0.0640625
    would go the other way). See ``ampere.functions.casts.stable_round``."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        cut = inner.rfind(",")
        expr, digits = (inner[:cut], inner[cut + 1:].strip()) if cut >= 0 else (inner, "0")
        expr = spark_round(expr)
        out.append(sql[i:j])
        out.append(_half_up(_half_up(expr, "10"), digits))
        i = k


ORACLE.update({
    "legacy_stg_generation": with_ctes(["g_raw_b"], """
    SELECT left(period, 7) AS period, left(state_id, 10) AS state_id,
           left(fuel_type_code, 50) AS fuel_type_code, fuel_type_desc,
           round(generation_mwh, 6) AS generation_mwh, ingested_at
    FROM g_raw_b WHERE period IS NOT NULL"""),
    "pull_profile": with_ctes(["r_raw_b"], """
    SELECT count(*) AS n_records, count(DISTINCT state_id) AS n_states,
           count(DISTINCT sector_name) AS n_sectors FROM r_raw_b"""),
    "spikes_by_state_since": with_ctes(["f_retail"], """
    SELECT state_id, state_name, count_if(z_score > 2.0) AS spike_months
    FROM f_retail WHERE length(state_id) = 2 AND period >= '1999-01' GROUP BY 1, 2"""),
})


# ---------------------------------------------------------------- stored layers, dirty records

def _dirty_copies(cols, name: str, value: str, rows: str) -> str:
    """The rows, and two more copies of every eleventh, as ``ampere.sources.dirty`` places them."""
    def pick(name_expr, value_expr):
        return ", ".join(name_expr if c == name else value_expr if c == value else c for c in cols)
    return f"""
    SELECT {", ".join(cols)}, k FROM {rows}
    UNION ALL SELECT {pick(f"'~' || {name}", f"{value} + 1")}, k FROM {rows} WHERE k % 11 = 0
    UNION ALL SELECT {pick("NULL", f"{value} + 2")}, k FROM {rows} WHERE k % 11 = 0"""


def _dirty_retail(raw: str, only_repull: str) -> str:
    base = f"""(SELECT period, CASE WHEN k % 17 = 1 THEN NULL WHEN nation = 5 THEN 'LONG05' ELSE state_id END AS state_id,
        CASE WHEN nation = 3 AND period >= '1998-01' THEN 'NEW ' || state_name ELSE state_name END AS state_name,
        sector_id, sector_name, price_cents_kwh, sales_mwh, customers, ingested_at, k
      FROM (SELECT *, CAST(state_id AS INTEGER) AS nation,
              (CAST(substr(period, 1, 4) AS INTEGER) * 12 + CAST(substr(period, 6, 2) AS INTEGER) - 1) * 3
                + CAST(state_id AS INTEGER) * 7 + ascii(sector_id) AS k FROM {raw}) {only_repull})"""
    typed = _dirty_copies(RETAIL_COLS, "sector_name", "price_cents_kwh", base)
    rows = f"""(SELECT * REPLACE (CASE WHEN k % 7 = 2 THEN NULL ELSE price_cents_kwh END AS price_cents_kwh,
        CASE WHEN k % 23 = 5 THEN NULL ELSE sales_mwh END AS sales_mwh,
        CASE WHEN k % 7 = 3 THEN NULL ELSE customers END AS customers) FROM ({typed}))"""
    return _first_of(rows, ("period", "state_id", "sector_id"),
                     ("state_name", "sector_name", "price_cents_kwh", "sales_mwh", "customers"), RETAIL_COLS)


def _dirty_generation(raw: str, only_repull: str) -> str:
    base = f"""(SELECT period, CASE WHEN k % 29 = 2 THEN NULL ELSE state_id END AS state_id,
        CASE WHEN k % 17 = 1 THEN NULL ELSE fuel_type_code END AS fuel_type_code,
        fuel_type_desc, generation_mwh, ingested_at, k
      FROM (SELECT *,
              (CAST(substr(period, 1, 4) AS INTEGER) * 12 + CAST(substr(period, 6, 2) AS INTEGER) - 1) * 3
                + CAST(state_id AS INTEGER) * 7 + ascii(fuel_type_code) AS k FROM {raw}) {only_repull})"""
    typed = _dirty_copies(GEN_COLS, "fuel_type_desc", "generation_mwh", base)
    rows = f"""(SELECT * REPLACE (CASE WHEN k % 7 = 2 THEN NULL ELSE generation_mwh END AS generation_mwh)
      FROM ({typed}))"""
    return _first_of(rows, ("period", "state_id", "fuel_type_code"), ("fuel_type_desc", "generation_mwh"), GEN_COLS)


def _first_of(rows: str, keys, ties, cols) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ties)
    return f"""
    SELECT {", ".join(cols)} FROM (
      SELECT *, row_number() OVER (PARTITION BY {", ".join(keys)} ORDER BY ingested_at DESC, {order}) AS rn FROM {rows}
    ) WHERE rn = 1"""


_DIRTY_EVENTS = """
    SELECT event_id AS k, ts, event_type, value, ts - to_days(CAST(event_id % 6 AS INTEGER) * 30) AS happened,
           ((TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 5) + 5) % 5 AS kmod
    FROM events"""
_DIRTY_TEXT = """CASE WHEN k % 41 = 0 THEN NULL WHEN k % 19 = 0 THEN strftime(happened, '%Y-%m') || '-45T99'
      WHEN k % 23 = 0 THEN strftime(happened, '%Y-%m') WHEN k % 4 = 0 THEN strftime(happened, '%Y-%m-%dT%H')
      WHEN k % 4 = 1 THEN strftime(happened, '%Y-%m-%dT%H:%M') WHEN k % 4 = 2 THEN strftime(happened, '%Y-%m-%d %H:%M:%S')
      ELSE strftime(happened, '%Y-%m-%dT%HZ') END"""


def _dirty_demand(load: str) -> str:
    which = ("k % 47 <> 5" if load == "b" else
             f"happened >= (SELECT date_trunc('month', max(ts)) - INTERVAL {LOOKBACK_MONTHS} MONTH FROM x_events)")
    value = "value" if load == "b" else "value + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END"
    at = BACKFILL_AT if load == "b" else REVISION_AT
    return f"""
    SELECT date_trunc('hour', happened) AS period, event_type AS region_id,
           max(CASE WHEN k % 43 <> 0 THEN upper(event_type) || ' GRID' END) AS region_name,
           avg(CASE WHEN k % 37 = 0 OR k % 31 = 0 THEN NULL ELSE {value} END) AS demand_mwh,
           TIMESTAMP '{at}' AS ingested_at
    FROM x_events
    WHERE {which} AND k % 19 <> 0 AND k % 23 <> 0 AND k % 41 <> 0 AND k % 29 <> 0
      AND happened IS NOT NULL AND event_type IS NOT NULL AND (kmod IS NULL OR kmod IN (0, 4))
    GROUP BY 1, 2"""


_R_KEYS, _G_KEYS, _D_KEYS = (("period", "state_id", "sector_id"), ("period", "state_id", "fuel_type_code"),
                             ("period", "region_id"))

CTES.update({
    "x_r_b": (_dirty_retail("r_raw_b", "WHERE k % 19 <> 4"), ("r_raw_b",)),
    "x_r_v": (_dirty_retail("r_raw_v", ""), ("r_raw_v",)),
    "x_r_stg": (_upsert("x_r_b", "x_r_v", _R_KEYS), ("x_r_b", "x_r_v")),
    "x_g_b": (_dirty_generation("g_raw_b", "WHERE k % 19 <> 4"), ("g_raw_b",)),
    "x_g_v": (_dirty_generation("g_raw_v", ""), ("g_raw_v",)),
    "x_g_stg": (_upsert("x_g_b", "x_g_v", _G_KEYS), ("x_g_b", "x_g_v")),
    "x_events": (_DIRTY_EVENTS, ()),
    "x_d_b": (_dirty_demand("b"), ("x_events",)),
    "x_d_v": (_dirty_demand("v"), ("x_events",)),
    "x_d_stg": (_upsert("x_d_b", "x_d_v", _D_KEYS), ("x_d_b", "x_d_v")),
    "x_f_retail": (CTES["f_retail"][0].replace("FROM r_stg WHERE", "FROM x_r_stg WHERE state_id IS NOT NULL AND"),
                   ("x_r_stg",)),
    "x_f_gen": (CTES["f_gen"][0].replace("FROM g_stg", "FROM x_g_stg"), ("x_g_stg",)),
    "x_history": ("""
    SELECT state_id, state_name, period AS valid_from, lead(period) OVER (PARTITION BY state_id ORDER BY period) AS valid_to
    FROM (SELECT *, lag(state_name) OVER (PARTITION BY state_id ORDER BY period) AS was
          FROM (SELECT state_id, period, max(state_name) AS state_name FROM x_r_stg
                WHERE length(state_id) = 2 AND state_name IS NOT NULL GROUP BY 1, 2))
    WHERE was IS DISTINCT FROM state_name""", ("x_r_stg",)),
})

_LAYERS = (("retail", "x_r", _R_KEYS, RETAIL_COLS), ("generation", "x_g", _G_KEYS, GEN_COLS),
           ("demand", "x_d", _D_KEYS, D_COLS))


def _effects(target: str, source: str, keys, cols, where: str = "TRUE") -> str:
    """Counts of each effect of merging ``source`` into the rows of ``target`` that ``where`` keeps."""
    match = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    same = " AND ".join(f"s.{c} IS NOT DISTINCT FROM t.{c}" for c in cols if c not in keys and c != "ingested_at")
    keyless = " OR ".join(f"s.{k} IS NULL" for k in keys)
    return f"""
      (SELECT count(*) FROM {target} t WHERE {where} AND NOT EXISTS (SELECT 1 FROM {source} s WHERE {match})) AS kept,
      (SELECT count(*) FROM {source} s WHERE NOT ({keyless})
         AND NOT EXISTS (SELECT 1 FROM {target} t WHERE {match})) AS inserted,
      (SELECT count(*) FROM {source} s JOIN {target} t ON {match} WHERE NOT ({same})) AS replaced,
      (SELECT count(*) FROM {source} s JOIN {target} t ON {match} WHERE {same}) AS unchanged,
      (SELECT count(*) FROM {source} s WHERE {keyless}) AS reinserted"""


def _month(c: str) -> str:
    return f"substr(CAST({c} AS VARCHAR), 1, 7)"


_DIRTY_NEEDS = ["x_r_b", "x_r_v", "x_g_b", "x_g_v", "x_d_b", "x_d_v"]
_KEYLESS = (("retail", "x_r", "state_id IS NULL OR sector_id IS NULL"),
            ("generation", "x_g", "state_id IS NULL OR fuel_type_code IS NULL"))

ORACLE.update({
    "stored_retail_mart": ORACLE["fact_retail_prices"],
    "stored_demand": with_ctes(["x_d_stg"], f"SELECT {rounded(D_COLS)} FROM x_d_stg"),
    "layer_report": ORACLE["health_report"],
    "merge_effect": with_ctes(_DIRTY_NEEDS, " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, {_effects(f'{t}_b', f'{t}_v', keys, cols, where)}" for d, t, keys, cols, where in
        ((d, t, keys, cols, f"{_month('t.period')} IN (SELECT {_month('period')} FROM {t}_v)")
         for d, t, keys, cols in _LAYERS))),
    "published_chunks": ORACLE["export_chunks"],
    "reconcile_published": with_ctes([c for _, c, _ in _TABS], " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) AS n_published, TRUE AS header_equal, "
        f"TRUE AS content_equal FROM {c}" for t, c, _ in _TABS)),
    "landed_files": with_ctes(["recs"], """
    SELECT DISTINCT dataset, substr(ym, 1, 4) AS year, substr(ym, 6, 2) AS month, 1::BIGINT AS n_files,
           TRUE AS has_bytes FROM recs"""),
    "calendar_gaps": with_ctes(["recs"], """
    SELECT dataset, count(have) AS n_months, max(have) AS latest,
           coalesce(string_agg(CASE WHEN have IS NULL THEN m.ym END, ',' ORDER BY m.ym), '') AS missing,
           CASE WHEN count(have) >= 70 AND count(*) = count(have) THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT dataset, strftime(unnest(generate_series(TIMESTAMP '1994-06-01',
                   strptime(max(ym) || '-01', '%Y-%m-%d'), INTERVAL 1 MONTH)), '%Y-%m') AS ym
          FROM recs GROUP BY dataset) m
    LEFT JOIN (SELECT DISTINCT dataset, ym, ym AS have FROM recs) r USING (dataset, ym) GROUP BY dataset"""),
    "dirty_stg_retail": with_ctes(["x_r_b"], f"SELECT {rounded(RETAIL_COLS)} FROM x_r_b"),
    "dirty_stg_generation": with_ctes(["x_g_b"], f"SELECT {rounded(GEN_COLS)} FROM x_g_b"),
    "dirty_stg_rto": with_ctes(["x_d_b"], f"SELECT {rounded(D_COLS)} FROM x_d_b"),
    "dirty_upsert_rto": with_ctes(["x_d_stg"], f"SELECT {rounded(D_COLS)} FROM x_d_stg"),
    "dirty_dim_state": with_ctes(["x_r_stg"], """
    SELECT DISTINCT state_id, state_name FROM x_r_stg WHERE length(state_id) = 2"""),
    "dirty_leaderboard": with_ctes(["x_f_retail"], """
    SELECT state_id, state_name, count(*) AS anomaly_count
    FROM x_f_retail WHERE is_anomaly AND length(state_id) = 2 GROUP BY 1, 2"""),
    "dirty_fact_generation": with_ctes(["x_f_gen"], f"SELECT {rounded(F_GEN_COLS)} FROM x_f_gen"),
    "dirty_periods": with_ctes(["x_events"], f"""
    SELECT {_DIRTY_TEXT} AS period_text, count(*) AS n_rows,
           min(CASE WHEN k % 41 = 0 OR k % 19 = 0 OR k % 23 = 0 THEN NULL ELSE date_trunc('hour', happened) END) AS period
    FROM x_events WHERE k % 47 <> 5 GROUP BY 1"""),
    "state_history": with_ctes(["x_history"], "SELECT * FROM x_history"),
    "fact_with_state_at": with_ctes(["x_f_retail", "x_history"], """
    SELECT f.period, f.state_id, round(f.price_cents_kwh, 6) AS price_cents_kwh, h.state_name AS dim_state_name
    FROM x_f_retail f LEFT JOIN x_history h
      ON f.state_id = h.state_id AND f.period >= h.valid_from AND (h.valid_to IS NULL OR f.period < h.valid_to)"""),
    "upsert_idempotent": with_ctes(_DIRTY_NEEDS + ["x_r_stg", "x_g_stg", "x_d_stg"], " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, {n} AS run, {_effects(f'{t}_{target}', f'{t}_v', keys, cols)}"
        for d, t, keys, cols in _LAYERS for n, target in ((1, "b"), (2, "stg")))),
    "keyless_rows": with_ctes(["x_r_b", "x_r_v", "x_r_stg", "x_g_b", "x_g_v", "x_g_stg"], " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, {n} AS merges, "
        f"(SELECT count(*) FROM {t}_b WHERE {none}) + {n} * (SELECT count(*) FROM {t}_v WHERE {none}) AS keyless, "
        f"(SELECT count(*) FROM {t}_{'b' if n == 0 else 'stg'} WHERE NOT ({none})) AS keyed"
        for d, t, none in _KEYLESS for n in (0, 1, 2))),
    "legacy_stg_retail": with_ctes(["r_b"], f"""
    SELECT left(period, 7) AS period, {rounded(RETAIL_COLS[1:-1])}, max(ingested_at) AS ingested_at
    FROM r_b GROUP BY ALL"""),
    "legacy_stg_demand": with_ctes(["d_rows_b"], """
    SELECT CASE ((event_id % 4) + 4) % 4 WHEN 1 THEN date_trunc('minute', ts) WHEN 2 THEN date_trunc('second', ts)
             ELSE date_trunc('hour', ts) END AS period, region_id, max(region_name) AS region_name,
           round(avg(value), 6) AS demand_mwh, max(ingested_at) AS ingested_at
    FROM d_rows_b WHERE ts IS NOT NULL GROUP BY 1, 2"""),
    "demand_of_named_operators": with_ctes(["x_d_stg"], """
    SELECT region_id, max(region_name) AS region_name, round(avg(demand_mwh), 6) AS avg_demand_mwh
    FROM x_d_stg WHERE region_id IN ('click', 'purchase', 'view') GROUP BY region_id"""),
    "headline_of_region": with_ctes(["x_f_gen", "x_f_retail", "x_d_stg"], f"""
    SELECT round((SELECT sum(CASE WHEN fuel_category IN {_CLEAN} THEN generation_mwh END)
                         / NULLIF(sum(generation_mwh), 0) FROM x_f_gen WHERE period >= '1996-01'), 6) AS clean_share,
           round((SELECT avg(price_cents_kwh) FROM x_f_retail WHERE period >= '1996-01'), 6) AS avg_price_cents_kwh,
           (SELECT count_if(z_score > 2.0) FROM x_f_retail WHERE period >= '1996-01') AS price_spikes,
           round((SELECT avg(demand_mwh) FROM x_d_stg WHERE region_id = 'view'
                  AND {_month("period")} >= '1996-01'), 6) AS avg_hourly_demand_mwh"""),
})
ORACLE["dirty_hourly_export"] = with_ctes(["x_d_stg"], """
    SELECT date_trunc('hour', period) AS hour, CAST(hour(period) AS INTEGER) AS hour_of_day,
           CAST(month(period) AS INTEGER) AS month, CAST(dayofweek(period) AS INTEGER) AS day_of_week,
           region_id, region_name, round(demand_mwh, 6) AS demand_mwh
    FROM x_d_stg WHERE demand_mwh IS NOT NULL""")

ORACLE["fact_retail_prices_chunked"] = ORACLE["fact_retail_prices"]

def bigint_counts(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; Spark's count_if is BIGINT."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        out.append(f"CAST({sql[j:k]} AS BIGINT)")
        i = k


ORACLE = {name: bigint_counts(spark_round(sql)) for name, sql in ORACLE.items()}
