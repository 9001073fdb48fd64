"""DuckDB twins of the registered queries (the correctness oracle).

Written from the definitions, independently of the Spark code: one grouping
over both calendars for bars, DISTINCT ON for de-duplication, and indicators
by numbering a symbol's bars and joining every bar to the ones before it. Over
the driver's pre-registered views; every computed column is aliased to the
name the Spark side uses.
"""

from __future__ import annotations

import re

# Ordered CTE library; a query pulls in every CTE up to the last it needs.
_CTES: list[tuple[str, str]] = []
STG_ORDER = "date, open, high, low, close, volume, dividends, stock_splits, symbol"


def _cte(name: str, body: str) -> None:
    _CTES.append((name, body))


def _deps(text: str, before: int) -> set[str]:
    return {n for n, _ in _CTES[:before] if re.search(rf"\b{n}\b", text)}


def with_(last: str, select: str) -> str:
    """``select`` preceded by ``last`` and every CTE it depends on."""
    names = [n for n, _ in _CTES]
    need, todo = set(), [last] + sorted(_deps(select, len(names)))
    while todo:
        n = todo.pop()
        if n in need:
            continue
        need.add(n)
        i = names.index(n)
        todo.extend(_deps(_CTES[i][1], i))
    parts = ",\n".join(f"{n} AS (\n{b}\n)" for n, b in _CTES if n in need)
    return f"WITH {parts}\n{select}"


_cte("trades_base", """
    SELECT l_suppkey AS k,
           CAST(l_shipdate AS DATE) AS date,
           l_extendedprice / l_quantity AS open,
           l_tax, l_discount,
           CAST(l_quantity AS BIGINT) AS volume
    FROM lineitem""")
_cte("trades", """
    SELECT k, date, open,
           greatest(open, close) * 1.01e0 AS high,
           least(open, close) * 0.99e0 AS low,
           close, volume,
           0.0e0 AS dividends, 0.0e0 AS stock_splits,
           'S' || CAST(k AS VARCHAR) AS symbol
    FROM (SELECT *, open * (1.0e0 + l_tax - l_discount) AS close FROM trades_base) t""")
_cte("index_agg", """
    SELECT CAST(l_shipdate AS DATE) AS date, 'NIFTY50' AS symbol,
           CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS c,
           CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume
    FROM lineitem WHERE l_suppkey % 10 = 0 GROUP BY 1
    UNION ALL
    SELECT CAST(l_shipdate AS DATE) AS date, 'NIFTY500' AS symbol,
           CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS c,
           CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume
    FROM lineitem GROUP BY 1""")
_cte("bronze", """
    SELECT date, open, high, low, close, volume, dividends, stock_splits, symbol FROM trades
    UNION ALL
    SELECT date, p AS open, p AS high, p AS low, p AS close, volume,
           0.0e0 AS dividends, 0.0e0 AS stock_splits, symbol
    FROM (SELECT *, (c / 100.0e0) / volume AS p FROM index_agg) i""")
BEST = ", ".join(f"{c} DESC NULLS FIRST" for c in
                 ("volume", "close", "open", "high", "low", "dividends", "stock_splits"))
_cte("complete", """
    SELECT date, symbol, open, high, low, close, volume, dividends, stock_splits
    FROM bronze WHERE NOT (symbol IS NULL OR date IS NULL OR close IS NULL)""")
_cte("stg", f"""
    SELECT DISTINCT ON (symbol, date) * FROM complete ORDER BY symbol, date, {BEST}""")
# Both calendars at once: every day belongs to a week (named by its Friday,
# ISO day 5) and to a month (named by its last day).
_cte("bars", """
    SELECT p.grain AS grain, symbol, p.label AS label,
           min(date) AS first_day, max(date) AS last_day,
           arg_min_null(open, date) AS open, max(high) AS high, min(low) AS low,
           arg_max_null(close, date) AS close, CAST(sum(volume) AS BIGINT) AS volume
    FROM (SELECT *, unnest([
              {'grain': 'week', 'label': CAST(date + CAST(5 - isodow(date) AS INTEGER) AS DATE)},
              {'grain': 'month', 'label': last_day(date)}]) AS p FROM stg)
    GROUP BY p.grain, symbol, p.label""")
for _grain, _name in (("week", "weekly"), ("month", "monthly")):
    _cte(_name, f"""
    SELECT last_day AS date, symbol, open, high, low, close, volume
    FROM bars WHERE grain = '{_grain}'""")
_cte("numbered", """
    SELECT *, (high + low + close) / 3.0e0 AS typical_price,
           row_number() OVER (PARTITION BY symbol ORDER BY date) AS n
    FROM weekly WHERE symbol <> 'NIFTY50' AND symbol <> 'NIFTY500'""")
# Bar n beside the bars n - 104 .. n of its symbol; a frame is a range of
# their distance.
_tops = ",\n".join(f"           max(y.high) FILTER (WHERE x.n - y.n BETWEEN 1 AND {k}) AS prev_high_{k}w"
                   for k in (13, 26, 52, 104))
_cte("frames", f"""
    SELECT x.symbol, x.n,
           avg(y.close) FILTER (WHERE x.n - y.n < 30) AS mean30,
           count(*) FILTER (WHERE x.n - y.n < 30) AS sma_30_count,
           avg(y.typical_price) FILTER (WHERE x.n - y.n < 34) AS tp_sma_34,
           count(*) FILTER (WHERE x.n - y.n < 34) AS cci_count,
{_tops}
    FROM numbered x JOIN numbered y ON y.symbol = x.symbol AND x.n - y.n BETWEEN 0 AND 104
    GROUP BY x.symbol, x.n""")
_cte("narrow_index", "    SELECT date, close AS nifty50_close FROM weekly WHERE symbol = 'NIFTY50'")
_cte("broad_index", "    SELECT date, close AS nifty500_close FROM weekly WHERE symbol = 'NIFTY500'")
_hits = ",\n".join(f"           CAST(coalesce(close > prev_high_{k}w, false) AS INTEGER) AS is_breakout_{k}w"
                   for k in (13, 26, 52, 104))
_cte("scored", f"""
    SELECT *,
           round(close / nullif(greatest(nifty50_close, 0), 0), 6) AS rs_nifty50,
           round(close / nullif(greatest(nifty500_close, 0), 0), 6) AS rs_nifty500,
           if(sma_30_count = 30, round(mean30, 2), NULL) AS sma_30,
           if(cci_count = 34, round((typical_price - tp_sma_34)
                                    / (0.015e0 * nullif(greatest(tp_sma_34, 0), 0)), 2), NULL) AS cci_34,
{_hits}
    FROM numbered JOIN frames USING (symbol, n)
    LEFT JOIN narrow_index USING (date) LEFT JOIN broad_index USING (date)""")
_cte("gold", """
    SELECT date, symbol, open, high, low, close, volume, sma_30, cci_34,
           rs_nifty50, rs_nifty500,
           is_breakout_13w, is_breakout_26w, is_breakout_52w, is_breakout_104w
    FROM scored WHERE sma_30_count = 30""")

# Incremental-load fixture: run 2001-12-31 12:00, lookback from 1996-12-31.
_cte("master", """
    SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS company_name FROM supplier""")
_cte("control", """
    SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol,
           CASE WHEN s_suppkey % 4 = 1 THEN DATE '2001-12-31'
                ELSE CAST(DATE '2000-01-01' - CAST(s_suppkey % 7 AS INTEGER) AS DATE)
           END AS last_extract_date,
           CAST(0 AS BIGINT) AS rows_extracted,
           'seed' AS last_run_id,
           TIMESTAMP '2000-01-01 00:00:00' AS last_run_timestamp,
           'FULL' AS last_run_type,
           CASE WHEN s_suppkey % 4 = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS last_status,
           TIMESTAMP '2000-01-01 00:00:00' AS updated_at
    FROM supplier WHERE s_suppkey % 4 <> 0""")
_cte("landing_norm", f"""
    SELECT {STG_ORDER} FROM trades WHERE k % 5 <> 2""")
_cte("late_norm", f"""
    SELECT {STG_ORDER} FROM trades WHERE k % 5 = 2 AND k % 10 <> 7""")
_cte("retry_source", """
    SELECT * FROM landing_norm UNION ALL SELECT * FROM late_norm""")
_cte("watermarks", """
    SELECT symbol, last_extract_date FROM control WHERE last_status = 'SUCCESS'""")
_cte("classified", """
    SELECT m.symbol, w.last_extract_date,
           CASE WHEN w.symbol IS NULL THEN 'NEW'
                WHEN w.last_extract_date >= DATE '2001-12-31' THEN 'UP_TO_DATE'
                ELSE 'DELTA' END AS class
    FROM (SELECT DISTINCT symbol FROM master WHERE symbol IS NOT NULL) m
    LEFT JOIN watermarks w ON m.symbol = w.symbol""")
_cte("plan", """
    SELECT symbol, class,
           CASE WHEN class = 'NEW' THEN 'FULL' ELSE 'DELTA' END AS run_type,
           CASE WHEN class = 'NEW' THEN DATE '1996-12-31'
                ELSE (SELECT MIN(last_extract_date) + 1 FROM classified WHERE class = 'DELTA')
           END AS start_date,
           last_extract_date
    FROM classified WHERE class <> 'UP_TO_DATE'""")
_cte("extracted", """
    SELECT l.*, p.run_type FROM landing_norm l JOIN plan p ON l.symbol = p.symbol
    WHERE l.date >= p.start_date""")
_cte("success", """
    SELECT symbol, MAX(date) AS last_extract_date, COUNT(*) AS rows_extracted,
           run_type AS last_run_type, 'SUCCESS' AS last_status
    FROM extracted GROUP BY symbol, run_type""")
_cte("failed", """
    SELECT p.symbol,
           CASE WHEN p.run_type = 'FULL' THEN DATE '2001-12-31' ELSE p.last_extract_date END
               AS last_extract_date,
           CAST(0 AS BIGINT) AS rows_extracted, p.run_type AS last_run_type,
           'FAILED' AS last_status
    FROM plan p WHERE NOT EXISTS (SELECT 1 FROM success s WHERE s.symbol = p.symbol)""")
_cte("retry_plan", """
    SELECT symbol, class, run_type,
           CASE WHEN class = 'NEW' THEN DATE '1996-12-31' ELSE last_extract_date + 1 END
               AS start_date,
           last_extract_date
    FROM plan p WHERE EXISTS (SELECT 1 FROM failed f WHERE f.symbol = p.symbol)""")
_cte("retried_rows", """
    SELECT l.*, p.run_type FROM retry_source l JOIN retry_plan p ON l.symbol = p.symbol
    WHERE l.date >= p.start_date""")
_cte("retried", """
    SELECT symbol, MAX(date) AS last_extract_date, COUNT(*) AS rows_extracted,
           run_type AS last_run_type, 'SUCCESS' AS last_status
    FROM retried_rows GROUP BY symbol, run_type""")
_cte("first_results", """
    SELECT * FROM success UNION ALL SELECT * FROM failed""")
_cte("all_extracted", """
    SELECT * FROM extracted UNION ALL SELECT * FROM retried_rows""")
# After the retry: its successes stand in for the first attempt's failures.
_cte("final_results", """
    SELECT * FROM success UNION ALL SELECT * FROM retried
    UNION ALL SELECT * FROM failed WHERE symbol NOT IN (SELECT symbol FROM retried)""")
for _when in ("first", "final"):
    _cte(f"control_{_when}", f"""
    SELECT * FROM control c
    WHERE NOT EXISTS (SELECT 1 FROM {_when}_results r WHERE r.symbol = c.symbol)
    UNION ALL
    SELECT symbol, last_extract_date, rows_extracted, 'testrun1' AS last_run_id,
           TIMESTAMP '2001-12-31 12:00:00' AS last_run_timestamp, last_run_type, last_status,
           TIMESTAMP '2001-12-31 12:00:00' AS updated_at
    FROM {_when}_results""")
# Upsert fixture: de-duplicated trades; target before 2000-06-01, source from
# 2000-01-01 on with volume + 1.
_cte("trade_stg", f"""
    SELECT DISTINCT ON (symbol, date)
           date, open, high, low, close, volume, dividends, stock_splits, symbol
    FROM trades ORDER BY symbol, date, {BEST}""")
_cte("upserted", """
    SELECT * FROM trade_stg t
    WHERE t.date < DATE '2000-06-01'
      AND NOT EXISTS (SELECT 1 FROM trade_stg s
                      WHERE s.date >= DATE '2000-01-01' AND s.symbol = t.symbol AND s.date = t.date)
    UNION ALL
    SELECT date, open, high, low, close, volume + 1 AS volume, dividends, stock_splits, symbol
    FROM trade_stg WHERE date >= DATE '2000-01-01'""")

STG_COLS = "date, symbol, open, high, low, close, volume, dividends, stock_splits"


def _silver_gold() -> dict[str, str]:
    q = {
        "stg_not_null": with_("complete", f"SELECT {STG_COLS} FROM complete"),
        "stg_daily_prices": with_("stg", f"SELECT {STG_COLS} FROM stg"),
        "week_key": with_("stg", """
            SELECT symbol, date, CAST(date + CAST(5 - isodow(date) AS INTEGER) AS DATE)
                   AS week_ending_friday FROM stg"""),
        "month_key": with_("stg", "SELECT symbol, date, last_day(date) AS month_end FROM stg"),
        "week_boundaries": with_("bars", """
            SELECT symbol, label AS week_ending_friday, first_day, last_day
            FROM bars WHERE grain = 'week'"""),
        "month_boundaries": with_("bars", """
            SELECT symbol, label AS month_end, first_day, last_day FROM bars WHERE grain = 'month'"""),
        "period_open": with_("bars", """
            SELECT symbol, label AS week_ending_friday, first_day, open FROM bars WHERE grain = 'week'"""),
        "period_close": with_("bars", """
            SELECT symbol, label AS week_ending_friday, last_day, close FROM bars WHERE grain = 'week'"""),
        "weekly_prices": with_("weekly", "SELECT * FROM weekly"),
        "monthly_prices": with_("monthly", "SELECT * FROM monthly"),
        "benchmarks": with_("weekly", """
            SELECT DISTINCT date, nifty50_close, nifty500_close FROM weekly
            LEFT JOIN narrow_index USING (date) LEFT JOIN broad_index USING (date)"""),
        "benchmark_join": with_("scored", """
            SELECT date, symbol, close, nifty50_close, nifty500_close FROM scored"""),
        "exclude_benchmarks": with_("weekly", """
            SELECT * FROM weekly WHERE symbol NOT IN ('NIFTY50', 'NIFTY500')"""),
        "typical_price": with_("numbered", "SELECT date, symbol, typical_price FROM numbered"),
        "tp_sma_34": with_("scored", """
            SELECT date, symbol, ROUND(tp_sma_34, 6) AS tp_sma_34, cci_count FROM scored"""),
        "sma_30": with_("scored", "SELECT date, symbol, sma_30, sma_30_count FROM scored"),
        "sma_warmup": with_("scored", """
            SELECT date, symbol, close, sma_30_count FROM scored WHERE sma_30_count = 30"""),
        "cci_34": with_("scored", "SELECT date, symbol, typical_price, cci_34 FROM scored"),
        "rs_nifty50": with_("scored", "SELECT date, symbol, close, rs_nifty50 FROM scored"),
        "rs_nifty500": with_("scored", "SELECT date, symbol, close, rs_nifty500 FROM scored"),
        "weekly_technical_analysis": with_("gold", "SELECT * FROM gold"),
    }
    for n in (13, 26, 52, 104):
        q[f"breakout_{n}w"] = with_("scored", f"""
            SELECT date, symbol, close, prev_high_{n}w, is_breakout_{n}w FROM scored""")
    return q


def _summary(results: str, rows: str) -> str:
    return with_(results, f"""
            SELECT (SELECT COUNT(*) FROM classified WHERE class = 'NEW') AS new_symbols,
                   (SELECT COUNT(*) FROM classified WHERE class = 'DELTA') AS delta_symbols,
                   (SELECT COUNT(*) FROM classified WHERE class = 'UP_TO_DATE') AS up_to_date_symbols,
                   COUNT(*) FILTER (WHERE last_status = 'SUCCESS') AS symbols_ok,
                   COUNT(*) FILTER (WHERE last_status = 'FAILED') AS symbols_failed,
                   (SELECT COUNT(*) FROM {rows}) AS total_rows,
                   (SELECT MIN(date) FROM {rows}) AS min_date,
                   (SELECT MAX(date) FROM {rows}) AS max_date
            FROM {results}""")


def _incremental() -> dict[str, str]:
    return {
        "watermarks": with_("watermarks", "SELECT * FROM watermarks"),
        "symbol_classification": with_("classified", "SELECT * FROM classified"),
        "new_symbols": with_("watermarks", """
            SELECT m.symbol FROM master m
            WHERE NOT EXISTS (SELECT 1 FROM watermarks w WHERE w.symbol = m.symbol)"""),
        "known_symbols": with_("watermarks", """
            SELECT m.symbol FROM master m
            WHERE EXISTS (SELECT 1 FROM watermarks w WHERE w.symbol = m.symbol)"""),
        "class_counts": with_("classified", """
            SELECT COUNT(*) FILTER (WHERE class = 'NEW') AS new_symbols,
                   COUNT(*) FILTER (WHERE class = 'DELTA') AS delta_symbols,
                   COUNT(*) FILTER (WHERE class = 'UP_TO_DATE') AS up_to_date_symbols
            FROM classified"""),
        "delta_start_date": with_("classified", """
            SELECT MIN(last_extract_date) + 1 AS delta_start_date
            FROM classified WHERE class = 'DELTA'"""),
        "extract_plan": with_("plan", "SELECT * FROM plan"),
        "extract_planned": with_("extracted", "SELECT * FROM extracted"),
        "extract_results": with_("success", "SELECT * FROM success"),
        "failed_results": with_("failed", "SELECT * FROM failed"),
        "retry_plan": with_("retry_plan", "SELECT * FROM retry_plan"),
        "control_upsert": with_("control_final", "SELECT * FROM control_final"),
        "control_upsert_first_pass": with_("control_first", "SELECT * FROM control_first"),
        "run_summary": _summary("final_results", "all_extracted"),
        "run_summary_first_pass": _summary("first_results", "extracted"),
        "failed_symbols": with_("final_results", """
            SELECT symbol FROM final_results WHERE last_status = 'FAILED'"""),
        "failed_symbols_first_pass": with_("first_results", """
            SELECT symbol FROM first_results WHERE last_status = 'FAILED'"""),
        "incremental_run": with_("all_extracted", f"""
            SELECT DISTINCT ON (symbol, date) {STG_ORDER} FROM all_extracted
            ORDER BY symbol, date, {BEST}"""),
    }


def _bronze() -> dict[str, str]:
    return {
        "scan_bronze": with_("trades", f"""
            SELECT date, open, high, low, close, volume, dividends,
                   CAST(NULL AS DOUBLE) AS stock_splits, symbol FROM trades"""),
        "master_symbols": """
            SELECT regexp_replace(raw, '^\\s+|\\s+$', '', 'g') || '.NS' AS symbol, company_name
            FROM (SELECT CASE s_suppkey % 3 WHEN 0 THEN ' S' || s_suppkey || ' '
                              WHEN 1 THEN chr(9) || 'S' || s_suppkey || chr(13) || chr(10)
                              ELSE 'S' || s_suppkey END AS raw, s_name AS company_name FROM supplier)""",
        "landing_normalized": with_("trades", f"SELECT {STG_ORDER} FROM trades"),
        "nan_to_null": with_("trades", f"""
            SELECT date, open, high, low,
                   CASE WHEN k % 7 = 3 AND dayofmonth(date) = 1 THEN NULL ELSE close END AS close,
                   volume, dividends, stock_splits, symbol
            FROM trades"""),
        "landing_tolerant": with_("trades", """
            SELECT date, open, high, low, close, volume, CAST(NULL AS DOUBLE) AS dividends,
                   CAST(NULL AS DOUBLE) AS stock_splits, symbol FROM trades"""),
        "bronze_first_load": with_("trade_stg", f"SELECT {STG_ORDER} FROM trade_stg"),
        "bronze_upsert": with_("upserted", "SELECT * FROM upserted"),
        "table_stats": with_("upserted", """
            SELECT COUNT(*) AS row_count, COUNT(DISTINCT symbol) AS symbol_count,
                   MIN(date) AS min_date, MAX(date) AS max_date FROM upserted"""),
        "union_extracts": with_("all_extracted", "SELECT * FROM all_extracted"),
    }


def _report(layer: str, table: str, not_null=(), unique=False, accepted=()) -> str:
    parts = [f"SELECT '{layer}' AS layer, 'not_null' AS \"check\", '{c}' AS \"column\", "
             f"COUNT(*) AS violations FROM {table} WHERE {c} IS NULL" for c in not_null]
    parts += [f"SELECT '{layer}' AS layer, 'accepted_values' AS \"check\", '{c}' AS \"column\", "
              f"COUNT(DISTINCT {c}) AS violations FROM {table} "
              f"WHERE {c} IS NOT NULL AND {c} NOT IN (0, 1)" for c in accepted]
    if unique:
        parts.append(f"SELECT '{layer}' AS layer, 'unique' AS \"check\", "
                     f"'symbol || ''-'' || date' AS \"column\", COUNT(*) AS violations FROM ("
                     f"SELECT symbol || '-' || CAST(date AS VARCHAR) AS k FROM {table} "
                     f"WHERE symbol || '-' || CAST(date AS VARCHAR) IS NOT NULL "
                     f"GROUP BY 1 HAVING COUNT(*) > 1) u")
    return "\nUNION ALL\n".join(parts)


FLAGS = ["is_breakout_13w", "is_breakout_26w", "is_breakout_52w", "is_breakout_104w"]


def _checks() -> dict[str, str]:
    suite = "\nUNION ALL\n".join([
        _report("stg_daily_prices", "stg", ["date", "symbol", "close"], True),
        _report("weekly_prices", "weekly", ["date", "symbol", "close"], True),
        _report("monthly_prices", "monthly", ["date", "symbol", "close"], True),
        _report("weekly_technical_analysis", "gold", ["date", "symbol"], accepted=FLAGS),
    ])
    return {
        "bar_key": with_("stg", """
            SELECT symbol, date, symbol || '-' || CAST(date AS VARCHAR) AS bar_key FROM stg"""),
        "check_not_null": with_("trades", """
            SELECT 'landing' AS layer, 'not_null' AS "check", c AS "column", v AS violations
            FROM (SELECT COUNT(*) FILTER (WHERE date IS NULL) AS d,
                         COUNT(*) FILTER (WHERE symbol IS NULL) AS s,
                         COUNT(*) FILTER (WHERE k % 7 = 3 AND dayofmonth(date) = 1) AS cl
                  FROM trades) x,
                 (VALUES ('date'), ('symbol'), ('close')) AS t(c),
                 LATERAL (SELECT CASE c WHEN 'date' THEN d WHEN 'symbol' THEN s ELSE cl END AS v) y"""),
        "check_unique": with_("stg", "\nUNION ALL\n".join([
            _report("bronze", "bronze", unique=True),
            _report("stg_daily_prices", "stg", unique=True)])),
        "check_accepted_values": with_("gold", _report(
            "weekly_technical_analysis", "gold", accepted=FLAGS)),
        "quality_report": with_("gold", suite),
    }


def _stored() -> dict[str, str]:
    same = {**_bronze(), **_incremental(), **_silver_gold()}
    return {
        "bronze_stored_upsert": same["bronze_upsert"],
        "bronze_stored_run": same["incremental_run"],
        "control_stored": same["control_upsert"],
        "stg_view": same["stg_daily_prices"],
        "gold_bucketed": same["weekly_technical_analysis"],
        "stored_stats": with_("upserted", """
            SELECT COUNT(DISTINCT strftime(date, '%Y%m')) AS file_count, COUNT(*) AS row_count,
                   COUNT(DISTINCT symbol) AS symbol_count, MIN(date) AS min_date, MAX(date) AS max_date
            FROM upserted"""),
        "ordered_gold": with_("gold", """
            SELECT *, row_number() OVER (ORDER BY symbol, date) AS position FROM gold"""),
        "master_from_csv": """
            SELECT CASE WHEN fits THEN symbol END AS symbol, CASE WHEN fits THEN name END AS company_name,
                   CASE WHEN k % 10 = 4 THEN symbol WHEN k % 10 = 8 THEN symbol || ',"' || name || '",surplus' END AS record
            FROM (SELECT s_suppkey AS k, 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, s_suppkey % 10 NOT IN (4, 8) AS fits,
                         CASE WHEN s_suppkey % 10 = 6 THEN 'The "' || s_name || '", Ltd' ELSE s_name || ', Ltd' END AS name
                  FROM supplier) AS listed""",
        "landing_exchange_day": with_("trades", """
            SELECT CAST(timezone(CASE WHEN k % 2 = 0 THEN 'Asia/Kolkata' ELSE 'America/New_York' END,
                                 timezone('UTC', CAST(date AS TIMESTAMP) + to_hours(CAST((k * 5 + volume) % 24 AS BIGINT))
                                                 + to_minutes(30))) AS DATE) AS date,
                   open, high, low, close,
                   CAST(trunc(volume + CASE WHEN k % 2 = 0 THEN 0.25e0 ELSE 0.75e0 END) AS BIGINT) AS volume,
                   volume / 100.0e0 AS dividends, CASE WHEN k % 3 = 0 THEN 2.0e0 ELSE 0.0e0 END AS stock_splits, symbol
            FROM trades"""),
    }


def oracle_sql() -> dict[str, str]:
    out = {}
    out.update(_bronze())
    out.update(_silver_gold())
    out.update(_incremental())
    out.update(_checks())
    out.update(_stored())
    return out
