"""Independent DuckDB SQL for the registered queries, built from shared common table expressions."""

from __future__ import annotations

import math

from ..functions.student import REACH, SIMPSON_STEPS
from ..operators.forecast import SLOTS
from ..operators.segment import FEATURES, NAMES
from ..operators.stats import WEIGHTS


def r(expr: str, digits: int) -> str:
    """Same rounding as ``functions.numeric.rnd``."""
    scale = f"1e{digits}::DOUBLE"
    return f"(round_even(CAST({expr} AS DOUBLE)*{scale},0)/{scale}+0.0::DOUBLE)"


# ------------------------------------------------------------------ shared tables

_REGION_WEEKLY = """
weekly AS (
  SELECT n_name AS series, date_trunc('week', l_shipdate)::DATE + 6 AS week_ending, sum(l_quantity) AS qty
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL)"""

_PANEL = (
    _REGION_WEEKLY
    + """,
stacked AS (
  SELECT series, week_ending, qty FROM weekly
  UNION ALL SELECT 'TOTAL', week_ending, sum(qty) FROM weekly GROUP BY week_ending),
panel AS (
  SELECT *, 100.0::DOUBLE * qty
    / nullif(avg(CASE WHEN year(week_ending) = 1996 THEN qty END) OVER (PARTITION BY series), 0) AS idx
  FROM stacked)"""
)

_SITE = """
site_weekly AS (
  SELECT p_type AS series, date_trunc('week', l_shipdate)::DATE + 6 AS week_ending, sum(l_quantity) AS qty
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
site AS (
  SELECT *, 100.0::DOUBLE * qty
    / avg(CASE WHEN year(week_ending) = 1996 THEN qty END) OVER (PARTITION BY series) AS idx
  FROM site_weekly)"""


def _calendar(d: str) -> str:
    return f"""year({d})::BIGINT AS year, month({d})::BIGINT AS month, week({d})::BIGINT AS week_number,
  quarter({d})::BIGINT AS quarter,
  CASE WHEN month({d}) IN (12,1,2) THEN 'Winter' WHEN month({d}) <= 5 THEN 'Spring'
       WHEN month({d}) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season,
  (week({d}) >= 49 AND week({d}) <= 52 OR week({d}) = 1) AS is_holiday_week"""


def _fact(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT *, {_calendar('week_ending')}, coalesce(idx > 100, false) AS above_baseline,
    {r('avg(idx) OVER (PARTITION BY series ORDER BY week_ending ROWS 3 PRECEDING)', 2)} AS rolling_4w,
    {r('avg(idx) OVER (PARTITION BY series ORDER BY week_ending ROWS 11 PRECEDING)', 2)} AS rolling_12w
  FROM {source})"""


def _filled(source: str, value: str, name: str, bounds: str | None = None) -> str:
    """Dense, interpolated copy of a table with columns series, week_ending and a value."""
    return f"""
{name}_cal AS (
  SELECT unnest(generate_series(min(week_ending)::TIMESTAMP, max(week_ending)::TIMESTAMP, INTERVAL 7 DAY))::DATE
    AS week_ending FROM {bounds or source}),
{name}_dense AS (
  SELECT k.series, c.week_ending, t.{value} AS v,
    row_number() OVER (PARTITION BY k.series ORDER BY c.week_ending) AS x
  FROM (SELECT DISTINCT series FROM {source}) k CROSS JOIN {name}_cal c
       LEFT JOIN {source} t ON t.series = k.series AND t.week_ending = c.week_ending),
{name}_near AS (
  SELECT *, max(CASE WHEN v IS NOT NULL THEN x END) OVER (PARTITION BY series ORDER BY x) AS px,
    min(CASE WHEN v IS NOT NULL THEN x END) OVER (PARTITION BY series ORDER BY x
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nx
  FROM {name}_dense),
{name} AS (
  SELECT s.series, s.week_ending, s.x, s.v AS known,
    CASE WHEN s.v IS NOT NULL THEN s.v WHEN a.v IS NULL THEN b.v WHEN b.v IS NULL THEN a.v
         ELSE a.v + (b.v - a.v) * ((s.x - s.px)::DOUBLE / (s.nx - s.px)::DOUBLE) END AS idx
  FROM {name}_near s LEFT JOIN {name}_dense a ON a.series = s.series AND a.x = s.px
       LEFT JOIN {name}_dense b ON b.series = s.series AND b.x = s.nx)"""


_FACT = _PANEL + "," + _fact("panel", "fact")
_SITE_FACT = _SITE + "," + _fact("site", "site_fact")
_CLEAN = _PANEL + "," + _filled("panel", "idx", "clean")
_SITE_CLEAN = _SITE + "," + _filled("site", "idx", "site_clean")

_LINES = """
lines AS (
  SELECT 'LINES' AS series, date_trunc('week', l_shipdate)::DATE + 6 AS week_ending,
    CASE WHEN l_discount > 0 THEN l_quantity END AS idx,
    row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 AS pos
  FROM lineitem)"""

_FEED = (
    _PANEL
    + """,
marked AS (
  SELECT series, week_ending, round_even(idx * 100, 0)::BIGINT AS cents,
    row_number() OVER (PARTITION BY series ORDER BY week_ending) AS pos
  FROM panel),
copies AS (
  SELECT *, 0 AS copy FROM marked UNION ALL SELECT *, 1 FROM marked WHERE pos % 13 = 0),
feed AS (
  SELECT series,
    CASE WHEN pos % 101 = 0 THEN 'unknown' WHEN pos % 97 = 0 THEN '99999999'
         WHEN pos % 29 = 0 THEN strftime(week_ending, '%Y%m%d')
         WHEN pos % 7 = 0 THEN (week_ending - DATE '1899-12-30')::VARCHAR
         ELSE strftime(week_ending, '%Y-%m-%d') END AS week_raw,
    CASE WHEN pos % 17 = 0 THEN NULL WHEN pos % 11 = 0 THEN 'n/a'
         ELSE ((cents + copy * 100) // 100)::VARCHAR || '.'
              || lpad(((cents + copy * 100) % 100)::VARCHAR, 2, '0') END AS value_raw,
    pos * 2 + copy AS ingest_seq
  FROM copies),
typed AS (
  SELECT *, coalesce(try_cast(week_raw AS INT) BETWEEN 20000 AND 80000, false) AS serial,
    CASE WHEN regexp_full_match(week_raw, '[0-9]{8}') THEN try_strptime(week_raw, '%Y%m%d')::DATE
         WHEN coalesce(try_cast(week_raw AS INT) BETWEEN 20000 AND 80000, false)
           THEN DATE '1899-12-30' + try_cast(week_raw AS INT)
         WHEN NOT regexp_full_match(week_raw, '[0-9]+') THEN try_cast(week_raw AS DATE) END AS week_ending,
    try_cast(value_raw AS DOUBLE) AS value
  FROM feed)"""
)
_GOOD = """
good AS (SELECT * FROM typed WHERE week_ending IS NOT NULL),
kept AS (
  SELECT series, week_ending, arg_min({v: value}, ingest_seq).v AS value, min(ingest_seq) AS ingest_seq
  FROM good GROUP BY ALL)"""
_FEED_CLEAN = _FEED + "," + _GOOD + "," + _filled("kept", "value", "clean_feed", "good")
_GAPS = """
weeks AS (SELECT DISTINCT series, week_ending FROM typed WHERE week_ending IS NOT NULL),
gaps AS (
  SELECT series, lag(week_ending) OVER (PARTITION BY series ORDER BY week_ending) AS from_week,
    week_ending AS to_week FROM weeks),
wide_gaps AS (
  SELECT *, ((to_week - from_week) // 7 - 1)::BIGINT AS missing FROM gaps WHERE to_week - from_week > 9)"""
_DUPS = """
dups AS (
  SELECT series, sum(n - 1)::BIGINT AS n_dup
  FROM (SELECT series, week_ending, count(*) AS n FROM typed WHERE week_ending IS NOT NULL GROUP BY ALL)
  GROUP BY series)"""


def q(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"


# ------------------------------------------------------------------ loading and quality

def _etl() -> dict[str, str]:
    out = {
        "src_dispatch": "SELECT o_orderstatus, count(*)::BIGINT AS n FROM orders GROUP BY ALL",
        "etl_load_stats": "SELECT count(*)::BIGINT AS n_rows, 11::BIGINT AS n_cols FROM lineitem",
        "dq_null_pct": q(
            _FEED,
            f"""SELECT series, {r('100.0 * count(*) FILTER (value_raw IS NULL) / count(*)', 4)} AS pct_null
            FROM feed GROUP BY series""",
        ),
        "dq_range": q(
            _FEED,
            """SELECT series, (count(*) FILTER (value < 50 OR value > 200))::BIGINT AS n_out
            FROM typed GROUP BY series""",
        ),
        "dq_date_gaps": q(_FEED + "," + _GAPS, "SELECT series, from_week, to_week, missing, missing = 0 AS irregular FROM wide_gaps"),
        "dq_duplicates": q(_FEED + "," + _DUPS, "SELECT series, n_dup FROM dups"),
        "dq_type_check": q(
            _FEED,
            """SELECT series, (count(*) FILTER (value_raw IS NOT NULL AND value IS NULL))::BIGINT AS n_bad
            FROM typed GROUP BY series""",
        ),
        "dq_serial_dates": q(
            _FEED,
            f"""SELECT series, (count(*) FILTER (serial))::BIGINT AS n_serial,
              {r('avg(serial::INT)', 6)} AS share_serial, avg(serial::INT) > 0.5 AS is_serial_column
            FROM typed GROUP BY series""",
        ),
        "dq_bad_dates": q(
            _FEED,
            """SELECT series, (count(*) FILTER (week_ending IS NULL))::BIGINT AS n_bad_date
            FROM typed GROUP BY series""",
        ),
        "clean_dates": q(_FEED, "SELECT series, week_raw AS raw, week_ending FROM typed"),
        "clean_numeric": q(_FEED, "SELECT series, value_raw AS raw, value FROM typed"),
        "clean_dedupe": q(_FEED + "," + _GOOD, "SELECT series, week_ending, value, ingest_seq FROM kept"),
        "clean_interpolate": q(
            _FEED_CLEAN,
            f"""SELECT series, week_ending, {r('known', 6)} AS value, {r('idx', 6)} AS value_filled
            FROM clean_feed""",
        ),
        "dq_log": q(
            _FEED + "," + _GAPS + "," + _DUPS,
            """SELECT "check", series, detail, n::BIGINT AS n FROM (
              SELECT 'null' AS "check", series, 'missing values' AS detail, count(*) AS n
                FROM typed WHERE value_raw IS NULL GROUP BY series
              UNION ALL SELECT 'range', series, 'values outside [50, 200]', count(*)
                FROM typed WHERE value < 50 OR value > 200 GROUP BY series
              UNION ALL SELECT 'type', series, 'values that are no number', count(*)
                FROM typed WHERE value_raw IS NOT NULL AND value IS NULL GROUP BY series
              UNION ALL SELECT 'serial_date', series, 'weeks given as serials', count(*)
                FROM typed WHERE serial GROUP BY series
              UNION ALL SELECT 'bad_date', series, 'weeks set aside', count(*)
                FROM typed WHERE week_ending IS NULL GROUP BY series
              UNION ALL SELECT 'duplicate', series, 'repeated weeks', n_dup FROM dups WHERE n_dup > 0
              UNION ALL SELECT 'gap', series, from_week::VARCHAR || ' to ' || to_week::VARCHAR, missing
                FROM wide_gaps)""",
        ),
        "snk_panel_reload": q(_PANEL, f"SELECT series, week_ending, {r('idx', 4)} AS idx FROM panel"),
        "snk_fact_view": q(
            _FACT + "," + _SITE_FACT + """,
both_facts AS (
  SELECT coalesce('Nation of ' || n_name, series) AS label, false AS is_site, season, above_baseline, week_ending
  FROM fact LEFT JOIN nation ON n_name = series WHERE year >= 1994
  UNION ALL SELECT series, true, season, above_baseline, week_ending FROM site_fact WHERE year >= 1994)""",
            """SELECT label, is_site, season, count(*)::BIGINT AS n,
              (count(*) FILTER (above_baseline))::BIGINT AS n_above, max(week_ending) AS newest
            FROM both_facts GROUP BY label, is_site, season""",
        ),
        "etl_stats": q(
            _FEED_CLEAN + "," + _DUPS,
            """SELECT (SELECT count(*) FROM feed)::BIGINT AS rows_raw,
              (SELECT count(*) FROM clean_feed)::BIGINT AS rows_final,
              (SELECT count(*) FROM clean_feed WHERE known IS NULL AND idx IS NOT NULL)::BIGINT AS nulls_filled,
              (SELECT count(*) FROM typed WHERE value < 50 OR value > 200)::BIGINT AS anomalies_flagged,
              (SELECT sum(n_dup) FROM dups)::BIGINT AS duplicates_removed""",
        ),
    }
    out["snk_log_text"] = q(
        out["dq_log"].removeprefix("WITH RECURSIVE ").replace('SELECT "check", series, detail, n::BIGINT AS n FROM (', """SELECT
          "check" || ' | ' || series || ' | ' || detail || ' | ' || n AS line FROM ("""),
        "",
    )
    names = [f"NATION_{i}" for i in range(25)]
    wide = ", ".join(
        f"{r(f'max(CASE WHEN series = $${n}$$ THEN idx END)', 4)} AS \"{n}\"" for n in names
    )
    out["etl_wide_pivot"] = q(_PANEL, f"SELECT week_ending, {wide} FROM panel GROUP BY week_ending")
    out["tr_calendar"] = q(
        _PANEL, f"SELECT series, week_ending, {_calendar('week_ending')} FROM panel"
    )
    out["tr_flags"] = q(
        _PANEL, f"SELECT series, week_ending, {r('idx', 4)} AS idx, idx > 100 AS above_baseline FROM panel"
    )
    out["tr_vs_total"] = q(
        _CLEAN,
        f"""SELECT c.series, c.week_ending, {r('c.idx - t.idx', 2)} AS vs_total
        FROM clean c LEFT JOIN clean t ON t.series = 'TOTAL' AND t.week_ending = c.week_ending
        WHERE c.series <> 'TOTAL'""",
    )
    frame = "OVER (PARTITION BY series ORDER BY week_ending ROWS {} PRECEDING)"
    out["tr_rolling"] = q(
        _CLEAN,
        f"""SELECT series, week_ending, {r('avg(idx) ' + frame.format(3), 2)} AS rolling_4w,
          {r('avg(idx) ' + frame.format(11), 2)} AS rolling_12w FROM clean""",
    )
    out["tr_yoy_rows"] = q(
        _CLEAN,
        f"""SELECT a.series, a.week_ending, {r('a.idx - b.idx', 2)} AS yoy
        FROM clean a LEFT JOIN clean b ON b.series = a.series AND b.x = a.x - 52""",
    )
    out["tr_melt"] = q(
        _PANEL,
        f"""SELECT k.series, w.week_ending, {r('p.idx', 4)} AS idx
        FROM (SELECT n_name AS series FROM nation) k CROSS JOIN (SELECT DISTINCT week_ending FROM panel) w
             LEFT JOIN panel p ON p.series = k.series AND p.week_ending = w.week_ending""",
    )
    out["tr_labels"] = q(
        _PANEL,
        """SELECT p.series, p.n_weeks, d.label, coalesce(d.label, p.series) AS label_or_key
        FROM (SELECT series, count(*)::BIGINT AS n_weeks FROM panel GROUP BY series) p
        LEFT JOIN (SELECT n_name, n_name || ' / ' || r_name AS label FROM nation
                   JOIN region ON n_regionkey = r_regionkey) d ON d.n_name = p.series""",
    )
    return out


# ------------------------------------------------------------------ report pack

def _pack() -> dict[str, str]:
    newest = "(SELECT max(week_ending) FROM fact)"
    ranked = r("avg(idx)", 6)
    return {
        "q01_latest": q(
            _FACT,
            f"""SELECT series, week_ending, {r('idx', 4)} AS idx,
              CASE sign(idx - 100) WHEN 1 THEN 'Above baseline' WHEN 0 THEN 'At baseline'
                ELSE 'Below baseline' END AS status
            FROM fact WHERE week_ending = {newest}""",
        ),
        "q02_ranking": q(
            _FACT,
            f"""SELECT series, {r('avg(idx)', 2)} AS avg_index, {r('min(idx)', 2)} AS min_index,
              {r('max(idx)', 2)} AS max_index, {r('avg(idx) - 100', 2)} AS vs_baseline,
              (rank() OVER (ORDER BY {ranked} DESC))::BIGINT AS rank_position
            FROM fact GROUP BY series""",
        ),
        "q03_peak_trough": q(
            _FACT,
            f"""SELECT series, {r('max(idx)', 4)} AS peak_index,
              arg_max(week_ending, {{v: idx, d: DATE '1970-01-01' - week_ending}}) AS peak_week,
              {r('min(idx)', 4)} AS trough_index,
              arg_min(week_ending, {{v: idx, d: week_ending - DATE '1970-01-01'}}) AS trough_week,
              {r('max(idx) - min(idx)', 2)} AS range_amplitude
            FROM fact GROUP BY series""",
        ),
        "q04_mom": q(
            _FACT
            + """,
monthly AS (SELECT series, year, month, """ + r('avg(idx)', 9) + """ AS m FROM fact GROUP BY ALL),
steps AS (SELECT *, m - lag(m) OVER (PARTITION BY series ORDER BY year, month) AS d FROM monthly)""",
            f"""SELECT series, year, month, {r('m', 2)} AS monthly_avg, {r('d', 2)} AS mom_change,
              if({r('d', 6)} > 0, 'Improving', 'Declining') AS direction FROM steps""",
        ),
        "q05_yoy": q(
            _FACT,
            f"""SELECT a.series, a.week_ending AS current_week, {r('a.idx', 4)} AS current_index,
              {r('b.idx', 4)} AS prior_year_index, {r('a.idx - b.idx', 2)} AS yoy_change,
              {r('(a.idx - b.idx) / nullif(b.idx, 0) * 100', 2)} AS yoy_pct_change
            FROM fact a JOIN fact b ON b.series = a.series AND b.week_ending = a.week_ending - 364
            WHERE b.idx IS NOT NULL""",
        ),
        "q06_rolling": q(
            _FACT,
            f"""SELECT series, week_ending, {r('idx', 4)} AS idx, rolling_4w AS calc_rolling_4w,
              rolling_12w AS calc_rolling_12w FROM fact""",
        ),
        "q07_xmas": q(
            _FACT,
            f"""SELECT series, year, week_number, week_ending, {r('idx', 4)} AS idx,
              {r('idx - 100', 2)} AS above_baseline_pts,
              (rank() OVER (PARTITION BY year ORDER BY {r('idx', 6)} DESC))::BIGINT AS xmas_rank
            FROM fact WHERE week_number >= 49 AND week_number <= 52 AND idx > 120""",
        ),
        "q08_slump": q(
            _FACT,
            f"""SELECT series, year, week_number, week_ending, {r('idx', 4)} AS idx,
              {r('100 - idx', 2)} AS below_baseline_pts,
              (rank() OVER (PARTITION BY year ORDER BY {r('idx', 6)}))::BIGINT AS slump_rank
            FROM fact WHERE week_number <= 4 AND idx < 95""",
        ),
        "q09_vs_total": q(
            _FACT,
            f"""SELECT f.series, f.week_ending, {r('f.idx', 4)} AS series_index, {r('t.idx', 4)} AS total_index,
              {r('f.idx - t.idx', 2)} AS vs_total,
              if(f.idx > t.idx, 'Outperforming', 'Underperforming') AS relative_performance
            FROM fact f LEFT JOIN (SELECT * FROM fact WHERE series = 'TOTAL') t USING (week_ending)
            WHERE f.series <> 'TOTAL'""",
        ),
        "q10_site_winner": q(
            _SITE_FACT,
            f"""SELECT year, month, series AS site_type, {r('avg(idx)', 2)} AS avg_index,
              (rank() OVER (PARTITION BY year, month ORDER BY {ranked} DESC))::BIGINT AS monthly_rank
            FROM site_fact GROUP BY year, month, series""",
        ),
        "q11_consistent": q(
            _FACT
            + """,
shares AS (
  SELECT series, count(*) AS n, count(*) FILTER (idx > 100) AS k, 100.0::DOUBLE * k / n AS pct
  FROM fact GROUP BY series)""",
            f"""SELECT series, n::BIGINT AS total_weeks, k::BIGINT AS weeks_above,
              {r('pct', 1)} AS pct_above_baseline,
              CASE WHEN pct > 80 THEN 'Consistent Performer' WHEN pct > 50 THEN 'Mixed Performance'
                ELSE 'Below Average' END AS classification
            FROM shares WHERE n >= 10""",
        ),
        "q12_top5": q(
            _FACT,
            f"""SELECT series, week_ending, {r('idx', 4)} AS idx, season, week_number,
              CASE WHEN week_number >= 49 AND week_number <= 52 THEN 'Christmas period'
                WHEN month IN (7, 8) THEN 'Summer peak' ELSE 'Other' END AS period_context
            FROM (SELECT * FROM fact ORDER BY fact.idx DESC, series, week_ending LIMIT 5)""",
        ),
        "q13_seasonal_index": q(
            _FACT
            + """,
by_week AS (
  SELECT week_number, avg(idx) AS m, count(*) AS n, min(idx) AS lo, max(idx) AS hi
  FROM fact WHERE series = 'TOTAL' GROUP BY week_number)""",
            f"""SELECT week_number, {r('m', 2)} AS seasonal_index, {r('m - 100', 2)} AS vs_baseline,
              n::BIGINT AS sample_size, {r('lo', 2)} AS week_min, {r('hi', 2)} AS week_max,
              CASE WHEN m > 115 THEN 'HIGH' WHEN m > 105 THEN 'MODERATE' WHEN m > 95 THEN 'LOW'
                ELSE 'TROUGH' END || ' season' AS season_class FROM by_week""",
        ),
        "q14_quarters": q(
            _FACT
            + """,
quarterly AS (
  SELECT series, year, quarter, avg(idx) AS m, min(idx) AS lo, max(idx) AS hi, count(*) AS n
  FROM fact GROUP BY ALL)""",
            f"""SELECT series, year, quarter, {r('m', 2)} AS q_avg, {r('lo', 2)} AS q_min, {r('hi', 2)} AS q_max,
              n::BIGINT AS weeks_in_quarter,
              {r('m - lag(m) OVER (PARTITION BY series, quarter ORDER BY year)', 2)} AS yoy_q_change
            FROM quarterly""",
        ),
        "q15_dashboard": q(
            _FACT
            + f""",
newest AS (SELECT series, idx FROM fact WHERE week_ending = {newest}),
overall AS (
  SELECT series, {r('avg(idx)', 2)} AS m, {r('max(idx)', 2)} AS hi, {r('min(idx)', 2)} AS lo,
    rank() OVER (ORDER BY {ranked} DESC) AS place
  FROM fact GROUP BY series),
recent AS (
  SELECT series, {r('avg(idx)', 2)} AS m FROM fact WHERE week_ending >= {newest} - 84 GROUP BY series)""",
            f"""SELECT n.series, {r('n.idx', 4)} AS current_index, o.m AS avg_index, o.hi AS peak_index,
              o.lo AS trough_index, t.m AS last_12w_avg, {r('n.idx - o.m', 2)} AS vs_average,
              o.place::BIGINT AS overall_rank,
              CASE WHEN n.idx > o.m AND t.m > o.m THEN 'Strong' WHEN n.idx > 100 THEN 'Moderate'
                ELSE 'Weak' END AS health_status
            FROM newest n JOIN overall o USING (series) JOIN recent t USING (series)""",
        ),
        "v_summary": q(
            _FACT,
            f"""SELECT series, week_ending, {r('idx', 4)} AS current_index, rolling_4w AS rolling_4w_avg,
              rolling_12w AS rolling_12w_avg, above_baseline, season,
              (rank() OVER (ORDER BY {r('idx', 6)} DESC))::BIGINT AS current_rank
            FROM fact WHERE week_ending = {newest}""",
        ),
        "report_region": q(
            _FACT,
            f"""SELECT 'REGIONAL REPORT' AS report_type, series, count(*)::BIGINT AS total_weeks,
              {r('avg(idx)', 2)} AS mean_index, {r('min(idx)', 2)} AS min_index, {r('max(idx)', 2)} AS max_index,
              {r("avg(idx) FILTER (season = 'Summer')", 2)} AS summer_avg,
              {r("avg(idx) FILTER (season = 'Winter')", 2)} AS winter_avg,
              {r('avg(idx) FILTER (month = 12)', 2)} AS december_avg,
              {r('avg(idx) FILTER (month = 1)', 2)} AS january_avg,
              (count(*) FILTER (above_baseline))::BIGINT AS weeks_above_100,
              {r('100.0::DOUBLE * count(*) FILTER (above_baseline) / count(*)', 1)} AS pct_above
            FROM fact WHERE series = 'NATION_7' GROUP BY series""",
        ),
    }


# ------------------------------------------------------------------ statistics

def _t_p(t: str, df: str) -> str:
    """Two-sided p-value by Simpson's rule over the angle atan(t / sqrt(df))."""
    n = SIMPSON_STEPS
    top = f"least({math.pi / 2!r}::DOUBLE, {REACH} / sqrt({df}))"
    low = f"least(atan(abs({t}) / sqrt({df})), {top})"

    def area(lo: str) -> str:
        h = f"(({top}) - ({lo})) / {n}.0"
        weight = f"CASE WHEN i IN (0, {n}) THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END::DOUBLE"
        points = f"list_transform(range(0, {n + 1}), lambda i: {weight} * pow(cos({lo} + i * {h}), {df} - 1))"
        return f"(list_sum({points}) * {h} / 3.0)"

    return f"({area(low)} / {area('0.0::DOUBLE')})"


_TREND = (
    _CLEAN
    + """,
line AS (
  SELECT series, regr_slope(idx, x - 1) AS slope, regr_intercept(idx, x - 1) AS icpt,
    regr_r2(idx, x - 1) AS r2, regr_sxx(idx, x - 1) AS sxx, regr_syy(idx, x - 1) AS syy, count(idx) AS n
  FROM clean GROUP BY series)"""
)

#: Series cut to none (one null), one, two, three or four weeks; p-values have closed forms there.
_SHORT = (
    _PANEL
    + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY week_ending) - 1 AS pos,
    ascii(right(series, 1)) % 4 + 1 AS size FROM panel),
cut AS (
  SELECT series || '#' || (pos // size) AS series, pos % size AS x,
    CASE WHEN size > 1 OR pos % 2 = 0 THEN idx END AS v FROM placed),
line AS (
  SELECT series, regr_slope(v, x) AS slope, regr_intercept(v, x) AS icpt,
    regr_r2(v, x) AS r2, regr_sxx(v, x) AS sxx, regr_syy(v, x) AS syy, count(v) AS n
  FROM cut GROUP BY series)"""
)

_PARTS = (
    _CLEAN
    + """,
level AS (
  SELECT *, avg(idx) OVER (PARTITION BY series ORDER BY week_ending
    ROWS BETWEEN 26 PRECEDING AND 25 FOLLOWING) AS trend FROM clean),
parts AS (
  SELECT *, week(week_ending) AS wk, avg(idx - trend) OVER (PARTITION BY series, week(week_ending)) AS seasonal
  FROM level)"""
)

_MOMENTS = (
    _SITE_CLEAN
    + """,
moments AS (
  SELECT series, count(idx)::DOUBLE AS n, avg(idx) AS m, var_samp(idx) / count(idx) AS e, var_pop(idx) AS vp
  FROM site_clean GROUP BY series),
tests AS (
  SELECT a.series AS a, b.series AS b, (a.m - b.m) / sqrt(a.e + b.e) AS t,
    pow(a.e + b.e, 2) / (pow(a.e, 2) / (a.n - 1) + pow(b.e, 2) / (b.n - 1)) AS df,
    (a.m - b.m) / sqrt((a.vp + b.vp) / 2) AS d
  FROM moments a JOIN moments b ON a.series < b.series)"""
)

_CORR = (
    _CLEAN
    + f""",
pairs AS (
  SELECT p.series AS a, s.series AS b, {r('corr(p.idx, s.idx)', 3)} AS r
  FROM clean p JOIN clean s USING (week_ending) GROUP BY ALL)"""
)

_ODD = (
    _CLEAN
    + f""",
norms AS (
  SELECT series, avg(idx) AS m, stddev_pop(idx) AS sd, quantile_cont(idx, 0.25) AS q1,
    quantile_cont(idx, 0.75) AS q3 FROM clean GROUP BY series),
scored AS (
  SELECT c.series, c.week_ending, c.idx, n.m, if(n.sd > 0, (c.idx - n.m) / n.sd, 0) AS z,
    n.q1 - 1.5 * (n.q3 - n.q1) AS lo, n.q3 + 1.5 * (n.q3 - n.q1) AS hi
  FROM clean c JOIN norms n USING (series)),
odd AS (
  SELECT series, week_ending, {r('idx', 2)} AS "index", {r('z', 2)} AS z_score,
    if(abs(z) > 2.5, 'Z-score', 'IQR') AS method,
    CASE WHEN month(week_ending) = 12 AND idx > m THEN 'Christmas peak'
         WHEN month(week_ending) = 1 AND idx < m THEN 'January slump'
         WHEN month(week_ending) IN (7, 8) AND idx > m THEN 'Summer peak'
         ELSE 'Anomaly - investigate' END AS likely_cause
  FROM scored WHERE abs(z) > 2.5 OR idx < lo OR idx > hi)"""
)

_COMPOSITE = " + ".join(f"s_{name} * {w}::DOUBLE" for name, w in WEIGHTS.items())
_RANKED = (
    _CLEAN
    + f""",
shape AS (
  SELECT series, arg_max(idx, week_ending) AS last, regr_slope(idx, x - 1) AS slope, min(idx) AS lo,
    max(idx) AS hi, max(idx) FILTER (month(week_ending) = 12) AS dec, stddev_pop(idx) AS sd
  FROM clean GROUP BY series),
scores AS (
  SELECT series, least(100.0::DOUBLE, last / 1.4::DOUBLE) AS s_current,
    least(100.0::DOUBLE, greatest(0.0::DOUBLE, 50 + slope * 200)) AS s_trend,
    greatest(0.0::DOUBLE, 100 - (hi - lo)) AS s_stability,
    least(100.0::DOUBLE, (last - lo) / (hi - lo + 0.01::DOUBLE) * 100) AS s_recovery,
    CASE WHEN dec IS NULL THEN 50.0::DOUBLE ELSE least(100.0::DOUBLE, dec / 1.5::DOUBLE) END AS s_peak,
    greatest(0.0::DOUBLE, 100 - sd * 5) AS s_consistency
  FROM shape),
ranked AS (
  SELECT row_number() OVER (ORDER BY {r(_COMPOSITE, 6)} DESC, series) AS rank, series,
    {', '.join(f"{r('s_' + n, 1)} AS {n}" for n in WEIGHTS)}, {r(r(_COMPOSITE, 6), 1)} AS composite
  FROM scores)"""
)


def _summary_select(source: str, kind: str, share: str) -> str:
    return f"""SELECT '{kind}' AS kind, series, {r('avg(idx)', 2)} AS mean, {r('median(idx)', 2)} AS median,
      {r('stddev_samp(idx)', 2)} AS std, {r('min(idx)', 2)} AS min, {r('max(idx)', 2)} AS max,
      {r('arg_max(idx, week_ending)', 2)} AS latest, {share} AS above_baseline_pct
    FROM {source} GROUP BY series"""


def _facts() -> str:
    """Facts of the management report; TOTAL is the total, NATION_7 the premium series."""
    ctes = (
        _ODD
        + ","
        + _RANKED[len(_CLEAN) + 1 :]
        + ","
        + _PARTS[len(_CLEAN) + 1 :]
        + ","
        + _SITE_CLEAN
        + """,
aged AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY week_ending DESC) AS age FROM clean),
per AS (
  SELECT series, max(idx) FILTER (age = 1) AS last, max(idx) FILTER (age = 13) AS prior, avg(idx) AS mean,
    min(idx) AS lo, max(idx) AS hi, min(week_ending) AS d0, max(week_ending) AS d1, count(*) AS n
  FROM aged GROUP BY series),
total AS (SELECT * FROM per WHERE series = 'TOTAL'),
named AS (SELECT * FROM per),
site_per AS (SELECT series, arg_max(idx, week_ending) AS last, avg(idx) AS mean FROM site_clean GROUP BY series),
season AS (
  SELECT arg_max(wk, {v: round_even(seasonal * 1e9, 0), d: -x}) AS hi,
    arg_min(wk, {v: round_even(seasonal * 1e9, 0), d: x}) AS lo, max(seasonal) - min(seasonal) AS amp
  FROM parts WHERE series = 'TOTAL')"""
    )
    up = "if(last > prior, 'upward', 'downward')"
    amp = r(r("amp", 2), 1)
    rows = [
        ("10, 'start', series, NULL, (SELECT min(d0)::VARCHAR FROM per)", "total"),
        ("11, 'end', series, NULL, (SELECT max(d1)::VARCHAR FROM per)", "total"),
        ("12, 'weeks', series, (SELECT max(n) FROM per), NULL", "total"),
        ("13, 'series_count', series, (SELECT count(*) FROM per), NULL", "total"),
        (f"20, 'latest', series, {r('last', 1)}, NULL", "total"),
        (
            f"21, 'points_vs_baseline', series, {r('abs(last - 100)', 1)}, if(last > 100, 'above', 'below')",
            "total",
        ),
        ("30, 'top_ranked', series, composite, NULL", "ranked WHERE rank = 1"),
        (
            f"40, 'premium', series, {r('last - (SELECT last FROM total)', 1)}, NULL",
            "per WHERE series = 'NATION_7'",
        ),
        (f"50, 'trough', series, {r('lo', 1)}, NULL", "total"),
        (f"51, 'peak', series, {r('hi', 1)}, NULL", "total"),
        (f"60, 'direction', series, NULL, {up}", "total"),
        ("70, 'anomalies', series, (SELECT count(*) FROM odd WHERE series = 'TOTAL'), NULL", "total"),
        (f"100, 'series_latest', series, {r('last', 1)}, NULL", "named"),
        (f"101, 'series_mean', series, {r('mean', 1)}, NULL", "named"),
        (f"102, 'series_direction', series, NULL, {up}", "named"),
        (f"200, 'site_latest', series, {r('last', 1)}, NULL", "site_per"),
        (f"201, 'site_mean', series, {r('mean', 1)}, NULL", "site_per"),
        ("300, 'peak_week', 'TOTAL', hi, NULL", "season"),
        ("301, 'trough_week', 'TOTAL', lo, NULL", "season"),
        (f"302, 'amplitude', 'TOTAL', {amp}, NULL", "season"),
    ]
    body = "\nUNION ALL ".join(f"SELECT {cols} FROM {src}" for cols, src in rows)
    return q(
        ctes,
        f"""SELECT ord::BIGINT AS ord, metric, series, value::DOUBLE AS value, note::VARCHAR AS note
        FROM ({body}) f(ord, metric, series, value, note)""",
    )


def _stats() -> dict[str, str]:
    share = r("avg((idx > 100)::INT) * 100", 1)
    return {
        "an_descriptive": q(
            _CLEAN,
            f"""SELECT series, {r('avg(idx)', 2)} AS mean, {r('median(idx)', 2)} AS median,
              {r('stddev_samp(idx)', 2)} AS std, {r('min(idx)', 2)} AS min, {r('max(idx)', 2)} AS max,
              {r('quantile_cont(idx, 0.25)', 2)} AS p25, {r('quantile_cont(idx, 0.75)', 2)} AS p75
            FROM clean GROUP BY series""",
        ),
        "an_summary": q(
            _CLEAN + "," + _SITE_CLEAN,
            _summary_select("clean", "region", share)
            + " UNION ALL "
            + _summary_select("site_clean", "site_type", "NULL::DOUBLE"),
        ),
        "an_coverage": q(
            _CLEAN,
            """SELECT min(week_ending) AS start, max(week_ending) AS "end",
              count(DISTINCT week_ending)::BIGINT AS weeks, count(DISTINCT series)::BIGINT AS n_series
            FROM clean""",
        ),
        "an_trend": q(
            _TREND,
            f"""SELECT series, {r('slope', 4)} AS slope, {r('icpt', 2)} AS intercept, {r('r2', 4)} AS r_squared,
              {r('sqrt((1 - r2) * syy / sxx / (n - 2))', 4)} AS std_error,
              CASE WHEN slope > 0.1 THEN 'STRONG_UP' WHEN slope > 0.03 THEN 'MODERATE_UP'
                WHEN slope > -0.03 THEN 'FLAT' WHEN slope > -0.1 THEN 'MODERATE_DOWN'
                ELSE 'STRONG_DOWN' END AS direction
            FROM line""",
        ),
        "an_trend_short": q(
            _SHORT,
            f"""SELECT series, {r('CASE WHEN n >= 2 THEN slope END', 4)} AS slope,
              {r('CASE WHEN n >= 2 THEN icpt END', 2)} AS intercept,
              {r('CASE WHEN n >= 2 THEN CASE WHEN syy = 0 THEN 0 ELSE least(r2, 1) END END', 4)} AS r_squared,
              {r('CASE WHEN n = 2 THEN 0 WHEN n > 2 THEN sqrt((1 - least(r2, 1)) * syy / sxx / (n - 2)) END', 4)}
                AS std_error,
              CASE WHEN n < 2 THEN NULL WHEN slope > 0.1 THEN 'STRONG_UP' WHEN slope > 0.03 THEN 'MODERATE_UP'
                WHEN slope > -0.03 THEN 'FLAT' WHEN slope > -0.1 THEN 'MODERATE_DOWN'
                ELSE 'STRONG_DOWN' END AS direction
            FROM line""",
        ),
        "an_trend_p_short": q(
            _SHORT + ", tt AS (SELECT series, n, sqrt(r2 * (n - 2) / (1 - r2)) AS t FROM line)",
            f"""SELECT series, {r("CASE n WHEN 3 THEN 1 - 2 / pi() * atan(t) WHEN 4 THEN 1 - t / sqrt(2 + t * t) END", 6)}
              AS p_value FROM tt""",
        ),
        "an_trend_p": q(
            _TREND + ", tt AS (SELECT series, n - 2.0::DOUBLE AS df, sqrt(r2 * (n - 2) / (1 - r2)) AS t FROM line)",
            f"SELECT series, {r(_t_p('t', 'df'), 6)} AS p_value FROM tt",
        ),
        "an_decompose": q(
            _PARTS,
            f"""SELECT series, week_ending, {r('idx', 4)} AS observed, {r('trend', 2)} AS trend,
              {r('seasonal', 2)} AS seasonal, {r('idx - trend - seasonal', 2)} AS residual FROM parts""",
        ),
        "an_season_summary": q(
            _PARTS,
            f"""SELECT series,
              arg_max(wk, {{v: round_even(seasonal * 1e9, 0), d: -x}})::BIGINT AS peak_week,
              arg_min(wk, {{v: round_even(seasonal * 1e9, 0), d: x}})::BIGINT AS trough_week,
              {r('max(seasonal) - min(seasonal)', 2)} AS amplitude
            FROM parts GROUP BY series""",
        ),
        "an_corr": q(_CORR, "SELECT a, b, r FROM pairs"),
        "an_corr_extremes": q(
            _CORR,
            """SELECT 'most' AS kind, * FROM (SELECT a, b, r FROM pairs WHERE a < b ORDER BY r DESC, a DESC, b DESC LIMIT 1)
            UNION ALL
            SELECT 'least', * FROM (SELECT a, b, r FROM pairs WHERE a < b ORDER BY r, a, b LIMIT 1)""",
        ),
        "an_anomalies": q(_ODD, "SELECT * FROM odd"),
        "an_site_profile": q(
            _SITE_CLEAN,
            f"""SELECT series AS site_type, {r('avg(idx)', 2)} AS mean, {r('stddev_samp(idx)', 2)} AS std,
              {r('min(idx)', 2)} AS min, {r('max(idx)', 2)} AS max,
              {r('avg(idx) FILTER (month(week_ending) = 12)', 2)} AS xmas_peak,
              {r('avg(idx) FILTER (month(week_ending) = 1)', 2)} AS jan_trough
            FROM site_clean GROUP BY series""",
        ),
        "an_site_welch": q(
            _MOMENTS,
            f"SELECT a, b, {r('t', 3)} AS t_stat, {r('df', 3)} AS df, {r('d', 3)} AS cohens_d FROM tests",
        ),
        "an_site_welch_p": q(
            _MOMENTS + f", pv AS (SELECT a, b, {_t_p('t', 'df')} AS p FROM tests)",
            f"SELECT a, b, {r('p', 6)} AS p_value, p < 0.05 AS significant FROM pv",
        ),
        "an_ranking": q(_RANKED, "SELECT * FROM ranked"),
        "an_report_facts": _facts(),
    }


# ------------------------------------------------------------------ forecasts

def _fitted(holdout: int = 0) -> str:
    """Aged rows, slot means and the fitted line and level of every series."""
    return (
        _CLEAN
        + f""",
old AS (
  SELECT series, week_ending, idx, row_number() OVER (PARTITION BY series ORDER BY week_ending DESC) AS back
  FROM clean),
train AS (
  SELECT series, week_ending, idx, back - {holdout} AS age, week(week_ending) % {SLOTS} AS slot,
    count(*) OVER (PARTITION BY series) AS n
  FROM old WHERE back > {holdout}),
means AS (SELECT series, avg(idx) AS m, max(week_ending) AS last_week, max(n) AS n FROM train GROUP BY series),
slots AS (SELECT series, slot, avg(idx) AS m FROM train GROUP BY series, slot),
recent AS (
  SELECT series, regr_slope(idx, -age::DOUBLE) AS slope, regr_intercept(idx, -age::DOUBLE) AS level,
    regr_r2(idx, -age::DOUBLE) AS r2, regr_syy(idx, -age::DOUBLE) AS syy, count(*) AS k
  FROM train WHERE age <= 26 GROUP BY series),
smooth AS (
  SELECT series, sum(idx * CASE WHEN age = n THEN pow(0.7::DOUBLE, n - 1)
    ELSE 0.3::DOUBLE * pow(0.7::DOUBLE, age - 1) END) AS ewma
  FROM train GROUP BY series)"""
    )


def _ahead(h: int, holdout: int = 0) -> str:
    point = "(v.level + v.slope * (i - 1) + coalesce(s.m - m.m, 0) * 0.3::DOUBLE)"
    return (
        _fitted(holdout)
        + f""",
steps AS (
  SELECT v.series, i, m.n, m.last_week + (i * 7)::INT AS week_ending, {point} AS p,
    1.96::DOUBLE * sqrt(v.syy * (1 - v.r2) / v.k) * sqrt(1 + 1.0::DOUBLE / v.k) * (1 + i * 0.1::DOUBLE) AS w,
    {r('e.ewma', 2)} AS ma
  FROM recent v JOIN means m USING (series) JOIN smooth e USING (series)
       CROSS JOIN (SELECT unnest(range(1, {h + 1})) AS i) h
       LEFT JOIN slots s ON s.series = v.series AND s.slot = (week(m.last_week) + i) % {SLOTS}),
lin AS (SELECT *, {r('p', 2)} AS mid, {r('p + w', 2)} AS hi, {r('p - w', 2)} AS lo FROM steps),
ens AS (
  SELECT series, i, week_ending, n, mid, ma, hi, lo,
    {r('0.6::DOUBLE * mid + 0.4::DOUBLE * ma', 2)} AS forecast,
    {r('0.6::DOUBLE * hi + 0.4::DOUBLE * (ma + 3)', 2)} AS upper_95,
    {r('0.6::DOUBLE * lo + 0.4::DOUBLE * (ma - 3)', 2)} AS lower_95
  FROM lin)"""
    )


_ENS = _ahead(8)


def _forecasts() -> dict[str, str]:
    summary = f"{r('avg(forecast)', 1)} AS avg_forecast, if(avg(forecast) > 100, 'Above 100', 'Below 100') AS status"
    return {
        "fc_seasonal_index": q(
            _fitted(),
            f"""SELECT m.series, g.slot::BIGINT AS slot, {r('coalesce(s.m - m.m, 0)', 4)} AS seasonal
            FROM means m CROSS JOIN (SELECT unnest(range(0, {SLOTS})) AS slot) g
                 LEFT JOIN slots s ON s.series = m.series AND s.slot = g.slot""",
        ),
        "fc_linear": q(
            _ENS,
            "SELECT series, i::BIGINT AS week_ahead, mid AS forecast, hi AS upper_95, lo AS lower_95 FROM lin",
        ),
        "fc_linear_model": q(
            _fitted(),
            f"""SELECT series, {r('slope', 4)} AS slope, {r('r2', 4)} AS r_squared,
              {r('sqrt(syy * (1 - r2) / k)', 3)} AS residual_std FROM recent""",
        ),
        "fc_ewma": q(_fitted(), f"SELECT series, {r('ewma', 2)} AS last_ewma FROM smooth"),
        "fc_ensemble": q(
            _ENS,
            "SELECT series, i::BIGINT AS week_ahead, week_ending, forecast, upper_95, lower_95 FROM ens",
        ),
        "fc_summary": q(_ENS, f"SELECT series, {summary} FROM ens GROUP BY series"),
        "fc_eval": q(
            _ahead(12, 12)
            + f""",
guess AS (
  SELECT e.series, o.idx AS y, unnest([{{o: 0, model: 'Linear+Seasonal', f: e.mid}},
    {{o: 1, model: 'Exponential MA', f: e.ma}}, {{o: 2, model: 'Ensemble', f: e.forecast}}]) AS g
  FROM ens e JOIN old o ON o.series = e.series AND o.back = 13 - e.i WHERE e.n > 26),
errors AS (
  SELECT series, g.o AS o, g.model AS model, {r('avg(abs(y - g.f))', 3)} AS mae,
    {r('sqrt(avg((y - g.f) * (y - g.f)))', 3)} AS rmse,
    {r('avg(abs((y - g.f) / (y + 0.01::DOUBLE))) * 100', 2)} AS mape
  FROM guess GROUP BY ALL)""",
            """SELECT series, model, mae, rmse, mape,
              row_number() OVER (PARTITION BY series ORDER BY rmse, o) = 1 AS best FROM errors""",
        ),
    }


# ------------------------------------------------------------------ segments

_FEATURES = (
    _CLEAN
    + f""",
aged AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY week_ending DESC) AS age FROM clean),
raw_feat AS (
  SELECT series, avg(idx) AS m, stddev_pop(idx) AS sd, regr_slope(idx, x - 1) AS slope, min(idx) AS lo,
    max(idx) AS hi, avg(idx) FILTER (month(week_ending) = 12) AS dec,
    avg(idx) FILTER (month(week_ending) = 1) AS jan, max(idx) FILTER (age = 1) AS last,
    max(idx) FILTER (age = 53) AS prior
  FROM aged GROUP BY series),
feat AS (
  SELECT series, {r('m', 2)} AS mean_index, {r('sd', 2)} AS std_index, {r('slope', 4)} AS trend_slope,
    {r('hi - lo', 2)} AS seasonal_amplitude, coalesce({r('dec', 2)}, m) AS christmas_peak,
    coalesce({r('jan', 2)}, m) AS january_trough,
    {r('(last - lo) / (hi - lo + 0.01::DOUBLE)', 3)} AS recovery_rate, {r('last', 2)} AS current_index,
    {r('coalesce(last - prior, 0)', 2)} AS yoy_change
  FROM raw_feat)"""
)
_NORM = (
    _FEATURES
    + ", norm AS (SELECT feat.*, "
    + ", ".join(
        f"({f} - avg({f}) OVER ()) / (stddev_pop({f}) OVER () + 1e-8::DOUBLE) AS z_{f}" for f in FEATURES
    )
    + " FROM feat)"
)


def _kmeans() -> str:
    """Lloyd's iterations as a recursive query over points given as lists, seeded by key hash.

    Rows of ``cent`` are (iteration, k, centroid number, coordinates); 60 passes are far beyond the
    point where 26 points stop moving."""
    return (
        _NORM
        + f""",
pts AS (
  SELECT series, [{', '.join('z_' + f for f in FEATURES)}]::DOUBLE[8] AS p,
    row_number() OVER (ORDER BY md5(series)) - 1 AS seed FROM norm),
ks AS (SELECT unnest([2, 3, 4]) AS k),
cent(it, k, c, p) AS (
  SELECT 0, k, seed, p FROM ks JOIN pts ON seed < k
  UNION ALL
  SELECT it + 1, k, c, coalesce(moved, p)::DOUBLE[8] FROM (
    SELECT o.it, o.k, o.c, o.p, g.moved FROM cent o LEFT JOIN (
      SELECT k, c, [{', '.join(f'avg(x[{i}])' for i in range(1, 9))}] AS moved FROM (
        SELECT e.k, pts.p AS x, arg_min(e.c, {{d: array_distance(pts.p, e.p), c: e.c}}) AS c
        FROM pts CROSS JOIN cent e GROUP BY e.k, pts.series, pts.p)
      GROUP BY k, c) g ON g.k = o.k AND g.c = o.c)
  WHERE it < 60),
labels AS (
  SELECT e.k, pts.series, pts.p, arg_min(e.c, {{d: array_distance(pts.p, e.p), c: e.c}}) AS c
  FROM pts CROSS JOIN cent e WHERE e.it = 60 GROUP BY e.k, pts.series, pts.p),
far AS (
  SELECT a.k, a.series, a.c AS own, b.c AS other, sum(array_distance(a.p, b.p)) AS dist,
    count(*) FILTER (a.p <> b.p) AS unequal, count(*) AS n
  FROM labels a JOIN labels b ON a.k = b.k GROUP BY ALL),
ab AS (
  SELECT k, series, coalesce(max(dist / unequal) FILTER (own = other AND unequal > 0), 0) AS a,
    min(dist / n) FILTER (own <> other) AS b
  FROM far GROUP BY ALL),
scores AS (SELECT k, coalesce(avg((b - a) / greatest(a, b, 1e-8)), -1) AS score FROM ab GROUP BY k),
apart AS (
  SELECT a.k, a.series, a.c AS own, b.c AS other, sum(pow(array_distance(a.p, b.p), 2)) AS dist, count(*) AS n
  FROM labels a JOIN labels b ON a.k = b.k GROUP BY ALL),
sides AS (
  SELECT k, series, max(CASE WHEN own = other THEN if(n > 1, dist / (n - 1), 0) END) AS a,
    min(CASE WHEN own <> other THEN dist / n END) AS b
  FROM apart GROUP BY ALL),
squared AS (SELECT k, coalesce(avg((b - a) / greatest(a, b, 1e-8)), -1) AS score FROM sides GROUP BY k),
chosen AS (
  SELECT l.series, l.c::BIGINT AS cluster_id FROM labels l
  WHERE l.k = (SELECT k FROM squared ORDER BY score DESC, k LIMIT 1)),
named AS (
  SELECT cluster_id, ([{', '.join(f"'{n}'" for n in NAMES)}])[row_number() OVER (ORDER BY avg(mean_index) DESC, cluster_id)]
    AS cluster_name
  FROM chosen JOIN feat USING (series) GROUP BY cluster_id),
clustered AS (
  SELECT feat.*, cluster_id, cluster_name FROM feat JOIN chosen USING (series) JOIN named USING (cluster_id))"""
    )


def _axis(name: str, matrix: str) -> str:
    """Leading axis of a symmetric matrix by repeated squaring: m**(2**16) tends to v v'."""
    return f"""
{name}_pow(i, m) AS (
  SELECT 0, c FROM {matrix}
  UNION ALL
  SELECT i + 1, [[list_dot_product(a, b) / list_sum([list_dot_product(d, d) for d in m]) for b in m] for a in m]
  FROM {name}_pow WHERE i < 16),
{name}_row AS (
  SELECT m[list_position([m[j][j] for j in range(1, 9)], list_max([m[j][j] for j in range(1, 9)]))] AS w
  FROM {name}_pow WHERE i = 16),
{name}_unit AS (SELECT [x / sqrt(list_dot_product(w, w)) for x in w] AS u FROM {name}_row),
{name} AS (
  SELECT [x * sign(u[list_position([abs(y) for y in u], list_max([abs(y) for y in u]))]) for x in u] AS v,
    list_dot_product(u, [list_dot_product(a, u) for a in c]) AS ev, c
  FROM {name}_unit CROSS JOIN {matrix})"""


_COV = "cov AS (SELECT [" + ", ".join(
    "[" + ", ".join(f"avg(z_{a} * z_{b})" for b in FEATURES) + "]" for a in FEATURES
) + "] AS c FROM norm)"
_PCA = f"""{_COV},{_axis("ax1", "cov")},
rest AS (SELECT [[c[i][j] - ev * v[i] * v[j] for j in range(1, 9)] for i in range(1, 9)] AS c FROM ax1),
{_axis("ax2", "rest")}"""


def _segments() -> dict[str, str]:
    km = _kmeans()
    p = f"[{', '.join('z_' + f for f in FEATURES)}]"
    whole = "list_sum([ax1.c[i][i] for i in range(1, 9)])"
    top = ", ".join(FEATURES)
    return {
        "sg_features": q(_FEATURES, "SELECT * FROM feat"),
        "sg_normalised": q(
            _NORM, "SELECT series, " + ", ".join(f"{r('z_' + f, 6)} AS z_{f}" for f in FEATURES) + " FROM norm"
        ),
        "sg_kmeans": q(km, "SELECT series, k::BIGINT AS k, c::BIGINT AS cluster_id FROM labels"),
        "sg_silhouette": q(km, f"SELECT k::BIGINT AS k, {r('score', 6)} AS score FROM scores"),
        "sg_silhouette_squared": q(
            km, f"SELECT k::BIGINT AS k, {r('score', 6)} AS score FROM squared"
        ),
        "sg_clusters": q(
            km, "SELECT series, cluster_id, cluster_name, mean_index, current_index FROM clustered"
        ),
        "sg_pca": q(
            km + "," + _PCA,
            f"""SELECT series, {r(f'list_dot_product({p}, ax1.v)', 4)} AS pc1,
              {r(f'list_dot_product({p}, ax2.v)', 4)} AS pc2, cluster_name AS cluster
            FROM norm JOIN (SELECT series, cluster_name FROM clustered) USING (series), ax1, ax2""",
        ),
        "sg_pca_variance": q(
            _NORM + "," + _PCA,
            f"""SELECT component, {r('100 * share', 2)} AS explained_pct, (SELECT count(*) FROM feat) AS n_series
            FROM (SELECT 1::BIGINT AS component, ax1.ev / {whole} AS share FROM ax1
                  UNION ALL SELECT 2, ax2.ev / {whole} FROM ax1, ax2)""",
        ),
        "sg_profiles": q(
            km
            + ", prof AS (SELECT cluster_name, "
            + ", ".join(f"{r(f'avg({f})', 2)} AS {f}" for f in FEATURES)
            + " FROM clustered GROUP BY cluster_name)",
            f"""SELECT *, ([{', '.join(f"'{f}'" for f in FEATURES)}])
              [list_position([{top}], greatest({top}))] AS top_feature FROM prof""",
        ),
    }


# ------------------------------------------------------------------ chart data and alerts

def _views() -> dict[str, str]:
    months = ", ".join(
        f"{r(f'avg(idx) FILTER (month(week_ending) = {m})', 2)} AS m{m:02d}" for m in range(1, 13)
    )
    dims = [*WEIGHTS, "composite"]
    return {
        "ch_month_heatmap": q(
            _CLEAN, f"SELECT series, {months} FROM clean WHERE series <> 'TOTAL' GROUP BY series"
        ),
        "ch_trends": q(
            _CLEAN,
            f"""SELECT series, week_ending, {r('idx', 2)} AS idx, 100.0::DOUBLE AS baseline,
              series = 'TOTAL' AS is_total FROM clean""",
        ),
        "ch_site": q(
            _SITE_CLEAN,
            f"""SELECT series AS site_type, week_ending, {r('idx', 2)} AS idx,
              {r('avg(idx) OVER (PARTITION BY series ORDER BY week_ending ROWS 3 PRECEDING)', 2)} AS rolling_4w
            FROM site_clean""",
        ),
        "ch_ranking": q(
            _RANKED + ", bars AS (SELECT *, row_number() OVER (ORDER BY rank DESC) AS bar FROM ranked)",
            """SELECT bar, series, composite,
              CASE WHEN rank = 1 THEN 'best' WHEN bar <= 3 THEN 'bottom' ELSE 'rest' END AS bar_group
            FROM bars""",
        ),
        "ch_corr_lower": q(_CORR, "SELECT a, b, r FROM pairs WHERE a >= b"),
        "ch_forecast": q(
            _ENS,
            f"""SELECT series, week_ending, 'actual' AS kind, {r('idx', 2)} AS idx,
              NULL::DOUBLE AS upper_95, NULL::DOUBLE AS lower_95 FROM old WHERE back <= 20
            UNION ALL SELECT series, week_ending, 'forecast', forecast, upper_95, lower_95 FROM ens""",
        ),
        "ch_anomaly_picks": q(
            _ODD
            + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY "index" DESC, week_ending) AS up,
    row_number() OVER (PARTITION BY series ORDER BY "index", week_ending) AS down FROM odd)""",
            """SELECT series, week_ending, "index", likely_cause, 'high' AS pick FROM placed WHERE up <= 3
            UNION ALL SELECT series, week_ending, "index", likely_cause, 'low' FROM placed WHERE down <= 2""",
        ),
        "al_below_runs": q(
            _CLEAN
            + """,
marks AS (SELECT series, x, idx < 100 AS low, sum((idx >= 100)::INT) OVER (PARTITION BY series ORDER BY x) AS grp FROM clean),
runs AS (SELECT series, grp, count(*) FILTER (low) AS len, max(x) AS ends FROM marks GROUP BY series, grp),
per AS (SELECT series, max(len) AS longest, arg_max(len, ends) AS now FROM runs GROUP BY series)""",
            """SELECT series, longest::BIGINT AS longest_run, now::BIGINT AS current_run,
              CASE WHEN now >= 6 THEN 'red' WHEN now > 0 OR longest >= 6 THEN 'amber' ELSE 'green' END AS status
            FROM per""",
        ),
        "al_impact": q(
            _FACT
            + f""",
change AS (
  SELECT a.series, a.week_ending, {r('a.idx - b.idx', 2)} AS d
  FROM fact a JOIN fact b ON b.series = a.series AND b.week_ending = a.week_ending - 364),
newest AS (SELECT series, arg_max(d, week_ending) AS d FROM change GROUP BY series)""",
            f"""SELECT series, d AS index_change, {r('d * 1000', 2)} AS revenue_change,
              {r('d * 1000 * 0.3::DOUBLE', 2)} AS margin_change FROM newest""",
        ),
        "al_calendar": q(
            _ENS,
            f"""SELECT week_ending, count(*)::BIGINT AS n_series,
              (count(*) FILTER (forecast > 100))::BIGINT AS n_above, {r('avg(forecast)', 2)} AS avg_forecast
            FROM ens GROUP BY week_ending""",
        ),
        "al_grades": q(
            _RANKED
            + ", long AS ("
            + " UNION ALL ".join(f"SELECT series, '{d}' AS dimension, {d} AS score FROM ranked" for d in dims)
            + ")",
            """SELECT *, CASE WHEN score >= 80 THEN 'A' WHEN score >= 65 THEN 'B' WHEN score >= 50 THEN 'C'
              WHEN score >= 35 THEN 'D' ELSE 'E' END AS grade FROM long""",
        ),
    }


def _long_series() -> dict[str, str]:
    """One series of all lines, in one window each."""
    filled = """CASE WHEN n.idx IS NOT NULL THEN n.idx WHEN a.idx IS NULL THEN b.idx WHEN b.idx IS NULL THEN a.idx
      ELSE a.idx + (b.idx - a.idx) * ((n.pos - px)::DOUBLE / (nx - px)::DOUBLE) END"""
    return {
        "tr_rolling_lines": q(
            _LINES,
            f"""SELECT pos, idx, {r('avg(idx) OVER (ORDER BY pos ROWS 3 PRECEDING)', 2)} AS rolling_4,
              {r('avg(idx) OVER (ORDER BY pos ROWS 11 PRECEDING)', 2)} AS rolling_12 FROM lines""",
        ),
        "clean_interpolate_lines": q(
            _LINES
            + """,
near AS (
  SELECT *, max(CASE WHEN idx IS NOT NULL THEN pos END) OVER (ORDER BY pos) AS px,
    min(CASE WHEN idx IS NOT NULL THEN pos END) OVER (ORDER BY pos
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nx FROM lines)""",
            f"""SELECT n.series, n.pos, n.idx, {r(filled, 6)} AS idx_filled
            FROM near n LEFT JOIN lines a ON a.pos = px LEFT JOIN lines b ON b.pos = nx""",
        ),
        "an_decompose_lines": q(
            _LINES
            + """,
wide AS (
  SELECT *, avg(idx) OVER (ORDER BY pos ROWS BETWEEN 26 PRECEDING AND 25 FOLLOWING) AS trend FROM lines),
parts AS (
  SELECT *, avg(idx - trend) OVER (PARTITION BY week(week_ending)) AS seasonal FROM wide)""",
            f"""SELECT series, pos, week_ending, {r('idx', 4)} AS observed, {r('trend', 2)} AS trend,
              {r('seasonal', 2)} AS seasonal, {r('idx - trend - seasonal', 2)} AS residual FROM parts""",
        ),
    }


def oracle_sql() -> dict[str, str]:
    pack, etl = _pack(), _etl()
    etl["snk_bucketed_rolling"] = etl["tr_rolling"]
    return {**etl, **_long_series(), **pack, "report_sql": pack["report_region"], **_stats(), **_forecasts(), **_segments(), **_views()}
