"""Hand-made edge cases of parsing, cleaning, checks and the statistics."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from weekloom.functions.calendar import calendar, week_ending
from weekloom.functions.numeric import rnd
from weekloom.operators import alerts, clean, forecast, quality, segment, sqlpack, stats, transform
from weekloom.sources import readers, tables

from .frames import by, panel, weeks

RAW = "series string, week_raw string, value_raw string, ingest_seq bigint"


def feed(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_rounding_is_half_even_without_negative_zero(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.2,)], "x double")
    assert [str(r[0]) for r in df.select(rnd("x", 0)).collect()] == ["0.0", "2.0", "2.0", "0.0"]


def test_interpolation_reaches_both_edges(spark):
    df = panel(spark, s=[None, 1, None, 4, None])
    got = clean.interpolate(df, value="idx").orderBy("week_ending")
    assert [r["value_filled"] for r in got.collect()] == [1.0, 1.0, 2.5, 4.0, 4.0]


def test_interpolation_of_an_empty_series_stays_null(spark):
    got = clean.interpolate(panel(spark, s=[None, None]), value="idx").collect()
    assert [r["value_filled"] for r in got] == [None, None]


def test_densify_adds_inner_and_outer_weeks(spark):
    w = weeks("2023-01-01", 6)
    df = spark.createDataFrame(
        [("a", w[1], 1.0), ("a", w[3], 3.0), ("b", w[0], 5.0), ("b", w[5], 6.0)],
        "series string, week_ending date, qty double",
    ).withColumn("idx", F.col("qty"))
    got = by(clean.clean_panel(df), "series", "week_ending")
    assert [got["a", d]["idx"] for d in w] == [1.0, 1.0, 2.0, 3.0, 3.0, 3.0]
    assert [got["b", d]["idx"] for d in w] == pytest.approx([5.0, 5.2, 5.4, 5.6, 5.8, 6.0])


def test_dates_iso_serial_and_garbage(spark):
    df = feed(spark, [("s", t, "1", i) for i, t in enumerate(["2024-07-07", "45480", "45480.7", "garbage", ""])])
    got = [r["week_ending"] for r in clean.typed(df).orderBy("ingest_seq").collect()]
    assert got == [date(2024, 7, 7), date(2024, 7, 7), date(2024, 7, 7), None, None]


def test_dates_in_other_formats_and_absurd_numbers(spark):
    good = ["20240707", "2024/07/07", "7/7/2024", "07/07/2024", "7.7.2024", "7 Jul 2024", "Jul 7, 2024", "July 7, 2024"]
    bad = ["99999999", "2024", "5", "123456", "45480000", "99999-01-01", "1024-01-01", "77/77/2024"]
    df = feed(spark, [("s", t, "1", i) for i, t in enumerate(good + bad)])
    got = [r["week_ending"] for r in clean.typed(df).orderBy("ingest_seq").collect()]
    assert got == [date(2024, 7, 7)] * len(good) + [None] * len(bad)
    assert by(quality.bad_dates(df), "series")["s"]["n_bad_date"] == len(bad)
    assert not any(r["check"] == "serial_date" for r in quality.dq_log(df).collect())


def test_one_odd_date_does_not_widen_the_calendar(spark):
    rows = [("a", "2024-07-07", "1", 0), ("a", "20240721", "3", 1), ("b", "2024-07-14", "5", 2), ("b", "77777777", "6", 3)]
    got = by(clean.clean_feed(feed(spark, rows)), "series", "week_ending")
    assert len(got) == 6 and got["a", date(2024, 7, 14)]["value_filled"] == 2.0


def test_gap_without_a_whole_week_is_irregular(spark):
    rows = [("s", t, "1", i) for i, t in enumerate(["2024-07-07", "2024-07-18", "2024-08-01"])]
    got = by(quality.date_gaps(feed(spark, rows)), "from_week")
    assert got[date(2024, 7, 7)]["irregular"] and not got[date(2024, 7, 18)]["irregular"]


def test_trend_of_short_empty_constant_and_zero_base_series(spark):
    p = panel(spark, good=[1, 2, 3, 5], one=[4, None, None, None], two=[1, 3, None, None], none=[None] * 4, flat=[7] * 4)
    got = by(stats.trend(p).join(stats.trend_p(p), "series"), "series")
    value = lambda s: tuple(got[s][c] for c in ("slope", "r_squared", "std_error", "direction", "p_value"))
    assert value("none") == value("one") == (None,) * 5
    assert value("two") == (2.0, 1.0, 0.0, "STRONG_UP", None)
    assert value("flat") == (0.0, 0.0, 0.0, "FLAT", 1.0)
    assert got["good"]["direction"] == "STRONG_UP" and 0 < got["good"]["p_value"] < 0.1
    weekly = spark.createDataFrame(
        [("z", date(1996, 1, 7), 0.0), ("z", date(1997, 1, 5), 5.0), ("y", date(1996, 1, 7), 2.0)],
        "series string, week_ending date, qty double",
    )
    idx = {(r["series"], r["week_ending"].year): r["idx"] for r in tables.to_index(weekly).collect()}
    assert idx == {("z", 1996): None, ("z", 1997): None, ("y", 1996): 100.0}


def test_total_must_have_its_own_name(spark):
    weekly = spark.createDataFrame([("TOTAL", date(1996, 1, 7), 1.0)], "series string, week_ending date, qty double")
    with pytest.raises(Exception, match="TOTAL"):
        tables.with_total(weekly).collect()
    assert tables.with_total(weekly, "ALL").count() == 2


def test_numbers(spark):
    texts = ["1.5", " 2 ", "n/a", None, "NaN", "inf", ""]
    df = feed(spark, [("s", "2024-07-07", t, i) for i, t in enumerate(texts)])
    got = [r["value"] for r in clean.typed(df).orderBy("ingest_seq").collect()]
    assert got == [1.5, 2.0, None, None, None, None, None]


def test_first_copy_wins_across_date_formats(spark):
    raw = feed(spark, [("s", "45480", "7", 2), ("s", "2024-07-07", "5", 1), ("s", "2024-07-14", "9", 3)])
    got = by(clean.clean_feed(raw), "week_ending")
    assert got[date(2024, 7, 7)]["value_filled"] == 5.0
    assert by(quality.duplicates(raw), "series")["s"]["n_dup"] == 1


def test_date_gaps(spark):
    days = [0, 7, 16, 26, 40, 61]  # spacing 7, 9, 10, 14, 21
    start = date(2024, 1, 7)
    rows = [("s", str(date.fromordinal(start.toordinal() + d)), "1", d) for d in days]
    got = quality.date_gaps(feed(spark, rows)).orderBy("to_week").collect()
    assert [r["missing"] for r in got] == [0, 1, 2]
    log = quality.dq_log(feed(spark, rows)).where("check = 'gap'").collect()
    assert sorted(r["n"] for r in log) == [0, 1, 2]


def test_range_and_type_checks(spark):
    texts = ["49.9", "50", "200", "200.1", None, "x"]
    raw = feed(spark, [("s", f"2024-01-{7 + 7 * (i % 3):02d}", t, i) for i, t in enumerate(texts)])
    assert by(quality.range_check(raw), "series")["s"]["n_out"] == 2
    assert by(quality.type_check(raw), "series")["s"]["n_bad"] == 1
    assert by(quality.null_pct(raw), "series")["s"]["pct_null"] == pytest.approx(100 / 6, abs=1e-4)
    log = {r["check"]: r["n"] for r in quality.dq_log(raw).collect()}
    assert log == {"null": 1, "range": 2, "type": 1, "duplicate": 3}


def test_unreadable_dates_are_set_aside_and_logged(spark):
    raw = feed(spark, [("s", "soon", "1", 1), ("s", "2024-01-07", "2", 2)])
    assert by(quality.bad_dates(raw), "series")["s"]["n_bad_date"] == 1
    s = quality.etl_stats(raw).collect()[0]
    assert (s["rows_raw"], s["rows_final"], s["duplicates_removed"]) == (2, 1, 0)


def test_serial_column_needs_a_majority(spark):
    rows = [("a", "45480", "1", 1), ("a", "45487", "1", 2), ("a", "2024-07-21", "1", 3), ("b", "2024-07-07", "1", 1)]
    got = by(quality.serial_dates(feed(spark, rows)), "series")
    assert got["a"]["is_serial_column"] and not got["b"]["is_serial_column"]


def test_baseline_flag(spark):
    got = transform.flags(panel(spark, s=[100, 100.1, None])).orderBy("week_ending").collect()
    assert [r["above_baseline"] for r in got] == [False, True, False]


def test_calendar_edges(spark):
    days = [date(2024, 12, 29), date(2024, 12, 30), date(2021, 1, 3)]
    df = spark.createDataFrame([(d,) for d in days], "week_ending date")
    got = by(calendar(df), "week_ending")
    assert [got[d]["week_number"] for d in days] == [52, 1, 53]
    assert [got[d]["is_holiday_week"] for d in days] == [True, True, False]
    assert got[days[1]]["year"] == 2024 and got[days[1]]["season"] == "Winter"
    ends = df.select("week_ending", week_ending("week_ending").alias("e")).collect()
    assert {str(r["e"]) for r in ends} == {"2024-12-29", "2025-01-05", "2021-01-03"}


def test_constant_series_has_no_anomalies(spark):
    p = panel(spark, s=[100] * 10)
    assert stats.anomalies(p).count() == 0
    t = stats.trend(p).collect()[0]
    assert (t["slope"], t["r_squared"], t["direction"]) == (0.0, 0.0, "FLAT")


def test_nulls_are_never_anomalies(spark):
    p = panel(spark, s=[100, 101, 99, 100, 100, 101, 99, 100, None, 300])
    got = stats.anomalies(p).collect()
    assert [r["index"] for r in got] == [300.0]


def test_short_series_uses_a_smaller_centred_window(spark):
    values = [float(i * i % 17) for i in range(30)]  # window min(13, 30 // 3) = 10: rows -5 .. +4
    got = stats.decompose(panel(spark, s=values)).orderBy("week_ending").collect()
    want = [sum(values[max(0, i - 5): i + 5]) / len(values[max(0, i - 5): i + 5]) for i in range(30)]
    assert [r["trend"] for r in got] == pytest.approx(want, abs=0.006)


def test_trend_positions_keep_gaps(spark):
    t = stats.trend(panel(spark, s=[0, None, 2, None, 4])).collect()[0]
    assert (t["slope"], t["intercept"]) == (1.0, 0.0)


def test_ranking_without_december(spark):
    p = panel(spark, "2023-01-01", s=[100 + i % 5 for i in range(40)])
    assert stats.ranking(p).collect()[0]["peak"] == 50.0
    f = segment.features(p).collect()[0]
    assert f["christmas_peak"] == pytest.approx(102.0) and f["yoy_change"] == 0.0


def test_ranking_takes_other_weights(spark):
    p = panel(spark, a=[100, 101, 102], b=[100, 99, 98])
    only = dict.fromkeys(stats.WEIGHTS, 0.0) | {"current": 1.0}
    got = by(stats.ranking(p, only), "series")
    assert got["a"]["rank"] == 1 and got["a"]["composite"] == got["a"]["current"]


def test_forecast_slots_pass_year_end(spark):
    # last week is ISO week 52: steps use slots 0, 1, 2 ...; slot 0 has no values
    values = [100.0] * 51 + [150.0]
    p = panel(spark, "2023-01-08", s=values)
    slots = by(forecast.seasonal_index(p), "slot")
    assert slots[0]["seasonal"] == 0.0 and len(slots) == 53
    line = by(forecast.linear(p, h=2), "week_ahead")
    model = forecast.fit(p).collect()[0]
    step1 = model["level"]  # slot 0
    step2 = model["level"] + model["slope"] + 0.3 * (100 - model["mean"])  # slot 1
    assert line[1]["forecast"] == pytest.approx(step1, abs=0.006)
    assert line[2]["forecast"] == pytest.approx(step2, abs=0.006)


def test_ewma_equals_the_recurrence(spark):
    values = [100.0, 120.0, 90.0, 95.0, 130.0]
    level = values[0]
    for v in values[1:]:
        level = 0.3 * v + 0.7 * level
    assert forecast.ewma(panel(spark, s=values)).collect()[0]["last_ewma"] == pytest.approx(level, abs=0.006)


def test_evaluation_needs_enough_weeks_and_holds_out(spark):
    flat = [100.0] * 39
    p = panel(spark, enough=flat, short=flat[:38])
    got = forecast.evaluate(p).collect()
    assert {r["series"] for r in got} == {"enough"} and sum(r["best"] for r in got) == 1
    # the newest twelve values must not reach the fitted models
    jump = panel(spark, s=[100.0] * 40 + [200.0] * 12)
    errors = by(forecast.evaluate(jump), "model")
    assert errors["Exponential MA"]["mae"] == 100.0 and errors["Linear+Seasonal"]["rmse"] == 100.0


def test_bands_contain_the_forecast(spark):
    p = panel(spark, s=[100 + (i * 7) % 13 for i in range(80)])
    for df in (forecast.linear(p), forecast.ensemble(p)):
        assert df.where("lower_95 > forecast or forecast > upper_95").count() == 0


def test_year_on_year_by_date_and_by_row(spark):
    p = panel(spark, s=list(range(100, 160)))
    got = sqlpack.year_on_year(p).collect()
    assert len(got) == 8 and {r["yoy_change"] for r in got} == {52.0}
    gone = p.where("week_ending <> date'2023-01-08'")  # one prior week missing: one pair fewer
    assert sqlpack.year_on_year(gone).count() == 7
    assert transform.yoy_rows(p).where("yoy is not null").count() == 8


def test_first_month_counts_as_declining(spark):
    got = sqlpack.month_on_month(calendar(panel(spark, s=[100] * 5 + [110] * 4))).collect()
    assert [(r["mom_change"], r["direction"]) for r in got] == [(None, "Declining"), (10.0, "Improving")]


def test_missing_total_counts_as_underperforming(spark):
    p = panel(spark, a=[101, 102]).unionByName(panel(spark, TOTAL=[100]))
    got = by(sqlpack.against_total(p), "week_ending")
    assert [got[d]["relative_performance"] for d in weeks("2023-01-01", 2)] == ["Outperforming", "Underperforming"]


def test_peak_week_ties_take_the_earliest(spark):
    got = sqlpack.peak_trough(panel(spark, s=[None, 5, 9, 9, 1, 1])).collect()[0]
    d = weeks("2023-01-01", 6)
    assert (got["peak_week"], got["trough_week"]) == (d[2], d[4])


def test_below_runs(spark):
    p = panel(spark, red=[101] + [99] * 6, amber=[99] * 6 + [100], green=[99, 101, 101], now=[101, 99])
    got = by(alerts.below_runs(p), "series")
    assert {k: r["status"] for k, r in got.items()} == {
        "red": "red", "amber": "amber", "green": "green", "now": "amber",
    }
    assert (got["amber"]["longest_run"], got["amber"]["current_run"]) == (6, 0)


def test_melt_undoes_pivot(spark):
    p = panel(spark, a=[1, 2, 3], b=[4, 5, 6])
    back = transform.melt(transform.pivot_wide(p, ["a", "b"]), ["week_ending"], ["a", "b", "absent"])
    key = lambda df: sorted((r["series"], r["week_ending"], r["idx"]) for r in df.collect())
    assert key(back) == key(p)


def test_formats(spark, tmp_path):
    df = panel(spark, a=[1, 2])
    for fmt in ("csv", "json", "parquet", "orc"):
        path = str(tmp_path / f"t.{fmt}")
        df.write.option("header", True).format(fmt).save(path)
        assert readers.read_any(spark, path).count() == 2
    assert readers.read_panel(spark, str(tmp_path / "t.csv")).schema["idx"].dataType.typeName() == "double"
    assert readers.read_panel(spark, str(tmp_path / "absent.parquet")) is None
    with pytest.raises(ValueError, match="Unsupported file format"):
        readers.read_any(spark, "x.docx")
