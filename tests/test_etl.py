"""From raw CSV to stored panels, exports and reports."""

import json
from pathlib import Path

import pytest
from weekloom.functions.labels import REGION_LABELS
from weekloom.operators import clean, quality, sqlpack, transform
from weekloom.plans.etl import clean_wide, run_etl, summary_document, to_feed
from weekloom.plans.reports import write_reports
from weekloom.sources.readers import read_wide

from .frames import by, weeks
from .plans import rows_read

NAMES = ["UK_total", "London", "Wales", "Scotland", "England", "North_East"]


def raw_csv(path: Path, names: list[str], n: int = 60) -> None:
    days = weeks("2024-07-07", n)
    lines = ["week_ending," + ",".join(names)]
    for i, d in enumerate(days):
        week = str((d - weeks("1899-12-30", 1)[0]).days) if i == 5 else d.isoformat()
        values = [f"{100 + (i * (3 + 2 * j)) % (17 + j) - j:.1f}" for j in range(len(names))]
        if i == 8:
            values[1] = ""
        if i == 9 and len(names) > 2:
            values[2] = "n/a"
        lines.append(",".join([week, *values]))
    lines.append(lines[3].replace(",", ",9", 1))  # a later copy of the third week with another value
    lines.append("unknown," + ",".join(["100"] * len(names)))
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("etl")
    raw_csv(base / "region.csv", NAMES)
    raw_csv(base / "site.csv", ["Retail_Parks", "Town_and_City_Centres"])
    out = str(base / "out")
    panel, site = run_etl(spark, str(base / "region.csv"), out, str(base / "site.csv"))
    return base, out, panel, site


def test_panels(run):
    _, _, panel, site = run
    assert panel.count() == 60 * len(NAMES) and site.count() == 120
    assert panel.where("idx is null").count() == 0
    got = by(panel.where("series = 'UK_total'"), "week_ending")
    assert got[weeks("2024-07-07", 3)[2]]["idx"] == 106.0  # the first copy
    gap = by(panel.where("series = 'London'"), "week_ending")
    d = weeks("2024-07-07", 10)
    assert gap[d[8]]["idx"] == pytest.approx((gap[d[7]]["idx"] + gap[d[9]]["idx"]) / 2)


def test_wide_export(spark, run):
    _, out, _, _ = run
    wide = spark.read.option("header", True).csv(f"{out}/cleaned_wide")
    assert wide.count() == 60
    for c in ("London", "London_above_baseline", "London_vs_total", "London_rolling_4w", "London_yoy"):
        assert c in wide.columns
    assert wide.where("UK_total_vs_total is not null").count() == 0
    assert wide.where("London_yoy is not null").count() == 8


def test_long_export_and_layout(spark, run):
    _, out, panel, _ = run
    long = spark.read.option("header", True).csv(f"{out}/cleaned_long")
    assert long.count() == panel.count()
    assert {r["label"] for r in long.select("label").distinct().collect()} == {REGION_LABELS[n] for n in NAMES}
    assert sorted(p.name for p in Path(out, "panel").glob("year=*")) == ["year=2024", "year=2025"]


def test_log_and_summary(spark, run):
    _, out, _, _ = run
    log = [r["value"] for r in spark.read.text(f"{out}/validation_log").collect()]
    assert any(line.startswith("duplicate | UK_total | repeated weeks | 1") for line in log)
    assert any(line.startswith("type | Wales") for line in log)
    rows = [json.loads(r["value"]) for r in spark.read.text(f"{out}/summary").collect()]
    head = next(r for r in rows if r["kind"] == "header")
    assert head["coverage"] == {"start": "2024-07-07", "end": "2025-08-24", "weeks": 60, "n_series": 6}
    stats = head["pipeline_stats"]
    assert stats["rows_final"] == 360 and stats["nulls_filled"] == 2 and stats["duplicates_removed"] == 6
    assert {r["label"] for r in rows if r["kind"] == "site_type"} == {"Retail Parks", "Town & City Centres"}


def test_feed_keeps_file_order(spark, run):
    base, *_ = run
    feed, series = to_feed(read_wide(spark, str(base / "region.csv")))
    assert series == NAMES
    rows = feed.where("series = 'Wales'").orderBy("ingest_seq").collect()
    assert len(rows) == 62 and rows[0]["week_raw"] == "2024-07-07" and rows[-1]["week_raw"] == "unknown"


def test_reports(spark, run):
    base, _, panel, site = run
    out = str(base / "reports")
    write_reports(panel, out, site, premium="London")
    written = {p.name for p in Path(out).iterdir()}
    assert {
        "descriptive_stats", "trend_analysis", "seasonal_components", "correlation_matrix", "anomalies",
        "site_type_comparison", "regional_rankings", "forecasts", "clusters", "pca_coords", "executive_summary",
    } <= written
    forecasts = spark.read.option("header", True).csv(f"{out}/forecasts")
    assert forecasts.count() == 8 * len(NAMES)
    text = [r["value"] for r in spark.read.text(f"{out}/executive_summary").collect()]
    assert "Coverage from 2024-07-07" in text and any(t.startswith("Recommendation 5") for t in text)
    assert any(t.startswith("London premium over the total: ") for t in text)


def test_report_pack_on_a_stored_panel(spark, run):
    """The report pack and free SQL run on the stored panel as well as on one built from lines."""
    _, _, panel, _ = run
    fact = sqlpack.register(transform.fact(panel), "weekly_fact")
    board = by(sqlpack.dashboard(fact), "series")
    assert sorted(board) == sorted(NAMES)
    last = by(sqlpack.latest(fact), "series")
    assert {r["week_ending"] for r in last.values()} == {weeks("2024-07-07", 60)[-1]}
    sqlpack.summary_view(fact, "newest")
    assert spark.sql("select count(*) n from newest where current_rank >= 1").collect()[0]["n"] == 6
    means = spark.sql(
        "select series, avg(idx) m from weekly_fact where season = :season group by series",
        args={"season": "Summer"},
    )
    report = sqlpack.series_report(fact, "London").collect()[0]
    assert report["summer_avg"] == pytest.approx(by(means, "series")["London"]["m"], abs=0.006)


def test_raw_file_is_read_once(spark, tmp_path):
    """Everything after loading works from the stored feed, even if the raw file has changed since."""
    raw_csv(tmp_path / "region.csv", NAMES)
    part = clean_wide(read_wide(spark, str(tmp_path / "region.csv")))
    (tmp_path / "region.csv").write_text("week_ending,x\n")
    assert part.panel.count() == 60 * len(NAMES)
    assert quality.dq_log(part.feed).count() > 0
    assert quality.etl_stats(part.feed, fill_weeks=False).first()["rows_raw"] == 62 * len(NAMES)


def test_summary_header_has_the_callers_facts(spark, run):
    _, _, panel, _ = run
    feed = spark.createDataFrame([("a", "2024-07-07", "1", 0)], "series string, week_raw string, value_raw string, ingest_seq int")
    head = summary_document(feed, panel, generated_at="2024-07-08", data_source="a.csv").where("kind = 'header'").first()
    assert (head["generated_at"], head["data_source"]) == ("2024-07-08", "a.csv")


@pytest.mark.parametrize("dense", [False, True])
def test_counters_are_observed(spark, tmp_path, dense):
    """Counters of a run equal those of a scan; a run without new weeks reads the feed no more often for them."""
    raw_csv(tmp_path / "region.csv", NAMES)
    part = clean_wide(read_wide(spark, str(tmp_path / "region.csv")), dense)
    part.save(str(tmp_path / "panel"), "errorifexists")
    before = rows_read(spark)
    got = part.counters().first().asDict()
    assert dense or rows_read(spark) - before <= part.texts.count()
    assert got == quality.etl_stats(part.feed, dense).first().asDict()


def test_each_format_is_parsed_once(spark):
    """Distinct texts are parsed, every format once for each, whatever uses the dates."""
    feed = spark.createDataFrame([("s", "2024-07-07", "1", k) for k in range(40)], "series string, week_raw string, value_raw string, ingest_seq int")
    plan = feed.select(clean.parse_week("week_raw").alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == len(clean.DATE_FORMATS) + 1
    for f in (quality.date_gaps, quality.duplicates, quality.bad_dates, quality.dq_log, quality.etl_stats, clean.clean_feed):
        text = f(feed)._jdf.queryExecution().optimizedPlan().toString()
        assert not any(fmt in text for fmt in clean.DATE_FORMATS)
    assert clean.week_texts(feed).count() == 1
