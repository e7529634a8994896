"""From raw wide files to a cleaned, enriched panel and its exports."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import REGION_LABELS, SITE_LABELS, dim_series, labels
from ..functions.numeric import rnd
from ..operators import quality, stats, transform
from ..operators.clean import clean_feed, to_number, typed, week_texts
from ..sources.readers import INGEST_ORDER, read_pair
from ..sources.scratch import stored as scratch
from ..sources.writers import save, save_log, save_panel


@dataclass
class Cleaned:
    """Result of one input: its raw long feed, its week texts, the clean panel and the series in file order.

    ``intake`` was observed while the feed was written, ``written`` is observed while the panel is; the panel's column
    ``_filled`` is for that only."""

    feed: DataFrame
    texts: DataFrame
    panel: DataFrame
    series: list[str]
    intake: Observation
    written: Observation
    dense: bool

    def save(self, path: str, mode: str) -> DataFrame:
        """Write the panel; returns it as stored."""
        metrics = [F.count(F.lit(1)).alias("rows_final"), F.count_if("_filled").alias("nulls_filled")]
        save_panel(self.panel, path, mode, (self.written, metrics), ["_filled"])
        schema = self.panel.drop("_filled").schema
        return self.panel.sparkSession.read.schema(schema).parquet(path).select("series", "week_ending", "idx")

    def counters(self) -> DataFrame:
        """The counters of ``quality.etl_stats`` from what was observed, without a scan of feed or panel."""
        if self.dense:
            return quality.etl_stats(typed(self.feed, self.texts), True)
        readable = self.texts.where("week_ending is not null").agg(F.sum("n")).first()[0] or 0
        seen = {**self.intake.get, **self.written.get}
        seen["duplicates_removed"] = readable - seen["rows_final"]
        names = ["rows_raw", "rows_final", "nulls_filled", "anomalies_flagged", "duplicates_removed"]
        row = tuple(seen[c] for c in names)
        return self.feed.sparkSession.createDataFrame([row], ", ".join(f"{c} bigint" for c in names))


def to_feed(wide: DataFrame, week: str = "week_ending") -> tuple[DataFrame, list[str]]:
    """Raw wide rows to the long feed the checks and the cleaning work on."""
    series = [c for c in wide.columns if c != week and c not in INGEST_ORDER]
    rows = wide.select(
        F.col(week).alias("week_raw"), F.struct(*INGEST_ORDER).alias("ingest_seq"), *series
    )
    return rows.unpivot(["week_raw", "ingest_seq"], series, "series", "value_raw"), series


def clean_wide(wide: DataFrame, fill_weeks: bool = False) -> Cleaned:
    """Clean one raw input. Weeks no row has are added only with ``fill_weeks``. The long feed is stored, so
    that cleaning, log and counters read the raw file once; rows and flagged values are counted on the way."""
    feed, series = to_feed(wide)
    intake, value = Observation(), to_number("value_raw")
    flagged = (value < quality.INDEX_MIN) | (value > quality.INDEX_MAX)
    feed = scratch(
        feed.observe(intake, F.count(F.lit(1)).alias("rows_raw"), F.count_if(flagged).alias("anomalies_flagged")), "feed"
    )
    texts = week_texts(feed)
    filled = clean_feed(typed(feed, texts), fill_weeks)
    new = F.col("value").isNull() & F.col("value_filled").isNotNull()
    panel = filled.select("series", "week_ending", F.col("value_filled").alias("idx"), new.alias("_filled"))
    return Cleaned(feed, texts, panel, series, intake, Observation(), fill_weeks)


def enrich(panel: DataFrame, total: str | None = None) -> DataFrame:
    """Calendar, flag, trailing means; year-on-year and difference to the total if one is named."""
    out = transform.fact(panel)
    if total is None:
        return out
    lookup = transform.total_by_week(panel, total)
    out = transform.yoy_rows(out).join(
        lookup, F.col("week_ending") == F.col("_week"), "left"
    )
    gap = F.when(F.col("series") != total, rnd(F.col("idx") - F.col("total_idx"), 2))
    return out.withColumn("vs_total", gap).drop("_week", "total_idx")


def wide_export(enriched: DataFrame, series: list[str]) -> DataFrame:
    """One row per week with, for each series, its value and derived columns."""
    ids = ["week_ending", "year", "month", "week_number", "quarter", "season", "is_holiday_week"]
    derived = ["above_baseline", "vs_total", "rolling_4w", "rolling_12w", "yoy"]
    extra = [c for c in derived if c in enriched.columns]
    wide = (
        enriched.groupBy(*ids)
        .pivot("series", series)
        .agg(F.first("idx").alias("idx"), *[F.first(c).alias(c) for c in extra])
    )
    return wide.withColumnsRenamed({f"{s}_idx": s for s in series})


def long_export(enriched: DataFrame, dim: DataFrame) -> DataFrame:
    """Tidy rows with label and flag."""
    cols = ["week_ending", "year", "month", "week_number", "quarter", "season", "is_holiday_week"]
    return labels(enriched, dim).select(*cols, "series", "idx", "label", "above_baseline")


def run_etl(
    spark: SparkSession,
    region_path: str,
    out: str,
    site_path: str | None = None,
    total: str = "UK_total",
    region_labels: Mapping[str, str] = REGION_LABELS,
    fmt: str = "csv",
    mode: str = "errorifexists",
    generated_at: str | None = None,
    data_source: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Load, validate, clean, enrich and export; returns the stored region and site panels.

    The raw files are read once; the clean panels are written first and the exports read them back.
    ``generated_at`` and ``data_source`` are the caller's texts for the summary's header."""
    raw_region, raw_site = read_pair(spark, region_path, site_path)
    region = clean_wide(raw_region)
    site = clean_wide(raw_site) if raw_site is not None else None

    panel = region.save(f"{out}/panel", mode)
    site_panel = site.save(f"{out}/site_panel", mode) if site is not None else None

    named = total if total in region.series else None
    rich = enrich(panel, named)
    save(wide_export(rich, region.series), f"{out}/cleaned_wide", fmt, mode)
    save(long_export(rich, dim_series(spark, dict(region_labels))), f"{out}/cleaned_long", fmt, mode)
    if site_panel is not None:
        save(wide_export(enrich(site_panel), site.series), f"{out}/cleaned_sites", fmt, mode)
    save_log(quality.dq_log(typed(region.feed, region.texts)), f"{out}/validation_log", mode)
    document = summary_document(
        region.feed, panel, site_panel, region_labels, generated_at, data_source, region.counters()
    )
    save(document, f"{out}/summary", "json", mode)
    return panel, site_panel


def summary_document(
    feed: DataFrame,
    panel: DataFrame,
    site: DataFrame | None = None,
    region_labels: Mapping[str, str] = REGION_LABELS,
    generated_at: str | None = None,
    data_source: str | None = None,
    counters: DataFrame | None = None,
) -> DataFrame:
    """The summary as JSON rows: one header with coverage and run counters, then one row per series. Without
    ``counters`` they are counted from the feed.
    Rows instead of one nested document keep it writable for any number of series."""
    spark = panel.sparkSession
    cover = F.struct("start", "end", "weeks", "n_series").alias("coverage")
    if counters is None:
        counters = quality.etl_stats(feed, fill_weeks=False)
    packed = counters.select(F.struct(*counters.columns)).scalar()
    head = stats.coverage(panel).select(
        F.lit("header").alias("kind"), cover, packed.alias("pipeline_stats"),
        F.lit(generated_at).cast("string").alias("generated_at"),
        F.lit(data_source).cast("string").alias("data_source"),
    )
    rows = labels(
        stats.summary(panel, site), dim_series(spark, {**region_labels, **SITE_LABELS})
    ).withColumn("label", F.col("label_or_key"))
    return head.unionByName(rows.drop("label_or_key"), allowMissingColumns=True)
