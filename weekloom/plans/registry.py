"""All registered queries: name -> function of (session, folder of the source tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import calendar
from ..functions.labels import labels
from ..functions.numeric import position, rnd
from ..operators import alerts, clean, forecast, quality, segment, sqlpack, stats, transform, views
from ..sources import tables
from ..sources.feed import raw_feed
from ..sources.readers import load_stats, read_any, read_panel
from ..sources.scratch import scratch_path, stored
from ..sources.writers import save_bucketed, save_log, save_panel

Query = Callable[[SparkSession, str], DataFrame]
ONE_SERIES = "NATION_7"


def _panel(s: SparkSession, d: str) -> DataFrame:
    return tables.region_panel(s, d)


def _feed(s: SparkSession, d: str) -> DataFrame:
    return raw_feed(_panel(s, d))


def _stored_feed(s: SparkSession, d: str) -> DataFrame:
    """The feed as a table, for steps that look up its week texts."""
    return stored(_feed(s, d), "feed")


def _fact(s: SparkSession, d: str) -> DataFrame:
    return transform.fact(_panel(s, d))


def _clean(s: SparkSession, d: str) -> DataFrame:
    return clean.clean_panel(_panel(s, d))


def _site(s: SparkSession, d: str) -> DataFrame:
    return clean.clean_panel(tables.site_panel(s, d))


def _norm(s: SparkSession, d: str) -> DataFrame:
    return segment.normalise(segment.features(_clean(s, d)))


def _over(source: Query, f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: f(source(s, d))


def _nations(s: SparkSession, d: str) -> DataFrame:
    return tables.table(s, d, "nation").select(F.col("n_name").alias("series")).distinct()


def _src_dispatch(s: SparkSession, d: str) -> DataFrame:
    orders = read_any(s, f"{d}/orders.parquet")
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def _wide(s: SparkSession, d: str) -> DataFrame:
    # the names are the columns of the result, so the driver needs them for its schema
    names = sorted(r["series"] for r in _nations(s, d).collect())
    wide = transform.pivot_wide(tables.region_panel(s, d, total=False), names)
    return wide.select("week_ending", *[rnd(n, 4).alias(n) for n in names])


def _melt(s: SparkSession, d: str) -> DataFrame:
    long = transform.all_cells(tables.region_panel(s, d, total=False), _nations(s, d))
    return long.select("series", "week_ending", rnd("idx", 4).alias("idx"))


def _short(s: SparkSession, d: str) -> DataFrame:
    """Panel with every series cut into many of one to four weeks, by the last sign of its name; every second
    series of one week has no value."""
    size = F.ascii(F.right("series", F.lit(1))) % 4 + 1
    block = F.floor(F.col("pos") / F.col("size"))
    placed = _panel(s, d).select("series", "week_ending", "idx", position().alias("pos"), size.alias("size"))
    known = F.when((F.col("size") > 1) | (block % 2 == 0), F.col("idx"))
    return placed.select(F.concat_ws("#", "series", block).alias("series"), "week_ending", known.alias("idx"))


def _lines(s: SparkSession, d: str) -> DataFrame:
    return tables.line_series(s, d)


def _lines_filled(s: SparkSession, d: str) -> DataFrame:
    filled = clean.interpolate_ranged(_lines(s, d), tables.LINE_ORDER)
    return filled.select("series", "pos", "idx", rnd("idx_filled", 6).alias("idx_filled"))


def _panel_reload(s: SparkSession, d: str) -> DataFrame:
    """Panel written in its layout and read again."""
    path = scratch_path(s, "panel") + ".parquet"
    save_panel(_panel(s, d), path)
    back = read_panel(s, path)
    return back.select("series", "week_ending", rnd("idx", 4).alias("idx"))


def _bucketed_rolling(s: SparkSession, d: str) -> DataFrame:
    """Trailing means of a panel stored in buckets, which need no exchange."""
    path = scratch_path(s, "buckets")
    panel = save_bucketed(_clean(s, d), path, "panel_" + path[-32:])
    return transform.rolling(panel, 4, 12).drop("idx")


def _log_text(s: SparkSession, d: str) -> DataFrame:
    """Lines of the validation log as written."""
    path = scratch_path(s, "log-text")
    save_log(quality.dq_log(_stored_feed(s, d)), path)
    return s.read.text(path).select(F.col("value").alias("line"))


def _fact_view(s: SparkSession, d: str) -> DataFrame:
    """Free SQL over the stored union of both fact tables."""
    path = scratch_path(s, "fact")
    nation = tables.table(s, d, "nation")
    dim = nation.select(F.col("n_name").alias("series"), F.concat(F.lit("Nation of "), "n_name").alias("label"))
    site = transform.fact(tables.site_panel(s, d))
    save_panel(transform.fact_union(_fact(s, d), site, dim), path)
    s.read.parquet(path).createOrReplaceTempView("weekly_fact")
    return s.sql(
        """SELECT label, region IS NULL AS is_site, season, count(*) AS n,
             count_if(above_baseline) AS n_above, max(week_ending) AS newest
           FROM weekly_fact WHERE year >= 1994 GROUP BY label, region IS NULL, season"""
    )


def _silhouette_squared(s: SparkSession, d: str) -> DataFrame:
    labelled, ks = segment.fit_clusters(_norm(s, d))
    return segment.squared_silhouette(labelled, ks).select(
        F.col("k").cast("bigint").alias("k"), rnd("score", 6).alias("score")
    )


def _labels(s: SparkSession, d: str) -> DataFrame:
    nation, region = tables.table(s, d, "nation"), tables.table(s, d, "region")
    dim = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("series"), F.concat("n_name", F.lit(" / "), "r_name").alias("label")
    )
    per = _panel(s, d).groupBy("series").agg(F.count(F.lit(1)).alias("n_weeks"))
    return labels(per, dim)


def _report(s: SparkSession, d: str) -> DataFrame:
    panel = tables.region_panel(s, d, only=ONE_SERIES)
    return sqlpack.series_report(transform.fact(panel), ONE_SERIES)


def _report_sql(s: SparkSession, d: str) -> DataFrame:
    sqlpack.register_report(transform.fact(tables.region_panel(s, d, total=False)))
    return s.sql("SELECT * FROM series_report(wanted => :wanted)", args={"wanted": ONE_SERIES})


def _facts(s: SparkSession, d: str) -> DataFrame:
    return stats.report_facts(_clean(s, d), _site(s, d), premium=ONE_SERIES)


def _labels_per_k(s: SparkSession, d: str) -> DataFrame:
    labelled, ks = segment.fit_clusters(_norm(s, d))
    each = F.explode(
        F.array(*[F.struct(F.lit(k).cast("bigint").alias("k"), F.col(f"k{k}").alias("c")) for k in ks])
    )
    return labelled.select("series", each.alias("l")).select(
        "series", "l.k", F.col("l.c").cast("bigint").alias("cluster_id")
    )


def _silhouette(s: SparkSession, d: str) -> DataFrame:
    labelled, ks = segment.fit_clusters(_norm(s, d))
    return segment.silhouette(labelled, ks).select(
        F.col("k").cast("bigint").alias("k"), rnd("score", 6).alias("score")
    )


def _clusters(s: SparkSession, d: str) -> DataFrame:
    return segment.cluster(_norm(s, d), scores=segment.squared_silhouette)


def _forecast_chart(s: SparkSession, d: str) -> DataFrame:
    panel = _clean(s, d)
    return views.forecast_lines(panel, forecast.ensemble(panel))


def queries() -> dict[str, Query]:
    z = [segment.z(f) for f in segment.FEATURES]
    return {
        # sources and quality
        "src_dispatch": _src_dispatch,
        "etl_load_stats": lambda s, d: load_stats(read_any(s, f"{d}/lineitem.parquet")),
        "etl_wide_pivot": _wide,
        "etl_stats": _over(_stored_feed, quality.etl_stats),
        "dq_null_pct": _over(_feed, quality.null_pct),
        "dq_range": _over(_feed, quality.range_check),
        "dq_date_gaps": _over(_stored_feed, quality.date_gaps),
        "dq_duplicates": _over(_stored_feed, quality.duplicates),
        "dq_type_check": _over(_feed, quality.type_check),
        "dq_serial_dates": _over(_feed, quality.serial_dates),
        "dq_bad_dates": _over(_stored_feed, quality.bad_dates),
        "dq_log": _over(_stored_feed, quality.dq_log),
        # sinks, read again
        "snk_panel_reload": _panel_reload,
        "snk_bucketed_rolling": _bucketed_rolling,
        "snk_log_text": _log_text,
        "snk_fact_view": _fact_view,
        # cleaning
        "clean_dates": _over(
            _stored_feed, lambda f: clean.with_weeks(f).select("series", F.col("week_raw").alias("raw"), "week_ending")
        ),
        "clean_numeric": _over(
            _feed,
            lambda f: f.select("series", F.col("value_raw").alias("raw"), clean.to_number("value_raw").alias("value")),
        ),
        "clean_dedupe": _over(
            _stored_feed,
            lambda f: clean.dedupe_first(
                clean.typed(f)
                .where("week_ending is not null")
                .select("series", "week_ending", "value", "ingest_seq"),
                ["series", "week_ending"],
                ["ingest_seq"],
            ),
        ),
        "clean_interpolate": _over(
            _stored_feed,
            lambda f: clean.clean_feed(f).select(
                "series",
                "week_ending",
                rnd("value", 6).alias("value"),
                rnd("value_filled", 6).alias("value_filled"),
            ),
        ),
        "clean_interpolate_lines": _lines_filled,
        # derived columns
        "tr_calendar": _over(_panel, lambda p: calendar(p).drop("qty", "idx")),
        "tr_flags": _over(
            _panel,
            lambda p: transform.flags(p).select(
                "series", "week_ending", rnd("idx", 4).alias("idx"), "above_baseline"
            ),
        ),
        "tr_vs_total": _over(
            _clean, lambda p: transform.vs_total(p).select("series", "week_ending", "vs_total")
        ),
        "tr_rolling": _over(_clean, lambda p: transform.rolling(p, 4, 12).drop("idx")),
        "tr_rolling_lines": _over(
            _lines, lambda p: transform.rolling_ranged(p, tables.LINE_ORDER).select("pos", "idx", "rolling_4", "rolling_12")
        ),
        "tr_yoy_rows": _over(_clean, lambda p: transform.yoy_rows(p).drop("idx")),
        "tr_melt": _melt,
        "tr_labels": _labels,
        # report pack
        "q01_latest": _over(_fact, sqlpack.latest),
        "q02_ranking": _over(_fact, sqlpack.ranking),
        "q03_peak_trough": _over(_fact, sqlpack.peak_trough),
        "q04_mom": _over(_fact, sqlpack.month_on_month),
        "q05_yoy": _over(_fact, lambda f: sqlpack.year_on_year(f).orderBy("series", F.desc("current_week"))),
        "q06_rolling": _over(_fact, sqlpack.rolling_means),
        "q07_xmas": _over(_fact, sqlpack.peak_season),
        "q08_slump": _over(_fact, sqlpack.slump_season),
        "q09_vs_total": _over(_fact, sqlpack.against_total),
        "q10_site_winner": lambda s, d: sqlpack.site_winner(calendar(tables.site_panel(s, d))),
        "q11_consistent": _over(_fact, sqlpack.consistency),
        "q12_top5": _over(_fact, sqlpack.top_weeks),
        "q13_seasonal_index": _over(_fact, sqlpack.seasonal_profile),
        "q14_quarters": _over(_fact, sqlpack.quarters),
        "q15_dashboard": _over(_fact, sqlpack.dashboard),
        "v_summary": _over(_fact, lambda f: sqlpack.summary_view(f, "summary_view")),
        "report_region": _report,
        "report_sql": _report_sql,
        # statistics
        "an_descriptive": _over(_clean, stats.describe),
        "an_summary": lambda s, d: stats.summary(_clean(s, d), _site(s, d)),
        "an_coverage": _over(_clean, stats.coverage),
        "an_trend": _over(_clean, stats.trend),
        "an_trend_p": _over(_clean, stats.trend_p),
        "an_trend_short": _over(_short, stats.trend),
        "an_trend_p_short": _over(_short, stats.trend_p),
        "an_decompose": _over(_clean, stats.decompose),
        "an_decompose_lines": _over(_lines, lambda p: stats.decompose_ranged(p, tables.LINE_ORDER)),
        "an_season_summary": _over(_clean, stats.season_summary),
        "an_corr": _over(_clean, stats.correlation),
        "an_corr_extremes": _over(_clean, stats.corr_extremes),
        "an_anomalies": _over(_clean, stats.anomalies),
        "an_site_profile": _over(_site, stats.site_profile),
        "an_site_welch": _over(_site, stats.welch),
        "an_site_welch_p": _over(_site, stats.welch_p),
        "an_ranking": _over(_clean, stats.ranking),
        "an_report_facts": _facts,
        # forecasts
        "fc_seasonal_index": _over(_clean, forecast.seasonal_index),
        "fc_linear": _over(_clean, forecast.linear),
        "fc_linear_model": _over(_clean, forecast.linear_model),
        "fc_ewma": _over(_clean, forecast.ewma),
        "fc_ensemble": _over(_clean, forecast.ensemble),
        "fc_summary": _over(_clean, lambda p: forecast.forecast_summary(forecast.ensemble(p))),
        "fc_eval": _over(_clean, forecast.evaluate),
        # segments
        "sg_features": _over(_clean, segment.features),
        "sg_normalised": _over(_norm, lambda n: n.select("series", *[rnd(c, 6).alias(c) for c in z])),
        "sg_kmeans": _labels_per_k,
        "sg_silhouette": _silhouette,
        "sg_silhouette_squared": _silhouette_squared,
        "sg_clusters": _over(
            _clusters,
            lambda c: c.select("series", "cluster_id", "cluster_name", "mean_index", "current_index"),
        ),
        "sg_profiles": _over(_clusters, segment.profiles),
        "sg_pca": _over(_clusters, segment.pca),
        "sg_pca_variance": _over(_norm, lambda n: segment.pca_variance(stored(n, "points"))),
        # chart data and alerts
        "ch_month_heatmap": _over(_clean, views.month_heatmap),
        "ch_trends": _over(_clean, views.trends),
        "ch_site": _over(_site, views.site_lines),
        "ch_ranking": _over(_clean, lambda p: views.ranking_bars(stats.ranking(p))),
        "ch_corr_lower": _over(_clean, stats.correlation_lower),
        "ch_forecast": _forecast_chart,
        "ch_anomaly_picks": _over(_clean, lambda p: views.anomaly_picks(stats.anomalies(p))),
        "al_below_runs": _over(_clean, alerts.below_runs),
        "al_impact": _over(_fact, lambda f: alerts.impact(sqlpack.year_on_year(f))),
        "al_calendar": _over(_clean, lambda p: alerts.planning(forecast.ensemble(p))),
        "al_grades": _over(_clean, lambda p: alerts.grades(stats.ranking(p))),
    }
