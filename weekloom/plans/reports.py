"""The report tables written from stored panels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import forecast, segment, stats
from ..sources.writers import save, save_lines


def report_tables(
    panel: DataFrame, site: DataFrame | None = None, horizon: int = 8
) -> dict[str, DataFrame]:
    """Every report as a named DataFrame. Clusters are fitted at once, over points stored in the shared folder;
    nothing is written elsewhere."""
    clustered = segment.cluster(segment.normalise(segment.features(panel)))
    tables = {
        "descriptive_stats": stats.describe(panel),
        "trend_analysis": stats.trend(panel).join(stats.trend_p(panel), "series"),
        "seasonal_components": stats.decompose(panel),
        "correlation_matrix": stats.correlation(panel),
        "anomalies": stats.anomalies(panel),
        "regional_rankings": stats.ranking(panel),
        "forecasts": forecast.ensemble(panel, horizon),
        "model_evaluation": forecast.evaluate(panel),
        "clusters": clustered.select(
            "series", *segment.FEATURES, "yoy_change", "cluster_id", "cluster_name"
        ),
        "cluster_profiles": segment.profiles(clustered),
        "pca_coords": segment.pca(clustered),
    }
    if site is not None:
        tables["site_type_comparison"] = stats.site_profile(site)
        tables["site_type_tests"] = stats.welch(site).join(stats.welch_p(site), ["a", "b"])
    return tables


def write_reports(
    panel: DataFrame,
    out: str,
    site: DataFrame | None = None,
    total: str = "UK_total",
    premium: str | None = None,
    fmt: str = "csv",
    mode: str = "errorifexists",
) -> None:
    """Write all report tables and the management summary text."""
    for name, df in report_tables(panel, site).items():
        save(df, f"{out}/{name}", fmt, mode)
    facts = stats.report_facts(panel, site, total, premium)
    save_lines(stats.report_text(facts), f"{out}/executive_summary", mode=mode)
