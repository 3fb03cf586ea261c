"""Batch jobs: load the source tables, write every result, export the reports.

This is the only module that writes. A result that others build on is written once
and read back, so a lost executor or a rerun never repeats the joins above it.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tavola.functions.filters import completed
from tavola.functions.lines import LINE_COLUMNS, ORDER_COLUMNS, completed_lines
from tavola.operators import (
    anomalies,
    baskets,
    channels,
    classifier,
    customers,
    demand,
    inventory,
    kpis,
    locations,
    pricing,
    profit,
    promotions,
    quality,
    ratings,
    recommend,
    sales_cube,
    segments,
    wastage,
)
from tavola.sources.bucketed import BucketedPair
from tavola.sources.schemas import TABLES
from tavola.sources.tables import (
    export_csv_report,
    read_restaurants,
    read_table,
    read_wastage_share,
    save_model,
    write_metrics,
    write_partitioned_orders,
    write_table,
)

# Result folder -> report file, the set of reports handed to the business.
REPORTS = {
    "menu_classified": "menu_performance_report",
    "customer_segments": "customer_segments_report",
    "wastage_risk": "wastage_report",
    "recommendations": "recommendations_report",
    "sales_anomalies": "anomalies_report",
    "association_rules": "association_rules",
    "location_analysis": "location_report",
}

BASKET_SUPPORT, BASKET_CONFIDENCE = 0.01, 0.3
RULE_SUPPORT, RULE_CONFIDENCE = 0.005, 0.2


class Workspace:
    """The folders a run reads tables from and writes results to."""

    def __init__(self, spark: SparkSession, tables: str, results: str):
        self.spark = spark
        self.tables = tables.rstrip("/")
        self.results = results.rstrip("/")

    def table(self, name: str) -> DataFrame:
        found = read_table(self.spark, name, f"{self.tables}/{name}", "parquet")
        if found is None:
            raise FileNotFoundError(f"{self.tables}/{name}")
        return found

    def lines(self) -> DataFrame:
        return self.spark.read.parquet(self.path("completed_lines"))

    def cube(self) -> tuple[DataFrame, DataFrame]:
        return tuple(self.spark.read.parquet(self.path(n)) for n in ("sales_cube", "customer_bitmaps"))

    def path(self, name: str) -> str:
        return f"{self.results}/{name}"

    def save(self, name: str, df: DataFrame) -> DataFrame:
        write_table(df, self.path(name))
        return self.spark.read.parquet(self.path(name))

    def note(self, name: str, df: DataFrame) -> None:
        write_metrics(df, self.path(f"metrics/{name}"))


def _bucketed(spark: SparkSession, tables: str, buckets: int) -> BucketedPair:
    return BucketedPair(spark, f"{tables.rstrip('/')}/lines_and_orders", "order_id", buckets)


def ingest(spark: SparkSession, raw: str, tables: str, buckets: int = 0) -> list[str]:
    """Store every CSV table that exists as Parquet; returns the names found.

    With ``buckets``, lines and completed orders are also stored in that many buckets of the
    order id, and every later join of them goes without a shuffle.
    """
    found = []
    for name in TABLES:
        table = read_table(spark, name, f"{raw}/{name}.csv")
        if table is not None:
            write_table(table, f"{tables}/{name}")
            found.append(name)
    if buckets and {"orders", "order_items"} <= set(found):
        orders, items = (read_table(spark, n, f"{tables}/{n}", "parquet") for n in ("orders", "order_items"))
        _bucketed(spark, tables, buckets).store(
            items.select("order_id", *LINE_COLUMNS), completed(orders).select("order_id", *ORDER_COLUMNS)
        )
    return found


def quality_job(w: Workspace, raw: str | None = None) -> None:
    checked = ("orders", "order_items", "menu_items", "customers", "ratings", "wastage")
    for name in checked:
        w.note(f"null_profile/{name}", quality.null_profile(w.table(name)))
    stored = f"{w.tables}/restaurants"
    restaurants = read_restaurants(w.spark, stored, f"{raw or w.tables}/restaurants.csv")
    if restaurants is None:
        raise FileNotFoundError(stored)
    orders, items = w.table("orders"), w.table("order_items")
    keys = {
        "orders": (orders, "order_id"),
        "customers": (w.table("customers"), "customer_id"),
        "menu_items": (w.table("menu_items"), "item_id"),
    }
    w.note("duplicate_keys", quality.duplicate_keys(keys))
    report = quality.quality_report(
        orders,
        items,
        w.table("menu_items"),
        w.table("customers"),
        w.table("ratings"),
        w.table("wastage"),
        restaurants,
    )
    w.note("quality_report", report)
    w.save("orders_cleaned", quality.clean_orders(orders))
    w.note("cleaning_log", quality.cleaning_log(orders))
    write_partitioned_orders(orders, w.path("orders_partitioned"))


def lines_job(w: Workspace, buckets: int = 0) -> None:
    """Join lines and completed orders once, for all the results that need both."""
    if buckets:
        lines = _bucketed(w.spark, w.tables, buckets).joined(list(LINE_COLUMNS), list(ORDER_COLUMNS))
    else:
        lines = completed_lines(w.table("order_items"), w.table("orders"))
    w.save("completed_lines", lines)


def cube_job(w: Workspace) -> None:
    """Read the orders for the cube and for the visits of customers; all results that sum or
    count orders read those."""
    orders = w.table("orders")
    w.save("sales_cube", sales_cube.sales_cube(orders))
    visited = w.save("visits", sales_cube.visits(orders))
    numbers = w.save("customer_numbers", sales_cube.dense_numbers(visited, "customer_id"))
    w.save("customer_bitmaps", sales_cube.customer_bitmaps(visited, numbers))


def menu_job(w: Workspace) -> None:
    items, menu, lines = w.table("order_items"), w.table("menu_items"), w.lines()
    profitability = w.save("menu_profitability", profit.menu_profitability_of(lines, menu))
    classified = w.save("menu_classified", profit.classify_quadrant(profitability))
    w.note("class_summary", profit.class_summary(classified))
    w.save("location_menu", profit.location_menu_of(lines))
    w.save("location_menu_classified", profit.location_menu_classified_of(lines, menu))
    volume = w.save("item_volume", inventory.item_volume(items))
    w.note("top_sellers", inventory.top_sellers_of(volume))
    w.note("low_sellers", inventory.low_sellers_of(volume))
    w.save("slow_moving_threshold", inventory.slow_moving_threshold_of(volume, menu))
    w.save("slow_moving_items", inventory.slow_moving_bottom_k_of(volume, menu))
    advice = inventory.inventory_recommendations(w.table("inventory"))
    w.save("inventory_recommendations", advice)


def operations_job(w: Workspace) -> None:
    items, menu = w.table("order_items"), w.table("menu_items")
    wasted, lines = w.table("wastage"), w.lines()
    cube, bitmaps = w.cube()
    takings = sales_cube.location_takings_of(cube, bitmaps)
    w.save("location_analysis", locations.compare_takings(takings, lines, menu, wasted))
    w.save("channel_analysis", sales_cube.channel_analysis_of(cube, bitmaps))
    w.save("channel_detailed", channels.channel_detailed_of(lines))
    w.save("channel_top_items", channels.channel_item_qty_of(lines))
    by_period: dict[str, Callable[[DataFrame], DataFrame]] = {
        "peak_hours": sales_cube.peak_hours_of,
        "peak_days": sales_cube.peak_days_of,
        "weekend_analysis": sales_cube.weekend_analysis_of,
        "monthly_analysis": sales_cube.monthly_analysis_of,
        "seasonal_analysis": sales_cube.seasonal_analysis_of,
    }
    for name, analyse in by_period.items():
        w.save(name, analyse(cube))
    w.save("wastage_analysis", wastage.wastage_by_item_of(wasted, menu, lines))
    w.save("wastage_risk", wastage.wastage_risk(wasted, items))
    w.save("wastage_by_location", wastage.wastage_by_location(wasted))
    w.save("wastage_by_category", wastage.wastage_by_category(wasted, menu))
    w.save("wastage_by_day", wastage.wastage_by_day(wasted))
    w.save("wastage_by_reason", wastage.wastage_by_reason(wasted))


def market_job(w: Workspace) -> None:
    """Ratings, promotions, prices and anomalies; needs ``menu_classified``."""
    items, orders, menu = w.table("order_items"), w.table("orders"), w.table("menu_items")
    scores, promos, lines = w.table("ratings"), w.table("promotions"), w.lines()
    classified = w.spark.read.parquet(w.path("menu_classified"))
    w.save("rating_analysis", ratings.rating_analysis(scores))
    w.save("rating_by_location", ratings.rating_by_location(scores, orders))
    w.save("rating_vs_profit", ratings.rating_vs_profit(scores, classified))
    w.save("rating_by_promotion", ratings.rating_by_promotion(scores, promos))
    w.note("best_rated", ratings.best_rated(scores))
    w.note("worst_rated", ratings.worst_rated(scores))
    w.save("rating_anomalies", anomalies.rating_anomalies(scores))
    performance = w.save(
        "promotion_performance", promotions.promotion_performance_of(lines, menu, promos)
    )
    w.save(
        "nonpromoted_performance", promotions.nonpromoted_performance_of(lines, menu, promos)
    )
    w.save("promo_traps", promotions.promo_traps(performance))
    w.save("promotion_dependency", promotions.promotion_dependency(items, promos))
    sensitivity = w.save(
        "price_sensitivity", pricing.price_sensitivity(items, w.table("pricing_history"))
    )
    w.note("sensitivity_summary", pricing.sensitivity_summary(sensitivity))
    w.save("sales_anomalies", anomalies.sales_anomalies(orders))


def customer_job(w: Workspace) -> None:
    orders, menu, lines = w.table("orders"), w.table("menu_items"), w.lines()
    churn = w.save("churn_risk", customers.churn_risk(orders))
    diversity = customers.category_diversity_of(lines, menu)
    w.save("churn_enhanced", customers.churn_enhanced(churn, diversity))
    w.save("repeat_purchase_rate", customers.repeat_purchase_rate_of(lines))
    ratio = w.save("weekend_ratio", customers.weekend_ratio_of(lines))
    w.save("weekend_only_items", customers.weekend_only_items(ratio))
    w.save("basket_size", customers.basket_size_of(lines))
    _, scored = segments.fit_segments(customers.rfm(orders))
    w.note("segment_quality", segments.silhouette(scored))
    labelled = w.save("customer_segments", segments.label_segments(scored.drop("features")))
    w.note("segment_summary", segments.segment_summary(labelled))
    w.save("customer_targeting", segments.customer_targeting(labelled))
    paid = w.save("paid_segments", segments.label_segments(segments.kmeans_segments(customers.rfm_elapsed(orders))))
    w.note("segment_agreement", customers.segment_agreement(labelled, paid))
    w.note("segment_matching", customers.matched_agreement(labelled, paid))


def basket_job(w: Workspace) -> None:
    done = w.save("completed_baskets", baskets.baskets_of(w.lines()))
    rules = baskets.association_rules(done, BASKET_SUPPORT, BASKET_CONFIDENCE)
    w.save("basket_rules", rules)
    sold = w.save("baskets", baskets.baskets(w.table("order_items")))
    model = baskets.fit_itemsets(sold, RULE_SUPPORT, RULE_CONFIDENCE)
    w.save("frequent_itemsets", baskets.itemsets_of(model))
    w.save("association_rules", baskets.rules_of(model))
    w.save("bundle_recommendations", baskets.bundle_pairs(sold))


def forecast_job(w: Workspace) -> None:
    daily = w.save("daily_demand", demand.daily_demand_of(w.lines()))
    models, predictions = demand.train_forecast(demand.demand_features(daily))
    w.note("forecast_models", demand.forecast_metrics(predictions))
    _, best = demand.best_forecast(models, predictions)
    save_model(best, w.path("models/demand_forecast"))
    by_month = demand.forecast_day_of_month(demand.demand_features_dom(daily))
    stored = w.save("demand_predictions", by_month)
    w.note("forecast_metrics", demand.forecast_error(stored))


def advice_job(w: Workspace) -> None:
    """Recommendations, odd cases, the classifier and the headline figures."""
    classified = w.spark.read.parquet(w.path("menu_classified"))
    share = read_wastage_share(w.spark, w.path("wastage_analysis"), w.path("wastage_risk"))
    advice = w.save("recommendations", recommend.recommend(classified, share))
    w.note("recommendation_counts", recommend.recommendation_counts(advice))
    w.note("tricky_cases", recommend.tricky_cases(classified, w.table("ratings")))
    models, comparison = classifier.train_menu_classifier(classified)
    w.note("model_comparison", comparison)
    w.note("model_version", classifier.model_version(comparison))
    best = comparison.filter("best").first()["model"]
    save_model(models[best], w.path("models/menu_classifier"))
    totals = sales_cube.paid_totals_of(*w.cube())
    figures = kpis.master_kpis_of(totals, w.table("menu_items"), w.table("wastage"), w.table("ratings"))
    w.note("master_kpis", figures)


def export_reports(w: Workspace, reports: str) -> list[str]:
    """Write the business reports as CSV; a result that was not built is left out."""
    written = []
    for name, report in REPORTS.items():
        result = read_table(w.spark, name, w.path(name), "parquet")
        if result is not None:
            export_csv_report(result, f"{reports}/{report}")
            written.append(report)
    return written


def run_all(
    spark: SparkSession, raw: str, tables: str, results: str, reports: str, buckets: int = 0
) -> None:
    ingest(spark, raw, tables, buckets)
    w = Workspace(spark, tables, results)
    quality_job(w, raw)
    lines_job(w, buckets)
    cube_job(w)
    menu_job(w)
    operations_job(w)
    market_job(w)
    customer_job(w)
    basket_job(w)
    forecast_job(w)
    advice_job(w)
    export_reports(w, reports)


def main() -> None:
    parser = argparse.ArgumentParser(description="Run all menu analytics jobs.")
    for folder in ("raw", "tables", "results", "reports"):
        parser.add_argument(f"--{folder}", required=True, help=f"{folder} folder or URL")
    parser.add_argument("--buckets", type=int, default=0, help="buckets of lines and orders; 0 for none")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("tavola").getOrCreate()
    run_all(spark, args.raw, args.tables, args.results, args.reports, args.buckets)
    spark.stop()


if __name__ == "__main__":
    main()
