"""The operators as named queries over the star-schema tables.

Thresholds that only fit the volumes of a restaurant chain are set here for the
volumes of the star schema; everything else is left at its default.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.functions.columns import band, cents
from tavola.functions.filters import filter_menu, filter_orders
from tavola.functions.fixed import HIDDEN_OPPORTUNITY, LOW_PERFORMER, PROFIT_DRIVER, VOLUME_DRIVER
from tavola.functions.lines import completed_lines
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
    periods,
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
from tavola.sources.star import StarTables

FILTER_FROM = date(1996, 1, 1)
FILTER_TO = date(1998, 12, 31)
FILTER_LOCATION = 7
FILTER_CHANNEL = "1-URGENT"
FILTER_CLASSES = (PROFIT_DRIVER, HIDDEN_OPPORTUNITY)
FILTER_CATEGORIES = ("ECONOMY", "SMALL")
PRICE_CHANGE = 10
TRAP_QTY, TRAP_MARGIN = 300, 0.45
SLOW_FRACTION = 0.7
ANOMALY_RATINGS, ANOMALY_STD = 3, 1.3
TRICKY = {
    "high_qty": 300,
    "low_qty": 180,
    "low_margin": 40,
    "high_margin": 60,
    "well_rated": 2.6,
    "badly_rated": 2.0,
}
RULE_SUPPORT, RULE_CONFIDENCE = 0.01, 0.3
VALUE_BANDS = ((900_000, "rich"), (400_000, "middle"))
VISIT_BANDS = ((4, "x"), (2, "y"))


def _classified(t: StarTables) -> DataFrame:
    return profit.menu_classified(t.order_items(), t.orders(), t.menu_items())


def _locations(t: StarTables) -> DataFrame:
    return locations.location_comparison(
        t.located_orders(), t.order_items(), t.menu_items(), t.located_wastage()
    )


def _wastage(t: StarTables) -> DataFrame:
    return wastage.wastage_by_item(t.wastage(), t.menu_items(), t.order_items(), t.orders())


def _recommended(t: StarTables) -> DataFrame:
    share = wastage.wastage_risk(t.wastage(), t.order_items()).withColumnRenamed(
        "waste_ratio", "wastage_pct"
    )
    return recommend.recommend(_classified(t), share)


def _promoted(t: StarTables) -> DataFrame:
    return promotions.promotion_performance(
        t.order_items(), t.orders(), t.menu_items(), t.promotions()
    )


def _sensitivity(t: StarTables) -> DataFrame:
    return pricing.price_sensitivity(t.order_items(), t.pricing_history())


def _churn(t: StarTables) -> DataFrame:
    return customers.churn_risk(t.orders())


def _diversity(t: StarTables) -> DataFrame:
    return customers.category_diversity(t.order_items(), t.orders(), t.menu_items())


def _dashboard_orders(t: StarTables) -> DataFrame:
    return filter_orders(t.orders(), FILTER_FROM, FILTER_TO)


def _basket_text(rows: DataFrame, *columns: str) -> DataFrame:
    """Arrays as text, so that any engine can compare them."""
    return rows.withColumns({c: F.array_join(c, ",") for c in columns})


def _category_baskets(t: StarTables) -> DataFrame:
    return baskets.baskets(baskets.category_lines(t.order_items(), t.menu_items()))


def _itemsets(t: StarTables) -> DataFrame:
    return baskets.frequent_itemsets(_category_baskets(t), RULE_SUPPORT)


def _rules(t: StarTables) -> DataFrame:
    return baskets.association_rules(_category_baskets(t), RULE_SUPPORT, RULE_CONFIDENCE)


def _six_digits(rules: DataFrame) -> DataFrame:
    return rules.withColumns({c: F.round(c, 6) for c in ("support", "confidence", "lift")})


def _baskets(t: StarTables) -> DataFrame:
    rows = baskets.baskets(t.order_items(), t.orders()).withColumn("size", F.size("items"))
    return rows.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


def _daily(t: StarTables) -> DataFrame:
    return demand.daily_demand(t.order_items(), t.orders())


def _labelled(t: StarTables) -> DataFrame:
    return segments.label_segments(segments.kmeans_segments(customers.rfm(t.orders())))


def _above_average(rfm: DataFrame, measure: str) -> DataFrame:
    average = rfm.agg(F.sum(cents(measure)) / F.count(measure)).scalar()
    label = F.when(cents(measure) >= average, "High").otherwise("Low")
    return rfm.select("customer_id", label.alias("segment"))


def _agreement(t: StarTables) -> DataFrame:
    rfm = customers.rfm(t.orders())
    return customers.segment_agreement(
        _above_average(rfm, "monetary"), _above_average(rfm, "frequency")
    )


def _null_profile(t: StarTables) -> DataFrame:
    tables = {
        "orders": t.located_orders(),
        "order_items": t.order_items(),
        "menu_items": t.menu_items(),
        "customers": t.customers(),
        "ratings": t.ratings(),
        "wastage": t.located_wastage(),
    }
    parts = [
        quality.null_profile(df).select(F.lit(name).alias("table"), "column", "nulls", "pct")
        for name, df in tables.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _duplicate_keys(t: StarTables) -> DataFrame:
    return quality.duplicate_keys(
        {
            "orders": (t.orders(), "order_id"),
            "customers": (t.customers(), "customer_id"),
            "menu_items": (t.menu_items(), "item_id"),
            "order_items": (t.order_items(), "order_line_id"),
        }
    )


def _quality_report(t: StarTables) -> DataFrame:
    return quality.quality_report(
        t.located_orders(),
        t.order_items(),
        t.menu_items(),
        t.customers(),
        t.ratings(),
        t.wastage(),
        t.restaurants(),
    )


def _forecast_metrics(t: StarTables) -> DataFrame:
    _, predictions = demand.train_forecast(demand.demand_features(_daily(t)))
    return demand.forecast_metrics(predictions)


def _forecast_dom(t: StarTables) -> DataFrame:
    return demand.forecast_day_of_month(demand.demand_features_dom(_daily(t)))


def _cube(t: StarTables) -> tuple[DataFrame, DataFrame]:
    orders = t.located_orders()
    return sales_cube.sales_cube(orders), sales_cube.customer_bitmaps(sales_cube.visits(orders))


def _locations_of_cube(t: StarTables) -> DataFrame:
    lines = completed_lines(t.order_items(), t.located_orders())
    takings = sales_cube.location_takings_of(*_cube(t))
    return locations.compare_takings(takings, lines, t.menu_items(), t.located_wastage())


def _rule_clusters(t: StarTables) -> DataFrame:
    """Customers clustered by how often they order, so that SQL can check what follows a fit."""
    cluster = (F.least("frequency", F.lit(5)) - 1).cast("int")
    return customers.rfm(t.orders()).withColumn("prediction", cluster)


def _rule_segments(t: StarTables) -> DataFrame:
    return segments.label_segments(_rule_clusters(t))


def _rule_matching(t: StarTables) -> DataFrame:
    rfm = customers.rfm(t.orders())
    by_value = rfm.select("customer_id", band("monetary", VALUE_BANDS, "modest").alias("segment"))
    by_visits = rfm.select("customer_id", band("frequency", VISIT_BANDS, "z").alias("segment"))
    return customers.matched_agreement(by_value, by_visits)


def _real_matching(t: StarTables) -> DataFrame:
    def clusters(rfm: DataFrame) -> DataFrame:
        found = segments.kmeans_segments(rfm)
        return found.select("customer_id", F.col("prediction").alias("segment"))

    orders = t.orders()
    return customers.matched_agreement(
        clusters(customers.rfm(orders)), clusters(customers.rfm_elapsed(orders))
    )


def _rule_forecast(t: StarTables) -> DataFrame:
    features = demand.demand_features(_daily(t))
    guesses = [
        features.select("demand", F.col(lag).alias("predicted"), F.lit(name).alias("model"))
        for name, lag in (("yesterday", "lag_1"), ("last week", "lag_7"))
    ]
    scores = demand.forecast_metrics(guesses[0].unionByName(guesses[1]))
    return scores.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "r2")})


def _rule_models(t: StarTables) -> DataFrame:
    items = _classified(t)
    by_margin = F.when(F.col("profit_pct") >= 50, PROFIT_DRIVER).otherwise(LOW_PERFORMER)
    by_volume = F.when(F.col("qty_sold") >= 240, VOLUME_DRIVER).otherwise(HIDDEN_OPPORTUNITY)
    guesses = F.array(
        F.struct(F.lit("margin").alias("model"), by_margin.alias("prediction")),
        F.struct(F.lit("volume").alias("model"), by_volume.alias("prediction")),
    )
    rows = items.select(F.col("performance_class").alias("label"), F.inline(guesses))
    return classifier.classification_scores(rows)


def _recommended_by_sales(t: StarTables) -> DataFrame:
    """With the share of completed sales, the first choice of the advice."""
    return recommend.recommend(_classified(t), _wastage(t).select("item_id", "wastage_pct"))


QUERIES: dict[str, Callable[[StarTables], DataFrame]] = {
    # quality and cleaning
    "null_profile": _null_profile,
    "duplicate_keys": _duplicate_keys,
    "quality_report": _quality_report,
    "clean_orders": lambda t: quality.clean_orders(t.located_orders()),
    "cleaning_log": lambda t: quality.cleaning_log(t.orders()),
    # menu
    "menu_profitability": lambda t: profit.menu_profitability(
        t.order_items(), t.orders(), t.menu_items()
    ),
    "menu_classified": _classified,
    "class_summary": lambda t: profit.class_summary(_classified(t)),
    "top_profit_items": lambda t: profit.top_profit_items(_classified(t)),
    "top_profit_filtered": lambda t: profit.top_profit_items(
        filter_menu(_classified(t), FILTER_CLASSES, FILTER_CATEGORIES)
    ),
    "promote_candidates": lambda t: profit.promote_candidates(_classified(t)),
    "top_sellers": lambda t: inventory.top_sellers(t.order_items()),
    "low_sellers": lambda t: inventory.low_sellers(t.order_items()),
    "slow_moving_threshold": lambda t: inventory.slow_moving_threshold(
        t.order_items(), t.menu_items(), SLOW_FRACTION
    ),
    "slow_moving_bottom_k": lambda t: inventory.slow_moving_bottom_k(
        t.order_items(), t.menu_items()
    ),
    "inventory_recommendations": lambda t: inventory.inventory_recommendations(t.inventory()),
    "price_what_if": lambda t: pricing.price_what_if(_classified(t), PRICE_CHANGE),
    # locations, channels, periods
    "location_menu": lambda t: profit.location_menu(t.order_items(), t.located_orders()),
    "location_menu_classified": lambda t: profit.location_menu_classified(
        t.order_items(), t.located_orders(), t.menu_items()
    ),
    "location_comparison": _locations,
    "top_locations": lambda t: locations.top_locations(_locations(t)),
    "worst_locations": lambda t: locations.worst_locations(_locations(t)),
    "channel_analysis": lambda t: channels.channel_analysis(t.orders()),
    "channel_detailed": lambda t: channels.channel_detailed(t.order_items(), t.orders()),
    "channel_detailed_orders": lambda t: channels.channel_detailed(
        t.order_items(), t.orders(), distinct_orders=True
    ),
    "channel_top_items": lambda t: channels.channel_item_qty(t.order_items(), t.orders()),
    "peak_hours": lambda t: periods.peak_hours(t.event_orders()),
    "peak_days": lambda t: periods.peak_days(t.orders()),
    "weekend_analysis": lambda t: periods.weekend_analysis(t.orders()),
    "monthly_analysis": lambda t: periods.monthly_analysis(t.orders()),
    "monthly_analysis_by_year": lambda t: periods.monthly_analysis(t.orders(), by_year=True),
    "seasonal_analysis": lambda t: periods.seasonal_analysis(t.orders()),
    "orders_with_month": lambda t: periods.orders_with_month(t.located_orders()),
    # the same from one stored scan of the orders
    "cube_channels": lambda t: sales_cube.channel_analysis_of(*_cube(t)),
    "cube_locations": _locations_of_cube,
    "cube_hours": lambda t: sales_cube.peak_hours_of(sales_cube.sales_cube(t.event_orders())),
    "cube_days": lambda t: sales_cube.peak_days_of(_cube(t)[0]),
    "cube_weekend": lambda t: sales_cube.weekend_analysis_of(_cube(t)[0]),
    "cube_months": lambda t: sales_cube.monthly_analysis_of(_cube(t)[0], by_year=True),
    "cube_seasons": lambda t: sales_cube.seasonal_analysis_of(_cube(t)[0]),
    "cube_totals": lambda t: sales_cube.paid_totals_of(*_cube(t)),
    # wastage
    "wastage_analysis": _wastage,
    "wastage_by_location": lambda t: wastage.wastage_by_location(t.located_wastage()),
    "wastage_by_category": lambda t: wastage.wastage_by_category(t.wastage(), t.menu_items()),
    "wastage_by_day": lambda t: wastage.wastage_by_day(t.wastage()),
    "wastage_by_reason": lambda t: wastage.wastage_by_reason(t.wastage()),
    "wastage_risk": lambda t: wastage.wastage_risk(t.wastage(), t.order_items()),
    "top_wastage": lambda t: wastage.top_wastage(_wastage(t)),
    "wastage_headline": lambda t: wastage.wastage_headline(_wastage(t)),
    # ratings
    "rating_analysis": lambda t: ratings.rating_analysis(t.ratings()),
    "rating_by_location": lambda t: ratings.rating_by_location(t.ratings(), t.located_orders()),
    "rating_vs_profit": lambda t: ratings.rating_vs_profit(t.ratings(), _classified(t)),
    "rating_by_promotion": lambda t: ratings.rating_by_promotion(t.ratings(), t.promotions()),
    "best_rated": lambda t: ratings.best_rated(t.ratings(), more_than=2),
    "worst_rated": lambda t: ratings.worst_rated(t.ratings(), more_than=2),
    "rating_anomalies": lambda t: anomalies.rating_anomalies(
        t.ratings(), ANOMALY_RATINGS, ANOMALY_STD
    ),
    # promotions and prices
    "promotion_performance": _promoted,
    "nonpromoted_performance": lambda t: promotions.nonpromoted_performance(
        t.order_items(), t.orders(), t.menu_items(), t.promotions()
    ),
    "promo_traps": lambda t: promotions.promo_traps(_promoted(t), TRAP_QTY, TRAP_MARGIN),
    "promotion_dependency": lambda t: promotions.promotion_dependency(
        t.order_items(), t.promotions()
    ),
    "promotion_dependency_in_window": lambda t: promotions.promotion_dependency_in_window(
        t.order_items(), t.orders(), t.promotions()
    ),
    "price_sensitivity": _sensitivity,
    "sensitivity_summary": lambda t: pricing.sensitivity_summary(_sensitivity(t)),
    "top_price_sensitive": lambda t: pricing.top_price_sensitive(_sensitivity(t)),
    # customers
    "rfm": lambda t: customers.rfm(t.orders()),
    "rfm_plus_one": lambda t: customers.rfm_elapsed(t.orders()),
    "churn_risk": _churn,
    "churn_headline": lambda t: customers.churn_headline(_churn(t)),
    "category_diversity": _diversity,
    "churn_enhanced": lambda t: customers.churn_enhanced(_churn(t), _diversity(t)),
    "repeat_purchase_rate": lambda t: customers.repeat_purchase_rate(t.order_items(), t.orders()),
    "repeat_purchase_orders": lambda t: customers.repeat_purchase_rate(
        t.order_items(), t.orders(), distinct_orders=True
    ),
    "weekend_ratio": lambda t: customers.weekend_ratio(t.order_items(), t.orders()),
    "weekend_only_items": lambda t: customers.weekend_only_items(
        customers.weekend_ratio(t.order_items(), t.orders())
    ),
    "basket_size": lambda t: customers.basket_size(t.order_items(), t.orders()),
    "segment_agreement": _agreement,
    "customer_segments": lambda t: segments.kmeans_segments(customers.rfm(t.orders())),
    "segment_quality": lambda t: segments.segment_quality(customers.rfm(t.orders())),
    "labelled_segments": _labelled,
    "segment_counts": lambda t: segments.segment_counts(_labelled(t)),
    "segment_summary": lambda t: segments.segment_summary(_labelled(t)),
    "customer_targeting": lambda t: segments.customer_targeting(_labelled(t)),
    "segmentation_agreement": _real_matching,
    # what follows a fit, on clusters and forecasts that a rule makes
    "rule_segments": _rule_segments,
    "rule_segment_counts": lambda t: segments.segment_counts(_rule_segments(t)),
    "rule_segment_summary": lambda t: segments.segment_summary(_rule_segments(t)),
    "rule_segment_quality": lambda t: segments.silhouette(_rule_clusters(t)),
    "rule_customer_targeting": lambda t: segments.customer_targeting(_rule_segments(t)),
    "rule_segment_matching": _rule_matching,
    "rule_forecast_metrics": _rule_forecast,
    "rule_model_comparison": _rule_models,
    # baskets
    "baskets": _baskets,
    "frequent_itemsets": lambda t: _basket_text(_itemsets(t), "items"),
    "top_itemsets": lambda t: _basket_text(baskets.top_itemsets(_itemsets(t)), "items"),
    "association_rules": lambda t: _basket_text(
        _six_digits(_rules(t)), "antecedent", "consequent"
    ),
    "top_rules": lambda t: _basket_text(
        baskets.top_rules(_six_digits(_rules(t))), "antecedent", "consequent"
    ),
    "pair_rules": lambda t: _six_digits(
        baskets.pair_rules(_category_baskets(t), RULE_SUPPORT, RULE_CONFIDENCE)
    ),
    "bundle_pairs": lambda t: baskets.bundle_pairs(baskets.baskets(t.order_items())),
    # advice and headline figures
    "recommendations": _recommended,
    "recommendations_by_priority": lambda t: recommend.by_priority(_recommended(t)),
    "recommendations_by_sales": _recommended_by_sales,
    "recommendations_without_wastage": lambda t: recommend.recommend(_classified(t)),
    "recommendation_counts": lambda t: recommend.recommendation_counts(_recommended(t)),
    "tricky_cases": lambda t: recommend.tricky_cases(_classified(t), t.ratings(), **TRICKY),
    "tricky_cases_rated": lambda t: recommend.tricky_cases(
        _classified(t), t.ratings(), **TRICKY, require_rating=True
    ),
    "master_kpis": lambda t: kpis.master_kpis(
        t.orders(), t.menu_items(), t.wastage(), t.ratings()
    ),
    "filtered_kpis": lambda t: kpis.executive_kpis(
        filter_orders(
            t.located_orders(), FILTER_FROM, FILTER_TO, FILTER_LOCATION, FILTER_CHANNEL
        )
    ),
    "daily_revenue": lambda t: kpis.daily_revenue(_dashboard_orders(t)),
    "channel_mix": lambda t: kpis.channel_mix(_dashboard_orders(t)),
    # demand and anomalies
    "sales_anomalies": lambda t: anomalies.sales_anomalies(t.orders()),
    "top_anomalies": lambda t: anomalies.top_anomalies(anomalies.sales_anomalies(t.orders())),
    "daily_demand": _daily,
    "demand_features": lambda t: demand.demand_features(_daily(t)),
    "demand_features_dom": lambda t: demand.demand_features_dom(_daily(t)),
    "demand_split": lambda t: demand.demand_split(demand.demand_features(_daily(t))),
    "forecast_error": lambda t: demand.forecast_error(
        demand.naive_forecast(demand.demand_features(_daily(t)))
    ),
    "fitted_demand": lambda t: demand.fitted_demand(demand.demand_features(_daily(t))),
    "linear_forecast": lambda t: demand.linear_forecast(demand.demand_features(_daily(t))),
    "forecast_metrics": _forecast_metrics,
    "forecast_predictions": _forecast_dom,
    "forecast_model_error": lambda t: demand.forecast_error(_forecast_dom(t)),
    "model_comparison": lambda t: classifier.train_menu_classifier(_classified(t))[1],
}


def _bind(build: Callable[[StarTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(StarTables(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(build) for name, build in QUERIES.items()}
