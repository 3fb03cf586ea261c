"""Labels, thresholds and texts that results are defined by."""

# Order states and channels of the data model.
COMPLETED = "Completed"
CANCELLED = "Cancelled"

# Four-quadrant classes of menu items.
PROFIT_DRIVER = "Profit Driver"
VOLUME_DRIVER = "Volume Driver"
HIDDEN_OPPORTUNITY = "Hidden Opportunity"
LOW_PERFORMER = "Low Performer"

# Seasons by month.
SEASON_MONTHS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}

# Bands: a value strictly above the bound gets the label, first match wins.
CHURN_BANDS = ((180, "High Risk"), (90, "Medium Risk"), (60, "Low Risk"))
CHURN_REST = "Active"
WASTE_BANDS = ((15, "High"), (8, "Medium"))
WASTE_REST = "Low"
PRICE_BANDS = ((10, "Highly Price Sensitive"), (5, "Moderately Price Sensitive"))
PRICE_REST = "Low Price Sensitivity"
PRIORITY_BANDS = ((65, "Critical"), (55, "High"), (45, "Medium"))
PRIORITY_REST = "Low"

# Stock advice.
REORDER_NOW = "REORDER NOW"
STOCK_MONITOR = "MONITOR"
STOCK_SUFFICIENT = "SUFFICIENT"

# Item recommendations.
PROMOTE = "PROMOTE - High margin, low visibility"
REVIEW = "REVIEW - Low performer with high wastage"
REMOVE = "REMOVE or REDESIGN - Low margin"
REPRICE = "REPRICE - High volume, low margin"
MAINTAIN = "MAINTAIN - Strong performer"
MONITOR = "MONITOR"

# Customer segments, richest cluster first, and the strategy for each.
SEGMENT_LABELS = (
    "High-Value Loyal",
    "Frequent",
    "Promotion-Driven",
    "Occasional",
    "At-Risk",
)
SEGMENT_STRATEGIES = (
    "VIP Program - Exclusive offers",
    "Loyalty Rewards - Frequent buyers",
    "Promotional Campaigns - Discount sensitive",
    "Reactivation - Send special offers",
    "Re-engagement - Reminder emails",
)
