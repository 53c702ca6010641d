"""Business rules as Column expressions (BUS-1..22).

Each rule is a searched CASE whose branch order matters; thresholds and
labels are the fixed values the results must carry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.dates import as_of_date

# ---- fixed values (labels and thresholds that results must reproduce) -------
ORDER_STATUS = {1: "In Process", 2: "Approved", 3: "Backordered", 4: "Rejected",
                5: "Shipped", 6: "Cancelled"}
UNKNOWN_STATUS = "Unknown"
CHANNELS = ("Online", "Offline")
SHIPPING = ("On Time", "Late", "Not Shipped")
LIFECYCLE = ("Discontinued", "Ended", "Not Started", "Active")
RECENCY_DAYS = (30, 60, 90, 180)          # scores 5, 4, 3, 2; else 1
FREQUENCY_PER_MONTH = (4, 2, 1, 0.5)      # scores 5, 4, 3, 2; else 1
MONETARY = (10000, 5000, 2000, 1000)      # scores 5, 4, 3, 2; else 1
SEGMENTS = ("Champion", "Loyal Customer", "Potential Loyalist", "At Risk", "Lost",
            "New Customer", "Regular")
CHANNEL_PREFERENCE = ("Online Preferred", "Offline Preferred", "Mixed")
PERFORMANCE = ("Star Product", "High Performer", "Regular Performer", "Low Performer",
               "Underperformer")
# ------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bit(flag) -> Column:
    """``case when flag = 1 then 1 else 0 end`` as a boolean; NULL → false."""
    return F.coalesce(_c(flag).cast("boolean"), F.lit(False))


def order_status_name(status) -> Column:
    status = _c(status)
    expr = None
    for code, name in ORDER_STATUS.items():
        expr = F.when(status == code, name) if expr is None else expr.when(status == code, name)
    return expr.otherwise(UNKNOWN_STATUS)


def order_channel(is_online) -> Column:
    return F.when(_c(is_online) == F.lit(True), "Online").otherwise("Offline")


def shipping_performance(ship_date, due_date) -> Column:
    ship, due = _c(ship_date), _c(due_date)
    return (F.when(ship.isNotNull() & (ship <= due), "On Time")
            .when(ship.isNotNull() & (ship > due), "Late")
            .otherwise("Not Shipped"))


def discount_flag(discount) -> Column:
    return F.when(_c(discount) > 0, 1).otherwise(0)


def lifecycle_status(discontinued, sell_end, sell_start, as_of=None) -> Column:
    """Discontinued > Ended (end before as_of) > Not Started (start after as_of) > Active.

    ``getdate()`` is a timestamp; comparing a date with it is a comparison with
    the as-of instant, so a sell end equal to the as-of day counts as ended only
    when the as-of instant is later than midnight.
    """
    from salesmart.functions.dates import as_of_ts
    now = as_of_ts(as_of)
    disc, end, start = _c(discontinued), _c(sell_end), _c(sell_start)
    return (F.when(disc.isNotNull(), "Discontinued")
            .when(end.isNotNull() & (end.cast("timestamp_ntz") < now), "Ended")
            .when(start.cast("timestamp_ntz") > now, "Not Started")
            .otherwise("Active"))


def _score(value: Column, bounds, cmp) -> Column:
    expr = None
    for score, b in zip((5, 4, 3, 2), bounds):
        cond = cmp(value, b)
        expr = F.when(cond, score) if expr is None else expr.when(cond, score)
    return expr.otherwise(1)


def recency_score(days_since) -> Column:
    return _score(_c(days_since), RECENCY_DAYS, lambda v, b: v <= b)


def frequency_score(per_month) -> Column:
    return _score(_c(per_month), FREQUENCY_PER_MONTH, lambda v, b: v >= b)


def monetary_score(revenue) -> Column:
    return _score(_c(revenue), MONETARY, lambda v, b: v >= b)


def customer_segment(revenue, per_month, days_since, orders) -> Column:
    """Seven ordered rules; 'Lost' is unreachable because 'At Risk' comes first."""
    r, f, d, n = _c(revenue), _c(per_month), _c(days_since), _c(orders)
    return (F.when((r >= 10000) & (f >= 2) & (d <= 30), "Champion")
            .when((r >= 5000) & (f >= 1) & (d <= 60), "Loyal Customer")
            .when((d <= 30) & (n >= 3), "Potential Loyalist")
            .when(d > 180, "At Risk")
            .when(d > 365, "Lost")
            .when(n == 1, "New Customer")
            .otherwise("Regular"))


def channel_preference(online, offline) -> Column:
    on, off = _c(online), _c(offline)
    return (F.when(on > off * 2, "Online Preferred")
            .when(off > on * 2, "Offline Preferred")
            .otherwise("Mixed"))


def performance_category(revenue, avg_margin) -> Column:
    """Revenue/margin bands; the margin is a ratio, so 30 means 3000 %."""
    r, m = _c(revenue), _c(avg_margin)
    return (F.when((r >= 50000) & (m >= 30), "Star Product")
            .when((r >= 20000) & (m >= 20), "High Performer")
            .when(r >= 10000, "Regular Performer")
            .when(r >= 1000, "Low Performer")
            .otherwise("Underperformer"))
