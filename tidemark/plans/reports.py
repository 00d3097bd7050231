"""The analytical reports. ``as_of`` stands where a live report would use now.

Tables follow their primary keys: one row per ``order_id`` in orders, per
``user_id`` in users, per ``product_id`` and ``category_id`` in theirs. Ties in
a ranking are broken by the grouping key.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import rounded_ratio
from ..functions.time import moment, truncate
from ..operators.hierarchy import category_roots


def _on_or_after(column: str, start: datetime | date):
    return F.col(column) >= (moment(start) if isinstance(start, datetime) else F.lit(start))


def top_converting_products(
    funnel: DataFrame,
    as_of: datetime,
    lookback: timedelta = timedelta(hours=24),
    min_views: int = 10,
    limit: int = 10,
) -> DataFrame:
    totals = (
        funnel.where(_on_or_after("window_start", as_of - lookback))
        .groupBy("product_id")
        .agg(
            F.sum("page_views").alias("total_page_views"),
            F.sum("add_to_carts").alias("total_add_to_carts"),
            F.sum("purchases").alias("total_purchases"),
        )
        .where(F.col("total_page_views") >= min_views)
    )
    views = F.col("total_page_views")
    return (
        totals.withColumns({
            "conversion_rate_pct": rounded_ratio(F.col("total_purchases"), views, 100),
            "add_to_cart_rate_pct": rounded_ratio(F.col("total_add_to_carts"), views, 100),
        })
        .orderBy(F.desc_nulls_first("conversion_rate_pct"), "product_id")
        .limit(limit)
    )


def hourly_event_volume(sessions: DataFrame, limit: int = 48) -> DataFrame:
    return (
        sessions.where(F.col("session_start").isNotNull())
        .groupBy(truncate(F.col("session_start"), "hour").alias("hour_bucket"))
        .agg(
            F.sum("page_views").alias("page_views"),
            F.sum("add_to_carts").alias("add_to_carts"),
            F.sum("purchases").alias("purchases"),
            F.count_distinct("session_id").alias("unique_sessions"),
        )
        .withColumn("total_events", F.col("page_views") + F.col("add_to_carts") + F.col("purchases"))
        .orderBy(F.desc_nulls_first("hour_bucket"))
        .limit(limit)
    )


def _recent_order_categories(
    items: DataFrame, orders: DataFrame, products: DataFrame, labels: DataFrame, since: date
) -> DataFrame:
    """Recent order lines per (category, order).

    Lines meet the recent orders first, which leaves few of them, and are then
    summed per (order, product) where they are. The product lookup is a plain
    join: it is broadcast if it is small at run time, else a product in very
    many orders is split by the adaptive join.
    """
    recent = orders.where(_on_or_after("order_date", since)).select("order_id", "total")
    sold = items.join(recent, "order_id").groupBy("order_id", "product_id").agg(
        F.count("*").alias("_lines"),
        F.sum("quantity").alias("_quantity"),
        F.sum("line_total").alias("_line_total"),
        F.max("total").alias("total"),
    )
    category_of = products.select("product_id", "category_id").join(labels, "category_id").select(
        "product_id", "category"
    )
    labelled = sold.join(category_of, "product_id")
    return labelled.groupBy("category", "order_id").agg(
        F.sum("_lines").alias("_lines"),
        F.sum("_quantity").alias("_quantity"),
        F.sum("_line_total").alias("_line_total"),
        F.max("total").alias("_order_total"),
    )


def _category_totals(per_order: DataFrame) -> DataFrame:
    # The order total counts once per line, as it does after a join with the lines.
    weighted = (F.col("_order_total") * F.col("_lines")).cast("decimal(22,2)")
    return (
        per_order.groupBy("category")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("_quantity").alias("total_items_sold"),
            F.round(F.sum("_line_total"), 2).alias("total_revenue"),
            F.sum(weighted).cast("decimal(22,2)").alias("_weighted"),
            F.sum("_lines").alias("_all_lines"),
        )
        .withColumn("avg_order_value", rounded_ratio(F.col("_weighted"), F.col("_all_lines")))
        .drop("_weighted", "_all_lines")
        .orderBy(F.desc_nulls_first("total_revenue"), "category")
    )


def revenue_by_category(
    items: DataFrame, orders: DataFrame, products: DataFrame, categories: DataFrame,
    as_of: date, lookback: timedelta = timedelta(days=30),
) -> DataFrame:
    labels = categories.select("category_id", F.col("name").alias("category"))
    return _category_totals(_recent_order_categories(items, orders, products, labels, as_of - lookback))


def revenue_by_root_category(
    items: DataFrame, orders: DataFrame, products: DataFrame, categories: DataFrame,
    as_of: date, lookback: timedelta = timedelta(days=30),
) -> DataFrame:
    """The same report rolled up to the top of the category tree.

    Categories without a root (a parent is missing, or a cycle) share the category NULL.
    """
    roots = category_roots(categories).select("category_id", "root_category_id")
    names = categories.select(F.col("category_id").alias("root_category_id"), F.col("name").alias("category"))
    labels = roots.join(names, "root_category_id", "left").select("category_id", "category")
    return _category_totals(_recent_order_categories(items, orders, products, labels, as_of - lookback))


def _orders_per_user(orders: DataFrame) -> DataFrame:
    """Order totals reduced to one row per user before they meet the users.

    ``order_id`` is the key of orders, so counting it needs no distinct.
    """
    return orders.groupBy("user_id").agg(
        F.count("order_id").alias("_orders"),
        F.count("total").alias("_priced"),
        F.sum("total").alias("_revenue"),
    )


def _buyer_totals(buyers: DataFrame, group: str, buyers_name: str, per_buyer_name: str) -> DataFrame:
    totals = buyers.groupBy(group).agg(
        F.sum("_orders").alias("total_orders"),
        F.count("user_id").alias(buyers_name),
        F.sum("_priced").alias("_priced"),
        F.sum("_revenue").cast("decimal(22,2)").alias("_revenue"),
    )
    return totals.withColumns({
        "avg_order_value": rounded_ratio(F.col("_revenue"), F.col("_priced")),
        "total_revenue": F.round("_revenue", 2),
        per_buyer_name: rounded_ratio(F.col("_revenue"), F.col(buyers_name)),
    }).drop("_priced", "_revenue")


def avg_order_value_by_city(
    orders: DataFrame, users: DataFrame, as_of: date,
    lookback: timedelta = timedelta(days=30), min_orders: int = 5, limit: int = 15,
) -> DataFrame:
    recent = _orders_per_user(orders.where(_on_or_after("order_date", as_of - lookback)))
    buyers = recent.join(users.select("user_id", "city"), "user_id")
    return (
        _buyer_totals(buyers, "city", "unique_buyers", "revenue_per_buyer")
        .where(F.col("total_orders") >= min_orders)
        .orderBy(F.desc_nulls_first("total_revenue"), "city")
        .limit(limit)
    )


def user_cohorts(
    users: DataFrame, orders: DataFrame, as_of: date, lookback: timedelta = timedelta(days=365)
) -> DataFrame:
    """Spending by registration month. Counts users with an order, as only they join."""
    members = users.where(_on_or_after("registered_date", as_of - lookback)).select(
        "user_id", F.trunc("registered_date", "month").alias("cohort_month")
    )
    buyers = members.join(_orders_per_user(orders), "user_id")
    return _buyer_totals(buyers, "cohort_month", "cohort_size", "revenue_per_user").orderBy(
        F.desc_nulls_first("cohort_month")
    )


def session_funnel(sessions: DataFrame) -> DataFrame:
    stages = sessions.agg(
        F.count("*").alias("total_sessions"),
        F.count_if(F.col("page_views") > 0).alias("sessions_with_pageview"),
        F.count_if(F.col("add_to_carts") > 0).alias("sessions_with_add_to_cart"),
        F.count_if(F.col("purchases") > 0).alias("sessions_with_purchase"),
    )
    viewed, carted, bought = (
        F.col(f"sessions_with_{stage}") for stage in ("pageview", "add_to_cart", "purchase")
    )
    return stages.withColumns({
        "view_to_cart_pct": rounded_ratio(carted, viewed, 100),
        "cart_to_purchase_pct": rounded_ratio(bought, carted, 100),
        "overall_conversion_pct": rounded_ratio(bought, viewed, 100),
    })


def sessions_by_city(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Lake sessions joined with the serving users, whatever store either comes from."""
    per_user = sessions.groupBy("user_id").agg(
        F.count("*").alias("_sessions"), F.sum("purchases").alias("_purchases")
    )
    return (
        per_user.join(users.select("user_id", "city"), "user_id")
        .groupBy("city")
        .agg(
            F.count("*").alias("active_users"),
            F.sum("_sessions").alias("total_sessions"),
            F.sum("_purchases").alias("total_purchases"),
        )
    )
