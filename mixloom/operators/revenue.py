"""Sales: the joined item table, line revenue, order roll-up and customer metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixloom.functions.scalars import clip_lower

# Fixed value: rupees per dollar.
EXCHANGE_RATE = 83.0

MAIN_COLUMNS = (
    "order_id",
    "customer_id",
    "order_date",
    "year",
    "week",
    "signup_date",
    "city",
    "state",
    "segment",
    "quantity",
    "item_discount",
    "product_id",
    "brand",
    "category_name",
    "unit_price",
)


def main_dataset(order, customer, order_item, product, category, price_change) -> DataFrame:
    """Items with their order, customer, product, category and weekly price; inner joins.

    The two fact tables meet first, on the order key. The dimensions follow, broadcast by Catalyst
    where their size allows. Where it doesn't, a hot product-week or customer makes a skewed join
    to one row per key, which adaptive execution splits, as no aggregation on that key
    follows. Nothing runs before the result is asked for. Items without a price for the week are
    dropped.
    """
    items = order_item.select("order_id", "product_id", "quantity", "item_discount")
    orders = order.select("order_id", "customer_id", "order_date", "year", "week")
    sold = items.join(orders, "order_id")
    named = product.select("product_id", "category_id", "brand").join(category, "category_id")
    return (
        sold.join(price_change.select("product_id", "year", "week", "unit_price"), ["product_id", "year", "week"])
        .join(named, "product_id")
        .join(customer.select("customer_id", "signup_date", "city", "state", "segment"), "customer_id")
        .select(*MAIN_COLUMNS)
    )


def price_as_of(items: DataFrame, price_change: DataFrame) -> DataFrame:
    """Optional price lookup: the last price of the product at or before the week.

    Prices and the weeks in which a product was sold are put in one order per product; the last
    price is carried to the sold weeks, and items meet it in an equi-join. A product has at most
    as many rows there as the calendar has weeks, twice, however many items it has.
    """
    key = ["product_id", "year", "week"]
    asked = items.select(*key).distinct().withColumn("unit_price", F.lit(None).cast(price_change.schema["unit_price"].dataType))
    # In a week with both, the price comes first.
    both = price_change.select(*key, "unit_price", F.lit(0).alias("_asked")).unionByName(asked.withColumn("_asked", F.lit(1)))
    order = Window.partitionBy("product_id").orderBy("year", "week", "_asked")
    carried = both.withColumn("_last", F.last("unit_price", ignorenulls=True).over(order))
    found = carried.filter("_asked = 1 and _last is not null").select(*key, F.col("_last").alias("unit_price"))
    return items.join(found, key)


def line_revenue(items: DataFrame, rate: float = EXCHANGE_RATE) -> DataFrame:
    """Dollar price and discount, gross and net revenue per item. Net is not floored here."""
    converted = items.withColumns(
        {"unit_price_usd": F.col("unit_price") / rate, "item_discount_usd": F.col("item_discount") / rate}
    )
    gross = F.col("quantity") * F.col("unit_price_usd")
    return converted.withColumns(
        {"gross_revenue_usd": gross, "net_revenue_usd": gross - F.col("item_discount_usd")}
    )


def order_rollup(items: DataFrame) -> DataFrame:
    """One row per order: gross summed, discount the largest of the items, net floored at 0."""
    attributes = ["customer_id", "order_date", "signup_date", "year", "week"]
    rolled = items.groupBy("order_id").agg(
        *[F.min(c).alias(c) for c in attributes],
        F.sum("gross_revenue_usd").alias("gross_revenue_usd"),
        F.max("item_discount_usd").alias("item_discount_usd"),
    )
    net = F.col("gross_revenue_usd") - F.col("item_discount_usd")
    return rolled.withColumn("net_revenue_usd", clip_lower(net, 0.0))


def customer_metrics(orders: DataFrame) -> DataFrame:
    """Total spending and number of purchases per customer."""
    return orders.groupBy("customer_id").agg(
        F.sum("net_revenue_usd").alias("total_spending"), F.count("order_id").alias("purchase_frequency")
    )


def monthly_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.date_format("order_date", "yyyy-MM").alias("year_month")).agg(
        F.sum("net_revenue_usd").alias("net_revenue")
    )
