"""Declared schemas of the retail tables and of the churn records, with their keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, INT, DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()
DATE, TIMESTAMP, BOOLEAN = T.DateType(), T.TimestampType(), T.BooleanType()


@dataclass(frozen=True)
class TableSpec:
    """One table: its columns, primary key and foreign keys (column -> parent table)."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    parents: dict[str, str] = field(default_factory=dict)

    @property
    def date_columns(self) -> list[str]:
        return [f.name for f in self.schema if isinstance(f.dataType, T.DateType)]


def _table(name, key, columns, parents=None):
    schema = T.StructType([T.StructField(n, t, True) for n, t in columns])
    return TableSpec(name, schema, tuple(key), parents or {})


# Names and types of the retail tables, parents before children.
TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        _table("category", ["category_id"], [("category_id", STRING), ("category_name", STRING)]),
        _table("channel", ["channel_id"], [("channel_id", STRING), ("channel_name", STRING)]),
        _table(
            "store",
            ["store_id"],
            [("store_id", STRING), ("store_city", STRING), ("store_state", STRING), ("store_type", STRING)],
        ),
        _table(
            "customer",
            ["customer_id"],
            [
                ("customer_id", STRING),
                ("signup_date", DATE),
                ("city", STRING),
                ("state", STRING),
                ("segment", STRING),
                ("status", STRING),
            ],
        ),
        _table(
            "promotion",
            ["promo_id"],
            [
                ("promo_id", STRING),
                ("promo_type", STRING),
                ("start_date", DATE),
                ("end_date", DATE),
                ("discount_value", DOUBLE),
            ],
        ),
        _table(
            "marketing_channel",
            ["channel_id"],
            [("channel_id", STRING), ("channel_name", STRING), ("channel_type", STRING), ("cost_tier", STRING)],
        ),
        _table(
            "product",
            ["product_id"],
            [("product_id", STRING), ("category_id", STRING), ("brand", STRING), ("sku_name", STRING)],
            {"category_id": "category"},
        ),
        _table(
            "order",
            ["order_id"],
            [
                ("order_id", STRING),
                ("customer_id", STRING),
                ("order_date", DATE),
                ("store_id", STRING),
                ("channel_id", STRING),
                ("payment_type", STRING),
                ("year", INT),
                ("week", INT),
            ],
            {"customer_id": "customer", "store_id": "store", "channel_id": "channel"},
        ),
        _table(
            "order_item",
            ["order_item_id"],
            [
                ("order_item_id", STRING),
                ("order_id", STRING),
                ("product_id", STRING),
                ("promo_id", STRING),
                ("quantity", INT),
                ("item_discount", DOUBLE),
            ],
            {"order_id": "order", "product_id": "product", "promo_id": "promotion"},
        ),
        _table(
            "price_change",
            ["product_id", "year", "week"],
            [("product_id", STRING), ("year", INT), ("week", INT), ("unit_price", DOUBLE)],
            {"product_id": "product"},
        ),
        _table(
            "session",
            ["session_id"],
            [
                ("session_id", STRING),
                ("customer_id", STRING),
                ("session_start", TIMESTAMP),
                ("session_duration_sec", INT),
                ("pages_viewed", INT),
                ("device", STRING),
                ("referrer", STRING),
            ],
            {"customer_id": "customer"},
        ),
        _table(
            "support_ticket",
            ["ticket_id"],
            [
                ("ticket_id", STRING),
                ("customer_id", STRING),
                ("created_date", DATE),
                ("issue_type", STRING),
                ("status", STRING),
                ("resolution_time_hr", INT),
                ("csat_score", INT),
            ],
            {"customer_id": "customer"},
        ),
        _table(
            "campaign_touch",
            ["touch_id"],
            [
                ("touch_id", STRING),
                ("customer_id", STRING),
                ("touch_date", DATE),
                ("channel", STRING),
                ("campaign_name", STRING),
                ("outcome", STRING),
            ],
            {"customer_id": "customer"},
        ),
        _table(
            "external_factor",
            ["factor_id"],
            [
                ("factor_id", STRING),
                ("store_id", STRING),
                ("factor_date", DATE),
                ("is_holiday", BOOLEAN),
                ("temp_c", DOUBLE),
                ("rainfall_mm", DOUBLE),
                ("trend_index", DOUBLE),
                ("cpi_index", DOUBLE),
                ("year", INT),
                ("week", INT),
            ],
            {"store_id": "store"},
        ),
    )
}

# The churn record contract; ``churn`` is the target.
CHURN_COLUMNS = (
    ("age", INT),
    ("gender", STRING),
    ("region", STRING),
    ("income", DOUBLE),
    ("tenure_months", INT),
    ("monthly_spend", DOUBLE),
    ("website_visits", INT),
    ("support_tickets", INT),
    ("email_click_rate", DOUBLE),
    ("loyalty_score", DOUBLE),
    ("campaign_type", STRING),
    ("discount_used", INT),
    ("last_campaign_days", INT),
    ("churn", INT),
)
CHURN_SCHEMA = T.StructType([T.StructField(n, t, n != "churn") for n, t in CHURN_COLUMNS])
