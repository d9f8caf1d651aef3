"""Queries over readers, writers, ingestion and splits."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.operators import churn as churn_ops
from mixloom.operators import keys
from mixloom.plans import views
from mixloom.plans.registry import Tables, as_text, query, rounded
from mixloom.sources import readers, warehouse, writers
from mixloom.sources.schemas import TABLES
from mixloom.sources.staging import staging_root


def _folder(t: Tables) -> str:
    return f"{staging_root(t.spark).rstrip('/')}/mixloom-{uuid.uuid4().hex}"


def _as_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


@query("s1_read_csv_inferred", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def read_csv_inferred(t: Tables) -> DataFrame:
    path = _as_csv(t.customer, _folder(t))
    return readers.read_csv_inferred(t.spark, path).select(
        F.col("c_custkey").cast("long"), "c_name", F.col("c_nationkey").cast("int"), "c_acctbal", "c_mktsegment"
    )


@query(
    "s2_read_csv_contract",
    """SELECT count(*) AS n_rows, count(*) FILTER (s_suppkey % 7 = 0) AS n_corrupt, count(*) AS n_s_suppkey,
              count(*) FILTER (s_suppkey % 7 <> 0) AS n_s_acctbal FROM supplier""",
)
def read_csv_contract(t: Tables) -> DataFrame:
    """Every seventh balance is unreadable; the contract turns it into NULL and the row is counted."""
    damaged = t.supplier.select(
        "s_suppkey", F.when(F.col("s_suppkey") % 7 == 0, "n/a").otherwise(F.col("s_acctbal").cast("string")).alias("s_acctbal")
    )
    path = _as_csv(damaged, _folder(t))
    contract = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_acctbal", T.DoubleType())])
    return readers.corrupt_count(readers.read_csv(t.spark, path, contract, keep_corrupt=True))


def _schema_rows(t: Tables, schema: T.StructType) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema)]
    return t.spark.createDataFrame(rows, "position int, column_name string, data_type string, is_nullable boolean")


@query("s3_freeze_schema")
def freeze_schema(t: Tables) -> DataFrame:
    readers.freeze_schema(t.lineitem, path := _folder(t))
    return t.spark.read.text(path, wholetext=True)


@query("s4_load_schema")
def load_schema(t: Tables) -> DataFrame:
    readers.freeze_schema(t.orders, path := _folder(t))
    return _schema_rows(t, readers.load_schema(t.spark, path))


@query(
    "s5_ingest",
    views.with_views(
        "order_",
        """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
                  CAST(order_date AS VARCHAR) AS order_date, channel_id, payment_type, year, week FROM order_""",
    ),
)
def ingest(t: Tables) -> DataFrame:
    """Orders as CSV with repeated rows and two date layouts, ingested into Parquet."""
    text = F.when(F.col("week") > 26, F.date_format("order_date", "dd-MM-yyyy")).otherwise(
        F.date_format("order_date", "yyyy-MM-dd")
    )
    raw = views.order(t).withColumns({"order_date": text, "store_id": F.lit(None).cast("string")})
    raw = raw.select(*TABLES["order"].schema.names)
    root = _folder(t)
    again = raw.filter(F.col("channel_id") == "1-URGENT")
    _as_csv(raw.unionByName(again), f"{root}/ORDER.csv")
    tables = readers.ingest(t.spark, root, f"{root}/tables", ["order"])
    return as_text(tables["order"].drop("store_id"), "order_date")


def _two_layouts(day: str, flag: Column) -> Column:
    return F.when(flag, F.date_format(day, "dd-MM-yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))


def _star_batches(t: Tables) -> dict[str, DataFrame]:
    """Every retail table as a batch of text, with planted faults: see ``STAR_SQL``."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    customer = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    store = t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    text, null = F.lit, F.lit(None).cast("string")
    orders = views.order(t).withColumns(
        {"order_date": _two_layouts("order_date", F.col("week") > 26), "store_id": (F.col("customer_id") % 10).cast("string")}
    )
    day = F.col("ts").cast("date")

    def events(kind: str, **columns) -> DataFrame:
        return t.events.filter(F.col("event_type") == kind).select(*[c.alias(n) for n, c in columns.items()])

    key, user, hours = F.col("event_id"), F.col("user_id"), F.col("value").cast("int")
    return {
        "category": views.category(t),
        "channel": t.orders.select(F.col("o_orderpriority").alias("channel_id"), F.col("o_orderpriority").alias("channel_name")).distinct(),
        "store": store.select(F.col("s_suppkey").alias("store_id"), F.col("n_name").alias("store_city"), F.col("r_name").alias("store_state"), text("S").alias("store_type")),
        "customer": customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.when(F.col("c_custkey") % 53 == 7, "unknown").otherwise(F.when(F.col("c_custkey") % 2 == 0, "2020-02-01").otherwise("01-03-2020")).alias("signup_date"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.col("c_mktsegment").alias("segment"),
            text("active").alias("status"),
        ),
        "promotion": t.part.select(
            F.col("p_brand").alias("promo_id"), text("PCT_OFF").alias("promo_type"), text("2025-01-01").alias("start_date"), text("31-01-2025").alias("end_date"), F.lit(10.0).alias("discount_value")
        ).distinct(),
        "marketing_channel": t.events.select(
            F.col("event_type").alias("channel_id"), F.col("event_type").alias("channel_name"), text("digital").alias("channel_type"), text("low").alias("cost_tier")
        ).distinct(),
        "product": t.part.select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_partkey") % 41 == 3, "NONE").otherwise(F.col("p_type")).alias("category_id"),
            F.col("p_brand").alias("brand"),
            F.col("p_name").alias("sku_name"),
        ),
        "order": orders.unionByName(orders.filter(F.col("channel_id") == "1-URGENT")),
        "order_item": t.lineitem.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            null.alias("promo_id"),
            F.when(F.col("l_partkey") % 89 == 5, "many").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
            F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("double").alias("item_discount"),
        ),
        "price_change": views.price_change(t),
        "session": events(
            "view", session_id=F.when(key % 101 != 0, key), customer_id=user, session_start=F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            session_duration_sec=hours, pages_viewed=F.lit(1), device=text("web"), referrer=null,
        ),
        "support_ticket": events(
            "error", ticket_id=key, customer_id=user, created_date=F.date_format(day, "yyyy-MM-dd"), issue_type=text("error"), status=text("open"),
            resolution_time_hr=hours, csat_score=F.lit(3),
        ),
        "campaign_touch": events(
            "click", touch_id=key, customer_id=user, touch_date=F.date_format(day, "dd-MM-yyyy"), channel=text("mail"), campaign_name=text("spring"), outcome=text("open")
        ),
        "external_factor": events(
            "signup", factor_id=key, store_id=user % 10, factor_date=F.date_format(day, "yyyy-MM-dd"), is_holiday=F.lit(True), temp_c=F.col("value"),
            rainfall_mm=F.lit(0.0), trend_index=F.lit(1.0), cpi_index=F.lit(1.0), year=F.year(day), week=F.weekofyear(day),
        ),
    }


#: Customers with an unreadable date fall out, and with them their orders, items, sessions, tickets and
#: touches; products without a category, and with them their items and prices.
STAR_SQL = """WITH good_customer AS (SELECT c_custkey FROM customer WHERE c_custkey % 53 <> 7),
    good_product AS (SELECT p_partkey FROM part WHERE p_partkey % 41 <> 3),
    orders_read AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'),
    good_order AS (SELECT DISTINCT o_orderkey FROM orders_read WHERE o_custkey IN (FROM good_customer)),
    r AS (
      SELECT 'category' AS t, CAST(p_type AS VARCHAR) AS k, CAST(NULL AS VARCHAR) AS reason FROM (SELECT DISTINCT p_type FROM part)
      UNION ALL SELECT 'channel', o_orderpriority, NULL FROM (SELECT DISTINCT o_orderpriority FROM orders)
      UNION ALL SELECT 'store', CAST(s_suppkey AS VARCHAR), NULL FROM supplier
      UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 53 = 7 THEN 'bad_date' END FROM customer
      UNION ALL SELECT 'promotion', p_brand, NULL FROM (SELECT DISTINCT p_brand FROM part)
      UNION ALL SELECT 'marketing_channel', event_type, NULL FROM (SELECT DISTINCT event_type FROM events)
      UNION ALL SELECT 'product', CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 41 = 3 THEN 'orphan:category_id' END FROM part
      UNION ALL SELECT 'order', CAST(o_orderkey AS VARCHAR),
                       CASE WHEN o_custkey NOT IN (FROM good_customer) THEN 'orphan:customer_id' END FROM orders_read
      UNION ALL SELECT 'order_item', l_orderkey || '-' || l_linenumber,
                       CASE WHEN l_partkey % 89 = 5 THEN 'bad_value' WHEN l_orderkey NOT IN (FROM good_order) THEN 'orphan:order_id'
                            WHEN l_partkey NOT IN (FROM good_product) THEN 'orphan:product_id' END FROM lineitem
      UNION ALL SELECT 'price_change', p || '-' || y || '-' || w, CASE WHEN p NOT IN (FROM good_product) THEN 'orphan:product_id' END
                FROM (SELECT DISTINCT l_partkey AS p, year(o_orderdate) AS y, week(o_orderdate) AS w
                      FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
      UNION ALL SELECT 'session', CAST(event_id AS VARCHAR), CASE WHEN event_id % 101 = 0 THEN 'null_key'
                       WHEN user_id NOT IN (FROM good_customer) THEN 'orphan:customer_id' END FROM events WHERE event_type = 'view'
      UNION ALL SELECT 'support_ticket', CAST(event_id AS VARCHAR),
                       CASE WHEN user_id NOT IN (FROM good_customer) THEN 'orphan:customer_id' END FROM events WHERE event_type = 'error'
      UNION ALL SELECT 'campaign_touch', CAST(event_id AS VARCHAR),
                       CASE WHEN user_id NOT IN (FROM good_customer) THEN 'orphan:customer_id' END FROM events WHERE event_type = 'click'
      UNION ALL SELECT 'external_factor', CAST(event_id AS VARCHAR), NULL FROM events WHERE event_type = 'signup'),
    good AS (SELECT t, count(*) AS n, count(DISTINCT k) AS u FROM r WHERE reason IS NULL GROUP BY t),
    bad AS (SELECT t, reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY ALL)
    SELECT CAST(run AS INTEGER) AS run, t AS table_name, outcome, CAST(n AS BIGINT) AS n_rows FROM (
      SELECT t, unnest(['inserted', 'present', 'duplicate']) AS outcome, unnest([u, 0, n - u]) AS n, 1 AS run FROM good
      UNION ALL SELECT t, unnest(['inserted', 'present', 'duplicate']), unnest([0, u, n - u]), 2 FROM good
      UNION ALL SELECT t, reason, n, unnest([1, 2]) FROM bad)"""


def _put_batches(t: Tables, root: str, names=None) -> None:
    """The named batches (all) as CSV files, written side by side."""
    batches = _star_batches(t)

    def put(name: str) -> None:
        _as_csv(batches[name].select(*TABLES[name].schema.names), f"{root}/{name.upper()}.csv")

    with ThreadPoolExecutor(warehouse.AT_ONCE) as pool:
        written = [pool.submit(inheritable_thread_target(t.spark)(put), n) for n in names or batches]
    for w in written:
        w.result()


@query("s5_ingest_star", STAR_SQL)
def ingest_star(t: Tables) -> DataFrame:
    """All retail tables in order of their keys, ingested twice; what became of the rows in each run."""
    root = _folder(t)
    _put_batches(t, root)
    house = warehouse.Warehouse(t.spark, f"{root}/tables")
    runs = [warehouse.report(t.spark, house.ingest(root)).withColumn("run", F.lit(run)) for run in (1, 2)]
    return runs[0].unionByName(runs[1])


@query(
    "s5_ingested_sales",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, product_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, count(*) AS n_items
       FROM (SELECT l_orderkey, l_linenumber, min(CAST(l_partkey AS VARCHAR)) AS product_id FROM lineitem
             JOIN part ON p_partkey = l_partkey WHERE p_partkey % 41 <> 3 AND l_partkey % 89 <> 5 GROUP BY ALL)
       JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
       WHERE c_custkey % 53 <> 7 GROUP BY ALL""",
)
def ingested_sales(t: Tables) -> DataFrame:
    """Items per order and product of the loaded star schema, joined as it was loaded."""
    root = _folder(t)
    wanted = ["category", "channel", "store", "customer", "promotion", "product", "order", "order_item"]
    _put_batches(t, root, wanted)
    house = warehouse.Warehouse(t.spark, f"{root}/tables")
    house.ingest(root, wanted)
    joined = house.table("order_item").join(house.table("order"), "order_id").join(house.table("product"), "product_id")
    return as_text(joined.groupBy("order_id", "product_id", "order_date").agg(F.count(F.lit(1)).alias("n_items")), "order_date")


@query(
    "s6_dedupe_on_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                      ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
         FROM lineitem) WHERE rn = 1""",
)
def dedupe_on_key(t: Tables) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return keys.dedupe_on_key(t.lineitem.select(*columns), ["l_orderkey", "l_linenumber"], columns[2:])


MAIN_SQL = """
    SELECT o.order_id, o.customer_id, CAST(o.order_date AS STRING) AS order_date, o.year, o.week, c.segment,
           i.quantity, round(i.item_discount, 4) AS item_discount, i.product_id, p.brand, k.category_name,
           round(r.unit_price, 8) AS unit_price
    FROM {orders} o
    JOIN {customer} c ON c.customer_id = o.customer_id
    JOIN {order_item} i ON i.order_id = o.order_id
    JOIN {product} p ON p.product_id = i.product_id
    JOIN {category} k ON k.category_id = p.category_id
    JOIN {price_change} r ON r.product_id = i.product_id AND r.year = o.year AND r.week = o.week"""


@query(
    "s7_main_dataset_sql",
    views.with_views(
        "main_items",
        """SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, year, week, segment, quantity,
                  round(item_discount, 4) AS item_discount, product_id, brand, category_name,
                  round(unit_price, 8) AS unit_price FROM main_items""",
    ),
)
def main_dataset_sql(t: Tables) -> DataFrame:
    return readers.sql_source(
        t.spark,
        MAIN_SQL,
        orders=views.order(t),
        customer=views.customer(t),
        order_item=views.order_item(t),
        product=views.product(t),
        category=views.category(t),
        price_change=views.price_change(t),
    )


SCORES_SQL = "SELECT c_custkey, (c_custkey * 37 % 101) / 100.0::DOUBLE AS score FROM customer"


@query(
    "s8_save_predictions",
    f"""SELECT c_custkey, CAST(score >= 0.5 AS DOUBLE) AS predicted_class, score AS predicted_probability
        FROM ({SCORES_SQL})""",
)
def save_predictions(t: Tables) -> DataFrame:
    score = (F.col("c_custkey") * 37 % 101) / F.lit(100.0)
    scored = t.customer.withColumns(
        {"predicted_probability": score, "predicted_class": (score >= 0.5).cast("double")}
    )
    writers.save_predictions(scored, path := _folder(t), ["c_custkey"])
    schema = T.StructType.fromDDL("c_custkey long, predicted_class double, predicted_probability double")
    return readers.read_csv(t.spark, path, schema)


@query(
    "s9_save_load_table",
    """SELECT c_mktsegment AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1""",
)
def save_load_table(t: Tables) -> DataFrame:
    table = t.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )
    writers.save_table(table, path := _folder(t))
    return writers.load_table(t.spark, path, T.StructType.fromDDL("segment string, n long, balance double"))


@query("s10_random_split")
def random_split(t: Tables) -> DataFrame:
    train, test = churn_ops.random_split(t.customer)
    marked = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return marked.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


SPLIT_SQL = """
    CASE WHEN CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '#420'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE
              < 0.8 THEN 'train' ELSE 'test' END"""


@query("s10_hash_split", f"SELECT c_custkey, {SPLIT_SQL} AS split FROM customer")
def hash_split(t: Tables) -> DataFrame:
    return churn_ops.hash_split(t.customer, "c_custkey").select("c_custkey", "split")


@query("j13_complement", f"SELECT c_custkey, c_acctbal FROM customer WHERE {SPLIT_SQL} = 'test'")
def complement(t: Tables) -> DataFrame:
    train = churn_ops.hash_split(t.customer, "c_custkey").filter("split = 'train'")
    return churn_ops.complement(t.customer, train, "c_custkey").select("c_custkey", "c_acctbal")


@query("u1_union_train_test", "SELECT c_custkey, c_mktsegment FROM customer")
def union_train_test(t: Tables) -> DataFrame:
    split = churn_ops.hash_split(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey")
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    return train.unionByName(test).drop("split")


@query(
    "p23_rename",
    """SELECT c_custkey AS customer_id, c_mktsegment AS segment, round(c_acctbal, 2) AS balance FROM customer""",
)
def rename(t: Tables) -> DataFrame:
    names = {"c_custkey": "customer_id", "c_mktsegment": "segment", "c_acctbal": "balance"}
    return rounded(t.customer.withColumnsRenamed(names).select(*names.values()), 2, "balance")
