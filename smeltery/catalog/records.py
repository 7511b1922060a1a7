"""Queries over nested data: extraction by path, exploding, flattening, renaming, discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.catalog.frames import EVENTS, INGESTED, BATCH, event_pages, json_list, order_lines, response
from smeltery.catalog.registry import Tables, query
from smeltery.functions.documents import first_record_list, has_items
from smeltery.operators.extract import inherited_key, records_of
from smeltery.operators.flatten import explode_lists, flatten
from smeltery.operators.validate import judge_pages
from smeltery.session import scratch_path
from smeltery.sources.bronze import envelope, land, read_pages
from smeltery.sources.models import Dataset, Level, Model, listed, nested, text, whole, real
from smeltery.sources.silver import silver_rows, write_silver, read_silver

LINE = Model((whole("number"), real("qty"), real("price"), whole("n")))
CUSTOMER = Model((whole("cust_key", "custKey"), text("segment")))
ORDER = Model(
    (
        whole("order_key", "orderKey"),
        text("status"),
        text("order_date", "orderDate"),
        nested("customer", "Customer", CUSTOMER),
        listed("lines", "Lines", LINE),
    )
)
ORDERS = Dataset(
    "orders", ORDER, (Level("OrderTable.Orders"),), ("order_key", "lines_number"), has_season=True
)
ORDERS_PER_PAGE = 200
LINES_PER_RECORD = 100


def order_documents(t: Tables) -> DataFrame:
    """Enveloped pages of orders with their customer and lines nested inside.

    An order with very many line numbers goes on in further records, as a paginated source would
    split it; orders without lines have an empty list.
    """
    line = F.to_json(
        F.struct(
            F.col("l_linenumber").cast("string").alias("number"),
            F.col("qty").cast("string").alias("qty"),
            F.col("price").cast("string").alias("price"),
            F.col("n").cast("string").alias("n"),
        )
    )
    lists = (
        order_lines(t)
        .withColumn("part", (F.col("l_linenumber") / LINES_PER_RECORD).cast("int"))
        .groupBy("l_orderkey", "part")
        .agg(json_list(F.col("l_linenumber"), line).alias("lines"))
    )
    joined = t.orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )
    head = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("orderKey"),
            F.col("o_orderstatus").alias("status"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("orderDate"),
            F.struct(
                F.col("c_custkey").cast("string").alias("custKey"), F.col("c_mktsegment").alias("segment")
            ).alias("Customer"),
        )
    )
    record = F.concat(
        F.expr("left(_head, length(_head) - 1)"), F.lit(',"Lines":['), F.coalesce("lines", F.lit("")), F.lit("]}")
    )
    rows = joined.withColumn("_head", head).select(
        F.year("o_orderdate").alias("season"),
        F.coalesce("part", F.lit(0)).alias("part"),
        (F.col("o_orderkey") / ORDERS_PER_PAGE).cast("int").alias("page"),
        "o_orderkey",
        record.alias("record"),
    )
    pages = rows.groupBy("season", "page", "part").agg(
        json_list(F.col("o_orderkey"), F.col("record")).alias("list"), F.count(F.lit(1)).alias("total")
    )
    body = F.concat(
        F.lit('{"MRData":{"total":"'), F.col("total").cast("string"),
        F.lit('","OrderTable":{"Orders":['), F.col("list"), F.lit("]}}}"),
    )
    none = F.lit(None)
    value = envelope(
        F.lit("orders"), F.col("season"), none, F.lit(BATCH), F.col("page") + 1, F.lit(INGESTED), F.col("total"), body
    )
    return pages.select("season", F.lit(BATCH).alias("batch_id"), value.alias("value"))


def order_rows(t: Tables) -> DataFrame:
    """Orders nested, landed as Bronze, read back, judged, flattened, written and read as Silver."""
    spark = t.spark
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    land(order_documents(t), bronze, ORDERS)
    judged = judge_pages(read_pages(spark, bronze, ORDERS), ORDERS)
    write_silver(silver_rows(judged, ORDERS), silver, ORDERS)
    return read_silver(spark, silver, ORDERS)


_LINES = """(SELECT l_orderkey, l_linenumber, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty,
    sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price, count(*) AS n FROM lineitem GROUP BY ALL)"""


@query(f"""
SELECT year(o_orderdate) AS season, o_orderkey AS order_key, o_orderstatus AS status,
  strftime(o_orderdate, '%Y-%m-%d') AS order_date, c_custkey AS customer_cust_key,
  c_mktsegment AS customer_segment, CAST(l_linenumber AS BIGINT) AS lines_number,
  CAST(qty AS DOUBLE) AS lines_qty, CAST(price AS DOUBLE) AS lines_price, n AS lines_n
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN {_LINES} ON l_orderkey = o_orderkey""")
def envelope_roundtrip(t: Tables) -> DataFrame:
    return order_rows(t).select(
        "season", "order_key", "status", "order_date", "customer_cust_key", "customer_segment",
        "lines_number", "lines_qty", "lines_price", "lines_n",
    )


@query("""
SELECT year(o_orderdate) AS season, o_custkey AS customer, count(DISTINCT o_orderkey) AS orders,
  CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS revenue,
  coalesce(sum(CASE WHEN l_linenumber = 1 THEN 1 END), 0)::BIGINT AS first_lines
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")
def customer_year_totals(t: Tables) -> DataFrame:
    """The whole way: nested pages, Bronze, validation, flattening, Silver, then an aggregate."""
    rows = order_rows(t)
    # Per order first: its rows are few, and the distinct count becomes a plain one.
    orders = rows.groupBy("season", "customer_cust_key", "order_key").agg(
        F.sum(F.col("lines_price").cast("decimal(18,2)")).alias("price"),
        F.sum(F.when(F.col("lines_number") == 1, F.col("lines_n"))).alias("firsts"),
    )
    return orders.groupBy("season", F.col("customer_cust_key").alias("customer")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.coalesce(F.sum("price"), F.lit(0)).cast("double").alias("revenue"),
        F.coalesce(F.sum("firsts"), F.lit(0)).cast("long").alias("first_lines"),
    )


@query("""
SELECT s_suppkey AS supplier_key, s_name AS supplier_name, n_name AS supplier_nation_name,
  r_name AS supplier_nation_region_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def flatten_nested_struct(t: Tables) -> DataFrame:
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    region = F.struct(F.col("r_name").alias("name")).alias("region")
    nation = F.struct(F.col("n_name").alias("name"), region).alias("nation")
    supplier = F.struct(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), nation)
    return flatten(joined.select(supplier.alias("supplier")))


def _order_lists(t: Tables) -> DataFrame:
    """Orders with the list of their line quantities, in pieces of bounded length."""
    piece = (F.col("l_linenumber") / LINES_PER_RECORD).cast("int").alias("piece")
    item = F.struct(F.col("l_linenumber").alias("number"), F.col("qty").cast("double").alias("qty"))
    lists = order_lines(t).groupBy("l_orderkey", piece).agg(
        F.sort_array(F.collect_list(item)).alias("lines")
    )
    return t.orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "lines")


@query(f"""
SELECT o_orderkey, l_linenumber AS lines_number, CAST(qty AS DOUBLE) AS lines_qty
FROM orders LEFT JOIN {_LINES} ON l_orderkey = o_orderkey""")
def explode_outer_keep_empty(t: Tables) -> DataFrame:
    return flatten(_order_lists(t))


@query(f"""
SELECT o_orderkey, l_linenumber AS lines_number, CAST(qty AS DOUBLE) AS lines_qty
FROM orders JOIN {_LINES} ON l_orderkey = o_orderkey""")
def explode_inner(t: Tables) -> DataFrame:
    return flatten(explode_lists(_order_lists(t), ["lines"], keep_empty=False))


@query(f"""
SELECT o_orderkey, l_linenumber AS number, CAST(qty AS DOUBLE) AS qty
FROM orders LEFT JOIN {_LINES} ON l_orderkey = o_orderkey""")
def zip_explode(t: Tables) -> DataFrame:
    lists = _order_lists(t).select(
        "o_orderkey", F.col("lines.number").alias("number"), F.col("lines.qty").alias("qty")
    )
    return flatten(lists)


SUPPLIER = Model((whole("key"), text("name")))
SUPPLIERS = Dataset(
    "suppliers",
    SUPPLIER,
    (Level("RegionTable.Regions", (text("region"),)), Level("Nations", (text("nation"),)), Level("Suppliers")),
    ("key",),
)
SUPPLIERS_PER_PAGE = 1000


@query("""
SELECT r_name AS region, n_name AS nation, s_suppkey AS key, s_name AS name
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def nested_record_path(t: Tables) -> DataFrame:
    """Suppliers two lists below the regions of a page, with the names above carried along."""
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    leaf = F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("name")))
    rows = joined.select(
        (F.col("s_suppkey") / SUPPLIERS_PER_PAGE).cast("int").alias("page"), "r_name", "n_name", "s_suppkey", leaf.alias("record")
    )
    nations = rows.groupBy("page", "r_name", "n_name").agg(json_list(F.col("s_suppkey"), F.col("record")).alias("l"))
    nation = F.concat(F.lit('{"nation":"'), "n_name", F.lit('","Suppliers":['), "l", F.lit("]}"))
    regions = nations.groupBy("page", "r_name").agg(json_list(F.col("n_name"), nation).alias("l"))
    region = F.concat(F.lit('{"region":"'), "r_name", F.lit('","Nations":['), "l", F.lit("]}"))
    pages = response(
        regions.select("page", "r_name", region.alias("record")),
        ["page"], "r_name", F.lit('"RegionTable":{"Regions":['), "]}}}",
    )
    parsed = pages.select(F.parse_json("value").alias("document"))
    found = parsed.select(F.explode(F.expr(records_of("document", SUPPLIERS))).alias("e"))
    return found.select(
        F.expr(inherited_key("e", SUPPLIERS, "region")).alias("region"),
        F.expr(inherited_key("e", SUPPLIERS, "nation")).alias("nation"),
        F.try_variant_get("e.record", "$.key", "long").alias("key"),
        F.try_variant_get("e.record", "$.name", "string").alias("name"),
    )


@query("""
SELECT event_id, user_id, event_type, value FROM events""")
def alias_rename(t: Tables) -> DataFrame:
    """Half the records use the output names, half the JSON names; both are accepted."""

    def record(event: str, user: str, kind: str):
        return F.to_json(
            F.struct(
                F.col("event_id").alias(event),
                F.col("user_id").cast("string").alias(user),
                F.col("event_type").alias(kind),
                F.col("value"),
                F.lit("2024-01-01").alias("seenAt"),
                F.lit(1).alias("ignored"),
            )
        )

    text_ = F.when(F.col("event_id") % 2 == 0, record("event_id", "user_id", "event_type")).otherwise(
        record("eventId", "userId", "eventType")
    )
    judged = judge_pages(event_pages(t.events, record=text_), EVENTS)
    return silver_rows(judged, EVENTS).select("event_id", "user_id", "event_type", "value")


@query("""
SELECT event_id, user_id FROM events WHERE (event_id // 500) % 3 < 2""")
def record_discovery(t: Tables) -> DataFrame:
    """Record lists found by shape where no path is declared.

    A third of the pages hide the list below decoys (empty lists, lists of numbers); another third
    keeps it inside a list of numbers, where it does not count.
    """
    pages = event_pages(t.events, dirty=False)
    response_ = F.get_json_object("value", "$.data.MRData")
    decoy = F.concat(F.lit('{"a":[],"b":[1,{"c":[{"eventId":"9"}]}],"d":{"e":'), response_, F.lit("}}"))
    hidden = F.concat(F.lit('{"a":[0,'), response_, F.lit("]}"))
    kind = (F.col("page") - 1) % 3
    shaped = pages.select(F.when(kind == 0, response_).when(kind == 1, decoy).otherwise(hidden).alias("j"))
    items = shaped.select(
        F.explode(F.from_json(first_record_list(F.col("j")), "array<struct<eventId:string,userId:string>>")).alias("i")
    )
    return items.select(F.col("i.eventId").cast("long").alias("event_id"), F.col("i.userId").cast("long").alias("user_id"))


@query("""
SELECT event_type, (event_id // 500 + 1)::INT AS page, (event_id // 500) % 3 = 0 AS has_items
FROM events GROUP BY ALL""")
def list_presence(t: Tables) -> DataFrame:
    """Whether a page holds a non-empty list: some do, some lost theirs, some bury it too deep."""
    pages = event_pages(t.events, dirty=False)
    kind = (F.col("page") - 1) % 3
    response_ = F.get_json_object("value", "$.data.MRData")
    emptied = F.lit('{"total":"9","note":"[1]","EventTable":{"Events":[ ]}}')
    deep = F.concat(F.lit('{"k":' * 25), response_, F.lit("}" * 25))
    text_ = F.when(kind == 0, response_).when(kind == 1, emptied).otherwise(deep)
    return pages.select(F.col("kind").alias("event_type"), "page", has_items(text_).alias("has_items"))
