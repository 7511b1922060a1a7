"""Pages, Silver-shaped and Gold-shaped frames derived from the driver tables.

Every list that goes into a page is bounded by the key range of its page, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.catalog.registry import Tables
from smeltery.functions.keys import object_key
from smeltery.sources.bronze import envelope
from smeltery.sources.models import Dataset, Level, Model, nested, real, text, whole
from smeltery.sources.registry import SOURCE

BATCH = "20240131T000000"
INGESTED = "2024-01-31T00:00:00Z"
EVENTS_PER_PAGE = 500
CENTS = "decimal(18,2)"

EVENT = Model(
    (
        whole("event_id", "eventId"),
        whole("user_id", "userId"),
        text("event_type", "eventType"),
        real("value"),
        text("seen_at", "seenAt"),
        nested("props", "Props", Model((whole("k"),)), optional=True),
    )
)
EVENTS = Dataset("events", EVENT, (Level("EventTable.Events"),), ("event_id",))

# The faults put into the event pages, as SQL conditions both engines read.
BAD_VALUE = "event_id % 11 = 0"
NO_USER = "event_id % 17 = 0"
NUMBER_TYPE = "event_id % 23 = 0"
NO_PROPS = "event_id % 7 = 0"
IS_BAD = f"({BAD_VALUE} OR {NO_USER} OR {NUMBER_TYPE})"


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def clock(ms: Column) -> Column:
    """Milliseconds as ``m:ss.SSS``."""
    def digits(number: Column, width: int) -> Column:
        return F.lpad(number.cast("long").cast("string"), width, "0")

    minutes = (ms / 60000).cast("long").cast("string")
    return F.concat(minutes, F.lit(":"), digits(ms % 60000 / 1000, 2), F.lit("."), digits(ms % 1000, 3))


def json_list(order: Column, record: Column) -> Column:
    """Aggregate: the records of a page as the inside of a JSON list, in order."""
    rows = F.sort_array(F.collect_list(F.struct(order.alias("o"), record.alias("r"))))
    return F.array_join(F.transform(rows, lambda row: row["r"]), ",")


def event_record(dirty: bool = True) -> Column:
    """JSON text of one event; with ``dirty``, faults by the conditions above."""
    fault = (lambda sql: F.expr(sql)) if dirty else (lambda sql: F.lit(False))

    def record(kind: Column) -> Column:
        return F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("eventId"),
                F.when(~fault(NO_USER), F.col("user_id").cast("string")).alias("userId"),
                kind.alias("eventType"),
                F.when(fault(BAD_VALUE), "n/a").otherwise(F.col("value").cast("string")).alias("value"),
                iso(F.col("ts")).alias("seenAt"),
                F.when(
                    ~F.expr(NO_PROPS), F.struct(F.get_json_object("props", "$.k").alias("k"))
                ).alias("Props"),
                F.lit("x").alias("unknownField"),
            )
        )

    return F.when(fault(NUMBER_TYPE), record(F.lit(7))).otherwise(record(F.col("event_type")))


def event_pages(
    events: DataFrame,
    dirty: bool = True,
    per_page: int = EVENTS_PER_PAGE,
    season: Column | None = None,
    round_: Column | None = None,
    batch: str = BATCH,
    record: Column | None = None,
    total: Column | None = None,
) -> DataFrame:
    """Enveloped pages per event type, optionally per season and round too."""
    none = F.lit(None).cast("int")
    rows = events.select(
        F.col("event_type").alias("kind"),
        (none if season is None else season).alias("_p_season"),
        (none if round_ is None else round_).alias("_p_round"),
        ((F.col("event_id") / per_page).cast("long") + 1).cast("int").alias("page"),
        "event_id",
        (event_record(dirty) if record is None else record).alias("_record"),
    )
    keys = ["kind", "_p_season", "_p_round", "page"]
    grouped = rows.groupBy(*keys).agg(
        json_list(F.col("event_id"), F.col("_record")).alias("_list"),
        F.count(F.lit(1)).alias("_rows"),
    )
    count = F.col("_rows") if total is None else total
    body = F.concat(
        F.lit('{"MRData":{"total":"'), count.cast("string"), F.lit('","EventTable":{"Events":['), F.col("_list"), F.lit("]}}}")
    )
    where = (F.col("kind"), F.lit(batch), F.col("_p_season"), F.col("_p_round"), F.col("page"))
    return grouped.select(
        "kind",
        "_p_season",
        "_p_round",
        F.lit(batch).alias("batch_id"),
        "page",
        object_key(SOURCE, *where).alias("_file_path"),
        envelope(
            F.col("kind"), F.col("_p_season"), F.col("_p_round"), F.lit(batch), F.col("page"),
            F.lit(INGESTED), count, body,
        ).alias("value"),
    )


def order_lines(t: Tables) -> DataFrame:
    """One row per order and line number: rows sharing both are summed first, so no list built
    from them can grow past the line numbers of its page."""
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum(F.col("l_quantity").cast(CENTS)).alias("qty"),
        F.sum(F.col("l_extendedprice").cast(CENTS)).alias("price"),
        F.count(F.lit(1)).alias("n"),
    )


def response(rows: DataFrame, keys: list[str], order: str, head: Column, tail: str) -> DataFrame:
    """Bare response documents from JSON ``record`` rows, one per key combination."""
    pages = rows.groupBy(*keys).agg(
        json_list(F.col(order), F.col("record")).alias("_list"), F.count(F.lit(1)).alias("_rows")
    )
    text = F.concat(
        F.lit('{"MRData":{"total":"'), F.col("_rows").cast("string"), F.lit('",'), head, F.col("_list"), F.lit(tail)
    )
    none = F.lit(None).cast("int")
    return pages.select(
        *(F.col(k).cast("int").alias(f"_p_{k}") if k in keys else none.alias(f"_p_{k}") for k in ("season", "round")),
        F.lit(BATCH).alias("batch_id"),
        F.col("page").cast("int").alias("page"),
        F.lit("derived").alias("_file_path"),
        text.alias("value"),
    )


# --- Silver-shaped frames for the Gold models ---


def race_results(t: Tables) -> DataFrame:
    """Order lines read as race results: year and month as season and round, customer as driver,
    nation as constructor, line number as place, quantity as points."""
    ms = (F.col("l_extendedprice").cast(CENTS) * 100).cast("long")
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.select(
        F.year("o_orderdate").alias("season"),
        F.month("o_orderdate").alias("round"),
        F.concat(F.lit("d"), F.col("o_custkey")).alias("driver_driver_id"),
        F.concat(F.lit("c"), F.col("c_nationkey")).alias("constructor_constructor_id"),
        F.col("l_suppkey").alias("grid"),
        F.col("l_linenumber").alias("position"),
        F.col("l_quantity").alias("points"),
        F.col("l_partkey").alias("laps"),
        F.col("l_returnflag").alias("status"),
        clock(ms).alias("fastest_lap_time_time"),
        F.col("l_linenumber").alias("fastest_lap_rank"),
    )


def races(t: Tables) -> DataFrame:
    return t.orders.groupBy(
        F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("round")
    ).agg(F.max(F.concat(F.lit("circuit"), F.month("o_orderdate"))).alias("circuit_circuit_id"))


def statuses(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_returnflag").alias("status")).agg(
        F.max(F.ascii("l_returnflag")).cast("long").alias("status_id")
    )


def event_results(events: DataFrame) -> DataFrame:
    """Events read as finished races: week as season, day as round, user as driver, event type as
    constructor, value as points; the place follows from the event's number."""
    return events.select(
        F.weekofyear("ts").alias("season"),
        F.dayofmonth("ts").alias("round"),
        F.concat(F.lit("u"), F.col("user_id")).alias("driver_id"),
        F.col("event_type").alias("constructor_id"),
        (F.col("event_id") % 5 + 1).alias("final_position"),
        F.col("value").cast(CENTS).alias("points"),
    )
