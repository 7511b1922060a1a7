"""Queries over the Bronze and Silver layers: landing, pruning, overwriting, deduplication, intake."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from smeltery.catalog.datasets import seasons_pages
from smeltery.catalog.frames import BATCH, EVENTS, INGESTED, IS_BAD, event_pages, event_record
from smeltery.catalog.checks import _FATES, _PAGE, _VERDICTS, _mixed_pages
from smeltery.catalog.registry import Tables, query
from smeltery.operators.dedupe import keep_latest_batches, latest_by_key
from smeltery.operators.validate import judge_pages
from smeltery.operators.audit import backfill_summary
from smeltery.operators.quality import CorruptPagesError
from smeltery.plans.silver_run import PagesRejectedError, deduplicated, read_runs, refine, run_seasons, run_silver
from smeltery.plans.staging import season_view, staged
from smeltery.plans.worklist import still_missing, with_keys
from smeltery.session import scratch_path
from smeltery.sources import bronze
from smeltery.sources.consolidate import consolidate, to_consolidate
from smeltery.sources.inventory import inventory_diff, object_inventory
from smeltery.sources.models import Dataset, Level
from smeltery.sources.registry import DATASETS, SOURCE
from smeltery.sources.silver import read_parquet_as, read_silver, silver_rows
from smeltery.sources.single_pages import read_single_pages
from smeltery.sources.tables import as_table, as_view, remove, rename, written
from smeltery.streaming.intake import append_to, drain, new_files, new_pages, read_progress, refine_into, taken_in

# Events as a per-round and as a global dataset, for the two shapes of the layout.
RACE_EVENTS = Dataset(
    "race_events", EVENTS.model, EVENTS.levels, ("event_id",), has_season=True, has_round=True
)
GLOBAL_EVENTS = Dataset("global_events", EVENTS.model, (Level("EventTable.Events"),), ("event_id",))


def _landed(t: Tables, dirty: bool = False, batch: str = BATCH) -> DataFrame:
    pages = event_pages(
        t.events, dirty, season=F.weekofyear("ts"), round_=F.dayofmonth("ts"), batch=batch
    )
    return pages.withColumnsRenamed({"_p_season": "season", "_p_round": "round"})


@query(f"""
WITH landed AS (SELECT weekofyear(ts) AS week, day(ts) AS day, {_PAGE} AS page, event_type, count(*) AS n
  FROM events GROUP BY ALL)
SELECT week AS season, day AS round, sum(n)::BIGINT AS records, count(*) AS pages, count(*) AS distinct_digests, week <> 3 AS same
FROM landed GROUP BY ALL""")
def manifest(t: Tables) -> DataFrame:
    """Landed pages, their checksums compared with those of a second read, one season altered between."""
    base = scratch_path(t.spark, "bronze")
    pages = _landed(t)
    bronze.land(pages, base, RACE_EVENTS)
    first = written(bronze.manifest(bronze.read_pages(t.spark, base, RACE_EVENTS), RACE_EVENTS), "manifest")
    altered = pages.where("season = 3").withColumn("value", F.regexp_replace("value", '"unknownField":"x"', '"unknownField":"y"'))
    bronze.land(altered, base, RACE_EVENTS, mode="overwrite")
    second = bronze.manifest(bronze.read_pages(t.spark, base, RACE_EVENTS), RACE_EVENTS)
    known = second.join(first.select("digest", F.lit(True).alias("known")).distinct(), "digest", "left")
    return known.groupBy("season", "round").agg(
        F.sum("api_response_total").alias("records"),
        F.count(F.lit(1)).alias("pages"),
        F.count_distinct("digest").alias("distinct_digests"),
        F.every(F.col("known").isNotNull()).alias("same"),
    )


@query(f"""
WITH p AS (SELECT DISTINCT weekofyear(ts)::INT AS season, event_type, day(ts) AS day, {_PAGE} AS page FROM events WHERE ts IS NOT NULL),
c AS (SELECT season, CASE WHEN season = 3 THEN 'altered' WHEN season = 2 THEN 'lost' ELSE 'same' END AS change FROM p
  UNION ALL SELECT season, 'added' FROM p WHERE season = 4)
SELECT season, change, count(*) AS objects FROM c GROUP BY ALL""")
def inventory_changes(t: Tables) -> DataFrame:
    """Two inventories of a landing in which one season was altered, one lost, and one landed again."""
    base = scratch_path(t.spark, "bronze")
    pages = _landed(t).where("season IS NOT NULL")
    bronze.land(pages, base, RACE_EVENTS)
    first = written(object_inventory(t.spark, base, RACE_EVENTS), "inventory")
    altered = pages.where("season = 3").withColumn("value", F.regexp_replace("value", '"unknownField":"x"', '"unknownField":"y"'))
    bronze.land(altered, base, RACE_EVENTS, mode="overwrite")
    bronze.land(_landed(t, batch="20240201T000000").where("season = 4"), base, RACE_EVENTS)
    remove(t.spark, bronze.dataset_path(base, RACE_EVENTS, 2))
    second = object_inventory(t.spark, base, RACE_EVENTS, known=first)
    # Pages of several event types share a name here, so they are told apart by what they hold.
    season = F.regexp_extract("object_key", r"season=(\d+)", 1).cast("int").alias("season")
    return inventory_diff(first, second).groupBy(season, "change").agg(F.count(F.lit(1)).alias("objects"))


@query(f"""
SELECT DISTINCT '{SOURCE}/endpoint=' || event_type || '/season=' || weekofyear(ts) || '/round=' ||
  lpad(day(ts)::VARCHAR, 2, '0') || '/batch_id={BATCH}/page_' || lpad(({_PAGE})::VARCHAR, 3, '0') || '.json' AS object_key
FROM events WHERE event_type = 'click' AND weekofyear(ts) = 3 ORDER BY 1 LIMIT 25""")
def listing(t: Tables) -> DataFrame:
    """The first names of one source and season, as an object store would list them."""
    names = _landed(t).select(F.col("_file_path").alias("object_key"))
    return bronze.list_keys(names, f"{SOURCE}/endpoint=click/season=3/", max_keys=25)


@query(f"""
SELECT weekofyear(ts) AS week, event_type, event_id FROM events WHERE weekofyear(ts) = 3""")
def partition_prune_read(t: Tables) -> DataFrame:
    """One season of a landed dataset; only its folder is listed and read."""
    base = scratch_path(t.spark, "bronze")
    bronze.land(_landed(t), base, RACE_EVENTS)
    pages = bronze.read_pages(t.spark, base, RACE_EVENTS, season=3)
    rows = silver_rows(judge_pages(pages, RACE_EVENTS), RACE_EVENTS)
    return rows.select(F.col("season").cast("int").alias("week"), "event_type", "event_id")


@query("""
SELECT event_id, CASE WHEN weekofyear(ts) = 2 THEN 'second' ELSE 'first' END AS batch FROM events
WHERE weekofyear(ts) IS NOT NULL""")
def force_overwrite(t: Tables) -> DataFrame:
    """Landing a season again replaces that season's pages and leaves the rest."""
    base = scratch_path(t.spark, "bronze")
    record = F.to_json(F.struct(F.col("event_id").alias("eventId"), F.lit("first").alias("batch")))
    again = F.to_json(F.struct(F.col("event_id").alias("eventId"), F.lit("second").alias("batch")))
    for text, rows in ((record, t.events), (again, t.events.where(F.weekofyear("ts") == 2))):
        pages = event_pages(rows, season=F.weekofyear("ts"), round_=F.dayofmonth("ts"), record=text)
        keyed = pages.withColumnsRenamed({"_p_season": "season", "_p_round": "round"})
        bronze.land(keyed, base, RACE_EVENTS, mode="overwrite")
    items = bronze.read_pages(t.spark, base, RACE_EVENTS).select(
        F.explode(F.from_json(F.get_json_object("value", "$.data.MRData.EventTable.Events"), "array<struct<eventId:long,batch:string>>")).alias("i")
    )
    return items.select(F.col("i.eventId").alias("event_id"), F.col("i.batch").alias("batch"))


@query("""
SELECT season, round, endpoint, page FROM (SELECT weekofyear(ts) AS season, day(ts) AS round,
    event_type AS endpoint, CAST(event_id % 50 + 1 AS INT) AS page, event_id % 3 = 0 AS landed FROM events)
GROUP BY season, round, endpoint, page HAVING NOT bool_or(landed) OR season = 5""")
def skip_existing(t: Tables) -> DataFrame:
    """Pages to fetch: those not landed yet, and all pages of the season being refreshed."""
    page = (F.col("event_id") % 50 + 1).cast("int").alias("page")
    item = [F.weekofyear("ts").alias("season"), F.dayofmonth("ts").alias("round"), F.col("event_type").alias("endpoint"), page]
    wanted = t.events.select(*item).distinct().withColumn("force_refresh", F.col("season") == 5)
    done = t.events.where("event_id % 3 = 0").select(*item)
    missing = still_missing(with_keys(wanted, F.lit(BATCH)), with_keys(done, F.lit(BATCH)))
    return missing.select("season", "round", "endpoint", "page")


@query("""
SELECT event_id, value, user_id FROM events WHERE event_type = 'click'
UNION ALL BY NAME SELECT event_id, value, NULL::BIGINT AS user_id FROM events WHERE event_type <> 'click'""")
def external_staging(t: Tables) -> DataFrame:
    """Files of two layouts, one without a column, read under one declared schema."""
    path = scratch_path(t.spark, "external")
    click = F.col("event_type") == "click"
    t.events.where(click).select("event_id", "value", "user_id").write.parquet(f"{path}/part=1")
    t.events.where(~click).select("event_id", "value").write.parquet(f"{path}/part=2")
    table = read_parquet_as(t.spark, path, "event_id long, user_id long, value double")
    return as_view(table.select("event_id", "value", "user_id"), "external_staging")


@query(f"""
SELECT event_id, event_type, value FROM events JOIN (SELECT event_type, page, {_FATES} AS verdict
    FROM {_VERDICTS.format(0.2)}) v USING (event_type)
WHERE v.page = {_PAGE} AND verdict = 'ok' AND NOT {IS_BAD}""")
def silver_run(t: Tables) -> DataFrame:
    """Good, bad and empty pages landed together; the run goes on and keeps the good ones."""
    base, silver = scratch_path(t.spark, "bronze"), scratch_path(t.spark, "silver")
    bronze.land(_mixed_pages(t), base, GLOBAL_EVENTS)
    failures = refine(t.spark, bronze.read_pages(t.spark, base, GLOBAL_EVENTS), silver, GLOBAL_EVENTS)
    if not failures:
        raise PagesRejectedError("the mixed pages hold bad ones")
    return read_silver(t.spark, silver, GLOBAL_EVENTS).select("event_id", "event_type", "value")


@query(f"""
SELECT 'global_events' AS endpoint, count(*) AS pages, count(*) FILTER (verdict <> 'ok') AS failed,
  count(*) FILTER (verdict = 'corrupt') AS corrupt, sum(total)::BIGINT AS records, sum(bad)::BIGINT AS bad_records,
  coalesce(sum(total - bad) FILTER (verdict = 'ok'), 0)::BIGINT AS rows_written,
  CASE WHEN corrupt > 0 THEN 'FAILED' WHEN failed > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
FROM (SELECT CASE WHEN page % 7 = 0 THEN 'invalid_json' WHEN page % 5 = 0 THEN 'corrupt' WHEN page % 4 = 0 THEN 'incomplete'
    ELSE verdict END AS verdict, CASE WHEN page % 7 * (page % 5) * (page % 4) = 0 THEN 0 ELSE total END AS total,
    CASE WHEN page % 7 * (page % 5) * (page % 4) = 0 THEN 0 ELSE bad END AS bad FROM {_VERDICTS.format(0.2)})""")
def run_metrics(t: Tables) -> DataFrame:
    """The counters a run takes while it writes, read from its table of runs."""
    base, silver = scratch_path(t.spark, "bronze"), scratch_path(t.spark, "silver")
    bronze.land(_mixed_pages(t), base, GLOBAL_EVENTS)
    try:
        run_silver(t.spark, base, silver, None, [GLOBAL_EVENTS], on_error="continue")
    except CorruptPagesError:
        pass  # noted in the table all the same
    return read_runs(t.spark, silver).select(
        "endpoint", "pages", "failed", "corrupt", "records", "bad_records", "rows_written", "status"
    )


def _replayed(t: Tables) -> DataFrame:
    """Events landed in three batches: the second lacks some days, the third some more, and all
    but the first repeat each record on a second page."""
    repeat = t.events.select(
        F.weekofyear("ts").alias("season"),
        F.dayofmonth("ts").alias("round"),
        "event_id",
        "value",
        F.explode(
            F.expr(
                "array_compact(array(struct('b1' AS batch_id, 1 AS page),"
                " if(day(ts) % 3 <> 0 AND event_id % 10 <> 0, struct('b2' AS batch_id, 1 AS page), null),"
                " if(day(ts) % 3 <> 0, struct('b2' AS batch_id, 2 AS page), null),"
                " if(day(ts) % 3 = 2 AND event_id % 4 <> 0, struct('b3' AS batch_id, 1 AS page), null)))"
            )
        ).alias("p"),
    )
    version = F.col("value") + F.when(F.col("p.batch_id") == "b3", 2).when(F.col("p.batch_id") == "b2", 1).otherwise(0)
    return repeat.select(
        "season", "round", "event_id", version.alias("value"), "p.batch_id", "p.page",
        F.lit(0).alias("_record_index"),
    )


_REPLAYED = """(SELECT weekofyear(ts) AS season, day(ts) AS round, event_id, value + b AS value, b, page FROM events,
    (VALUES (0, 1), (1, 1), (1, 2), (2, 1)) AS r(b, page)
    WHERE b = 0 OR (b = 1 AND day(ts) % 3 <> 0 AND (page = 2 OR event_id % 10 <> 0))
      OR (b = 2 AND day(ts) % 3 = 2 AND event_id % 4 <> 0))"""


@query(f"""
SELECT season, round, event_id, value, 'b' || (b + 1) AS batch_id, page FROM {_REPLAYED}
QUALIFY b = max(b) OVER (PARTITION BY season, round)""")
def latest_batch(t: Tables) -> DataFrame:
    return keep_latest_batches(_replayed(t), ["season", "round"]).drop("_record_index")


@query(f"""
SELECT season, round, event_id, value, 'b' || (b + 1) AS batch_id, page FROM {_REPLAYED} WHERE b < 2
QUALIFY b = max(b) OVER (PARTITION BY season, round)""")
def batch_rollback(t: Tables) -> DataFrame:
    """The newest batches as they stood before the last one."""
    return keep_latest_batches(_replayed(t), ["season", "round"], as_of_batch="b2").drop("_record_index")


@query(f"""
SELECT season, round, event_id, value, 'b' || (b + 1) AS batch_id, page FROM {_REPLAYED}
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY b DESC, page DESC) = 1""")
def dedupe_natural_key(t: Tables) -> DataFrame:
    order = ["batch_id", "page", "_record_index"]
    return latest_by_key(_replayed(t), ["event_id"], order).drop("_record_index")


@query(f"""
SELECT season, round, event_id, value FROM (SELECT * FROM {_REPLAYED}
  QUALIFY b = max(b) OVER (PARTITION BY season, round))
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY b DESC, page DESC) = 1""")
def consolidated(t: Tables) -> DataFrame:
    """Both steps, as the Silver run applies them."""
    return deduplicated(_replayed(t), RACE_EVENTS).select("season", "round", "event_id", "value")


@query("""
SELECT event_id::VARCHAR AS event_id, event_type, '20240131T000000' AS batch_id, '2024-01-31 00:00:00' AS ingested_at,
  'page_' || lpad((event_id // 500 + 1)::VARCHAR, 3, '0') || '.json' AS file_name
FROM events WHERE user_id % 5 <> 0""")
def staging_view(t: Tables) -> DataFrame:
    """Envelopes projected to text rows through a view; rows with an empty user are dropped."""
    blank = F.when(F.col("user_id") % 5 == 0, "").otherwise(F.col("user_id").cast("string"))
    record = F.to_json(F.struct(F.col("event_id").alias("eventId"), blank.alias("userId"), F.col("event_type").alias("eventType")))
    rows = staged(
        event_pages(t.events, record=record),
        ("EventTable", "Events"),
        {"event_id": "eventId", "user_id": "userId", "event_type": "eventType"},
        "user_id",
    )
    view = as_view(rows, "staging_events")
    return view.select(
        "event_id",
        "event_type",
        "batch_id",
        F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"),
        F.substring_index("file_path", "/", -1).alias("file_name"),
    )


@query("""SELECT event_id, event_type, value FROM events""")
def stream_incremental(t: Tables) -> DataFrame:
    """Two drops of files through a checkpointed stream; each file is taken in once."""
    source, sink, checkpoint = (scratch_path(t.spark, n) for n in ("drops", "taken", "progress"))
    columns = t.events.select("event_id", "event_type", "value")
    early = F.col("event_type") < "f"
    for drop in (columns.where(early), columns.where(~early)):
        drop.write.mode("append").parquet(source)
        drain(new_files(t.spark, source, columns.schema), checkpoint, append_to(sink))
    return t.spark.read.schema(columns.schema).parquet(sink).select(columns.columns)


def _versioned(t: Tables, batch: str, spec: Dataset, dirty: str = "false") -> DataFrame:
    """Clean pages of one batch, the value raised by one in the second; where ``dirty``, no user."""
    rows = t.events.withColumn("value", F.col("value") + (1 if batch == "b2" else 0))
    broken = F.to_json(F.struct(F.col("event_id").alias("eventId")))
    record = F.when(F.expr(dirty), broken).otherwise(event_record(False))
    places = {"season": F.weekofyear("ts"), "round_": F.dayofmonth("ts")} if spec.partitions else {}
    pages = event_pages(rows, record=record, batch=batch, **places)
    return pages.withColumnsRenamed({"_p_season": "season", "_p_round": "round"})


_CLICK_DAY = "bool_or(event_type = 'click') OVER (PARTITION BY weekofyear(ts), day(ts))"


@query(f"""
SELECT 'race_events' AS dataset, week AS season, day AS round, event_id, value + (batch_id = 'b2')::INT AS value, batch_id
FROM (SELECT weekofyear(ts)::BIGINT AS week, day(ts)::BIGINT AS day, event_id, value,
    CASE WHEN weekofyear(ts) = 4 AND {_CLICK_DAY} THEN 'b1' WHEN weekofyear(ts) >= 3 THEN 'b2' ELSE 'b1' END AS batch_id
  FROM events)
UNION ALL SELECT 'global_events', NULL, NULL, event_id, value, 'b1' FROM events""")
def season_run(t: Tables) -> DataFrame:
    """Two runs over a seasonal and a global dataset. The second batch lacks two seasons and has
    rejected pages in one season and in the global dataset: there the first batch stays."""
    base, silver = scratch_path(t.spark, "bronze"), scratch_path(t.spark, "silver")
    specs = [RACE_EVENTS, GLOBAL_EVENTS]
    for batch in ("b1", "b2"):
        for spec in specs:
            bad = "event_type = 'click' AND weekofyear(ts) = 4" if batch == "b2" else "false"
            pages = _versioned(t, batch, spec, bad)
            later = pages.where("season >= 3") if batch == "b2" and spec.partitions else pages
            bronze.land(later, base, spec)
        run_silver(t.spark, base, silver, None, specs, on_error="continue")
    # Running one season again touches nothing else.
    run_silver(t.spark, base, silver, 3, [RACE_EVENTS])
    both = [
        read_silver(t.spark, silver, spec)
        .withColumn("dataset", F.lit(spec.name))
        .withColumns({k: F.col(k) if k in spec.partitions else F.lit(None).cast("long") for k in ("season", "round")})
        .select("dataset", "season", "round", "event_id", "value", "batch_id")
        for spec in specs
    ]
    return both[0].unionByName(both[1])


@query("""
WITH s AS (SELECT DISTINCT weekofyear(ts) AS week FROM events WHERE ts IS NOT NULL),
r AS (SELECT week, CASE WHEN week = 5 THEN 'FAILED' WHEN week % 2 = 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status FROM s)
SELECT count(*) AS total_seasons, count(*) FILTER (status = 'SUCCESS') AS successful_seasons,
  count(*) FILTER (status = 'PARTIAL') AS partial_seasons, count(*) FILTER (status = 'FAILED') AS failed_seasons,
  coalesce(string_agg(week::VARCHAR, ',' ORDER BY week) FILTER (status = 'FAILED'), '') AS failed_season_list
FROM r""")
def backfill_run(t: Tables) -> DataFrame:
    """Seasons run one by one from landed pages: clean, with rejected pages, and with a page that
    reports records but holds none."""
    base, silver = scratch_path(t.spark, "bronze"), scratch_path(t.spark, "silver")
    pages = _versioned(t, "b1", RACE_EVENTS, "weekofyear(ts) % 2 = 0")
    lost = F.regexp_replace("value", r'"Events":\[.*\]', '"Events":[]')
    bronze.land(
        pages.withColumn("value", F.when(F.col("season") == 5, lost).otherwise(F.col("value"))), base, RACE_EVENTS
    )
    weeks = [r[0] for r in t.events.where("ts IS NOT NULL").select(F.weekofyear("ts")).distinct().collect()]
    runs = run_seasons(t.spark, base, silver, sorted(weeks), [RACE_EVENTS])
    return backfill_summary(runs).withColumn("failed_season_list", F.array_join("failed_season_list", ","))


@query(f"""
SELECT weekofyear(ts)::BIGINT AS season, day(ts)::BIGINT AS round, event_id, value + (weekofyear(ts) >= 3)::INT AS value,
  CASE WHEN weekofyear(ts) >= 3 THEN 'b2' ELSE 'b1' END AS batch_id FROM events""")
def stream_bronze(t: Tables) -> DataFrame:
    """Landed pages taken in by a stream in two drops, seasons and rounds from their folders."""
    base, silver, audit, progress = (scratch_path(t.spark, n) for n in ("bronze", "taken", "audit", "progress"))
    for batch in ("b1", "b2"):
        pages = _versioned(t, batch, RACE_EVENTS)
        bronze.land(pages.where("season >= 3") if batch == "b2" else pages, base, RACE_EVENTS)
        stream = new_pages(t.spark, bronze.dataset_path(base, RACE_EVENTS), RACE_EVENTS)
        drain(stream, progress, refine_into(silver, audit, RACE_EVENTS))
    return taken_in(t.spark, silver, RACE_EVENTS).select("season", "round", "event_id", "value", "batch_id")


_DROPS = "CASE WHEN weekofyear(ts) >= 3 THEN 'b2' WHEN weekofyear(ts) = 2 THEN 'b3' ELSE 'b1' END"


def _three_drops(t: Tables) -> tuple[str, str]:
    """Pages taken in by a stream in three drops, the second micro-batch being replayed."""
    base, silver, audit, progress, published = (
        scratch_path(t.spark, n) for n in ("bronze", "taken", "audit", "progress", "published")
    )
    handle = refine_into(silver, audit, RACE_EVENTS, published=published)

    def replayed(frame: DataFrame, batch: int) -> None:
        for _ in range(2 if batch == 1 else 1):
            handle(frame, batch)

    weeks = {"b1": "true", "b2": "season >= 3", "b3": "season = 2"}
    for batch, which in weeks.items():
        bronze.land(_versioned(t, batch, RACE_EVENTS).where(which), base, RACE_EVENTS)
        drain(new_pages(t.spark, bronze.dataset_path(base, RACE_EVENTS), RACE_EVENTS), progress, replayed)
    return published, audit


@query(f"""
SELECT weekofyear(ts)::BIGINT AS season, day(ts)::BIGINT AS round, event_id, value + (weekofyear(ts) >= 3)::INT AS value,
  {_DROPS} AS batch_id FROM events""")
def stream_published(t: Tables) -> DataFrame:
    """What three drops published, each only the partitions it touched."""
    published, _ = _three_drops(t)
    return read_silver(t.spark, published, RACE_EVENTS).select("season", "round", "event_id", "value", "batch_id")


@query(f"""
WITH p AS (SELECT weekofyear(ts) AS week, count(*) AS n FROM events GROUP BY weekofyear(ts), day(ts), event_type, {_PAGE})
SELECT micro_batch, count(*) AS pages, 0::BIGINT AS failed, sum(n)::BIGINT AS records
FROM p, (VALUES (0, 1, 60), (1, 3, 60), (2, 2, 2)) AS d(micro_batch, low, high) WHERE week BETWEEN low AND high GROUP BY micro_batch""")
def stream_progress(t: Tables) -> DataFrame:
    """Pages and records by the micro-batch that took their files in."""
    _, audit = _three_drops(t)
    return read_progress(t.spark, audit).groupBy(F.col("_batch").alias("micro_batch")).agg(
        *(F.sum(c).alias(c) for c in ("pages", "failed", "records"))
    )


@query("""
SELECT weekofyear(ts)::VARCHAR AS week, event_id, CASE WHEN event_type = 'click' THEN event_type END AS event_type,
  CASE WHEN event_type <> 'click' THEN user_id END AS user_id, value FROM events WHERE ts IS NOT NULL""")
def consolidated_layouts(t: Tables) -> DataFrame:
    """A table in two layouts, one of many small files, brought into one of few files."""
    one, two = scratch_path(t.spark, "layout"), scratch_path(t.spark, "layout")
    rows = t.events.where("ts IS NOT NULL").withColumn("week", F.weekofyear("ts"))
    click = F.col("event_type") == "click"
    small = rows.where(click).select("week", "event_id", "event_type", "value").repartition(16)
    small.write.partitionBy("week").parquet(one)
    rows.where(~click).select("week", "event_id", "user_id", "value").write.partitionBy("week").parquet(two)
    consolidate(t.spark, [one, two], one, ["week"], ["event_id"])
    if to_consolidate(t.spark, [one, two], ["week"]).head(1):
        raise RuntimeError("some partitions are still to be consolidated")
    return read_parquet_as(t.spark, one, "event_id long, event_type string, user_id long, value double, week string")


@query("""SELECT event_id, event_type, value FROM events""")
def single_pages(t: Tables) -> DataFrame:
    """Pages landed one to a file, packed; one of them lost the ending of its name."""
    base = scratch_path(t.spark, "bronze")
    bronze.land(_versioned(t, "b1", GLOBAL_EVENTS), base, GLOBAL_EVENTS, pages_per_file=1)
    some = bronze.read_pages(t.spark, base, GLOBAL_EVENTS, whole_files=True).select("_file_path").first()["_file_path"]
    rename(t.spark, some, some.removesuffix(".txt.gz") + ".json")
    # Counted while the files are read for the only time, as opening them is most of the work.
    seen = Observation()
    pages = read_single_pages(t.spark, base, GLOBAL_EVENTS).observe(
        seen,
        F.count_if(F.col("mislabelled")).alias("mislabelled"),
        F.count_if(F.col("body_verdict") != "ok").alias("lost"),
    )
    judged = written(judge_pages(pages.drop("codec", "body_verdict", "mislabelled"), GLOBAL_EVENTS), "judged")
    if seen.get["mislabelled"] != 1 or seen.get["lost"]:
        raise RuntimeError("every body can be unpacked, and one name is wrong")
    return silver_rows(judged, GLOBAL_EVENTS).select("event_id", "event_type", "value")


@query(f"""
SELECT year(o_orderdate)::VARCHAR AS season_year, 'u' || year(o_orderdate) AS season_url, '{BATCH}' AS batch_id,
  '2024-01-31 00:00:00' AS ingested_at FROM orders GROUP BY ALL""")
def season_staging(t: Tables) -> DataFrame:
    """The staging view of the season list, straight from landed pages, and kept as a table."""
    base = scratch_path(t.spark, "bronze")
    pages = seasons_pages(t)
    place = [F.col(c) for c in ("_p_season", "_p_round", "batch_id", "page")]
    value = bronze.envelope(F.lit("seasons"), *place, F.lit(INGESTED), F.lit(None), F.col("value"))
    keyed = pages.withColumn("value", value).withColumnsRenamed({"_p_season": "season", "_p_round": "round"})
    bronze.land(keyed, base, DATASETS["seasons"])
    view = as_view(season_view(bronze.read_pages(t.spark, base, DATASETS["seasons"])), "season_staging")
    path = scratch_path(t.spark, "staging")
    table = as_table(view, f"season_staging_{path.rsplit('-', 1)[-1]}", path)
    return table.select(
        "season_year", "season_url", "batch_id", F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested_at")
    )
