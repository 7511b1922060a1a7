"""Landing, reading, the Silver run over all datasets, and streaming intake."""

import gzip
import hashlib
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SMALL

from oracle import connect_to, difference
from smeltery.catalog.registry import QUERIES
from smeltery.functions.keys import object_key, page_count, parquet_key
from smeltery.operators.audit import run_status
from smeltery.operators.quality import CorruptPagesError, reconcile, page_payloads
from smeltery.plans.side_by_side import side_by_side
from smeltery.plans.silver_run import PagesRejectedError, read_runs, run_seasons, run_silver
from smeltery.plans.worklist import round_worklist, season_range, still_missing, with_keys, with_pages
from smeltery.session import scratch_path
from smeltery.sources.bronze import envelope, land, manifest, read_pages
from smeltery.sources.consolidate import consolidate, to_consolidate
from smeltery.sources.inventory import existing, inventory_diff, landed_files, object_inventory
from smeltery.sources.registry import DATASETS
from smeltery.sources.silver import read_silver
from smeltery.sources.single_pages import read_single_pages
from smeltery.sources.tables import as_table, remove, written
from smeltery.streaming.intake import drain, new_pages, read_progress, refine_into, taken_in
from test_pages import DRIVER, SIMPLE, TEAM, drivers

CIRCUIT = {"circuitId": "spa", "circuitName": "Spa", "url": "u", "Location": {"lat": "50.4", "long": "5.9", "locality": "Spa", "country": "belgium"}}
RESULT = {"number": "1", "position": "1", "points": "25", "grid": "1", "laps": "44", "Driver": DRIVER, "Constructor": TEAM, "status": "Finished"}
PAYLOADS = {
    "seasons": ("SeasonTable", "Seasons", [{"season": "2024", "url": "u"}]),
    "circuits": ("CircuitTable", "Circuits", [CIRCUIT]),
    "status": ("StatusTable", "Status", [{"statusId": "1", "status": "Finished", "count": "9"}]),
    "drivers": ("DriverTable", "Drivers", [DRIVER]),
    "constructors": ("ConstructorTable", "Constructors", [TEAM]),
    "races": ("RaceTable", "Races", [{"season": "2024", "round": "5", "url": "u", "raceName": "GP", "Circuit": CIRCUIT, "date": "2024-05-01"}]),
    "results": ("RaceTable", "Races", "Results", [RESULT]),
    "qualifying": ("RaceTable", "Races", "QualifyingResults", [{"number": "1", "position": "1", "Driver": DRIVER, "Constructor": TEAM, "Q1": "1:20.1"}]),
    "sprint": ("RaceTable", "Races", "SprintResults", [RESULT]),
    "pitstops": ("RaceTable", "Races", "PitStops", [{"driverId": "ada", "lap": "9", "stop": "1", "time": "15:02:11", "duration": "23.456"}]),
    "laps": ("RaceTable", "Races", "Laps", [{"number": "1", "Timings": [{"driverId": "ada", "position": "1", "time": "1:21.3"}]}]),
    "driverstandings": ("StandingsTable", "StandingsLists", "DriverStandings", [{"position": "1", "points": "25", "wins": "1", "Driver": DRIVER, "Constructors": [TEAM]}]),
    "constructorstandings": ("StandingsTable", "StandingsLists", "ConstructorStandings", [{"position": "1", "points": "25", "wins": "1", "Constructor": TEAM}]),
}


def body(name, records=None):
    table, outer, *inner, default = PAYLOADS[name]
    records = default if records is None else records
    inside = [{"season": "2024", "round": "5", inner[0]: records}] if inner else records
    return {"MRData": {"total": str(len(records)), table: {outer: inside}}}


def write_page(base, name, batch, document, page=1, file=None, raw=None, season=2024):
    """One page per gzip file, the way a per-page landing leaves it."""
    spec = DATASETS[name]
    parts = [f"endpoint={name}"]
    parts += [f"season={season}"] * spec.has_season + ["round=05"] * spec.has_round + [f"batch_id={batch}"]
    folder = Path(base, "ergast", *parts)
    folder.mkdir(parents=True, exist_ok=True)
    metadata = {"batch_id": batch, "endpoint": name, "page": page, "ingestion_timestamp": "2024-05-02T00:00:00Z"}
    content = raw or json.dumps({"metadata": metadata, "data": document}, indent=1)
    with gzip.open(folder / (file or f"page_{page:03d}.json.gz"), "wt") as out:
        out.write(content)


def test_run_over_all_datasets_twice(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for name in PAYLOADS:
        write_page(bronze, name, "20240501", body(name))
    for _ in range(2):
        run = run_silver(spark, bronze, silver, season=2024, whole_files=True)
        assert set(run.failures) == set(DATASETS) and not any(run.failures.values())
        assert all(read_silver(spark, silver, spec).count() == 1 for spec in DATASETS.values())
    row = read_silver(spark, silver, DATASETS["results"]).first()
    assert (row.season, row.round, row.batch_id, row.points) == (2024, 5, "20240501", 25.0)


def test_latest_batch_and_natural_key_win(spark, tmp_path):
    bronze, silver = str(tmp_path / "b"), str(tmp_path / "s")
    other = {**RESULT, "Driver": {**DRIVER, "driverId": "lewis"}}
    write_page(bronze, "results", "1", body("results", [RESULT, other]))
    write_page(bronze, "results", "2", body("results", [RESULT]))
    write_page(bronze, "results", "2", body("results", [{**RESULT, "points": "26"}]), page=2)
    run_silver(spark, bronze, silver, 2024, ["results"], whole_files=True)
    rows = read_silver(spark, silver, DATASETS["results"]).collect()
    assert [(r.driver_driver_id, r.points) for r in rows] == [("ada", 26.0)]


def test_bad_pages_fail_the_run_after_the_good_are_written(spark, tmp_path):
    bronze, silver = str(tmp_path / "b"), str(tmp_path / "s")
    write_page(bronze, "seasons", "1", body("seasons"))
    write_page(bronze, "seasons", "1", None, page=2, raw="invalid json")
    write_page(bronze, "seasons", "1", body("seasons", [{"season": "x", "url": "u"}]), page=3)
    with pytest.raises(PagesRejectedError):
        run_silver(spark, bronze, silver, 2024, ["seasons"], whole_files=True)
    assert read_silver(spark, silver, DATASETS["seasons"]).count() == 1
    run = run_silver(spark, bronze, silver, 2024, ["seasons", "status"], on_error="continue", whole_files=True)
    assert run.failures == {"seasons": 2} and run.skipped == ["status"]
    verdicts = {r.page: r.verdict for r in run.verdicts(spark).collect()}
    assert verdicts == {1: "ok", 2: "invalid_json", 3: "rejected"}


CIRCUIT = {"circuitId": "loop", "circuitName": "Loop", "url": "u", "Location": {"lat": "1", "long": "2", "locality": "x", "country": "y"}}
BROKEN = {"driverId": "?"}


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "b"), str(tmp_path / "s")


def test_seasons_keep_their_own_rows(spark, places):
    for season in (2022, 2023, 2024):
        write_page(places[0], "circuits", "1", body("circuits", [CIRCUIT]), season=season)
    run_silver(spark, *places, None, ["circuits"], whole_files=True)
    rows = read_silver(spark, places[1], DATASETS["circuits"]).collect()
    assert sorted(r.season for r in rows) == [2022, 2023, 2024]


def test_shared_drives_keep_both_results(spark, places):
    shared = [RESULT, {**RESULT, "number": "8", "position": "4"}, {**RESULT, "number": "8", "position": "4"}]
    write_page(places[0], "results", "1", body("results", shared))
    run_silver(spark, *places, 2024, ["results"], whole_files=True)
    assert sorted(r.number for r in read_silver(spark, places[1], DATASETS["results"]).collect()) == [1, 8]


def test_rejected_pages_do_not_replace_good_rows(spark, places):
    write_page(places[0], "seasons", "1", body("seasons"))
    write_page(places[0], "results", "1", body("results", [RESULT, {**RESULT, "Driver": {**DRIVER, "driverId": "bob"}}]))
    run_silver(spark, *places, 2024, ["seasons", "results"], whole_files=True)
    write_page(places[0], "seasons", "2", None, raw="no json")
    write_page(places[0], "results", "2", body("results"))
    write_page(places[0], "results", "2", body("results", [BROKEN]), page=2)
    run = run_silver(spark, *places, 2024, ["seasons", "results"], on_error="continue", whole_files=True)
    assert run.failures == {"seasons": 1, "results": 1}
    assert read_silver(spark, places[1], DATASETS["seasons"]).count() == 1
    rows = read_silver(spark, places[1], DATASETS["results"]).collect()
    assert [r.batch_id for r in rows] == ["1", "1"]


def test_a_batch_that_lacks_pages_does_not_replace_a_whole_one(spark, places):
    many = [{**RESULT, "number": str(i)} for i in range(3)]
    write_page(places[0], "results", "1", body("results", many))
    part = body("results", many[:1])
    part["MRData"] |= {"total": "3", "limit": "1"}
    write_page(places[0], "results", "2", part, page=2)
    run_silver(spark, *places, 2024, ["results"], whole_files=True)
    assert read_silver(spark, places[1], DATASETS["results"]).count() == 3


def test_runs_are_counted_as_they_are_written(spark, places):
    """Counters equal a recount of what was landed and written; a dataset without rows counts none."""
    write_page(places[0], "results", "1", body("results", [RESULT, {**RESULT, "Driver": {**DRIVER, "driverId": "bob"}}]))
    write_page(places[0], "results", "1", body("results", [RESULT] * 9 + [BROKEN]), page=2)
    write_page(places[0], "results", "1", body("results", [BROKEN]), page=3)
    write_page(places[0], "drivers", "1", body("drivers", []))
    write_page(places[0], "seasons", "1", None, raw="no json")
    names = ["results", "drivers", "seasons", "laps"]
    run = run_silver(spark, *places, 2024, names, on_error="continue", whole_files=True)
    assert run.skipped == ["laps"] and run.failures == {"results": 1, "drivers": 0, "seasons": 1}
    rows = {r["endpoint"]: r.asDict() for r in read_runs(spark, places[1]).collect()}
    size = sum(len(gzip.open(p).read()) for p in Path(places[0]).rglob("endpoint=results/**/*.gz"))
    expected = {"pages": 3, "failed": 1, "corrupt": 0, "empty": 0, "records": 13, "bad_records": 2, "bytes_read": size}
    assert expected.items() <= rows["results"].items()
    assert rows["results"]["rows_written"] == read_silver(spark, places[1], DATASETS["results"]).count() == 2
    assert (rows["drivers"]["empty"], rows["drivers"]["rows_written"], rows["drivers"]["status"]) == (1, 0, "SUCCESS")
    assert (rows["seasons"]["failed"], rows["seasons"]["rows_written"], rows["seasons"]["status"]) == (1, 0, "PARTIAL")
    assert run.counts["results"].records == 13
    run_silver(spark, *places, 2024, ["results"], on_error="continue", whole_files=True)
    assert sorted((r["commit"], r["endpoint"]) for r in read_runs(spark, places[1]).collect())[-1] == (2, "results")


def test_seasons_of_one_scan_are_told_apart(spark, places):
    for season, document in ((2022, body("drivers")), (2023, body("drivers", [BROKEN])), (2024, body("drivers"))):
        write_page(places[0], "drivers", "1", document, season=season)
    lost = body("circuits", [])
    lost["MRData"]["total"] = "5"
    write_page(places[0], "circuits", "1", lost, season=2024)
    runs = run_seasons(spark, *places, [2024, 2022, 2023, 2021], ["drivers", "circuits"], whole_files=True)
    assert [tuple(r) for r in runs.collect()] == [(2024, "FAILED", 1), (2022, "SUCCESS", 0), (2023, "PARTIAL", 1), (2021, "SUCCESS", 0)]
    assert sorted(r.season for r in read_silver(spark, places[1], DATASETS["drivers"]).collect()) == [2022, 2024]
    # Pages of a dataset without seasons count for each.
    write_page(places[0], "seasons", "1", None, raw="no json")
    runs = run_seasons(spark, *places, [2022, 2023], ["drivers", "seasons"], whole_files=True)
    assert [tuple(r) for r in runs.collect()] == [(2022, "PARTIAL", 1), (2023, "PARTIAL", 2)]


def test_jobs_side_by_side_all_end(spark):
    ended = []

    def job(n):
        if n == 1:
            raise RuntimeError("one")
        ended.append(spark.range(n).count())
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    with pytest.raises(RuntimeError, match="one"):
        side_by_side(spark, {str(n): lambda n=n: job(n) for n in range(4)})
    assert sorted(ended) == [0, 2, 3]
    assert side_by_side(spark, {"a": lambda: job(5), "b": lambda: job(6)}) == {"a": "a", "b": "b"}
    assert side_by_side(spark, {"a": lambda: job(5), "b": lambda: job(6)}, pool="p") == {"a": "p", "b": "p"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_audit_tables_keep_earlier_seasons(spark, places):
    for season in (2023, 2024):
        write_page(places[0], "drivers", "1", body("drivers"), season=season)
        run = run_silver(spark, *places, season, ["drivers"], whole_files=True)
    assert sorted(r.season for r in run.verdicts(spark).collect()) == [2023, 2024]


@pytest.mark.parametrize("mode", ["fail", "continue"])
def test_pages_without_their_records_always_fail(spark, places, mode):
    lost = body("drivers", [])
    lost["MRData"]["total"] = "50"
    write_page(places[0], "drivers", "1", lost)
    with pytest.raises(CorruptPagesError):
        run_silver(spark, *places, 2024, ["drivers"], on_error=mode, whole_files=True)
    runs = run_seasons(spark, *places, [2024], ["drivers"], whole_files=True)
    assert [tuple(r) for r in runs.collect()] == [(2024, "FAILED", 1)]


def test_single_page_files_and_path_keys_stay_text(spark, tmp_path):
    write_page(tmp_path, "results", "007", body("results"), file="data.json.gz", page=1)
    row = read_pages(spark, str(tmp_path), DATASETS["results"], season=2024, whole_files=True).first()
    assert (row._p_season, row._p_round, row.batch_id, row.page) == (2024, 5, "007", 1)


def landing(spark, base, points, batch="b1", mode="append"):
    text = json.dumps(body("results", [{**RESULT, "points": points}]), indent=2)
    frame = spark.createDataFrame([(2024, 5, batch, 1, text)], "season int, round int, batch_id string, page int, body string")
    value = envelope(
        F.lit("results"), F.col("season"), F.col("round"), F.col("batch_id"), F.col("page"), F.lit("2024-05-01T00:00:00Z"), F.lit(1), F.col("body")
    )
    land(frame.withColumn("value", value), base, DATASETS["results"], mode)


def test_land_read_manifest_and_checksums(spark, tmp_path):
    base, spec = str(tmp_path), DATASETS["results"]
    landing(spark, base, "25")
    first = spark.createDataFrame(manifest(read_pages(spark, base, spec), spec).collect())
    row = first.first()
    assert row.object_key == "ergast/endpoint=results/season=2024/round=05/batch_id=b1/page_001.json"
    assert row.api_response_total == 1 and row._file_path.endswith(".txt.gz")
    landing(spark, base, "26", mode="overwrite")
    again = manifest(read_pages(spark, base, spec), spec)
    assert again.count() == 1
    assert [r["change"] for r in inventory_diff(first, again).collect()] == ["altered"]
    assert landed_files(spark, base, spec).count() == 1


def test_inventories_differ_by_object(spark, tmp_path):
    base, spec = str(tmp_path), DATASETS["drivers"]
    for season in (2021, 2022, 2023):
        write_page(base, "drivers", "1", body("drivers"), season=season)
    first = written(object_inventory(spark, base, spec, whole_files=True), "first")
    one = first.where(F.col("object_key").contains("season=2022")).first()
    assert one["etag"] == hashlib.md5(one_page(base, 2022)).hexdigest() and one["size"] == len(one_page(base, 2022))
    assert one["tags"]["batch_id"] == "1" and one["tags"]["season"] == "2022" and "round" not in one["tags"]
    # One page altered, one lost, one new; the rest keeps its rows without being read.
    write_page(base, "drivers", "1", body("drivers", [{**DRIVER, "driverId": "bob"}]), season=2021)
    remove(spark, f"{base}/ergast/endpoint=drivers/season=2022")
    write_page(base, "drivers", "2", body("drivers"), season=2024)
    again = written(object_inventory(spark, base, spec, known=first, whole_files=True), "again")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, object_inventory(spark, base, spec, whole_files=True).collect()), key=str)
    changes = {re.search(r"season=(\d+)", r["object_key"])[1]: r for r in inventory_diff(first, again).collect()}
    assert {k: r["change"] for k, r in changes.items()} == {"2021": "altered", "2022": "lost", "2023": "same", "2024": "added"}
    assert changes["2022"]["size_after"] is None and changes["2024"]["size_before"] is None
    assert object_inventory(spark, base, spec, known=again, whole_files=True).count() == 3
    asked = spark.createDataFrame([(one["object_key"],), (changes["2023"]["object_key"],)], "object_key string")
    assert {r["object_key"]: r["exists"] for r in existing(again, asked).collect()} == {one["object_key"]: False, changes["2023"]["object_key"]: True}


def one_page(base, season):
    (path,) = Path(base).rglob(f"season={season}/**/*.gz")
    return gzip.open(path).read()


def test_keys(spark):
    frame = spark.createDataFrame([(2024, 1, 1), (None, None, 12)], "season int, round int, page int")
    key = object_key("ergast", F.lit("laps"), F.lit("b"), F.col("season"), F.col("round"), F.col("page"))
    assert [r.k for r in frame.select(parquet_key(key).alias("k")).collect()] == [
        "ergast/endpoint=laps/season=2024/round=01/batch_id=b/page_001.parquet",
        "ergast/endpoint=laps/batch_id=b/page_012.parquet",
    ]


@pytest.mark.parametrize(("total", "limit", "pages"), [(25, 10, 3), (50, 10, 5), (0, 100, 1), (100, 100, 1), (101, 100, 2)])
def test_page_counts(spark, total, limit, pages):
    frame = spark.createDataFrame([(total, True), (total, False)], "total int, paginated boolean")
    counts = with_pages(frame, limit).groupBy("paginated").count().collect()
    assert {r.paginated: r["count"] for r in counts} == {True: pages, False: 1}
    assert spark.range(1).select(page_count(F.lit(total), limit).alias("n")).first().n == pages


def test_season_range(spark):
    rows = season_range(spark, "2024-03-01", 2022, 2024).collect()
    assert [(r.season, r.force_refresh) for r in rows] == [(2022, False), (2023, False), (2024, True)]
    assert season_range(spark, "2024-03-01").count() == 2023 - 1950 + 1
    with pytest.raises(ValueError, match="after end"):
        season_range(spark, "2024-03-01", 2025, 2024)


def test_sprint_only_where_held(spark):
    rounds = spark.createDataFrame([(2024, 1, False), (2024, 2, True)], "season int, round int, has_sprint boolean")
    work = round_worklist(rounds).collect()
    assert {r.round for r in work if r.endpoint == "sprint"} == {2}
    assert {r.request_path for r in work if r.endpoint == "driverstandings"} == {"2024/1/driverStandings.json", "2024/2/driverStandings.json"}
    assert round_worklist(rounds.limit(0)).count() == 0


def test_landed_pages_are_skipped_unless_forced(spark):
    pages = spark.createDataFrame([("laps", 2024, 1, p, p == 3) for p in (1, 2, 3)], "endpoint string, season int, round int, page int, force_refresh boolean")
    keyed = with_keys(pages, F.lit("b"))
    left = still_missing(keyed, keyed.where("page <> 2").select("object_key"))
    assert sorted(r.page for r in left.collect()) == [2, 3]


def test_reconcile_finds_missing_pages(spark):
    docs = [("a", 1, 3, 2), ("a", 2, 3, 1), ("b", 1, 3, 2)]
    rows = []
    for item, page, total, n in docs:
        doc = drivers(*[{"driverId": "x", "nationality": "y"}] * n)
        doc["MRData"]["total"] = str(total)
        rows.append((item, page, json.dumps(doc)))
    payloads = page_payloads(spark.createDataFrame(rows, "item string, page int, value string"), SIMPLE)
    found = reconcile(payloads, ["item"], limit=2).collect()
    assert [(r.item, r.items, r.pages, r.expected_pages) for r in found] == [("b", 2, 1, 2)]


def test_stream_refines_each_page_once(spark, tmp_path):
    source, silver, verdicts, progress = (str(tmp_path / n) for n in ("in", "silver", "verdicts", "progress"))
    spec = DATASETS["seasons"]
    for year in (2023, 2024):
        text = json.dumps(body("seasons", [{"season": str(year), "url": "u"}]))
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(source)
        drain(new_pages(spark, source, spec, "b"), progress, refine_into(silver, verdicts, spec))
    assert sorted(r.season for r in spark.read.parquet(silver).collect()) == [2023, 2024]
    assert spark.read.parquet(f"{verdicts}/verdicts").count() == 2
    assert taken_in(spark, silver, spec).count() == 2


def test_table_is_replaced(spark, tmp_path):
    for n in (3, 2):
        assert as_table(spark.range(n), "kept", str(tmp_path / "kept")).count() == n


def test_run_statuses(spark):
    frame = spark.createDataFrame([(0, False), (2, False), (0, True)], "errors int, raised boolean")
    shown = frame.select(run_status(F.col("errors"), F.col("raised")).alias("s")).collect()
    assert [r.s for r in shown] == ["SUCCESS", "PARTIAL", "FAILED"]


def test_scratch_follows_the_session():
    class Session:
        conf = {"spark.checkpoint.dir": "hdfs://shared/tmp/"}

        class sparkContext:  # noqa: N801
            master = "yarn"

    assert scratch_path(Session, "x").startswith("hdfs://shared/tmp/x-")
    assert scratch_path(Session, "x") != scratch_path(Session, "x")
    Session.conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session, "x")


@pytest.mark.parametrize("name", ["backfill_run"])
def test_runs_over_ten_weeks_match_their_sql(spark, tmp_path, name):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    later = events.withColumn("ts", F.expr("ts + make_interval(0, 0, cast(event_id % 10 as int))"))
    spread = later.where("weekofyear(ts) <= 10")
    spread.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    assert spread.select(F.weekofyear("ts")).distinct().count() == 10
    con = connect_to({"events": f"{tmp_path}/events.parquet/*.parquet"})
    assert difference(QUERIES[name].run(spark, str(tmp_path)), con, QUERIES[name].sql) == ""


def partition_files(path):
    found = {}
    for p in Path(path).rglob("*.parquet"):
        found.setdefault("/".join(x for x in p.parts if "=" in x), []).append(p)
    return found


def test_consolidation_writes_what_needs_it(spark, tmp_path):
    one, two = f"{tmp_path}/one", f"{tmp_path}/two"
    rows = spark.range(3000).selectExpr("id", "id * 2 AS a", "lpad(id % 3, 2, '0') AS k", "'x' AS j")
    rows.where("k = '00'").coalesce(1).write.partitionBy("k", "j").parquet(one)
    rows.where("k = '01'").repartition(7).write.mode("append").partitionBy("k", "j").parquet(one)
    rows.where("k = '02'").selectExpr("id", "-id AS b", "k", "j").repartition(3).write.partitionBy("k", "j").parquet(two)
    rows.where("k = '01'").limit(5).selectExpr("id + 9000 AS id", "1L AS b", "k", "j").write.mode("append").partitionBy("k", "j").parquet(two)
    before = partition_files(one)["k=00/j=x"]
    done = {(r["k"], r["files"], r["wanted"]) for r in consolidate(spark, [one, two], one, ["k", "j"], ["id"]).collect()}
    assert done == {("01", 8, 1), ("02", 3, 1)}
    files = partition_files(one)
    assert {k: len(v) for k, v in files.items()} == {"k=00/j=x": 1, "k=01/j=x": 1, "k=02/j=x": 1}
    assert files["k=00/j=x"] == before and not partition_files(two)
    back = spark.read.schema("id long, a long, b long, k string, j string").parquet(one)
    assert back.count() == 3005 and back.where("k = '02' AND a IS NULL AND b = -id").count() == 1000
    assert back.where("k = '01' AND b = 1").count() == 5
    assert to_consolidate(spark, [one, two], ["k", "j"]).count() == 0
    # A small size calls for more files; a partition of any size is split.
    consolidate(spark, [one], f"{tmp_path}/three", ["k", "j"], file_bytes=1000)
    assert all(len(v) > 1 for v in partition_files(f"{tmp_path}/three").values())
    assert spark.read.option("mergeSchema", "true").parquet(f"{tmp_path}/three").count() == 3005
    with pytest.raises(ValueError):
        to_consolidate(spark, [f"{tmp_path}/none"], ["k"])


def test_bodies_are_told_apart_by_their_bytes(spark, tmp_path):
    base, spec = str(tmp_path), DATASETS["drivers"]
    folder = Path(base, "ergast", "endpoint=drivers", "season=2024", "batch_id=007")
    folder.mkdir(parents=True)
    text = json.dumps({"metadata": {"page": 9}, "data": body("drivers")})
    bodies = {
        "page_001.json": text.encode(), "page_002.json": gzip.compress(text.encode()), "page_003.json.gz": gzip.compress(text.encode()),
        "page_004.json.gz": text.encode(), "page_005.json": gzip.compress(text.encode())[:-9], "page_006.json": b"\xff\xfe",
        "data.json": text.encode(), "page_008.json": b"", "page_010.json": gzip.compress("é".encode()) + b"rest",
    }
    for name, content in bodies.items():
        (folder / name).write_bytes(content)
    found = {r["page"]: r for r in read_single_pages(spark, base, spec, 2024).collect()}
    assert {p: (r["codec"], r["body_verdict"], r["mislabelled"]) for p, r in found.items()} == {
        1: ("plain", "ok", False), 2: ("gzip", "ok", True), 3: ("gzip", "ok", False), 4: ("plain", "ok", True),
        5: ("gzip", "bad_gzip", True), 6: ("plain", "not_text", False), 9: ("plain", "ok", False),
        10: ("gzip", "bad_gzip", True),
    }
    assert all(found[p]["value"] == text for p in (1, 2, 3, 4, 9))
    assert found[5]["value"] is None and found[6]["value"] is None
    assert {(r["_p_season"], r["_p_round"], r["batch_id"]) for r in found.values()} == {(2024, None, "007")}


def test_a_stream_publishes_what_it_touched(spark, tmp_path):
    base, spec = str(tmp_path / "b"), DATASETS["circuits"]
    silver, audit, progress, published = (str(tmp_path / n) for n in ("s", "a", "p", "out"))
    handle = refine_into(silver, audit, spec, published=published)

    def drop(season, batch, place):
        # On one line, as a stream reads text by lines.
        document = {"metadata": {"batch_id": batch, "page": 1}, "data": body("circuits", [{**CIRCUIT, "circuitName": place}])}
        write_page(base, "circuits", batch, None, raw=json.dumps(document), season=season)
        drain(new_pages(spark, str(Path(base, "ergast", "endpoint=circuits")), spec), progress, handle)
        return {str(p): p.stat().st_mtime_ns for p in Path(published).rglob("*.parquet")}

    first, second, third = drop(2023, "1", "Old"), drop(2024, "1", "Spa"), drop(2024, "2", "Spa II")
    assert first.items() <= second.items()
    assert {p for p in third if p in second} == {p for p in second if "season=2023" in p}
    rows = sorted((r["season"], r["name"], r["batch_id"]) for r in read_silver(spark, published, spec).collect())
    assert rows == [(2023, "Old", "1"), (2024, "Spa II", "2")]
    went = sorted((r["_batch"], r["pages"], r["failed"], r["records"]) for r in read_progress(spark, audit).collect())
    assert went == [(0, 1, 0, 1), (1, 1, 0, 1), (2, 1, 0, 1)]
    assert read_progress(spark, audit).select("file_path").distinct().count() == 3
