"""Gold built whole from Silver, refreshed by changed partitions, and stored in buckets."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from smeltery.catalog import QUERIES
from smeltery.plans import gold
from smeltery.plans.gold_run import SOURCES, build_gold
from smeltery.plans.silver_run import run_silver
from smeltery.sources.registry import DATASETS
from test_layers import DRIVER, PAYLOADS, RESULT, body, write_page

DOCUMENTED = {
    "dim_drivers": "driver_id name nationality dob valid_from valid_to",
    "dim_constructors": "constructor_id name nationality valid_from valid_to",
    "dim_circuits": "circuit_id name location country lat lng valid_from valid_to",
    "dim_seasons": "season_id year url",
    "dim_status": "status_id status description",
    "fact_race_results": "result_id season round driver_id constructor_id circuit_id grid_position final_position points"
    " laps_completed status_id fastest_lap_time fastest_lap_rank",
    "fact_qualifying_results": "qualifying_id season round driver_id constructor_id q1_time q2_time q3_time final_position",
    "fact_lap_times": "lap_id season round driver_id lap_number lap_time_ms",
    "fact_pit_stops": "pitstop_id season round driver_id lap stop_number duration_ms",
    "agg_driver_season_stats": "season driver_id total_points races wins podiums poles",
    "agg_constructor_season_stats": "season constructor_id total_points races wins podiums",
    "agg_fastest_laps_by_circuit": "circuit_id driver_id fastest_time season round",
}


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("whole")
    bronze, silver = str(base / "bronze"), str(base / "silver")
    for name in PAYLOADS:
        records = [{**RESULT, "FastestLap": {"rank": "1", "lap": "9", "Time": {"time": "1:20.5"}}}] if name == "results" else None
        write_page(bronze, name, "1", body(name, records))
    run_silver(spark, bronze, silver, 2024, whole_files=True)
    return bronze, silver, str(base / "gold")


def test_every_documented_table_is_built(spark, places):
    built = build_gold(spark, *places[1:])
    assert set(DOCUMENTED) <= set(built) == set(SOURCES)
    for name, columns in DOCUMENTED.items():
        assert set(columns.split()) <= set(built[name].columns), name
        assert built[name].count() == 1, name
        assert spark.read.parquet(f"{places[2]}/{name}").count() == 1
    driver = built["agg_driver_season_stats"].first()
    assert (float(driver["total_points"]), driver["races"], driver["wins"], driver["poles"]) == (50.0, 1, 1, 1)  # with the sprint
    assert built["dim_drivers"].first()["valid_from"] == 2024 and built["dim_drivers"].first()["valid_to"] is None
    assert built["fact_lap_times"].first()["lap_time_ms"] == 81300
    assert built["agg_fastest_laps_by_circuit"].first()["fastest_time"] == 80500
    assert built["fact_pit_stops"].first()["duration_ms"] == 23456


def test_versions_of_dimensions_across_seasons(spark, tmp_path):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    for season, name in ((2022, "Ada"), (2023, "Ada"), (2024, "Adele")):
        write_page(bronze, "drivers", "1", body("drivers", [{**DRIVER, "givenName": name}]), season=season)
    run_silver(spark, bronze, silver, None, ["drivers"], whole_files=True)
    built = build_gold(spark, silver, f"{tmp_path}/gold")
    assert set(built) == {"dim_drivers"}
    versions = sorted((r["valid_from"], r["valid_to"], r["name"].split()[0]) for r in built["dim_drivers"].collect())
    assert versions == [(2022, 2024, "Ada"), (2024, None, "Adele")]
    with pytest.raises(ValueError, match="fact_lap_times"):
        build_gold(spark, silver, f"{tmp_path}/gold", ["fact_lap_times"])


def test_only_changed_partitions_of_a_fact_are_read(spark, tmp_path):
    fact, path = f"{tmp_path}/fact", f"{tmp_path}/agg"
    rows = spark.range(400).select((F.col("id") % 4 + 2020).alias("season"), (F.col("id") % 10).alias("round"), F.col("id").alias("driver_id"))
    gold.write_fact(rows, fact, ["driver_id"])
    daily = lambda f: f.groupBy("season", "round").agg(F.count("*").alias("n"))
    stored = spark.read.schema(rows.schema).parquet(fact)
    daily(stored).write.partitionBy("season", "round").parquet(path)
    before = {p: os.stat(p).st_mtime_ns for p in map(str, tmp_path.glob("agg/**/*.parquet"))}
    changed = spark.createDataFrame([(2020, 2), (2021, 3), (2099, 1)], "season long, round long")
    spark.createDataFrame([(2099, 1, 5)], "season long, round long, n long").write.mode("append").partitionBy("season", "round").parquet(path)
    gold.refresh_aggregate(stored, changed, ["season", "round"], daily, path)
    after = {p: os.stat(p).st_mtime_ns for p in map(str, tmp_path.glob("agg/**/*.parquet"))}
    assert not [p for p in after if "season=2099" in p]  # its rows are gone
    stays = {p for p in before if "season=2020/round=2/" not in p and "season=2021/round=3/" not in p}
    assert all(after[p] == before[p] for p in stays) and len(after) == len(before)
    assert len(set(after) - set(before)) == 2
    # The plan prunes the fact by the changed keys, and opens only their files.
    marked = changed.withColumn("_changed", F.lit(1))
    marked.write.parquet(f"{tmp_path}/changed")
    kept = spark.read.parquet(f"{tmp_path}/changed").where("_changed > 0").select("season", "round")
    touched = daily(stored.join(kept, ["season", "round"], "left_semi"))
    plan = touched._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    touched.collect()
    # Seasons and rounds prune apart from each other: of 20 files the changed two, and 2021's first round.
    assert files_opened(touched, fact) == 3


def files_opened(frame, path):
    """How many files of a path the scans of an executed plan opened."""
    scans, waiting = [], [frame._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "FileSourceScanExec":
            scans.append(node)
        elif kind == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            waiting.append(node.plan())
        else:
            waiting += [node.children().apply(i) for i in range(node.children().size())]
    mine = [s for s in scans if path in s.relation().location().rootPaths().mkString(",")]
    return sum(s.metrics().apply("numFiles").value() for s in mine)


def test_bucketed_facts_join_without_a_shuffle(spark):
    joined = QUERIES["bucketed_join"].run(spark, SMALL)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = QUERIES["bucketed_join"].run(spark, SMALL)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_a_dataset_name_is_known_for_every_source():
    assert {s for sources in SOURCES.values() for s in sources if s != "|"} <= set(DATASETS)
