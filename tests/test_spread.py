"""Work is shared out over tasks by what it costs, not by the bytes that reach them."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from smeltery.functions.coerce import INT_TEXT, clean_str, float_of_text, int_of_text
from smeltery.operators.plain import plain_records
from smeltery.operators.validate import quarantined_records
from smeltery.plans import silver_run
from smeltery.sources.bronze import land, read_pages
from smeltery.sources.registry import DATASETS
from smeltery.sources.silver import read_silver, write_silver
from smeltery.streaming import intake


def _writers(base: Path) -> list[str]:
    return sorted(p.name.split("-")[1] for p in base.rglob("*.txt.gz"))


def test_pages_of_a_file_each_are_written_by_the_tasks_that_have_them(spark, tmp_path):
    made = spark.range(0, 40, 1, 4)
    pages = made.select(F.lit(2024).alias("season"), F.lit("b1").alias("batch_id"), F.col("id").cast("string").alias("value"))
    spec = DATASETS["drivers"]
    land(pages, str(tmp_path / "each"), spec, pages_per_file=1)
    assert len(_writers(tmp_path / "each")) == 40 and len(set(_writers(tmp_path / "each"))) == 4
    assert read_pages(spark, str(tmp_path / "each"), spec).count() == 40
    land(pages, str(tmp_path / "some"), spec)
    assert len(_writers(tmp_path / "some")) == 1


def test_records_are_dealt_before_they_are_sorted(spark, tmp_path, monkeypatch):
    path, spec = str(tmp_path / "rows"), DATASETS["pitstops"]
    made = spark.range(60).selectExpr(
        "2024L AS season", "id % 3 AS round", "string(id % 20) AS driver_id", "id div 30 AS stop", "string(id) AS duration",
        "'b1' AS batch_id", "int(id % 7) AS page", "int(id) AS _record_index",
    )
    made.unionByName(made.withColumn("page", F.col("page") + 10)).write.parquet(path)
    rows = spark.read.parquet(path)
    monkeypatch.setattr(silver_run, "BYTES_PER_TASK", 10)
    plainly = sorted(map(tuple, silver_run.newest_records(rows, spec).collect()))
    for size, dealing in ((15, "hashpartitioning"), (1005, "rangepartitioning")):
        found = silver_run.newest_records(rows, spec, size)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.index("partial_max_by") < plan.index(f"Exchange {dealing}")
        assert sorted(map(tuple, found.collect())) == plainly
    # Many rows: a task takes a bounded share whatever the session's number of partitions, and writes it.
    assert ", 101), REPARTITION_BY_NUM" in plan and len(plainly) == 60
    assert write_silver(found, str(tmp_path / "s"), spec, dealt=True)
    again = read_silver(spark, str(tmp_path / "s"), spec).select(found.columns)
    assert sorted(map(tuple, again.collect())) == plainly and min(r.page for r in again.collect()) >= 10


def test_plain_spellings_give_what_any_spelling_gives(spark):
    texts = ["5", " 45 ", "12.0", "+7", "-0", "1_0", "1.5", "x", "", "007", "1.", "9" * 18, "9" * 19, "5 ", "5\n", ".5", "1e3", "-2.50", "nan", None]
    whole = [5, 45, 12, 7, 0, 10, None, None, None, 7, None, int("9" * 18), None, None, 5, None, None, None, None, None]
    real = [5, 45, 12, 7, 0, 10, 1.5, None, None, 7, 1, 1e18, 1e19, None, 5, 0.5, 1000, -2.5, "nan", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    found = rows.select(F.expr(int_of_text("t")).alias("w"), F.expr(float_of_text("t")).alias("r")).collect()
    assert [r.w for r in found] == whole
    assert [r.r if r.r is None or r.r == r.r else "nan" for r in found] == real


def test_words_of_plain_letters_are_titled_like_others(spark):
    rows = spark.createDataFrame([(t,) for t in (" united kingdom", "FURNITURE ", "a\n", "o'neil", "éa", "", "  ", None)], "t string")
    assert [r[0] for r in rows.select(F.expr(clean_str("t"))).collect()] == ["United Kingdom", "Furniture", "A", "O'Neil", "Éa", "", "", None]


def test_quarantine_reads_only_pages_with_bad_records(spark, tmp_path, monkeypatch):
    """What the audit unpacks are the pages that have something to be unpacked."""
    seen = []
    monkeypatch.setattr(silver_run, "quarantined_records", lambda judged: seen.append(judged.count()) or quarantined_records(judged))
    good, bad = ({"driverId": "d", "lap": "1", "stop": stop, "time": "15:02:11", "duration": "2.5"} for stop in ("1", "x"))
    races = [json.dumps({"MRData": {"RaceTable": {"Races": [{"season": "2024", "round": "1", "PitStops": r}]}}}) for r in ([good] * 9, [good] * 9 + [bad])]
    pages = spark.createDataFrame([(2024, 1, "b1", i, t) for i, t in enumerate(races)], "season int, round int, batch_id string, page int, value string")
    spec = DATASETS["pitstops"]
    land(pages, str(tmp_path / "b"), spec)
    silver_run.run_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), None, ["pitstops"])
    assert seen == [1]
    assert spark.read.parquet(str(tmp_path / "s" / "_quarantine")).count() == 1


def test_every_text_is_typed_once():
    sql = plain_records("items", DATASETS["pitstops"])
    whole = [f for f in DATASETS["pitstops"].model.fields if f.kind == "int"]
    inherited = [f for f in DATASETS["pitstops"].inherited if f.kind == "int"]
    assert whole and sql.count(INT_TEXT) == len(whole) + len(inherited)


def test_a_stream_unpacks_only_pages_with_bad_records(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(intake, "quarantined_records", lambda judged: seen.append(judged.count()) or quarantined_records(judged))
    good, bad = ({"driverId": "d", "lap": "1", "stop": stop, "time": "15:02:11", "duration": "2.5"} for stop in ("1", "x"))
    races = [json.dumps({"MRData": {"RaceTable": {"Races": [{"season": "2024", "round": "1", "PitStops": r}]}}}) for r in ([good] * 9, [good] * 9 + [bad])]
    pages = spark.createDataFrame([(2024, 1, "b1", i, "d", t) for i, t in enumerate(races)], "_p_season int, _p_round int, batch_id string, page int, _file_path string, value string")
    intake.refine_into(str(tmp_path / "s"), str(tmp_path / "a"), DATASETS["pitstops"])(pages, 0)
    assert seen == [1]
    assert spark.read.parquet(str(tmp_path / "a" / "quarantine")).count() == 1
    assert intake.read_progress(spark, str(tmp_path / "a")).first()["records"] == 19
