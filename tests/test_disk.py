"""What lies on disk while Silver and Gold are built: no text is shuffled, and nothing stays that was only passed on."""

import uuid

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from smeltery.catalog import datasets
from smeltery.catalog import gold as queries
from smeltery.catalog.registry import Tables
from smeltery.plans import gold, silver_run
from smeltery.session import shuffles_freed
from smeltery.sources.bronze import land, read_pages
from smeltery.sources.registry import DATASETS

FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]


def _shuffled(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}


def _tables(spark, folder: str, dated: str = "true") -> Tables:
    made = spark.range(400).selectExpr(
        "id * 25 AS o_orderkey", "id % 30 AS o_custkey", "'F' AS o_orderstatus", "id * 1.25D AS o_totalprice",
        f"CASE WHEN {dated} THEN timestamp_ntz '1996-01-15 00:00:00' + make_dt_interval(int(id % 700)) END AS o_orderdate",
        "'1-URGENT' AS o_orderpriority",
    )
    customers = "id AS c_custkey, 'Customer ' || id AS c_name, int(id % 5) AS c_nationkey, 0D AS c_acctbal, 'BUILDING' AS c_mktsegment"
    made.unionByName(made.where("o_orderkey % 3 = 0")).write.parquet(f"{folder}/orders.parquet")  # some come twice
    spark.range(30).selectExpr(*customers.split(", ")).write.parquet(f"{folder}/customer.parquet")
    spark.range(5).selectExpr("int(id) AS n_nationkey", "'NATION_' || id AS n_name", "0 AS n_regionkey").write.parquet(f"{folder}/nation.parquet")
    return Tables(spark, folder)


@pytest.mark.parametrize("build", [datasets.results_pages, datasets.qualifying_pages, datasets.sprint_pages])
def test_orders_are_dealt_before_they_become_text(spark, tmp_path, monkeypatch, build):
    tables = _tables(spark, str(tmp_path), dated="id % 97 <> 0")
    plainly = build(tables)
    assert "rangepartitioning" not in _plan(plainly)
    monkeypatch.setattr(datasets, "ORDERS_PER_TASK", 25)
    found = build(tables)
    lines = _plan(found).splitlines()
    text = max(i for i, line in enumerate(lines) if "collect_list" in line)
    ranged = next(i for i, line in enumerate(lines) if "Exchange rangepartitioning" in line)
    assert text < ranged and not any("Exchange" in line for line in lines[:ranged])
    assert sorted(map(str, found.collect())) == sorted(map(str, plainly.collect()))


def test_dealt_pages_are_landed_by_the_tasks_that_have_them(spark, tmp_path):
    made = spark.range(0, 40, 1, 4)
    pages = made.select(F.lit(2024).alias("season"), F.lit("b1").alias("batch_id"), F.col("id").cast("string").alias("value"))
    spec = DATASETS["drivers"]
    land(pages, str(tmp_path / "b"), spec, dealt=True)
    assert len({*tmp_path.rglob("*.txt.gz")}) == 4
    assert {r.value for r in read_pages(spark, str(tmp_path / "b"), spec).collect()} == {str(i) for i in range(40)}


def test_gathered_facts_are_written_by_the_tasks_that_have_them(spark, tmp_path):
    fact = spark.range(0, 40, 1, 4).selectExpr("'d' || id % 7 AS driver_id", "2024L AS season", "1L AS round", "id AS points")
    gold.write_fact(fact, str(tmp_path / "f"), ["driver_id"], gathered=True)
    assert len({*tmp_path.rglob("*.parquet")}) == 4
    assert spark.read.parquet(str(tmp_path / "f")).agg(F.sum("points")).first()[0] == 780


def test_shuffles_go_when_their_write_ends(spark, tmp_path):
    spark._jvm.System.gc()
    before, was = _shuffled(spark), spark.conf.get(FREEING)
    with shuffles_freed(spark), shuffles_freed(spark):
        frame = spark.range(1000).groupBy((F.col("id") % 50).alias("k")).count()
        frame.write.parquet(str(tmp_path / "a"))
        assert len(frame.collect()) == len(frame.collect()) == 50  # what is run again is shuffled again
    assert spark.conf.get(FREEING) == was
    assert spark.read.parquet(str(tmp_path / "a")).count() == 50
    for _ in range(50):
        if not _shuffled(spark) - before:
            break
        spark._jvm.Thread.sleep(100)  # files are removed in the background
    assert len(_shuffled(spark) - before) <= 2  # those of the count above, which is not inside


def test_the_whole_build_keeps_no_landing_and_gives_the_same_rows(spark, tmp_path, monkeypatch):
    """Dealt or not, Gold has the same seasons; large datasets take turns, and no landing is left behind."""
    kept, writes, write_silver = tmp_path / "kept", [], silver_run.write_silver
    _tables(spark, str(tmp_path / "tables"))

    def held(rows, silver, spec, **more):
        writes.append((spec.name, silver_run._TURN.locked() and more["dealt"]))
        return write_silver(rows, silver, spec, **more)

    def built() -> list[tuple]:
        rows = entry.queries()["gold_driver_seasons"](spark, str(tmp_path / "tables")).collect()
        assert not [*kept.glob("bronze-*")] and [*kept.glob("gold-*")]
        return sorted(map(tuple, rows), key=str)

    monkeypatch.setattr(queries, "scratch_path", lambda spark, label: str(kept / f"{label}-{uuid.uuid4().hex}"))
    plainly = built()
    monkeypatch.setattr(datasets, "ORDERS_PER_TASK", 25)
    monkeypatch.setattr(silver_run, "BYTES_PER_TASK", 10_000)
    monkeypatch.setattr(silver_run, "write_silver", held)
    assert built() == plainly and len(plainly) > 30
    assert writes[:2] == [("results", True), ("qualifying", True)] and len(writes) == 4
    assert sum(r[4] for r in plainly) > 0 and sum(r[6] for r in plainly) > 0
