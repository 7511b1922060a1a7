"""Steps that aggregate texts, which is done by sorting, deal rows by key before."""

import pytest
from pyspark.sql import functions as F

from smeltery.operators.ordered import neighbours
from smeltery.plans.gold import driver_snapshots


def _sorted_before_dealt(frame) -> bool:
    """Whether a sort aggregate stands below the lowest exchange of any branch, on what was read."""
    lines = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
    return any("partial_max" in line and "Exchange" not in "".join(lines[i + 1 :]) for i, line in enumerate(lines))


@pytest.fixture
def rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    made = spark.range(40).selectExpr("string(id % 4) AS k", "id AS at", "string(id div 8) AS v", "2000 + id % 2 AS season", "id AS round")
    made.write.parquet(path)
    return spark.read.parquet(path)


def test_neighbours_deal_first(rows):
    found = neighbours(rows, ["k"], ["at"], F.col("at").cast("int") % 40 / 10, ["v"], "before_")
    assert not _sorted_before_dealt(found)
    assert found.where("before_exists").count() == 36


def test_teams_deal_first(rows):
    teams = rows.selectExpr("k AS driver_driver_id", "season", "round", "v AS constructor_constructor_id")
    drivers = rows.selectExpr("k AS driver_id", "season", "k AS given_name", "v AS family_name", "v AS nationality", "'2000-01-01' AS date_of_birth").limit(3)
    found = driver_snapshots(drivers, teams)
    assert not _sorted_before_dealt(found)
    assert {r.constructor_id for r in found.collect()} <= {"4", None}
