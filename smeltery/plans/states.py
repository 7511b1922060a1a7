"""Season statistics kept as mergeable states per round.

A state table holds, per season, round and entity, partial aggregates that merge: sums, counts, least
structs. Seasons and all time are merges of these rows and never read the facts. A refresh finds the
rounds whose rows differ from those it last saw, by a count and a sum of row hashes per round, and
replaces the states of these rounds only; a round that lost all its rows keeps an empty mark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.plans.gold import POINTS
from smeltery.sources.commits import commit, commits, next_number, read_commits
from smeltery.sources.tables import written

ROUND = ("season", "round")
_PRINT = "season long, round long, rows long, digest decimal(38,0)"


@dataclass(frozen=True)
class Measure:
    """A state: an aggregate over rows, and the aggregate that merges states of that name."""

    name: str
    of_rows: Callable[[], Column]
    merge: Callable[[str], Column]


def total(name: str, value: str, kind: str = POINTS) -> Measure:
    wide = "decimal(38,2)" if kind == POINTS else "long"
    summed = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast(wide)
    return Measure(name, lambda: summed(F.expr(value).cast(kind)), summed)


def number(name: str, condition: str) -> Measure:
    """How many rows meet a condition."""
    return Measure(name, lambda: F.count_if(F.expr(condition)), lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long"))


def rounds(name: str, condition: str) -> Measure:
    """In how many rounds some row meets a condition; a state is one round."""
    some = lambda: F.coalesce(F.max(F.expr(condition).cast("long")), F.lit(0))
    return Measure(name, some, lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long"))


def least(name: str, order: Sequence[str], where: str) -> Measure:
    """The least struct of some columns among the rows that meet a condition."""
    return Measure(name, lambda: F.min(F.when(F.expr(where), F.struct(*order))), F.min)


@dataclass(frozen=True)
class States:
    """A state table: the entity columns its rows are about, and their measures."""

    entity: tuple[str, ...]
    measures: tuple[Measure, ...]

    def of(self, rows: DataFrame) -> DataFrame:
        """States of the rounds of ``rows``, which hold ``season, round`` and what the measures name."""
        found = rows.groupBy(*ROUND, *self.entity).agg(*(m.of_rows().alias(m.name) for m in self.measures))
        return found.withColumns({k: F.col(k).cast("long") for k in ROUND}).withColumn("present", F.lit(True))

    def merged(self, states: DataFrame, by: Sequence[str]) -> DataFrame:
        """The measures by some of ``season, round`` and the entity columns."""
        return states.groupBy(*by).agg(*(m.merge(m.name).alias(m.name) for m in self.measures))


DRIVERS = States(
    ("driver_id",),
    (
        total("total_points", "points"),
        number("races", "kind = 'race'"),
        number("wins", "kind = 'race' AND place = 1"),
        number("podiums", "kind = 'race' AND place <= 3"),
        number("poles", "kind = 'qualifying' AND place = 1"),
    ),
)
CONSTRUCTORS = States(
    ("constructor_id",),
    (
        total("total_points", "points"),
        rounds("races", "kind = 'race'"),
        number("wins", "kind = 'race' AND place = 1"),
        number("podiums", "kind = 'race' AND place <= 3"),
    ),
)
CIRCUITS = States(
    ("circuit_id",),
    (
        least("best", ("fastest_lap_time", "season", "round", "driver_id"), "fastest_lap_time IS NOT NULL"),
        number("timed", "fastest_lap_time IS NOT NULL"),
    ),
)


def scoring_rows(results: DataFrame, qualifying: DataFrame | None = None, sprints: DataFrame | None = None) -> DataFrame:
    """Facts of all kinds as rows of one shape, for the driver and constructor states."""
    parts = [("race", results), ("sprint", sprints), ("qualifying", qualifying)]
    shaped = [
        f.select(
            *ROUND,
            "driver_id",
            "constructor_id",
            F.lit(kind).alias("kind"),
            F.col("final_position").alias("place"),
            (F.col("points") if kind != "qualifying" else F.lit(None)).cast(POINTS).alias("points"),
        )
        for kind, f in parts
        if f is not None
    ]
    whole = shaped[0]
    for more in shaped[1:]:
        whole = whole.unionByName(more)
    return whole


def prints(rows: DataFrame) -> DataFrame:
    """Rows and a sum of row hashes per round: equal for equal sets of rows, in whatever order."""
    keys = [F.col(k).cast("long").alias(k) for k in ROUND]
    hashed = F.xxhash64(*rows.columns).cast("decimal(20,0)")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum(hashed).cast("decimal(38,0)").alias("digest"))


def changed_rounds(before: DataFrame, now: DataFrame) -> DataFrame:
    """``season, round, change`` of the rounds that are new, changed or emptied between two ``prints``."""
    b, n = before.alias("b"), now.alias("n")
    match = F.col("b.season").eqNullSafe(F.col("n.season")) & F.col("b.round").eqNullSafe(F.col("n.round"))
    change = F.when(F.col("b.rows").isNull(), "new").when(F.col("n.rows").isNull(), "emptied").otherwise("changed")
    same = F.col("b.rows").eqNullSafe(F.col("n.rows")) & F.col("b.digest").eqNullSafe(F.col("n.digest"))
    pick = [F.when(F.col("n.rows").isNotNull(), F.col(f"n.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in ROUND]
    return b.join(n, match, "full_outer").where(~same).select(*pick, change.alias("change"))


def refresh(rows: DataFrame, path: str, table: States) -> DataFrame:
    """Bring the states below ``path`` up to ``rows`` and return the rounds that were replaced.

    The rounds seen last are those of the newest commit; a refresh that is cut short commits none, so
    the next one finds the same rounds and replaces them again. Rows without a season or round belong
    to no round and are left out.
    """
    spark, log = rows.sparkSession, f"{path}/prints"
    placed = rows.where("season IS NOT NULL AND round IS NOT NULL")
    now = written(prints(placed), "prints")
    last = read_commits(spark, log, _PRINT, commits(spark, log)[-1:])
    changed = written(changed_rounds(last, now), "changed-rounds")
    # The comparison on the small side lets a fact stored by round be pruned while the job runs.
    live = changed.where(F.col("change") != "emptied").select(*ROUND)
    states = table.of(placed.join(live, list(ROUND), "left_semi"))
    marks = changed.where(F.col("change") == "emptied").select(
        *ROUND,
        *(F.lit(None).cast(states.schema[c].dataType).alias(c) for c in states.columns if c not in (*ROUND, "present")),
        F.lit(False).alias("present"),
    )
    out = states.unionByName(marks).hint("rebalance", *ROUND).write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy(*ROUND).parquet(f"{path}/states")
    commit(now.coalesce(1), log, next_number(spark, log))
    return changed


def read_states(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.parquet(f"{path}/states").where("present")
    return found.withColumns({k: F.col(k).cast("long") for k in ROUND})


def season_and_all_time(spark: SparkSession, path: str, table: States) -> DataFrame:
    """The measures per season and entity, and with a null season over all seasons."""
    states = read_states(spark, path)
    seasons = table.merged(states, ["season", *table.entity])
    ever = table.merged(seasons, list(table.entity)).withColumn("season", F.lit(None).cast("long"))
    return seasons.unionByName(ever)
