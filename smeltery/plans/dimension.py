"""A slowly changing dimension in buckets: folding a snapshot touches only the buckets it changes.

Keys are dealt to buckets by hash. A bucket has an open part (current versions) and a closed part, both
made of immutable folders; a commit names the folders that count. A snapshot newer than all before
is compared with the open versions alone: the open part of touched buckets is written anew and closed
versions are added beside the older ones. A late snapshot is spliced between the versions of the keys
it contradicts. Every fold gives the versions it removed and opened as a table.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smeltery.operators.history import VALID_FROM, VALID_TO
from smeltery.sources.commits import commit, commits, next_number, read_commits
from smeltery.sources.tables import exists, written

OPEN, CLOSED = "open", "closed"
_AT, _THERE, _BUCKET = "_at", "_there", "bucket"


@dataclass(frozen=True)
class Dimension:
    """Where a dimension lies, its keys and checked columns with their types, and the type of moments."""

    path: str
    keys: dict[str, str]
    check: dict[str, str]
    moment: str = "timestamp"
    buckets: int = 64

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.check]

    def schema(self, *more: str) -> str:
        named = {**self.keys, **self.check, VALID_FROM: self.moment, VALID_TO: self.moment}
        return ", ".join([*(f"`{c}` {kind}" for c, kind in named.items()), *more])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(_BUCKET)

    def log(self) -> str:
        return f"{self.path}/commits"

    def folder(self, part: str, bucket: int, fold: int) -> str:
        return f"{self.path}/versions/part={part}/fold={fold}/bucket={bucket}"


@dataclass(frozen=True)
class _State:
    """What the newest commit says: the folders that count, and the folds so far with their moments."""

    live: frozenset[tuple[str, int, int]]
    folds: tuple[tuple[int, object, bool], ...]


def _state(spark: SparkSession, dim: Dimension, version: int | None = None) -> _State:
    """Metadata only: a row per folder and per fold."""
    schema = f"kind string, part string, bucket int, fold int, at {dim.moment}, complete boolean"
    rows = read_commits(spark, dim.log(), schema, commits(spark, dim.log(), version)[-1:]).collect()
    live = frozenset((r["part"], r["bucket"], r["fold"]) for r in rows if r["kind"] == "folder")
    folds = sorted((r["fold"], r["at"], r["complete"]) for r in rows if r["kind"] == "fold")
    return _State(live, tuple(folds))


def _read(spark: SparkSession, dim: Dimension, folders: Iterable[tuple[str, int, int]]) -> DataFrame:
    paths = [dim.folder(*f) for f in sorted(folders)]
    schema = dim.schema("part string", "fold int", f"{_BUCKET} int")
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{dim.path}/versions").parquet(*paths)


def read_dimension(spark: SparkSession, dim: Dimension, version: int | None = None) -> DataFrame:
    """All versions, closed ones and open ones (no ``valid_to``), now or after an earlier fold."""
    state = _state(spark, dim, version)
    return _read(spark, dim, state.live).select(*dim.columns, VALID_FROM, VALID_TO)


def read_changes(spark: SparkSession, dim: Dimension) -> DataFrame:
    """What every fold did: ``fold, change, reason`` and the version. ``removed`` ones are no longer there,
    ``opened`` ones are new or have new bounds; the reason is insert, update, delete or late.
    """
    schema = dim.schema("change string", "reason string", "fold int")
    done = [f for f, _, _ in _state(spark, dim).folds]
    paths = [p for p in (f"{dim.path}/changes/fold={f}" for f in done) if exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{dim.path}/changes").parquet(*paths)


def _same(left: str, right: str, columns: Iterable[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns), F.lit(True))


def _contradicted(dim: Dimension, valid: DataFrame, snapshot: DataFrame, complete: bool) -> DataFrame:
    """Keys for which a snapshot says something else than the versions valid at its moment."""
    match = [F.col(f"v.{k}") == F.col(f"s.{k}") for k in dim.keys]
    both = valid.withColumn("_v", F.lit(True)).alias("v").join(
        snapshot.withColumn("_s", F.lit(True)).alias("s"), match, "full_outer"
    )
    held, said = F.col("v._v").isNotNull(), F.col("s._s").isNotNull()
    differs = reduce(or_, (~F.col(f"v.{c}").eqNullSafe(F.col(f"s.{c}")) for c in dim.check), F.lit(False))
    news = (held & said & differs) | (said & ~held) | ((held & ~said) if complete else F.lit(False))
    reason = F.when(held & said, "update").when(said, "insert").otherwise("delete").alias("reason")
    keys = [F.coalesce(f"s.{k}", f"v.{k}").alias(k) for k in dim.keys]
    found = both.where(news).select(*keys, said.alias(_THERE), *(F.col(f"s.{c}").alias(c) for c in dim.check), reason)
    return found.select("*", dim.bucket())


def _rebuilt(dim: Dimension, told: DataFrame) -> DataFrame:
    """Versions from what was observed of each key: ``<keys>, <check>, _at, _there``.

    A version starts where an observation differs from the one before it and ends at the next that
    does; where the key was not there, none is open. Rows of a key are as few as its versions.
    """
    order = Window.partitionBy(*dim.keys).orderBy(_AT)
    now = F.struct(_THERE, *dim.check)
    kept = told.withColumn("_before", F.lag(now).over(order)).where(~now.eqNullSafe(F.col("_before")))
    ended = kept.withColumn(VALID_TO, F.lead(_AT).over(order)).where(_THERE)
    return ended.select(*dim.columns, F.col(_AT).alias(VALID_FROM), VALID_TO)


def _observed(dim: Dimension, versions: DataFrame) -> DataFrame:
    """Versions as observations: one where each starts, and an absence where one ends without a next."""
    order = Window.partitionBy(*dim.keys).orderBy(VALID_FROM)
    after = versions.withColumn("_next", F.lead(VALID_FROM).over(order))
    starts = after.select(*dim.columns, F.col(VALID_FROM).alias(_AT), F.lit(True).alias(_THERE))
    gone = F.col(VALID_TO).isNotNull() & ~F.col(VALID_TO).eqNullSafe(F.col("_next"))
    none = [F.lit(None).cast(kind).alias(c) for c, kind in dim.check.items()]
    return starts.unionByName(
        after.where(gone).select(*dim.keys, *none, F.col(VALID_TO).alias(_AT), F.lit(False).alias(_THERE))
    )


def _seen_again(spark: SparkSession, dim: Dimension, state: _State, at: object, keys: DataFrame) -> DataFrame:
    """The first moment after ``at`` at which each key was observed once more (``<keys>, _at``)."""
    later = [(fold, moment, whole) for fold, moment, whole in state.folds if moment > at]
    wholes = [moment for _, moment, whole in later if whole]
    found = keys.select(*dim.keys, F.lit(min(wholes) if wholes else None).cast(dim.moment).alias(_AT))
    paths = [f"{dim.path}/seen/fold={fold}" for fold, _, _ in later]
    if paths:
        schema = ", ".join([*(f"`{k}` {kind}" for k, kind in dim.keys.items()), f"{_AT} {dim.moment}"])
        seen = spark.read.schema(schema).parquet(*paths)
        found = found.unionByName(seen.join(keys.select(*dim.keys), list(dim.keys), "left_semi"))
    return found.groupBy(*dim.keys).agg(F.min(_AT).alias(_AT)).where(F.col(_AT).isNotNull())


def fold(snapshot: DataFrame, dim: Dimension, at: object, complete: bool = False) -> DataFrame:
    """Fold the snapshot of one moment into a dimension; returns the fold's rows of ``read_changes``.

    ``snapshot`` has one row per key; further columns are not kept, rows with a null key are left out. Keys
    it lacks stay as they are, unless it is ``complete``: then they are closed. Snapshots may come in any
    order, each moment once; the versions are those of all snapshots in the order of their moments.
    """
    spark, number = snapshot.sparkSession, next_number(snapshot.sparkSession, dim.log())
    state = _state(spark, dim)
    moments = [moment for _, moment, _ in state.folds]
    if at in moments:
        raise ValueError(f"a snapshot of {at} was folded before")
    late = any(moment > at for moment in moments)
    typed = [F.col(c).cast(kind).alias(c) for c, kind in {**dim.keys, **dim.check}.items()]
    here = snapshot.select(*typed).where(reduce(and_, (F.col(k).isNotNull() for k in dim.keys)))
    moment = F.lit(at).cast(dim.moment)

    held = _read(spark, dim, state.live if late else [f for f in state.live if f[0] == OPEN])
    valid = held.where((F.col(VALID_FROM) <= moment) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > moment)))
    news = written(_contradicted(dim, valid, here, complete), "contradicted")
    before = written(
        held.join(news.select(*dim.keys), list(dim.keys), "left_semi").select(*dim.columns, VALID_FROM, VALID_TO), "before"
    )
    told = _observed(dim, before).unionByName(news.select(*dim.columns, moment.alias(_AT), _THERE))
    if late:
        again = written(_seen_again(spark, dim, state, at, news), "seen-again")
        covers = (F.col(f"b.{VALID_FROM}") < F.col(f"g.{_AT}")) & (F.col(f"b.{VALID_TO}").isNull() | (F.col(f"b.{VALID_TO}") > F.col(f"g.{_AT}")))
        match = reduce(and_, (F.col(f"g.{k}") == F.col(f"b.{k}") for k in dim.keys))
        known = again.alias("g").join(before.alias("b"), match & covers, "left")
        starts = before.select(*dim.keys, F.col(VALID_FROM).alias(_AT))
        told = told.unionByName(
            known.select(
                *(F.col(f"g.{k}").alias(k) for k in dim.keys),
                *(F.col(f"b.{c}").alias(c) for c in dim.check),
                F.col(f"g.{_AT}").alias(_AT),
                F.col(f"b.{VALID_FROM}").isNotNull().alias(_THERE),
            ).join(starts, [*dim.keys, _AT], "left_anti")
        )
    after = written(_rebuilt(dim, told), "after")

    whole = [*dim.columns, VALID_FROM, VALID_TO]
    removed = before.alias("x").join(after.alias("y"), _same("x", "y", whole), "left_anti").withColumn("change", F.lit("removed"))
    opened = after.alias("x").join(before.alias("y"), _same("x", "y", whole), "left_anti").withColumn("change", F.lit("opened"))
    reasons = news.select(*dim.keys, F.lit("late").alias("reason") if late else "reason")
    changes = removed.unionByName(opened).join(reasons, list(dim.keys)).select(*whole, "change", "reason")
    changes.write.mode("overwrite").parquet(f"{dim.path}/changes/fold={number}")
    seen = here.select(*dim.keys, moment.alias(_AT))
    seen.write.mode("overwrite").parquet(f"{dim.path}/seen/fold={number}")

    touched = {r[_BUCKET] for r in news.select(_BUCKET).distinct().collect()}  # at most the buckets
    replaced = {f for f in state.live if f[1] in touched and (late or f[0] == OPEN)}
    stay = _read(spark, dim, replaced).join(news.select(*dim.keys), list(dim.keys), "left_anti").select(*whole)
    out = stay.unionByName(after).select("*", dim.bucket())
    for part, rows in ((OPEN, out.where(F.col(VALID_TO).isNull())), (CLOSED, out.where(F.col(VALID_TO).isNotNull()))):
        writer = rows.repartition(_BUCKET).sortWithinPartitions(_BUCKET, *dim.keys).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "static").partitionBy(_BUCKET).parquet(f"{dim.path}/versions/part={part}/fold={number}")
    made = {(part, b, number) for part in (OPEN, CLOSED) for b in touched if exists(spark, dim.folder(part, b, number))}
    _commit(spark, dim, _State(frozenset((state.live - replaced) | made), (*state.folds, (number, at, complete))), number)
    return read_changes(spark, dim).where(F.col("fold") == number)


def _commit(spark: SparkSession, dim: Dimension, state: _State, number: int) -> None:
    rows = [("folder", part, bucket, fold, None, None) for part, bucket, fold in sorted(state.live)]
    rows += [("fold", None, None, fold, at, complete) for fold, at, complete in state.folds]
    schema = f"kind string, part string, bucket int, fold int, at {dim.moment}, complete boolean"
    commit(spark.createDataFrame(rows, schema).coalesce(1), dim.log(), number)
