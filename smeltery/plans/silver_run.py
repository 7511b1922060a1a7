"""Bronze to Silver for the registered datasets.

A run never makes Silver poorer: the batch of a partition is chosen on its pages before any record is
unpacked, only among complete batches, and a partition without one keeps what Silver has.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smeltery.operators.audit import failed
from smeltery.operators.dedupe import keep_latest_batches, latest_by_key
from smeltery.operators.quality import CorruptPagesError
from smeltery.operators.validate import (
    ERROR_THRESHOLD,
    judge_pages,
    page_verdicts,
    quarantined_records,
)
from smeltery.plans.side_by_side import AT_ONCE, side_by_side
from smeltery.session import scratch_path, shuffles_freed
from smeltery.sources.bronze import dataset_path, read_pages
from smeltery.sources.commits import commit, commits, next_number, read_commits
from smeltery.sources.models import Dataset
from smeltery.sources.registry import DATASETS
from smeltery.sources.silver import present_partitions, silver_rows, write_silver
from smeltery.sources.tables import remove, written_at
from smeltery.sources.versions import pointers, publish, versions

VERDICTS, QUARANTINE, RUNS = "_verdicts", "_quarantine", "_runs"
# Audit tables are replaced per dataset and season; datasets without seasons use this one.
NO_SEASON = "none"
# Bytes of page text whose records one task deduplicates, which is done by sorting; from this many such tasks on
# rows are dealt by ranges, which takes reading them twice.
BYTES_PER_TASK, MANY_TASKS = 64 << 20, 16
# Datasets with many such tasks take turns: each fills the cluster by itself, and what is dealt lies on disk.
_TURN = threading.Lock()


class PagesRejectedError(RuntimeError):
    """Some pages failed; the good ones of every dataset were written all the same."""


@dataclass(frozen=True)
class Counts:
    """What a run counted of one dataset while it wrote it."""

    pages: int
    failed: int
    corrupt: int
    empty: int
    records: int
    bad_records: int
    bytes_read: int
    rows_written: int


_COUNTERS = ("pages", "failed", "corrupt", "empty", "records", "bad_records", "bytes_read", "rows_written")
_RUN = "season long, endpoint string, status string, " + ", ".join(f"{c} long" for c in _COUNTERS)


def _observed_pages(judged: DataFrame, seen: Observation) -> DataFrame:
    verdict = F.col("verdict")
    return judged.observe(
        seen,
        F.count(F.lit(1)).alias("pages"),
        F.count_if(failed(verdict)).alias("failed"),
        F.count_if(verdict == "corrupt").alias("corrupt"),
        F.count_if(verdict == "empty").alias("empty"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_records"),
    )


@dataclass
class SilverRun:
    """Where a run left its results, and the pages it could not use per dataset."""

    silver: str
    failures: dict[str, int]
    skipped: list[str]
    corrupt: dict[str, int] = field(default_factory=dict)
    counts: dict[str, Counts] = field(default_factory=dict)

    def verdicts(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.silver}/{VERDICTS}")


def read_runs(spark: SparkSession, silver: str) -> DataFrame:
    """Every run's counters: ``commit`` (the run's number), season asked for, dataset and ``Counts``."""
    path = f"{silver}/{RUNS}"
    return read_commits(spark, path, _RUN, commits(spark, path))


def deduplicated(rows: DataFrame, spec: Dataset) -> DataFrame:
    """Newest batch per season and round, then newest record per natural key."""
    if spec.partitions:
        rows = keep_latest_batches(rows, list(spec.partitions))
    return newest_records(rows, spec)


def many(bytes_read: int) -> bool:
    return bytes_read >= BYTES_PER_TASK * MANY_TASKS


def newest_records(rows: DataFrame, spec: Dataset, bytes_read: int | None = None) -> DataFrame:
    """Newest record per natural key; partitions never take rows from each other.

    With ``bytes_read``, the size of the pages the rows are from, rows are dealt by key before they are sorted, as
    a task that unpacks pages has many times more rows than bytes. If they are ``many``, by ranges of the key, so
    that every task has a bounded share of neighbouring partitions and can write it as it is.
    """
    keys = [k for k in dict.fromkeys((*spec.partitions, *spec.natural_key)) if k in rows.columns]
    if bytes_read is not None and many(bytes_read):
        usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartitionByRange(max(bytes_read // BYTES_PER_TASK + 1, usual), *keys)
    elif bytes_read is not None:
        rows = rows.repartition(*keys)
    return latest_by_key(rows, keys, ["batch_id", "page", "_record_index"])


def chosen_batches(judged: DataFrame, spec: Dataset, present: DataFrame | None) -> DataFrame:
    """The batch to take per partition: the newest complete one.

    A batch is complete if no page of it failed and its pages or records add up to what its pages
    report. Where no batch is complete the newest is taken, but only if Silver (``present``) has
    nothing of the partition yet.
    """
    keys = [f"_p_{k}" for k in spec.partitions]
    pages = F.count_distinct("page") >= F.ceil(F.max("reported") / F.max("per_page"))
    batches = judged.groupBy(*keys, "batch_id").agg(
        ((F.count_if(failed(F.col("verdict"))) == 0) & (pages | (F.sum("total") >= F.max("reported")))).alias("whole")
    )
    newest = batches.groupBy(*keys).agg(
        F.max(F.when(F.col("whole"), F.col("batch_id"))).alias("complete"), F.max("batch_id").alias("any")
    )
    if present is None:
        return newest.select(*keys, F.coalesce("complete", "any").alias("batch_id"))
    if not keys:
        return newest.select(F.col("complete").alias("batch_id")).where("batch_id IS NOT NULL")
    held = present.withColumn("_held", F.lit(True))
    match = [F.col(f"n.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    joined = newest.alias("n").join(held.alias("h"), match, "left")
    batch = F.coalesce("n.complete", F.when(F.col("h._held").isNull(), F.col("n.any")))
    return joined.select(*(f"n.{k}" for k in keys), batch.alias("batch_id")).where("batch_id IS NOT NULL")


def published_partitions(spark: SparkSession, silver: str, spec: Dataset) -> DataFrame | None:
    """As ``present_partitions``, of a Silver that keeps its batches."""
    if not versions(spark, silver, spec):
        return None
    return pointers(spark, silver, spec).select(*(F.col(k).alias(f"_p_{k}") for k in spec.partitions)).distinct()


def of_batches(judged: DataFrame, chosen: DataFrame, spec: Dataset) -> DataFrame:
    """The pages of the chosen batches."""
    match = F.col("j.batch_id") == F.col("c.batch_id")
    for k in spec.partitions:
        match = match & F.col(f"j._p_{k}").eqNullSafe(F.col(f"c._p_{k}"))
    return judged.alias("j").join(chosen.alias("c"), match, "left_semi")


def refine(
    spark: SparkSession,
    pages: DataFrame,
    silver: str,
    spec: Dataset,
    threshold: float = ERROR_THRESHOLD,
    dedupe: bool = True,
) -> int:
    """Judge the pages of one dataset once, then write rows, quarantine and verdicts from that."""
    return _refined(spark, pages, silver, spec, threshold, dedupe)[0].failed


def _refined(
    spark: SparkSession,
    pages: DataFrame,
    silver: str,
    spec: Dataset,
    threshold: float,
    dedupe: bool,
    keep_batches: bool = False,
    by_season: bool = False,
) -> tuple[Counts, dict[int | None, tuple[int, int]]]:
    """The dataset's counters and, if wanted, failed and corrupt pages of every season.

    Counters are taken where tables are written, from the tasks that write: a task that is run again
    counts once. What is written from the judged pages is written at the same time.
    """
    scratch, keys = scratch_path(spark, f"refine-{spec.name}"), dict(spark=spark, pool=spec.name)
    read, seen, put = Observation(), Observation(), Observation()
    measured = pages.observe(read, F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).cast("long").alias("bytes_read"))
    judged = written_at(_observed_pages(judge_pages(measured, spec, threshold, gate=True), seen), f"{scratch}/judged")

    def rows() -> bool:
        """Write the rows; False if there was nothing to write at all."""
        if keep_batches or dedupe:
            present = (published_partitions if keep_batches else present_partitions)(spark, silver, spec)
            batches = written_at(chosen_batches(judged, spec, present), f"{scratch}/batches")
            found = silver_rows(of_batches(judged, batches, spec), spec)
        else:
            found = silver_rows(judged, spec)
        if keep_batches:
            publish(found, silver, spec, put)
            return True
        if not dedupe:
            return write_silver(found, silver, spec, seen=put)
        size = read.get["bytes_read"]
        with _TURN if many(size) else nullcontext():
            return write_silver(newest_records(found, spec, size), silver, spec, seen=put, dealt=many(size))

    def audit(frame: DataFrame, name: str) -> None:
        season = F.coalesce(F.col("_p_season").cast("string"), F.lit(NO_SEASON)).alias("season")
        target = frame.select(F.lit(spec.name).alias("endpoint"), season, "*").write.mode("overwrite")
        target = target.partitionBy("endpoint", "season").option("partitionOverwriteMode", "dynamic")
        target.parquet(f"{silver}/{name}")

    def seasons() -> dict[int | None, tuple[int, int]]:
        bad, lost = F.count_if(failed(F.col("verdict"))), F.count_if(F.col("verdict") == "corrupt")
        found = judged.groupBy("_p_season").agg(bad.alias("bad"), lost.alias("lost")).collect() if by_season else []
        return {r["_p_season"]: (r["bad"], r["lost"]) for r in found}  # a row per season

    try:
        done = side_by_side(
            jobs={
                "rows": rows,
                "verdicts": lambda: audit(page_verdicts(judged), VERDICTS),
                "quarantine": lambda: audit(quarantined_records(judged.where("bad > 0")), QUARANTINE),
                "seasons": seasons,
            },
            **keys,
        )
    finally:
        remove(spark, scratch)
    counted = seen.get | read.get | (put.get if done["rows"] else {})
    return Counts(*(counted.get(c) or 0 for c in _COUNTERS)), done["seasons"]


def run_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    season: int | None = None,
    datasets: Iterable[str | Dataset] | None = None,
    threshold: float = ERROR_THRESHOLD,
    on_error: str = "fail",
    whole_files: bool = False,
    keep_batches: bool = False,
    at_once: int = AT_ONCE,
) -> SilverRun:
    """Refine every dataset, side by side; bad pages stop nothing but, with ``on_error='fail'``, the run's end.

    Pages that report records but hold none fail it in either mode. Season-less datasets are read
    whole, the others only in their season's folder. With ``keep_batches`` Silver holds its batches side
    by side (``sources.versions``) and can be rolled back; without, a partition holds its newest.
    What was counted is in the result and in the table of ``read_runs``.
    """
    run = SilverRun(silver, {}, [])
    found = _all_refined(spark, bronze, silver, season, datasets, threshold, whole_files, at_once, keep_batches)
    for name, done in found.items():
        if done is None:
            run.skipped.append(name)
            continue
        run.counts[name] = counts = done[0]
        run.failures[name] = counts.failed
        if counts.corrupt:
            run.corrupt[name] = counts.corrupt
    _note(spark, silver, season, run)
    if run.corrupt:
        raise CorruptPagesError(f"pages report records but hold none: {run.corrupt}")
    if on_error == "fail" and any(run.failures.values()):
        raise PagesRejectedError(f"pages failed: { {k: n for k, n in run.failures.items() if n} }")
    return run


def _all_refined(
    spark: SparkSession,
    bronze: str,
    silver: str,
    season: int | list[int] | None,
    datasets: Iterable[str | Dataset] | None,
    threshold: float,
    whole_files: bool,
    at_once: int,
    keep_batches: bool = False,
    by_season: bool = False,
) -> dict[str, tuple[Counts, dict[int | None, tuple[int, int]]] | None]:
    """Refine the datasets side by side; None for those that have not landed."""

    def refined(spec: Dataset) -> tuple[Counts, dict[int | None, tuple[int, int]]] | None:
        try:
            pages = read_pages(spark, bronze, spec, season, whole_files)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return _refined(spark, pages, silver, spec, threshold, True, keep_batches, by_season)

    chosen = [DATASETS[e] if isinstance(e, str) else e for e in datasets or DATASETS]
    with shuffles_freed(spark):
        return side_by_side(spark, {spec.name: lambda spec=spec: refined(spec) for spec in chosen}, at_once)


def _note(spark: SparkSession, silver: str, season: int | None, run: SilverRun) -> None:
    """Add the run's counters to the table of runs."""
    rows = [
        (season, name, "FAILED" if c.corrupt else "PARTIAL" if c.failed else "SUCCESS", *(getattr(c, k) for k in _COUNTERS))
        for name, c in run.counts.items()
    ]
    if rows:
        commit(spark.createDataFrame(rows, _RUN).coalesce(1), f"{silver}/{RUNS}", next_number(spark, f"{silver}/{RUNS}"))


def run_seasons(
    spark: SparkSession,
    bronze: str,
    silver: str,
    seasons: Iterable[int],
    datasets: Iterable[str | Dataset] | None = None,
    threshold: float = ERROR_THRESHOLD,
    whole_files: bool = False,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """Refine the pages of some seasons and return a row each: ``season, status, failed_pages``.

    All seasons of a dataset are one scan, judged at once and told apart afterwards; datasets are
    refined side by side. SUCCESS without failed pages, PARTIAL with some, FAILED with pages that report
    records but hold none; a season that fails does not keep the others from being written. Pages
    of datasets without seasons count for each season. The rows feed ``audit.backfill_summary``.
    """
    wanted = list(dict.fromkeys(seasons))
    found = _all_refined(spark, bronze, silver, wanted, datasets, threshold, whole_files, at_once, by_season=True)
    rows: list[tuple[int, str, int]] = []
    for season in wanted:
        pages = [done[1].get(key, (0, 0)) for done in found.values() if done for key in (season, None)]
        bad, lost = sum(b for b, _ in pages), sum(n for _, n in pages)
        rows.append((season, "FAILED" if lost else "PARTIAL" if bad else "SUCCESS", bad))
    return spark.createDataFrame(rows, "season long, status string, failed_pages long")


__all__ = [
    "SilverRun",
    "PagesRejectedError",
    "run_silver",
    "run_seasons",
    "read_runs",
    "refine",
    "deduplicated",
    "dataset_path",
]
