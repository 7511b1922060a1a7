"""Independent jobs submitted together, so that small ones do not wait for each other."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")
# Jobs of so many kinds are submitted at once; what runs is the cluster's to decide.
AT_ONCE = 8


def side_by_side(
    spark: SparkSession, jobs: dict[str, Callable[[], Result]], at_once: int = AT_ONCE, pool: str | None = None
) -> dict[str, Result]:
    """The results of all jobs by name. All are run to their end; then the first error is raised.

    Each job submits to a scheduler pool of its own name (or ``pool``), which shares the cluster fairly
    where ``spark.scheduler.mode`` is FAIR and changes nothing elsewhere.
    """

    def in_pool(name: str, job: Callable[[], Result]) -> Callable[[], Result]:
        def run() -> Result:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool or name)
            return job()

        return inheritable_thread_target(spark)(run)

    if len(jobs) == 1:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(max(1, min(at_once, len(jobs)))) as threads:
        started = {name: threads.submit(in_pool(name, job)) for name, job in jobs.items()}
    return {name: future.result() for name, future in started.items()}
