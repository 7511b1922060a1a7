"""New Bronze or Silver files, each processed once, with the batch operators doing the work."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.operators.audit import failed
from smeltery.operators.validate import ERROR_THRESHOLD, judge_pages, page_verdicts, quarantined_records
from smeltery.plans.side_by_side import side_by_side
from smeltery.plans.silver_run import deduplicated
from smeltery.sources.models import Dataset
from smeltery.sources.silver import silver_rows, write_silver
from smeltery.sources.tables import written


def new_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream, oldest first; sources stay where they are."""
    reader = spark.readStream.schema(schema).option("latestFirst", "false")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def new_pages(spark: SparkSession, path: str, spec: Dataset, batch_id: str = "") -> DataFrame:
    """Landed text pages of one dataset as a stream, with the columns the batch reader gives.

    Season, round and batch come from the folders of the dataset's layout; ``batch_id`` is for files
    that lie in no batch folder.
    """
    raw = spark.readStream.option("recursiveFileLookup", "true").text(path)
    file = F.col("_metadata.file_path")

    def folder(name: str) -> Column:
        return F.nullif(F.regexp_extract(file, rf"/{name}=([^/]+)/", 1), F.lit(""))

    keys = [
        (folder(k).try_cast("int") if k in spec.partitions else F.lit(None).cast("int")).alias(f"_p_{k}")
        for k in ("season", "round")
    ]
    in_text = F.get_json_object("value", "$.metadata.batch_id")
    return raw.select(
        *keys,
        F.coalesce(folder("batch_id"), in_text, F.lit(batch_id)).alias("batch_id"),
        F.coalesce(F.get_json_object("value", "$.metadata.page").try_cast("int"), F.lit(1)).alias("page"),
        file.alias("_file_path"),
        "value",
    )


def drain(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Process all files not seen by this checkpoint yet, then stop."""
    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that survives replays: a batch overwrites its own folder only."""

    def handle(frame: DataFrame, batch: int) -> None:
        frame.write.mode("overwrite").parquet(f"{path}/_batch={batch}")

    return handle


def refine_into(
    silver: str, audit: str, spec: Dataset, threshold: float = ERROR_THRESHOLD, published: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Judge every micro-batch once; keep its good rows, its verdicts, its bad records and its progress.

    A batch that is replayed overwrites its own folders. Pages of later batches land beside older ones;
    ``taken_in`` gives the rows that count. With ``published`` these are also kept as a Silver there,
    of which each micro-batch publishes the partitions it touched.
    """

    def handle(frame: DataFrame, batch: int) -> None:
        judged = written(judge_pages(frame, spec, threshold, gate=True), f"stream-{spec.name}")
        parts = {
            silver: silver_rows(judged, spec),
            f"{audit}/verdicts": page_verdicts(judged),
            f"{audit}/quarantine": quarantined_records(judged.where("bad > 0")),
            f"{audit}/progress": intake_progress(judged),
        }
        keys = list(spec.partitions)

        def put(target: str, rows: DataFrame) -> None:
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
            # Rows lie by partition, so that publishing reads the touched ones alone.
            writer = writer.partitionBy(*keys) if target == silver and keys else writer
            writer.parquet(f"{target}/_batch={batch}")

        jobs = {target: lambda target=target, rows=rows: put(target, rows) for target, rows in parts.items()}
        side_by_side(frame.sparkSession, jobs, pool=f"stream-{spec.name}")
        if published is not None:
            publish_touched(frame.sparkSession, silver, published, spec, batch)

    return handle


def intake_progress(judged: DataFrame) -> DataFrame:
    """One row per file of a micro-batch: its pages, how many failed, and the records they held."""
    return judged.groupBy(F.col("_file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(failed(F.col("verdict"))).alias("failed"), F.sum("total").alias("records")
    )


def read_progress(spark: SparkSession, audit: str) -> DataFrame:
    """Which file went in with which micro-batch (``_batch``), over the life of the stream."""
    return spark.read.parquet(f"{audit}/progress")


def publish_touched(spark: SparkSession, silver: str, published: str, spec: Dataset, batch: int) -> None:
    """Bring the partitions a micro-batch touched up to date: newest batch, newest record per key.

    Of all that was taken in before, only these partitions are read. A micro-batch that is replayed
    publishes the same rows again. A dataset without partitions is published whole.
    """
    keys = list(spec.partitions)
    whole = spark.read.parquet(silver)
    if not keys:
        write_silver(deduplicated(whole.drop("_batch"), spec), published, spec)
        return
    touched = whole.where(F.col("_batch") == batch).select(*keys).distinct().withColumn("_touched", F.lit(1))
    # Compared by value below, so that the planner prunes the folders of other partitions.
    marked = written(touched, "touched").where("_touched > 0")
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    named = marked.where(reduce(and_, (F.col(k).isNotNull() for k in keys))).select(*keys)
    rows = whole.join(named, keys, "left_semi")
    nowhere = marked.where(reduce(or_, (F.col(k).isNull() for k in keys)))
    if nowhere.head(1):
        rows = rows.unionByName(whole.alias("w").join(nowhere.alias("t"), same, "left_semi"))
    write_silver(deduplicated(rows.drop("_batch"), spec), published, spec)


def taken_in(spark: SparkSession, silver: str, spec: Dataset) -> DataFrame:
    """The rows a stream has taken in: newest batch per partition, newest record per key."""
    return deduplicated(spark.read.parquet(silver).drop("_batch"), spec)
