"""Landings of one page per file, whose name need not tell how the body is packed.

A file is taken as bytes and told apart by them: gzip starts with two fixed bytes, whatever the name
ends in. Bodies are unpacked in batches, which the engine has no function for; all else stays in it. A body
that cannot be unpacked or is not UTF-8 gets a verdict and no text, instead of text that means nothing.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.sources.bronze import dataset_path, season_paths
from smeltery.sources.models import Dataset

# The first two bytes of a gzip body (fixed by its format).
GZIP = b"\x1f\x8b"


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the body: the content, unpacked if it is gzip, or null where that fails."""
    for batch in batches:
        bodies, contents = [], batch.column(batch.schema.get_field_index("content")).to_pylist()
        for content in contents:
            try:
                bodies.append(gzip.decompress(content) if content[:2] == GZIP else content)
            except (OSError, EOFError, zlib.error):
                bodies.append(None)
        heads = [c[:2] == GZIP for c in contents]
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        names = batch.schema.names[:-1]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(bodies, pa.binary()), pa.array(heads, pa.bool_())], names=[*names, "body", "packed"]
        )


def read_single_pages(spark: SparkSession, base: str, spec: Dataset, season: int | None = None) -> DataFrame:
    """What ``bronze.read_pages`` gives for whole-file pages, with ``codec`` and ``body_verdict``.

    ``codec`` is ``gzip`` or ``plain``, by the body. The verdict is ``ok``, ``bad_gzip`` or ``not_text``; only
    ``ok`` bodies have a ``value``. ``mislabelled`` marks gzip bodies without, and plain ones with, a name in
    ``.gz``. A file without a byte holds no page.
    """
    declared = [*spec.partitions, "batch_id"]
    raw = (
        spark.read.format("binaryFile")
        .option("basePath", dataset_path(base, spec))
        .option("recursiveFileLookup", "false")
        .load(season_paths(spark, base, spec, season))
    )
    path = F.col("_metadata.file_path")
    # Keys are taken from the path as text, as folders of digits would be guessed to be numbers.
    keys = [F.regexp_extract(path, rf"/{k}=([^/]+)/", 1).alias(k) for k in declared]
    files = raw.select(*keys, path.alias("_file_path"), "content")
    schema = ", ".join(f"`{c}` string" for c in files.columns[:-1])
    whole = files.mapInArrow(_unpacked, f"{schema}, body binary, packed boolean")
    text = F.try_validate_utf8(F.col("body").cast("string"))
    number = F.coalesce(
        F.regexp_extract("_file_path", r"page_(\d+)\.json", 1).try_cast("int"),
        F.get_json_object(text, "$.metadata.page").try_cast("int"),
        F.lit(1),
    )
    path_keys = [
        (F.col(k).try_cast("int") if k in spec.partitions else F.lit(None).cast("int")).alias(f"_p_{k}")
        for k in ("season", "round")
    ]
    verdict = F.when(F.col("body").isNull(), "bad_gzip").when(text.isNull(), "not_text").otherwise("ok")
    return whole.select(
        *path_keys,
        "batch_id",
        number.alias("page"),
        "_file_path",
        text.alias("value"),
        F.when(F.col("packed"), "gzip").otherwise("plain").alias("codec"),
        verdict.alias("body_verdict"),
        (F.col("packed") != F.col("_file_path").endswith(".gz")).alias("mislabelled"),
    )
