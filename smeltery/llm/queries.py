"""The registered queries of the package: each operator over its whole table, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.catalog.registry import Query, Tables
from smeltery.llm import sql
from smeltery.llm.common import lowered_ascii, prepared
from smeltery.llm.exact_dedup import exact_duplicates
from smeltery.llm.jaccard_join import jaccard_classes
from smeltery.llm.language import language
from smeltery.llm.line_dedup import without_repeated_lines
from smeltery.llm.merkle import merkle_manifest
from smeltery.llm.packing import packed
from smeltery.llm.pieces import decoded, encoded
from smeltery.llm.pii import BASE, KEEP_FROM, KINDS, LENGTHS, MADE_UP, personal_data
from smeltery.llm.quality import quality
from smeltery.llm.sharding import placed
from smeltery.llm.topk import nearest
from smeltery.llm.toxicity import toxicity
from smeltery.llm.variants import spelling_variants

LLM_QUERIES: dict[str, Query] = {}


def _query(text: str | None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(prepared(spark), folder))

        LLM_QUERIES[build.__name__] = Query(build.__name__, run, text)
        return build

    return register


@_query(sql.LINE_DEDUP)
def op3_line_dedup(t: Tables) -> DataFrame:
    return without_repeated_lines(t.documents).select("doc_id", "text", "n_lines", "n_removed")


def _of_kind(name: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == name


@_query(None)
def op7_packing(t: Tables) -> DataFrame:
    return packed(t.documents, path("word_bpe_49k.json"))


@_query(sql.pii(KINDS, BASE, LENGTHS, MADE_UP, KEEP_FROM))
def op8_pii(t: Tables) -> DataFrame:
    base = {k.name for k in BASE}

    def joined(spans):
        return F.concat_ws(
            ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        )

    ours = F.filter("spans", lambda s: s["kind"].isin(*sorted(base)))
    return personal_data(t.documents).select(
        F.col("id").alias("doc_id"),
        *[
            F.size(F.filter("spans", _of_kind(k.name))).cast("long").alias(f"n_{k.name}")
            for k in BASE
        ],
        F.sha2(joined(ours), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.concat_ws(",", F.transform("spans", lambda s: s["score"].cast("string"))).alias("scores"),
    )


@_query(sql.EXACT_DEDUP)
def op9_exact_dedup(t: Tables) -> DataFrame:
    return exact_duplicates(t.documents)


@_query(None)
def op10_toxicity(t: Tables) -> DataFrame:
    return toxicity(t.documents, t.labels)


@_query(None)
def op4_jaccard_join(t: Tables) -> DataFrame:
    return jaccard_classes(t.documents)


@_query(sql.TOP_K)
def op1_topk(t: Tables) -> DataFrame:
    return nearest(t.embeddings, F.col("vec_id") % 50 == 0, 5)


@_query(None)
def op2_language(t: Tables) -> DataFrame:
    return language(t.documents).withColumn("languages", F.concat_ws(",", "languages"))


@_query(None)
def op6_quality(t: Tables) -> DataFrame:
    """Grades: 0 of bad quality, 1 good but toxic, 2 good and not toxic."""
    return quality(t.documents, t.labels, F.col("quality") * (2 - F.col("toxic")), levels=3)


@_query(None)
def op5_pieces(t: Tables) -> DataFrame:
    """Each text encoded with dropout and decoded again: its pieces, and whether the text came back."""
    model = path("piece_bpe_32k.model")
    both = decoded(encoded(t.documents.select("doc_id", "text"), model, seed=17), model)
    return both.select(
        "doc_id",
        F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("piece_ids").alias("ids_hash"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


@_query(sql.VARIANTS)
def op11_variants(t: Tables) -> DataFrame:
    """Words as written but for a code point deleted here and there, picked by a checksum."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    mark = F.crc32(named.cast("binary"))
    at = (mark % F.char_length("run")).cast("int")
    shorter = F.concat(F.left("run", at), F.substring("run", at + 2, F.char_length("run")))
    return spelling_variants(t.documents, F.when(mark % 199 == 0, shorter).otherwise(F.col("run")))


@_query(sql.MERKLE)
def op12_manifest(t: Tables) -> DataFrame:
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle_manifest(t.documents, marked, lowered_ascii(F.col("text")))


@_query(None)
def op13_shards(t: Tables) -> DataFrame:
    return placed(t.documents, 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
