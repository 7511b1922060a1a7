"""Typed records, their errors, and the verdict on the page they came from.

A page is one row, so a page's records, error rate and verdict are worked out inside that row:
no shuffle, and a source with many pages is spread over tasks like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.functions.coerce import let
from smeltery.functions.documents import has_items
from smeltery.operators.extract import inherited_key, records_of
from smeltery.operators.plain import plain_list, plain_records
from smeltery.sources.models import SCALARS, Dataset, Field, ListOf, Model

# Fixed values of the threshold gate.
ERROR_THRESHOLD = 0.20
SMALL_PAGE = 5
SAMPLE_SIZE = 3
# Records of a page, where its response does not say.
DEFAULT_LIMIT = 100

ERRORS = "array<string>"
NO_ERRORS = f"CAST(array() AS {ERRORS})"


def _taken_apart(model: Model, record: str) -> str:
    """The object as structs of JSON values, one per spelling: JSON names, then output names."""
    json = ",".join(f"`{f.json_names[0]}`:variant" for f in model.fields)
    plain = ",".join(f"`{f.name}`:variant" for f in model.fields if len(f.json_names) > 1)
    parts = f"'json', try_cast({record} AS struct<{json}>)"
    if plain:
        parts += f", 'plain', try_cast({record} AS struct<{plain}>)"
    return f"named_struct({parts})"


def _raw(field: Field, raw: str) -> str:
    found = f"{raw}.json.`{field.json_names[0]}`"
    return found if len(field.json_names) == 1 else f"coalesce({found}, {raw}.plain.`{field.name}`)"


def _typed(field: Field, raw: str, where: str, depth: int) -> str:
    """A scalar's value, or ``struct<value, errors>`` of an object or of a list of objects."""
    value = _raw(field, raw)
    if isinstance(field.kind, Model):
        inner = checked(field.kind, value, where, depth + 1)
        return f"CASE WHEN {value} IS NOT NULL AND NOT is_variant_null({value}) THEN {inner} END"
    if isinstance(field.kind, ListOf):
        element, items = f"_x{depth}", f"_i{depth}"
        each = f"transform(try_cast({value} AS array<variant>), {element} -> {checked(field.kind.item, element, where, depth + 1)})"
        gathered = (
            f"named_struct('value', transform({items}, _v -> _v.value), "
            f"'errors', flatten(transform({items}, _v -> _v.errors)))"
        )
        return f"CASE WHEN try_cast({value} AS array<variant>) IS NOT NULL THEN {let(each, items, gathered)} END"
    coerced = SCALARS[field.kind][1](value)
    return field.normalise(coerced) if field.normalise else coerced


def _fault(field: Field, raw: str, typed: str, where: str) -> str:
    """All errors of one field; only worked out for records that have any."""
    value, own = _raw(field, raw), f"{typed}.`{field.name}`"
    absent = NO_ERRORS if field.optional else f"array('{where}: missing')"
    null = NO_ERRORS if field.optional else f"array('{where}: null')"
    if isinstance(field.kind, Model):
        rest = f"{own}.errors"
    elif isinstance(field.kind, ListOf):
        rest = f"CASE WHEN {own} IS NULL THEN array('{where}: not list') ELSE {own}.errors END"
    else:
        rest = f"CASE WHEN {own} IS NULL THEN array('{where}: not {field.kind}') ELSE {NO_ERRORS} END"
    return f"CASE WHEN {value} IS NULL THEN {absent} WHEN is_variant_null({value}) THEN {null} ELSE {rest} END"


def _fits(field: Field, raw: str, typed: str) -> str:
    own = f"{typed}.`{field.name}`"
    good = f"{own} IS NOT NULL"
    if not isinstance(field.kind, str):
        good = f"coalesce(size({own}.errors) = 0, false)"
    if field.optional:
        value = _raw(field, raw)
        return f"({good} OR {value} IS NULL OR is_variant_null({value}))"
    return good


def checked(model: Model, record: str, prefix: str = "", depth: int = 0) -> str:
    """SQL of ``struct<value, errors>`` of one JSON object: every field typed, every fault listed.

    The object is taken apart once, into a struct of JSON values; the fields are then typed from
    that struct, and errors are spelled out only where a field does not fit.
    """
    raw, typed = f"_j{depth}", f"_t{depth}"
    places = {f.name: f"{prefix}.{f.name}" if prefix else f.name for f in model.fields}
    fields = ", ".join(f"'{f.name}', {_typed(f, raw, places[f.name], depth)}" for f in model.fields)
    value = ", ".join(
        f"'{f.name}', {typed}.`{f.name}`" + ("" if isinstance(f.kind, str) else ".value") for f in model.fields
    )
    fits = " AND ".join(_fits(f, raw, typed) for f in model.fields)
    faults = ", ".join(_fault(f, raw, typed, places[f.name]) for f in model.fields)
    judged = (
        f"named_struct('value', named_struct({value}), "
        f"'errors', CASE WHEN {fits} THEN {NO_ERRORS} ELSE flatten(array({faults})) END)"
    )
    return let(_taken_apart(model, record), raw, let(f"named_struct({fields})", typed, judged))


def _check_all(document: str, quick: str, spec: Dataset) -> str:
    """SQL of the page's checked records, in document order.

    Records that were read as texts and fit (``quick``) are taken over if all of the page do; else those
    that do not, and all of other pages, are checked value by value.
    """
    keys = ", ".join(f"'{f.name}', {inherited_key('_n', spec, f.name)}" for f in spec.inherited)
    above = f"'above', named_struct({keys}), " if keys else ""
    judged = f"named_struct('index', _p, {above}'value', _c.value, 'errors', _c.errors)"

    def taken(entry: str) -> str:
        own = ", ".join(f"'{f.name}', {inherited_key(entry, spec, f.name)}" for f in spec.inherited)
        kept = f"'above', named_struct({own}), " if own else ""
        return f"named_struct('index', _p, {kept}'value', {entry}.value, 'errors', {NO_ERRORS})"

    each = let(checked(spec.model, "_n.record"), "_c", judged)
    exact = f"CASE WHEN get({quick}, _p).fits THEN {taken(f'get({quick}, _p)')} ELSE {each} END"
    return (
        f"CASE WHEN forall({quick}, _n -> _n.fits) THEN transform({quick}, (_n, _p) -> {taken('_n')}) "
        f"ELSE transform({records_of(document, spec)}, (_n, _p) -> {exact}) END"
    )


def response_text(body: str) -> Column:
    """The response inside an enveloped page, or a bare one, as JSON text."""
    return F.coalesce(F.get_json_object(body, "$.data.MRData"), F.get_json_object(body, "$.MRData"), F.col(body))


def reported_total(body: str) -> Column:
    """How many records the response says there are; 0 if it says nothing."""
    total = F.coalesce(
        F.get_json_object(body, "$.data.MRData.total"), F.get_json_object(body, "$.MRData.total")
    )
    return F.coalesce(total.try_cast("long"), F.lit(0))


def page_limit(body: str, default: int) -> Column:
    """How many records the response says a page holds at most."""
    limit = F.coalesce(
        F.get_json_object(body, "$.data.MRData.limit"), F.get_json_object(body, "$.MRData.limit")
    ).try_cast("long")
    return F.when(limit > 0, limit).otherwise(default)


def too_bad(total: Column, bad: Column, threshold: float) -> Column:
    """Whether a page has too many bad records, or any if it is small."""
    return (bad / total > threshold) | ((total < SMALL_PAGE) & (bad > 0))


def judge_pages(
    pages: DataFrame,
    spec: Dataset,
    threshold: float = ERROR_THRESHOLD,
    body: str = "value",
    gate: bool = False,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Replace the JSON text ``body`` by ``checked`` records, ``total``, ``bad`` and ``verdict``.

    Verdicts: ``ok``; ``empty`` (no records, nothing to write); ``rejected`` (too many bad records,
    or any in a small page); ``no_rows`` (nothing valid is left); ``invalid_json``. With ``gate`` a page
    that reports records but has none is ``incomplete`` if some other list of it holds anything, else
    ``corrupt``, and the columns ``reported`` and ``per_page`` are added.
    """
    parsed = pages.withColumn("_document", F.try_parse_json(body))
    if gate:
        parsed = parsed.withColumns({"reported": reported_total(body), "per_page": page_limit(body, limit)})
    # Columns of their own: bound by names inside an expression they would be copied.
    kinds = parsed.withColumn("_kinds", F.schema_of_variant("_document"))
    read = kinds.withColumn("_quick", F.expr(plain_records(plain_list("_kinds", body, spec), spec)))
    checked_pages = read.withColumn("checked", F.expr(_check_all("_document", "_quick", spec)))
    counted = checked_pages.withColumn(
        "total", F.coalesce(F.size("checked"), F.lit(0)).cast("long")
    ).withColumn(
        "bad",
        F.coalesce(F.size(F.filter("checked", lambda r: F.size(r["errors"]) > 0)), F.lit(0)).cast("long"),
    )
    total, bad = F.col("total"), F.col("bad")
    verdict = F.when(F.col("_document").isNull(), "invalid_json")
    if gate:
        lost = (total == 0) & (F.col("reported") > 0)
        verdict = verdict.when(lost & has_items(response_text(body)), "incomplete").when(lost, "corrupt")
    verdict = (
        verdict.when(total == 0, "empty")
        .when(too_bad(total, bad, threshold), "rejected")
        .when(bad == total, "no_rows")
        .otherwise("ok")
    )
    return counted.withColumn("verdict", verdict).drop("_document", "_kinds", "_quick", body)


def _unpacked(judged: DataFrame, keep: Column, outputs: list[Column], keys: list[str]) -> DataFrame:
    # The list is built inside the generator on purpose: a filter on the row would be pushed down
    # and run the whole check a second time.
    rows = judged.select(*keys, F.explode(keep).alias("_r"))
    return rows.select(*keys, *outputs)


def page_keys(judged: DataFrame) -> list[str]:
    return [c for c in judged.columns if c not in ("checked", "total", "bad", "verdict", "reported", "per_page")]


def valid_records(judged: DataFrame, spec: Dataset) -> DataFrame:
    """Typed records of the pages that passed, one struct column per model field."""
    keep = F.when(
        F.col("verdict") == "ok", F.filter("checked", lambda r: F.size(r["errors"]) == 0)
    )
    own = {f.name for f in spec.model.fields}
    outputs = [F.col(f"_r.value.{f.name}").alias(f.name) for f in spec.model.fields]
    for f in spec.inherited:
        if f.name not in own:
            outputs.append(F.col(f"_r.above.{f.name}").alias(f"_above_{f.name}"))
    outputs.append(F.col("_r.index").alias("_record_index"))
    return _unpacked(judged, keep, outputs, page_keys(judged))


def quarantined_records(judged: DataFrame) -> DataFrame:
    """Every bad record with its index and all its errors, whatever the page's verdict."""
    keep = F.filter("checked", lambda r: F.size(r["errors"]) > 0)
    outputs = [
        F.col("_r.index").alias("record_index"),
        F.col("_r.errors").alias("errors"),
    ]
    return _unpacked(judged, F.when(F.col("bad") > 0, keep), outputs, page_keys(judged))


def error_samples(judged: DataFrame, count: int = SAMPLE_SIZE) -> DataFrame:
    """The first few bad records of every page, in record order."""
    bad = F.filter("checked", lambda r: F.size(r["errors"]) > 0)
    outputs = [F.col("_r.index").alias("record_index"), F.col("_r.errors").alias("errors")]
    return _unpacked(judged, F.when(F.col("bad") > 0, F.slice(bad, 1, count)), outputs, page_keys(judged))


def page_verdicts(judged: DataFrame) -> DataFrame:
    return judged.select(
        *page_keys(judged),
        "total",
        "bad",
        F.when(F.col("total") > 0, F.col("bad") / F.col("total")).alias("error_rate"),
        "verdict",
    )
