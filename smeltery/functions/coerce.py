"""Lenient scalar coercion of JSON values, and typed parsing of the texts kept in Silver.

The JSON coercions are SQL expression templates: each takes the SQL of a VARIANT and gives the SQL
of the value, NULL where the type does not accept it (whether that is an error is for the
validator, which also knows if the field was there). A dataset has hundreds of such expressions;
as text the engine parses them in one go, where building them call by call takes seconds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number spellings the coercion contract accepts.
INT_TEXT = r"^\s*[+-]?\d+(_\d+)*(\.0+)?\s*$"
FLOAT_TEXT = (
    r"(?i)^\s*[+-]?((\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|nan|inf|infinity)\s*$"
)
# Timestamp spellings tried after the ISO forms.
EXTRA_TIMESTAMP_FORMATS = (
    "yyyyMMdd'T'HHmmss",
    "yyyyMMddHHmmss",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
)
DURATION_TEXT = r"^\s*(\d+:){0,2}\d+(\.\d+)?\s*$"
BLANKS = r"[\s\x1c-\x1f]"
CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"


def let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def int_of_text(text: str) -> str:
    """Whole number from a text; plain spellings, by far the most, take the first branch."""
    # Spellings are checked before the cast: one that fails raises and catches inside, which costs
    # more than all the rest.
    digits = rf"regexp_replace(regexp_replace({text}, r'[\s_]', ''), r'\.0+$', '')"
    plain = rf"r'^\s*[+-]?\d{{1,18}}(\.0+)?\s*$'"
    return rf"""CASE WHEN {text} RLIKE {plain} THEN try_cast(substring_index({text}, '.', 1) AS BIGINT)
        WHEN {text} RLIKE r'{INT_TEXT}' THEN try_cast({digits} AS BIGINT) END"""


def float_of_text(text: str) -> str:
    """Number from a text; plain spellings take the first branch."""
    return rf"""CASE WHEN {text} RLIKE r'^[+-]?\d+(\.\d+)?$' THEN try_cast({text} AS DOUBLE)
        WHEN {text} RLIKE r'{FLOAT_TEXT}' THEN try_cast(regexp_replace({text}, r'[\s_]', '') AS DOUBLE) END"""


def lax_int(value: str) -> str:
    """Whole number from a JSON string, number or boolean."""
    kind = f"schema_of_variant({value})"
    number = f"try_cast({value} AS DOUBLE)"
    return f"""CASE {kind} WHEN 'STRING' THEN {let(f"try_cast({value} AS STRING)", "_n", int_of_text("_n"))}
        WHEN 'BIGINT' THEN CAST({value} AS BIGINT)
        WHEN 'BOOLEAN' THEN CAST(CAST({value} AS INT) AS BIGINT)
        ELSE CASE WHEN startswith({kind}, 'D') AND {number} = floor({number}) AND abs({number}) < pow(2D, 63D)
            THEN CAST({number} AS BIGINT) END END"""


def lax_float(value: str) -> str:
    """Number from a JSON string, number or boolean."""
    kind = f"schema_of_variant({value})"
    return f"""CASE {kind} WHEN 'STRING' THEN {let(f"try_cast({value} AS STRING)", "_n", float_of_text("_n"))}
        WHEN 'BIGINT' THEN CAST({value} AS DOUBLE)
        WHEN 'BOOLEAN' THEN CAST(CAST({value} AS INT) AS DOUBLE)
        ELSE CASE WHEN startswith({kind}, 'D') THEN CAST({value} AS DOUBLE) END END"""


def strict_str(value: str) -> str:
    """Only a JSON string is a string; the empty one counts."""
    return f"CASE WHEN schema_of_variant({value}) = 'STRING' THEN try_cast({value} AS STRING) END"


def clean_str(text: str) -> str:
    """Title-case every run of cased letters, then strip; NULL and '' pass through."""
    runs = f"regexp_extract_all(_s, r'([{CASED}]+|[^{CASED}]+)', 0)"
    titled = f"transform({runs}, _w -> concat(upper(substr(_w, 1, 1)), lower(substr(_w, 2))))"
    stripped = f"regexp_replace(array_join({titled}, ''), r'(?U)^{BLANKS}+|{BLANKS}+$', '')"
    # Words of plain letters need no taking apart.
    words = "WHEN _s RLIKE '^[A-Za-z ]*[A-Za-z ]\\\\z' THEN trim(initcap(_s))"
    return let(text, "_s", f"CASE WHEN _s RLIKE '^([A-Z][a-z]*)?$' THEN _s {words} ELSE {stripped} END")


def null_if_blank(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def best_effort_timestamp(text: Column, strict: bool = False) -> Column:
    """Second-precision timestamp from any known spelling; ``strict`` raises on the unparseable."""
    attempts = [F.when(text.rlike(r"^\d{9,10}$"), F.timestamp_seconds(text.try_cast("long")))]
    attempts.append(F.when(~text.rlike(r"^\d+$"), F.try_to_timestamp(text)))
    attempts += [F.try_to_timestamp(text, F.lit(fmt)) for fmt in EXTRA_TIMESTAMP_FORMATS]
    parsed = F.date_trunc("second", F.coalesce(*attempts))
    if not strict:
        return parsed
    return F.when(text.isNull(), F.lit(None).cast("timestamp")).otherwise(
        F.coalesce(
            parsed,
            F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp"),
        )
    )


def duration_ms(text: Column) -> Column:
    """``23.456``, ``1:23.456`` and ``1:29:18.303`` to milliseconds; anything else is NULL."""
    parts = F.split(F.trim(text), ":")

    def part(position: int) -> Column:
        return F.coalesce(F.try_element_at(parts, F.lit(position)).try_cast("long"), F.lit(0))

    millis = (F.try_element_at(parts, F.lit(-1)).try_cast("decimal(18,3)") * 1000).cast("long")
    return F.when(text.rlike(DURATION_TEXT), (part(-3) * 3600 + part(-2) * 60) * 1000 + millis)


def iso_date(text: Column) -> Column:
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}\s*$"), F.trim(text).try_cast("date"))
