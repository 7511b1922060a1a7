"""Pages whose values all have the kinds that the model names, read as texts.

Taking every value out of a VARIANT copies it several times and is most of a check's time. The kinds of
a whole page are told at once, though: where they are the declared ones (numbers may be texts), a page
is read by ``from_json`` with all scalars as texts and typed from these. What is not so, such as other
spellings of a name or numbers with a fraction, is left to ``validate``, which gives the same values.
"""

from __future__ import annotations

from smeltery.functions.coerce import clean_str
from smeltery.sources.models import TEXTS, Dataset, Field, Level, ListOf, Model

_NAME = r"(?:\w+|`[^`]*+`)"
_SCALAR = r"(?:STRING|BIGINT|BOOLEAN|DOUBLE|FLOAT|VOID|VARIANT|DECIMAL\(\d+,\d+\))"
# Kinds a scalar may have on a page. Whole numbers read as text are spelled as in texts.
_KINDS = {"int": "STRING|BIGINT", "float": "STRING|BIGINT", "str": "STRING"}


def _object(members: dict[str, str], excluded: tuple[str, ...], other: str) -> str:
    """Pattern of an object's kinds: named members of these kinds, and any others but the excluded."""
    known = "|".join((*members, *excluded))
    named = [f"{name}: {kind}" for name, kind in members.items()]
    rest = f"(?!(?:{known}): ){_NAME}: {other}"
    return f"OBJECT<(?:(?:{'|'.join([*named, rest])})(?:, |(?=>)))*+>"


def _others(depth: int = 2) -> str:
    """Kinds of what no model names."""
    if not depth:
        return _SCALAR
    inner = _others(depth - 1)
    return f"(?:{_SCALAR}|ARRAY<{inner}>|OBJECT<(?:{_NAME}: {inner}(?:, |(?=>)))*+>)"


def _kind(kind: str | Model | ListOf) -> str:
    if isinstance(kind, Model):
        return f"(?:{_model_kinds(kind.fields)}|VOID)"
    if isinstance(kind, ListOf):
        return f"(?:ARRAY<{_kind(kind.item)}>|VOID)"
    return f"(?:{_KINDS[kind]}|VOID)"


def _model_kinds(fields: tuple[Field, ...], more: dict[str, str] | None = None) -> str:
    members = {f.json_names[0]: _kind(f.kind) for f in fields} | (more or {})
    second = tuple(n for f in fields for n in f.json_names[1:] if n not in members)
    return _object(members, second, _others())


def _level_kinds(levels: tuple[Level, ...], model: Model) -> dict[str, str]:
    """Pattern of the first step to the records, by its name."""
    level, deeper = levels[0], levels[1:]
    element = _model_kinds(level.inherit, _level_kinds(deeper, model)) if deeper else _model_kinds(model.fields)
    kinds = f"(?:ARRAY<(?:{element}|VOID)>|VOID)"
    first, *steps = level.path.split(".")
    for name in reversed(steps):
        kinds = f"(?:{_object({name: kinds}, (), _others())}|VOID)"
    return {first: kinds}


def _patterns(spec: Dataset) -> tuple[str, str]:
    """Kinds of an enveloped page, and of a bare response."""
    response = _object(_level_kinds(spec.levels, spec.model), (), _others())
    enveloped = _object({"data": _object({"MRData": response}, (), _others())}, ("MRData",), _others())
    return enveloped, _object({"MRData": response}, ("data",), _others())


def _type(kind: str | Model | ListOf) -> str:
    if isinstance(kind, Model):
        return f"struct<{_fields(kind.fields)}>"
    return f"array<{_type(kind.item)}>" if isinstance(kind, ListOf) else "string"


def _fields(fields: tuple[Field, ...]) -> str:
    return ",".join(f"`{f.json_names[0]}`:{_type(f.kind)}" for f in fields)


def _level_type(levels: tuple[Level, ...], model: Model) -> str:
    level, deeper = levels[0], levels[1:]
    members = [_fields(level.inherit), _level_type(deeper, model)] if deeper else [_fields(model.fields)]
    inner = f"array<struct<{','.join(m for m in members if m)}>>"
    first, *steps = level.path.split(".")
    for name in reversed(steps):
        inner = f"struct<`{name}`:{inner}>"
    return f"`{first}`:{inner}"


def plain_list(kinds: str, body: str, spec: Dataset) -> str:
    """SQL of the outermost list of a page, scalars as texts; NULL unless all values have the declared kinds.

    ``kinds`` is what ``schema_of_variant`` says of the page, ``body`` its text.
    """
    response = f"struct<{_level_type(spec.levels, spec.model)}>"
    enveloped, bare = _patterns(spec)
    # A text that parsed as a VARIANT but not here stops the job rather than lose its records.
    strict = "map('mode', 'FAILFAST')"
    path = spec.levels[0].path
    return (
        f"CASE WHEN {kinds} RLIKE r'^{enveloped}$' "
        f"THEN from_json({body}, 'data struct<MRData:{response}>', {strict}).data.MRData.{path} "
        f"WHEN {kinds} RLIKE r'^{bare}$' THEN from_json({body}, 'MRData {response}', {strict}).MRData.{path} END"
    )


def _walk(items: str, levels: tuple[Level, ...], model: Model, above: str | None) -> str:
    level, deeper = levels[0], levels[1:]
    if not deeper:
        carried, kept = (f"'above', {above}, ", "'above', _t.above, ") if above else ("", "")
        typed = f"transform({items}, _r -> named_struct({carried}'texts', _r, 'value', {_value(model, '_r')}))"
        return f"transform({typed}, _t -> named_struct({kept}'value', _t.value, 'fits', {_fits(model, '_t.texts', '_t.value')}))"
    element = f"_e{len(deeper)}"
    if level.inherit:
        parts = [f"'{f.name}', {TEXTS[f.kind](f'{element}.`{f.json_names[0]}`')}" for f in level.inherit]
        above = f"named_struct({', '.join(parts + ([f"'above', {above}"] if above else []))})"
    inner = _walk(f"{element}.{deeper[0].path}", deeper, model, above)
    return f"flatten(transform({items}, {element} -> coalesce({inner}, array())))"


def plain_records(items: str, spec: Dataset) -> str:
    """SQL of ``struct<above, value, fits>`` of every record below a plain list, in document order.

    ``fits`` is false where the record has any fault. It is told from the typed record, so that every text is
    typed once; no other part is bound by a name of its own, as binding copies all below it.
    """
    return _walk(items, spec.levels, spec.model, None)


def _scalar(field: Field, text: str) -> str:
    value = TEXTS[field.kind](text)
    return field.normalise(value) if field.normalise else value


def _value(model: Model, record: str) -> str:
    parts = []
    for f in model.fields:
        text = f"{record}.`{f.json_names[0]}`"
        if isinstance(f.kind, Model):
            value = f"CASE WHEN {text} IS NOT NULL THEN {_value(f.kind, text)} END"
        elif isinstance(f.kind, ListOf):
            value = f"transform({text}, _x -> {_value(f.kind.item, '_x')})"
        else:
            value = _scalar(f, text)
        parts.append(f"'{f.name}', {value}")
    return f"named_struct({', '.join(parts)})"


def _fits(model: Model, record: str, typed: str) -> str:
    """SQL of whether every field is there and of its type, or optional and absent."""
    good = []
    for f in model.fields:
        text, own = f"{record}.`{f.json_names[0]}`", f"{typed}.`{f.name}`"
        if isinstance(f.kind, Model):
            fits = _fits(f.kind, text, own)
        elif isinstance(f.kind, ListOf):
            fits = f"forall(zip_with({text}, {own}, (_x, _y) -> {_fits(f.kind.item, '_x', '_y')}), _x -> _x)"
        elif f.kind == "str" and f.normalise in (None, clean_str):
            fits = f"{text} IS NOT NULL"
        else:
            fits = f"{own} IS NOT NULL"
        there = "" if isinstance(f.kind, str) else f"{text} IS NOT NULL AND "
        good.append(f"({text} IS NULL OR {fits})" if f.optional else f"({there}{fits})")
    return f"({' AND '.join(good)})"
