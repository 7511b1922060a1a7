"""From a parsed page to its list of records, keeping the keys of the objects above them.

Everything here is SQL text over a VARIANT named in the arguments, as in ``functions.coerce``.
"""

from __future__ import annotations

from smeltery.functions.coerce import let
from smeltery.sources.models import SCALARS, Dataset, Field, Level

VARIANTS = "array<variant>"


def response_root(document: str) -> str:
    """``data.MRData`` of an enveloped page, ``MRData`` of a bare response, else the document."""
    return (
        f"coalesce(try_variant_get({document}, '$.data.MRData', 'variant'), "
        f"try_variant_get({document}, '$.MRData', 'variant'), {document})"
    )


def present(owner: str, names: tuple[str, ...]) -> str:
    """The first of several spellings of a key; SQL NULL when none is there."""
    found = [f"try_variant_get({owner}, '$.{name}', 'variant')" for name in names]
    return found[0] if len(found) == 1 else f"coalesce({', '.join(found)})"


def list_at(owner: str, path: str) -> str:
    return f"try_variant_get({owner}, '$.{path}', '{VARIANTS}')"


def _inherited(element: str, fields: tuple[Field, ...], above: str | None) -> str:
    parts = [
        f"'{f.name}', " + let(present(element, f.json_names), "_k", SCALARS[f.kind][1]("_k")) for f in fields
    ]
    return f"named_struct({', '.join(parts + ([f"'above', {above}"] if above else []))})"


def _walk(owner: str, levels: tuple[Level, ...], above: str | None) -> str:
    level, deeper = levels[0], levels[1:]
    if not deeper:
        carried = f", 'above', {above}" if above else ""
        return f"transform({list_at(owner, level.path)}, _r -> named_struct('record', _r{carried}))"
    element, keys = f"_e{len(deeper)}", f"_a{len(deeper)}"
    if level.inherit:
        # Bound once per element: inside the record lambda the keys would be read per record.
        inner = let(_inherited(element, level.inherit, above), keys, _walk(element, deeper, keys))
    else:
        inner = _walk(element, deeper, above)
    return f"flatten(transform({list_at(owner, level.path)}, {element} -> coalesce({inner}, array())))"


def records_of(document: str, spec: Dataset) -> str:
    """Array of ``struct<record: variant, above: struct<inherited keys>>`` in document order."""
    return let(response_root(document), "_m", _walk("_m", spec.levels, None))


def inherited_key(entry: str, spec: Dataset, name: str) -> str:
    """An inherited key of a record: nearest level first, outer levels below ``above``."""
    keys = f"{entry}.above"
    for level in reversed([lv for lv in spec.levels if lv.inherit]):
        if name in (f.name for f in level.inherit):
            return f"{keys}.{name}"
        keys = f"{keys}.above"
    raise KeyError(name)


def leaf_items(document: str, spec: Dataset) -> str:
    """How many records the page really holds at the declared path."""
    return f"coalesce(size({records_of(document, spec)}), 0)"
