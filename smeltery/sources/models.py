"""How a dataset's records look: fields, nested objects, nested lists, and where they sit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from smeltery.functions.coerce import clean_str, float_of_text, int_of_text, lax_float, lax_int, strict_str

# name of a scalar type -> (Spark type, SQL template of its coercion from a VARIANT)
SCALARS: dict[str, tuple[str, Callable[[str], str]]] = {
    "int": ("bigint", lax_int),
    "float": ("double", lax_float),
    "str": ("string", strict_str),
}
# The same coercions of a value whose JSON kind is known to fit, read as text.
TEXTS: dict[str, Callable[[str], str]] = {"int": int_of_text, "float": float_of_text, "str": lambda text: text}


@dataclass(frozen=True)
class Model:
    """A JSON object. At least one field is required, so a value of another kind never fits."""

    fields: tuple[Field, ...]

    def __post_init__(self) -> None:
        if all(f.optional for f in self.fields):
            raise ValueError("a model needs a required field")

    @property
    def ddl(self) -> str:
        return "struct<" + ",".join(f"`{f.name}`:{f.ddl}" for f in self.fields) + ">"


@dataclass(frozen=True)
class ListOf:
    item: Model

    @property
    def ddl(self) -> str:
        return f"array<{self.item.ddl}>"


@dataclass(frozen=True)
class Field:
    """One field: output name, kind, JSON name, whether it may be absent, and a normaliser.

    The normaliser maps the SQL of a typed value to the SQL of the cleaned one.
    """

    name: str
    kind: str | Model | ListOf
    alias: str | None = None
    optional: bool = False
    normalise: Callable[[str], str] | None = None

    @property
    def json_names(self) -> tuple[str, ...]:
        if self.alias is None or self.alias == self.name:
            return (self.name,)
        return (self.alias, self.name)

    @property
    def ddl(self) -> str:
        return SCALARS[self.kind][0] if isinstance(self.kind, str) else self.kind.ddl


@dataclass(frozen=True)
class Level:
    """One list on the way to the records, and the keys of its elements the records inherit."""

    path: str
    inherit: tuple[Field, ...] = ()


@dataclass(frozen=True)
class Dataset:
    name: str
    model: Model
    levels: tuple[Level, ...]
    natural_key: tuple[str, ...]
    group: str = "reference"
    url_pattern: str = ""
    has_season: bool = False
    has_round: bool = False
    paginated: bool = True
    phase: int = 1
    partitions: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        parts = ("season",) * self.has_season + ("round",) * self.has_round
        object.__setattr__(self, "partitions", parts)

    @property
    def inherited(self) -> tuple[Field, ...]:
        return tuple(f for level in self.levels for f in level.inherit)


def whole(name: str, alias: str | None = None, optional: bool = False) -> Field:
    return Field(name, "int", alias, optional)


def real(name: str, alias: str | None = None, optional: bool = False) -> Field:
    return Field(name, "float", alias, optional)


def text(name: str, alias: str | None = None, optional: bool = False) -> Field:
    return Field(name, "str", alias, optional)


def titled(name: str, alias: str | None = None) -> Field:
    return Field(name, "str", alias, normalise=clean_str)


def nested(name: str, alias: str, model: Model, optional: bool = False) -> Field:
    return Field(name, model, alias, optional)


def listed(name: str, alias: str, model: Model) -> Field:
    return Field(name, ListOf(model), alias)
