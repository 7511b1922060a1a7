"""Validation of random records against the public validation library it is specified by."""

import json
import random

import pytest
from pyspark.sql import functions as F

from smeltery.operators.validate import checked
from smeltery.sources.models import ListOf, Model
from smeltery.sources.registry import DATASETS

pydantic = pytest.importorskip("pydantic")

SCALARS = {"int": int, "float": float, "str": str}
ODD = [None, "", " 7 ", "1.0", "1_000", "1.5", "5d", "1e3", "x", 3, 3.0, 3.5, True, [], {}, [1], {"a": 1}, "true", "-0", "Ünïted-kingdom o'x"]


def library_model(model: Model, name: str = "M"):
    fields = {}
    for f in model.fields:
        if isinstance(f.kind, Model):
            kind = library_model(f.kind)
        elif isinstance(f.kind, ListOf):
            kind = list[library_model(f.kind.item)]
        else:
            kind = SCALARS[f.kind]
        default = None if f.optional else ...
        fields[f.name] = (kind | None if f.optional else kind, pydantic.Field(default, alias=f.json_names[0]))
    return pydantic.create_model(name, __config__=pydantic.ConfigDict(populate_by_name=True, extra="ignore"), **fields)


def good(model: Model, rng: random.Random):
    record = {}
    for f in model.fields:
        if f.optional and rng.random() < 0.3:
            continue
        if isinstance(f.kind, Model):
            value = good(f.kind, rng)
        elif isinstance(f.kind, ListOf):
            value = [good(f.kind.item, rng) for _ in range(rng.randrange(3))]
        else:
            value = {"int": str(rng.randrange(99)), "float": f"{rng.randrange(99)}.5", "str": "red bull"}[f.kind]
        record[f.json_names[-1] if rng.random() < 0.15 else f.json_names[0]] = value
    return record


def spoil(value, rng: random.Random):
    """Replace or drop one value somewhere in the record."""
    if not isinstance(value, dict) or not value:
        return rng.choice(ODD)
    key = rng.choice(list(value))
    inner = value[key]
    if isinstance(inner, dict) and rng.random() < 0.7:
        return {**value, key: spoil(inner, rng)}
    if isinstance(inner, list) and inner and rng.random() < 0.7:
        return {**value, key: [spoil(inner[0], rng), *inner[1:]]}
    if rng.random() < 0.15:
        return {k: v for k, v in value.items() if k != key}
    return {**value, key: rng.choice(ODD)}


def cleaned(model: Model, value):
    """The library's dump with the title-casing the dataset adds."""
    if value is None:
        return None
    out = {}
    for f in model.fields:
        v = value[f.name]
        if isinstance(f.kind, Model):
            v = cleaned(f.kind, v)
        elif isinstance(f.kind, ListOf):
            v = [cleaned(f.kind.item, x) for x in v]
        elif f.normalise and v:
            v = v.title().strip()
        out[f.name] = v
    return out


@pytest.mark.parametrize("name", ["results", "laps", "driverstandings", "races"])
def test_random_records(spark, name):
    model, rng = DATASETS[name].model, random.Random(name)
    records = [good(model, rng) for _ in range(250)]
    records = [spoil(r, rng) if i % 3 else r for i, r in enumerate(records)]
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, j string")
    parsed = frame.select("i", F.parse_json("j").alias("v")).select("i", F.expr(checked(model, "v")).alias("c"))
    ours = {r.i: r.c.asDict(recursive=True) for r in parsed.collect()}
    library = library_model(model)
    seen = set()
    for i, record in enumerate(records):
        try:
            expected = cleaned(model, library.model_validate(record).model_dump())
        except pydantic.ValidationError:
            expected = None
        found = None if ours[i]["errors"] else ours[i]["value"]
        assert found == expected, record
        seen.add(expected is None)
    assert seen == {True, False}
