"""Pages read as texts give what pages taken apart value by value give, and the usual ones are read so."""

import json

import pytest
from pyspark.sql import functions as F

from smeltery.operators import validate
from smeltery.operators.plain import plain_list
from smeltery.operators.validate import judge_pages
from smeltery.sources.models import Dataset, Level, Model, listed, nested, real, text, titled, whole

LINE = Model((whole("n"), text("note", optional=True)))
CAR = Model((text("maker"), titled("country"), real("speed", optional=True)))
CARS = Dataset(
    "cars",
    Model((whole("key", "carKey"), real("points"), nested("car", "Car", CAR, optional=True), listed("lines", "Lines", LINE))),
    (Level("Table.Races", (whole("season"), whole("round"))), Level("Cars")),
    ("key",),
)
GOOD = {"carKey": "1", "points": "2.5", "Car": {"maker": "ä\"x", "country": " united kingdom"}, "Lines": [{"n": "1"}]}


def page(*records, **more):
    races = [{"season": "2024", "round": "05", "Cars": list(records)}, {"season": "2025", "round": "6", "Cars": list(records[:1])}, {"season": "2026", "round": "7"}]
    return {"metadata": {"page": 1, "tags": ["a"]}, "data": {"MRData": {"total": "3", "Table": {"Races": races}, **more}}}


PLAIN = {
    "good": page(GOOD, GOOD),
    "bare": page(GOOD)["data"],
    "whole numbers": page(GOOD | {"carKey": 12, "points": 3}),
    "null and absent": page(GOOD | {"Car": None}, {k: v for k, v in GOOD.items() if k != "Car"}, GOOD),
    "faults": page(GOOD, GOOD | {"carKey": "x"}, {"points": "1"}, GOOD | {"Lines": None}, None, GOOD | {"points": " 1_0e1 "}),
    "list faults": page(GOOD | {"Lines": [{"n": "1", "note": "a"}, {"note": "b"}, None]}, GOOD | {"Lines": []}),
    "unknown": page(GOOD | {"unknown": {"a b": [1.5, None]}}, limit="30", **{"odd, name: STRING": 1}),
    "no list": page(),
}
OTHER = {
    "mixed kinds": page(GOOD, GOOD | {"carKey": True}),
    "fraction": page(GOOD | {"carKey": 3.0, "points": 1.5}),
    "text from number": page(GOOD, GOOD | {"Car": {"maker": 5, "country": "x"}}),
    "text from object": page(GOOD | {"Car": {"maker": {"a": 1}, "country": "x"}}),
    "other spelling": page({"key" if k == "carKey" else k: v for k, v in GOOD.items()}),
    "object as list": page(GOOD | {"Car": [GOOD["Car"]]}),
    "both roots": page(GOOD) | {"MRData": page()["data"]["MRData"]},
    "no root": page(GOOD)["data"]["MRData"],
    "list as root": [GOOD],
}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(name, json.dumps(document)) for name, document in (PLAIN | OTHER).items()] + [("broken", '{"data":'), ("twice", '{"a":1,"a":2}')]
    return spark.createDataFrame(rows, "name string, value string")


def test_usual_pages_are_read_as_texts(pages):
    kinds = pages.withColumn("kinds", F.schema_of_variant(F.try_parse_json("value")))
    taken = kinds.withColumn("taken", F.expr(plain_list("kinds", "value", CARS)).isNotNull())
    assert {r.name for r in taken.where("taken").collect()} == set(PLAIN)


def test_texts_and_values_give_the_same(pages, monkeypatch):
    def judged():
        found = judge_pages(pages, CARS, 0.9, gate=True).orderBy("name")
        return [r.asDict(recursive=True) for r in found.collect()]

    quick = judged()
    monkeypatch.setattr(validate, "plain_list", lambda kinds, body, spec: plain_list("CAST(NULL AS STRING)", body, spec))
    exact = judged()
    assert quick == exact
    assert {r["verdict"] for r in quick} >= {"ok", "invalid_json"}
    assert sum(len(r["checked"] or []) for r in quick if r["name"] == "faults") == 7  # six, and the first once more
