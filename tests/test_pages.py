"""Record discovery, validation, the threshold gate and flattening on small literal pages."""

import json

import pytest
from pyspark.sql import functions as F

from smeltery.functions.documents import first_record_list, has_items
from smeltery.operators.flatten import explode_lists, flatten
from smeltery.operators.quality import CorruptPagesError, page_payloads, require_no_corruption
from smeltery.operators.validate import judge_pages, page_verdicts, quarantined_records, valid_records
from smeltery.sources.models import Dataset, Level, Model, listed, text, titled, whole
from smeltery.sources.registry import DATASETS, dataset
from smeltery.sources.silver import silver_rows

SIMPLE = Dataset(
    "simple", Model((text("driver_id", "driverId"), titled("nationality"))), (Level("DriverTable.Drivers"),), ("driver_id",)
)
GOOD = {"driverId": "ada", "nationality": "dutch"}
BAD = {"lap": "none"}
DRIVER = {
    "driverId": "ada", "givenName": "Ada", "familyName": "V", "dateOfBirth": "1997-09-30", "nationality": " dutch", "url": "u",
}
TEAM = {"constructorId": "rb", "name": "RB", "nationality": "AUSTRIAN", "url": "u"}


def drivers(*records):
    return {"MRData": {"DriverTable": {"Drivers": list(records)}}}


def races(inner, records, **keys):
    return {"data": {"MRData": {"total": str(len(records)), "RaceTable": {"Races": [{"season": "2024", "round": "05", inner: records, **keys}]}}}}


def judge(spark, spec, *documents, threshold=0.20):
    rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return judge_pages(spark.createDataFrame(rows, "page int, value string"), spec, threshold)


def verdicts(judged):
    return [r.verdict for r in page_verdicts(judged).orderBy("page").collect()]


def test_dataset_lookup():
    assert dataset("DRIVERS") is DATASETS["drivers"]
    with pytest.raises(ValueError, match="no dataset"):
        dataset("invalid")


def test_bare_and_enveloped_documents(spark):
    judged = judge(spark, SIMPLE, drivers(GOOD), {"metadata": {"page": 1}, "data": drivers(GOOD)}, {"DriverTable": {"Drivers": [GOOD]}})
    assert [r.nationality for r in valid_records(judged, SIMPLE).collect()] == ["Dutch"] * 3


@pytest.mark.parametrize(
    ("document", "threshold", "expected"),
    [
        (drivers(GOOD, GOOD, BAD), 0.20, "rejected"),
        (drivers(BAD), 0.99, "rejected"),
        (drivers(GOOD, GOOD, GOOD, GOOD, BAD, BAD), 0.50, "ok"),
        (drivers(GOOD, GOOD, GOOD, GOOD, BAD), 0.20, "ok"),
        (drivers(BAD, BAD, BAD, BAD, BAD), 1.0, "no_rows"),
        ({"MRData": {"Note": "x"}}, 0.20, "empty"),
        ({"MRData": {"Nothing": []}}, 0.20, "empty"),
        ("invalid json", 0.20, "invalid_json"),
    ],
)
def test_gate(spark, document, threshold, expected):
    assert verdicts(judge(spark, SIMPLE, document, threshold=threshold)) == [expected]


def test_one_bad_page_does_not_stop_others(spark):
    judged = judge(spark, SIMPLE, drivers(BAD), drivers(GOOD))
    assert verdicts(judged) == ["rejected", "ok"]
    assert valid_records(judged, SIMPLE).count() == 1
    assert quarantined_records(judged).first().errors == ["driver_id: missing", "nationality: missing"]


def test_kept_rows_at_half(spark):
    judged = judge(spark, SIMPLE, drivers(GOOD, GOOD, GOOD, GOOD, BAD, BAD), threshold=0.50)
    assert valid_records(judged, SIMPLE).count() == 4


def test_nested_path_carries_keys(spark):
    laps = [{"number": "1", "Timings": [{"driverId": "a", "position": "1", "time": "1:21.3"}]}, {"number": "2", "Timings": []}]
    rows = silver_rows(judge(spark, DATASETS["laps"], races("Laps", laps)), DATASETS["laps"]).orderBy("number").collect()
    assert [(r.season, r.round, r.number, r.timings_driver_id) for r in rows] == [(2024, 5, 1, "a"), (2024, 5, 2, None)]


def test_validation_is_atomic_per_record(spark):
    laps = [{"number": "1", "Timings": [{"driverId": "a", "position": "1", "time": "t"}, {"driverId": "b", "position": "x", "time": "t"}]}]
    judged = judge(spark, DATASETS["laps"], races("Laps", laps))
    assert verdicts(judged) == ["rejected"]
    assert quarantined_records(judged).first().errors == ["timings.position: not int"]


def test_present_but_invalid_optional_object_rejects(spark):
    base = {"Driver": DRIVER, "Constructor": TEAM, "status": "Finished"}
    records = [base, {**base, "Time": {"millis": 1}}, {**base, "Time": None}, {**base, "Time": "1:02"}, {**base, "Driver": "ada"}, *[base] * 20]
    judged = judge(spark, DATASETS["results"], races("Results", records))
    bad = {r.record_index: r.errors for r in quarantined_records(judged).collect()}
    assert set(bad) == {1, 3, 4}
    assert bad[1] == ["time.time: missing"]
    assert "driver.driver_id: missing" in bad[4]


def test_columns_do_not_depend_on_the_data(spark):
    base = {"Driver": DRIVER, "Constructor": TEAM, "status": "Engine"}
    rows = silver_rows(judge(spark, DATASETS["results"], races("Results", [base])), DATASETS["results"])
    assert {"time_time", "time_millis", "fastest_lap_average_speed_speed"} <= set(rows.columns)
    assert rows.first().driver_nationality == "Dutch"
    assert len(rows.columns) == len(set(rows.columns))


def test_unknown_fields_go_and_both_names_count(spark):
    judged = judge(spark, SIMPLE, drivers({"driver_id": "x", "nationality": "a", "extra": 1}, {"driverId": "y", "driver_id": "z", "nationality": "b"}))
    rows = valid_records(judged, SIMPLE).orderBy("_record_index").collect()
    assert [r.driver_id for r in rows] == ["x", "y"]
    assert "extra" not in rows[0].asDict()


def test_explode_lists(spark):
    frame = spark.createDataFrame([(1, [(4, "p"), (5, "q")]), (2, [])], "id int, items array<struct<id:int,name:string>>")
    assert [tuple(r) for r in flatten(frame).collect()] == [(1, 4, "p"), (1, 5, "q"), (2, None, None)]
    assert explode_lists(frame, ["items"], keep_empty=False).count() == 2


def test_unequal_parallel_lists_raise(spark):
    frame = spark.createDataFrame([([1, 2], [3])], "a array<int>, b array<int>")
    with pytest.raises(Exception, match="unequal length"):
        flatten(frame).collect()


def nest(depth, value):
    for _ in range(depth):
        value = {"k": value}
    return json.dumps(value)


@pytest.mark.parametrize(
    ("document", "expected"),
    [('{"a":[]}', False), ('{"a":"[1]"}', False), ('{"a":{"b":[[]]}}', True), (nest(20, [1]), True), (nest(21, [1]), False), (nest(25, [1]), False), ("{}", False)],
)
def test_has_items(spark, document, expected):
    assert spark.createDataFrame([(document,)], "j string").select(has_items(F.col("j")).alias("h")).first().h is expected


@pytest.mark.parametrize(
    ("document", "expected"),
    [
        ({"outer": {"inner": [{"p": [{"q": "2"}]}]}}, [{"p": [{"q": "2"}]}]),
        ({"a": [1, {"b": [{"c": 1}]}], "d": [{"e": "]"}]}, [{"e": "]"}]),
        ({"a": [[{"b": 1}]], "c": {"d": [{"e": []}, {"f": [{"g": "}{"}]}]}}, [{"e": []}, {"f": [{"g": "}{"}]}]),
        ({"a": "[{", "b": []}, None),
        ({"a": {"b": {}}, "c": [{}]}, [{}]),
    ],
)
def test_first_record_list(spark, document, expected):
    row = spark.createDataFrame([(json.dumps(document),)], "j string").select(first_record_list(F.col("j")).alias("l")).first()
    assert (json.loads(row.l) if row.l else None) == expected


def test_long_strings_in_documents(spark):
    long = "x\\\"[{" * 150_000
    text = json.dumps({"a": long, "b": {"c": [{"d": long}]}})
    frame = spark.createDataFrame([(text,)], "j string")
    row = frame.select(has_items(F.col("j")).alias("h"), F.length(first_record_list(F.col("j"))).alias("n")).first()
    assert row.h and row.n == len(json.dumps([{"d": long}]))


def test_corrupt_pages_are_fatal(spark):
    documents = [
        {"MRData": {"total": "100", "DriverTable": {"Drivers": []}}},
        {"MRData": {"total": "0", "DriverTable": {"Drivers": []}}},
        {"MRData": {"total": "1", "Other": [{"x": 1}]}},
        {"MRData": {"total": "1", "DriverTable": {"Drivers": [GOOD]}}},
    ]
    rows = [(i, json.dumps(d)) for i, d in enumerate(documents)]
    payloads = page_payloads(spark.createDataFrame(rows, "page int, value string"), SIMPLE)
    assert [r.severity for r in payloads.orderBy("page").collect()] == ["corrupt", "ok", "incomplete", "ok"]
    with pytest.raises(CorruptPagesError):
        require_no_corruption(payloads)


def test_a_model_needs_a_required_field():
    with pytest.raises(ValueError, match="required"):
        Model((whole("x", optional=True),))
    assert listed("xs", "Xs", Model((whole("x"),))).ddl == "array<struct<`x`:bigint>>"
