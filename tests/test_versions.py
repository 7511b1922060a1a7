"""Kept versions: Silver batches and pointers, states per round, bucketed dimensions."""

import os
import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from smeltery.plans import states
from smeltery.plans.dimension import Dimension, fold, read_changes, read_dimension
from smeltery.plans.silver_run import run_silver
from smeltery.session import scratch_path
from smeltery.sources.commits import commit, commits, next_number
from smeltery.sources.registry import DATASETS
from smeltery.sources.tables import remove
from smeltery.sources.versions import history, pointers, publish, read_version, roll_back, stored_batches, versions
from test_layers import body, write_page


def files_below(path):
    """Every data file below a folder with its time of change."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                whole = os.path.join(folder, name)
                found[os.path.relpath(whole, path)] = os.stat(whole).st_mtime_ns
    return found


# --- commits ---


def test_a_commit_counts_once_it_is_whole(spark, tmp_path):
    path, rows = f"{tmp_path}/log", spark.range(2)
    assert commits(spark, path) == [] and next_number(spark, path) == 1
    commit(rows, path, 1)
    with pytest.raises(Exception, match="exists"):
        commit(rows, path, 1)
    os.makedirs(f"{path}/commit=00000002")  # a writer that never ended
    assert commits(spark, path) == [1] and next_number(spark, path) == 3
    commit(rows, path, 3)
    assert commits(spark, path) == [1, 3] and commits(spark, path, until=2) == [1]


# --- Silver with its batches side by side ---

RACES = replace(DATASETS["driverstandings"], natural_key=("season", "round", "driver_driver_id"))
ROWS = "season long, round long, driver_driver_id string, points double, batch_id string, page int, _record_index int"


def rows_of(spark, *rows):
    return spark.createDataFrame([(*r, 1, i) for i, r in enumerate(rows)], ROWS)


def shown(spark, base, version=None):
    found = read_version(spark, base, RACES, version)
    return sorted((r["season"], r["round"], r["driver_driver_id"], r["points"], r["batch_id"]) for r in found.collect())


def test_rollback_of_silver(spark, tmp_path):
    base = str(tmp_path)
    first = publish(rows_of(spark, (2024, 1, "a", 1.0, "20240101"), (2024, 2, "a", 2.0, "20240101")), base, RACES)
    kept = files_below(base)
    second = publish(rows_of(spark, (2024, 1, "a", 9.0, "20240202"), (2024, 3, "b", 3.0, "20240202")), base, RACES)
    assert (first, second) == (1, 2) and versions(spark, base, RACES) == [1, 2]
    assert kept.items() <= files_below(base).items()  # nothing is written in place
    one = [(2024, 1, "a", 1.0, "20240101"), (2024, 2, "a", 2.0, "20240101")]
    two = [(2024, 1, "a", 9.0, "20240202"), (2024, 2, "a", 2.0, "20240101"), (2024, 3, "b", 3.0, "20240202")]
    assert shown(spark, base, 1) == one and shown(spark, base) == two
    # Back at the first: the round that came with the second is emptied; then forward again.
    third = roll_back(spark, base, RACES, version=1)
    assert shown(spark, base) == one and shown(spark, base, 2) == two
    fourth = roll_back(spark, base, RACES, version=2, only=F.col("round") == 1)
    assert shown(spark, base) == [two[0], one[1]]
    assert roll_back(spark, base, RACES, as_of_batch="20240101") == fourth + 1 == third + 2
    assert shown(spark, base) == one
    counts = {r["version"]: (r["moved"], r["emptied"], r["stored"]) for r in history(spark, base, RACES).collect()}
    assert counts == {1: (2, 0, 2), 2: (2, 0, 2), 3: (1, 1, 0), 4: (1, 0, 0), 5: (1, 0, 0)}
    for wrong in ({}, {"version": 1, "as_of_batch": "x"}, {"version": 77}):
        with pytest.raises(ValueError):
            roll_back(spark, base, RACES, **wrong)
    with pytest.raises(ValueError):
        read_version(spark, base, RACES, 77)


def test_published_batches_never_change(spark, tmp_path):
    base = str(tmp_path)
    rows = rows_of(spark, (2024, 1, "a", 1.0, "b2"), (2024, 1, "a", 2.0, "b2"), (2024, 1, "b", 1.0, "b2"))
    publish(rows, base, RACES)
    before = files_below(base)
    assert shown(spark, base) == [(2024, 1, "a", 2.0, "b2"), (2024, 1, "b", 1.0, "b2")]  # newest record of a key
    assert publish(rows_of(spark, (2024, 1, "a", 5.0, "b2")), base, RACES) is None
    assert files_below(base) == before
    # A batch older than the one that counts is stored, and can be gone back to.
    publish(rows_of(spark, (2024, 1, "a", 7.0, "b1"), (2024, 4, "a", 8.0, "b1")), base, RACES)
    assert shown(spark, base)[0][3] == 2.0 and shown(spark, base)[-1] == (2024, 4, "a", 8.0, "b1")
    assert stored_batches(spark, base, RACES).count() == 3
    roll_back(spark, base, RACES, as_of_batch="b1")
    assert shown(spark, base) == [(2024, 1, "a", 7.0, "b1"), (2024, 4, "a", 8.0, "b1")]
    assert publish(rows.limit(0), base, RACES) is None


def test_only_the_batches_that_count_are_read(spark, tmp_path):
    base = str(tmp_path)
    for batch in ("b1", "b2", "b3"):
        publish(rows_of(spark, *[(2024, r, d, 1.0, batch) for r in (1, 2) for d in "abc"]), base, RACES)
    roll_back(spark, base, RACES, version=1, only=F.col("round") == 1)
    now = read_version(spark, base, RACES)
    assert {(r["round"], r["batch_id"]) for r in now.collect()} == {(1, "b1"), (2, "b3")}
    assert "dynamicpruning" in now._jdf.queryExecution().executedPlan().toString()


def test_a_dataset_without_partitions(spark, tmp_path):
    base, spec = str(tmp_path), DATASETS["status"]
    schema = "status_id long, status string, batch_id string, page int, _record_index int"
    for batch, text in (("1", "old"), ("2", "new")):
        publish(spark.createDataFrame([(1, text, batch, 1, 0), (2, text, batch, 1, 1)], schema), base, spec)
    assert {r["status"] for r in read_version(spark, base, spec).collect()} == {"new"}
    roll_back(spark, base, spec, version=1)
    assert {(r["status"], r["batch_id"]) for r in read_version(spark, base, spec).collect()} == {("old", "1")}
    assert pointers(spark, base, spec).count() == 1


def test_a_run_keeps_its_batches(spark, tmp_path):
    """Two runs from Bronze, which is then gone; Silver goes back and forth without it."""
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    for batch in ("b1", "b2"):
        write_page(bronze, "constructors", batch, body("constructors"))
        run_silver(spark, bronze, silver, None, ["constructors"], whole_files=True, keep_batches=True)
    remove(spark, bronze)
    spec = DATASETS["constructors"]
    assert {r["batch_id"] for r in read_version(spark, silver, spec).collect()} == {"b2"}
    roll_back(spark, silver, spec, version=1)
    back = read_version(spark, silver, spec).collect()
    assert {r["batch_id"] for r in back} == {"b1"} and back[0]["name"]


# --- states per round ---


def scored(spark, rows):
    schema = "season long, round long, driver_id string, constructor_id string, final_position int, points decimal(18,2)"
    return states.scoring_rows(spark.createDataFrame([(*r[:5], Decimal(r[5])) for r in rows], schema))


def stats(spark, path):
    found = states.season_and_all_time(spark, path, states.DRIVERS).collect()
    return {(r["season"], r["driver_id"]): (float(r["total_points"]), r["races"], r["wins"], r["podiums"]) for r in found}


def test_states_follow_the_facts(spark, tmp_path):
    path = str(tmp_path)
    rows = [(2023, 1, "a", "t", 1, 25), (2023, 1, "b", "t", 2, 18), (2024, 1, "a", "t", 3, 15), (2024, 2, "b", "u", 1, 25)]
    first = states.refresh(scored(spark, rows), path, states.DRIVERS)
    assert {tuple(r) for r in first.collect()} == {(2023, 1, "new"), (2024, 1, "new"), (2024, 2, "new")}
    before = files_below(f"{path}/states")
    assert stats(spark, path)[(None, "a")] == (40.0, 2, 1, 2)
    # One round changes, one is new, one loses all its rows, one stays.
    rows = [rows[0], rows[1], (2024, 2, "b", "u", 2, 18), (2024, 3, "a", "t", 1, 25)]
    second = states.refresh(scored(spark, rows), path, states.DRIVERS)
    assert {tuple(r) for r in second.collect()} == {(2024, 1, "emptied"), (2024, 2, "changed"), (2024, 3, "new")}
    assert stats(spark, path) == {
        (2023, "a"): (25.0, 1, 1, 1), (2023, "b"): (18.0, 1, 0, 1), (2024, "a"): (25.0, 1, 1, 1), (2024, "b"): (18.0, 1, 0, 1),
        (None, "a"): (50.0, 2, 2, 2), (None, "b"): (36.0, 2, 0, 2),
    }
    after = files_below(f"{path}/states")
    stays = {n for n in before if "season=2023" in n}
    assert stays and all(after[n] == before[n] for n in stays)
    assert not {n for n in after if n in before} - stays
    # The same rows in another order change nothing; no rows empty everything.
    assert states.refresh(scored(spark, rows[::-1]), path, states.DRIVERS).count() == 0
    assert states.refresh(scored(spark, rows).limit(0), path, states.DRIVERS).count() == 3
    assert stats(spark, path) == {}


def test_a_refresh_that_broke_off_is_done_again(spark, tmp_path):
    path = str(tmp_path)
    rows = [(2024, 1, "a", "t", 1, 25), (2024, 2, "a", "t", 1, 25)]
    states.refresh(scored(spark, rows), path, states.DRIVERS)
    changed = scored(spark, [*rows[:1], (2024, 2, "a", "t", 2, 18)])
    states.refresh(changed, path, states.DRIVERS)
    last = max(os.listdir(f"{path}/prints"))
    os.remove(f"{path}/prints/{last}/_SUCCESS")  # as if the commit had not ended
    assert states.refresh(changed, path, states.DRIVERS).count() == 1
    assert stats(spark, path)[(None, "a")] == (43.0, 2, 1, 2)


def test_least_structs_merge(spark, tmp_path):
    path, schema = str(tmp_path), "season long, round long, circuit_id string, driver_id string, fastest_lap_time long"
    rows = [(2023, 1, "spa", "b", 90), (2023, 1, "spa", "a", 90), (2024, 9, "spa", "c", 80), (2024, 1, "ulm", "a", None)]
    states.refresh(spark.createDataFrame(rows, schema), path, states.CIRCUITS)
    states.refresh(spark.createDataFrame(rows[:2] + rows[3:], schema), path, states.CIRCUITS)
    found = {(r["season"], r["circuit_id"]): r for r in states.season_and_all_time(spark, path, states.CIRCUITS).collect()}
    assert found[(None, "spa")]["best"]["driver_id"] == "a" and found[(None, "spa")]["timed"] == 2
    assert found[(2024, "ulm")]["best"] is None and (2024, "spa") not in found


# --- dimensions in buckets ---


def plain_history(snapshots, keys):
    """Versions of all snapshots in the order of their moments: ``(key, value, from, to)``."""
    out = []
    for key in keys:
        told = []
        for at, rows, complete in sorted(snapshots, key=lambda s: s[0]):
            if key in rows:
                told.append((at, True, rows[key]))
            elif complete:
                told.append((at, False, None))
        kept = [t for i, t in enumerate(told) if i == 0 or t[1:] != told[i - 1][1:]]
        for i, (at, there, value) in enumerate(kept):
            if there:
                out.append((key, value, at, kept[i + 1][0] if i + 1 < len(kept) else None))
    return sorted(out, key=repr)


def frame_of(spark, rows):
    return spark.createDataFrame([(k, v, 1) for k, v in rows.items()], "id long, value string, other int")


def dimension(path, buckets=4):
    return Dimension(str(path), {"id": "bigint"}, {"value": "string"}, moment="int", buckets=buckets)


def held(spark, dim):
    found = read_dimension(spark, dim).collect()
    return sorted(((r["id"], r["value"], r["valid_from"], r["valid_to"]) for r in found), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_snapshots_in_any_order_give_one_history(spark, tmp_path, seed):
    draw, keys = random.Random(seed), range(12)
    snapshots = []
    for at in draw.sample(range(10, 70, 10), 6):
        rows = {k: draw.choice(("x", "y", None)) for k in keys if draw.random() < 0.6}
        snapshots.append((at, rows, draw.random() < 0.5))
    dim, changes = dimension(tmp_path), []
    for n, (at, rows, complete) in enumerate(snapshots, 1):
        changes.append(fold(frame_of(spark, rows), dim, at, complete).collect())
        assert held(spark, dim) == plain_history(snapshots[:n], keys), (snapshots[:n], n)
    # The change tables, applied one after the other, give the dimension.
    replayed = set()
    for rows in changes:
        version = lambda r: (r["id"], r["value"], r["valid_from"], r["valid_to"])
        replayed -= {version(r) for r in rows if r["change"] == "removed"}
        replayed |= {version(r) for r in rows if r["change"] == "opened"}
    assert sorted(replayed, key=repr) == held(spark, dim)
    assert read_changes(spark, dim).count() == sum(map(len, changes))


def test_only_touched_open_buckets_are_written(spark, tmp_path):
    dim = dimension(tmp_path, buckets=8)
    rows = {k: "x" for k in range(40)}
    fold(frame_of(spark, rows), dim, 10)
    before = files_below(f"{tmp_path}/versions")
    changes = fold(frame_of(spark, rows | {7: "y"}), dim, 20).collect()
    assert {(r["change"], r["reason"], r["value"], r["valid_from"], r["valid_to"]) for r in changes} == {
        ("removed", "update", "x", 10, None), ("opened", "update", "x", 10, 20), ("opened", "update", "y", 20, None),
    }
    after = files_below(f"{tmp_path}/versions")
    assert before.items() <= after.items()  # nothing in place
    new = sorted(n for n in after if n not in before)
    bucket = spark.createDataFrame([(7,)], "id long").select(dim.bucket()).first()[0]
    assert [n.rsplit("/", 1)[0] for n in new] == [f"part=closed/fold=2/bucket={bucket}", f"part=open/fold=2/bucket={bucket}"]
    # A snapshot that says nothing new writes no version at all.
    assert fold(frame_of(spark, rows | {7: "y"}), dim, 30).count() == 0
    assert files_below(f"{tmp_path}/versions") == after
    # A late one writes the buckets of the keys it contradicts.
    fold(frame_of(spark, {7: "z"}), dim, 15)
    late = sorted({n.rsplit("/", 1)[0] for n in files_below(f"{tmp_path}/versions") if n not in after})
    assert late == [f"part=closed/fold=4/bucket={bucket}", f"part=open/fold=4/bucket={bucket}"]
    assert [h[1:] for h in held(spark, dim) if h[0] == 7] == [("x", 10, 15), ("y", 20, None), ("z", 15, 20)]
    assert read_dimension(spark, dim, 1).count() == 40  # as the first fold left it


def test_deletes_and_edges_of_folds(spark, tmp_path):
    dim = dimension(tmp_path)
    fold(frame_of(spark, {1: "x", 2: "x", None: "x"}), dim, 10)
    gone = fold(frame_of(spark, {1: "x"}), dim, 20, complete=True).collect()
    assert {(r["id"], r["reason"]) for r in gone} == {(2, "delete")}
    fold(frame_of(spark, {2: "x"}), dim, 30)
    assert held(spark, dim) == [(1, "x", 10, None), (2, "x", 10, 20), (2, "x", 30, None)]
    fold(frame_of(spark, {}), dim, 40, complete=True)
    assert held(spark, dim) == [(1, "x", 10, 40), (2, "x", 10, 20), (2, "x", 30, 40)]
    with pytest.raises(ValueError):
        fold(frame_of(spark, {1: "x"}), dim, 40)
    assert read_dimension(spark, dimension(f"{tmp_path}/none")).count() == 0
    broken = next_number(spark, dim.log())
    os.makedirs(f"{tmp_path}/versions/part=open/fold={broken}/bucket=0")  # left by a fold that broke off
    fold(frame_of(spark, {1: "w"}), dim, 50)
    assert held(spark, dim)[1] == (1, "x", 10, 40) and (1, "w", 50, None) in held(spark, dim)
