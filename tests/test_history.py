"""Chunked windows, history and as-of joins against brute force, with one key holding most rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from smeltery.operators.dedupe import latest_by_key
from smeltery.operators.history import apply_snapshot, as_of, as_of_join, history
from smeltery.operators.ordered import carried_forward, descending_rank, neighbours
from smeltery.plans import gold


def skewed(spark, rows=600):
    rng = random.Random(5)
    data = [(0 if rng.random() < 0.7 else rng.randrange(1, 6), i, rng.choice("abc") if rng.random() < 0.8 else None) for i in range(rows)]
    return spark.createDataFrame(data, "k int, t int, v string"), data


def test_neighbours_equal_plain_windows(spark):
    frame, _ = skewed(spark)
    w = Window.partitionBy("k").orderBy("t")
    for forward, plain in ((False, F.lag), (True, F.lead)):
        ours = neighbours(frame, ["k"], ["t"], F.floor(F.col("t") / 7), ["v", "t"], "n_", forward)
        theirs = frame.select("k", "t", "v", plain("t").over(w).isNotNull(), plain("v").over(w), plain("t").over(w))
        assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, theirs.collect()), key=str)


def test_carried_forward_equals_plain_window(spark):
    frame, _ = skewed(spark)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ours = carried_forward(frame, ["k"], ["t"], F.floor(F.col("t") / 9), "v", "last")
    theirs = frame.select("*", F.last("v", True).over(w))
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, theirs.collect()), key=str)


def test_rank_equals_plain_window(spark):
    frame, _ = skewed(spark)
    scored = frame.select("k", "t", (F.col("t") * 37 % 101).alias("p"), (F.col("t") % 3).alias("w"))
    plain = scored.select("*", F.rank().over(Window.partitionBy("k").orderBy(F.desc("p"), F.desc("w"))))
    ours = descending_rank(scored, ["k"], ["p", "w"], "r")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_history_and_as_of_join_equal_brute_force(spark):
    frame, data = skewed(spark)
    versions = history(frame, ["k"], ["v"], "t", F.floor(F.col("t") / 11))
    last, open_, expected = {}, {}, []
    for k, t, v in data:
        if k not in last or last[k] != v:
            if k in open_:
                expected.append((*open_[k], t))
            open_[k] = (k, v, t)
        last[k] = v
    expected += [(*row, None) for row in open_.values()]
    found = [(r.k, r.v, r.valid_from, r.valid_to) for r in versions.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)

    facts = spark.createDataFrame([(k, t * 2 % 650, t) for k, t, _ in data] + [(99, 5, -1)], "k int, at int, id int")
    joined = as_of_join(facts, versions, ["k"], "at", ["v"], "floor(_at / 13)").collect()
    spans = {}
    for k, v, start, end in expected:
        spans.setdefault(k, []).append((start, end, v))
    assert len(joined) == len(data) + 1
    for r in joined:
        hits = [v for s, e, v in spans.get(r.k, []) if s <= r.at and (e is None or r.at < e)]
        assert r.v == (hits[0] if hits else None)


def test_closed_versions_do_not_reach_past_their_end(spark):
    dim = spark.createDataFrame([(1, "a", 0, 10), (1, "b", 20, None)], "k int, v string, valid_from int, valid_to int")
    facts = spark.createDataFrame([(1, t) for t in (0, 9, 10, 19, 20, 99)], "k int, at int")
    joined = as_of_join(facts, dim, ["k"], "at", ["v"], "floor(_at / 5)")
    assert {r.at: r.v for r in joined.collect()} == {0: "a", 9: "a", 10: None, 19: None, 20: "b", 99: "b"}
    assert [r.v for r in as_of(dim, F.lit(15)).collect()] == []


def test_snapshots_one_by_one_equal_history(spark):
    days = [{1: "a", 2: "x"}, {1: "b", 2: "x", 3: "n"}, {1: "b", 3: "m"}, {1: "a", 2: "y", 3: "m"}]
    rows = [(k, v, d) for d, snapshot in enumerate(days) for k, v in snapshot.items()]
    whole = history(spark.createDataFrame(rows, "k int, v string, at int"), ["k"], ["v"], "at", F.col("at"))
    dim = spark.createDataFrame([], "k int, v string, valid_from int, valid_to int")
    for d, snapshot in enumerate(days):
        dim = apply_snapshot(dim, spark.createDataFrame(list(snapshot.items()), "k int, v string"), ["k"], ["v"], F.lit(d))
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    pick = ("k", "v", "valid_from", "valid_to")
    assert sorted(map(tuple, dim.select(*pick).collect()), key=str) == sorted(map(tuple, whole.select(*pick).collect()), key=str)


def test_latest_by_key(spark):
    rows = [(1, "b1", 2), (1, "b2", 1), (1, "b2", 3), (2, "b1", 9), (None, "b1", 1)]
    frame = spark.createDataFrame(rows, "k int, batch_id string, page int")
    found = latest_by_key(frame, ["k"], ["batch_id", "page"]).collect()
    assert sorted(map(tuple, found), key=str) == [(1, "b2", 3), (2, "b1", 9), (None, "b1", 1)]


def test_standings_repeat_totals_of_rounds_sat_out(spark):
    rows = [(2024, 1, "a", 1, 25), (2024, 1, "b", 2, 18), (2024, 3, "b", 1, 25)]
    frame = spark.createDataFrame(rows, "season int, round int, driver_id string, final_position int, points int")
    table = gold.standings_by_round(frame).orderBy("round", "position").collect()
    assert [(r.round, r.driver_id, int(r.points), r.position) for r in table] == [
        (1, "a", 25, 1), (1, "b", 18, 2), (2, "a", 25, 1), (2, "b", 18, 2), (3, "b", 43, 1), (3, "a", 25, 2),
    ]


def test_only_race_results_make_wins(spark):
    schema = "season int, round int, driver_id string, final_position int, points double"
    races = spark.createDataFrame([(2024, 1, "a", 1, 25.0), (2024, 2, "a", 3, 15.0)], schema)
    sprints = spark.createDataFrame([(2024, 2, "a", 1, 8.0)], schema)
    poles = spark.createDataFrame([(2024, 1, "a", 1)], "season int, round int, driver_id string, final_position int")
    row = gold.driver_season_stats(races, poles, sprints).first()
    assert (float(row.total_points), row.races, row.wins, row.podiums, row.poles) == (48.0, 2, 1, 2, 1)
    assert float(gold.driver_season_stats(races, poles).first().total_points) == 40.0
