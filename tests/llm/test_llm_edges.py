"""Nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import brute
from smeltery.llm import bpe, exact_dedup, jaccard_join, language, line_dedup, packing, pieces, pii, quality, topk, toxicity
from smeltery.llm.common import cut

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = "lorem ipsum dolor " * 30_000
CLASH = ("row", "id", "key", "set", "text_key", "covered", "owner", "lines", "n_lines", "place", "label", "sha", "print")
ROWS = [
    (1, "Alpha beta gamma\ndelta\nepsilon zeta", "en"),
    (2, "ALPHA beta gamma\ndelta\nepsilon zeta", "en"),
    (2, "ALPHA beta gamma\ndelta\nepsilon zeta", "en"),
    (3, "É alpha", None),
    (4, "é alpha", "fr"),
    (5, "", "fr"),
    (6, None, "de"),
    (None, "alone here", None),
    (None, None, None),
    (7, LONG, "en"),
    (8, "1234 !!", "de"),
]
LABELS = "doc_id long, toxic int, quality int"


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return cut(frame.withColumns({c: F.lit(7) for c in CLASH}))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, LABELS)


def test_exact_duplicates(docs, empty):
    found = exact_dedup.exact_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert (by_id[1]["keep_id"], by_id[1]["group_size"], by_id[1]["kept"]) == (2, 3, False)
    assert [r["kept"] for r in found if r["doc_id"] == 2].count(True) == 1
    assert by_id[3]["kept"] and by_id[4]["kept"]  # only A-Z are folded
    nothing = [r for r in found if r["text_sha256"].startswith("e3b0c44298fc")]
    assert len(nothing) == 3 and {r["keep_id"] for r in nothing} == {6} and sum(r["kept"] for r in nothing) == 1
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_filters_merge_without_loss():
    values = np.random.default_rng(1).integers(-(2**62), 2**62, 500)
    # Neighbours fill runs and push others on; the largest print lies past the last slot.
    values = np.concatenate((values, values[:50], values[:7], values[3] + np.arange(40), [-1, -1, 0, 2**63 - 1]))
    make = exact_dedup.CountingQuotientFilter
    expected = Counter(values.astype(np.int64).view(np.uint64).tolist())
    whole = make.of(values)
    prints, counts = whole.entries()
    assert dict(zip(prints.tolist(), counts.tolist(), strict=True)) == expected and (np.diff(prints) > 0).all()
    assert whole.shifted.any() and whole.continuation.any()
    parts = [make.of(part) for part in np.array_split(values, 9)]
    for merged in (make.merged(parts), make.merged(parts[::-1])):
        for name in ("remainders", "occupied", "continuation", "shifted", "counted", "counters"):
            assert (getattr(merged, name) == getattr(whole, name)).all()
    slices = [make.unpacked(p.packed()) for _, p in whole.slices(6)]
    deeper = [make.unpacked(p.packed()) for s in slices for _, p in s.slices(6)]
    for pieces_ in (slices, deeper):
        entries = [p.entries() for p in pieces_]
        assert (np.concatenate([e[0] for e in entries]) == prints).all()
        assert (np.concatenate([e[1] for e in entries]) == counts).all()
    empty = make.of(np.array([], np.int64))
    assert not len(empty.entries()[0]) and not list(empty.slices(6))
    assert (empty.merged_with(whole).entries()[0] == prints).all()


def test_filters_are_merged_in_levels(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FILTER_ROWS", 60)
    monkeypatch.setattr(exact_dedup, "SLICE_ROWS", 2)
    monkeypatch.setattr(exact_dedup, "LEVEL_BITS", 3)
    monkeypatch.setattr(exact_dedup, "LEVEL_FAN", 2)
    values = [v * 2**40 for v in range(-200, 200)] + [v * 2**40 for v in range(0, 90, 3)] * 2
    frame = spark.createDataFrame([(v,) for v in values], "print long").repartition(9)
    found = {r["print"]: r["count"] for r in exact_dedup.repeated_fingerprints(frame, len(values)).collect()}
    assert found == {v * 2**40: 3 for v in range(0, 90, 3)}
    marks = exact_dedup.marks_of(cut(spark.createDataFrame([(v,) for v in found], "print long")))
    assert marks.of(np.array(sorted(found))).all() and not marks.of(np.array([2**61, -(2**61)])).any()


@pytest.mark.parametrize("bits", [1, 3, 64])
def test_bytes_decide_where_fingerprints_collide(spark, bits):
    """Prints cut to one bit, or few, throw different texts together; only equal bytes are grouped."""
    texts = ["a", "A", "b", "B", "c", "é", "É", None, "", *[f"t{i % 25}" for i in range(60)], *[f"u{i}" for i in range(30)]]
    rows = list(enumerate(texts))
    frame = cut(spark.createDataFrame(rows, "doc_id long, text string"))
    found = exact_dedup.exact_duplicates(frame, print_bits=bits).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(exact_dedup.normal_bytes(t), []).append(i)
    for r in found:
        mine = groups[exact_dedup.normal_bytes(texts[r["doc_id"]])]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(mine), len(mine), r["doc_id"] == max(mine))
    assert len(found) == len(rows)


def test_line_windows(spark, docs, empty):
    found = line_dedup.without_repeated_lines(docs)
    assert found.count() == len(ROWS) and found.columns[-2:] == ["n_lines_", "n_removed"]
    assert line_dedup.without_repeated_lines(empty).count() == 0
    rows = [
        (1, "a\nb\nc\nd"),
        (2, "x\nb\nc\nd\ny"),
        (3, "a\na\na\na"),
        (4, "\n\n\n\n"),
        (5, None),
        (6, "b\nc"),
        (None, "q\na\nb\nc"),
        (7, "\n".join(f"l{i}" for i in range(3000))),
        (8, "\n".join(f"l{i}" for i in range(3000))),
        (9, "z\nz2\nz3"),
        (9, "z\nz2\nz3"),
    ]
    frame = cut(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r["doc_id"]): (r["text"], r["n_removed"]) for r in line_dedup.without_repeated_lines(frame).collect()}
    expected = brute.line_dedup([r for r in rows[:-1] if r[0] is not None])
    assert {i: got[i][0] for i in expected} == expected
    assert got[2] == ("x\ny", 3) and got[3][0] == "a" and got[None] == ("q", 3) and got[8] == ("", 3000)
    assert got[9] == ("z\nz2\nz3", 0)  # one row stored twice is one document


def test_near_duplicates(spark, docs, empty):
    assert jaccard_join.jaccard_classes(docs).count() == len(ROWS)
    assert jaccard_join.jaccard_classes(empty).count() == 0
    random.seed(4)
    base = [f"w{random.randrange(900)}" for _ in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(i % 9):
            words[random.randrange(200)] = f"v{i}"
        rows.append((i, " ".join(words)))
    rows += [(100, "one two"), (101, "One, two!"), (102, ""), (103, None), (104, "..."), (105, "one two three")]
    frame = cut(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_sets"]) for r in jaccard_join.jaccard_classes(frame).collect()}
    assert found == brute.near_classes(rows)
    kept = jaccard_join.without_near_duplicates(frame).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for c, _, _ in found.values()})


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    rows = [(i, " ".join(f"w{j}" for j in range(100)) + f" x{i}") for i in range(40)]
    frame = cut(spark.createDataFrame(rows, "doc_id long, text string"))
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    found = jaccard_join.jaccard_classes(frame).collect()
    assert {(r["class_id"], r["n_links"], r["n_sets"]) for r in found} == {(0, 39, 39)}


def test_posterior_pruning_keeps_pairs_at_the_threshold():
    for compared in (32, 96, 160):
        least = jaccard_join.least_matches(compared)
        lost = sum(math.comb(compared, m) * 0.8**m * 0.2 ** (compared - m) for m in range(least))
        assert 0.2 * compared < least < 0.8 * compared and lost < 1e-4


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(901, 900)], "node long, root long")
    found = {r["node"]: r["label"] for r in jaccard_join.components(edges).collect()}
    assert found == dict.fromkeys(range(301), 0) | {900: 900, 901: 900}


PII_TEXT = (
    "mail a.b@c.de.fr, x@y, é 1.2.3.4 and 300.1.1.1 card 4111 1111 1111 1111 or 4111111111111112, "
    "+1 (343) 555-6039 iban DE89 3704 0044 0532 0130 00 and \U0001f600 z@q.io_x@y.zz"
)


def test_personal_data(spark, docs, empty):
    assert pii.personal_data(docs).count() == len(ROWS) and pii.personal_data(empty).count() == 0
    many = " ".join(f"u{i}@h.com 10.0.0.{i % 300}" for i in range(1500))
    hard = ["a" * 50_000, "1" * 50_000, "a@" + "b." * 20_000, "+1" + "(" * 20_000, "a.b@" * 5_000, "1." * 20_000]
    rows = [(1, PII_TEXT), (2, None), (3, many), *[(10 + i, t) for i, t in enumerate(hard)]]
    frame = cut(spark.createDataFrame(rows, "doc_id long, text string"))
    kinds = ("EMAIL", "IP", "CARD", "PHONE", "IBAN")
    for r in pii.personal_data(frame).collect():
        text = dict(rows)[r["id"]]
        if r["id"] in (10, 11, 13):  # the plain patterns take too long on these
            assert r["spans"] == []
            continue
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"]] == brute.spans(text, kinds)
        assert all(s["value"] == text[s["start"] : s["end"]] for s in r["spans"])
        if r["id"] == 1:
            assert {s["kind"] for s in r["spans"]} == {"email", "ip", "card", "phone", "iban"}
            assert [s["score"] for s in r["spans"] if s["kind"] == "card"] == [pytest.approx(0.8)]
    out = {r["doc_id"]: r["text"] for r in pii.without_personal_data(frame.where("doc_id < 4")).collect()}
    assert out == {i: brute.masked(t) for i, t in rows[:3]}
    clash = pii.without_personal_data(docs)
    assert clash.columns == docs.columns and clash.count() == len(ROWS)


def test_words_nearby_decide_on_added_kinds(spark):
    number = "DE89 3704 0044 0532 0130 00"
    rows = [
        (1, f"Pay {number} now", 0.8), (2, f"my bank {number}", 0.9), (3, f"for example {number}", None),
        (4, f"an example account {number}", 0.5), (5, f"write to me@example.com, {number}", 0.8),
        (6, f"sample{'x' * 50} {number}", 0.8), (7, f"{number} (Beispiel)", None),
    ]
    frame = cut(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    found = {r["id"]: [s["score"] for s in r["spans"] if s["kind"] == "iban"] for r in pii.personal_data(frame).collect()}
    assert found == {i: [] if s is None else [s] for i, _, s in rows}
    masked = {r["doc_id"]: r["text"] for r in pii.without_personal_data(frame).collect()}
    assert {i for i, t in masked.items() if "[IBAN]" in t} == {1, 2, 4, 5, 6}
    assert masked == {i: brute.masked(t) for i, t, _ in rows}
    card = cut(spark.createDataFrame([(1, "for example 4111 1111 1111 1111")], "doc_id long, text string"))
    assert [s["score"] for s in pii.personal_data(card).first()["spans"]] == [pytest.approx(0.3)]  # base kinds stay


def test_packing(spark, docs, empty):
    found = packing.packed(docs, WORDS).collect()
    assert sum(r["length"] for r in found if r["doc_id"] == 5) == 1
    assert len([r for r in found if r["doc_id"] is None]) == 2
    assert packing.packed(empty, WORDS).count() == 0
    encode = packing.encoder(WORDS)
    odd = ["İstanbul ΣΑΣ don't", "x\x1cy", "é é", "’s it's 12½²", "a" * 90, "ÀÉ µª ×÷ 's''t", "🙂 ok", ""]
    plain = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in odd]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(odd)] == plain


def test_fill_is_the_best_there_is():
    random.seed(2)
    for _ in range(60):
        lengths = [random.randrange(1, 40) for _ in range(8)]
        counts = {k: lengths.count(k) for k in lengths}
        room = random.randrange(0, 90)
        chosen = packing.best_fill(sorted(counts), counts, room)
        best = max(s for s in (sum(x for i, x in enumerate(lengths) if m >> i & 1) for m in range(256)) if s <= room)
        assert sum(k * n for k, n in chosen.items()) == best
        assert all(n <= counts[k] for k, n in chosen.items())


def test_top_k(spark):
    rows = [(i, [float(i % 5), 0.0, -1.5][: 1 + i % 3]) for i in range(40)]
    rows += [(40, None), (41, [1.0, None]), (42, [float("nan")]), (43, [float("inf")]), (None, [1.0]), (44, [])]
    frame = cut(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)))
    found = topk.nearest(frame, F.col("vec_id") % 7 == 0, 5).collect()
    whole = {
        i: [math.floor(256 * x) for x in v]
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    for q in {r["query_id"] for r in found}:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        assert [(-r["score"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == scores[:5]
    assert {r["query_id"] for r in found} == {0, 7, 14, 21, 28, 35}
    assert topk.nearest(frame.limit(0), F.col("vec_id") % 7 == 0, 5).count() == 0
    assert topk.nearest(frame.where("vec_id = 7"), F.col("vec_id") % 7 == 0, 5).count() == 0


def test_languages(spark, docs, empty):
    found = {r["doc_id"]: r for r in language.language(docs).collect()}
    assert found[5]["lang_pred"] == found[6]["lang_pred"] == found[8]["lang_pred"] == "und"
    assert language.language(empty).count() == 0
    model = language.Model(("aa", "bb"), np.array([[0.9, 0.1], [0.1, 0.9]], np.float32))
    one, both = (np.array([0, 1]), np.array([900, 100])), (np.array([0, 1]), np.array([500, 500]))
    got = model.mixtures([one, both])
    assert got[0].tolist() == [1, 0] and got[1] == pytest.approx([0.5, 0.5], abs=0.01)


def test_classifiers(spark, docs, empty):
    some = labels_of(spark, [(1, 1, 1), (3, 0, 0), (3, 0, 0), (4, 0, 1), (None, 1, 0), (7, None, 1), (99, 1, 1)])
    for labels in (some, some.limit(0)):
        found = toxicity.toxicity(docs, labels).collect()
        assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
        assert toxicity.without_toxic(docs, labels).columns == docs.columns
        graded = quality.quality(docs, labels, F.col("quality") * (2 - F.col("toxic")), 3).collect()
        assert len(graded) == len(ROWS) and all(0 <= r["expected_grade"] <= 2 for r in graded)
    assert toxicity.toxicity(empty, some).count() == 0
    assert quality.quality(empty, some, F.col("quality"), 2).count() == 0


def test_pieces(spark, docs, empty):
    frame = docs.where("doc_id < 9").unionByName(
        docs.limit(1).withColumns({"doc_id": F.lit(20).cast("long"), "text": F.lit(" a  ▁b\n\té🙂\u0000 " + "x" * 99)})
    )
    for dropout in (0.0, 0.3):
        both = pieces.decoded(pieces.encoded(frame, PIECES, seed=3, dropout=dropout), PIECES)
        assert both.where("NOT decoded <=> text").count() == 0
        assert both.columns == [*docs.columns, "piece_ids", "decoded"]
    assert pieces.encoded(empty, PIECES, seed=1).count() == 0
    model, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.encoder(PIECES)
    texts = ["Hello  world", "naïve café\n執", "a" * 120, " lead"]
    assert [np.frombuffer(x, "<i4").tolist() for x in own.encode(texts, [1] * 4, 0.0)] == [model.encode(t) for t in texts]
    first, again, other = (own.encode(texts, [s] * 4, 0.3) for s in (5, 5, 6))
    assert first == again != other


def test_long_words_merge_as_short_ones(monkeypatch):
    own = pieces.encoder(PIECES)
    texts = ["internationalisation of the misunderstandings", "abababababab aaaa"]
    rows = own.encode(texts, [9, 9], 0.3)
    monkeypatch.setattr(pieces, "LONGEST", 1)
    assert own.encode(texts, [9, 9], 0.3) == rows


def test_pair_table_finds_what_it_holds():
    rng = np.random.default_rng(5)
    left, right = np.divmod(rng.choice(10_000, 3000, replace=False), 100)
    table = bpe.PairTable(left, right, np.arange(3000), np.arange(3000) + 7)
    rank, merged = table.find(left, right)
    assert (rank == np.arange(3000)).all() and (merged == np.arange(3000) + 7).all()
    held = set(zip(left.tolist(), right.tolist(), strict=True))
    a, b = np.divmod(np.arange(10_000), 100)
    assert ((table.find(a, b)[0] != bpe.NONE) == [(x, y) in held for x, y in zip(a.tolist(), b.tolist(), strict=True)]).all()
