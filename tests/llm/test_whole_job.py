"""Cases in which the operators once did less than the whole job."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from smeltery.llm import jaccard_join, language, packing, pii, quality, toxicity
from smeltery.llm.common import cut


def test_sampled_toxicity_keeps_the_class_mix(spark):
    draw = random.Random(3)
    words = ["stone", "river", "cloud", "meadow", "lantern", "harbour", "copper", "willow"]
    rows, marks = [], []
    for i in range(900):
        toxic = i % 9 == 0
        text = draw.choices(words, k=12) + (["idiot"] if toxic and i % 2 else [])
        rows.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    docs = cut(spark.createDataFrame(rows, "id long, text string"))
    # Labels without a document, of one class alone, must not change the mix.
    labels = cut(spark.createDataFrame(marks + [(1000 + i, 1) for i in range(900)], "id long, label int"))
    known = labels.where("id < 1000")
    whole, sampled = toxicity.train(docs, known, 10_000), toxicity.train(docs, known, 100)
    assert whole.score("") < 0.25
    assert sampled.bias == pytest.approx(whole.bias, abs=0.5)
    assert toxicity.train(docs, labels, 10_000).bias == pytest.approx(whole.bias, abs=1e-9)
    grams = [toxicity.features(t) for _, t in rows]
    toxic = np.array([m == 1 for _, m in marks])
    assert toxicity.fit(grams, toxic).bias == pytest.approx(whole.bias, abs=1e-3)


IBANS = (
    "ES91 2100 0418 4502 0005 1332",
    "ES9121000418450200051332",
    "BE68 5390 0754 7034",
    "SE4550000000058398257466",
    "AT611904300234573201",
    "DE89 3704 0044 0532 0130 00",
    "NO93 8601 1117 947",
    "MT84 MALT 0110 0001 2345 MTLC AST0 01S",
)
BEHIND = ("", " 2024", " BIC GKCCBEBB", " EUR", " SEK.", " and", ", 1234", " 1234 5678", " A", " EUR 100 AND MORE")


def test_account_numbers_before_capitals_and_numbers(spark):
    rows, places = [], {}
    for number in IBANS:
        for behind in BEHIND:
            places[len(rows)] = [(5, 5 + len(number))]
            rows.append((len(rows), f"Pay: {number}{behind}"))
    # One after the other, with a word between, and a number whose check fails before a good one.
    for first in IBANS:
        for second in IBANS:
            at = len(first) + 1
            places[len(rows)] = [(0, len(first)), (at, at + len(second))]
            rows.append((len(rows), f"{first} {second}"))
    wrong = "AT61 1904 3002 3457 3202 "
    places[len(rows)] = [(len(wrong), len(wrong) + len(IBANS[2]))]
    rows.append((len(rows), wrong + IBANS[2]))
    # Countries without a registered length are found as before.
    places[len(rows)] = [(0, 20)]
    rows.append((len(rows), f"ZZ{98 - int('19043002345732013535') * 100 % 97:02d}1904300234573201"))
    frame = cut(spark.createDataFrame(rows, "doc_id long, text string"))
    iban = tuple(k for k in pii.KINDS if k.name == "iban")
    for r in pii.personal_data(frame, kinds=iban).collect():
        assert [(s["start"], s["end"]) for s in r["spans"]] == places[r["id"]], rows[r["id"]]
    for r in pii.without_personal_data(frame, kinds=iban).collect():
        text = rows[r["doc_id"]][1]
        for start, end in reversed(places[r["doc_id"]]):
            text = f"{text[:start]}[IBAN]{text[end:]}"
        assert r["text"] == text


def test_copies_neither_hide_nor_fill_a_language(spark):
    draw = random.Random(5)
    letters = {"aa": "abcdefgh", "bb": "stuvwxyz"}
    some = {k: ["".join(draw.choices(v + " ", k=80)) for _ in range(n)] for (k, v), n in zip(letters.items(), (60, 5))}
    once = [(t, k) for k, found in some.items() for t in found]
    copies = once + [(t, "bb") for t in some["bb"] for _ in range(600)] + [(some["aa"][7], "aa")] * 900
    frame = cut(spark.createDataFrame(copies, "text string, lang string"))
    plain = cut(spark.createDataFrame(once, "text string, lang string"))
    model, expected = (language.train(f, "text", "lang", 20) for f in (frame, plain))
    assert model.languages == ("aa", "bb")
    assert np.array_equal(model.chances, expected.chances)


def test_every_language_is_learned(spark):
    draw = random.Random(8)
    words = {f"l{i:03d}": ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(6)] for i in range(300)}
    rows = [(i, " ".join(draw.choices(w, k=20)), lang) for i, (lang, w) in enumerate(list(words.items()) * 2)]
    frame = cut(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    model = language.train(frame, "text", "lang")
    assert model.languages == tuple(words)
    found = language.identified(frame, model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found} == {i: lang for i, _, lang in rows}


def test_special_strings_are_encoded_as_by_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    odd = ["a <|startoftext|> b", "x<|endoftext|>y", "<|ENDOFTEXT|> é", "É <|endoftext|> ’", "<|end oftext|>", "plain"]
    plain = [library.encode(t, add_special_tokens=False).ids for t in odd]
    assert 49407 in plain[1] and 49406 in plain[0]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.WordEncoder(path)(odd)] == plain


def test_toxicity_sample_is_not_cut():
    assert toxicity.SAMPLE >= 3000


def test_bands_cover_lower_thresholds():
    shared = np.random.default_rng(4)
    met = 0
    bands, rows = jaccard_join.bands_of(0.5)
    for _ in range(200):
        common, a, b = (shared.integers(0, 2**63, n, dtype=np.uint64) for n in (200, 100, 100))
        one, two = (jaccard_join.signature(np.unique(np.concatenate((common, x)))) for x in (a, b))
        met += bool((jaccard_join.band_keys(one, bands, rows) == jaccard_join.band_keys(two, bands, rows)).any())
    assert met == 200
    assert jaccard_join.bands_of(0.8) == (jaccard_join.BANDS, jaccard_join.ROWS)
    with pytest.raises(ValueError):
        jaccard_join.bands_of(0.05)


def test_account_numbers_have_the_length_of_their_country(spark):
    """One valid number per country, in blocks of four and in one go, before capitals and figures."""
    draw, rows, places = random.Random(8), [], {}
    for length, countries in pii.LENGTHS.items():
        for country in countries.split():
            body = "".join(draw.choices("0123456789", k=length - 4))
            check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
            plain = f"{country}{check:02d}{body}"
            blocks = " ".join(plain[i : i + 4] for i in range(0, length, 4))
            for number in (plain, blocks):
                for behind in ("", " EUR", " 2024", " paid"):
                    places[len(rows)] = (5, 5 + len(number))
                    rows.append((len(rows), f"Pay: {number}{behind}"))
    frame = cut(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in pii.personal_data(frame).collect():
        found = [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "iban"]
        assert found == [places[r["id"]]], rows[r["id"]]
    # Lengths that the registry names for some countries, stated here once more.
    known = {"NO": 15, "BE": 16, "DK": 18, "NL": 18, "AT": 20, "CH": 21, "DE": 22, "GB": 22, "ES": 24, "SE": 24}
    known |= {"TR": 26, "FR": 27, "IT": 27, "PL": 28, "HU": 28, "EG": 29, "BR": 29, "UA": 29, "JO": 30, "MT": 31}
    assert {c: n for n, names in pii.LENGTHS.items() for c in names.split() if c in known} == known


def test_grades_of_absent_documents_change_nothing(spark):
    draw = random.Random(4)
    words = ["stone", "river", "cloud", "meadow", "lantern", "harbour", "copper", "willow"]
    rows, marks = [], []
    for i in range(600):
        good = i % 3 > 0
        rows.append((i, " ".join(draw.choices(words, k=12) + (["junk"] if not good and i % 2 else []))))
        marks.append((i, int(good)))
    docs = cut(spark.createDataFrame(rows, "id long, text string"))
    known = cut(spark.createDataFrame(marks, "id long, label int"))
    more = cut(known.unionByName(spark.createDataFrame([(1000 + i, 1) for i in range(4000)], known.schema)))
    whole, again = quality.train(docs, known, 2, 10_000), quality.train(docs, more, 2, 10_000)
    assert again.thresholds == pytest.approx(whole.thresholds, abs=1e-9)
    assert again.tails("unseen words") == pytest.approx(whole.tails("unseen words"), abs=1e-9)
    sampled = quality.train(docs, known, 2, 150)
    assert sampled.tails("stone river") == pytest.approx(whole.tails("stone river"), abs=0.15)
