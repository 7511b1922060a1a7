"""Plain forms of the fitted operators and of merge-dropout, on a few hundred texts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from smeltery.llm import language, pieces, quality, toxicity
from smeltery.llm.common import cut

WRAP = (1 << 64) - 1


def gram(points, size, bits):
    """One n-gram as a number, in plain integers."""
    mixed = size
    for p in points:
        mixed = (mixed * 0x100000001B3 + p) & WRAP
    mixed ^= mixed >> 31
    return (mixed * 0x9E3779B97F4A7C15 & WRAP) >> (64 - bits)


# --- merge-dropout ---


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & WRAP
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & WRAP
    return x ^ x >> 31


def plain_pieces(model, text, owner, dropout):
    """Segment word by word: of all neighbours that form a piece and are not skipped, merge the best."""
    names = {
        model.id_to_piece(i): i
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    }
    order = {n: r for r, n in enumerate(sorted(names, key=lambda n: (-model.get_score(names[n]), names[n])))}
    keys = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5]
    ids = []
    for word in re.findall("▁+[^▁]*|[^▁]+", "▁" + text.replace(" ", "▁")):
        total = sum(mix((ord(c) * keys[3] + i) & WRAP) for i, c in enumerate(word)) & WRAP
        seed = mix(total ^ owner & WRAP)
        parts = []
        for c in word:
            parts += [c] if c in names else [f"<0x{b:02X}>" for b in c.encode()]
        spans = [(i, i + 1, p) for i, p in enumerate(parts)]
        while True:
            options = []
            for k, ((start, mid, left), (_, end, right)) in enumerate(zip(spans, spans[1:])):
                kept = mix((seed + start * keys[0] + mid * keys[1] + end * keys[2]) & WRAP) >> 11 >= dropout * 2.0**53
                if left in names and right in names and left + right in names and kept:
                    options.append((order[left + right], start, k))
            if not options:
                break
            k = min(options)[2]
            spans[k : k + 2] = [(spans[k][0], spans[k + 1][1], spans[k][2] + spans[k + 1][2])]
        ids += [names[p] if p in names else model.piece_to_id(p) for _, _, p in spans]
    return ids


def test_pieces_with_dropout_match_a_plain_form(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 900").limit(25)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(10_001, "naïve café 執🙂 " + "abcdefgh" * 12), (10_002, "  two  blanks "), (10_003, "internationalisation")]
    frame = cut(spark.createDataFrame(rows, "doc_id long, text string"))
    owners = {r[0]: r[1] for r in frame.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), F.lit(17))).collect()}
    differ = 0
    for dropout in (0.1, 0.5):
        for r in pieces.encoded(frame, path, seed=17, dropout=dropout).collect():
            expected = plain_pieces(model, dict(rows)[r["doc_id"]], owners[r["doc_id"]], dropout)
            assert r["piece_ids"] == expected, (r["doc_id"], dropout)
            differ += expected != model.encode(dict(rows)[r["doc_id"]])
    assert differ > len(rows)  # dropout does change segmentations


# --- mixtures of languages ---


def plain_mixture(chances, counts):
    """Proportions by plain expectation-maximisation over growing sets of languages."""
    width, total = len(chances), sum(counts.values())

    def likelihood(shares):
        return sum(n * math.log(sum(s * chances[k][g] for k, s in enumerate(shares) if s)) for g, n in counts.items())

    def estimate(shares):
        for _ in range(language.ROUNDS):
            new = [0.0] * width
            for g, n in counts.items():
                mixed = sum(s * chances[k][g] for k, s in enumerate(shares))
                for k, s in enumerate(shares):
                    new[k] += n * s * chances[k][g] / mixed
            shares = [x / total for x in new]
        return shares

    alone = [likelihood([float(k == j) for k in range(width)]) for j in range(width)]
    penalty = language.PENALTY * math.log1p(total)
    free = estimate([1 / width] * width)
    ranked = sorted(range(width), key=lambda k: -free[k])
    best, shares = max(alone), [float(k == alone.index(max(alone))) for k in range(width)]
    for size in range(2, width + 1):
        found = estimate([1 / size if k in ranked[:size] else 0.0 for k in range(width)])
        value = likelihood(found) - (size - 1) * penalty
        if value > best:
            best, shares = value, found
    return shares


def test_languages_match_a_plain_form(spark):
    draw = random.Random(5)
    words = {"aa": "the of and stone river cloud".split(), "bb": "der die und stein fluss wolke".split(), "cc": "le la et pierre fleuve nuage".split()}
    rows = []
    for i in range(240):
        lang = draw.choice(sorted(words))
        other = draw.choice(sorted(words))
        text = " ".join(draw.choices(words[lang], k=25) + (draw.choices(words[other], k=draw.randrange(0, 25)) if i % 3 == 0 else []))
        rows.append((i, text, lang))
    rows += [(900, rows[0][1], rows[0][2]), (901, "Stone, STEIN! pierre", None)]
    docs = cut(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    model = language.train(docs, "text", "lang")
    # Learning: n-gram counts of distinct texts, smoothed.
    counts = defaultdict(Counter)

    def grams_of(text):
        plain = " " + " ".join(re.findall("[a-z]+", text.lower())) + " "
        return Counter(gram([ord(c) for c in plain[i : i + 3]], 3, language.BITS) for i in range(len(plain) - 2))

    for lang, text in {(r[2], r[1]) for r in rows if r[2]}:
        counts[lang].update(grams_of(text))
    assert model.languages == tuple(sorted(words))
    chances = []
    for k, lang in enumerate(model.languages):
        whole = sum(counts[lang].values()) + language.SMOOTH * 2**language.BITS
        chances.append(defaultdict(lambda w=whole: language.SMOOTH / w, {g: (n + language.SMOOTH) / whole for g, n in counts[lang].items()}))
        some = list(counts[lang])
        assert model.chances[some, k] == pytest.approx([chances[k][g] for g in some], rel=1e-6)
    mixed = 0
    for r in language.identified(docs, model).collect():
        shares = plain_mixture(chances, grams_of(dict((x[0], x[1]) for x in rows)[r["doc_id"]]))
        assert set(r["languages"]) == {model.languages[k] for k, s in enumerate(shares) if s > 0}
        assert r["score"] == pytest.approx(max(shares), abs=2e-3)
        assert r["lang_pred"] in {model.languages[k] for k, s in enumerate(shares) if s > max(shares) - 2e-3}
        mixed += len(r["languages"]) > 1
    assert mixed > 5


# --- fitted classifiers ---


def descended(slope, size, rounds=6000, step=1.0):
    """Accelerated descent with restarts: slow and plain."""
    x = y = np.zeros(size)
    t, last = 1.0, slope(x)[0]
    for _ in range(rounds):
        value, g = slope(y)
        new = y - step * g
        moved = slope(new)[0]
        if moved > value - step / 2 * g @ g:
            step /= 2
            continue
        if moved > last:
            t, y = 1.0, x
            last = moved + 1e-15
            continue
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / after * (new - x)
        x, t, last = new, after, moved
    return x


def labelled(seed, size):
    draw = random.Random(seed)
    good, bad = "stone river cloud meadow lantern harbour copper willow".split(), "idiot moron scum liar".split()
    rows = []
    for i in range(size):
        toxic = i % 4 == 0
        rows.append((i, " ".join(draw.choices(good, k=9) + (draw.choices(bad, k=2) if toxic and i % 8 else [])), int(toxic)))
    return rows


def test_toxicity_matches_a_plain_fit(spark):
    rows = labelled(1, 240)
    frame = cut(spark.createDataFrame(rows, "id long, text string, label int"))
    model = toxicity.train(frame.select("id", "text"), frame.select("id", "label"))

    def features_of(text):
        plain = f" {' '.join(text.lower().split())} "
        return {gram([ord(c) for c in plain[i : i + n]], n, toxicity.BITS) for n in (4, 5) for i in range(len(plain) - n + 1)}

    sets, marks = [features_of(t) for _, t, _ in rows], np.array([m for *_, m in rows])
    bad = Counter(g for s, m in zip(sets, marks) if m for g in s)
    fine = Counter(g for s, m in zip(sets, marks) if not m for g in s)
    n_bad, n_fine = marks.sum(), (1 - marks).sum()
    ratios = {g: math.log((bad[g] + 1) / (n_bad + 2)) - math.log((fine[g] + 1) / (n_fine + 2)) for g in bad | fine}
    used = sorted(g for g, r in ratios.items() if bad[g] + fine[g] >= 3 and abs(r) >= 0.5)
    table = np.array([[ratios[g] * (g in s) for g in used] + [1.0] for s in sets])
    sign = 2.0 * marks - 1

    def slope(x):
        margin = sign * (table @ x)
        value = np.logaddexp(0, -margin).mean() + toxicity.PENALTY / 2 * x[:-1] @ x[:-1]
        g = table.T @ (-sign / (1 + np.exp(margin))) / len(sign)
        g[:-1] += toxicity.PENALTY * x[:-1]
        return value, g

    x = descended(slope, len(used) + 1)
    assert np.abs(slope(x)[1]).max() < 1e-5
    for (_, text, _), row in zip(rows, table):
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(-row @ x)), abs=0.01)
    assert set(np.flatnonzero(model.weights)) <= set(used)


def test_quality_matches_a_plain_fit(spark):
    rows = [(i, t, 0 if m else 1 + i % 2) for i, t, m in labelled(2, 240)]
    frame = cut(spark.createDataFrame(rows, "id long, text string, label int"))
    model = quality.train(frame.select("id", "text"), frame.select("id", "label"), 3)
    columns, parts = {}, []
    for _, text, _ in rows:
        words = text.split()
        _, hashed = quality.tokens(text)
        held = Counter({int(c): 0.0 for c in hashed})
        for c in hashed:
            held[int(c)] += quality.TOKENS / len(words)
        for c in quality.shape(text, words):
            held[int(c)] += 1.0
        parts.append(held)
        for c in held:
            columns.setdefault(c, len(columns))
    table = np.zeros((len(rows), len(columns)))
    for i, held in enumerate(parts):
        for c, v in held.items():
            table[i, columns[c]] = v
    grades, width = np.array([g for *_, g in rows]), len(columns)

    def chance(x):
        low, high = x[width], x[width] + math.exp(x[width + 1])
        score = table @ x[:width]
        return [1 / (1 + np.exp(score - t)) for t in (low, high)]  # P(grade <= 0), P(grade <= 1)

    def slope(x):
        first, second = chance(x)
        p = np.maximum(np.choose(grades, (first, second - first, 1 - second)), 1e-12)
        d1, d2 = first * (1 - first), second * (1 - second)
        by_low = np.choose(grades, (d1, -d1, 0 * d1)) / p
        by_high = np.choose(grades, (0 * d2, d2, -d2)) / p
        n = len(rows)
        g = np.append(table.T @ (by_low + by_high) / n, (0.0, 0.0))
        g[:width] += quality.PENALTY * x[:width]
        g[width] = -(by_low + by_high).sum() / n
        g[width + 1] = -by_high.sum() / n * math.exp(x[width + 1])
        return -np.log(p).mean() + quality.PENALTY / 2 * x[:width] @ x[:width], g

    x = descended(slope, width + 2)
    assert np.abs(slope(x)[1]).max() < 1e-4
    first, second = chance(x)
    for i, (_, text, _) in enumerate(rows):
        assert model.tails(text) == pytest.approx([1 - first[i], 1 - second[i]], abs=0.02)
    assert model.thresholds[0] < model.thresholds[1]
