"""Symbols, Kneser-Ney models and predictions against plain Python."""
import math
import random
from collections import Counter

import numpy as np
import pytest
from navrecon.llm import language
from pyspark.sql import functions as F


def read(text):
    """The symbols of a text: spaces part words, three before it, one behind it."""
    out = []
    for c in text.lower():
        s = int(language.alphabet()[ord(c)])
        if s or (out and out[-1]):
            out.append(s)
    while out and out[-1] == 0:
        out.pop()
    return [0, 0, 0, *out, 0] if out else []


def grams(text):
    s = read(text)
    return [tuple(s[i - 3:i + 1]) for i in range(3, len(s))]


def packed(gram):
    return sum(s << 6 * k for k, s in enumerate(reversed(gram)))


def test_sequences():
    rng = random.Random(1)
    for _ in range(500):
        pieces = ["".join(rng.choice("ab  .1\nÄé\x00😀中") for _ in range(rng.randint(0, 7))) for _ in range(rng.randint(1, 6))]
        g, counts = language.sequences(pieces)
        assert g.tolist() == [packed(x) for p in pieces for x in grams(p)]
        assert counts.tolist() == [len(grams(p)) for p in pieces]


class Plain:
    """Interpolated Kneser-Ney by its definition."""

    def __init__(self, texts):
        self.c = {4: Counter(g for t in texts for g in grams(t))}
        for n in (3, 2, 1):
            self.c[n] = Counter(g[1:] for g in self.c[n + 1])

    def discount(self, n):
        one, two = (sum(c == k for c in self.c[n].values()) for k in (1, 2))
        return min(0.95, max(0.05, one / (one + 2 * two) if one + two else 0.5))

    def p(self, gram):
        if not gram:
            return 1 / 64
        n, d = len(gram), self.discount(len(gram))
        after = {g: c for g, c in self.c[n].items() if g[:-1] == gram[:-1]}
        if not after:
            return self.p(gram[1:])
        s = sum(after.values())
        return max(self.c[n][gram] - d, 0) / s + d * len(after) / s * self.p(gram[1:])


TEXTS = {"x": ["abab cab ba", "ab ba b", "cab cab", ""], "y": ["ééz zé", "zéz é zzz", "...", "ab é"]}


def model_of(spark, rows):
    df = spark.createDataFrame([(k, True, t) for k, texts in rows.items() for t in texts], "lang string, fit boolean, text string")
    return language.arrays_of(language.smoothed(language.counted(df).select("lang", "g", F.col("all").alias("c"))))


def test_model_equals_definition(spark):
    made = model_of(spark, TEXTS)
    tried = sorted({packed(g): g for t in [*TEXTS["x"], *TEXTS["y"], "a new word, ééé", "QQ"] for g in grams(t)}.items())
    for lang, texts in TEXTS.items():
        plain = Plain(texts)
        got = language.log_probabilities(np.array([k for k, _ in tried], np.uint32), made[lang])
        assert np.allclose(got, [math.log(plain.p(g)) for _, g in tried], atol=1e-5)
        # What may follow a context has probability one in all.
        for g in (tried[0][1], tried[-1][1]):
            every = np.array([packed((*g[:-1], s)) for s in range(64)], np.uint32)
            assert math.isclose(np.exp(language.log_probabilities(every, made[lang])).sum(), 1, abs_tol=1e-5)


def test_entropies_of_pieces(spark, monkeypatch):
    made = model_of(spark, TEXTS)
    arrays = [made["x"], made["y"]]
    texts = ["ab cab", None, "", "12 ...", "é" * 50, "ab ba " * 40]
    size, entropy = language.entropies(texts, arrays)
    assert size.tolist() == [len(grams(t or "")) for t in texts] and (entropy[1:4] == 0).all()
    assert math.isclose(entropy[0, 0], -np.mean([math.log(Plain(TEXTS["x"]).p(g)) for g in grams("ab cab")]), rel_tol=1e-5)
    monkeypatch.setattr(language, "TURN", 20)
    again = language.entropies(texts, arrays)
    assert (again[0] == size).all() and np.allclose(again[1], entropy)
    monkeypatch.setattr(language, "PIECE", 7)
    cut = [t[k:k + 7] for t in texts if t for k in range(0, len(t), 7)]
    assert language.entropies(texts, arrays)[0].sum() == sum(len(grams(p)) for p in cut)


def spoken(lang, rng):
    parts = {"one": ["ka", "to", "mi", "ra"], "two": ["ße", "ön", "sch", "ta"], "three": ["пр", "ив", "ет", "но"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 40)))


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(8)
    rows = [(i, spoken(lang, rng), lang, "s") for i, lang in enumerate(["one", "two", "three"] * 120)]
    rows += [(i, "ka to", None, "s") for i in range(500, 510)] + [(None, "ka", "one", "s"), (600, None, "one", "s"), (601, "7", "two", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs, language.train(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)


def test_predictions(spark, learned):
    docs, model = learned
    assert model["names"] == ["one", "three", "two"]
    told = language.identify(docs.where("doc_id < 400"), model).collect()
    assert all(r.lang_pred == r.lang and 0.3 < r.lang_score <= 1 for r in told)
    assert sum(r.lang_rejected for r in told) < 40
    strange = spark.createDataFrame([("中文中文中文 qxqxq vvvw" * 30,)], "text string")
    assert language.identify(strange, model).first().lang_rejected


def test_odd_texts(spark, learned, messy, clashing, empty):
    _, model = learned
    for df in (messy, clashing):
        told = language.identify(df, model)
        assert told.columns[:len(df.columns)] == df.columns and told.count() == df.count()
        for r in told.collect():
            letters = any(c.isalpha() for c in r.text or "")
            assert (r.lang_pred != "und") == letters == (r.lang_score > 0) and 0 <= r.lang_score <= 1
    assert language.identify(empty, model).count() == 0
    for docs in (empty, messy.where("text is null"), messy.where("lang is null")):
        none = language.train(docs, F.lit(True))
        assert none["names"] == [] and {r.lang_pred for r in language.identify(messy, none).collect()} == {"und"}
    few = language.train(messy.where("doc_id = 4"), F.lit(True))
    assert {r.lang_pred for r in language.identify(messy, few).collect()} == {"en", "und"}


def test_held_out_rows_teach_nothing(spark, learned):
    docs, model = learned
    quarter = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    other = docs.withColumn("lang", F.when(quarter == 2, "one").otherwise(F.col("lang"))).withColumn(
        "text", F.when(quarter == 2, "zzz").otherwise(F.col("text")))
    again = language.train(other, quarter != 2)
    assert again["sharp"] == model["sharp"] and again["limits"] == model["limits"]
    for name in model["names"]:
        for key, (g, p) in model["arrays"][name].items():
            assert (again["arrays"][name][key][0] == g).all() and (again["arrays"][name][key][1] == p).all()


def test_all_learning_texts_calibrate(spark, learned):
    docs, model = learned
    rows = docs.where("lang is not null and doc_id is not null").where(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2).select(
        "lang", "text", (F.xxhash64(F.col("doc_id").cast("string"), F.lit(12)) % 2 == 0).alias("half")).collect()
    names, told = model["names"], []
    for half in (True, False):
        other = model_of(spark, {n: [r.text for r in rows if r.lang == n and r.half != half] for n in names})
        own = [r for r in rows if r.half == half]
        size, entropy = language.entropies([r.text for r in own], [other[n] for n in names])
        told += [(names.index(r.lang), s, e) for r, s, e in zip(own, size, entropy, strict=True) if s]
    assert len(told) > 250  # every learning text with letters, none left out
    own, size, entropy = (np.array(x) for x in zip(*told, strict=True))
    for k, name in enumerate(names):
        mean = np.average(entropy[own == k, k], weights=size[own == k])
        excess = np.sort((entropy[own == k, k] - mean) * np.sqrt(size[own == k]))
        assert np.allclose(model["limits"][name], (mean, excess[math.ceil(len(excess) * 0.99) - 1]), atol=1e-5)
    losses = [-np.log(np.maximum(language.chances(size, entropy, s)[np.arange(len(own)), own], 1e-12)).sum() for s in language.SHARP]
    assert losses[language.SHARP.index(model["sharp"])] <= min(losses) + 1e-6


def test_limits_of_any_number_of_values(spark):
    rng = random.Random(5)
    values = {"a": [rng.randint(-10**13, 10**13) for _ in range(300)], "b": [7] * 50 + [-3] * 50, "c": [-1]}
    df = spark.createDataFrame([(n, x) for n, xs in values.items() for x in xs], "lang string, x long")
    for share in (0.0, 0.3, 0.5, 0.99):
        ranks = {n: int(share * len(xs)) for n, xs in values.items()}
        assert language.limits_of(df, ranks) == {n: sorted(xs)[ranks[n]] for n, xs in values.items()}
