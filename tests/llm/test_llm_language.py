from __future__ import annotations

import random
from collections import Counter

import numpy as np
from llm_cases import prose
from pyspark.sql import functions as F

from strata.llm import language

SF = "/root/testdata/sf0.001"


def grams_of(text):
    """The letters and trigrams of a text by plain string work, as codes."""
    t = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    for i, c in enumerate(t):
        if c != " ":
            yield ord(c) << 21
            yield ord(t[i - 1]) << 42 | ord(c) << 21 | ord(t[i + 1])


def test_filters_hold_every_learned_ngram(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs)
    for k, name in enumerate(model.langs):
        texts = [r["text"] for r in docs.where((F.col("lang") == name) & F.col("text").isNotNull()).collect()]
        codes = np.array(sorted({g for t in texts for g in grams_of(t)}), dtype=np.int64)
        assert (model.masks(codes)[:, k] & 1).all()


def test_predictions_equal_plain_counts(spark):
    """With roomy filters: the bands, the usual popcount, the languages and the scores, all counted in plain Python."""
    rng = random.Random(5)
    rows = [(prose(("en", "de", "fr")[k % 3], rng.randint(3, 60), rng), ("en", "de", "fr")[k % 3]) for k in range(60)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3), bits_per_gram=400)
    of = {}
    for name in model.langs:
        share, seen, texts = Counter(), Counter(), [list(grams_of(t)) for t, lang in rows if lang == name]
        for grams in texts:
            for g in grams:
                share[g] += 2 / len(grams) / len(texts)
            seen.update(set(grams))
        bits = {g: sum(x >= t for t in language.BANDS) for g, x in share.items()}
        of[name] = bits, sum(share[g] * bits[g] for g in share if seen[g] > 1) / sum(share.values())
    assert np.allclose(model.usual, [of[name][1] for name in model.langs], rtol=1e-6)
    asked = [prose(x, 40, rng) for x in ("en", "de", "fr") * 5]
    got = language._predict(model, asked)
    for text, pred, score in zip(asked, got["lang_pred"], got["score"], strict=True):
        grams = list(grams_of(text))
        mean = {name: sum(bits.get(g, 0) for g in grams) / len(grams) for name, (bits, _) in of.items()}
        best = max(mean, key=mean.get)
        assert pred == best and abs(score - min(1, mean[best] / of[best][1])) < 0.01


def test_languages_of_many_letters_keep_their_score(spark):
    rng = random.Random(7)
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(n))
    rows = [(han(400), "zh") for _ in range(200)] + [(prose("en", 80, rng), "en") for _ in range(200)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    got = language._predict(model, [han(400) for _ in range(50)] + [prose("en", 80, rng) for _ in range(50)])
    assert got["lang_pred"].tolist() == ["zh"] * 50 + ["en"] * 50
    assert got["score"].min() > 0.8


def test_bounded_filters_still_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL")
    model = language.fit(docs, max_bytes=1 << 14)
    assert model.slices.nbytes <= 1 << 14
    out = docs.select("lang", language.language(model, F.col("text"), spark)["lang_pred"].alias("p")).toPandas()
    assert (out["lang"] == out["p"]).mean() > 0.95


def test_very_long_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs)
    got = language._predict(model, ["the house and the garden " * 100_000, "x" * 1_000_000])
    assert got["n_letters"].tolist() == [2_000_000, 1_000_000] and got["lang_pred"][0] == "en"


def test_chance_is_the_measured_false_positive_rate(spark):
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet"), bits_per_gram=2)
    absent = np.random.default_rng(1).integers(2**50, 2**62, 20_000)
    masks = model.masks(absent)
    for k in range(len(model.langs)):
        for b in range(len(language.BANDS)):
            assert abs(((masks[:, k] >> b) & 1).mean() - model.chance[k, b]) < 0.02


def test_crowded_filters_are_corrected(spark):
    """Even filters that pass many foreign trigrams decide rightly."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL")
    model = language.fit(docs, bits_per_gram=1, hashes=1)
    assert model.chance.max() > 0.15
    out = docs.select("lang", language.language(model, F.col("text"), spark).alias("r")).select("lang", "r.*").toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.95


def test_trigrams_across_alphabets():
    texts = ["Ab, c", None, "日本語テキスト" * 40 + "".join(map(chr, range(0x4E00, 0x5000)))]
    grams = language.Ngrams(texts)
    assert grams.n.tolist()[:2] == [3, 0]
    decoded = ["".join(chr((int(c) >> s) & 0x1FFFFF) for s in (42, 21, 0)) for c in grams.trigrams[grams.gram[:3]]]
    assert decoded == [" ab", "ab ", " c "]


def test_more_than_64_languages(spark):
    rng = random.Random(1)
    rows = [(prose(("en", "de", "fr")[k % 3], 50, rng) + f" {chr(0x4E00 + k)}" * 40, f"l{k:02d}") for k in range(70)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = language.fit(docs)
    assert len(model.langs) == 70 and model.slices.shape[1] == 70
    out = docs.select("lang", language.language(model, F.col("text"), spark)["lang_pred"].alias("p")).toPandas()
    assert (out["lang"] == out["p"]).mean() > 0.9


def test_nothing_learned(spark):
    docs = spark.createDataFrame([("some text", None)], "text string, lang string")
    model = language.fit(docs)
    out = docs.select(language.language(model, F.col("text"), spark).alias("r")).first()["r"]
    assert (out["lang_pred"], out["score"]) == ("und", 0.0)
