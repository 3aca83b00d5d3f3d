"""Languages: a plain version, held-out accuracy, mixtures, undetermined texts."""

import math
from collections import Counter

from pyspark.sql import functions as F

from ledgerloom.llm import langmix, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = queries.QUERIES["op10_language_mixture"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = found.join(docs, "doc_id").where("held_out")
    right, n, low, high = held.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 250 and right > 0.99 and 0 <= low <= high <= 1


def test_mixtures_and_undetermined(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    langs, model = langmix.train(docs)
    assert langs == ["de", "en", "es", "fr"]
    text = {r.lang: r.text[:3000] for r in docs.where("n_chars > 3000").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    rows = [(1, text["de"]), (2, text["fr"] + "\n" + text["en"]), (3, None), (4, ""), (5, "123 -- 4"), (None, text["es"]), (1, text["de"]), (6, "日本"), (7, "é" * 100_000)]
    mixed = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = sorted(langmix.predicted_languages(mixed, langs, model).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert got[0] == got[1] and got[0].lang_pred == "de" and got[-1].lang_pred == "es"
    two = got[2].lang_shares
    assert {k for k, v in two.items() if v > 0.2} == {"fr", "en"} and abs(sum(two.values()) - 1) < 1e-6
    assert [(r.lang_pred, r.score, r.lang_shares) for r in got[3:6]] == [("und", 0.0, {})] * 3
    assert got[6].lang_pred in langs and got[7].lang_pred in langs
    assert langmix.predicted_languages(mixed.where("false"), langs, model).count() == 0
    none, empty = langmix.train(docs.where("false"))
    assert {r.lang_pred for r in langmix.predicted_languages(mixed, none, empty).collect()} == {"und"}


def plain_words(text):
    """Words of a text as lists of trigrams: runs of ASCII letters, lower-cased, and of other bytes above 127."""
    data = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").encode())
    return [[(b" " + w + b" ")[i : i + 3] for i in range(len(w))] for w in data.split()]


def plain_bucket(gram):
    return ((gram[0] << 16 | gram[1] << 8 | gram[2]) * 2654435761 % 2**32) >> 16


def plain_model(rows, langs):
    counts = {lang: Counter() for lang in langs}
    for text, lang in rows:
        if text is not None and lang is not None:
            counts[lang].update(plain_bucket(g) for w in plain_words(text) for g in w)
    smooth = 0.5 / len(langs)
    total = {lang: sum(c.values()) + smooth * langmix.BUCKETS for lang, c in counts.items()}
    return {lang: (lambda b, c=counts[lang], n=total[lang]: math.log((c[b] + smooth) / n)) for lang in langs}


def plain_mixture(text, langs, model, price=3.0):
    """Proportions of the selected languages: expectation-maximisation word by word, languages leaving one by one."""
    words = []
    for grams in plain_words(text):
        logs = [sum(model[lang](plain_bucket(g)) for g in grams) / 3 for lang in langs]
        words.append([math.exp(x - max(logs)) + 1e-12 for x in logs])

    def fitted(allowed, share, rounds):
        share = [s if a else 0.0 for s, a in zip(share, allowed)]
        share = [s / sum(share) for s in share]
        for _ in range(rounds):
            gained = [0.0] * len(langs)
            for like in words:
                weight = [x * s for x, s in zip(like, share)]
                for j, w in enumerate(weight):
                    gained[j] += w / sum(weight)
            share = [g / len(words) + 1e-9 if a else 0.0 for g, a in zip(gained, allowed)]
            share = [s / sum(share) for s in share]
        return share, sum(math.log(sum(x * s for x, s in zip(like, share))) for like in words)

    allowed = [True] * len(langs)
    best, fit = fitted(allowed, [1 / len(langs)] * len(langs), langmix.ROUNDS)
    while sum(allowed) > 1:
        weakest = min((s, j) for j, (s, a) in enumerate(zip(best, allowed)) if a)[1]
        fewer = [a and j != weakest for j, a in enumerate(allowed)]
        again, refit = fitted(fewer, [s + 1e-9 for s in best], langmix.ROUNDS // 3)
        if refit - fit + price <= 0:
            break
        allowed, best, fit = fewer, again, refit
    return best


def test_against_plain_expectation_maximisation(spark):
    """Model and mixtures of whole texts, word by word in plain Python."""
    docs = [(r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    langs, table = langmix.train(spark.createDataFrame(docs, "text string, lang string"))
    model = plain_model(docs, langs)
    for bucket in list(range(0, langmix.BUCKETS, 997)) + [plain_bucket(g) for w in plain_words("the straße día où") for g in w]:
        assert all(abs(table[bucket, j] - model[lang](bucket)) < 1e-4 for j, lang in enumerate(langs))
    short = sorted((t for t, _ in docs if t and plain_words(t)), key=len)[:60]
    texts = short + [a[:400] + " " + b[:400] for a, b in zip(short[20:40], short[40:60])] + ["ab", "the", "é"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in langmix.predicted_languages(rows, langs, table).collect():
        wanted = plain_mixture(texts[row.doc_id], langs, model)
        assert all(abs(row.lang_shares.get(lang, 0.0) - s) < 2e-3 for lang, s in zip(langs, wanted)), (texts[row.doc_id], row.lang_shares, wanted)
        assert row.score == row.lang_shares[row.lang_pred] == max(row.lang_shares.values())
