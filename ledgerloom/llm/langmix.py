"""Language identification by multilingual mixture inference.

Each language has a smoothed model of byte trigrams of words. A document is a
mixture: every word comes from one language, with the document's proportions,
which expectation-maximisation finds from the words' likelihoods. The set of
languages is chosen by penalised likelihood: from all languages, the one with
the least proportion leaves as long as a criterion of fit minus a price per
language gains.

The model is a table of ``2 ** 16`` trigram buckets per language, counted over
all learned documents; its size does not depend on the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.words import _LOWER, as_bytes, slices, widened

BUCKETS = 1 << 16
ROUNDS = 12
#: Trigrams overlap, so a word's log-likelihood counts a third.
TEMPER = 1 / 3

_FOLD = _LOWER.copy()
_FOLD[:128][~(((np.arange(128) >= 65) & (np.arange(128) <= 90)) | ((np.arange(128) >= 97) & (np.arange(128) <= 122)))] = 32


def _trigrams(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the trigrams of `` word ``, the word of each and the text of each word.

    A word is a run of ASCII letters, lower-cased, and of bytes of other characters.
    """
    data, cuts = as_bytes(column)
    data = _FOLD[data]
    inside = data != 32
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    before[inner] = False
    after[inner - 1] = False
    start = np.flatnonzero(inside & ~before)
    at = np.flatnonzero(inside)
    word = np.cumsum((inside & ~before)[at]) - 1
    wide = data.astype(np.uint32)
    left, right = np.full(len(at), 32, np.uint32), np.full(len(at), 32, np.uint32)
    has_left, has_right = before[at], after[at]
    left[has_left] = wide[at[has_left] - 1]
    right[has_right] = wide[at[has_right] + 1]
    code = (left << 16) | (wide[at] << 8) | right
    bucket = (code * np.uint32(2654435761)) >> np.uint32(16)
    return bucket.astype(np.int64), word, np.searchsorted(cuts, start, side="right") - 1


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (bucket by language) from all labelled rows.

    Rows without text or language teach nothing. What reaches the driver is one
    count per bucket and language.
    """

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                langs = part.column(1).dictionary_encode()
                code = langs.indices.to_numpy(zero_copy_only=False)
                names = langs.dictionary.to_pylist()
                bucket, word, text = _trigrams(part.column(0))
                flat = np.bincount(code[text[word]] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                for i, name in enumerate(names):
                    totals[name] = totals.get(name, 0) + flat[i * BUCKETS : (i + 1) * BUCKETS]
        for name, counts in totals.items():
            seen = np.flatnonzero(counts)
            columns = [pa.array([name] * len(seen), pa.string()), pa.array(seen), pa.array(counts[seen])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counted = rows.where("text IS NOT NULL AND lang IS NOT NULL").mapInArrow(count, "lang string, bucket long, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(table["lang"].unique())
    counts = np.zeros((BUCKETS, len(langs)))
    place = {name: i for i, name in enumerate(langs)}
    counts[table["bucket"], table["lang"].map(place)] = table["n"]
    smooth = counts + 0.5 / max(1, len(langs))
    return langs, np.log(smooth / smooth.sum(axis=0)).astype(np.float32) if langs else counts.astype(np.float32)


def _proportions(like: np.ndarray, first: np.ndarray, allowed: np.ndarray, start: np.ndarray, rounds: int):
    """EM over all texts of a slice: proportions and log-likelihood of each text.

    ``like``: word by language; words of text ``t`` begin at ``first[t]``;
    ``allowed``: text by language.
    """
    share = np.where(allowed, start, 0)
    share /= share.sum(axis=1, keepdims=True)
    size = np.diff(np.append(first, len(like)))
    for _ in range(rounds):
        weight = like * np.repeat(share, size, axis=0)
        total = weight.sum(axis=1, keepdims=True)
        weight /= total
        share = np.add.reduceat(weight, first, axis=0) / size[:, None]
        share = np.where(allowed, share + 1e-9, 0)
        share /= share.sum(axis=1, keepdims=True)
    total = (like * np.repeat(share, size, axis=0)).sum(axis=1)
    return share, np.add.reduceat(np.log(total), first)


def infer(column, langs: list[str], model: np.ndarray, price: float = 3.0):
    """Language and score of each text of a slice, and its selected proportions."""
    n = len(column)
    share = np.zeros((n, len(langs)))
    pred = np.full(n, -1)
    if n and langs:
        bucket, word, text = _trigrams(column)
        if len(text):
            first_gram = np.flatnonzero(np.diff(word, prepend=-1))
            logs = np.add.reduceat(model[bucket], first_gram, axis=0).astype(np.float64) * TEMPER
            like = np.exp(logs - logs.max(axis=1, keepdims=True)) + 1e-12
            first = np.flatnonzero(np.diff(text, prepend=-1))
            rows = text[first]
            allowed = np.ones((len(rows), len(langs)), bool)
            flat = np.full((len(rows), len(langs)), 1 / len(langs))
            best, fit = _proportions(like, first, allowed, flat, ROUNDS)
            for _ in range(len(langs) - 1):
                weakest = np.where(allowed, best, 2).argmin(axis=1)
                fewer = allowed.copy()
                fewer[np.arange(len(rows)), weakest] = False
                fewer[~fewer.any(axis=1)] = allowed[~fewer.any(axis=1)]
                again, refit = _proportions(like, first, fewer, best + 1e-9, ROUNDS // 3)
                gain = (refit - fit + price > 0) & (allowed.sum(axis=1) > 1)
                if not gain.any():
                    break
                allowed[gain], best[gain], fit[gain] = fewer[gain], again[gain], refit[gain]
            share[rows] = best
            pred[rows] = best.argmax(axis=1)
    has_letter = pc.fill_null(pc.match_substring_regex(column.cast(pa.large_string()), r"\p{L}"), False)
    pred[~has_letter.to_numpy(zero_copy_only=False)] = -1
    return pred, share


def predicted_languages(
    docs: DataFrame,
    langs: list[str],
    model: np.ndarray,
    id_cols: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    price: float = 3.0,
) -> DataFrame:
    """``lang_pred``, ``score`` and ``lang_shares`` of whole texts, beside ``id_cols``.

    ``score`` is the proportion of the predicted language in the selected
    mixture (0 to 1), ``lang_shares`` the mixture itself. Null texts, texts
    without a letter and any text under a model without languages are ``und``
    with score 0 and no shares. Equal texts get equal results. Only ``id_cols``
    and the text are read; an empty table gives none.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((list(langs), model))
    picked = docs.select(*id_cols, F.col(text_col).cast("string").alias("text_"))
    schema = widened(docs.select(*id_cols).schema, "lang_pred string, score double, lang_shares map<string, double>")

    def predict(batches):
        names, table = held.value
        limit = max(1 << 16, (8 << 20) // max(4, len(names)))
        for batch in batches:
            for part in slices(batch, "text_", limit=limit):
                pred, share = infer(part.column(part.num_columns - 1), names, table, price)
                told = [names[i] if i >= 0 else "und" for i in pred]
                score = [float(share[t, i]) if i >= 0 else 0.0 for t, i in enumerate(pred)]
                mix = [
                    [(names[j], float(share[t, j])) for j in np.flatnonzero(share[t] > 1e-6)] if pred[t] >= 0 else []
                    for t in range(part.num_rows)
                ]
                kind = pa.map_(pa.string(), pa.float64())
                columns = [*part.columns[:-1], pa.array(told, pa.string()), pa.array(score, pa.float64()), pa.array(mix, kind)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:-1], "lang_pred", "score", "lang_shares"])

    return picked.mapInArrow(predict, schema)
