"""A language model by deleted interpolation.

Maximum-likelihood estimates of n-grams of all orders up to ``order`` and the
uniform one are mixed. The weights of the mixture depend on how often the
context was seen (a bucket per power of two) and are learned by
expectation-maximisation on a deleted part of the learned documents: there the
estimates come from the other part. Scores use estimates from both parts.

Counts are those of all learned documents. Blocks of documents ask shards of
the key space for the counts of their n-grams (see ``blocks``), so a key that
is everywhere is one entry per block, and no table of n-grams reaches the
driver. What expectation-maximisation works on is a histogram of the deleted
part over context bucket and estimates in steps of an eighth of an octave: its
size is bounded by the steps, and its sums are over all tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.blocks import answered, pack, pack_sorted, rows_of, shard_cuts, shard_count, summed, unpack, unpack_sorted, write_blocks
from ledgerloom.llm.words import joined, mixed, split_words, widened, word_hashes
from ledgerloom.session import scratch_dir

ORDER = 2
ROUNDS = 60
CONTEXTS = 40
STEPS = 8
KEPT, DELETED, UNSEEN = 0, 1, 2

_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


class _Tokens:
    """Tokens of a block with ``order - 1`` start marks before and an end after each text.

    ``grams[k]`` has the hash of the ``k + 1`` tokens that end at each place,
    ``whole[k]`` marks the places where they lie in one text.
    """

    def __init__(self, rows: pa.RecordBatch, order: int):
        words = split_words(rows.column("text"), lower=True)
        h = word_hashes(words, 3)
        n, lead = np.diff(words.first), order - 1
        size = n + lead + 1
        self.first = np.concatenate([[0], np.cumsum(size)])
        total = int(self.first[-1])
        self.text = np.repeat(np.arange(len(n)), size)
        inside = np.arange(total) - self.first[self.text]
        self.token = inside >= lead
        tokens = np.full(total, _START, np.uint64)
        tokens[(inside >= lead) & (inside < lead + n[self.text])] = h
        tokens[inside == lead + n[self.text]] = _END
        self.grams, self.whole = [mixed(tokens)], [np.ones(total, bool)]
        for k in range(1, order):
            longer = np.zeros(total, np.uint64)
            longer[k:] = joined(self.grams[-1][: total - k] if k == 1 else self.grams[-1][k - 1 : total - 1], tokens[k:])
            self.grams.append(longer)
            self.whole.append(inside >= k)
        self.part = rows.column("part").to_numpy(zero_copy_only=False)[self.text]

    def asked(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys of order ``k + 1``, and the kept and deleted counts here."""
        at = np.flatnonzero(self.whole[k] if k + 1 < len(self.grams) else self.token)
        keys, place = np.unique(self.grams[k][at], return_inverse=True)
        kept = np.bincount(place[self.part[at] == KEPT], minlength=len(keys))
        deleted = np.bincount(place[self.part[at] == DELETED], minlength=len(keys))
        return keys, kept, deleted


def _start_key() -> np.uint64:
    return mixed(np.array([_START]))[0]


def _answers(blocks: DataFrame, order: int, shards: int) -> DataFrame:
    """Per block, order and shard: kept and deleted totals of the block's keys.

    Rows with a null block have the sums of an order's shard: distinct keys
    ever seen in learned documents, and their occurrences, kept and deleted
    (start marks left out).
    """

    def ask(batches):
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = _Tokens(rows_of(payload.as_buffer()), order)
                for k in range(order):
                    keys, kept, deleted = tokens.asked(k)
                    used, cuts = shard_cuts(keys, shards)
                    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
                    counts = np.stack([kept, deleted], axis=1).astype(np.uint32)
                    columns = [
                        pa.array(np.full(len(used), k, np.int32)),
                        pa.array(used.astype(np.int32)),
                        pa.array([block] * len(used), pa.int64()),
                        pa.array([pack_sorted(keys[a:b]) for a, b in spans], pa.binary()),
                        pa.array([pack(counts[a:b].reshape(-1)) for a, b in spans], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["space", "shard", "block", "keys", "counts"])

    def answer(space, shard, table):
        keys = [unpack_sorted(x) for x in table["keys"].to_pylist()]
        counts = [unpack(x, np.uint32).astype(np.int64).reshape(-1, 2) for x in table["counts"].to_pylist()]
        totals = summed(keys, counts)
        flat, first = np.unique(np.concatenate(keys), return_index=True)
        every = np.concatenate(totals)[first]
        every = every[flat != _start_key()] if space == 0 else every
        sums = [int((every.sum(axis=1) > 0).sum()), int((every[:, 0] > 0).sum()), *every.sum(axis=0).tolist()]
        n = len(keys)
        columns = [
            pa.array([*table["block"].to_pylist(), None], pa.int64()),
            pa.array([space] * (n + 1), pa.int32()),
            pa.array([shard] * (n + 1), pa.int32()),
            pa.array([*[pack(t.astype(np.uint64).reshape(-1)) for t in totals], None], pa.binary()),
            pa.array([*[None] * n, sums], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["block", "space", "shard", "totals", "sums"])

    requests = blocks.select("block", "payload").mapInArrow(ask, "space int, shard int, block long, keys binary, counts binary")
    answers = answered(requests, answer, "block long, space int, shard int, totals binary, sums array<bigint>")
    where = scratch_dir(blocks.sparkSession, "counts")
    answers.write.parquet(where)
    return blocks.sparkSession.read.parquet(where)


def _counted(payload, told, order: int, shards: int) -> tuple[_Tokens, pa.RecordBatch, np.ndarray, np.ndarray]:
    """A block's tokens, its rows, and per order and place the kept and deleted counts
    of the n-gram and of its context."""
    rows = rows_of(payload.as_buffer())
    tokens = _Tokens(rows, order)
    grams = np.zeros((order, len(tokens.text), 2), np.int64)
    for k in range(order):
        keys, _, _ = tokens.asked(k)
        used, cuts = shard_cuts(keys, shards)
        totals = np.zeros((len(keys), 2), np.int64)
        for part in told:
            if part["space"] == k:
                place = np.searchsorted(used, part["shard"])
                a, b = cuts[place], cuts[place + 1]
                totals[a:b] = unpack(part["totals"], np.uint64).astype(np.int64).reshape(-1, 2)
        at = tokens.whole[k] if k + 1 < order else tokens.token
        grams[k, at] = totals[np.searchsorted(keys, tokens.grams[k][at])]
    contexts = np.zeros_like(grams)
    contexts[1:, 1:] = grams[:-1, :-1]
    return tokens, rows, grams, contexts


def _estimates(grams: np.ndarray, contexts: np.ndarray, total: int, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of orders 0 to ``order`` per place, and the bucket of the longest context.

    Order 0 is uniform over the distinct tokens and one for all others.
    """
    order = len(grams)
    out = np.zeros((order + 1, grams.shape[1]))
    out[0] = 1 / (distinct + 1)
    out[1] = grams[0] / max(1, total)
    for k in range(1, order):
        np.divide(grams[k], contexts[k], out=out[k + 1], where=contexts[k] > 0)
    bucket = np.zeros(grams.shape[1], np.int64)
    if order > 1:
        seen = contexts[order - 1]
        bucket = np.minimum(np.ceil(np.log2(seen + 1)).astype(np.int64), CONTEXTS - 1)
    return out, bucket


def mixture_weights(histogram: DataFrame, order: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (context bucket by order 0 to ``order``) that fit a histogram of estimates.

    ``histogram`` has ``bucket``, ``steps`` (per order, the estimate as eighths of
    an octave below 1; null: 0) and ``n``. Buckets are fitted apart from each
    other, one task each; a bucket has a bounded number of cells. Buckets
    without tokens take the weights of all tokens; without any, all weight is on
    order 0. No weight is zero, so every token has a probability.
    """

    def fit(key, table):
        steps = np.array([[np.inf if x is None else x for x in row] for row in table["steps"].to_pylist()])
        n = table["n"].to_numpy()
        p = 2.0 ** (-steps / STEPS)
        weights = np.full(order + 1, 1 / (order + 1))
        for _ in range(rounds):
            share = p * weights
            share *= (n / share.sum(axis=1))[:, None]
            weights = share.sum(axis=0) / n.sum()
        columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([int(n.sum())]), pa.array([weights.tolist()], pa.list_(pa.float64()))]
        return pa.Table.from_arrays(columns, ["bucket", "n", "weights"])

    found = histogram.groupBy("bucket").applyInArrow(fit, "bucket int, n long, weights array<double>").collect()
    weights = np.tile(np.eye(order + 1)[0], (CONTEXTS, 1))
    if found:
        total = sum(row["n"] for row in found)
        weights[:] = sum(np.array(row["weights"]) * row["n"] for row in found) / total
    for row in found:
        weights[row["bucket"]] = row["weights"]
    weights = np.maximum(weights, 1e-6)
    return weights / weights.sum(axis=1, keepdims=True)


def scored_documents(docs: DataFrame, learn_col: str, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log-probabilities of whole texts under a model learned from some of them.

    ``learn_col`` is 0 for documents that give estimates, 1 for the deleted part
    (weights are learned there), 2 or null for documents that teach nothing.
    Returns per row of ``docs`` the id, ``n_tokens`` (words, A to Z lower-cased,
    and one end), ``n_known`` (tokens seen in learned documents),
    ``train_tokens``, ``base_score`` (sum of log10 of (count + 0.5) / (tokens + 0.5
    * (distinct + 1))) and ``score``, the model's log10 probability. A null text
    is an empty one (its end is a token); equal texts score the same; with
    nothing learned every token has the uniform probability. Ids, null or
    repeated, are only passed on. Other columns are ignored; an empty table
    gives none.
    """
    spark = docs.sparkSession
    part = F.coalesce(F.col(learn_col).cast("int"), F.lit(UNSEEN))
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), part.alias("part"))
    blocks = write_blocks(picked, "text")
    shards = shard_count(blocks)
    answers = _answers(blocks, order, shards)
    sums = answers.where("block IS NULL AND space = 0").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"c{i}") for i in range(4)]).first()
    distinct, distinct_kept, kept, deleted = [x or 0 for x in sums]
    told = answers.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("space", "shard", "totals")).alias("told"))
    both = blocks.select("block", "payload").join(told, "block").select("payload", "told")

    def observe(batches):
        """Histogram of the deleted part, estimates from the kept part."""
        for batch in batches:
            for payload, mine in zip(*batch.columns, strict=True):
                tokens, _, grams, contexts = _counted(payload, mine.as_py(), order, shards)
                at = np.flatnonzero(tokens.token & (tokens.part == DELETED))
                p, bucket = _estimates(grams[:, at, 0], contexts[:, at, 0], kept, distinct_kept)
                with np.errstate(divide="ignore"):
                    steps = np.where(p > 0, np.round(-np.log2(p) * STEPS), -1).astype(np.int64)
                rows, n = np.unique(np.concatenate([bucket[None], steps]).T, axis=0, return_counts=True)
                cells = pa.array(rows[:, 1:].reshape(-1), mask=rows[:, 1:].reshape(-1) < 0)
                lists = pa.ListArray.from_arrays(np.arange(0, len(cells) + 1, order + 1, dtype=np.int32), cells)
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0], pa.int32()), lists, pa.array(n, pa.int64())], ["bucket", "steps", "n"])

    where = scratch_dir(spark, "held-out")
    both.mapInArrow(observe, "bucket int, steps array<bigint>, n long").groupBy("bucket", "steps").agg(F.sum("n").alias("n")).write.parquet(where)
    weights = mixture_weights(spark.read.parquet(where), order)

    def score(batches):
        total = kept + deleted
        for batch in batches:
            for payload, mine in zip(*batch.columns, strict=True):
                tokens, rows, grams, contexts = _counted(payload, mine.as_py(), order, shards)
                grams, contexts = grams.sum(axis=2), contexts.sum(axis=2)
                p, bucket = _estimates(grams, contexts, total, distinct)
                logs = np.log10((p * weights[bucket].T).sum(axis=0))
                base = np.log10((grams[0] + 0.5) / (total + 0.5 * (distinct + 1)))
                n = rows.num_rows
                adding = lambda x: np.bincount(tokens.text, weights=np.where(tokens.token, x, 0), minlength=n)
                columns = [
                    rows.column("id"),
                    pa.array(adding(1.0).astype(np.int64)),
                    pa.array(adding((grams[0] > 0).astype(float)).astype(np.int64)),
                    pa.array(np.full(n, total), pa.int64()),
                    pa.array(adding(base)),
                    pa.array(adding(logs)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    schema = widened(picked.select("id").schema, "n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return both.mapInArrow(score, schema).withColumnRenamed("id", id_col)
