"""Blocks of documents, and counts of keys across blocks.

Some operators need, for every position of every text, a number that the whole
corpus decides (how often a window or an n-gram occurs). Rows of one position
each would be many times the text. Here documents are stored once as blocks of
a few megabytes (compressed, one row per block); a block asks for its distinct
keys, sorted and packed per shard of the key space; a shard adds up what all
blocks hold and answers in the order of the keys. Shards are many enough to
hold about ``SHARD_KEYS`` keys each; a key that occurs everywhere is one entry
per block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.words import slices, split_words
from ledgerloom.session import scratch_dir

BLOCK_BYTES = 3 << 20
SHARD_KEYS = 1 << 20


def write_blocks(docs: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows and columns of ``docs`` as blocks: ``block``, ``n_words``, ``payload``.

    Block numbers are given as the table is written and stay as stored.
    """

    def pack(batches):
        for batch in batches:
            for part in slices(batch, text_col, limit=block_bytes):
                words = len(split_words(part.column(text_col)).start)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(part)
                payload = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([words], pa.int64()), payload], ["n_words", "payload"])

    spark = docs.sparkSession
    where = scratch_dir(spark, "blocks")
    packed = docs.mapInArrow(pack, "n_words long, payload binary")
    packed.select(F.monotonically_increasing_id().alias("block"), "n_words", "payload").write.option("compression", "none").parquet(where)
    return spark.read.parquet(where)


def rows_of(payload: bytes) -> pa.RecordBatch:
    """The rows of a block."""
    return next(iter(pa.ipc.open_stream(payload)))


def shard_count(blocks: DataFrame, keys_per_word: float = 1.0) -> int:
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    return max(1, math.ceil(total * keys_per_word / SHARD_KEYS))


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes; sorted ones should come as differences."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key: shards are equal ranges of the key space, so sorted keys have sorted shards."""
    return (((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def shard_cuts(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards that sorted keys lie in, and where the keys of each begin (and the last end).

    The work is that of the keys, however many shards there are.
    """
    used, begin = np.unique(shards_of(keys, shards), return_index=True)
    return used, np.append(begin, len(keys))


def answered(requests: DataFrame, answer: Callable[..., Iterator], schema: str) -> DataFrame:
    """One call per (``space``, ``shard``) of ``requests``: keys of all its blocks meet.

    ``requests`` has space, shard, block, ``keys`` (``pack_sorted``) and ``counts``
    (packed arrays). ``answer(space, shard, table)`` gets all requests of a shard
    and yields Arrow batches of ``schema``.
    """

    def run(key, table):
        return pa.Table.from_batches(answer(key[0].as_py(), key[1].as_py(), table))

    return requests.groupBy("space", "shard").applyInArrow(run, schema)


def summed(requests: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """For each request, the totals of its keys over all requests (counts: rows by kind)."""
    size = [len(k) for k in requests]
    keys = np.concatenate(requests) if requests else np.zeros(0, np.uint64)
    if not len(keys):
        return [np.zeros((0, counts[0].shape[1]) if counts else (0, 1), np.int64) for _ in requests]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    fresh = np.ones(len(ranked), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    begin = np.flatnonzero(fresh)
    totals = np.add.reduceat(np.concatenate(counts)[order], begin, axis=0)
    out = np.empty((len(keys), totals.shape[1]), np.int64)
    out[order] = totals[np.cumsum(fresh) - 1]
    return np.split(out, np.cumsum(size)[:-1])
