"""Repeated passages found by phrase automata.

A passage of ``window`` words or more that occurs twice holds, in every window,
the same least-hash phrase of a few words. Such phrases are collected from all
documents and those that recur are kept as text. Each block of documents gets
the recurring phrases of its documents, compiled into one Aho-Corasick
automaton (the automaton of all phrases, sharded by block), and its documents
are streamed through it, which locates every occurrence. Windows around the
located phrases are then confirmed: a window is a repeat if the same word
sequence starts at another place anywhere in the corpus.

Windows are compared by a 64-bit hash inside a shard of the key space. Shards
grow in number with the corpus, so the chance that a window is taken for a
repeat wrongly stays below one in 10 ** 12 per window.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.blocks import answered, pack, pack_sorted, rows_of, shard_cuts, shard_count, summed, unpack, unpack_sorted, write_blocks
from ledgerloom.llm.words import Words, spaced, split_words, widened, window_hashes, window_minima, word_hashes
from ledgerloom.session import scratch_dir

WINDOW = 35
PHRASE = 8


def _window_starts(words: Words, window: int) -> np.ndarray:
    """Words at which a window of one text begins."""
    last = np.repeat(words.first[1:], np.diff(words.first))
    return np.flatnonzero(np.arange(len(words.start)) + window <= last)


def _phrases(words: Words, window: int, size: int) -> np.ndarray:
    """First words of the phrases that stand for the windows of these texts."""
    starts = _window_starts(words, window)
    if not len(starts):
        return starts
    least = window_minima(window_hashes(word_hashes(words, 1), size), window - size + 1)
    return np.unique(least[starts])


def _recurring(blocks: DataFrame, text_col: str, window: int, size: int) -> DataFrame:
    """Phrases that occur twice or more in the corpus, as one list per block."""

    def collect(batches):
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = split_words(rows_of(payload.as_buffer()).column(text_col))
                at = _phrases(words, window, size)
                text, start = spaced(words)
                length = words.end - words.start
                held = text.tobytes()
                found: dict[bytes, int] = {}
                for begin, end in zip((start[at] - 1).tolist(), (start[at + size - 1] + length[at + size - 1] + 1).tolist(), strict=True):
                    phrase = held[begin:end]
                    found[phrase] = found.get(phrase, 0) + 1
                columns = [pa.array(list(found), pa.binary()), pa.array([block] * len(found), pa.int64()), pa.array(list(found.values()), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["phrase", "block", "n"])

    rows = blocks.select("block", "payload").mapInArrow(collect, "phrase binary, block long, n int")
    # A phrase has a row per block at most; AQE splits the join if one is in very many.
    total = rows.groupBy("phrase").agg(F.sum("n").alias("total")).where("total > 1").select("phrase")
    kept = rows.join(total, "phrase").groupBy("block").agg(F.collect_list("phrase").alias("phrases"))
    where = scratch_dir(blocks.sparkSession, "phrases")
    kept.write.parquet(where)
    return blocks.sparkSession.read.parquet(where)


def _automaton(phrases: list[bytes], size: int) -> ahocorasick.Automaton:
    """Phrases, with a space at either end, as characters of one byte each."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for phrase in phrases:
        automaton.add_word(phrase.decode("latin-1"))
    automaton.make_automaton()
    return automaton


def _candidates(words: Words, phrases: list[bytes], window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that hold a located phrase: first word and hash."""
    automaton = _automaton(phrases, size)
    text, start = spaced(words)
    ends = np.fromiter((end for end, _ in automaton.iter(text.tobytes().decode("latin-1"))), np.int64)
    # The character after a phrase is the space before the word that follows it.
    after = np.searchsorted(start, ends)
    phrase_at = after - size
    mark = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(mark, np.maximum(0, phrase_at - (window - size)), 1)
    np.add.at(mark, phrase_at + 1, -1)
    near = np.cumsum(mark[:-1]) > 0
    starts = _window_starts(words, window)
    starts = starts[near[starts]]
    return starts, window_hashes(word_hashes(words, 2), window)[starts] if len(starts) else np.zeros(0, np.uint64)


def _repeat_bits(blocks: DataFrame, phrases: DataFrame, text_col: str, window: int, size: int, shards: int) -> DataFrame:
    """Per block and shard: one bit per distinct candidate window, set if it is a repeat."""

    def ask(batches):
        for batch in batches:
            for block, payload, mine in zip(*batch.columns, strict=True):
                words = split_words(rows_of(payload.as_buffer()).column(text_col))
                _, hashes = _candidates(words, mine.as_py(), window, size)
                keys, counts = np.unique(hashes, return_counts=True)
                used, cuts = shard_cuts(keys, shards)
                spans = list(zip(cuts[:-1], cuts[1:], strict=True))
                columns = [
                    pa.array(np.zeros(len(used), np.int32)),
                    pa.array(used.astype(np.int32)),
                    pa.array([block.as_py()] * len(used), pa.int64()),
                    pa.array([pack_sorted(keys[a:b]) for a, b in spans], pa.binary()),
                    pa.array([pack(counts[a:b].astype(np.uint32)) for a, b in spans], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["space", "shard", "block", "keys", "counts"])

    def answer(space, shard, table):
        keys = [unpack_sorted(x) for x in table["keys"].to_pylist()]
        counts = [unpack(x, np.uint32).astype(np.int64)[:, None] for x in table["counts"].to_pylist()]
        bits = [np.packbits(t[:, 0] > 1).tobytes() for t in summed(keys, counts)]
        columns = [table["block"].combine_chunks(), pa.array([shard] * len(bits), pa.int32()), pa.array(bits, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "shard", "bits"])

    asked = blocks.select("block", "payload").join(phrases, "block").select("block", "payload", "phrases")
    requests = asked.mapInArrow(ask, "space int, shard int, block long, keys binary, counts binary")
    bits = answered(requests, answer, "block long, shard int, bits binary")
    kept = bits.groupBy("block").agg(F.collect_list(F.struct("shard", "bits")).alias("bits"))
    where = scratch_dir(blocks.sparkSession, "repeats")
    kept.write.parquet(where)
    return blocks.sparkSession.read.parquet(where)


def without_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words_``, ``n_removed_`` and ``kept_``.

    A word goes if a window of ``window`` words covers it whose word sequence also
    starts anywhere else, in the same document or another row; windows are those
    of the input. ``kept_`` is the other words joined by one space. Null and empty
    texts have no words; repeated rows repeat each other's windows; documents
    shorter than a window lose nothing; an empty table gives none. The three
    names end in an underscore, so that columns of ``docs`` stay as they are.
    """
    spark = docs.sparkSession
    blocks = write_blocks(docs, text_col)
    shards = shard_count(blocks)
    phrases = _recurring(blocks, text_col, window, phrase)
    bits = _repeat_bits(blocks, phrases, text_col, window, phrase, shards)
    joined = blocks.select("block", "payload").join(phrases, "block", "left").join(bits, "block", "left")
    schema = widened(docs.schema, "n_words_ long, n_removed_ long, kept_ string")
    names = schema.fieldNames()

    def remove(batches):
        for batch in batches:
            for payload, mine, told in zip(*batch.columns, strict=True):
                rows = rows_of(payload.as_buffer())
                words = split_words(rows.column(text_col))
                gone = np.zeros(len(words.start) + 1, np.int64)
                told = told.as_py()
                if told:
                    starts, hashes = _candidates(words, mine.as_py(), window, phrase)
                    keys = np.unique(hashes)
                    used, cuts = shard_cuts(keys, shards)
                    repeat = np.zeros(len(keys), bool)
                    for part in told:
                        place = np.searchsorted(used, part["shard"])
                        a, b = cuts[place], cuts[place + 1]
                        repeat[a:b] = np.unpackbits(np.frombuffer(part["bits"], np.uint8), count=b - a)
                    first = starts[repeat[np.searchsorted(keys, hashes)]]
                    np.add.at(gone, first, 1)
                    np.add.at(gone, first + window, -1)
                removed = np.cumsum(gone[:-1]) > 0
                total = np.concatenate([[0], np.cumsum(removed)])
                n = np.diff(words.first)
                n_removed = total[words.first[1:]] - total[words.first[:-1]]
                kept = Words(words.data, words.start[~removed], words.end[~removed], words.first - total[words.first])
                text, start = spaced(kept)
                held, begin = text.tobytes(), np.append(start, len(text))
                texts = [held[begin[a] : max(begin[a], begin[b] - 1)] for a, b in zip(kept.first[:-1], kept.first[1:], strict=True)]
                columns = [*rows.columns, pa.array(n, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return joined.select("payload", "phrases", "bits").mapInArrow(remove, schema)
