"""Words and window hashes against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from ledgerloom.llm.words import WORD, slices, spaced, split_words, window_hashes, window_minima, word_hashes

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b\x1c\xa0|longword", max_size=60)), max_size=8)


def plain(text, lower=False):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
    return [w.encode() for w in re.findall(WORD, text)]


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_and_hashes(values):
    words = split_words(pa.array(values, pa.string()), lower=True)
    expected = [plain(t, True) for t in values]
    found = [[words.data[words.start[i] : words.end[i]].tobytes() for i in range(a, b)] for a, b in zip(words.first, words.first[1:])]
    assert found == expected
    flat = [w for t in expected for w in t]
    h = word_hashes(words)
    assert len(set(h.tolist())) == len(set(flat))
    for size in (1, 2, 3, 5):
        wide = window_hashes(h, size).tolist()
        assert len(wide) == max(0, len(flat) - size + 1)
        assert len(set(wide)) == len({tuple(flat[i : i + size]) for i in range(len(wide))})
        assert window_minima(h, size).tolist() == [i + int(np.argmin(h[i : i + size])) for i in range(len(wide))]
    text, start = spaced(words)
    assert text.tobytes() == b"".join(b" " + w for w in flat) + b" "
    assert all(text[s : s + len(w)].tobytes() == w for s, w in zip(start, flat))


def test_long_words_are_hashed_whole():
    words = split_words(pa.array(["w" * 5000 + "a " + "w" * 5000 + "b " + "w" * 5000 + "a"]))
    a, b, c = word_hashes(words)
    assert a == c != b


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 50, 0, 3, 200)] + [None])], ["t"])
    parts = list(slices(batch, "t", limit=55))
    assert sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()
    assert [p.num_rows for p in parts] == [3, 1, 1, 1]
