import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from .brute import folded
from folioscan.llm.words import WordReader, distinct_per_row, plain_words, repeats_per_row, space_words

texts = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\nabAZ09é中!-\x1c\xa0", max_size=30)), max_size=12)
SPACE, PLAIN = WordReader(space_words()), WordReader(plain_words())


@given(texts)
@settings(max_examples=150, deadline=None)
def test_words_and_hashes(rows):
    seen = {}
    for reader, cut in ((SPACE, lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())), (PLAIN, folded)):
        for low, high, words in reader.read(pa.array(rows, pa.string())):
            for i in range(low, high):
                a, b = words.first[i - low], words.first[i - low + 1]
                want = cut(rows[i])
                assert b - a == len(want)
                assert (words.row[a:b] == i - low).all()
                for word, value in zip(want, words.hash[a:b]):
                    assert seen.setdefault((reader is SPACE, word), value) == value
    for kind in (True, False):
        mine = [v for (space, _), v in seen.items() if space == kind]
        assert len(set(mine)) == len(mine)


@given(texts, st.integers(1, 6))
@settings(max_examples=100, deadline=None)
def test_shingles(rows, size):
    values = {}
    for low, high, words in PLAIN.read(pa.array(rows, pa.string())):
        value, row = words.shingles(size)
        for i in range(low, high):
            cut = folded(rows[i])
            want = [tuple(cut[k : k + size]) for k in range(max(len(cut) - size + 1, 1))] if cut else []
            got = value[row == i - low]
            assert len(got) == len(want)
            for run, v in zip(want, got):
                assert values.setdefault(run, v) == v
    assert len(set(values.values())) == len(values)


def test_a_text_longer_than_a_chunk():
    long = "ab cd " * 400_000
    rows = [(low, high, len(w.start)) for low, high, w in SPACE.read(pa.array(["x", long, "y z"]))]
    assert sum(n for *_, n in rows) == 1 + 800_000 + 2 and rows[-1][1] == 3


def test_distinct_and_repeats():
    values, rows = np.array([5, 3, 5, 3, 9], np.uint64), np.array([0, 0, 0, 2, 2])
    got = distinct_per_row(values, rows)
    assert [x.tolist() for x in got] == [[3, 5, 3, 9], [0, 0, 2, 2], [1, 2, 1, 1]]
    spread = values << np.uint64(50)
    owner, times = repeats_per_row(spread, rows)
    assert owner.tolist() == [0, 0, 2, 2] and sorted(times.tolist()) == [1, 1, 1, 2]
