from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import runs as R
from llm_rows import odd_rows


def plain_runs(words, min_length=24, min_exponent=3):
    """All runs by comparing the words with themselves at every distance."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n_, q) for (s, n_), q in found.items()), key=lambda r: (r[0], r[2]))


def found_runs(texts, **kw):
    border = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    flat = np.array([w for t in texts for w in t], np.int64)
    out = R.find_runs(flat, border, **kw)
    return [[(int(s - a), int(n), int(q)) for s, n, q in out if a <= s < b] for a, b in zip(border, border[1:])]


WORDS = st.lists(st.integers(0, 2), max_size=90)
PERIODIC = st.tuples(st.lists(st.integers(0, 3), max_size=6), st.lists(st.integers(0, 3), min_size=1, max_size=14), st.integers(1, 12), WORDS).map(
    lambda t: t[0] + t[1] * t[2] + t[3]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(WORDS, PERIODIC), max_size=4), st.sampled_from([(24, 3), (6, 3), (4, 4), (9, 3)]))
def test_runs_equal_comparison_at_every_distance(texts, limits):
    length, exponent = limits
    assert found_runs(texts, min_length=length, min_exponent=exponent) == [plain_runs(t, length, exponent) for t in texts]


def test_suffix_array_and_lcps():
    rng = random.Random(1)
    for n in (0, 1, 2, 50, 200):
        words = [rng.randrange(3) for _ in range(n)]
        order, shared = R.suffixes(np.array(words, np.int64))
        assert order.tolist() == sorted(range(n), key=lambda i: words[i:])
        for k in range(1, n):
            a, b = words[order[k - 1] :], words[order[k] :]
            assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_one_word_repeated_and_a_passage_with_many_left_words():
    assert found_runs([[7] * 20_000]) == [[(0, 20_000, 1)]]
    passage = list(range(100, 120))
    many = [w for k in range(3_000) for w in (1_000 + k, *passage, 10_000 + k)]
    assert found_runs([many]) == [[]]
    with pytest.raises(ValueError, match="three periods"):
        found_runs([[1, 1]], min_exponent=2)


def expected(rows):
    out = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, h = len(words), None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = plain_runs(words)
        gone = {k for s, n_, q in runs for k in range(s + q, s + n_)}
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        spelled, left = "".join(f"{s},{n_},{q}\n" for s, n_, q in runs), " ".join(w for k, w in enumerate(words) if k not in gone)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (spelled, left)]
        out.append((i, len(runs), *top, 1000 * top[1] // top[2] if runs else None, *digests))
    return sorted(out, key=repr)


def test_query_equals_brute_force(docs_of):
    rng = random.Random(9)
    rows = [r for r in odd_rows() if not r[1] or len(r[1]) < 1_000]
    rows += [(100 + k, " ".join(rng.choices(["a", "b", "c,", "é", "\n", "x  y"], k=rng.randint(0, 120)))) for k in range(80)]
    rows += [(300 + k, "p q " + "one two three four " * 9 + "z " * 30) for k in range(40)]
    got = R.run_digest(R.collapse_runs(R.with_planted_runs(docs_of(rows))))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_long_texts_and_empty_table(docs_of):
    text = odd_rows()[4][1]
    got = R.collapse_runs(docs_of([(1, text), (2, f"{text} {text} {text}"), (None, "b " * 24)])).orderBy("doc_id").collect()
    n = len(text.split())
    assert [[tuple(r) for r in g.runs] for g in got] == [[(0, 24, 1)], [], [(0, 3 * n, n)]]
    assert [g.collapsed for g in got] == ["b", text, text]
    assert R.run_digest(R.collapse_runs(R.with_planted_runs(docs_of([(1, "x")]).limit(0)))).collect() == []
