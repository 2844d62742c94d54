from __future__ import annotations

import hashlib
import random

import numpy as np

from ledgerlake.llm import substring as S
from ledgerlake.llm.wordhash import WordHasher, window_hashes, word_spans
from llm_rows import odd_rows

LOW = -(1 << 63)


def expected(rows, window=20):
    """(doc_id, text) -> (words, removed, digest) by looking at every window."""
    docs = sorted({(LOW if i is None else i, t or "") for i, t in rows})
    first: dict = {}
    for d, (_, t) in enumerate(docs):
        words = t.encode().split()
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), (d, i))
    out = {}
    for d, (i, t) in enumerate(docs):
        words = t.encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] != (d, k):
                gone[k : k + window] = [True] * window
        kept = [w for w, g in zip(words, gone) if not g]
        out.setdefault(i, set()).add((len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def check(docs, rows, **kw):
    got = S.kept_digest(S.substring_dedup(docs, **kw)).collect()
    assert len(got) == len(rows)
    want = expected(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_sha256) in want[LOW if r.doc_id is None else r.doc_id], r


def test_word_hashes_depend_on_the_word_alone():
    text = b"alpha beta alpha  gamma\nbeta x"
    buf = np.frombuffer(text, np.uint8)
    s, e = word_spans(buf)
    assert [text[a:b] for a, b in zip(s, e)] == text.split()
    h = WordHasher()(buf, s, e)
    assert h[0] == h[2] and h[1] == h[4] and len(set(h.tolist())) == 4
    other = np.frombuffer(b"zz alpha", np.uint8)
    assert WordHasher()(other, *word_spans(other))[1] == h[0]
    w = window_hashes(np.concatenate([h, h]), 3)
    assert w[0] == w[6] and len(window_hashes(h[:2], 3)) == 0


def test_odd_rows(spark, docs_of):
    # ties between equal ids with other texts follow a hash, so the check covers rows without shared windows there
    check(docs_of(odd_rows()), odd_rows())
    assert S.substring_dedup(docs_of(odd_rows()).limit(0)).count() == 0


def test_repeats_at_any_shift_across_and_within_documents(spark, docs_of):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 6)))
    passages = [[word() for _ in range(n)] for n in (19, 20, 21, 33, 75)]
    rows = []
    for i in range(60):
        words = [word() for _ in range(rng.randint(0, 90))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = p
        rows.append((100 - i, rng.choice([" ", "\n", "  \t"]).join(words)))
    rows += [(500, "same " * 47), (501, rows[0][1]), (502, rows[0][1]), (499, "a b " * 30)]
    check(docs_of(rows, parts=5), rows)
    check(docs_of(rows, parts=2), rows, bucket_windows=50)
