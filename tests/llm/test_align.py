from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import align as A
from ledgerlake.llm.queries import tokenizer_path
from llm_rows import odd_rows

ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \n b\n \nc", "x▁y", "<|endoftext|> hi <s> </s> <0x41>", "\t\ta  \tb   ", "é ß 漢字 😀 \u0085 x",
    "a\x00b", "ﬁ ½ Å", "a\xa0b 　c", "\n \n", "don't we'll", "   x", "\x1c y \x1d z", "é à ̀", "word " * 900,
]


@pytest.fixture(scope="module")
def tokenizers():
    return A.load_tokenizers(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def aligner(tokenizers):
    return A.Aligner(tokenizers)


def plain(aligner, text):
    """(ids of A, ids of B, groups, links) from whole-text encoding and interval arithmetic; None without tokens."""
    if not text:
        return None
    a, b = aligner.encode.a.encode(" " + text, add_special_tokens=False).ids, aligner.encode.b.encode(text)
    of_a, of_b = [aligner.encode.a_bytes[i] for i in a], [aligner.encode.b_bytes[i] for i in b]
    if not b"".join(of_a) == (" " + text).encode() == b"".join(of_b):
        return None
    ends_a, ends_b = (np.cumsum([len(x) for x in y]).tolist() for y in (of_a, of_b))
    starts_a, starts_b = [0, *ends_a], [0, *ends_b]
    spelled, low = [], 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        sides = [[str(i) for i, e in zip(ids, ends) if low < e <= cut] for ids, ends in ((a, ends_a), (b, ends_b))]
        spelled.append("|".join(map(",".join, sides)))
        low = cut
    links = [(x, y) for x, s, e in zip(a, starts_a, ends_a) for y, t, f in zip(b, starts_b, ends_b) if s < f and t < e]
    return a, b, spelled, links


def test_groups_and_links_equal_plain_interval_arithmetic(aligner):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choices("ab .\n\t   é'sl\x1f▁", k=rng.randint(1, 40))) for _ in range(400)]
    for text, got in zip(texts, aligner(texts)):
        want = plain(aligner, text)
        if want is None:
            assert got == (0, 0, 0, 0, "", b""), text
            continue
        a, b, spelled, links = want
        assert got[:5] == (len(a), len(b), len(spelled), len(links), ";".join(spelled)), text
        codes = np.frombuffer(got[5], "<u4").tolist()
        assert codes == sorted(x * aligner.width + y for x, y in links)


def test_chunks_that_come_again_are_not_forgotten(tokenizers, monkeypatch):
    monkeypatch.setattr(A, "MEMO", 60)
    encode, asked = A.PairEncoder(tokenizers), []
    add = encode.add
    encode.add = lambda chunks: asked.extend(chunks) or add(chunks)
    texts = [f"the cat's größe  the {' '.join(f'w{k}x{i}' for i in range(30))} the end cat's" for k in range(12)]
    for text in texts:
        (a, b), (a_at, b_at) = encode([text, None, text])
        (a1, b1), (a1_at, b1_at) = A.PairEncoder(tokenizers)([text, None, text])
        assert (a == a1).all() and (b == b1).all() and (a_at == a1_at).all() and (b_at == b1_at).all()
    assert asked.count("cat's") == 1 and asked.count("the") == 1 and len(encode.code) < 120


def test_lanes_give_what_one_lane_gives():
    rng = np.random.default_rng(5)
    total = 3_000
    ends = [np.unique(np.append(rng.integers(1, total, 900), [700, 701, 2_000, total])) for _ in range(2)]
    border = np.concatenate(([0], np.searchsorted(ends[0], [700, 701, 2_000, total]) + 1))
    one = A.lockstep(*ends, border, lane=10_000)
    for lane in (1, 3, 64):
        many = A.lockstep(*ends, border, lane=lane)
        assert sorted(zip(*one[:2])) == sorted(zip(*many[:2])) and (one[2] == many[2]).all() and (one[3] == many[3]).all()


def brute(aligner, rows):
    """Expected rows from whole-corpus counting."""
    found = [plain(aligner, t) for _, t in rows]
    counts = Counter(p for f in found if f for p in set(f[3]))
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for (i, _), f in zip(rows, found):
        a, b, spelled, links = f or ([], [], [], [])
        digest = hashlib.sha256(";".join(spelled).encode()).hexdigest() if spelled else ""
        best, total = sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links)
        out.append((i, len(a), len(b), len(spelled), len(links), digest, best, total))
    return sorted(out, key=repr)


@pytest.mark.parametrize("per_bucket", [2_000_000, 40])
def test_corpus_counts_equal_brute_force(spark, docs_of, tokenizers, aligner, per_bucket):
    rows = [(i, t) for i, t in odd_rows() if t is None or len(t) < 1_000] + [(100 + k, t[:400]) for k, t in enumerate(ODD)]
    rows += [(200 + k, "the same words in a third of all rows, again and again") for k in range(12)]
    got = A.aligned_corpus(docs_of(rows), tokenizers, hashed=True, per_bucket=per_bucket)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(aligner, rows)


def test_very_long_text_and_empty_table(docs_of, tokenizers, aligner):
    text = odd_rows()[4][1] * 3
    got = A.aligned_corpus(docs_of([(1, text)]), tokenizers).collect()[0]
    a, b = aligner.encode.a.encode(" " + text, add_special_tokens=False).ids, aligner.encode.b.encode(text)
    assert (got.n_a, got.n_b, got.n_best > 0) == (len(a), len(b), True)
    assert [x for g in got.groups.split(";") for x in g.split("|")[0].split(",")] == list(map(str, a))
    assert A.aligned_corpus(docs_of([(1, "x")]).limit(0), tokenizers).collect() == []
