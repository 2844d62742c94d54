from __future__ import annotations

import random

from ledgerlake.llm import lines as L
from llm_rows import odd_rows

LOW = -(1 << 63)


def expected(rows, min_words=5):
    """(doc_id, text) -> kept text: a line goes if it lies in a run of two or more, or is a long line, that also starts earlier."""
    docs = sorted({(LOW if i is None else i, t) for i, t in rows if t is not None})
    seqs = [[(k, r) for k, r in enumerate(t.split("\n")) if r.encode().split()] for _, t in docs]
    starts: dict = {}
    for d, seq in enumerate(seqs):
        for i, (_, line) in enumerate(seq):
            starts.setdefault(line, []).append((d, i))
    out = {(i, None): None for i, t in rows if t is None}
    for d, ((key, text), seq) in enumerate(zip(docs, seqs)):
        gone = set()
        for i in range(len(seq)):
            longest = 0
            for e, j in starts[seq[i][1]]:
                if (e, j) >= (d, i):
                    continue
                n = 0
                while i + n < len(seq) and j + n < len(seqs[e]) and seq[i + n][1] == seqs[e][j + n][1]:
                    n += 1
                longest = max(longest, n)
            if longest > 1 or (longest == 1 and len(seq[i][1].encode().split()) >= min_words):
                gone.update(seq[k][0] for k in range(i, i + longest))
        kept = "\n".join(r for k, r in enumerate(text.split("\n")) if k not in gone)
        out[None if key == LOW else key, text] = kept
    return out


def check(docs, rows):
    got = L.line_dedup(docs)
    assert got.columns == [*docs.columns, "_lines"]
    want, rows_got = expected(rows), got.collect()
    assert len(rows_got) == len(rows)
    for r in rows_got:
        assert r._lines.text == want[r.doc_id, r.text], r


def test_odd_rows(spark, docs_of):
    check(docs_of(odd_rows()), odd_rows())
    assert L.line_dedup(docs_of(odd_rows()).limit(0)).count() == 0


def test_runs_of_any_length_within_and_across_documents(spark, docs_of):
    rng = random.Random(8)
    pool = [" ".join(rng.choices(["u", "v", "w", "x"], k=rng.choice([1, 2, 6]))) + f" {i}" for i in range(14)] + ["", "  "]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(40)]
    run = [f"line {k} of a long run" for k in range(37)]
    rows += [(200, "\n".join(["first"] + run)), (150, "\n".join(run[3:] + ["last"])), (300, "\n".join(run)), (301, "\n".join(["same"] * 9))]
    check(docs_of(rows, parts=4), rows)


def test_ranks_follow_the_order_of_the_runs(spark):
    rows = [(1, 0, i, ord(c), 0, True) for i, c in enumerate("banana")]
    lines = spark.createDataFrame(rows, "key long, tag long, i int, h long, g long, enough boolean")
    classes, _ = L._ranked(lines, ["h", "g"], "test-rank")
    assert [r.h for r in classes.orderBy("to").collect()] == [ord("a"), ord("n")]
    runs = {(r.i, r.n_lines): tuple(r.source) for r in L.repeated_runs(lines).collect()}
    # "ana" occurs at 1 and 3: single lines at 3, 4, 5 and the pairs at 3 and 4 start earlier too
    assert runs == {(3, 1): (1, 0, 1), (4, 1): (1, 0, 2), (5, 1): (1, 0, 1), (3, 2): (1, 0, 1), (4, 2): (1, 0, 2)} | {}
