from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerlake.llm import simhash as S
from ledgerlake.llm.common import mark_copies, scratch_table
from ledgerlake.llm.lines import line_dedup
from ledgerlake.llm.mixing import MIXED, mix

OWN = ["_key", "_tag", "_spans", "_is_copy", "_head", "_rows", "_lines", "w_mix", "n_mix", "source_mix", "lang_mix", "kept_mix", "r", "id", "head", "rows", "spans", "is_copy", "a.b"]
LONG = "a line of more than five words that is repeated in other documents"
TEXTS = [f"{LONG}\nfirst words of its own here", f"{LONG}\nquite another text with some more words", "short", "short", None, ""]


@pytest.fixture
def named(docs_of):
    docs = docs_of([(k, t) for k, t in enumerate(TEXTS)])
    return docs.withColumns({c: F.concat(F.lit(c + "="), F.col("doc_id").cast("string")) for c in OWN})


def _own(df):
    return {r.doc_id: [r[c] for c in OWN] for r in df.select("doc_id", *[f"`{c}`" for c in OWN]).collect()}


@pytest.mark.parametrize("stage", [P.line_dedup_stage, P.simhash_near_dedup, P.mix_to_targets])
def test_the_callers_columns_pass_unchanged(spark, named, stage):
    before, out = _own(named), stage(spark, named, "")
    assert out.columns == named.columns
    after = _own(out)
    assert after and all(before[i] == row for i, row in after.items())


def test_names_of_the_results_are_replaced(named):
    assert line_dedup(named).columns == [c for c in named.columns if c != "_lines"] + ["_lines"]
    out = mix(named)
    assert out.columns == [c for c in named.columns if c not in MIXED] + list(MIXED)
    assert out.filter("w_mix >= 0").count() == len(TEXTS)


def test_copies_of_one_text_in_a_third_of_the_rows(spark):
    rows = [(k, 7 if k % 3 == 0 else 100 + k // 2, 1) for k in range(300)]
    ids, _ = scratch_table(spark.createDataFrame(rows, "key long, tag long, tag2 long"), "test-ids")
    first = {}
    for k, t, _ in rows:
        first[t] = min(first.get(t, k), k)
    assert {(r.key, r.is_copy) for r in mark_copies(ids).collect()} == {(k, first[t] != k) for k, t, _ in rows}


def test_the_count_filter_comes_first_and_removes_pairs():
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    fp[1::2] = fp[::2] ^ (np.uint64(1) << rng.integers(0, 63, 200, dtype=np.uint64))  # near copies
    fp |= np.uint64(0xABCDEF)  # three bytes that all share, as the members of one list do
    x = fp[:, None] ^ fp[None, :]
    tally = S.shared_bytes(x)
    assert (tally == (x[..., None].view(np.uint8).reshape(400, 400, 8) == 0).sum(axis=2)).all()
    near = np.bitwise_count(x) <= 4
    assert (near & (tally < 4)).sum() == 0  # the filter loses none
    assert (tally >= 4).sum() < 0.2 * tally.size  # and removes most pairs before their bits are compared
    links = np.concatenate([np.stack(p, 1) for p in S._spanning(fp, 4, 4)])
    assert len(links) and (np.bitwise_count(links[:, 0] ^ links[:, 1]) <= 4).all()
