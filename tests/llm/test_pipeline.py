from __future__ import annotations

import pytest

import corpus_pipeline as P
from ledgerlake.llm.queries import QUERIES, tokenizer_path
from llm_rows import odd_rows
from test_lines import expected as lines_of
from test_simhash import components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    import __spark_entry__ as E

    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(QUERIES) < set(names)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output over the whole small table, written and read again."""
    out, docs = [], spark.read.parquet(f"{SF}/documents.parquet")
    root = tmp_path_factory.mktemp("stages")
    for k, (name, f) in enumerate(P.STAGES):
        f(spark, docs, SF).write.parquet(f"{root}/{k}")
        after = spark.read.parquet(f"{root}/{k}")
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_keep_the_columns_of_documents(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "line dedup", "simhash near-dedup", "mixing", "bpe"]
    assert all(after.columns == before.columns for _, before, after in stages[:-1])


def test_toxicity_stage_drops_what_the_model_rejects(spark, stages):
    _, before, after = stages[0]
    kept = {r.doc_id for r in after.collect()}
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in before.collect()} - kept
    assert gone and all(marks.get(i, 1) for i in gone)


def test_line_and_simhash_stages_equal_brute_force(stages):
    _, before, after = stages[1]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = lines_of(rows)
    assert {(r.doc_id, r.text) for r in after.collect()} == {(i, want[i, t]) for i, t in rows}
    assert all(r.n_chars == len(r.text) for r in after.collect() if want.get((r.doc_id, r.text)) != r.text)
    _, before, after = stages[2]
    same = components({r.doc_id: plain_fingerprint(r.text) for r in before.collect()}, 4)
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(same.values()))


def test_last_stages(stages):
    from tokenizers import Tokenizer

    _, before, after = stages[3]
    rows = {r.doc_id: r for r in before.collect()}
    assert 0 < after.count() <= len(rows) and all(rows[r.doc_id] == r for r in after.collect())
    library = Tokenizer.from_file(tokenizer_path())
    for r in stages[4][2].collect():
        assert list(r.ids) == library.encode(r.text or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_stages_bear_odd_rows(spark, docs_of, tmp_path):
    docs = docs_of(odd_rows())
    for k, (_, f) in enumerate(P.STAGES):
        f(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or after.columns == docs.columns
        docs = after
    empty = docs_of(odd_rows()).limit(0)
    assert all(f(spark, empty, SF).count() == 0 for _, f in P.STAGES)
