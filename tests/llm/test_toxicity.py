from __future__ import annotations

import random

import numpy as np

from ledgerlake.llm import toxicity as T
from llm_rows import odd_rows

BAD = ["idiot", "scum", "lostra"]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklm", k=rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        sentences = [[rng.choice(words) for _ in range(rng.randint(3, 9))] for _ in range(rng.randint(1, 12))]
        bad = rng.random() < 0.25
        if bad:
            for s in rng.sample(sentences, 1):
                word = rng.choice(BAD)
                s.insert(rng.randrange(len(s)), word + ("" if word != "lostra" else rng.choice(words)))
        rows.append((i, ". ".join(" ".join(s) for s in sentences) + ".", bad))
    return rows


def test_learns_from_documents_and_finds_the_sentences(spark, docs_of):
    rows = corpus()
    docs = docs_of([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, int(b), 0) for i, _, b in rows], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in T.toxicity(docs, labels).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(i, t, b) for i, t, b in rows if got[i].held_out]
    assert 40 < len(held) < 130
    assert np.mean([bool(got[i].predicted) == b for i, _, b in held]) > 0.9
    for i, t, b in held:
        if b and got[i].predicted:
            found = [t.lower()[s.start : s.end] for s in got[i].offending]
            assert any(any(w in f for w in BAD) for f in found) and len(found) < got[i].n_sentences + 1


def test_held_out_labels_are_never_used(spark, docs_of):
    rows = corpus(120)
    docs = docs_of([(i, t) for i, t, _ in rows])
    ids = {r.doc_id: r.held_out for r in T.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()}
    one = spark.createDataFrame([(i, int(b)) for i, _, b in rows], "doc_id long, toxic int")
    two = spark.createDataFrame([(i, int(b != ids[i])) for i, _, b in rows], "doc_id long, toxic int")
    a, b = ({r.doc_id: r.score for r in T.toxicity(docs, x).collect()} for x in (one, two))
    assert a == b


def test_odd_rows_and_labels(spark, docs_of):
    docs = docs_of(odd_rows())
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (6, None), (None, 1), (99, 1), (7, 0)], "doc_id long, toxic int")
    got = T.toxicity(docs, labels).collect()
    assert len(got) == len(odd_rows())
    assert all(r.score == 0 for r in got if r.n_sentences == 0)
    none = T.toxicity(docs, labels.filter("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}
    every = T.toxicity(docs, labels.filter("doc_id = 6 and toxic is not null").selectExpr("doc_id", "1 as toxic")).collect()
    assert {r.score for r in every} <= {0.0, 1.0}
    assert T.toxicity(docs.limit(0), labels).count() == 0
    kept = T.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(odd_rows())


def test_a_long_text_of_clean_sentences_stays():
    rows = corpus(1000)
    train, rest = rows[:700], rows[700:]
    toxic = np.array([b for _, _, b in train])
    model = T.fit_for_any_length([t for _, t, _ in train], toxic, np.ones(len(train)))
    scores = T.WordScores(model.weights)
    logits = lambda t: T.sentence_logits(t.lower(), scores, model.bias)
    plain = lambda t: -np.expm1(-T.softplus(logits(t)).sum())
    clean = [t for _, t, b in rest if not b and plain(t) < 0.5]
    found = [t for _, t, b in rest if b and plain(t) >= 0.9]
    for copies in (1, 10, 100):
        long = " ".join(clean * copies)
        assert model.probability(logits(long)) < 0.5
    assert plain(long) >= 0.5  # the noisy-or alone would drop it
    # a toxic document stays toxic with clean ones around it
    kept = [model.probability(logits(" ".join([*clean[:20], t, *clean[20:40]]))) >= 0.5 for t in found]
    assert found and np.mean(kept) > 0.8
