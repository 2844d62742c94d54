from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import mixing as M
from llm_rows import odd_rows


def raked(cells, goals, rounds=200):
    """Plain raking of {(source, lang, topic): n} to goals by dimension."""
    w = dict.fromkeys(cells, 1.0)
    for _ in range(rounds):
        for d in range(3):
            got = {}
            for c, n in cells.items():
                got[c[d]] = got.get(c[d], 0) + n * w[c]
            for c in cells:
                if cells[c]:
                    w[c] *= goals[d].get(c[d], 0.0) / got[c[d]] if got[c[d]] else 1.0
    return w


def _docs(spark, n=600):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "b", "c"], p=[0.6, 0.3, 0.1])
        lang = rng.choice(["en", "de"], p=[0.8, 0.2])
        words = ["word"] * int(rng.integers(5, 200)) + (["license"] if rng.random() < 0.3 else [])
        rows.append((i, " ".join(words), str(lang), str(source), "clash"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n string").repartition(4)


def test_weights_equal_plain_raking_and_meet_the_targets(spark):
    docs = _docs(spark)
    out = M.mix(docs, shares={"lang": {"en": 0.5, "de": 0.5}, "source": {"a": 1, "b": 1, "c": 1, "absent": 5}})
    rows = out.withColumn("t", M.token_count(F.col("text"))).collect()
    cells, weight = {}, {}
    for r in rows:
        c = (r.source, r.lang, r.topic_mix)
        cells[c] = cells.get(c, 0) + r.t
        weight[c] = r.w_mix
    total = sum(cells.values())
    topics = {}
    for c, n in cells.items():
        topics[c[2]] = topics.get(c[2], 0) + n
    raw = {t: n ** M.TEMPER["topic"] for t, n in topics.items()}
    goals = [{s: total / 3 for s in "abc"}, {"en": total / 2, "de": total / 2}, {t: total * v / sum(raw.values()) for t, v in raw.items()}]
    want = raked(cells, goals)
    assert all(abs(weight[c] / want[c] - 1) < 1e-4 for c in cells)
    top = max(want.values())
    assert all(abs(r.p_mix - want[r.source, r.lang, r.topic_mix] / top) < 1e-4 for r in rows)
    kept = {r.doc_id for r in rows if r.kept_mix}
    share = sum(r.p_mix for r in rows) / len(rows)
    assert abs(len(kept) / len(rows) - share) < 0.08


def test_main_path_is_native(spark):
    plan = M.mix(_docs(spark, 50), sweeps=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_odd_rows(spark, docs_of):
    docs = docs_of(odd_rows())
    out = M.mix(docs, sweeps=3)
    assert out.count() == len(odd_rows())
    got = out.collect()
    assert all(0 <= r.p_mix <= 1 for r in got)
    assert all(r.topic_mix == "=empty" for r in got if not (r.text or "").strip())
    twins = [r.kept_mix for r in got if r.doc_id == 5]
    assert len(twins) == 2 and twins[0] == twins[1]  # a hash decides
    assert M.sample_mixed(docs.limit(3), sweeps=1).columns == docs.columns
    assert M.sample_mixed(docs.limit(0)).count() == 0


def _cells(spark, rows):
    full = [(f"={s}", f"={lang}", f"={t}", float(n)) for s, lang, t, n in rows]
    return spark.createDataFrame(full, "source_mix string, lang_mix string, topic_mix string, n_mix double")


def _kept(out, column):
    got = {}
    for r in out.collect():
        got[r[column][1:]] = got.get(r[column][1:], 0.0) + r.n_mix * r.p_mix
    return got


def test_a_rare_cell_does_not_set_what_the_others_keep(spark):
    rows = [(s, lang, t, n * m * k) for s, n in (("a", 9), ("b", 7)) for lang, m in (("en", 80), ("de", 20)) for t, k in (("article", 900), ("short", 300))]
    for scale in (1, 1000):
        big = [(*r[:3], r[3] * scale) for r in rows]
        out, report = M.mixed_cells(_cells(spark, [*big, ("rare", "en", "short", 20)]), keep=0.75)
        assert abs(report.kept_share - 0.75) < 1e-5 and report.error < 1e-6
        weight = {r.source_mix: r.p_mix for r in out.collect()}
        assert weight["=rare"] == 1
        alone, _ = M.mixed_cells(_cells(spark, big), keep=0.75)
        was = {(r.source_mix, r.lang_mix, r.topic_mix): r.p_mix for r in alone.collect()}
        now = {(r.source_mix, r.lang_mix, r.topic_mix): r.p_mix for r in out.collect()}
        assert all(abs(now[c] - p) < 0.01 for c, p in was.items())
        # languages, which have enough, keep their raised shares
        have = {lang: sum(r[3] for r in big if r[1] == lang) + 20 * (lang == "en") for lang in ("en", "de")}
        raised = {lang: v**0.85 for lang, v in have.items()}
        kept = _kept(out, "lang_mix")
        assert all(abs(kept[v] / sum(kept.values()) - raised[v] / sum(raised.values())) < 1e-5 for v in have)


def test_targets_beyond_the_budget_lose_no_cell(spark):
    rows = [("a", "en", "t", 1e6), ("b", "de", "t", 2.5e5), ("c", "de", "t", 1e5), ("a", "de", "t", 1e3), ("b", "en", "t", 1e3)]
    for here in (0, 100):
        out, report = M.mixed_cells(_cells(spark, rows), keep=0.75, sweeps=3, cells_here=here)
        assert report.error > 1e-3  # told, not hidden
        assert all(0.05 < r.p_mix <= 1 for r in out.collect())


def test_driver_and_table_rake_alike(spark):
    rows = [(s, lang, t, n * m * k) for s, n in (("a", 90), ("b", 40)) for lang, m in (("en", 9), ("de", 4)) for t, k in (("x", 7), ("y", 5))]
    got = []
    for here in (0, 100):
        out, report = M.mixed_cells(_cells(spark, [*rows, ("a", "en", "empty", 0)]), shares={"lang": {"en": 0.6, "de": 0.4}}, keep=0.6, cells_here=here)
        assert report.error < 1e-6
        got.append({(r.source_mix, r.lang_mix, r.topic_mix): r.p_mix for r in out.collect()})
    assert all(abs(got[0][c] - got[1][c]) < 1e-4 for c in got[0])


def test_thinly_linked_sources_and_languages_meet_their_targets(spark):
    rows = [("a", "en", "t", 1e6), ("b", "de", "t", 2.5e5), ("c", "de", "t", 1e5), ("a", "de", "t", 1e3), ("b", "en", "t", 1e3)]
    total = sum(r[3] for r in rows)
    out, report = M.mixed_cells(_cells(spark, rows), shares={"source": {"a": 1, "b": 1, "c": 1}, "lang": {"en": 1, "de": 1}})
    got = {}
    for r in out.collect():
        got[r.source_mix] = got.get(r.source_mix, 0) + r.n_mix * r.w_mix
    assert report.error < 1e-6 and report.sweeps > 20
    assert all(abs(v / total - 1 / 3) < 1e-5 for v in got.values())
    _, report = M.mixed_cells(_cells(spark, rows))
    assert report.error < 1e-6 and report.sweeps > 20
