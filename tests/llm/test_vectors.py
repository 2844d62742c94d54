from __future__ import annotations

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import pq_dedup as P
from ledgerlake.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int, node long, block long, h long"


def odd_vectors(dim):
    nan, inf = float("nan"), float("inf")
    return [
        (20000, None), (20001, [0.0] * dim), (20002, [nan] * dim), (20003, [1.0, None]), (20004, [1.0, 2.0]), (20050, [2.0, 4.0]),
        (20006, []), (20007, [inf] * dim), (20100, [0.0] * dim), (None, [0.25] * dim), (21000, [0.25] * dim), (21001, [0.25] * dim),
    ]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(260, 16))
    near = base[:120] + rng.normal(size=(120, 16)) * rng.uniform(0.02, 0.25, size=(120, 1))
    tight = base[0] + rng.normal(size=(80, 16)) * 0.05
    x = np.concatenate([base, near, tight, base[:15]]).astype(np.float32)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + odd_vectors(16)
    rows += rows[:3]
    df = spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in rows], SCHEMA).repartition(4).cache()
    df.count()
    return rows, df


def usable(v, zero_ok):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and (zero_ok or any(v))


def test_near_duplicates_equal_brute_force(spark, vectors):
    rows, df = vectors
    n = len(rows)
    unit = [np.array(v, float) / np.linalg.norm(v) if usable(v, False) else None for _, v in rows]
    link = [[a != b and unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9 for b in range(n)] for a in range(n)]
    part = list(range(n))
    for a in range(n):
        todo = [a]
        while todo:
            x = todo.pop()
            for b in range(n):
                if link[x][b] and part[b] > a:
                    part[b] = a
                    todo.append(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[part[k]] = min(i, least.get(part[k], i))
    want = sorted(((i is None, i or 0), sum(link[k]), least.get(part[k])) for k, (i, _) in enumerate(rows))
    assert sum(w[1] for w in want) > 6000
    for block in (4096, 60):
        got = P.embedding_near_dedup(df, block=block, sample=300).collect()
        assert sorted(((r.vec_id is None, r.vec_id or 0), r.n_links, r.component_id) for r in got) == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_near_duplicates_of_nothing(spark, vectors):
    assert P.embedding_near_dedup(vectors[1].limit(0)).count() == 0
    one = P.embedding_near_dedup(vectors[1].filter("vec_id = 7")).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in one] == [(7, 0, 7, True)]


def test_probes_are_sufficient():
    rng = np.random.default_rng(1)
    x = P.unit(rng.normal(size=(400, 8)))
    y = P.unit(x + rng.normal(size=x.shape) * 0.13)
    close = (x * y).sum(1) >= 0.9
    centers, _ = P.train(x, 20, 4)
    own = ((x[:, None] - centers) ** 2).sum(2).argmin(1)
    to = ((y[:, None] - centers) ** 2).sum(2).argmin(1)
    reach = P.reachable(x, own, centers, float(np.sqrt(0.2)))
    assert close.sum() > 100 and reach[np.arange(400), to][close].all() and not reach.all()


def test_coded_filter_loses_no_partner_and_drops_nearly_all_others():
    rng = np.random.default_rng(3)
    x = P.unit(rng.normal(size=(1500, 64)))
    y = P.unit(x[:300] + rng.normal(size=(300, 64)) * 0.05)
    members = np.concatenate([x, y])
    centers, books = P.train(x, 38, 8)
    own = ((members[:, None] - centers) ** 2).sum(2).argmin(1)
    part = P.parts(64, 8)
    codes = np.stack([(((members - centers[own])[:, p][:, None] - b) ** 2).sum(2).argmin(1) for p, b in zip(part, books)], axis=1)
    code = P.decoded(codes, own, centers, books)
    able = members @ code.T >= P.least_near((code**2).sum(1), np.sqrt(((members - code) ** 2).sum(1)), 0.9)
    linked = members @ members.T >= 0.9
    assert linked.sum() > len(members) + 400 and able[linked].all()
    assert able.mean() < 0.02


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_training_and_coding_hold_a_few_rows_by_lists_at_a_time():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(16_384, 16))
    assert peak_mb(lambda: P.train(x, 1024, 4)) < 60  # 16,384 rows by 1,024 lists alone are 134 MB
    centers = P.unit(x[:1024])
    of = SimpleNamespace(value=(centers, [centers[:256, part] for part in P.parts(16, 4)], np.eye(16, 7)))
    batch = pa.RecordBatch.from_pydict({"vector": pa.array(x[:10_000].tolist(), pa.list_(pa.float64()))})
    assert peak_mb(lambda: list(P._lists(of)([batch]))) < 40


def test_rows_are_not_copied_to_the_blocks_they_are_compared_with(spark, monkeypatch):
    """Without structure every vector meets every other; still each is written once, in pages of bounded length."""
    x = np.random.default_rng(8).normal(size=(1500, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    plans, pages, write = [], [], P.scratch_table

    def watched(df, name, **options):
        table, path = write(df, name, **options)
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        if name == "pq-pages":
            pages.extend(len(r.node) // 8 for r in table.select("node").collect())
        return table, path

    monkeypatch.setattr(P, "scratch_table", watched)
    assert P.embedding_near_dedup(df, block=16, sample=500).count() == 1500
    assert plans and not any("CoGroup" in p for p in plans)
    assert sum(pages) == 1500 and len(pages) > 8 and max(pages) < 2 * 16 * P.PAGE_BLOCKS


def test_many_pages_floats_and_doubles_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(150, 12))
    x = np.concatenate([base, base[:80] + rng.normal(size=(80, 12)) * 0.15, base[0] + rng.normal(size=(150, 12)) * 0.04, base[:5]])
    for kind, values in (("double", x * 1e-200), ("float", x.astype(np.float32).astype(float))):
        unit = values / np.abs(values).max(axis=1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        link = unit @ unit.T >= 0.9
        least = np.arange(len(x))
        while (low := np.where(link, least[None, :], len(x)).min(axis=1)).tolist() != least.tolist():
            least = low
        df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(values)], f"vec_id long, embedding array<{kind}>").repartition(5)
        got = sorted(P.embedding_near_dedup(df, block=8, sample=64).collect())
        assert [(r.vec_id, r.n_links, r.component_id) for r in got] == [(i, int(link[i].sum()) - 1, int(least[i])) for i in range(len(x))]


def test_pairs_that_are_many_are_decided_together(spark):
    """A tile that is nearly full of links goes another way than a few pairs; both give all links."""
    rng = np.random.default_rng(10)
    x = P.unit(np.concatenate([rng.normal(size=(1, 24)) + rng.normal(size=(700, 24)) * 0.06, rng.normal(size=(900, 24))])[rng.permutation(1600)])
    centers, books = P.train(x, 20, 4)
    pages = []
    for k, of in enumerate((slice(0, 700), slice(700, 1600))):
        own = P.nearest(x[of], centers)[0]
        codes = np.stack([P.nearest((x[of] - centers[own])[:, p], b)[0] for p, b in zip(P.parts(24, 4), books)], axis=1).astype(np.uint8)
        code = P.decoded(codes, own, centers, books)
        least = P.least_near((code**2).sum(1), np.sqrt(((x[of] - code) ** 2).sum(1)), 0.9)
        pages.append(SimpleNamespace(node=np.arange(1600)[of], n=np.full(len(own), 1 + k), list=own, least=least, codes=codes, x=x[of], lead=P.lead(x[of], P.leading(x, 0.9))))
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    for (i, a), (j, b) in (((0, slice(0, 700)), (1, slice(700, 1600))), ((1, slice(700, 1600)), (1, slice(700, 1600)))):
        got = P.meet(pages[i], pages[j], i == j, centers, books, 0.9).to_pydict()
        at = [*range(1600)[a], *([] if i == j else range(1600)[b])]
        here = near[a, b]
        want = (here * pages[j].n).sum(1).tolist() + ([] if i == j else (here.T * pages[i].n).sum(1).tolist())
        assert dict(zip(got["node"], got["links"])) == {n: w for n, w in zip(at, want) if w} and here.sum() > 100_000
        assert len(set(got["least"])) == 1 and got["least"][0] == min(got["node"])


def best(rows, k, scale, every):
    ints = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if usable(v, True)]
    out, done = [], set()
    for q, qv in ints:
        if q is None or q % every or q in done:
            continue
        done.add(q)
        found = sorted((-sum(a * b for a, b in zip(qv, v)), i is None, i or 0) for i, v in ints if i != q and len(v) == len(qv))
        out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(found[:k])]
    return sorted(out)


def test_top_k_equals_brute_force_with_ties(spark, vectors):
    rows, df = vectors
    for block, scale in ((4096, 256), (40, 2)):
        got = K.exact_top_k(df, k=5, every=50, scale=scale, block=block, sample=300, queries_a_task=3)
        assert sorted(map(tuple, got.collect())) == best(rows, 5, scale, 50)


def test_top_k_of_large_components_and_of_nothing(spark):
    rows = [(0, [2.0**50, -3.0]), (1, [2.0**51, 5.0]), (2, [-(2.0**40), 1.5]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = K.exact_top_k(df, k=2, scale=1).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 1), (0, 2, 3)]
    assert got and {r.score for r in got} == {(1 << 63) - 1, 2**50 - 3}
    assert K.exact_top_k(df.limit(0)).count() == 0


def best_by_row(rows, k, scale, every):
    ints = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if usable(v, True)]
    out = []
    for p, (q, qv) in enumerate(ints):
        if q is None or q % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(qv, v)), i is None, i or 0) for j, (i, v) in enumerate(ints) if j != p and len(v) == len(qv))
        out += [(q, r + 1, None if none else i, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, none, i) in enumerate(found[:k])]
    return sorted(out, key=str)


def test_every_row_is_a_query_and_only_that_row_is_no_candidate(spark, vectors):
    rows = vectors[0] + [(50, [0.5] * 16), (50, [-1.0] * 16), (50, [0.5] * 15), (100, [0.25] * 16)]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>").repartition(4)
    for block, scale in ((4096, 256), (40, 2)):
        got = K.exact_top_k(df, k=5, every=50, scale=scale, block=block, sample=300, queries_a_task=3, by_row=True)
        assert sorted(map(tuple, got.collect()), key=str) == best_by_row(rows, 5, scale, 50)


def test_scores_beyond_64_bits_are_ranked_exactly(spark):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(12, 4))[rng.integers(0, 12, 200)] * 3e6 + rng.normal(size=(200, 4))).astype(np.float32)
    x[150:] *= np.float32(1e20)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [((1 << 63) - 1, [1e30] * 4), (None, [1e30] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = K.exact_top_k(df, k=5, every=10, scale=256, block=40, by_row=True)
    want = best_by_row([(i, [float(np.float32(c)) for c in v]) for i, v in rows], 5, 256, 10)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(w[2] is None for w in want) and any(w[2] == (1 << 63) - 1 for w in want)


def test_bounds_hold_for_rows_not_seen():
    rng = np.random.default_rng(2)
    x, q = np.floor(rng.normal(size=(300, 6)) * 40), np.floor(rng.normal(size=(9, 6)) * 40)
    block = K.Block(np.arange(300), x)
    scores, bounds = q @ x.T, block.bounds(q)
    for i in range(9):
        for j, depth in enumerate(block.depths()):
            rest = np.setdiff1d(np.arange(300), block.seen(q[i], depth)) if depth else np.arange(300)
            assert (scores[i, rest] <= bounds[i, j]).all()
