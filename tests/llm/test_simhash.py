from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import simhash as S
from ledgerlake.llm.common import connected_components
from llm_rows import odd_rows


def plain_fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: dict, distance: int) -> dict:
    """Class of every key by comparing all pairs."""
    left, out = set(prints), {}
    while left:
        todo, part = [left.pop()], []
        while todo:
            x = todo.pop()
            part.append(x)
            near = {y for y in left if (prints[x] ^ prints[y]).bit_count() <= distance}
            left -= near
            todo += near
        for x in part:
            out[x] = min(part)
    return out


def test_fingerprint_equals_the_plain_one():
    texts = [t for _, t in odd_rows() if t is None or len(t) < 9000] + ["One two THREE four Five", "x", "É é A", "a b c d " * 50]
    assert [S.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_spark_hash_is_the_same_hash(spark):
    words = "some four word shingle"
    assert spark.range(1).select(F.xxhash64(F.lit(words))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(words.encode(), 42)


def test_cover_holds_a_set_of_every_choice():
    from itertools import combinations

    for shared, size in ((4, 3), (6, 3), (2, 2)):
        found = S.cover(shared, size)
        assert all(any(set(s) <= set(t) for s in found) for t in combinations(range(8), shared))


def _prints(spark, values):
    return spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")


def _classes(spark, values, **kw):
    fps = _prints(spark, values)
    links = connected_components(S.simhash_links(fps, **kw))
    found = {r.node % (1 << 64): r.component for r in links.collect()}
    names: dict = {}
    return {v: names.setdefault(found.get(v, v), v) for v in sorted(values)}


def test_links_equal_brute_force_and_long_lists_take_the_exact_way(spark):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for base in list(values)[:12]:
        for n in (1, 2, 3, 4, 5, 6):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), n)))
    # one dense group
    values |= {0xABCDEF ^ 1 << a ^ 1 << b for a in range(8) for b in range(8) if a < b}
    want = components({v: v for v in values}, 4)
    assert _classes(spark, values) == want
    assert _classes(spark, values, max_list=4) == want


def test_documents_odd_rows_and_ties(spark, docs_of):
    rows = odd_rows()
    got = {(r.doc_id, r.fingerprint): r.component_id for r in S.simhash_dedup(docs_of(rows)).collect()}
    assert S.simhash_dedup(docs_of(rows)).count() == len(rows)
    prints = {k: plain_fingerprint(t) for k, (_, t) in enumerate(rows)}
    same = components(prints, 4)
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in same if same[j] == same[k] and rows[j][0] is not None]
        assert got[i, f"{prints[k]:016x}"] == (min(ids) if ids else None)


def test_keep_one_per_group_keeps_each_group_once_and_all_columns(spark, docs_of):
    rows = odd_rows()
    docs = docs_of(rows)
    kept = S.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    same = components({k: plain_fingerprint(t) for k, (_, t) in enumerate(rows)}, 4)
    assert len(got) == len(set(same.values()))
    # an id on two texts of different groups stays for each group it heads
    assert (False, 7, "a different text of the same id") in got and (False, 4, "a b c") in got
    assert S.keep_one_per_group(docs.limit(0)).count() == 0


def test_connected_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}}
