"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints at distance
``d <= 4`` differ in at most four bytes, so they share at least ``8 - d >= 4``
positional bytes: the guaranteed minimum.  A pair reaching the minimum shares
every byte of at least one *triple* of positions out of a small cover, so the
index is keyed by the bytes at those triples (20 keys a fingerprint at distance
4) and not by single bytes, whose 2,048 posting lists would each hold 1/256 of
the corpus.  Inside a list the shared bytes of a pair are tallied, pairs under
the minimum are dropped, and the rest are verified by their bit distance.

Equal fingerprints are collapsed first, so exact copies meet once.  A posting
list is read as a sorted stream and yields a spanning set of its links, never
all pairs.  Lists over ``max_list`` distinct fingerprints are linked another
exact way: two fingerprints are within ``2r`` bits exactly if balls of radius
``r`` around them meet, so each is joined to the points of its ball.

Null texts count as empty; texts without words have fingerprint zero and link
like any other; a null ``doc_id`` takes part and never names a component unless
no other id is in it.  Repeated rows share a fingerprint.  Empty tables give
empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import columns_of, connected_components, scratch_table, shuffle_width

SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the whole text (ASCII lower case, ASCII white space)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        part = np.array(hashes[k : k + 65536], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def simhash_udf(shingle: int):
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return simhash


def fingerprints(docs: DataFrame, *, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long of the same bits."""

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), simhash_udf(shingle)(F.col(text_col)).alias("fp"))


def cover(shared: int, size: int) -> list[tuple[int, ...]]:
    """Position sets of ``size`` such that any ``shared`` of the eight positions hold one of them (greedy)."""
    todo = set(combinations(range(8), shared))
    found = []
    while todo:
        best = max(combinations(range(8), size), key=lambda s: sum(set(s) <= set(t) for t in todo))
        todo = {t for t in todo if not set(best) <= set(t)}
        found.append(best)
    return found


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the eight positional bytes two fingerprints share, from their exclusive or: its zero bytes."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    return 8 - np.bitwise_count((((x & low) + low) | x) & ~low)


def _spanning(fp: np.ndarray, minimum: int, distance: int, block: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what the pairs within one list connect, by search from fingerprint to fingerprint."""
    left = np.arange(len(fp))
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            found = np.zeros(len(left), bool)
            by = np.zeros(len(left), np.int64)
            step = max(1, (block * 256) // len(left))
            for k in range(0, len(front), step):
                some = front[k : k + step]
                rest = np.flatnonzero(~found)
                if not len(rest):
                    break
                x = fp[some][:, None] ^ fp[left[rest]][None, :]
                # count filter: pairs that share enough positional bytes; then their bits are compared
                i, j = np.nonzero(shared_bytes(x) >= minimum)
                near = np.bitwise_count(x[i, j]) <= distance
                i, j = i[near], j[near]
                found[rest[j]] = True
                by[rest[j]] = some[i]
            yield fp[by[found]], fp[left[found]]
            front, left = left[found], left[~found]


def _list_links(minimum: int, distance: int, max_list: int):
    """Reads posting lists sorted by key; yields links, and members of lists that are too long (dst null)."""

    def rows(src: np.ndarray, dst: np.ndarray | None) -> pa.RecordBatch:
        d = pa.array(dst.view(np.int64)) if dst is not None else pa.nulls(len(src), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(src.view(np.int64)), d], names=["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, over = None, [], False
        out_a: list[np.ndarray] = []
        out_b: list[np.ndarray] = []

        def close():
            fp = np.concatenate(held)
            if over:
                yield rows(fp, None)
            elif len(fp) > 1:
                for a, b in _spanning(fp, minimum, distance):
                    if len(a):
                        out_a.append(a)
                        out_b.append(b)

        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(key):
                continue
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            ends = np.append(starts[1:], len(key))
            # lists of exactly two inside the batch: all at once
            inner = (ends - starts == 2) & (starts > 0) & (ends < len(key))
            a, b = fp[starts[inner]], fp[starts[inner] + 1]
            x = a ^ b
            kept = np.flatnonzero(shared_bytes(x) >= minimum)
            kept = kept[np.bitwise_count(x[kept]) <= distance]
            out_a.append(a[kept])
            out_b.append(b[kept])
            edge = (starts == 0) | (ends == len(key))
            for s, e in zip(starts[(ends - starts > 2) | edge].tolist(), ends[(ends - starts > 2) | edge].tolist()):
                if held and key[s] != held_key:
                    yield from close()
                    held, over = [], False
                held_key = key[s]
                held.append(fp[s:e].copy())
                if sum(map(len, held)) > max_list:
                    # too long for this way: hand the members on, and hold nothing
                    over = True
                    yield rows(np.concatenate(held), None)
                    held = [fp[:0]]
            if out_a:
                yield rows(np.concatenate(out_a), np.concatenate(out_b))
                out_a, out_b = [], []
        if held:
            yield from close()
        if out_a:
            yield rows(np.concatenate(out_a), np.concatenate(out_b))

    return run


def _ball_links(members: DataFrame, distance: int) -> DataFrame:
    """Links of long lists: fingerprints whose balls of half the distance share a point meet in one component."""
    masks = [sum(1 << b for b in bits) for r in range(distance // 2 + 1) for bits in combinations(range(64), r)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    points = members.select("fp", F.explode(F.array(*[F.lit(m) for m in signed])).alias("m"))
    points = points.select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("z"))
    least = points.groupBy("z").agg(F.min("fp").alias("src"))
    return points.join(least, "z").filter("fp <> src").select("src", F.col("fp").alias("dst")).distinct()


def simhash_links(distinct_fps: DataFrame, *, distance: int = 4, max_list: int = 16384) -> DataFrame:
    """(src, dst) links that connect all fingerprints within ``distance`` bits; ``distinct_fps`` has column fp, no repeats."""
    minimum = 8 - distance
    if distance not in (2, 4, 6):
        raise ValueError("distance must be 2, 4 or 6: half of it is the radius that long lists use")
    triples = cover(minimum, min(3, minimum))
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]

    def key(n: int, s: tuple[int, ...]):
        out = F.lit(n).cast("long")
        for p in s:
            out = F.shiftleft(out, 8).bitwiseOR(byte[p])
        return out

    postings = distinct_fps.select(F.explode(F.array(*[key(n, s) for n, s in enumerate(triples)])).alias("key"), "fp")
    postings = postings.repartition(shuffle_width(distinct_fps.sparkSession), "key").sortWithinPartitions("key", "fp")
    found = postings.mapInArrow(_list_links(minimum, distance, max_list), "src long, dst long")
    links, _ = scratch_table(found, "simhash-links")
    long_lists = links.filter("dst is null").select(F.col("src").alias("fp")).distinct()
    if long_lists.isEmpty():
        return links.distinct()
    return links.filter("dst is not null").unionByName(_ball_links(long_lists, distance)).distinct()


def simhash_components(prints: DataFrame, *, distance: int = 4, max_list: int = 16384) -> DataFrame:
    """(fp, component, component_id, n_docs) for every distinct fingerprint of ``prints`` (doc_id, fp).

    component is a fingerprint that names it, component_id the smallest doc_id reachable by links.
    """
    least, _ = scratch_table(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")), "simhash-fp")
    parts = connected_components(simhash_links(least.select("fp"), distance=distance, max_list=max_list))
    member = least.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ids = member.groupBy("component").agg(F.min("least_id").alias("component_id"), F.sum("n").alias("n_docs"))
    return member.select("fp", "component").join(ids, "component")


def simhash_dedup(docs: DataFrame, *, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, n_docs of the component."""
    prints, _ = scratch_table(fingerprints(docs, shingle=shingle), "simhash-docs")
    parts = simhash_components(prints, distance=distance)
    return prints.join(parts, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_docs")


def keep_one_per_group(docs: DataFrame, *, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` with one document of each component: its smallest doc_id (null only if no other).

    Where rows repeat that id, the row whose columns sort first stays.  All
    columns pass through unchanged.
    """
    prints, _ = scratch_table(fingerprints(docs, shingle=shingle), "simhash-docs")
    parts, _ = scratch_table(simhash_components(prints, distance=distance), "simhash-parts")
    heads = prints.join(parts, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("head")).distinct()
    # how many rows have the id at all: rows with a head's id may belong to other components
    rows = prints.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    heads = heads.join(rows, F.col("head").eqNullSafe(F.col("doc_id"))).select("head", "rows")
    heads, _ = scratch_table(heads, "simhash-heads")
    # the caller's columns stay in one struct, so their names meet none of these
    held = docs.select(F.struct(*columns_of(docs)).alias("r"), F.col("doc_id").cast("long").alias("id"))
    on = F.col("id").eqNullSafe(F.col("head"))
    single = held.join(heads.filter("rows = 1"), on, "left_semi").select("r.*")
    if heads.filter("rows > 1").isEmpty():
        return single
    # ids on several rows: the rows are told apart by the component of their own text
    again = held.join(heads.filter("rows > 1"), on, "left_semi")
    again = again.select("r", simhash_udf(shingle)(F.col("r.text")).alias("fp")).join(parts, "fp")
    first = again.filter(F.col("r.doc_id").cast("long").eqNullSafe(F.col("component_id"))).groupBy("component").agg(F.min("r").alias("r"))
    return single.unionByName(first.select("r.*"))
