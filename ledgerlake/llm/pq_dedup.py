"""Embedding near-duplicates by product quantisation with coarse inverted lists.

Equal vectors are collapsed first.  A coarse quantiser (k-means on a bounded
sample, at most 1,024 lists) gives every vector a list; its residual is coded by
product quantisation (``subspaces`` bytes), and the distance between vector and
code, the coding error, is kept.  Every distinct vector is a query.

Probes are sufficient, not guessed: partners at cosine c lie within
``r = sqrt(2 - 2c)`` of each other on the unit sphere, so a partner can be in a
list only if the query is within r of the plane between its own centre and that
list's.  Where a list is reached, three filters follow, each exact in what it drops:
the product of the leading components (of a rotation fitted to the sample) and of the lengths
of what is left; the product with the decoded member (asymmetric), whose angle may
exceed that of the cosine by no more than the angle between member and code; and
the exact cosine in double precision.  None can lose a link, so recall is 1
whatever the sample.

Lists are dealt in blocks of at most ``block`` rows, a few blocks are a page: one
row of a written table that holds its vectors, codes and lists as bytes (8 MB of
vectors at most), and the lists its rows can reach.  Each two pages of which
either reaches the other meet once, in a task that reads both from that table, in tiles: no vector is copied
in a shuffle, and a task holds two pages and a tile, however many rows there are.  It
returns counts of links, and each linked vector once with the smallest member of
its local component: no pairs leave it.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing.  Vectors of different length link with nothing.  Rows with equal
vec_id are vectors of their own.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ledgerlake.llm.common import connected_components, drop_scratch, scratch_table
from ledgerlake.llm.vectors import blocks_of_lists, is_finite, kmeans, list_count, matrix, nearest, sample_rows, squared_distances

#: A page has at most so many blocks and bytes of vectors, a tile so many rows and members; so many pairs are kept until they are decided.
PAGE_BLOCKS, PAGE_BYTES, TILE, PAIRS = 8, 8 << 20, 512, 65_536


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def train(sample: np.ndarray, lists: int, subspaces: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Coarse centres, and the codebook of every subspace of the residuals."""
    x = unit(sample)
    centers = kmeans(x, lists)
    residual = x - centers[nearest(x, centers)[0]]
    return centers, [kmeans(residual[:, part], 256, rounds=6) for part in parts(x.shape[1], subspaces)]


def packed(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x).tobytes())])


def unpacked(column: pa.Array | pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def parts(dim: int, subspaces: int) -> list[slice]:
    cuts = np.linspace(0, dim, min(subspaces, dim) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def leading(x: np.ndarray, cosine: float) -> np.ndarray:
    """Rotation of unit vectors to as many leading components as tell pairs apart at least cost, by a sample of such vectors."""
    turn = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    y, z = x[:1024] @ turn, x[-1024:] @ turn
    far = y @ z.T < cosine
    step = 8 * max(1, x.shape[1] // 128)
    cost = {}
    for m in (*range(step - 1, x.shape[1], step), x.shape[1]):  # with the length of the rest, a whole number of registers
        passed = ((lead(y, np.eye(len(turn), m)) @ lead(z, np.eye(len(turn), m)).T >= cosine - 1e-4) & far).mean()
        cost[m] = m + passed * 256 * x.shape[1]  # a pair that passes costs its gathered vectors
    return turn[:, : min(cost, key=lambda m: (cost[m], m))]


def lead(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Leading components of unit vectors and the length of what is left: products of these are at least those of the vectors."""
    part = x @ turn
    rest = np.sqrt(np.maximum(1 - (part * part).sum(1, keepdims=True), 0))
    return np.concatenate([part, rest], axis=1).astype(np.float32)


def _lists(shared):
    """Rows of each list, by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = shared.value[0]
        for batch in batches:
            if batch.num_rows:
                own, count = np.unique(nearest(unit(matrix(batch.column(0))), centers)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(count)], names=["list", "count"])

    return run


ASSIGNED = "page long, node long, n long, list int, least float, codes binary, vector binary"


def _assign(shared, dealt, cosine: float, dtype):
    """Rows with their page, list, codes and the least product with the code that a partner can have; the vector as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (centers, books, _), (first, count, blocks) = shared.value, dealt.value
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = matrix(batch.column(2))
            x = unit(raw)
            own = nearest(x, centers)[0]
            residual = x - centers[own]
            coded, codes = centers[own].copy(), []
            for part, book in zip(parts(x.shape[1], len(books)), books):
                code = nearest(residual[:, part], book)[0]
                coded[:, part] += book[code]
                codes.append(code.astype(np.uint8))
            least = least_near((coded**2).sum(1), np.sqrt(((x - coded) ** 2).sum(1)), cosine).astype(np.float32)
            spread = (batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            page = (first[own] + (spread % count[own].astype(np.uint64)).astype(np.int64)) // blocks
            cols = [pa.array(page), batch.column(0), batch.column(1), pa.array(own.astype(np.int32)), pa.array(least), packed(np.stack(codes, axis=1)), packed(raw.astype(dtype))]
            yield pa.RecordBatch.from_arrays(cols, names=["page", "node", "n", "list", "least", "codes", "vector"])

    return run


def reachable(x: np.ndarray, own: np.ndarray, centers: np.ndarray, radius: float, to: np.ndarray | None = None) -> np.ndarray:
    """Whether a partner of row i within ``radius`` can be in list j, of all lists or of ``to`` (rows by lists)."""
    others = centers if to is None else centers[to]
    home = ((x - centers[own]) ** 2).sum(1)
    mine, at = np.unique(own, return_inverse=True)
    gap = np.sqrt(squared_distances(centers[mine], others))[at]
    plane = (squared_distances(x, others) - home[:, None]) / (2 * np.maximum(gap, 1e-12))
    return (plane <= radius + 1e-9) | (gap < 1e-6)


HELD = {"node": np.int64, "n": np.int64, "list": np.int32, "least": np.float32, "codes": np.uint8, "vector": None}
PAGES = f"page long, {', '.join(f'{c} binary' for c in HELD)}, holds array<int>, reach array<boolean>"


def _pack(shared, radius: float):
    """A page of rows as one row, sorted by list, with the lists that it holds and those that any of its rows can reach."""

    def run(rows: pa.Table) -> pa.Table:
        centers = shared.value[0]
        rows = rows.sort_by("list")
        lists = rows["list"].to_numpy()
        reach = np.zeros(len(centers), bool)
        vectors = b"".join(rows["vector"].to_pylist())
        dim = centers.shape[1]
        x = unit(np.frombuffer(vectors, f"f{len(vectors) // dim // len(lists)}").reshape(-1, dim).astype(float))
        for at in range(0, len(x), TILE):
            if reach.all():
                break
            reach |= reachable(x[at : at + TILE], lists[at : at + TILE], centers, radius).any(axis=0)
        plain = [rows[c].to_numpy().tobytes() for c in ("node", "n", "list", "least")]
        held = [[v] for v in (*plain, b"".join(rows["codes"].to_pylist()), vectors)]
        arrays = [rows["page"][:1].combine_chunks(), *(pa.array(v, pa.binary()) for v in held), pa.array([np.unique(lists)], pa.list_(pa.int32())), pa.array([reach], pa.list_(pa.bool_()))]
        return pa.Table.from_arrays(arrays, names=["page", *HELD, "holds", "reach"])

    return run


def decoded(codes: np.ndarray, lists: np.ndarray, centers: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """Vectors that lists and codes stand for."""
    out = centers[lists].copy()
    for m, (part, book) in enumerate(zip(parts(centers.shape[1], len(books)), books)):
        out[:, part] += book[codes[:, m]]
    return out


def least_near(norm: np.ndarray, error: np.ndarray, cosine: float) -> np.ndarray:
    """Smallest product with a code that a partner of its member can have.

    Angles add up: a partner is within the cosine's angle of the member, which is
    within its own angle of the code (``norm``: the code's squared length,
    ``error``: the distance between member and code).
    """
    length = np.sqrt(norm)
    own = np.arccos(np.clip((1 + norm - error**2) / 2 / np.maximum(length, 1e-12), -1, 1))
    return length * np.cos(np.minimum(own + np.arccos(cosine), np.pi)) - 1e-4


FOUND = pa.schema([("node", pa.int64()), ("least", pa.int64()), ("links", pa.int64())])


class Page:
    """Vectors of a page as they are needed, from one row of the written table."""

    def __init__(self, row: list[pa.BinaryScalar], dtype, turn: np.ndarray):
        self.node, self.n, self.list, self.least, codes, vector = (np.frombuffer(v.as_buffer(), t or dtype) for v, t in zip(row, HELD.values()))
        self.codes = codes.reshape(len(self.node), -1)
        self.x = unit(vector.reshape(len(self.node), -1).astype(float))
        self.lead = lead(self.x, turn)


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of places a and b, pair by pair; ``root`` has the smallest place of each component."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while ((up := root[root]) != root).any():
            root[:] = up


def decided(a: Page, b: Page, i: np.ndarray, j: np.ndarray, centers: np.ndarray, books: list[np.ndarray], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and rows of b, pair by pair, that pass the filter by codes and the exact cosine."""
    kept = []
    for at in range(0, len(i), 8192):
        r, c = i[at : at + 8192], j[at : at + 8192]
        able = np.einsum("ij,ij->i", a.x[r], decoded(b.codes[c], b.list[c], centers, books)) >= b.least[c]
        r, c = r[able], c[able]
        near = np.einsum("ij,ij->i", a.x[r], b.x[c]) >= cosine
        kept.append((r[near], c[near]))
    return np.concatenate([k[0] for k in kept]), np.concatenate([k[1] for k in kept])


def decided_together(near: np.ndarray, a: Page, b: Page, r: np.ndarray, c: np.ndarray, centers: np.ndarray, books: list[np.ndarray], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The same for the pairs that ``near`` marks among rows r and members c, where these are many."""
    near = near & (a.x[r] @ decoded(b.codes[c], b.list[c], centers, books).T >= b.least[c])
    i, j = np.nonzero(near & (a.x[r] @ b.x[c].T >= cosine))
    return r[i], c[j]


def meet(a: Page, b: Page, same: bool, centers: np.ndarray, books: list[np.ndarray], cosine: float) -> pa.RecordBatch:
    """Links between two pages, or within one: each vector with its number of links and the smallest node of its component here."""
    radius, floor = float(np.sqrt(2 - 2 * cosine)), np.float32(cosine - 1e-4)
    nodes, counts = (a.node, a.n) if same else (np.concatenate([a.node, b.node]), np.concatenate([a.n, b.n]))
    links, root, shift = np.zeros(len(nodes), np.int64), np.arange(len(nodes)), 0 if same else len(a.node)
    here, place = np.unique(b.list, return_inverse=True)
    buffer = np.empty(TILE * TILE, np.float32)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def tie(i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(links, i, counts[j + shift])
        np.add.at(links, j + shift, counts[i])
        unite(root, i, j + shift)

    def settle() -> None:
        tie(*decided(a, b, *(np.concatenate(x) for x in zip(*waiting)), centers, books, cosine))
        waiting.clear()

    held = 0
    for at in range(0, len(a.node), TILE):
        some = slice(at, at + TILE)
        rows, q = np.arange(len(a.node))[some], a.lead[some]
        able = np.flatnonzero(reachable(a.x[some], a.list[some], centers, radius, here).any(axis=0)[place])
        if same:
            able = able[able > at]
        for start in range(0, len(able), TILE):
            cols = able[start : start + TILE]
            y = b.lead[cols[0] : cols[-1] + 1] if cols[-1] - cols[0] < len(cols) else b.lead[cols]
            near = np.matmul(q, y.T, out=buffer[: len(q) * len(y)].reshape(len(q), len(y))) >= floor
            if same:
                near &= cols > rows[:, None]
            r = np.flatnonzero(near.any(axis=1))
            near = near[r]
            i, j = np.nonzero(near)
            if len(i) > 4096:
                c = np.flatnonzero(near.any(axis=0))
                if len(i) * 8 >= len(r) * len(c):
                    tie(*decided_together(near[:, c], a, b, rows[r], cols[c], centers, books, cosine))
                    continue
            waiting.append((rows[r[i]], cols[j]))
            held += len(i)
            if held > PAIRS:
                settle()
                held = 0
    if held:
        settle()
    least = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(least, root, nodes)
    got = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(nodes[got]), pa.array(least[root[got]]), pa.array(links[got])], schema=FOUND)


def _match(shared, cosine: float, dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, books, turn = shared.value
        at, a = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = [c[k] for c in batch.columns]
                one, other = row[0].as_py(), row[1].as_py()
                if at != one:  # a task takes a page on the left through all those on the right
                    at, a = one, Page(row[2 : 2 + len(HELD)], dtype, turn)
                b = a if one == other else Page(row[2 + len(HELD) :], dtype, turn)
                yield meet(a, b, one == other, centers, books, cosine)

    return run


@contextmanager
def one_row_a_batch(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile sends rows to Python one by one: those of two pages are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def near_links(distinct: DataFrame, dim: int, *, cosine: float, sample: int, subspaces: int, block: int) -> DataFrame:
    """(node, least, links) for the vectors of length ``dim`` of ``distinct`` (node, n, vector), written."""
    spark = distinct.sparkSession
    sc = spark.sparkContext
    dtype = np.float32 if distinct.schema["vector"].dataType.elementType == FloatType() else np.float64
    vectors = distinct.filter(F.size("vector") == dim)
    total = vectors.count()
    # the sample is the rows with the smallest hashes: about twice as many are sorted, not all
    drawn = vectors if total <= 2 * sample else vectors.filter(F.xxhash64("node") < (2 * sample << 64) // total - (1 << 63))
    drawn = sample_rows(drawn, "vector", "node", sample)
    centers, books = train(drawn, list_count(total), subspaces)
    index = sc.broadcast((centers, books, leading(unit(drawn), cosine)))  # at most 1,024 centres and 256 codes a subspace
    counts = vectors.select("vector").mapInArrow(_lists(index), "list int, count long").groupBy("list").agg(F.sum("count").alias("count"))
    width = dim * np.dtype(dtype).itemsize
    rows = max(1, min(block, PAGE_BYTES // width))
    first, count = blocks_of_lists({r["list"]: r["count"] for r in counts.collect()}, len(centers), rows)  # a row for each list
    blocks = max(1, min(PAGE_BLOCKS, PAGE_BYTES // (rows * width)))
    coded = vectors.select("node", "n", "vector").mapInArrow(_assign(index, sc.broadcast((first, count, blocks)), cosine, dtype), ASSIGNED)
    packs = coded.groupBy("page").applyInArrow(_pack(index, float(np.sqrt(2 - 2 * cosine))), PAGES)
    # a file a page: a reader holds one at a time
    pages, path = scratch_table(packs, "pq-pages", maxRecordsPerFile=1)
    n_pages = int((first + count).max() - 1) // blocks + 1
    pages = pages.coalesce(-(-n_pages // min(8, -(-n_pages // 8))))  # a task has at most 8 pages by 8, and keeps 8
    a, b = (pages.select(*(F.col(c).alias(f"{side}_{c}") for c in pages.columns)) for side in "ab")
    # each two pages once, dealt evenly; a partner is in a list that its vector reaches, either way
    once = ((F.col("a_page") + F.col("b_page")) % 2 == 0) == (F.col("a_page") <= F.col("b_page"))
    reach = F.exists("b_holds", lambda x: F.get("a_reach", x)) & F.exists("a_holds", lambda x: F.get("b_reach", x))
    pairs = a.join(b.hint("shuffle_replicate_nl"), once & reach).select("a_page", "b_page", *(f"{side}_{c}" for side in "ab" for c in HELD))
    with one_row_a_batch(spark):
        found, _ = scratch_table(pairs.mapInArrow(_match(index, cosine, dtype), "node long, least long, links long"), "pq-found")
    drop_scratch(spark, path)
    return found


def embedding_near_dedup(
    embeddings: DataFrame, *, cosine: float = 0.9, sample: int = 16_384, subspaces: int = 8, block: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings``."""
    spark = embeddings.sparkSession
    vector = F.col(vector_col)
    of = embeddings.select(vector).schema[0].dataType
    if not (isinstance(of, ArrayType) and of.elementType == FloatType()):  # floats stay as small as they are
        vector = vector.cast("array<double>")
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
    usable = is_finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("h", F.when(usable, F.xxhash64("vector"))).withColumn("g", F.when(usable, F.xxhash64("vector", F.lit(1))))
    same = rows.filter("h is not null").groupBy("h", "g").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
    distinct, _ = scratch_table(same.withColumn("node", F.monotonically_increasing_id()), "pq-distinct")
    found = None
    for r in distinct.groupBy(F.size("vector").alias("dim")).count().filter("count > 1").collect():
        part = near_links(distinct, r["dim"], cosine=cosine, sample=sample, subspaces=subspaces, block=block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "node long, least long, links long")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts_ = connected_components(found.select(F.col("node").alias("src"), F.col("least").alias("dst")))
    member = distinct.drop("vector").join(links, "node", "left").join(parts_, "node", "left")
    member = member.withColumn("component", F.coalesce("component", "node"))
    ids = member.groupBy("component").agg(F.min("least_id").alias("component_id"))
    member = member.join(ids, "component").select("h", "g", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.drop("vector").join(member, ["h", "g"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
