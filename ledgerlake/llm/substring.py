"""Substring dedup by fixed-block anchors.

Every 20-word window holds a whole block of 10 words that starts at a multiple
of 10 in its own document.  These non-overlapping blocks are the index.  Every
rolling 10-word window of every document probes it, and a block is *live* when
its words also occur somewhere else (aligned there or not).  If a 20-word window
occurs twice, the aligned block inside either occurrence is probed by the other,
so windows whose block is not live need no further look.  Hits are extended: the
20-word windows around live blocks are compared whole, every occurrence but the
first in (doc_id, start) order is marked, and runs of marked windows are the
maximal exact repeats that are removed.

Both comparisons are hash shuffles of packed arrays: a row holds the hashes that
one chunk of documents (some MB of text) sends to one bucket, five bytes a probe,
repeated hashes of a chunk sent at most twice.  Buckets number one per
``bucket_windows`` windows of input, so a bucket's size does not grow with the
corpus.  The truncated probe hash can only add work; windows are decided by 128
bits of two independent hashes.

Documents with the same whole text are settled by their text's 128-bit hash: all
but the first are removed whole (from 20 words on) and do not enter the second
comparison, so no group of copies gathers anywhere.

A null text has no words.  Rows with equal doc_id and text are one document and
get equal results; rows with equal doc_id and other texts are separate documents
in the order of a text hash.  A null doc_id sorts first.  Input columns other
than the two named are ignored.  The input has to be a table or scan that yields
the same partitions when a lost task is run again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import mark_copies, release, scratch_table, shuffle_width
from ledgerlake.llm.wordhash import WordHasher, window_hashes, word_spans

NULL_KEY = -(1 << 63)
CHUNK_BYTES = 4 << 20


def _chunks(batches: Iterator[pa.RecordBatch], text_at: int, limit: int = CHUNK_BYTES) -> Iterator[list[dict]]:
    """Rows in lists of about ``limit`` bytes of text (one longer text stands alone)."""
    rows, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            text = row["text"] or b""
            if rows and size + len(text) > limit:
                yield rows
                rows, size = [], 0
            rows.append(row)
            size += len(text)
    if rows:
        yield rows


class _Words:
    """Words of a list of texts: hashes, the document of each word, its position there."""

    def __init__(self, texts: list[bytes], hashers: list[WordHasher]):
        buf = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, ends = word_spans(buf)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        first = np.searchsorted(starts, begins)
        self.n = np.diff(np.append(first, len(starts)))
        self.first = first
        self.doc = np.repeat(np.arange(len(texts)), self.n)
        self.at = np.arange(len(starts)) - first[self.doc] if len(starts) else np.zeros(0, int)
        self.hashes = [h(buf, starts, ends) for h in hashers]

    def starts(self, width: int) -> np.ndarray:
        """Word indices where a window of ``width`` words of one document starts."""
        return np.flatnonzero(self.at + width <= self.n[self.doc])


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


ANCHOR_SCHEMA = "bucket long, chunk long, probes binary, refs binary, ordinals binary, docs binary"


def _anchors(block: int, window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), *((c, pa.binary()) for c in ("probes", "refs", "ordinals", "docs"))])
        part = TaskContext.get().partitionId()
        for k, rows in enumerate(_chunks(batches, 2)):
            chunk = (part << 32) | k
            w = _Words([r["text"] or b"" for r in rows], [hasher])
            long_enough = w.n >= window
            h = window_hashes(w.hashes[0], block)
            at = w.starts(block)
            at = at[long_enough[w.doc[at]]]
            if not len(at):
                continue
            h = h[at]
            to = (h >> np.uint64(40)) % np.uint64(buckets)
            low = (h & np.uint64((1 << 40) - 1)).astype("<u8")
            # probes: each hash of the chunk once, or twice where it repeats here
            seen, times = np.unique(h, return_counts=True)
            probes = np.repeat(seen, np.minimum(times, 2))
            probe_to = (probes >> np.uint64(40)) % np.uint64(buckets)
            probe_low = (probes & np.uint64((1 << 40) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            aligned = np.flatnonzero(w.at[at] % block == 0)
            out = {b: [probe_low[i].tobytes(), b"", b""] for b, i in _by_bucket(probe_to)}
            low5 = low.view(np.uint8).reshape(-1, 8)[:, :5]
            for b, i in _by_bucket(to[aligned]):
                out[b][1:] = [low5[aligned[i]].tobytes(), i.astype("<u4").tobytes()]
            table = np.array([[NULL_KEY if r["key"] is None else r["key"] for r in rows], [r["tag"] for r in rows]], np.int64)
            blocks = np.where(long_enough, w.n // block, 0)
            docs = table.tobytes() + blocks.astype("<i8").tobytes()
            cols = [[*out, -1 - chunk % buckets], [chunk] * (len(out) + 1), [x[0] for x in out.values()] + [None], [x[1] for x in out.values()] + [None], [x[2] for x in out.values()] + [None], [None] * len(out) + [docs]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def _unpack5(parts: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel()


LIVE = pa.schema([("chunk", pa.int64()), ("ordinals", pa.binary()), ("docs", pa.binary())])


def _live(table: pa.Table) -> pa.Table:
    """One bucket: for every chunk, the ordinals of its blocks whose hash occurs twice or more in the bucket."""
    rows = table.to_pylist()
    if rows[0]["bucket"] < 0:
        return table.select(["chunk", "ordinals", "docs"]).cast(LIVE)
    probes = np.sort(_unpack5([r["probes"] for r in rows]))
    again = np.unique(probes[1:][probes[1:] == probes[:-1]])
    out = []
    for r in rows:
        refs = _unpack5([r["refs"]])
        hit = again[np.minimum(np.searchsorted(again, refs), len(again) - 1)] == refs if len(again) else np.zeros(len(refs), bool)
        if hit.any():
            out.append({"chunk": r["chunk"], "ordinals": np.frombuffer(r["ordinals"], "<u4")[hit].tobytes(), "docs": None})
    return pa.Table.from_pylist(out, LIVE)


BLOCKS = pa.schema([("key", pa.int64()), ("tag", pa.int64()), ("blocks", pa.binary())])


def _blocks_of_docs(table: pa.Table) -> pa.Table:
    """One chunk: its live blocks by document."""
    rows = table.to_pylist()
    docs = next((np.frombuffer(r["docs"], "<i8").reshape(3, -1) for r in rows if r["docs"] is not None), None)
    ordinals = np.frombuffer(b"".join(r["ordinals"] for r in rows if r["ordinals"] is not None), "<u4")
    out = []
    if docs is not None and len(ordinals):
        ordinals = np.sort(ordinals)
        ends = np.cumsum(docs[2])
        doc = np.searchsorted(ends, ordinals, "right")
        for d, i in _by_bucket(doc):
            out.append({"key": int(docs[0, d]), "tag": int(docs[1, d]), "blocks": (ordinals[i] - (ends[d] - docs[2, d])).astype("<u4").tobytes()})
    return pa.Table.from_pylist(out, BLOCKS)


WINDOW_SCHEMA = "bucket long, chunk long, hashes binary, docs binary, places binary"


def _windows(block: int, window: int, buckets: int):
    """Windows around live blocks, packed by bucket: 128-bit hash, document (index in the row's list), start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = [WordHasher(0), WordHasher(1)]
        schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), *((c, pa.binary()) for c in ("hashes", "docs", "places"))])
        part = TaskContext.get().partitionId()
        for k, rows in enumerate(_chunks(batches, 3)):
            w = _Words([r["text"] or b"" for r in rows], hashers)
            live = np.zeros(len(w.at) // block + len(rows) + 1, bool)
            base = np.concatenate(([0], np.cumsum(w.n // block + 1)))
            for d, r in enumerate(rows):
                live[base[d] + np.frombuffer(r["blocks"], "<u4")] = True
            at = w.starts(window)
            at = at[live[base[w.doc[at]] + -(-w.at[at] // block)]]
            if not len(at):
                continue
            h = np.stack([window_hashes(x, window, i)[at] for i, x in enumerate(w.hashes)], axis=1).astype("<u8")
            table = np.array([[NULL_KEY if r["key"] is None else r["key"] for r in rows], [r["tag"] for r in rows]], np.int64)
            cols: list[list] = [[], [], [], [], []]
            for b, i in _by_bucket((h[:, 0] >> np.uint64(40)) % np.uint64(buckets)):
                own, index = np.unique(w.doc[at[i]], return_inverse=True)
                places = np.stack([index, w.at[at[i]]]).astype("<u4")
                for c, v in zip(cols, (b, (part << 32) | k, h[i].tobytes(), table[:, own].tobytes(), places.tobytes())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


AGAIN = pa.schema([("chunk", pa.int64()), ("docs", pa.binary()), ("places", pa.binary())])


def _repeats(table: pa.Table) -> pa.Table:
    """One bucket: by chunk, the windows whose words start earlier too."""
    rows = table.to_pylist()
    h, key, tag, start, source, own = [], [], [], [], [], []
    for k, r in enumerate(rows):
        docs, places = np.frombuffer(r["docs"], "<i8").reshape(2, -1), np.frombuffer(r["places"], "<u4").reshape(2, -1)
        h.append(np.frombuffer(r["hashes"], "<u8").reshape(-1, 2))
        key.append(docs[0, places[0]])
        tag.append(docs[1, places[0]])
        start.append(places[1])
        own.append(places[0])
        source.append(np.full(len(places[0]), k))
    hs, ks, ts, ss, src, ow = np.concatenate(h), *map(np.concatenate, (key, tag, start, source, own))
    order = np.lexsort((ss, ts, ks, hs[:, 1], hs[:, 0]))
    hs, ks, ts, ss, src, ow = hs[order], ks[order], ts[order], ss[order], src[order], ow[order]
    new = np.concatenate(([True], (hs[1:] != hs[:-1]).any(axis=1)))
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (ks != ks[head]) | (ts != ts[head]) | (ss != ss[head])
    out = []
    for k, i in _by_bucket(src[later]):
        places = np.stack([ow[later][i], ss[later][i]]).astype("<u4")
        out.append({"chunk": rows[k]["chunk"], "docs": rows[k]["docs"], "places": places.tobytes()})
    return pa.Table.from_pylist(out, AGAIN)


SPANS = pa.schema([("key", pa.int64()), ("tag", pa.int64()), ("spans", pa.binary())])


def _spans_of_docs(window: int):
    """One chunk: the maximal runs of repeated words of its documents, as (start, end) pairs."""

    def run(table: pa.Table) -> pa.Table:
        found: dict[tuple[int, int], list[np.ndarray]] = {}
        for r in table.to_pylist():
            docs, places = np.frombuffer(r["docs"], "<i8").reshape(2, -1), np.frombuffer(r["places"], "<u4").reshape(2, -1)
            for d, i in _by_bucket(places[0]):
                found.setdefault((int(docs[0, d]), int(docs[1, d])), []).append(places[1, i])
        out = []
        for (key, tag), starts in found.items():
            s = np.unique(np.concatenate(starts)).astype(np.int64)
            cut = np.flatnonzero(np.diff(s) > window)
            lo, hi = s[np.concatenate(([0], cut + 1))], s[np.append(cut, len(s) - 1)] + window
            out.append({"key": key, "tag": tag, "spans": np.stack([lo, hi], axis=1).astype("<i8").tobytes()})
        return pa.Table.from_pylist(out, SPANS)

    return run


def repeated_spans(docs: DataFrame, *, window: int = 20, bucket_windows: int = 4_000_000) -> DataFrame:
    """(key, tag, spans, is_copy): what to remove, for documents that have anything to remove.

    ``docs`` has key (doc_id, nulls as the smallest long), tag and tag2 (two hashes of the text) and text (binary).
    spans: little-endian pairs of 64-bit word positions [start, end); is_copy: the whole text was seen earlier.
    """
    block = window // 2
    spark = docs.sparkSession
    total = docs.select(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(shuffle_width(spark), -(-int(total) // (6 * bucket_windows)))
    sent = docs.select("key", "tag", "text").mapInArrow(_anchors(block, window, buckets), ANCHOR_SCHEMA)
    live = sent.groupBy("bucket").applyInArrow(_live, "chunk long, ordinals binary, docs binary")
    blocks = live.groupBy("chunk").applyInArrow(_blocks_of_docs, "key long, tag long, blocks binary")
    blocks, _ = scratch_table(blocks, "substring-blocks")
    release(spark)
    ids, _ = scratch_table(docs.select("key", "tag", "tag2").distinct(), "substring-texts")
    marked, _ = scratch_table(mark_copies(ids).select("key", "tag", "is_copy"), "substring-copies")
    # equal doc_ids with several texts give several rows of live blocks, equal rows equal ones
    blocks = blocks.dropDuplicates(["key", "tag"]).join(marked.filter("is_copy"), ["key", "tag"], "left_anti")
    texts = docs.select("key", "tag", "text").join(blocks, ["key", "tag"])
    packed = texts.select("key", "tag", "blocks", "text").mapInArrow(_windows(block, window, buckets), WINDOW_SCHEMA)
    again = packed.groupBy("bucket").applyInArrow(_repeats, "chunk long, docs binary, places binary")
    spans = again.groupBy("chunk").applyInArrow(_spans_of_docs(window), "key long, tag long, spans binary").dropDuplicates(["key", "tag"])
    out = spans.withColumn("is_copy", F.lit(False)).unionByName(marked.filter("is_copy").withColumn("spans", F.lit(None).cast("binary")))
    out, _ = scratch_table(out, "substring-spans")
    release(spark)
    return out


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                words = (r["text"] or b"").split()
                kept = words
                if r["is_copy"]:
                    kept = words if len(words) < window else []
                elif r["spans"]:
                    kept, at = [], 0
                    for lo, hi in np.frombuffer(r["spans"], "<i8").reshape(-1, 2).tolist():
                        kept += words[at:lo]
                        at = hi
                    kept += words[at:]
                out.append((r["doc_id"], len(words), len(words) - len(kept), b" ".join(kept)))
            cols = list(zip(*out)) if out else [[], [], [], []]
            arrays = [pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def substring_dedup(docs: DataFrame, *, window: int = 20, bucket_windows: int = 4_000_000) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) for every row of ``docs``."""
    text = F.col("text").cast("string")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("key"),
        F.xxhash64(text).alias("tag"), F.xxhash64(text, F.lit(window)).alias("tag2"), text.cast("binary").alias("text"),
    )
    marks = repeated_spans(keyed, window=window, bucket_windows=bucket_windows)
    texts = keyed.select("doc_id", "key", "tag", "text").join(marks, ["key", "tag"], "left")
    return texts.select("doc_id", "text", "spans", "is_copy").mapInArrow(_kept(window), "doc_id long, n_words long, n_removed long, kept string")


def kept_digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

