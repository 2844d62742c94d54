"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often corpus-wide.

Both tokenizers cut the same bytes (a space and the text).  One state vector
holds, for all documents of a batch, a pointer into the tokens of A and one into
those of B; each step emits the link of the two tokens pointed at, advances the
pointer whose token ends first (both where both end: a cut) and drops finished
documents.  A document of many tokens enters as several lanes of ``LANE`` tokens
of A, each starting with the token of B over its first byte: every link has one
token of A, so lanes share none and lose none.

Token ids are looked up by chunk (a word with the space before it): neither
tokenizer merges across such a border, which is checked in their files.  Unknown
chunks go to the libraries.  Where the files do not allow it, a text is one chunk.

A link's count is the number of documents (rows) that hold its id pair.  Counts
are summed per task before they are shuffled, and joined by streaming: each task
gets one bucket of the pairs and the links of one share of the documents in it,
so a pair that every document holds is spread over all shares.

A null or empty text, and one whose tokens' bytes differ from it under either
tokenizer, has no tokens: zeros and empty groups.  Repeated rows count as documents of their own;
a null id stays.  Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import byte_characters
from ledgerlake.llm.common import drop_scratch, scratch_table, shuffle_width

LANE = 256
BATCH_BYTES = 2 << 20
MEMO = 200_000
PAIRS_PER_BUCKET = 2_000_000

Tokenizers = tuple[str, bytes]


def load_tokenizers(json_path: str, model_path: str) -> Tokenizers:
    """Contents of a byte-level BPE file (A) and of a piece model (B): plain values that travel to the tasks."""
    with open(json_path, encoding="utf-8") as f, open(model_path, "rb") as g:
        return f.read(), g.read()


def _piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()


def split_is_bytes(spec: dict) -> bool:
    """Whether a tokenizer file cuts raw text at the byte-level pattern, which ends a piece before every last space of a gap."""
    split = spec.get("pre_tokenizer") or {}
    plain = spec.get("normalizer") is None and all(t["special"] for t in spec["added_tokens"])
    return bool(plain and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space"))


class PairEncoder:
    """Ids of texts under both tokenizers; remembers up to MEMO chunks in flat pools, and of more those that came twice."""

    #: A space that a cut may not simply go before: beside other white space, doubled or at the end.
    CONFLICT = re.compile(r"\s \s|  | \Z")
    CUT = re.compile(r"(?<=\S)(?= +[^ ])")

    def __init__(self, tokenizers: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        spec = json.loads(tokenizers[0])
        self.a = Tokenizer.from_str(tokenizers[0])
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=tokenizers[1])
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            self.a_bytes[k] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        #: byte-level BPE whose 256 bytes are all tokens spells every text back
        self.lossless = split_is_bytes(spec) and len({x for x in self.a_bytes if len(x) == 1}) == 256
        pieces = [self.b.id_to_piece(k) for k in range(self.b.vocab_size())]
        self.b_bytes = [_piece_bytes(p, self.b.is_byte(k)) for k, p in enumerate(pieces)]
        self.by_chunk = split_is_bytes(spec) and not any(re.search("[^▁]▁", p) for p in pieces)
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int32)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int32)
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.good = np.zeros(0, bool)
        self.seen = np.zeros(0, np.int64)
        self.pools = [(np.zeros(0, np.int32), np.zeros(1, np.int64)) for _ in "ab"]

    def shrink(self, most: int) -> None:
        """Forgets the chunks that came once, or all but ``most`` where that keeps too many."""
        keep = np.flatnonzero(self.seen > 1)
        if len(keep) > most:
            keep = np.sort(keep[np.argpartition(self.seen[keep], -most)[-most:]])
        place = np.full(len(self.seen), -1)
        place[keep] = np.arange(len(keep))
        self.code = {c: k for c, k in zip(self.code, place.tolist()) if k >= 0}  # codes go up in the dict's order
        self.good, self.seen = self.good[keep], self.seen[keep]
        for k, (flat, at) in enumerate(self.pools):
            n = at[keep + 1] - at[keep]
            ends = np.cumsum(n)
            self.pools[k] = flat[np.repeat(at[keep] - (ends - n), n) + np.arange(n.sum())], np.concatenate(([0], ends))

    def chunks(self, text: str) -> list[str]:
        """Pieces of the text; each stands for itself with a space before it."""
        if not self.by_chunk:
            return [text]
        if not self.CONFLICT.search(" " + text):
            return text.split(" ")
        return [c[1:] for c in self.CUT.split(" " + text)]

    def learn(self, chunks: list[str], at_once: int = 8_192) -> None:
        """Asks the libraries for ``at_once`` chunks at a time: what they return for a chunk is far larger than its ids."""
        for k in range(0, len(chunks), at_once):
            self.add(chunks[k : k + at_once])

    def add(self, chunks: list[str]) -> None:
        a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        b = self.b.encode(chunks, num_threads=1)
        self.code.update(zip(chunks, range(len(self.code), len(self.code) + len(chunks))))
        self.seen = np.append(self.seen, np.zeros(len(chunks), np.int64))
        want = [f" {c}".encode() for c in chunks]
        sizes = np.fromiter(map(len, want), np.int64, len(want))
        good = np.ones(len(chunks), bool)
        for k, (new, of, length) in enumerate(((a, self.a_bytes, self.a_len), (b, self.b_bytes, self.b_len))):
            flat, at = self.pools[k]
            n = np.fromiter(map(len, new), np.int64, len(new))
            ids = np.fromiter(chain.from_iterable(new), np.int32, int(n.sum()))
            self.pools[k] = np.append(flat, ids), np.append(at, at[-1] + np.cumsum(n))
            if k == 0 and self.lossless:
                continue
            spelled = np.bincount(np.repeat(np.arange(len(n)), n), weights=length[ids], minlength=len(n))
            # all in one comparison; where that fails, chunk by chunk
            if not ((spelled == sizes).all() and b"".join(map(of.__getitem__, ids.tolist())) == b"".join(want)):
                good &= [b"".join([of[i] for i in x]) == w for w, x in zip(want, new)]
        self.good = np.append(self.good, good)

    def __call__(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """([flat ids of A, of B], [document borders in A, in B]); a text without tokens has an empty range."""
        pieces = [self.chunks(t) if t else [] for t in texts]
        if len(self.code) > MEMO:
            self.shrink(MEMO // 2)
        if unknown := list(set(chain.from_iterable(pieces)).difference(self.code)):
            self.learn(unknown)
        counts = np.array([len(p) for p in pieces], np.int64)
        codes = np.fromiter(map(self.code.__getitem__, chain.from_iterable(pieces)), np.int64, int(counts.sum()))
        self.seen += np.bincount(codes, minlength=len(self.seen))
        doc = np.repeat(np.arange(len(texts)), counts)
        bad = np.bincount(doc[~self.good[codes]], minlength=len(texts)) > 0
        keep = ~bad[doc]
        codes, doc = codes[keep], doc[keep]
        ids, borders = [], []
        for flat, at in self.pools:
            n = at[codes + 1] - at[codes]
            ends = np.cumsum(n)
            ids.append(flat[np.repeat(at[codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)])
            borders.append(np.concatenate(([0], np.cumsum(np.bincount(doc, weights=n, minlength=len(texts)).astype(np.int64)))))
        return ids, borders


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_border: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and cuts of documents laid end to end: (A token, B token) of every link; of each token whether a cut ends it.

    ``a_end`` and ``b_end`` are the tokens' byte ends over the whole batch,
    ``a_border`` the documents' borders among the tokens of A.
    """
    lanes = -(-np.diff(a_border) // lane)
    lane_of = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at_a = np.repeat(a_border[:-1], lanes) + lane_of * lane
    last = np.minimum(at_a + lane, np.repeat(a_border[1:], lanes))
    at_b = np.searchsorted(b_end, np.where(at_a > 0, a_end[at_a - 1], 0), "right")
    a_cut, b_cut = np.zeros(len(a_end), bool), np.zeros(len(b_end), bool)
    links_a, links_b = [at_a[:0]], [at_b[:0]]
    while len(at_a):
        links_a.append(at_a)
        links_b.append(at_b)
        ends_a, ends_b = a_end[at_a], b_end[at_b]
        cut = ends_a == ends_b
        a_cut[at_a[cut]] = True
        b_cut[at_b[cut]] = True
        at_a, at_b = at_a + (ends_a <= ends_b), at_b + (ends_b <= ends_a)
        going = at_a < last
        if not going.all():
            at_a, at_b, last = at_a[going], at_b[going], last[going]
    return np.concatenate(links_a), np.concatenate(links_b), a_cut, b_cut


class Aligner:
    """Alignment of batches of texts: counts, groups and links of each."""

    def __init__(self, tokenizers: Tokenizers):
        self.encode = PairEncoder(tokenizers)
        self.width = len(self.encode.b_bytes)
        self.size = max(len(self.encode.a_bytes), self.width)
        self.spelled = [f"{k}{s}" for s in ",|;" for k in range(self.size)]

    def __call__(self, texts: list[str | None]) -> list[tuple[int, int, int, int, str, bytes]]:
        """Per text: tokens of A and B, groups, links, the groups spelled out, and the links' pair codes, sorted."""
        (a, b), (a_border, b_border) = self.encode(texts)
        a_end, b_end = np.cumsum(self.encode.a_len[a]), np.cumsum(self.encode.b_len[b])
        link_a, link_b, a_cut, b_cut = lockstep(a_end, b_end, a_border)
        # pair codes in document order, sorted within a document
        doc = (np.searchsorted(a_border, link_a, "right") - 1).astype(np.int64)
        pairs = np.int64(len(self.encode.a_bytes)) * self.width
        key = np.sort(doc * pairs + a[link_a].astype(np.int64) * self.width + b[link_b])
        link_border = np.searchsorted(key, np.arange(len(texts) + 1) * pairs)
        codes = (key % pairs).astype("<u4" if pairs <= 1 << 32 else "<u8")
        # groups in order: a group's tokens of A, then those of B
        a_before, b_before = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        a_close, b_close = np.flatnonzero(a_cut) + 1, np.flatnonzero(b_cut) + 1
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate(([0], b_close))[a_before]] = a + self.size * a_cut
        order[np.arange(len(b)) + a_close[b_before] if len(b) else slice(0)] = b + 2 * self.size * b_cut
        cuts = np.concatenate(([0], np.cumsum(a_cut)))
        out, spelled = [], self.spelled
        for k in range(len(texts)):
            (a0, a1), (b0, b1), (l0, l1) = a_border[k : k + 2], b_border[k : k + 2], link_border[k : k + 2]
            groups = "".join([spelled[i] for i in order[a0 + b0 : a1 + b1].tolist()])[:-1]
            out.append((int(a1 - a0), int(b1 - b0), int(cuts[a1] - cuts[a0]), int(l1 - l0), groups, codes[l0:l1].tobytes()))
        return out


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, codes binary"


def align(docs: DataFrame, tokenizers: Tokenizers, hashed: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2``), codes of every row of ``docs`` (doc_id, text).

    ``hashed`` gives the groups' SHA-256 in their place.  ``codes`` holds a little-endian
    number a link (id of A times the size of B, plus id of B; 4 bytes, 8 for larger vocabularies), sorted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizers)
    names = [c.split()[0] for c in ALIGNED.split(", ")]
    types = [pa.int64()] * 5 + [pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(shared.value)

        def rows(ids, texts):
            done = aligner(texts)
            if hashed:
                done = [(*d[:4], hashlib.sha256(d[4].encode()).hexdigest() if d[4] else "", d[5]) for d in done]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((ids, *zip(*done)), types)], names=names)

        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(text)
                size += len(text or "")
                if size > BATCH_BYTES or len(ids) > 20_000:
                    yield rows(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield rows(ids, texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ALIGNED)


def _slices(batches: Iterator[pa.RecordBatch], links: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of about as many links (n_links), one row at least: what a task holds is bounded, whatever the batch."""
    for batch in batches:
        total = np.cumsum(np.asarray(batch.column("n_links").fill_null(0), np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + links, "right")))
            yield batch.slice(at, to - at)
            at = to


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column without nulls, and the rows' borders among them, read in place."""
    ends = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    if not len(column) or ends[0] == ends[-1]:
        return np.zeros(0, kind), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], kind, int(ends[-1] - ends[0]) // size, int(ends[0])), (ends - ends[0]).astype(np.int64) // size


def _blobs(flat: np.ndarray, border: np.ndarray) -> pa.Array:
    """A binary column of the numbers' bytes, a row between each two borders."""
    ends = (border * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(flat.tobytes())])


def pair_width(tokenizers: Tokenizers) -> tuple[int, str]:
    """Size of B, and the kind of number that a link's code is."""
    encoder = PairEncoder(tokenizers)
    pairs = len(encoder.a_bytes) * len(encoder.b_bytes)
    return len(encoder.b_bytes), "<u4" if pairs <= 1 << 32 else "<u8"


def link_counts(aligned: DataFrame, width: int, kind: str, hold: int = 2_000_000) -> DataFrame:
    """(code, n, best) of every linked id pair: the documents that hold it, and whether no pair of its A id has more.

    A task sums up to ``hold`` pairs before it sends them on.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(parts):
            code, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return code, np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(code)).astype(np.int64)

        def rows(code, n):
            return pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n)], names=["code", "n"])

        parts, size = [], 0
        for batch in _slices(batches):
            flat, border = _flat(batch.column("codes"), kind)
            if not len(flat):
                continue
            first = np.concatenate(([True], flat[1:] != flat[:-1]))
            first[border[:-1][border[:-1] < len(flat)]] = True
            parts.append(np.unique(flat[first], return_counts=True))
            size += len(parts[-1][0])
            if size > hold:
                parts = [summed(parts)]
                size = len(parts[0][0])
                if size > hold // 2:
                    yield rows(*parts[0])
                    parts, size = [], 0
        if parts:
            yield rows(*summed(parts))

    counted = aligned.select("codes", "n_links").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    most = counted.groupBy(F.expr(f"code div {width}").alias("a")).agg(F.max("n").alias("most"))
    return counted.join(most, F.expr(f"code div {width}") == F.col("a")).select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def score_links(aligned: DataFrame, counts: DataFrame, kind: str, per_bucket: int = PAIRS_PER_BUCKET, shares: int | None = None) -> DataFrame:
    """``aligned`` (with a unique column row) with n_best and count_sum over its links, in place of codes.

    Pairs fall into buckets of about ``per_bucket`` by their code, documents into
    ``shares``; a task reads one bucket's counts, then streams its share's links in it.
    """
    spark = aligned.sparkSession
    shares = shares or shuffle_width(spark)
    buckets = -(-counts.count() // per_bucket) or 1
    kept = [c for c in aligned.columns if c != "codes"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            flat, border = _flat(batch.column("codes"), kind)
            bucket, doc = flat % buckets, np.repeat(np.arange(batch.num_rows), np.diff(border))
            share = np.asarray(batch.column("row"), np.int64) % shares
            rest = batch.drop_columns(["codes"])
            for b in range(buckets):
                mine = bucket == b
                blobs = _blobs(flat[mine], np.concatenate(([0], np.cumsum(np.bincount(doc[mine], minlength=batch.num_rows)))))
                yield pa.RecordBatch.from_arrays([pa.array((b * shares + share).astype(np.int32)), blobs, *rest.columns], names=["slot", "codes", *rest.schema.names])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, n, best = (np.asarray(c) for c in (batch.column(0), batch.column(1), batch.column(2).cast(pa.int8())))
            of = code % buckets
            out = [(b, code[of == b].astype("<i8").tobytes(), n[of == b].astype("<i8").tobytes(), best[of == b].astype("<i1").tobytes()) for b in range(buckets)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), *[pa.binary()] * 3))], names=["bucket", "codes", "ns", "bests"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, table = [], None
        for batch in _slices(batches):
            is_count = np.asarray(batch.column("ns").is_valid())
            for r in batch.filter(pa.array(is_count)).select(["codes", "ns", "bests"]).to_pylist():
                parts.append((np.frombuffer(r["codes"], "<i8"), np.frombuffer(r["ns"], "<i8"), np.frombuffer(r["bests"], "<i1")))
            links = batch.filter(pa.array(~is_count))
            if not links.num_rows:
                continue
            if table is None:  # all counts come before all links
                table = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3
                by = np.argsort(table[0], kind="stable")
                table, parts = [c[by] for c in table], []
            flat, border = _flat(links.column("codes"), kind)
            at = np.searchsorted(table[0], flat.astype(np.int64))
            sums = [np.concatenate(([0], np.cumsum(c[at], dtype=np.int64))) for c in (table[2], table[1])]
            sums = [s[border[1:]] - s[border[:-1]] for s in sums]
            yield pa.RecordBatch.from_arrays([*(links.column(c) for c in kept), *map(pa.array, sums)], names=[*kept, "n_best", "count_sum"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name != "codes")
    links = aligned.mapInArrow(split, f"slot int, codes binary, {fields}")
    packed = counts.select("code", "n", "best").mapInArrow(pack, "bucket int, codes binary, ns binary, bests binary")
    packed = packed.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    packed = packed.select(F.expr(f"cast(bucket * {shares} + share as int)").alias("slot"), "codes", "ns", "bests")
    both = packed.unionByName(links, allowMissingColumns=True).repartitionById(buckets * shares, F.col("slot"))
    both = both.sortWithinPartitions(F.col("ns").isNull())
    parts = both.mapInArrow(look_up, f"{fields}, n_best long, count_sum long")
    if buckets == 1:
        return parts
    return parts.groupBy(*kept).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def aligned_corpus(docs: DataFrame, tokenizers: Tokenizers, hashed: bool = False, per_bucket: int = PAIRS_PER_BUCKET) -> DataFrame:
    """``align`` of all rows, with n_best (links whose count no pair of their A id exceeds) and count_sum."""
    spark = docs.sparkSession
    width, kind = pair_width(tokenizers)
    aligned, links = scratch_table(align(docs, tokenizers, hashed).withColumn("row", F.monotonically_increasing_id()), "align-links")
    counts, path = scratch_table(link_counts(aligned, width, kind), "align-counts")
    scored, _ = scratch_table(score_links(aligned, counts, kind, per_bucket), "align-scored")
    drop_scratch(spark, path, links)
    return scored.drop("row")

