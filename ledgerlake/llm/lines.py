"""Line dedup by a suffix array over line-ID sequences, built by distributed prefix doubling.

A document is the sequence of its non-blank lines, each line an ID (128 bits of
two hashes of its exact text).  Round 0 ranks single lines; round k ranks runs
of ``2**k`` lines by the pair of ranks of their halves: the distinct pairs are
counted with map-side combine, range-sorted over the cluster and numbered in
that order, which is the order of the suffix array by its first ``2**k`` lines.
A class of equal rank is an LCP interval of length ``2**k`` or more.  Classes
with one member are dropped after every round (their suffixes have no longer
common prefix with any other), so rounds shrink fast and end when no run of
``2**k`` lines occurs twice.

A run is *repeated* where its sequence of lines also starts earlier (smaller
doc_id, or the same document and an earlier line).  A line is deleted if it lies
in a repeated run of two or more lines, or is itself a repeated line of at least
``min_words`` words; the union of the intervals of all rounds is the union of
the maximal repeated runs, since a run of any length is covered by two of its
power-of-two pieces, both repeated.

No group is collected: classes are counted and their first place is a minimum,
members meet it in a join that Spark can split.  Documents with the same whole
text are settled by the text's 128-bit hash and only the first takes part.

Null and empty texts have no lines and stay as they are.  Blank lines are never
deleted.  Equal rows are one document; equal doc_ids with other texts are
separate documents in the order of a text hash; a null doc_id sorts first.
Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import columns_of, drop_scratch, mark_copies, release, scratch_table

NULL_KEY = -(1 << 63)
PLACE = ["key", "tag", "i"]


def _lines(min_words: int):
    schema = pa.schema([("key", pa.int64()), ("tag", pa.int64()), ("i", pa.int32()), ("h", pa.int64()), ("g", pa.int64()), ("enough", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for key, tag, text in zip(*(c.to_pylist() for c in batch.columns)):
                i = 0
                for line in (text or b"").split(b"\n"):
                    words = len(line.split())
                    if words:
                        h = xxhash.xxh3_128_intdigest(line)
                        for c, v in zip(cols, (key, tag, i, (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63), words >= min_words)):
                            c.append(v)
                        i += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def _ranked(runs: DataFrame, by: list[str], name: str) -> tuple[DataFrame, str]:
    """Classes of ``runs`` with two members or more: their rank in the order of ``by``, and their first place."""
    some = runs.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*PLACE)).alias("first")).filter("n > 1")
    # sorted by range over the cluster, so the number grows with the sort key; written once, so it stays
    return scratch_table(some.orderBy(*by).select(*by, "first", F.monotonically_increasing_id().alias("to")), name)


def repeated_runs(lines: DataFrame) -> DataFrame:
    """(key, tag, i, n_lines, enough, source) for every run of 1, 2, 4, ... lines that starts earlier too.

    ``lines``: key, tag, i, h, g, enough.  source is the first place (key, tag, i) of the same run.
    """
    spark = lines.sparkSession
    classes, path = _ranked(lines, ["h", "g"], "lines-rank")
    at, _ = scratch_table(lines.join(classes, ["h", "g"]).select(*PLACE, "enough", "first", F.col("to").alias("rank")), "lines-at")
    drop_scratch(spark, path)
    found, width = None, 1
    while True:
        later = at.filter(F.struct(*PLACE) != F.col("first"))
        later = later.select(*PLACE, F.lit(width).alias("n_lines"), "enough", F.col("first").alias("source"))
        found = later if found is None else found.unionByName(later)
        if at.isEmpty():
            return found
        ahead = F.max("rank").over(Window.partitionBy("key", "tag").orderBy("i").rangeBetween(width, width))
        pairs, pairs_path = scratch_table(at.select(*PLACE, "enough", "rank", ahead.alias("then")).filter("then is not null"), "lines-pairs")
        classes, path = _ranked(pairs, ["rank", "then"], "lines-rank")
        at = pairs.join(classes, ["rank", "then"]).select(*PLACE, "enough", "first", F.col("to").alias("rank"))
        at, _ = scratch_table(at, "lines-at")
        drop_scratch(spark, path, pairs_path)
        width *= 2


def line_marks(keyed: DataFrame, min_words: int) -> DataFrame:
    """(key, tag, is_copy, spans) for documents with repeated runs; spans: flat (start, n_lines, enough) of the rounds.

    ``keyed``: key, tag, tag2 and text (binary).
    """
    ids, _ = scratch_table(keyed.groupBy("key", "tag", "tag2").agg(F.count(F.lit(1)).alias("n")), "lines-texts")
    ids, _ = scratch_table(mark_copies(ids), "lines-copies")
    lines = keyed.select("key", "tag", "text").mapInArrow(_lines(min_words), "key long, tag long, i int, h long, g long, enough boolean")
    # copies of an earlier document do not take part
    own = ids.filter("not is_copy").select("key", "tag")
    lines, _ = scratch_table(lines, "lines")
    if not ids.filter("n > 1").isEmpty():
        lines = lines.dropDuplicates(PLACE)  # equal rows are one document
    runs = repeated_runs(lines.join(own, ["key", "tag"], "left_semi"))
    span = F.array("i", "n_lines", F.col("enough").cast("int"))
    marks = runs.groupBy("key", "tag").agg(F.flatten(F.collect_list(span)).alias("spans")).withColumn("is_copy", F.lit(False))
    copies = ids.filter("is_copy").select("key", "tag", "is_copy").withColumn("spans", F.lit(None).cast("array<int>"))
    marks, _ = scratch_table(marks.unionByName(copies), "lines-marks")
    release(keyed.sparkSession)
    return marks


KEPT = "text string, n_lines int, n_removed int, n_runs int"


def _kept_udf(min_words: int):
    def one(text: str | None, is_copy, spans):
        if text is None:
            return None, 0, 0, 0
        rows = text.split("\n")
        solid = [k for k, row in enumerate(rows) if row.encode("utf-8", "surrogatepass").split()]
        gone = np.zeros(len(solid) + 1, np.int64)
        if is_copy is not None and not pd.isna(is_copy) and is_copy:
            gone[:-1] = len(solid) > 1 or any(len(rows[k].encode("utf-8", "surrogatepass").split()) >= min_words for k in solid)
        elif spans is not None and len(spans):
            i, n, enough = np.asarray(spans, np.int64).reshape(-1, 3).T
            use = (n > 1) | (enough > 0)
            np.add.at(gone, i[use], 1)
            np.subtract.at(gone, (i + n)[use], 1)
            gone = np.cumsum(gone) > 0
        gone = gone[:-1].astype(bool)
        drop = {solid[k] for k in np.flatnonzero(gone)}
        kept = "\n".join(row for k, row in enumerate(rows) if k not in drop) if drop else text
        return kept, len(solid), len(drop), int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))

    @F.pandas_udf(KEPT)
    def kept(texts: pd.Series, copies: pd.Series, spans: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(*row) for row in zip(texts, copies, spans)], columns=["text", "n_lines", "n_removed", "n_runs"])

    return kept


def line_dedup(docs: DataFrame, *, min_words: int = 5) -> DataFrame:
    """``docs`` with the struct _lines: text without later copies of repeated runs, n_lines (non-blank), n_removed, n_runs.

    A column of that name is replaced; ``line_rows`` keeps the caller's columns apart.
    """
    return line_rows(docs, min_words=min_words).select(*[F.col("r").getField(c).alias(c) for c in docs.columns if c != "_lines"], "_lines")


def line_rows(docs: DataFrame, *, min_words: int = 5) -> DataFrame:
    """Rows of ``docs`` as the struct r, and the struct _lines of ``line_dedup``."""
    text, key = F.col("text").cast("string"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY))
    keyed = docs.select(key.alias("key"), F.xxhash64(text).alias("tag"), F.xxhash64(text, F.lit("line")).alias("tag2"), text.cast("binary").alias("text"))
    marks = line_marks(keyed, min_words).select("key", "tag", "spans", "is_copy")
    # the caller's columns stay in one struct, so their names meet none of these
    held = docs.select(F.struct(*columns_of(docs)).alias("r"), key.alias("key"), F.xxhash64(text).alias("tag"))
    out = held.join(marks, ["key", "tag"], "left")
    return out.select("r", _kept_udf(min_words)(F.col("r.text").cast("string"), "is_copy", "spans").alias("_lines"))


def line_digest(result: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the digest of the kept text (null counts as empty)."""
    kept = F.sha2(F.coalesce(F.col("_lines.text"), F.lit("")), 256)
    return result.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_lines.n_lines").cast("long").alias("n_lines"), F.col("_lines.n_removed").cast("long").alias("n_removed"), kept.alias("kept_sha256"))
