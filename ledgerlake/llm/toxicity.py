"""Toxicity by multiple-instance learning: sentence scores under a noisy-or, trained from document labels.

A document is a bag of sentences.  A sentence's logit is a bias plus the sum of
its words' scores; a word's score is the sum of the weights of its features (the
word and its prefixes, hashed to a fixed table).  The
document is toxic with probability ``1 - prod(1 - p_sentence)``, and the weights
are fitted to document labels only, so the same scores locate the offending
sentences.

A noisy-or over very many clean sentences adds up to toxic by itself.  So the
sum that makes a text toxic rises with its length by what clean sentences of
labelled documents add: their mean and, for chance, a multiple of their spread
(both measured on a quarter of the sample by a fit to the rest), counted beyond
the sample's usual number of sentences.  Texts up to that length are scored by
the plain noisy-or.

Slots seen in fewer than ``min_docs`` training documents get no weight, so words
that one document happens to hold are not learnt by heart.

The fit is on a bounded sample of labelled documents (``max_docs`` rows and
``max_bytes`` of text, both parameters, whole texts, chosen by a hash of the id,
toxic and clean ones apart and reweighted to the labels' true shares).  Scoring
covers every whole text.

Texts without sentences (null, empty, no letters) score 0.  Without a toxic
training document every score is 0; without a clean one every non-empty text
scores 1.  Labels repeated for an id count as toxic if any is; null labels and
ids that match no document are left out.  Repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import drop_scratch, scratch_table

SLOTS = 1 << 18
CHANCE = 3.0  # spreads
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")


def word_features(word: str) -> list[int]:
    """Slots of a lower-case word: itself and its prefixes of 3 to 6 letters."""
    found = {"=" + word}
    found.update("<" + word[:n] for n in range(3, min(7, len(word))))
    return [zlib.crc32(f.encode()) % SLOTS for f in found]


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    constant: float | None = None
    leak: float = 0.0  # mean and spread of what a clean sentence adds, and sentences of a usual document
    spread: float = 0.0
    usual: float = 1.0

    def probability(self, z: np.ndarray) -> float:
        """That a document with these sentence logits is toxic."""
        more = max(0.0, len(z) - self.usual)
        allowed = self.leak * more + CHANCE * self.spread * math.sqrt(more)
        return float(-np.expm1(-softplus(z).sum() * math.log(2) / (math.log(2) + allowed)))


class WordScores(dict):
    """Scores of words, computed on first sight.  Emptied when it holds ``most`` words."""

    def __init__(self, weights: np.ndarray, most: int = 200_000):
        super().__init__()
        self.table, self.most = weights, most

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        score = self[word] = float(self.table[word_features(word)].sum())
        return score


def sentence_logits(text: str, scores: WordScores, bias: float) -> np.ndarray:
    """Logit of every sentence with words, in order; a word counts once in a sentence."""
    bags = map(set, map(WORD.findall, SENTENCE.split(text)))
    return np.array([bias + math.fsum(map(scores.__getitem__, bag)) for bag in bags if bag])


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def fit(texts: list[str], toxic: np.ndarray, weight: np.ndarray, *, rounds: int = 200, rate: float = 0.3, decay: float = 1e-5, support: float = 20.0, min_docs: int = 4) -> Model:
    """Noisy-or model of the texts by Adam on the weighted document likelihood.

    ``support`` damps the steps of slots whose gradient is less than that of so many documents.
    """
    if not toxic.any() or toxic.all():
        return Model(np.zeros(SLOTS, np.float32), 0.0, constant=float(bool(len(toxic)) and bool(toxic.all())))
    vocabulary: dict[str, int] = {}
    # flat typed arrays throughout: the sample's tokens are the largest thing that the fit holds
    words, first, doc = array("i"), array("q"), array("q")
    for d, text in enumerate(texts):
        for sentence in SENTENCE.split(text.lower()):
            if bag := dict.fromkeys(WORD.findall(sentence)):
                first.append(len(words))
                doc.append(d)
                words.extend([vocabulary.setdefault(t, len(vocabulary)) for t in bag])
    words, first, doc = np.frombuffer(words, np.int32), np.frombuffer(first, np.int64), np.frombuffer(doc, np.int64)
    flat, counts = array("i"), array("i")
    for word in vocabulary:
        found = word_features(word)
        flat.extend(found)
        counts.append(len(found))
    size, counts = len(vocabulary), np.frombuffer(counts, np.int32)
    vocabulary.clear()
    slots, slot = np.unique(np.frombuffer(flat, np.int32), return_inverse=True)
    # documents that hold a word: its first sentence in each document counts
    pairs = np.unique(np.repeat(doc, np.diff(np.append(first, len(words)))) * size + words) % size
    in_docs = np.bincount(pairs, minlength=size)
    del pairs
    cuts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    # documents that hold a slot, at most: its words' document counts summed
    spread = np.bincount(slot, np.repeat(in_docs, counts), len(slots))
    used = spread >= min_docs
    word_of = np.repeat(np.arange(size), counts)
    length = np.diff(np.append(first, len(words)))
    w, b = np.zeros(len(slots)), -4.0
    m1, m2, n1, n2 = np.zeros(len(slots)), np.zeros(len(slots)), 0.0, 0.0
    total = weight.sum()
    for k in range(1, rounds + 1):
        score = np.add.reduceat(w[slot], cuts)
        z = np.clip(np.add.reduceat(score[words], first) + b, -40, 40)
        s = np.bincount(doc, softplus(z), len(texts))
        by_doc = np.where(toxic, -1 / np.expm1(np.clip(s, 1e-9, 60)), 1.0) * weight / total
        by_sentence = by_doc[doc] / (1 + np.exp(-z))
        by_word = np.bincount(words, np.repeat(by_sentence, length), size)
        g = np.bincount(slot, by_word[word_of], len(slots)) * used + decay * w
        h = by_sentence.sum()
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        n1, n2 = 0.9 * n1 + 0.1 * h, 0.99 * n2 + 0.01 * h * h
        step = rate * np.sqrt(1 - 0.99**k) / (1 - 0.9**k) * min(1.0, 2 * (1 - k / (rounds + 1)))
        w -= step * m1 / (np.sqrt(m2) + support / len(texts))
        b -= step * n1 / (np.sqrt(n2) + 1e-8)
    table = np.zeros(SLOTS, np.float32)
    table[slots] = w
    z = np.add.reduceat(np.add.reduceat(w[slot], cuts)[words], first) + b
    clean = softplus(z[~toxic[doc]])
    usual = len(doc) / max(1, len(np.unique(doc)))
    if not len(clean):
        return Model(table, float(b), usual=usual)
    return Model(table, float(b), leak=float(clean.mean()), spread=float(clean.std()), usual=usual)


def fit_for_any_length(texts: list[str], toxic: np.ndarray, weight: np.ndarray) -> Model:
    """``fit`` with leak and spread measured on clean texts that a model of the other three quarters has not seen."""
    model = fit(texts, toxic, weight)
    if model.constant is not None:
        return model
    apart = np.arange(len(texts)) % 4 == 0
    probe = fit([t for t, a in zip(texts, apart) if not a], toxic[~apart], weight[~apart])
    if probe.constant is not None:
        return model
    scores = WordScores(probe.weights)
    parts = [softplus(sentence_logits(texts[k].lower(), scores, probe.bias)) for k in np.flatnonzero(apart & ~toxic)]
    added = np.concatenate([np.zeros(0), *parts])
    if len(added):
        model.leak, model.spread = max(model.leak, float(added.mean())), max(model.spread, float(added.std()))
    return model


def train(docs: DataFrame, labels: DataFrame, *, max_docs: int = 8_000, max_bytes: int = 32 << 20) -> Model:
    """Model from the labelled rows of ``docs`` (doc_id, text) that are not held out."""
    marks = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("_id"))
    marks = marks.agg(F.max(F.col("toxic").cast("int")).alias("_toxic")).filter(~held_out(F.col("_id")))
    sizes = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("_bytes"))
    sizes, path = scratch_table(sizes.join(marks, "_id"), "toxicity-labelled")
    chosen, weights = None, {}
    for r in sizes.groupBy((F.col("_toxic") > 0).alias("mark")).agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("bytes")).collect():
        take = int(min(r["n"], max_docs // 2, max(1, r["n"] * (max_bytes // 2) // max(1, r["bytes"]))))
        part = sizes.filter((F.col("_toxic") > 0) == F.lit(r["mark"])).orderBy(F.xxhash64("_id", F.lit("train")), "_id").limit(take)
        part = part.select("_id", F.lit(r["mark"]).alias("_mark"))
        chosen = part if chosen is None else chosen.unionByName(part)
        weights[r["mark"]] = r["n"] / take
    if chosen is None:
        return Model(np.zeros(SLOTS, np.float32), 0.0, constant=0.0)
    # at most max_docs ids: small enough to send to every task, so only the chosen texts move
    chosen = chosen.dropDuplicates(["_id"])
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("_text")).join(F.broadcast(chosen), "_id")
    # the sample is bounded, so one task holds it; the driver gets the weights alone
    fitted = rows.groupBy(F.lit(0).alias("_all")).applyInArrow(_fit_task(weights), "weights binary, bias double, constant double, leak double, spread double, usual double").first()
    drop_scratch(docs.sparkSession, path)
    if fitted is None:
        return Model(np.zeros(SLOTS, np.float32), 0.0, constant=0.0)
    return Model(np.frombuffer(fitted.weights, np.float32), fitted.bias, fitted.constant, fitted.leak, fitted.spread, fitted.usual)


def _fit_task(class_weights: dict[bool, float]):
    def run(table: pa.Table) -> pa.Table:
        table = table.select(["_id", "_text", "_mark"]).sort_by([("_id", "ascending"), ("_text", "ascending")])
        toxic = table["_mark"].to_numpy().astype(bool)
        weight = np.where(toxic, class_weights.get(True, 0.0), class_weights.get(False, 0.0))
        model = fit_for_any_length(table["_text"].to_pylist(), toxic, weight)
        length = {"leak": [model.leak], "spread": [model.spread], "usual": [model.usual]}
        return pa.table({"weights": pa.array([model.weights.tobytes()], pa.binary()), "bias": [model.bias], "constant": pa.array([model.constant], pa.float64())} | length)

    return run


def held_out(doc_id):
    """crc32 of the id as text, modulo 5, is 0 (a null id counts as empty text, so it is held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


# Places of offending sentences count code points of the lower-cased text.
OUT = "score double, n_sentences int, offending array<struct<start:int,end:int,score:double>>"


def score_udf(docs: DataFrame, model: Model):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(OUT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        bias, constant = model.bias, model.constant
        scores = WordScores(model.weights)
        for batch in batches:
            out = []
            for text in batch:
                low = (text or "").lower()
                z = sentence_logits(low, scores, bias)
                if constant is not None:
                    out.append((constant if len(z) else 0.0, len(z), []))
                    continue
                total = model.probability(z)
                spots = []
                if total >= 0.5:
                    p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                    places = [m.span() for m in re.finditer(r"[^.!?\n]+", low) if WORD.search(m[0])]
                    spots = [{"start": places[k][0], "end": places[k][1], "score": float(p[k])} for k in np.flatnonzero(p >= min(0.5, p.max()))]
                out.append((total, len(z), spots))
            yield pd.DataFrame(out, columns=["score", "n_sentences", "offending"])

    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the column _toxicity: score, number of sentences, offending sentences (start, end, score)."""
    return docs.withColumn("_toxicity", score_udf(docs, model)(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame, *, max_docs: int = 8_000) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences, offending for every row of ``docs``."""
    model = train(docs, labels, max_docs=max_docs)
    scored = score_documents(docs.select("doc_id", "text"), model)
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("_toxicity.score").alias("score"),
        F.when(F.col("_toxicity.score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.col("_toxicity.n_sentences").alias("n_sentences"), F.col("_toxicity.offending").alias("offending"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, *, max_docs: int = 8_000) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, columns unchanged."""
    model = train(docs, labels, max_docs=max_docs)
    return docs.filter(score_udf(docs, model)(F.col("text"))["score"] < 0.5)
