"""License scans: one automaton finds names, notice wordings and identifier tags; license expressions are parsed and evaluated.

A text is reduced to its words (A-Z lower-cased; runs of ASCII letters and
digits and of any other characters beyond ASCII) with one space between, and an Aho-Corasick automaton over
all phrases, each between two spaces, reports every place where a phrase's words
stand consecutively.  After an identifier tag (``SPDX-License-Identifier:``,
``license:`` and the like) the raw text is read on as an expression: a
shunting-yard parser with the precedences WITH, AND, OR (strongest first) takes the
longest complete expression that starts there and ends before the first thing that cannot go on
(prose, an unclosed parenthesis).  Its value is the least demanding choice that the reader has:
OR takes the lower of two levels, AND the higher, WITH an exception lowers one
step; levels go from 0 (permissive) over 1 (weak copyleft) and 2 (strong
copyleft) to 3 (network copyleft, non-commercial, no derivatives).

The score is a noisy-or over what was found: each tag with an expression counts
0.95, a notice's own wording 0.9, a name 0.9 right after words that grant (``licensed
under the``) and 0.6 elsewhere.  It says how surely the document carries a license.

Null, empty and blank texts have no words: zeros, null places, empty labels, score 0.
Repeated rows are done alike, ties do not arise; a null id stays.  Only doc_id
and text are read.  Texts are scanned whole, one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.  BASE is given; the others are common names and notice wordings.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
NAMES = {
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "european union public licence": "eupl",
    "common development and distribution license": "cddl", "bsd license": "bsd", "isc license": "isc", "zlib license": "zlib",
    "boost software license": "bsl", "sil open font license": "ofl", "open database license": "odbl",
    "creative commons zero": "cc0", "creative commons attribution": "cc-by", "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution noderivatives": "cc-by-nd",
    "cc0 1 0": "cc0", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "you may not use this file except in compliance with the license": "apache",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}
GRANTS = ("licensed under", "released under", "distributed under", "available under", "under the terms of")
TAGS = ("spdx license identifier", "license expression", "license", "licence")
#: How much a license family asks of who passes the work on.
LEVELS = {
    "mit": 0, "apache": 0, "bsd": 0, "isc": 0, "zlib": 0, "unlicense": 0, "cc0": 0, "cc-by": 0, "bsl": 0, "psf": 0, "wtfpl": 0,
    "artistic": 1, "mpl": 1, "epl": 1, "lgpl": 1, "cddl": 1, "ofl": 1, "gpl": 2, "eupl": 2, "odbl": 2, "cc-by-sa": 2,
    "agpl": 3, "cc-by-nc": 3, "cc-by-nd": 3, "cc-by-nc-sa": 3, "cc-by-nc-nd": 3, "licenseref": 3,
}
VARIANTS = {"clause", "only", "or", "later", "patent", "attribution", "views", "new", "universal", "international"}
WEIGHTS = {"tag": 0.95, "notice": 0.9, "granted": 0.9, "name": 0.6}

#: Lower case for A-Z; a space for ASCII characters that are in no word.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
AFTER_TAG = re.compile(rb"[\"']?[ \t]*[:=][ \t]*[\"']?([A-Za-z0-9.+() \t:-]*)")
TOKEN = re.compile(r"[()]|[A-Za-z0-9.:-]+\+?")
PRECEDENCE = {"OR": 1, "AND": 2, "WITH": 3}


def family(identifier: str) -> str | None:
    """The known license family of an identifier (``GPL-2.0-or-later``: gpl); None for anything else."""
    name = identifier.lower().rstrip("+")
    if name == "0bsd":
        return "bsd"
    if re.match(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+$", name):
        return "licenseref"
    parts = name.split("-")
    for k in range(len(parts), 0, -1):
        if (found := "-".join(parts[:k])) in LEVELS:
            return found if all(p in VARIANTS or re.match(r"v?\d[\d.]*$", p) for p in parts[k:]) else None
    return None


def is_exception(identifier: str) -> bool:
    return "exception" in identifier.lower().split("-")


def postfix(text: str) -> list[str]:
    """The longest complete license expression at the start of ``text``, operators behind their operands; [] for none."""
    out: list[str] = []
    held: list[str] = []
    best: list[str] = []
    want, after_with = "operand", False
    for token in TOKEN.findall(text):
        word = token.upper()
        if want == "operand":
            if token == "(" and not after_with:
                held.append(token)
                continue
            if not (is_exception(token) if after_with else family(token)):
                break
            out.append(token)
            want = "operator"
        elif token == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                break
            held.pop()
            after_with = True  # a group takes no exception
        elif word in PRECEDENCE and not (word == "WITH" and after_with):
            while held and PRECEDENCE.get(held[-1], 0) >= PRECEDENCE[word]:
                out.append(held.pop())
            held.append(word)
            want, after_with = "operand", word == "WITH"
            continue
        else:
            break
        if "(" not in held:
            best = out + held[::-1]
    return best


def evaluate(rpn: list[str]) -> tuple[str, list[str], int]:
    """(expression in normal form, its families in order of appearance, level) of a postfix expression."""
    stack: list[tuple[str, list[str], int, int]] = []  # text, families, level, precedence of its outermost operator
    for token in rpn:
        if token not in PRECEDENCE:
            f = family(token)
            stack.append((token, [f] if f else [], LEVELS.get(f, 0), 4))
            continue
        (right, more, low, p), (left, some, high, q) = stack.pop(), stack.pop()
        mine = PRECEDENCE[token]
        # operators of one kind group as they like; only a weaker one needs parentheses
        left, right = (f"({s})" if of < mine else s for s, of in ((left, q), (right, p)))
        level = {"AND": max(low, high), "OR": min(low, high), "WITH": max(high - 1, 0)}[token]
        stack.append((f"{left} {token} {right}", list(dict.fromkeys(some + more)), level, mine))
    return stack[0][:3]


class Scanner:
    """Finds phrases and expressions in one text at a time."""

    def __init__(self):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        kinds = [("name", NAMES), ("notice", NOTICES), ("grant", dict.fromkeys(GRANTS, "")), ("tag", dict.fromkeys(TAGS, "")), ("base", BASE)]
        for kind, phrases in kinds:
            for phrase, label in phrases.items():
                self.found.add_word(f" {phrase} ", (len(phrase) + 2, phrase.count(" ") + 1, kind, label))
        self.found.make_automaton()

    def __call__(self, data: bytes) -> tuple[int, list[tuple], list[tuple], float]:
        """(words, places (word, label, kind), expressions (word, expression, families, level), score) of a text in UTF-8."""
        plain = data.translate(WORD_BYTES)
        words = plain.split()
        joined = f" {b' '.join(words).decode('latin-1')} "
        places, tags, granted, at, word = [], [], set(), 0, 0
        for end, (size, n, kind, label) in self.found.iter(joined):
            start = end - size + 1
            # places come by their ends: a longer phrase may start before the last one
            word = word + joined.count(" ", at, start) if start >= at else word - joined.count(" ", start, at)
            at = start
            if kind == "grant":
                granted.add(word + n)
            elif kind == "tag":
                tags.append((word, word + n - 1))
            else:
                places.append((word, label, kind))
        expressions = self.expressions(data, plain, tags) if tags else []
        missed = 1.0
        for w, _, kind in places:
            missed *= 1 - WEIGHTS["notice" if kind == "notice" else "granted" if granted & {w, w - 1} else "name"]
        missed *= (1 - WEIGHTS["tag"]) ** len(expressions)
        return len(words), sorted(places), expressions, 1 - missed

    def expressions(self, data: bytes, plain: bytes, tags: list[tuple[int, int]]) -> list[tuple]:
        wanted, out, seen = dict((last, first) for first, last in reversed(tags)), [], set()
        for k, m in enumerate(re.finditer(rb"[^ ]+", plain)):
            if k in wanted and (after := AFTER_TAG.match(data, m.end())) and after.start(1) not in seen:
                if rpn := postfix(after[1].decode("ascii")):
                    seen.add(after.start(1))
                    out.append((wanted[k], *evaluate(rpn)))
        return out


SCANNED = (
    "doc_id long, n_words long, places array<struct<word:long,label:string,kind:string>>, "
    "expressions array<struct<word:long,expression:string,labels:array<string>,level:int>>, score double"
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, places, expressions and score of every row of ``docs`` (doc_id, text).

    ``places`` are names and notices by their first word (from 0); kind is base (the
    given phrases), name or notice.  ``expressions`` follow identifier tags.
    """
    place = pa.struct([("word", pa.int64()), ("label", pa.string()), ("kind", pa.string())])
    expression = pa.struct([("word", pa.int64()), ("expression", pa.string()), ("labels", pa.list_(pa.string())), ("level", pa.int32())])
    types = [pa.int64(), pa.list_(place), pa.list_(expression), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner()
        for batch in batches:
            rows = []
            for t in batch.column(1).cast(pa.binary()):
                n, places, expressions, score = scan(t.as_py() or b"")
                rows.append((n, [dict(zip(place.names, p)) for p in places], [dict(zip(expression.names, e)) for e in expressions], score))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "places", "expressions", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCANNED)


def license_digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_expressions, level (of the most demanding expression)."""
    base = F.filter("places", lambda p: p["kind"] == "base")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    all_labels = F.concat(F.transform("places", lambda p: p["label"]), F.flatten(F.transform("expressions", lambda e: e["labels"])))
    return scanned.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        joined("base.label").alias("base_labels"), joined(all_labels).alias("labels"), "score",
        F.size("expressions").cast("long").alias("n_expressions"), F.array_max("expressions.level").alias("level"),
    )
