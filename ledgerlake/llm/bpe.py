"""BPE encoding and decoding through a minimal acyclic transducer of frequent words.

The words of the whole corpus are counted, the most frequent (at most
``lexicon_size``) are encoded once by merging, and a minimal acyclic transducer is compiled of
them: an automaton over the words' bytes whose common suffixes are shared, with
a word's rank read off the counts on its path, and the rank's ids in a table.
Tasks get it as one block of arrays, which they map into memory from an unlinked
temporary file.  Words outside the lexicon are merged exactly where they occur,
so the lexicon's size changes the speed and never the ids.  The round trip gathers
the new words of a block of texts, walks the transducer with all of them at once,
a byte a step, and merges those outside it side by side, a pair of each a round.

The tokenizer file (``tokenizers`` JSON) gives vocabulary, merges and pattern;
the steps are: NFC, white space to one space, lower case, the split pattern,
bytes as printable characters, merges by rank with ``</w>`` on a word's last
character.  Strings of the file's special tokens in a text get those tokens' ids,
as the file's added tokens say.  Characters that one of the two Unicode versions
at hand does not know yet (Python's, the library's) may be cut another way.

A null text counts as empty and gives no ids.  Other columns pass through.
Repeated rows are encoded alike.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import drop_scratch, scratch_table

MEMO = 150_000
ROUND_TRIP_MEMO = 450_000
BLOCK = 1_000_000
TOGETHER = 64
PREFIX = 4
PREFIXES = 16_384
SINGLE = [bytes([b]) for b in range(256)]
MARKS = bytes([0xC0, 0xC1, *range(0xF5, 0xFE)])
IN_UTF8 = bytes(b for b in range(256) if b not in MARKS)
TO_MARKS, FROM_MARKS = bytes.maketrans(b"0123456789 ", MARKS), bytes.maketrans(MARKS, b"0123456789 ")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: its own where that is printable, else the next free from 256 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


@dataclass
class Vocabulary:
    """What a tokenizer file says, ready for merging."""

    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    pattern: str
    special: dict[str, int]
    suffix: str

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or spec["decoder"] is not None:
            raise ValueError(f"{path}: not a word BPE file of the kind that this operator reads")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        return cls(model["vocab"], {m: k for k, m in enumerate(merges)}, split["pattern"]["Regex"], special, model["end_of_word_suffix"] or "")


    def parts(self) -> tuple:
        """The fields, for a broadcast: plain values need no class on the executors."""
        return self.ids, self.ranks, self.pattern, self.special, self.suffix


class Merger:
    """Exact BPE of single words."""

    def __init__(self, vocabulary: Vocabulary):
        ids, chars = vocabulary.ids, byte_characters()
        self.first = [ids[c] for c in chars]
        self.last = [ids[c + vocabulary.suffix] for c in chars]
        # a pair of ids is one number; merges keep their order, and the id of what rank r makes is made[r]
        self.size = max(ids.values()) + 1
        self.ranks = {ids[a] * self.size + ids[b]: r for (a, b), r in vocabulary.ranks.items()}
        self.made = [0] * len(vocabulary.ranks)
        for (a, b), r in vocabulary.ranks.items():
            self.made[r] = ids[a + b]
        self.arrays = None

    def __call__(self, word: str) -> tuple[int, ...]:
        data = word.encode("utf-8", "replace")
        parts = [self.first[b] for b in data]
        parts[-1] = self.last[data[-1]]
        return tuple(self.short(parts) if len(parts) <= 256 else self.long(parts))

    def short(self, parts: list[int]) -> list[int]:
        """Lowest rank first, leftmost of equals; ranks of neighbours kept in a list."""
        get, none, size, made = self.ranks.get, len(self.made), self.size, self.made
        ranks = [get(a * size + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            k = ranks.index(best)
            new = parts[k] = made[best]
            del parts[k + 1], ranks[k]
            if k < len(ranks):
                ranks[k] = get(new * size + parts[k + 1], none)
            if k:
                ranks[k - 1] = get(parts[k - 1] * size + new, none)
        return parts

    def long(self, parts: list[int]) -> list[int]:
        """The same with a heap of pairs and linked neighbours, for words of any length."""
        get, n, size = self.ranks.get, len(parts), self.size
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, p) for k, p in enumerate([a * size + b for a, b in zip(parts, parts[1:])]) if (r := get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k, pair = heapq.heappop(heap)
            j = after[k] if parts[k] is not None else n
            if j >= n or parts[k] * size + parts[j] != pair:
                continue
            parts[k], parts[j] = self.made[rank], None
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
            for x in (before[k], k):
                if x >= 0 and after[x] < n and (r := get(p := parts[x] * size + parts[after[x]])) is not None:
                    heapq.heappush(heap, (r, x, p))
        return [p for p in parts if p is not None]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs of ids, the number of merges where there is none."""
        pairs, ranks, *_ = self.arrays
        wanted = a * self.size + b
        at = np.searchsorted(pairs, wanted)
        return np.where(pairs[at] == wanted, ranks[at], len(self.made))

    def together(self, words: list[bytes]) -> list[list[int]]:
        """The same for many words at once: in a round each word's lowest pair, leftmost of equals, becomes one part."""
        if not words:
            return []
        if self.arrays is None:
            pairs = np.array([*self.ranks, np.iinfo("i8").max], "i8")  # the last pair is in no word
            order = np.argsort(pairs)
            ranks = np.array([*self.ranks.values(), len(self.made)], "i8")[order]
            self.arrays = pairs[order], ranks, np.array(self.made, "i8"), np.array(self.first, "i8"), np.array(self.last, "i8")
        _, _, made, first, last = self.arrays
        none, count = len(self.made), len(words)
        data = np.frombuffer(b"".join(words), "u1")
        word, lengths = np.arange(count), np.fromiter(map(len, words), "i8", count)
        ends = np.cumsum(lengths) - 1
        parts, ranks = first[data], np.full(len(data), none)
        parts[ends] = last[data[ends]]
        ranks[:-1] = self.rank(parts[:-1], parts[1:])
        ranks[ends] = none  # a part's rank is that of it and the next one of its word
        done = []
        while True:
            best = np.minimum.reduceat(ranks, ends + 1 - lengths)
            if (ready := best == none).any():
                mine = np.repeat(ready, lengths)
                done.append((word[ready], lengths[ready], parts[mine]))
                word, lengths, best, parts, ranks = word[~ready], lengths[~ready], best[~ready], parts[~mine], ranks[~mine]
                if not len(word):
                    break
                ends = np.cumsum(lengths) - 1
            at = np.flatnonzero(ranks == np.repeat(best, lengths))
            at = at[np.searchsorted(at, ends + 1 - lengths)]
            parts[at] = made[best]
            inner, begun = at + 1 < ends, at > ends + 1 - lengths
            ranks[at] = none
            ranks[at[inner]] = self.rank(parts[at[inner]], parts[at[inner] + 2])
            ranks[at[begun] - 1] = self.rank(parts[at[begun] - 1], parts[at[begun]])
            keep = np.ones(len(parts), bool)
            keep[at + 1] = False
            parts, ranks, lengths = parts[keep], ranks[keep], lengths - 1
            ends = np.cumsum(lengths) - 1
        out: list = [None] * count
        for owners, sizes, ids in done:
            flat, stop = ids.tolist(), 0
            for k, n in zip(owners.tolist(), sizes.tolist()):
                out[k] = flat[stop : stop + n]
                stop += n
        return out


def compile_lexicon(entries: dict[str, tuple[int, ...]]) -> bytes:
    """The minimal acyclic transducer of the words, as one block of bytes.

    Words are added in byte order; a state is looked up in the register of
    finished states (by finality and edges) as soon as no later word can change
    it.  Every edge carries the number of words that sort before it from its
    state on, so the sum over a path is the word's rank.
    """
    words = sorted((w.encode(), ids) for w, ids in entries.items())
    edges: list[list[tuple[int, int]]] = []  # of finished states: (byte, target), in byte order
    final: list[bool] = []
    size: list[int] = []
    register: dict[tuple, int] = {}

    def finish(is_final: bool, out: list[tuple[int, int]]) -> int:
        key = (is_final, *out)
        if key not in register:
            register[key] = len(edges)
            edges.append(out)
            final.append(is_final)
            size.append(is_final + sum(size[t] for _, t in out))
        return register[key]

    path: list[list] = [[False, []]]  # states of the last word, not finished: finality, finished edges
    last = b""
    for word, _ in words:
        same = next((k for k, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        for k in range(len(last), same, -1):
            state = path.pop()
            path[-1][1].append((last[k - 1], finish(*state)))
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        last = word
    for k in range(len(last), 0, -1):
        state = path.pop()
        path[-1][1].append((last[k - 1], finish(*state)))
    root = finish(*path[0])
    # flat arrays: first edge of each state, finality, and per edge its byte, target and words before
    first = np.cumsum([0] + [len(e) for e in edges]).astype("<u4")
    label, target, before = [], [], []
    for k, out in enumerate(edges):
        count = int(final[k])
        for b, t in out:
            label.append(b)
            target.append(t)
            before.append(count)
            count += size[t]
    starts = np.cumsum([0] + [len(ids) for _, ids in words]).astype("<u4")
    flat = np.array([i for _, ids in words for i in ids], "<u4")
    blocks = [np.array([root], "<u4"), first, np.array(final, "u1"), np.array(label, "u1"), np.array(target, "<u4"), np.array(before, "<u4"), starts, flat]
    head = json.dumps([[b.dtype.str, len(b)] for b in blocks]).encode()
    return len(head).to_bytes(4, "little") + head + b"".join(b.tobytes() for b in blocks)


class Lexicon:
    """Reads a compiled lexicon, mapped into memory from an unlinked temporary file."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(data)
            f.flush()
            self.file = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self.file)
        size = int.from_bytes(view[:4], "little")
        at, blocks, places = 4 + size, [], []
        for kind, n in json.loads(bytes(view[4 : 4 + size])):
            width = np.dtype(kind).itemsize
            blocks.append(view[at : at + n * width].cast("I" if width == 4 else "B"))
            places.append(at)
            at += n * width
        root, self.first, self.final, _, self.target, self.before, self.starts, self.ids = blocks
        self.root, self.labels = root[0], places[3]
        self.begun: dict[bytes, tuple[int, int] | None] = {}  # where the first bytes of words lead
        self.arrays = None

    def walk(self, state: int, rank: int, data: bytes) -> tuple[int, int] | None:
        """State and rank after ``data``, or None where no edge goes on."""
        at, first, find, before, target = self.labels, self.first, self.file.find, self.before, self.target
        for byte in map(SINGLE.__getitem__, data):
            edge = find(byte, at + first[state], at + first[state + 1]) - at
            if edge < 0:
                return None
            rank += before[edge]
            state = target[edge]
        return state, rank

    def get(self, word: str) -> tuple[int, ...] | None:
        data = word.encode("utf-8", "replace")
        head = data[:PREFIX]
        try:
            place = self.begun[head]
        except KeyError:
            place = self.walk(self.root, 0, head)
            if len(self.begun) < PREFIXES:
                self.begun[head] = place
        if place is None or (place := self.walk(*place, data[PREFIX:])) is None:
            return None
        state, rank = place
        if not self.final[state]:
            return None
        return tuple(self.ids[self.starts[rank] : self.starts[rank + 1]])

    def together(self, words: list[bytes]) -> list[list[int] | None]:
        """Ids of many words, None for those outside: all walk at once, a byte a step."""
        if self.arrays is None:
            first, label = np.asarray(self.first, "i8"), np.frombuffer(self.file, "u1", len(self.target), self.labels)
            # edges are in the order of their state and byte; the last one leads from no state
            edges = np.append(np.repeat(np.arange(len(first) - 1), np.diff(first)) * 256 + label, np.iinfo("i8").max)
            self.arrays = edges, np.asarray(self.target), np.asarray(self.before), np.asarray(self.final, bool)
        edges, target, before, final = self.arrays
        count = len(words)
        data, lengths = np.frombuffer(b"".join(words), "u1"), np.fromiter(map(len, words), "i8", count)
        starts = np.cumsum(lengths) - lengths
        place, rank = np.full(count, -1), np.zeros(count, "i8")  # ranks of words that are in
        word, state, step = np.arange(count), np.full(count, self.root, "i8"), 0
        while len(word):
            over = lengths[word] == step
            ended = word[over & final[state]]
            place[ended] = rank[ended]
            word, state = word[~over], state[~over]
            wanted = state * 256 + data[starts[word] + step]
            edge = np.searchsorted(edges, wanted)
            there = edges[edge] == wanted
            word, edge = word[there], edge[there]
            rank[word] += before[edge]
            state = target[edge].astype("i8")
            step += 1
        return [self.ids[self.starts[r] : self.starts[r + 1]].tolist() if r >= 0 else None for r in place.tolist()]


class Splitter:
    """Cuts texts as the tokenizer file's steps before the merges do.

    No word crosses white space, so a text is cut there first (``chunks``) and
    what a chunk holds can be remembered by chunk (``words``).  Special tokens
    are chunks of their own, told from others by a space in front.
    """

    #: str.split() also cuts at these, which are not white space to the file's pattern.
    CONTROLS = regex.compile("[\x1c-\x1f]")
    SPACE = regex.compile(r"\s+")

    def __init__(self, vocabulary: Vocabulary):
        self.pattern = regex.compile(vocabulary.pattern)
        self.letters = r"[\p{L}]+" in vocabulary.pattern  # a chunk of letters is one word
        self.special = vocabulary.special
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def plain(self, text: str) -> list[str]:
        text = text.lower() if text.isascii() else lower(unicodedata.normalize("NFC", text))
        if self.CONTROLS.search(text):
            return [c for c in self.SPACE.split(text) if c]
        return text.split()

    def chunks(self, text: str) -> list[str]:
        if self.marks is None or not any(s in text for s in self.special):
            return self.plain(text)
        out = []
        for part in self.marks.split(text):
            out += [" " + part] if part in self.special else self.plain(part)
        return out

    def is_word(self, chunk: str) -> bool:
        """Whether it is plain that the chunk is one word."""
        return chunk[0] == " " or (self.letters and chunk.isalpha())

    def words(self, chunk: str) -> list[str]:
        return [chunk] if self.is_word(chunk) else self.pattern.findall(chunk)


def lower(text: str) -> str:
    """Lower case character by character: a final capital sigma is no special case."""
    return text.lower() if "Σ" not in text else "σ".join(p.lower() for p in text.split("Σ"))


def word_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, n) over the whole texts of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.parts())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, found = Splitter(Vocabulary(*shared.value)), Counter()

        def rows():
            words = Counter()
            for chunk, n in found.items():
                for w in split.words(chunk):
                    words[w] += n
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    found.update(split.chunks(text))
                    if len(found) > MEMO:
                        yield rows()
        if found:
            yield rows()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, lexicon_size: int = 131_072, longest: int = 64) -> bytes:
    """Compiled lexicon of the corpus' most frequent words, of ``longest`` characters at most.

    Words are taken from a count on that at most ``lexicon_size`` words reach: the
    cut is read off a histogram of counts (a row for each sixteenth of a power of
    two), so what reaches the driver is bounded whatever the corpus.
    """
    counts, path = scratch_table(word_counts(docs, vocabulary).filter(F.length("word") <= longest), "bpe-words")
    step = F.floor(F.log2("n") * 16).cast("int")
    seen, cut = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        seen += r["count"]
        if seen > lexicon_size:
            break
        cut = r["step"]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.parts())

    @F.pandas_udf("array<int>")
    def merged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merge = Merger(Vocabulary(*shared.value))
        for batch in batches:
            yield pd.Series([merge(w) for w in batch], index=batch.index, dtype=object)

    if cut is None:
        return compile_lexicon({})
    top = counts.filter((step >= cut) & ~F.col("word").startswith(" ")).select("word", merged("word").alias("ids")).toArrow()
    drop_scratch(docs.sparkSession, path)
    return compile_lexicon({w.as_py(): tuple(ids.as_py()) for w, ids in zip(top["word"], top["ids"])})


class Memo(dict):
    """Values made once per key."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


class Encoder:
    """Ids of texts; remembers up to ``memo`` chunks and as many words."""

    def __init__(self, vocabulary: Vocabulary, lexicon: bytes, memo: int = MEMO):
        self.memo = memo
        self.split, self.merge, self.lexicon = Splitter(vocabulary), Merger(vocabulary), Lexicon(lexicon)
        self.special, self.known, self.of_words = vocabulary.special, None, {}

    def ids_of_chunk(self, chunk: str) -> tuple[int, ...]:
        out, of_words = (), self.of_words
        for word in self.split.words(chunk):
            ids = of_words.get(word)
            if ids is None:
                if word[0] == " ":
                    ids = (self.special[word[1:]],)
                elif (ids := self.lexicon.get(word)) is None:
                    ids = self.merge(word)
                if len(of_words) >= self.memo:
                    of_words.clear()
                of_words[word] = ids
            out += ids
        return out

    def chunks(self, text: str | None, make) -> list:
        """``make(ids)`` of every chunk that has ids, remembered by chunk; ``make`` is the same in all calls."""
        if not text:
            return []
        if self.known is None or len(self.known) > self.memo:
            self.known = Memo(lambda c: make(ids) if (ids := self.ids_of_chunk(c)) else None)
        return [x for x in map(self.known.__getitem__, self.split.chunks(text)) if x is not None]


class Decoder:
    """Text of ids, as the file's (absent) decoder gives it: the tokens' strings, one space between."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens = {i: t for t, i in (*vocabulary.ids.items(), *vocabulary.special.items())}

    def __call__(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


def encode(docs: DataFrame, vocabulary: Vocabulary, lexicon: bytes) -> DataFrame:
    """``docs`` with the column ids: array of the whole text's token ids."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.parts(), lexicon))

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        parts, data = shared.value
        encoder = Encoder(Vocabulary(*parts), data)
        for batch in batches:
            yield pd.Series([[i for w in encoder.chunks(t, tuple) for i in w] for t in batch], index=batch.index, dtype=object)

    return docs.withColumn("ids", ids(F.col("text")))


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encoded`` with the column decoded, read back from ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.parts())

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(Vocabulary(*shared.value))
        for batch in batches:
            yield pd.Series([decoder(ids) for ids in batch], index=batch.index, dtype=object)

    return encoded.withColumn("decoded", text(F.col("ids")))


class RoundTrip:
    """Ids and decoded text of whole texts; remembers ``memo`` chunks and as many words, and what a block of texts adds.

    A token is remembered as its id and its text in one string, a space before
    each, the id in bytes that UTF-8 never has (``MARKS``).  So a text's chunks
    are looked up and joined once, and both halves are read from the result.
    """

    def __init__(self, vocabulary: Vocabulary, lexicon: bytes, memo: int = ROUND_TRIP_MEMO):
        decode = Decoder(vocabulary)
        self.memo, self.special = memo, vocabulary.special
        self.split, self.merge, self.lexicon = Splitter(vocabulary), Merger(vocabulary), Lexicon(lexicon)
        self.tokens = Memo(lambda i: f" {i}".encode().translate(TO_MARKS) + f" {decode([i])}".encode())
        self.known: dict[str, bytes] = {}
        self.of_words: dict[str, bytes] = {}

    def ids_of_words(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) of every word, in any order."""
        data = [w.encode("utf-8", "replace") for w in words]
        others = []
        for word, d, ids in zip(words, data, self.lexicon.together(data)):
            if ids is not None:
                yield word, ids
            elif word[0] == " ":
                yield word, [self.special[word[1:]]]
            elif len(d) > TOGETHER:
                yield word, self.merge(word)
            else:
                others.append((word, d))
        yield from zip([w for w, _ in others], self.merge.together([d for _, d in others]))

    def learn(self, chunks: set[str]) -> None:
        """Remember those of ``chunks`` that are not known yet."""
        new, of_words, token = chunks.difference(self.known), self.of_words, self.tokens.__getitem__
        whole = [c for c in new if self.split.is_word(c)]
        cut = [(c, self.split.pattern.findall(c)) for c in new.difference(whole)]
        words = set(whole).union(chain.from_iterable([ws for _, ws in cut])).difference(of_words)
        of_words.update((w, b"".join(map(token, ids))) for w, ids in self.ids_of_words(list(words)))
        self.known.update(zip(whole, map(of_words.__getitem__, whole)))
        self.known.update((c, b"".join(map(of_words.__getitem__, ws))) for c, ws in cut)

    def __call__(self, texts: list[str]) -> Iterator[tuple[int, bytes, bytes]]:
        """(number of ids, ids, decoded) of every text, in order; new words of all the texts are encoded together."""
        for memory in (self.known, self.of_words):
            if len(memory) > self.memo:
                memory.clear()
        cut = list(map(self.split.chunks, texts))
        self.learn(set(chain.from_iterable(cut)))
        for chunks in cut:
            both = b"".join(map(self.known.__getitem__, chunks))
            ids = both.translate(FROM_MARKS, IN_UTF8)
            yield ids.count(b" "), ids[1:], both.translate(None, MARKS)[1:]


def in_blocks(texts: list[str | None], size: int = BLOCK) -> Iterator[list[str]]:
    """The texts in order, null as empty, in lists that end with the text that brings them to ``size`` characters."""
    block, n = [], 0
    for text in texts:
        block.append(text or "")
        n += len(block[-1])
        if n >= size:
            yield block
            block, n = [], 0
    if block:
        yield block


def round_trip_digests(docs: DataFrame, vocabulary: Vocabulary, lexicon: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass, a block of texts at a time, nothing kept whole but the digests."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.parts(), lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, data = shared.value
        encode = RoundTrip(Vocabulary(*parts), data)
        for batch in batches:
            out = []
            for block in in_blocks(batch.column(1).to_pylist()):
                out += [(n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()) for n, ids, back in encode(block)]
            cols = [pa.array(c) for c in zip(*out)] if out else [pa.array([], pa.int64()), pa.array([], pa.string()), pa.array([], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
