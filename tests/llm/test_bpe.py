from __future__ import annotations

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import bpe as B
from ledgerlake.llm.queries import tokenizer_path
from llm_rows import odd_rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary.load(tokenizer_path())


TEXTS = [
    "", "Hello World's don't  I'LL we'Re", "<|startoftext|>abc<|endoftext|> x <|ENDOFTEXT|>", "İstanbul ẞ ΣΑΣ Σ ὈΔΥΣΣΕΎΣ",
    "a\x00b\x1c\x1d\x85 \xa0 z", "ſ K Å ﬁ é 힣 한글 가", "12３４ ½ ² ⅷ", "😀👩‍👩‍👧 !!!??..", "日本語テキスト ไทย", "'S 'T it'S", "tab\tnew\nline\r\n",
    "x" * 3000 + " " + "ab" * 500, "é café", "a_b-c.d,e;f",
]


def test_ids_and_decoding_equal_the_library(library, vocabulary):
    merge = B.Merger(vocabulary)
    lexicon = B.compile_lexicon({w: merge(w) for w in ("the", "hello", "world", "größe", "don", "x")})
    encoder, decoder = B.Encoder(vocabulary, lexicon), B.Decoder(vocabulary)
    for text in TEXTS:
        want = library.encode(text, add_special_tokens=False).ids
        got = [i for ids in encoder.chunks(text, tuple) for i in ids]
        assert got == want, text
        assert decoder(got) == library.decode(want, skip_special_tokens=False)


def test_short_and_long_merging_agree(vocabulary):
    merge, rng = B.Merger(vocabulary), random.Random(4)
    for _ in range(200):
        parts = [merge.first[b] for b in "".join(rng.choices("theandingéß", k=rng.randint(1, 40))).encode()]
        parts[-1] = merge.last[merge.first.index(parts[-1])]
        assert merge.short(list(parts)) == merge.long(list(parts))


def test_words_merged_together_are_merged_alike(vocabulary):
    merge, rng = B.Merger(vocabulary), random.Random(5)
    words = ["".join(rng.choices("theandingéß日😀'!12", k=rng.randint(1, 24))) for _ in range(3000)] + ["a", "aaaaaaa", "é", "a"]
    assert merge.together([w.encode() for w in words]) == [list(merge(w)) for w in words]
    assert merge.together([]) == []


def test_words_walk_the_lexicon_together_as_alone(vocabulary):
    merge, rng = B.Merger(vocabulary), random.Random(6)
    entries = {w: merge(w) for w in {"".join(rng.choices("abcé", k=rng.randint(1, 6))) for _ in range(500)}}
    lexicon = B.Lexicon(B.compile_lexicon(entries))
    words = [*entries, *(w + "q" for w in entries), "abcabcabcabc", "z", "日本"]
    want = [lexicon.get(w) for w in words]
    assert [ids and tuple(ids) for ids in lexicon.together([w.encode() for w in words])] == want
    empty = B.Lexicon(B.compile_lexicon({}))
    assert empty.together([b"a", b"bc"]) == [None, None] and empty.together([]) == lexicon.together([]) == []


@pytest.mark.parametrize(("memo", "size"), [(B.ROUND_TRIP_MEMO, B.BLOCK), (3, 40), (0, 1)])
def test_round_trip_equals_the_library_whatever_is_remembered(library, vocabulary, memo, size):
    merge = B.Merger(vocabulary)
    lexicon = B.compile_lexicon({w: merge(w) for w in ("the", "hello", "world", "größe", "don", "x")})
    encode, texts = B.RoundTrip(vocabulary, lexicon, memo), [None, *TEXTS, *TEXTS[::-1], "0 12 \U0010ffff\xc0\xff 7"]
    got = [r for block in B.in_blocks(texts, size) for r in encode(block)]
    want = []
    for text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((len(ids), " ".join(map(str, ids)).encode(), library.decode(ids, skip_special_tokens=False).encode()))
    assert got == want


def test_new_words_of_a_block_are_encoded_in_one_call_and_once(vocabulary):
    encode, calls = B.RoundTrip(vocabulary, B.compile_lexicon({})), []
    one, together = encode.merge, encode.merge.together
    encode.merge.together = lambda words: calls.append(sorted(words)) or together(words)
    texts = ["storm over the hill", "over the storm, the sea", None, "sea"]
    for _ in range(2):
        assert len([r for block in B.in_blocks(texts) for r in encode(block)]) == 4
    assert encode.merge is one and calls == [sorted([b"storm", b"over", b"the", b"hill", b",", b"sea"]), []]


def test_chunks_are_made_once_within_the_memo(vocabulary):
    encoder, made = B.Encoder(vocabulary, B.compile_lexicon({}), B.ROUND_TRIP_MEMO), []
    encoder.merge = lambda word: made.append(word) or (1,)
    words = ["".join(chr(97 + k // 26**i % 26) for i in range(4)) for k in range(200_000)]
    for _ in range(2):
        for k in range(0, len(words), 1000):
            assert len(encoder.chunks(" ".join(words[k : k + 1000]), tuple)) == 1000
    assert len(made) == len(words)


def test_lexicon_is_minimal_and_exact():
    rng = random.Random(1)
    words = {"".join(rng.choices("abc", k=rng.randint(1, 7))) + rng.choice(["", "ing", "ed", "é"]) for _ in range(600)}
    entries = {w: tuple(range(k, k + k % 4 + 1)) for k, w in enumerate(sorted(words))}
    lexicon = B.Lexicon(B.compile_lexicon(entries))
    assert all(lexicon.get(w) == ids for w, ids in entries.items())
    assert all(lexicon.get(w + "q") is None for w in entries) and lexicon.get("") is None
    # minimal: no two states accept the same suffixes
    n = len(lexicon.final)
    after: dict = {}
    for s in range(n):  # targets are finished before their sources
        edges = range(lexicon.first[s], lexicon.first[s + 1])
        after[s] = (lexicon.final[s], tuple((lexicon.file[lexicon.labels + e], after[lexicon.target[e]]) for e in edges))
    assert len(set(after.values())) == n
    assert B.Lexicon(B.compile_lexicon({})).get("a") is None


def test_query_round_trip_on_odd_rows(spark, docs_of, library, vocabulary):
    rows = odd_rows() + list(enumerate(TEXTS, 100))
    docs = docs_of(rows)
    for size in (3, 1000):
        got = B.round_trip_digests(docs, vocabulary, B.build_lexicon(docs, vocabulary, lexicon_size=size)).collect()
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want = []
        for i, t in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_encode_and_decode_columns(spark, docs_of, library, vocabulary):
    docs = docs_of([(1, "Hello there"), (2, None)])
    out = B.decode(B.encode(docs, vocabulary, B.build_lexicon(docs, vocabulary)), vocabulary)
    rows = {r.doc_id: r for r in out.collect()}
    assert list(rows[1].ids) == library.encode("Hello there", add_special_tokens=False).ids and rows[1].decoded == "hello</w> there</w>"
    assert list(rows[2].ids) == [] and rows[2].decoded == ""
    assert B.build_lexicon(docs.limit(0), vocabulary)
