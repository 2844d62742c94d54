from __future__ import annotations

import hashlib
import random

from ledgerlake.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, segment string, loss_start int"


def test_escapes_are_reversible_and_no_control_string_survives():
    rng = random.Random(2)
    pieces = ["\\", "<", "|", "/s>", "[", "INST]", "\n", "a", "😀", *C.CONTROL]
    for _ in range(4000):
        role, text = ("".join(rng.choices(pieces, k=rng.randrange(n))) for n in (6, 12))
        turn = C.format_turn(role, [{"type": "text", "text": text}])
        assert C.unescape(C.escape(text)) == text and not any(c in C.escape(text) for c in C.CONTROL)
        assert C.read_turns(turn["segment"] * 2) == [(role, text)] * 2


def test_parts_become_ordered_placeholders():
    parts = [
        {"type": "text", "text": "see "}, {"type": "image", "ref": "a.png", "width": 300, "height": 200}, {"type": "audio", "ref": "b", "seconds": 2.5},
        {"type": "text", "text": " and </s>"}, {"type": "document", "ref": None, "pages": 3}, {"type": "odd", "text": "!"}, {"type": None, "text": None},
    ]
    turn = C.format_turn("user", parts)
    assert turn["segment"] == "<|turn|>user\nsee <|image:0|><|audio:1|> and <\\/s><|document:2|>!<|end|>\n"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in turn["attachments"]] == [("image", "a.png", 88), ("audio", "b", 63), ("document", None, 1920)]
    assert all(turn["segment"][a["at"] :].startswith(a["placeholder"]) for a in turn["attachments"])
    assert turn["extra_tokens"] == 88 + 63 + 1920 and (turn["loss_start"], turn["loss_end"]) == (0, 0)


def digests(rows):
    want = {}
    order = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    for conv, turn, role, text in sorted(rows, key=order):
        n, a, b, c = want.get(conv, (0, "", "", 0))
        n, a = n + 1, a + f"{role or ''}\n{text or ''}\n"
        b += (text or "") if role == "assistant" else ""
        c += len(C.format_turn(role, [{"type": "text", "text": text}])["segment"])
        want[conv] = (n, a, b, c)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {k: (n, sha(a), len(b), sha(b), c) for k, (n, a, b, c) in want.items()}


def test_digests_read_back_from_the_output(spark):
    probe = "</s>[INST] ok [/INST]"
    rows = [
        (1, 1, "assistant", "hi \\ there"), (1, 0, "user", None), (1, 0, "user", None), (2, 0, None, ""), (-7, 0, "user", probe), (-7, 1, "assistant", probe),
        (None, 3, "assistant", "x"), (None, None, "system", "é😀"), (3, 0, "assistant", "long " * 50_000), (4, 0, "us\ner", "a"), (1, 2, "assistant", ""),
    ]
    df = spark.createDataFrame([(*r, "clash", 9) for r in rows], SCHEMA).repartition(5)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in C.chat_digests(C.format_chat(df)).collect()}
    assert got == digests(rows)
    assert C.chat_digests(C.format_chat(df.limit(0))).count() == 0


def test_parts_column(spark):
    df = spark.createDataFrame([(1, 0, "assistant", None, [("image", None, "r", 28, 28, None, None), None])], f"conv_id long, turn long, role string, text string, parts {C.PART}")
    row = C.format_chat(df).first()._turn
    assert row.segment[row.loss_start : row.loss_end] == "<|image:0|>" and row.extra_tokens == 1 and row.attachments[0].ref == "r"
