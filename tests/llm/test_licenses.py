from __future__ import annotations

import random
import re

import pytest

from ledgerlake.llm import licenses as L
from llm_rows import odd_rows


@pytest.mark.parametrize(
    ("text", "normal", "labels", "level"),
    [
        ("MIT", "MIT", ["mit"], 0),
        ("Apache-2.0 OR GPL-2.0-or-later", "Apache-2.0 OR GPL-2.0-or-later", ["apache", "gpl"], 0),
        ("MIT and GPL-2.0+ or BSD-3-Clause", "MIT AND GPL-2.0+ OR BSD-3-Clause", ["mit", "gpl", "bsd"], 0),
        ("MIT AND (GPL-2.0-only OR AGPL-3.0-only)", "MIT AND (GPL-2.0-only OR AGPL-3.0-only)", ["mit", "gpl", "agpl"], 2),
        ("((MIT OR ISC))", "MIT OR ISC", ["mit", "isc"], 0),
        ("GPL-2.0-only WITH Classpath-exception-2.0 AND MPL-2.0", "GPL-2.0-only WITH Classpath-exception-2.0 AND MPL-2.0", ["gpl", "mpl"], 1),
        ("GPL-3.0-only AND (AGPL-3.0-only OR LGPL-2.1+) WITH x", "GPL-3.0-only AND (AGPL-3.0-only OR LGPL-2.1+)", ["gpl", "agpl", "lgpl"], 2),
        ("CC-BY-NC-SA-4.0", "CC-BY-NC-SA-4.0", ["cc-by-nc-sa"], 3),
        ("LicenseRef-own OR 0BSD", "LicenseRef-own OR 0BSD", ["licenseref", "bsd"], 0),
        ("MIT and then some prose", "MIT", ["mit"], 0),
        ("MIT OR (GPL-2.0-only AND", "MIT", ["mit"], 0),
        ("MIT ISC", "MIT", ["mit"], 0),
        ("MIT) AND ISC", "MIT", ["mit"], 0),
    ],
)
def test_expressions(text, normal, labels, level):
    assert L.evaluate(L.postfix(text)) == (normal, labels, level)


def test_what_is_no_expression():
    for text in ("", "(", "AND MIT", "(MIT", "mit-based", "the license", "WITH Classpath-exception-2.0", "gplish OR MIT"):
        assert L.postfix(text) == [], text


def test_normal_forms_read_back_as_they_were():
    rng = random.Random(2)

    def tree(depth):
        if not depth or rng.random() < 0.3:
            leaf = rng.choice(["MIT", "GPL-2.0+", "AGPL-3.0-only", "LGPL-2.1-only", "Apache-2.0"])
            return f"{leaf} WITH LLVM-exception" if rng.random() < 0.2 else leaf
        return f"({tree(depth - 1)} {rng.choice(['AND', 'OR', 'and'])} {tree(depth - 1)})"

    def level(text):  # Python's own operators in the place of the parser
        for name, n in (("AGPL-3.0-only", 3), ("LGPL-2.1-only", 1), ("GPL-2.0+", 2), ("Apache-2.0", 0), ("MIT", 0)):
            text = text.replace(f"{name} WITH LLVM-exception", f"N({max(n - 1, 0)})").replace(name, f"N({n})")
        return eval(text.replace("AND", "|").replace("and", "|").replace("OR", "&"), {"N": lambda n: (1 << n) - 1})  # levels as masks: or is max, and is min

    for _ in range(200):
        text = tree(4)
        normal, labels, got = L.evaluate(L.postfix(text))
        assert (1 << got) - 1 == level(text), text
        assert L.evaluate(L.postfix(normal)) == (normal, labels, got)


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = {"base": [], "name": [], "notice": []}
    for kind, phrases in (("base", L.BASE), ("name", L.NAMES), ("notice", L.NOTICES)):
        for phrase, label in phrases.items():
            p = phrase.split()
            found[kind] += [(k, label, kind) for k in range(len(words)) if words[k : k + len(p)] == p]
    return len(words), found


def test_places_equal_comparison_of_words(docs_of):
    rng = random.Random(6)
    pool = [w for p in (*L.BASE, *L.NAMES, *L.NOTICES) for w in p.split()] + ["x", "GNU", "é", "-"]
    rows = [r for r in odd_rows() if not r[1] or len(r[1]) < 1_000]
    rows += [(100 + k, "".join(w + rng.choice([" ", "\n", "-", ", ", "—", "\x00"]) for w in rng.choices(pool, k=rng.randint(0, 60)))) for k in range(60)]
    phrases = [*L.BASE, *L.NAMES, *L.NOTICES, *L.GRANTS]
    rows += [(200 + k, " ".join(rng.choice([str.upper, str])(rng.choice(phrases)) for _ in range(12))) for k in range(60)]
    rows += [(300, "cc by " * 5_000), (301, "CC BY-NC 4.0 cc\nby-sa"), (302, odd_rows()[4][1] + " MIT license")]
    got = L.license_digest(L.scan_licenses(docs_of(rows))).collect()
    want = []
    for i, t in rows:
        n, found = brute(t)
        at = [k for k, _, _ in found["base"]]
        base = ",".join(sorted({label for _, label, _ in found["base"]}))
        every = ",".join(sorted({label for f in found.values() for _, label, _ in f}))
        want.append((i, n, len(at), min(at, default=None), max(at, default=None), base, every))
    assert sorted([tuple(g)[:7] for g in got], key=repr) == sorted(want, key=repr)
    assert all(0 <= g.score <= 1 and (g.score > 0) == (g.labels != "") for g in got)


def test_tags_and_score(docs_of):
    rows = [
        (1, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\nint x;"), (2, '{"license": "GPL-2.0-or-later", "x": 1}'),
        (3, "the license: read it"), (4, "/* SPDX-License-Identifier: MIT */ and license = ISC"), (5, "Licensed under the MIT License."), (6, "we like the MIT license"),
        (7, "SPDX-License-Identifier:\nMIT"), (8, "a clean text about gardens"),
    ]
    scanned = {r.doc_id: r for r in L.scan_licenses(docs_of(rows)).collect()}
    spelled = {i: [(e.word, e.expression, e.level) for e in r.expressions] for i, r in scanned.items()}
    assert spelled == {
        1: [(0, "(MIT OR Apache-2.0) AND BSD-3-Clause", 0)], 2: [(0, "GPL-2.0-or-later", 2)], 3: [], 4: [(0, "MIT", 0), (5, "ISC", 0)], 5: [], 6: [], 7: [], 8: [],
    }
    assert [round(scanned[i].score, 4) for i in range(1, 9)] == [0.95, 0.95, 0, 0.9975, 0.9, 0.6, 0, 0]
    digest = {r.doc_id: r for r in L.license_digest(L.scan_licenses(docs_of(rows))).collect()}
    assert (digest[1].labels, digest[1].base_labels, digest[4].labels, digest[8].labels) == ("apache,bsd,mit", "", "isc,mit", "")


def test_empty_table(docs_of):
    assert L.license_digest(L.scan_licenses(docs_of([(1, "x")]).limit(0))).collect() == []
