import hashlib
import random
import re

import pytest

from clickpipe.llm import pii_bootstrap as pii
from clickpipe.llm.common import read_table

SMALL = "/root/testdata/sf0.001"
# The contract's rules as they are given.
RULES = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain(text):
    out = []
    for kind, rule in RULES:
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                  "card": 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def texts_of(spans):
    return [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans)]


def test_base_rules_equal_the_plain_ones():
    rnd = random.Random(5)
    pieces = ["a", "b.c", "@", ".", "-", "1", "25", "256", "0001", " ", "(", ")", "+", "4111 1111 1111 1111", "+1 (743) 555-3824", "é", "x@y.z", "\n", "1.2.3.4", "%"]
    for _ in range(4000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25)))
        assert texts_of(pii.base_spans(text)[0]) == plain(text), text


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "a." * 150_000, "1." * 150_000, "+1" * 100_000, "@a" * 100_000, "1 " * 100_000, "a@b." * 80_000):
        pii.contexts(text)


def test_query_equals_the_plain_rules(shared):
    docs = {r.doc_id: r.text for r in read_table(shared, SMALL, "documents", "doc_id", "text").collect()}
    rows = pii.op13_pii_bootstrap(shared, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = plain(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k + ":") for b in base) for k in pii.KINDS]
        assert set(base) <= set(r.spans.split(",") if r.spans else [])


def graph_by_hand(texts):
    """Trust of open instances by plain loops over the same contexts."""
    edges, other = {}, {}
    for t in set(texts):
        _, found, background = pii.contexts(t)
        for _, _, inst, kind, state, pats in found:
            for p in pats:
                old = edges.get((p, kind, inst))
                edges[p, kind, inst] = state if old is None else -1 if -1 in (old, state) else max(old, state)
        for p in background:
            other[p] = other.get(p, 0) + 1
    trust = {}
    for _ in range(pii.ROUNDS):
        confidence = {}
        for p, k in {(p, k) for p, k, _ in edges}:
            members = [(i, s) for (q, l, i), s in edges.items() if (q, l) == (p, k)]
            total = sum(1 if s == 1 else 0 if s == -1 else trust.get((i, k), 0) for i, s in members)
            if total >= pii.SUPPORT and (c := total / (len(members) + other.get(p, 0) + 1)) * pii.ONE >= pii.PATTERN_MIN:
                confidence[p, k] = c
        doubt = {}
        for (p, k, i), s in edges.items():
            if s == 0 and (p, k) in confidence:
                doubt[i, k] = doubt.get((i, k), 1) * (1 - confidence[p, k])
        trust = {x: 1 - d for x, d in doubt.items()}
    return trust


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(3)
    words = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 4))) for _ in range(n))
    rows = []
    for i in range(12):
        rows.append(f"{words(20)} reach me under +1 (743) 555-38{i:02} any time {words(20)}")
    rows += [f"{words(20)} reach me under 743 555 9901 any time {words(20)}", f"{words(9)} contact: user{7}@localhost {words(9)}"]
    rows += [f"{words(9)} contact: user{i}@mail.example.com {words(9)}" for i in range(9)]
    rows += [f"{words(9)} 743 555 9902 {words(9)}", f"{words(9)} reach me under the any time table {words(9)}"]
    rows += [rows[3]] * 40 + ["part 7435559903 of the list"] * 60
    return rows


def test_unseen_identifiers_in_trusted_contexts(shared, planted):
    docs = shared.createDataFrame([(i, t, "x", "y") for i, t in enumerate(planted)], "id long, text string, base string, _row string")
    rows = pii.find_identifiers(docs).collect()
    assert len(rows) == len(planted) and rows[0].asDict().keys() == {"id", "_row", "base", "spans"}
    added = {r.id: [planted[r.id][s.start:s.end] for s in r.spans if s not in r.base] for r in rows}
    assert added[12] == ["743 555 9901"] and added[13] == ["user7@localhost"]
    assert not any(v for k, v in added.items() if k not in (12, 13))
    by_hand = {x for x, t in graph_by_hand(planted).items() if t * pii.ONE >= pii.TRUST_MIN}
    assert by_hand == {(pii._key("phone", "743 555 9901"), 3), (pii._key("email", "user7@localhost"), 0)}


def test_defined_cases(shared):
    rows = [(1, None), (2, ""), (None, "a@b.cd"), (None, "a@b.cd"), (4, "x" * 50_000 + " 1.2.3.4"), (5, "300.1.1.1 4111 1111 1111 1112 +123")]
    found = pii.find_identifiers(shared.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, [tuple(s) for s in r.spans]) for r in found) == [
        (0, [(0, 0, 6)]), (0, [(0, 0, 6)]), (1, []), (2, []), (4, [(1, 50_001, 50_008)]), (5, [])]
    empty = shared.createDataFrame([], "doc_id long, text string")
    assert pii.find_identifiers(empty).collect() == []
