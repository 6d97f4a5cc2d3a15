import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from clickpipe.llm import divergence_trees as trees

SMALL = "/root/testdata/sf0.001"


def plain(rows):
    """The contract by loops, on (lang, source, text)."""
    docs = [(x or "", s or "", [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]) for x, s, t in rows]
    in_docs, counts, whole = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        in_docs.update((lang, w) for w in set(words))
        counts[lang, source].update(words)
        whole[lang].update(words)
    out = []
    for lang, source in counts:
        kept = [w for w in whole[lang] if in_docs[lang, w] >= 10]

        def share(c, w, kept=kept):
            return 1 + 1_000_000_000 * (c[w] + 2) // (sum(c[x] for x in kept) + 2 * len(kept))

        def gap(a, b, w):
            p, q = share(a, w), share(b, w)
            return (p - q) ** 2 // (p + q), p > q

        mine = counts[lang, source]
        pair = sorted((-sum(gap(mine, counts[x], w)[0] for w in kept), x[1]) for x in counts if x[0] == lang and x[1] != source)
        term = sorted((-gap(mine, whole[lang], w)[0], w.encode()) for w in kept if mine[w] and gap(mine, whole[lang], w)[1])[:10]
        out += [(lang, source, "pair", s, -v, i) for i, (v, s) in enumerate(pair, 1)]
        out += [(lang, source, "term", w.decode(), -v, i) for i, (v, w) in enumerate(term, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def odd_rows():
    rnd = random.Random(2)
    words = ["the", "The", "été", "ÉTÉ", "a1b", "x_y", "naïve", "zz", "语言", "q", "Q@q"]
    rows = [("en", f"s{rnd.randint(0, 40)}", " ".join(rnd.choices(words, k=rnd.randint(0, 30)))) for _ in range(300)]
    rows += [("fr", "s1", "rare words only"), ("fr", "s2", ""), ("fr", None, None), (None, None, "null lang"), ("de", "one", "allein " * 5)]
    rows += [("it", f"s{i}", "ciao mondo") for i in range(3) for _ in range(4)] + [("it", "s3", "")] + [("en", "s1", "long " * 400_000)]
    return rows


def test_equals_loops(shared, odd_rows, monkeypatch):
    docs = shared.createDataFrame([(*r, "x", 1) for r in odd_rows], "lang string, source string, text string, term string, n int")
    got = sorted(map(tuple, trees.divergence(docs).collect()))
    assert got == plain(odd_rows)


def test_small_segments_and_blocks(shared, odd_rows, monkeypatch):
    monkeypatch.setattr(trees, "SEGMENT", 3)
    monkeypatch.setattr(trees, "BLOCK", 4)
    docs = shared.createDataFrame(odd_rows, "lang string, source string, text string")
    assert sorted(map(tuple, trees.divergence(docs).collect())) == plain(odd_rows)


def test_query_equals_sql(shared):
    got = sorted(map(tuple, trees.op11_source_divergence(shared, SMALL).select("lang", "source", "part", "item", "value", "rank").collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    assert got == sorted(con.sql(trees.ORACLE_SQL).fetchall())


def test_equal_subtrees_are_one_node_and_priced_once():
    leaves = np.zeros((3, 1024), np.int64)
    leaves[1, 5] = leaves[2, 517] = 7
    levels, values, roots = trees.consed(leaves)
    assert list(values) == [0, 7] and len(set(roots)) == 3
    assert sum(x.shape[1] for x in levels) <= 3 * len(levels) + 3  # not 3 * 1023
    pair, u, v, times = trees.walk(levels, (roots[[0, 1]], roots[[1, 2]]))
    assert len(pair) == 5 and sorted(times.tolist()) == [1, 1, 1, 1022, 1023]


def test_wide_counts_are_exact():
    counts = np.array([0, 10**15, -1])
    total = 3 * 10**15 + 1
    assert trees.shares(counts, total, 9).tolist() == [1 + 2 * 10**9 // (total + 18), 1 + (10**15 + 2) * 10**9 // (total + 18), 0]


def test_empty_table(shared):
    assert trees.divergence(shared.createDataFrame([], "lang string, source string, text string")).collect() == []
