import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clickpipe.llm import bag_minhash, byte_bpe, license_scan, line_dedup, main_text, quality_qda, source_mix, suffix_dedup
from clickpipe.llm.common import whole_text
from clickpipe.llm.components import components

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.make_codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in any column, empty, very long and repeated texts, ties, and columns with clashing names."""
    rnd = random.Random(9)
    words = lambda n: " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9))) for _ in range(n))
    long = words(9000)
    page = words(60)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t\n ", None), (4, long, "b"), (4, long, "b"), (5, long + " x", "b"), (None, page, "b"), (6, page, None),
            (7, page, None), (8, "x" * 3000, "c"), (9, "!!! ??? ...", "c"), (10, "one", "c"), (11, "one", "c"), (None, None, None),
            (12, "MIT license\nApache License general public license", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in ("ids", "score", "size", "kept", "removed", "spans", "_u", "_key", "_h", "copies", "decoded"):
        df = df.withColumn(c, F.lit("clash"))
    return df.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))


# ------------------------------------------------------------------ byte-level BPE
def test_bpe_equals_tiktoken(codec):
    import tiktoken

    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(1)
    chars = [chr(i) for i in [*range(256), 0x2028, 0x3000, 0x200B, 0x1680, 0x1F600, 0x4E00, 0x660, 0xFEFF]]
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 50))) for _ in range(1500)] + ["x" * 9000 + "é" * 500, "<|endoftext|>", " a  b\n\n c "]
    for text in texts:
        ids = codec.encode(text).tolist()
        assert ids == theirs.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_perfect_hash_is_minimal(codec):
    table = codec.lookup
    assert sorted(table.values) == list(range(table.n)) and None not in table.keys
    assert all(table.get(k) == r for k, r in codec.ranks.items())
    assert table.get(b"no such token") == -1 and byte_bpe.PerfectHash({}).get(b"a") == -1


def test_bpe_query_and_edges(spark, codec, odd_docs):
    got = byte_bpe.decode(byte_bpe.encode(odd_docs, codec), codec).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert bytes(r.decoded) == (r.text or "").encode() and r.ids == codec.encode(r.text).tolist()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in byte_bpe.op5_byte_bpe(spark, SMALL).collect():
        ids = codec.encode(texts[r.doc_id]).tolist()
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert byte_bpe.encode(odd_docs.limit(0), codec).count() == 0


# ------------------------------------------------------------------ licences
def test_license_places_against_brute_force(spark, odd_docs):
    found = license_scan.Automaton(license_scan.TEMPLATES, license_scan.PHRASES)

    def brute(text):
        w = license_scan.words(text)
        return len(w), sorted((label, i) for p, label in license_scan.PHRASES.items()
                              for i in range(len(w)) if w[i:i + len(p.split())] == p.encode().split())

    rnd = random.Random(2)
    vocabulary = "mit license apache general public gnu the under Licensed x MIT released version 2 0".split()
    for _ in range(3000):
        text = " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 30)))
        n, places, _ = found.scan(text)
        assert (n, sorted(places)) == brute(text)
    rows = license_scan.scan(odd_docs.select("doc_id", "text", "spans"), found).collect()
    assert len(rows) == odd_docs.count()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in license_scan.op3_license_scan(spark, SMALL).collect():
        n, places = brute(texts[r.doc_id])
        starts = [i for _, i in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for x, _ in places})) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1


def test_matching_statistics_against_brute_force():
    found = license_scan.Automaton({"t": ("a b c a b d", "b c e a b c f")}, {})
    runs = [license_scan.words("a b c a b d"), license_scan.words("b c e a b c f")]
    inside = lambda x: any(r[i:i + len(x)] == x for r in runs for i in range(len(r)))
    for length in range(1, 7):
        for at in range(200):
            rnd = random.Random(at * 10 + length)
            run = [rnd.choice([b"a", b"b", b"c", b"d", b"e", b"f"]) for _ in range(length)]
            state = 0
            for w in run:
                state = found.step[state].get(found.vocabulary[w], None) if state is not None else None
            assert (state is not None) == inside(run)


def test_license_spans():
    found = license_scan.Automaton(license_scan.TEMPLATES, license_scan.PHRASES)
    _, _, spans = found.scan("foo Licensed under the Apache License, Version 2.0 bar. " * 2)
    assert [s[:3] for s in spans if s[0] == "apache"] == [("apache", 1, 8), ("apache", 11, 18)] and spans[0][4] == 1.0
    assert found.scan(None) == (0, [], [])


# ------------------------------------------------------------------ pages
def test_main_text():
    page = """<html><head><title>T</title><script>var a = "</p>";</script></head><body><header><h1>Site</h1></header><nav><a href=x>m</a></nav>
    <div class="cookie-notice"><p>We use cookies, many of them. Accept them all, please, now.</p></div>
    <div id="content"><h2>Title &amp; more</h2><p>One long   paragraph, with <b>words</b>, and commas.<br>It goes on, and on.</p><p>Short.<p>Open</div>
    <div class="comments"><p>I think, therefore, I comment, a lot, and at length, about it all.</p></div><aside>x</aside><footer>c</footer></body>"""
    want = "Title & more\nOne long paragraph, with words, and commas. It goes on, and on.\nShort.\nOpen"
    assert main_text.main_text(page) == want
    assert main_text.main_text(page.replace('<div id="content">', "<article>").replace("Open</div>", "Open</article>")) == want
    assert main_text.main_text(None) == main_text.main_text("") == main_text.main_text("<p></p>") == ""
    assert main_text.main_text("plain &lt;text&gt;") == "plain <text>" and main_text.main_text("<p>a<p>b<foo") == "a\nb"


def test_main_text_query(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in main_text.op7_main_text(spark, SMALL).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in blocks if x) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, "", "b"), (3, "<p>" + "w " * 200_000, "c")], "page_id long, html string, text string")
    assert sorted(len(r.text) for r in main_text.extract(odd).collect()) == [0, 0, 0, 399_999]
    assert main_text.extract(odd.limit(0)).count() == 0


# ------------------------------------------------------------------ quality
def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    found = quality_qda.op10_quality_qda(spark, d)
    assert found.count() == spark.read.parquet(f"{d}/documents.parquet").count()
    rows = found.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.97
    assert all(r.predicted for r in rows if r.quality == 1)


def test_quality_density_against_numpy(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 1, (200, 2)), rng.normal(2, 0.5, (300, 2))])
    y = [0] * 200 + [1] * 300
    df = spark.createDataFrame([(int(k), float(a), float(b)) for k, (a, b) in zip(y, x, strict=True)], "k int, a double, b double")
    model = quality_qda.fit(df, "k", ["a", "b"])
    got = np.array([r[0] for r in df.select(model.score([F.col("a"), F.col("b")])).collect()])
    dens = []
    cov = [np.cov(x[np.array(y) == k].T) for k in (0, 1)]
    pooled = (199 * cov[0] + 299 * cov[1]) / 498
    for k in (0, 1):
        s = 0.9 * (0.9 * cov[k] + 0.1 * pooled) + 0.1 * np.diag(np.diag(pooled))
        z = x - x[np.array(y) == k].mean(axis=0)
        dens.append(np.log([0.4, 0.6][k]) - 0.5 * np.log(np.linalg.det(s)) - 0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z))
    assert np.allclose(got, 1 / (1 + np.exp(dens[0] - dens[1])), atol=1e-9)
    with pytest.raises(ValueError):
        quality_qda.fit(df.filter("k = 1"), "k", ["a", "b"])


def test_quality_edges(spark, odd_docs):
    stats = quality_qda.with_statistics(odd_docs.select("doc_id", "text", "score"))
    bad = F.lit(False)
    for c in quality_qda.STATISTICS:
        bad = bad | F.col(c).isNull() | F.isnan(c)
    assert stats.filter(bad).count() == 0 and stats.count() == odd_docs.count()


# ------------------------------------------------------------------ mix
def test_mix_meets_its_targets(spark):
    rows = source_mix.op8_source_mix(spark, SMALL).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    size = {i: len(__import__("re").findall(r"[^\x20\x09-\x0D]+", r.text)) for i, r in docs.items()}
    own = Counter()
    for i, r in docs.items():
        own[r.source] += size[i]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(own))}
    total, target, open_ = 1.5 * sum(own.values()), {}, set(own)
    while open_:  # reshare what capped sources leave
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 2 * own[s]}
        target |= {s: 2.0 * own[s] for s in over} if over else share
        open_ = open_ - over if over else set()
    taken = Counter()
    for r in rows:
        s = docs[r.doc_id].source
        assert r.size == size[r.doc_id] and r.source_size == own[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    largest = {s: max(size[i] for i, r in docs.items() if r.source == s) for s in own}
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 for s in own)
    again = source_mix.op8_source_mix(spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_follows_the_keys(spark, monkeypatch):
    """The chosen documents are those of a plain sort by exponential key, but for one a source; whatever the weights."""
    rnd = random.Random(17)
    letters = lambda n, junk: " ".join("".join(rnd.choice("#*=%" if rnd.random() < junk else "abcdef") for _ in range(5)) for _ in range(n))
    rows = [(i, letters(rnd.randint(1, 30), 0.99 if i % 3 else 0.05), f"s{i % 4}" if i % 4 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    body = F.col("text")
    keyed = df.select("doc_id", "source", source_mix.word_count(body).alias("size"), source_mix.quality_weight(body).alias("w"),
                      source_mix.exponential_key(source_mix.quality_weight(body), F.col("doc_id"), body, seed=8).alias("k")).collect()
    for edge in (20_000, 7):
        monkeypatch.setattr(source_mix, "EDGE_ROWS", edge)
        got = {r.doc_id: r for r in source_mix.mix(df).collect()}
        assert min(r.w for r in keyed) < 0.15 and len(got) == 3000
        for source in {r.source for r in keyed}:
            own = sorted((r for r in keyed if r.source == source), key=lambda r: r.k)
            any_ = got[own[0].doc_id]
            left, want, total = any_.target % any_.source_size, set(), 0
            for r in own:
                total += r["size"]
                if total > left:
                    break
                want.add(r.doc_id)
            epochs = int(any_.target // any_.source_size)
            have = {r.doc_id for r in own if got[r.doc_id].copies > epochs}
            assert want <= have and len(have - want) <= 1 and all(got[r.doc_id].copies >= epochs for r in own)


def test_mix_edge_buckets_are_small(spark):
    """Two million keys of weight 0.06: the sorted bucket is bounded."""
    rows = spark.range(2_000_000).select(F.lit("a").alias("_source"), F.lit(10).cast("long").alias("size"),
                                         source_mix.exponential_key(F.lit(0.06), F.col("id"), seed=8).alias("_key"))
    rows = rows.withColumn("_at", F.floor(F.col("_key") / (1.0 + F.col("_key")) * float(1 << source_mix.KEY_BITS)).cast("long"))
    plan = spark.createDataFrame([("a", 20_000_000, 3e7, 1, 1e7)], "_source string, _source_size long, _target double, _epochs long, _left double")
    edges, level = source_mix._edges(rows, plan)
    edge = edges.first()
    inside = rows.filter(F.shiftright("_at", source_mix.KEY_BITS - level) == edge["_edge"]).count()
    before = rows.filter(F.shiftright("_at", source_mix.KEY_BITS - level) < edge["_edge"]).count()
    assert 0 < inside <= source_mix.EDGE_ROWS and edge["_before"] == 10 * before <= 1e7 < 10 * (before + inside)


def test_mix_edges(spark, odd_docs):
    out = source_mix.mix(odd_docs)
    assert out.count() == odd_docs.count()
    assert {r.doc_id: r.taken for r in out.collect()}[2] == 0
    whole = source_mix.mixed(odd_docs)
    assert whole.columns == odd_docs.columns
    assert whole.count() == out.agg(F.sum("copies")).first()[0]
    assert source_mix.mix(odd_docs.limit(0)).count() == 0


def test_exponential_keys_follow_the_weights(spark):
    """A document of weight 2 comes before one of weight 1 in two of three draws."""
    key = lambda w, i: source_mix.exponential_key(F.lit(w), F.col("id"), F.lit(i), seed=1)
    share = spark.range(20000).agg(F.avg((key(2.0, 1) < key(1.0, 2)).cast("double"))).first()[0]
    assert abs(share - 2 / 3) < 0.02


# ------------------------------------------------------------------ repeated strings
def _without(texts, length=200):
    seen = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and (not i or not gone[i - 1]))
        out.append((sum(gone), runs, bytes(x for x, y in zip(b, gone, strict=True) if not y)))
    return out


@pytest.mark.parametrize("many", [512, 2])
def test_repeated_strings_against_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(suffix_dedup, "CONTEXTS", many)  # 2: almost every anchor takes the counting way
    rnd = random.Random(5)
    noise = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    p, q = noise(700), noise(260)
    rows = [(i, noise(rnd.randint(0, 300)) + p[rnd.randint(0, 300):rnd.randint(350, 700)] + noise(50) + q[:rnd.randint(180, 260)]) for i in range(25)]
    rows += [(100, "x" * 900), (101, "y" * 150 + "x" * 300), (102, "ab" * 300), (103, ""), (104, None), (105, q + q), (106, "é" * 210),
             (107, "z" * 199), (108, "k" * 200), (109, p), (109, p), (None, p[:300])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("removed", F.lit("clash")).withColumn("_d", F.lit(1))
    got = [(r.doc_id, sum(x.end - x.first for x in r.removed), len(r.removed), bytes(r.kept)) for r in suffix_dedup.without_repeats(df).collect()]
    want = [(i, *x) for (i, _), x in zip(rows, _without([(t or "").encode() for _, t in rows]), strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0


def test_suffix_sort_is_a_sort():
    rng = np.random.default_rng(7)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1500] = data[0:500]
    s = suffix_dedup.Suffixes(data, 50)
    start = rng.permutation(2900)[:700]
    group = rng.integers(0, 5, 700)
    order = s.sort(start, group)
    text = data.tobytes()
    keys = [(group[i], text[start[i]:start[i] + 50]) for i in order]
    assert keys == sorted(keys)
    x, y = rng.integers(0, 2900, 500), rng.integers(0, 2900, 500)
    for a, b, n in zip(x, y, s.extension(x, y), strict=True):
        k = 0
        while k < 50 and data[a + k] == data[b + k]:
            k += 1
        assert n == k


# ------------------------------------------------------------------ near-duplicates
def test_union_find(spark):
    rnd = random.Random(8)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(80)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame([*edges, (5, 5), (None, 3)], "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bag_minhash_is_unbiased():
    rng = np.random.default_rng(0)
    for w1, w2 in (((1,) * 300, (1,) * 240), ((3, 5, 1, 7, 2) * 40, (2, 5, 4, 7, 1) * 40), ((100, 3), (80, 3))):
        same = []
        for _ in range(40):
            h = np.sort(rng.integers(0, 2 ** 63, max(len(w1), len(w2)), dtype=np.uint64))
            a, b = (h[:len(w1)], np.array(w1)), (h[:len(w2)], np.array(w2))
            same.append((bag_minhash.signature(*a, 180) == bag_minhash.signature(*b, 180)).mean())
        assert abs(np.mean(same) - bag_minhash.overlap(a, b)) < 0.025


def _near_copies(rnd, n):
    base = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(len(w))] = "changed" + str(rnd.random())
        out.append(" ".join(w))
    return out


def _classes(sets, alike):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(sets)), 2):
        if find(i) != find(j) and alike(sets[i], sets[j]):
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


def test_near_duplicates_against_brute_force(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(bag_minhash, "BLOCK", 16)
    rnd = random.Random(11)
    texts = _near_copies(rnd, 60) + _near_copies(rnd, 3) + ["a b c d e f g"] * 5 + ["", None, "...", "one two"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [bag_minhash.shingles(t) for t in texts]
    want = _classes(sets, lambda a, b: bag_minhash.overlap(a, b) >= 0.8)
    got = {r.doc_id: r.class_id for r in bag_minhash.with_classes(df).collect()}
    assert got == dict(enumerate(want))
    kept = sorted(r.doc_id for r in bag_minhash.keep_one(df).collect())
    assert kept == sorted(set(want))
    out = bag_minhash.keep_one(odd_docs)
    assert out.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids[4] + ids[5] == 1 and ids[6] + ids[7] + ids[None] - 1 == 1 and ids[10] + ids[11] == 1 and ids[1] == ids[2] == ids[3] == ids[9] == 1
    assert bag_minhash.keep_one(df.limit(0)).count() == 0


def test_line_dedup_against_brute_force(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    rnd = random.Random(12)
    many = _near_copies(rnd, 40) + _near_copies(rnd, 10)
    docs = [(i, "\n".join([many[i], "A common line of several words.", "short", many[(i * 7) % 50]])) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_h", F.lit("clash"))
    rows = line_dedup.lines_of(df).select("_d", "_no", "_h", "_line").collect()
    nodes = sorted({r["_h"]: frozenset(r["_line"][i:i + 5] for i in range(max(1, len(r["_line"]) - 4))) for r in rows}.items())
    root = dict(zip([h for h, _ in nodes], [nodes[i][0] for i in _classes([s for _, s in nodes], lambda a, b: len(a & b) >= 0.8 * len(a | b))], strict=True))
    got = {(r["_d"], r["_no"]): (r.class_id, r.kept) for r in line_dedup.places(df).collect()}
    first = {}
    for r in sorted(rows, key=lambda r: (r["_d"], r["_no"])):
        first.setdefault(root[r["_h"]], (r["_d"], r["_no"]))
    assert got == {(r["_d"], r["_no"]): (root[r["_h"]], first[root[r["_h"]]] == (r["_d"], r["_no"])) for r in rows}
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns
    left = {r.doc_id: r.text for r in out.collect()}
    assert left[1] is None and left[2] == "" and 7 not in left and left[9] == "!!! ??? ..." and left[10] == "one" and 11 not in left
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0
    assert all(len(r.text) == r.n_chars for r in out.filter("text IS NOT NULL").collect())


def test_line_dedup_query(spark):
    per_doc = line_dedup.op4_line_dedup(spark, SMALL)
    assert per_doc.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert per_doc.filter(F.size("dropped") != F.col("n_lines") - F.col("n_kept")).count() == 0


def test_line_dedup_numbers_repeated_rows(spark, tmp_path):
    """Equal rows are counted one by one: the first keeps what no earlier place has, the others nothing."""
    text = "A line of the first document\nab\na line of the first document"
    rows = [(1, text)] * 3 + [(2, "other words entirely, and more\nAB"), (None, "x"), (None, "x"), (4, None), (4, None), (5, " \n\t"), (5, " \n\t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_h", F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id or 0, r.n_lines, r.n_kept, [d.line_no for d in r.dropped]) for r in line_dedup.op4_line_dedup(spark, str(tmp_path)).collect())
    assert got == [(0, 1, 0, [0]), (0, 1, 1, []), (1, 3, 0, [0, 1, 2]), (1, 3, 0, [0, 1, 2]), (1, 3, 2, [2]), (2, 2, 1, [1]),
                   (4, 0, 0, []), (4, 0, 0, []), (5, 0, 0, []), (5, 0, 0, [])]
    left = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert left == Counter({(1, "A line of the first document\nab"): 1, (2, "other words entirely, and more"): 1, (None, "x"): 1, (4, None): 2, (5, " \n\t"): 2})


def test_line_dedup_short_documents_go_like_long_ones(spark):
    rows = [(1, "short line"), (2, "short line"), (3, "sixteen chars aa"), (4, "sixteen chars aa"), (5, "Short line\nnew")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.text for r in out.collect()} == {1: "short line", 3: "sixteen chars aa", 5: "new"}


def test_line_dedup_large_groups_are_shipped_about_once(spark, tmp_path, monkeypatch):
    """Buckets of one large component and strangers, and of strangers only: every pair decided, few rows."""
    from clickpipe.llm.common import saved

    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdefghij ") for _ in range(120))
    lines = [base[:i] + "x" + base[i + 1:] for i in range(0, 100)] + ["".join(rnd.choice("klmnop") for _ in range(60)) for _ in range(10)]
    lines += [lines[100] + "q", lines[101] + "q", base + "yy", base + "zz"]
    groups = [0] * 100 + list(range(100, len(lines)))
    rows = [(i, key, groups[i]) for i in range(len(lines)) for key in (1, 2)] + [(i, 3, groups[i]) for i in range(100, len(lines))]
    apart = saved(spark.createDataFrame(rows, "_h long, _key long, _c long"), "test-apart")
    texts = spark.createDataFrame(list(enumerate(lines)), "_h long, _line string")
    got = {frozenset(r) for r in line_dedup._bucket_links(apart, texts, 0.8).collect()}
    sets = [line_dedup.shingles(x) for x in lines]
    want = {frozenset((i, j)) for i in range(len(lines)) for j in range(i) if groups[i] != groups[j] and line_dedup.alike(sets[i], sets[j], 0.8)}
    assert got == want and len(want) > 100


def test_line_dedup_recall_at_the_threshold():
    """Pairs just at 0.8 share a key at least 99 times in 100, at every size of set."""
    rnd = random.Random(6)
    shared = total = 0
    for _ in range(1500):
        n = rnd.choice([30, 60, 120, 300, 900])
        base = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
        other = base + "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(round(n * 0.235)))
        a, b = line_dedup.shingles(base), line_dedup.shingles(other)
        if not 0.8 <= len(a & b) / len(a | b) < 0.83:
            continue
        x, y = line_dedup.band_keys([base, other])
        total, shared = total + 1, shared + bool(set(x) & set(y))
    assert total > 500 and shared >= 0.985 * total
    for n in range(1, 19):  # small sets: always
        for _ in range(60):
            base = "".join(rnd.choice("abcdefghij") for _ in range(n + 4))
            for other in (base + "x", "x" + base, base[1:], base[:-1]):
                a, b = line_dedup.shingles(base), line_dedup.shingles(other)
                if len(a & b) >= 0.8 * len(a | b):
                    x, y = line_dedup.band_keys([base, other])
                    assert set(x) & set(y), (base, other)


def test_whole_text_of_null(spark):
    assert spark.createDataFrame([(None,)], "text string").select(whole_text()).first()[0] == ""


def test_line_dedup_takes_short_lines(spark):
    """Exact copies go at any length; blank lines stay; near copies count from one shingle on."""
    long = "a first line that is long enough, number "
    rows = [(1, long + "one\nMenu\n\n \t\nab"), (2, long.upper() + "seventeen thousand\n menu \n\nAB\nabcdefgh"), (3, "something else entirely 12345\nabcdefghi\nab")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.text for r in out.collect()} == {1: rows[0][1], 2: long.upper() + "seventeen thousand\n\nabcdefgh", 3: "something else entirely 12345"}


def test_line_dedup_takes_every_character_window(spark):
    """Own shingles and brute force: one typo, spaceless text, and sets of every small size."""
    rnd = random.Random(21)
    draw = lambda n, a="abcdefghijklmnop qrs tuv": "".join(rnd.choice(a) for _ in range(n)).strip() or "x"
    lines = []
    for n in [*range(1, 30), *range(50, 90, 4), 150, 300, 2000]:
        base = draw(n) if n % 2 else draw(n, "的一是不了人我在有他这中大来上国𝒳")
        at = n // 2
        lines += [base, base[:at] + "Z" + base[at + 1:], base[:at] + "Q" + base[at:], base + "!"]
    lines = list(dict.fromkeys(x.lower().strip() for x in lines))
    sets = [frozenset(x[i:i + 5] for i in range(max(1, len(x) - 4))) for x in lines]
    want = _classes(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["_d"]: r.class_id for r in line_dedup.places(df).collect()}
    first = {}
    assert [first.setdefault(got[i], i) for i in range(len(lines))] == want
    assert len(set(want)) < len(lines) - 40


def test_main_text_names_are_no_verdict():
    long = "<p>One long paragraph, with words, and commas, and more. It goes on, and on, for a while.</p>" * 3
    want = "\n".join(["One long paragraph, with words, and commas, and more. It goes on, and on, for a while."] * 3)
    for name in ("content has-sidebar", "no-sidebar", "page-with-nav", "commentary", "sidebar"):
        assert main_text.main_text(f'<body><nav>m</nav><div class="{name}"><article>{long}</article></div></body>') == want
        assert main_text.main_text(f'<body><nav>m</nav><div class="{name}">{long}</div></body>') == want
    head = '<header class="entry-header"><h1>Title of it</h1></header>'
    assert main_text.main_text(f"<body><article>{head}{long}</article></body>") == f"Title of it\n{want}"
    for name in ("side-effects", "search-algorithms", "related-work", "shared-memory", "comments"):
        assert main_text.main_text(f'<body><article>{long}<h2 id="{name}">Part</h2>{long}</article></body>') == f"{want}\nPart\n{want}"


def test_main_text_ratios_decide_inside_main():
    long = "<p>One long paragraph, with words, and commas, and more. It goes on, and on, for a while, and still on.</p>" * 4
    want = "\n".join(["One long paragraph, with words, and commas, and more. It goes on, and on, for a while, and still on."] * 4)
    teasers = '<div><article class="teaser"><h3><a href="x">Other</a></h3><p>Teased.</p></article></div>' * 3
    links = "<ul>" + '<li><a href="x">Some link</a></li>' * 5 + "</ul>"
    notice = "<div><span>Signed in</span></div>"
    assert main_text.main_text(f"<body><main>{notice}<article>{long}</article>{teasers}{links}</main></body>") == want
    assert main_text.main_text(f"<body><main>{long}{links}</main></body>") == want
    assert main_text.main_text(f"<body><article><p>Tiny.</p></article><div>{long}</div></body>").endswith(want)
    assert main_text.main_text('<body><main><p>See <a href="x">this page</a>, it has more of all that, and more.</p></main></body>') == "See this page, it has more of all that, and more."


COMMENTS = ["comment-body", "post-comments", "user-comments", "reader-comments", "comment-thread", "discussion", "responses", "comments", "comment-list"]


def test_main_text_leaves_out_comments_and_teasers():
    long = "".join(f"<p>Paragraph {i} of the article, with words, and commas, and more. It goes on, and on, for a while, and still on.</p>" for i in range(6))
    want = re.sub("</?p>", "\n", long).replace("\n\n", "\n").strip()
    said = "".join(f"<p>I think, therefore, I comment, a lot, and at length, about it all, number {i}.</p>" for i in range(4))
    for name in [*COMMENTS, "cookie-message", "more-stories"]:
        for each in (f'<div class="{name}">{said}</div>', "".join(f'<div class="{name}"><p>{x}</p></div>' for x in said.replace("</p>", "").split("<p>")[1:])):
            assert main_text.main_text(f"<body><article>{long}</article>{each}</body>") == want, name
            assert main_text.main_text(f'<body><div class="story">{long}</div>{each}</body>') == want, name
    for each in (f'<div class="zzz">{said}</div>', f"<section><h3>What others say</h3>{said}</section>"):  # no name gives them away
        assert main_text.main_text(f"<body><main><article>{long}</article></main>{each}</body>") == want
    items = "".join(f'<div class="u"><span>Reader {i}</span><p>I think, therefore, I say a lot, and at length, about it all, number {i}.</p></div>' for i in range(4))
    assert main_text.main_text(f'<body><div class="story">{long}</div><div>{items}</div></body>') == want
    wp = "".join(f'<li><article class="comment-body"><p>I think, therefore, I comment, a lot, and at length, number {i}.</p></article></li>' for i in range(4))
    assert main_text.main_text(f"<body><article>{long}</article><ol>{wp}</ol></body>") == want


def test_main_text_keeps_the_article_whole():
    part = lambda i: f"<p>Paragraph {i} of the article, with words, and commas, and more. It goes on, and on, for a while, and still on.</p>"
    want = lambda n: "\n".join(re.sub("<[^>]*>", "", part(i)) for i in range(n))
    long = "".join(map(part, range(6)))
    assert main_text.main_text(f'<body><div class="post"><div class="post-header"><h1>Title</h1></div>{long}</div></body>') == "Title\n" + want(6)
    sections = "".join(f"<section><h2>Part {i}</h2>{part(i)}</section>" for i in range(5))
    assert main_text.main_text(f'<body><div id="content">{sections}</div></body>') == "\n".join(f"Part {i}\n{re.sub('<[^>]*>', '', part(i))}" for i in range(5))
    figure = "<figure><img src=x><figcaption>A picture of it, in colour.</figcaption></figure>"
    assert main_text.main_text(f"<body><article>{part(0)}{figure}{part(1)}</article></body>").split("\n")[1] == "A picture of it, in colour."
    menu = '<ul><li><a href="a">One</a></li><li><a href="b">Two</a></li></ul>'
    for tag in ("form", "fieldset", "label", "dialog"):
        assert main_text.main_text(f'<body><{tag} action="x"><nav>{menu}</nav><article>{long}</article><input><button>Go</button></{tag}></body>') == want(6)
        assert main_text.main_text(f'<body><{tag} id="aspnetForm"><div>{long}</div><button>Go</button></{tag}></body>') == want(6)
        own = f"<{tag}>Your name, your mail, and what you want to tell us, please. <button>Send</button></{tag}>"
        assert main_text.main_text(f"<body><article>{long}{own}</article></body>") == want(6)


def test_main_text_ids_make_no_paths_of_their_own():
    import time

    text = "Paragraph of the article, with words, and commas, and more. It goes on, and on, for a while, and still on."
    page = "<body><article>" + "".join(f'<p id="p{i}" class="c{i}">{text}</p>' for i in range(4000)) + "</article></body>"
    start = time.process_time()
    assert main_text.main_text(page) == "\n".join([text] * 4000)
    assert time.process_time() - start < 2
    letters = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    many = "<body><article>" + "".join(f'<div class="{letters(i)}"><p>{text}</p></div>' for i in range(4000)) + "</article></body>"
    start = time.process_time()
    assert main_text.main_text(many) == "\n".join([text] * 4000)
    assert time.process_time() - start < 6


def test_main_text_smoothing_equals_brute_force():
    import math

    rnd = random.Random(11)
    paths = list({tuple(rnd.choice("abc") for _ in range(rnd.randint(0, 9))) for _ in range(300)})
    count = [rnd.randint(1, 9) for _ in paths]
    fused = {p: rnd.random() * 100 for p in range(len(paths)) if rnd.random() < 0.9}
    got = main_text.smoothed(paths, count, fused)
    for p in fused:
        total = value = 0.0
        for q in fused:
            same = 0
            while same < min(len(paths[p]), len(paths[q])) and paths[p][same] == paths[q][same]:
                same += 1
            steps = len(paths[p]) + len(paths[q]) - 2 * same
            if steps <= main_text.REACH:
                w = math.exp(-steps ** 2 / 2) * count[q]
                total, value = total + w, value + w * fused[q]
        assert abs(got[p] - value / total) < 1e-9


@pytest.mark.parametrize("label, text", [
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
             "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
             "either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free "
            "Software Foundation; either version 2 of the License, or\n * (at your option) any later version."),
    ("gpl", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("apache", "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
               "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("mpl", "SPDX-License-Identifier: MPL-2.0"), ("bsd", "SPDX-License-Identifier: BSD-3-Clause"), ("lgpl", "// SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("mit", "# SPDX-License-Identifier: MIT"), ("apache", "SPDX-License-Identifier: Apache-2.0"), ("gpl", "SPDX-License-Identifier: GPL-2.0-only"),
])
def test_license_versions_and_tags(label, text):
    found = license_scan.Automaton(license_scan.TEMPLATES, license_scan.PHRASES).scan(f"Some words stand before it all. {text} And some more come after it.")
    assert {x[0] for x in found[2]} == {label}


def test_license_labels_need_what_sets_a_licence_apart():
    found = license_scan.Automaton(license_scan.TEMPLATES, license_scan.PHRASES)
    labels = lambda text: {x[0] for x in found.scan(text)[2]}
    for text in ("the album was released under the title of it", "Released under the GPL", "this work is licensed under a separate deal, version 3"):
        assert labels(text) == set()
    work = "This work is licensed under a Creative Commons Attribution%s 4.0 International License."
    for name, label in (("", "cc-by"), ("-NonCommercial", "cc-by-nc"), ("-ShareAlike", "cc-by-sa"), ("-NoDerivatives", "cc-by-nd"), ("-NonCommercial-NoDerivatives", "cc-by-nc-nd")):
        assert labels(work % name) == {label}
    assert labels("Licensed under CC BY-ND 4.0") == {"cc-by-nd"} and labels("Licensed under CC BY-SA-ND 4.0") == set()
    assert labels('Licensed under the Apache License, Version 2.0 (the "License"); and so on') == {"apache"}
    lesser = license_scan.TEMPLATES["gpl"][1].replace("GNU General", "GNU Lesser General")
    assert labels(lesser) == {"lgpl"}
    for label, texts in license_scan.TEMPLATES.items():
        for text in texts:
            assert labels(f"foo {text} bar") == {label}
        assert labels("\n".join(texts)) == {label}
    later = license_scan.TEMPLATES["mit"][-1].split()
    assert labels(" ".join(later[:20] + ["oddly"] + later[21:])) == {"mit"}


def test_quality_without_both_classes(spark, tmp_path):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    for name, some, known in (("none", docs.limit(0), labels), ("bare", docs, labels.limit(0)), ("good", docs, labels.filter("quality = 1"))):
        some.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        known.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    rows = {n: quality_qda.op10_quality_qda(spark, f"{tmp_path}/{n}") for n in ("none", "bare", "good")}
    assert rows["none"].count() == 0
    for n, prior in (("bare", 0.5), ("good", 1.0)):
        assert rows[n].count() == docs.count() and rows[n].filter(f"score <> {prior} OR predicted <> 1").count() == 0
