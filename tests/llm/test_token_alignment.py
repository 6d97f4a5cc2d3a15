import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from clickpipe.llm import token_alignment as ta
from clickpipe.llm.common import read_table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files():
    return ta.load(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def plain(texts):
    """Per text the groups, by loops over byte ends, with the libraries' own decoding of single ids."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    chars = {v: k for k, v in byte_chars().items()}
    for t in texts:
        if not t:
            yield []
            continue
        data = (" " + t).encode()
        xs = [(i, bytes(chars[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
        ys = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(t)]
        if b"".join(x for _, x in xs) != data or b"".join(y for _, y in ys) != data:
            yield []
            continue
        groups, i, j, end = [], 0, 0, [0, 0]
        left, right = [], []
        while i < len(xs) or j < len(ys):
            if end[0] <= end[1] and i < len(xs):
                left.append(xs[i][0])
                end[0] += len(xs[i][1])
                i += 1
            else:
                right.append(ys[j][0])
                end[1] += len(ys[j][1])
                j += 1
            if end[0] == end[1]:
                groups.append((left, right))
                left, right = [], []
        yield groups


def byte_chars():
    """Byte to character, by counting."""
    out, extra = {}, 256
    for i in range(256):
        if chr(i).isprintable() and chr(i) != " " and i != 0xAD:
            out[i] = chr(i)
        else:
            out[i], extra = chr(extra), extra + 1
    return out


def expected(texts):
    groups = list(plain(texts))
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    counts = Counter(p for n in links for p in n)
    best = {}
    for (x, _), c in counts.items():
        best[x] = max(best.get(x, 0), c)
    out = []
    for g, n in zip(groups, links, strict=True):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(n.values()), sum(k for p, k in n.items() if counts[p] == best[p[0]]),
                    sum(k * counts[p] for p, k in n.items()), hashlib.sha256(written.encode()).hexdigest() if g else ""))
    return out


OUT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_equals_loops(shared):
    docs = sorted((r.doc_id, r.text) for r in read_table(shared, SMALL, "documents", "doc_id", "text").collect())
    got = sorted((r.doc_id, *(r[c] for c in OUT)) for r in ta.op12_token_alignment(shared, SMALL).collect())
    want = expected([t for _, t in docs])
    assert got == [(d, *w) for (d, _), w in zip(docs, want, strict=True)]
    assert sum(w[0] for w in want) > 0


@pytest.fixture(scope="module")
def odd_texts():
    rnd = random.Random(4)
    chars = [*"abc xyz  \n\t.,09", "é", "ß", "語", "☃", "😀", "▁", "​", "﻿", "<0x41>", "<|endoftext|>", "<s>", "<unk>", "é", "\x00"]
    rows = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    return rows + [None, "", " ", "\n", "a", "a", "x" * 20_000, "aaa " * 6000, "語" * 3000, "<|endoftext|>", "Zürich 12:30"] + ["same text twice"] * 700


def test_odd_texts_in_small_blocks(shared, files, odd_texts, monkeypatch):
    monkeypatch.setattr(ta, "LINKS", 50)
    rows = [(i if i % 7 else None, t, "clash", "clash") for i, t in enumerate(odd_texts)]
    docs = shared.createDataFrame(rows, "doc_id long, text string, n_a string, _block string").repartition(5)
    got = ta.align(docs, files).collect()
    assert got[0].asDict().keys() == {"doc_id", "_block", *OUT} and got[0]["_block"] == "clash"
    want = expected(odd_texts)
    assert Counter((r.doc_id, *(r[c] for c in OUT)) for r in got) == Counter((i if i % 7 else None, *w) for i, w in enumerate(want))
    assert 0 < sum(not w[0] for w in want) < len(want)


def test_groups_are_the_real_output(shared, files, odd_texts):
    docs = shared.createDataFrame([(i, t) for i, t in enumerate(odd_texts[:400])], "doc_id long, text string")
    got = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in ta.groups_of(docs, files).collect()}
    assert got == dict(enumerate(plain(odd_texts[:400])))


def test_links_in_slices_equal_those_at_once(files, odd_texts, monkeypatch):
    tok = ta.Tokenizers(*files)
    block = ta.Block(tok, odd_texts[:200])
    whole = block.pairs()
    monkeypatch.setattr(ta, "LINKS", 3)
    assert all(np.array_equal(x, y) for x, y in zip(whole, block.pairs(), strict=True))
    assert whole[2].sum() == block.links.sum()


def test_empty_table(shared, files):
    assert ta.align(shared.createDataFrame([], "doc_id long, text string"), files).collect() == []


def test_encoding_by_ranks_equals_the_library(files):
    tok = ta.Tokenizers(*files)
    assert tok.ranked is not None
    rnd = random.Random(8)
    few = [chr(i) for i in range(0x250)] + [chr(i) for i in range(0x2000, 0x20C0)] + ["\u3000", "\u0600", "\U0001F600"]
    texts = ["".join(rnd.choices(few, k=rnd.randint(1, 30))) for _ in range(3000)]
    texts += ["".join(rnd.choices([*" \n\t\x85\xa0\x1c'", "s", "ll", "re", "a", "1", "\u00b2", ".", "\u2581", "\u3000", "\u00aa"], k=rnd.randint(1, 12))) for _ in range(4000)]
    texts += [f"{x}{c}{y}" for c in few for x, y in (("a", "a"), (" ", " "), ("1", "1"), (" a", "\n"))]
    want = [x.ids for x in tok.a.encode_batch_fast(texts, add_special_tokens=False)]
    assert [tok._encode_a(t) for t in texts] == want
    assert sum(ta._ODD.search(t) is None for t in texts) > 4000


def test_other_vocabularies_are_not_ranked(files):
    import json

    read = json.loads(files[0])
    table = ta.Tokenizers(*files).a_bytes
    for change in ({"pre_tokenizer": {"type": "Whitespace"}}, {"normalizer": {"type": "NFC"}}, {"model": read["model"] | {"merges": read["model"]["merges"][1:]}}):
        assert ta._ranked(json.dumps(read | change), table) is None
