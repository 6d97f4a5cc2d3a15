import math

import numpy as np
from pyspark.sql import functions as F

from clickpipe.llm.itq_dedup import ORACLE_SQL as DEDUP_SQL
from clickpipe.llm.itq_dedup import near_duplicates, op2_itq_dedup
from clickpipe.llm.topk_search import ORACLE_SQL, SortedLists, integer_components, op1_topk_search, search, usable

SMALL = "/root/testdata/sf0.001"


def _oracle(sql):
    import duckdb

    c = duckdb.connect()
    c.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    return c.sql(sql).df()


def _same(got, want):
    cols = sorted(want.columns)
    rows = lambda df: sorted(map(tuple, df[cols].astype(object).values.tolist()))
    assert sorted(got.columns) == cols and rows(got) == rows(want)


def test_op1_equals_sql(spark):
    _same(op1_topk_search(spark, SMALL).toPandas(), _oracle(ORACLE_SQL))


def test_op2_equals_sql(spark):
    _same(op2_itq_dedup(spark, SMALL).toPandas(), _oracle(DEDUP_SQL))


def test_threshold_algorithm_against_brute_force():
    rng = np.random.default_rng(3)
    for n, d, high in ((1, 3, 5), (40, 4, 2), (3000, 16, 60), (3000, 8, 1)):
        rows = rng.integers(-high, high + 1, (n, d)).astype(float)
        lists = SortedLists(rows)
        for q in (*rng.integers(-high, high + 1, (5, d)).astype(float), np.zeros(d)):
            banned = np.arange(min(2, n - 1))
            places, scores = lists.search(q, 5, banned)
            every = rows @ q
            want = sorted((i for i in range(n) if i not in banned), key=lambda i: (-every[i], i))[:5]
            assert places.tolist() == want and scores.tolist() == every[want].tolist()


def test_threshold_algorithm_stops_early():
    rows = np.zeros((5000, 3))
    rows[:, 0] = np.arange(5000)
    lists = SortedLists(rows)
    read = []
    whole = lists.rows
    lists.rows = type("Spy", (), {"__getitem__": lambda self, i: (read.append(len(i)), whole[i])[1], "__len__": lambda self: len(whole), "dtype": whole.dtype})()
    places, _ = lists.search(np.array([2.0, 0.0, 0.0]), 5, np.empty(0, int))
    assert places.tolist() == [4999, 4998, 4997, 4996, 4995] and sum(read) < 100


def test_search_edge_cases(spark):
    rows = [(0, [0.5, 0.25]), (50, [1.0, -1.0]), (50, [1.0, -1.0]), (1, [0.5, 0.25]), (2, None), (3, [0.5, None]), (4, [float("nan"), 1.0]),
            (5, []), (6, [0.5, 0.25, 9.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("rank", F.lit(0))
    df = df.filter(usable(F.col("embedding"))).withColumn("_v", integer_components(F.col("embedding")))
    got = [tuple(r) for r in search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    v = {0: [128, 64], 50: [256, -256], 1: [128, 64], 5: [], 6: [128, 64, 2304]}
    want = []
    for q in (0, 50):
        best = sorted(((-sum(a * b for a, b in zip(v[q], x)), i) for i, x in v.items() if i != q))[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == want
    assert search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def _brute(rows, threshold=0.98):
    ids = [r[0] for r in rows]
    able = [r[0] is not None and r[2] is not None and r[1] and None not in r[1] and all(map(math.isfinite, r[1])) and any(r[1]) for r in rows]
    cos = lambda a, b: float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))
    links = {i: {j for k, j in enumerate(ids) if able[n] and able[k] and j != i and rows[n][2] == rows[k][2] and cos(rows[n][1], rows[k][1]) >= threshold}
             for n, i in enumerate(ids)}
    out = []
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((i, len(links[i]), min(seen) if i is not None else None, i is not None and i == min(seen)))
    return out


def test_near_duplicate_vectors_against_brute_force(spark, monkeypatch):
    import clickpipe.llm.itq_dedup as M

    rng = np.random.default_rng(4)
    base = rng.standard_normal((12, 24))
    rows = []
    for i in range(420):
        v = base[0 if i % 3 == 0 else i % 12] + rng.standard_normal(24) * (0.16 if i % 2 else 0.05)  # a third around one vector
        rows.append((i, [float(np.float32(x)) for x in (base[0] if i % 9 == 0 else v)], None if i % 41 == 7 else i % 2))
    rows += [(1000, None, 1), (1001, [0.0] * 24, 1), (1002, [1.0, None] + [0.0] * 22, 1), (1003, [float("inf")] * 24, 1), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("kept", F.lit("clash"))
    want = sorted(_brute(rows), key=str)
    for block in (2048, 16):  # one block an entry, and many
        monkeypatch.setattr(M, "ENTRY_ROWS", block)
        got = sorted((tuple(r) for r in near_duplicates(df).collect()), key=str)
        assert got == want
    assert near_duplicates(df.limit(0)).count() == 0


def test_recall_of_the_tables():
    from clickpipe.llm.itq_dedup import Quantiser

    rng = np.random.default_rng(5)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + math.sqrt(1 - 0.98 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)  # pairs just at the threshold
    q = Quantiser(a, 2000)
    assert (q.keys(a) == q.keys(b)).any(axis=1).mean() >= 0.99
    assert abs(q.keys(a).max() / 2 ** q.bits - 1) < 0.1


def test_recall_with_a_common_direction():
    from clickpipe.llm.itq_dedup import Quantiser

    rng = np.random.default_rng(6)
    common = np.zeros(64)
    common[0] = 1
    for share in (0.0, 0.9, 0.95):
        a = rng.standard_normal((4000, 64))
        a = share * common + math.sqrt(1 - share ** 2) * a / np.linalg.norm(a, axis=1, keepdims=True)
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.standard_normal((4000, 64))
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b = 0.98 * a + math.sqrt(1 - 0.98 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        q = Quantiser(a, 4000)
        assert (q.keys(a) == q.keys(b)).any(axis=1).mean() >= 0.998


def test_search_with_large_components(spark):
    rng = np.random.default_rng(7)
    for high, dims in ((1 << 26, 40), (1 << 27, 40), (1 << 40, 3)):  # sums beyond 2**53 and beyond 2**63
        rows = [(i, [int(x) for x in rng.integers(-high, high, dims)]) for i in range(60)]
        got = [tuple(r) for r in search(spark.createDataFrame(rows, "vec_id long, _v array<long>"), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
        want = []
        for q in (0, 50):
            best = sorted((-sum(a * b for a, b in zip(rows[q][1], x, strict=True)), i) for i, x in rows if i != q)[:5]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
        assert got == want
