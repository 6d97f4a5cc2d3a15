import math

from clickpipe.operators.assemble import labelled_data
from clickpipe.operators.sampling import (SAMPLE_PLAN_LARGE, bernoulli_sample, exact_n_sample,
                                          hash_split, key_sample, random_split, sample_tables)


def test_hash_split_disjoint_complete_reproducible(tables):
    d = labelled_data(**tables)
    tr, te = hash_split(d)
    assert tr.count() + te.count() == d.count()
    tr_ids = {r.display_id for r in tr.select("display_id").distinct().collect()}
    te_ids = {r.display_id for r in te.select("display_id").distinct().collect()}
    assert not tr_ids & te_ids  # no impression on both sides (no fan-out leakage)
    assert tr.exceptAll(hash_split(d)[0]).count() == 0


def test_random_split_seeded(tables):
    d = labelled_data(**tables)
    a, b = random_split(d, [0.7, 0.3], seed=7)
    assert a.count() + b.count() == d.count()
    assert a.intersectAll(b).count() <= d.count() - d.distinct().count()
    a2, _ = random_split(d, [0.7, 0.3], seed=7)
    assert a2.count() == a.count()


def _brute_exact_n(pdf, fraction, cols, seed):
    import hashlib

    k = round(fraction * len(pdf))
    def h(row):
        key = "|".join(str(row[c]) for c in cols) if len(cols) > 1 else str(row[cols[0]])
        return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    pdf = pdf.assign(_h=pdf.apply(h, axis=1)).sort_values(["_h"] + cols, kind="mergesort")
    return pdf.head(k).drop(columns="_h")


def test_exact_n_sample_matches_brute_force(tables):
    ev = tables["event"]
    for target in (1 << 17, 64):  # one bucket, and many buckets
        got = exact_n_sample(ev, 0.09, order_cols=["display_id"], seed=123,
                             target_bucket_rows=target).toPandas()
        want = _brute_exact_n(ev.toPandas(), 0.09, ["display_id"], 123)
        assert len(got) == round(0.09 * ev.count())
        assert sorted(got.display_id) == sorted(want.display_id)


def test_exact_n_edges(tables):
    tr = tables["train"]
    assert exact_n_sample(tr, 0.0).count() == 0
    assert exact_n_sample(tr, 1.0).count() == tr.count()
    n = exact_n_sample(tr, 0.12, target_bucket_rows=100).count()
    assert n == round(0.12 * tr.count())


def test_key_sample_keeps_same_keys(tables):
    s = sample_tables(tables, SAMPLE_PLAN_LARGE, key="display_id")
    ev_ids = {r.display_id for r in s["event"].select("display_id").collect()}
    tr_ids = {r.display_id for r in s["train"].select("display_id").distinct().collect()}
    # train keeps 0.12 of the keys, event 0.09: the event keys are a subset of the train keys
    all_train = {r.display_id for r in tables["train"].select("display_id").distinct().collect()}
    assert ev_ids & all_train <= tr_ids
    assert s["promoted_content"].count() == tables["promoted_content"].count()
    n = tables["event"].count()
    assert abs(len(ev_ids) - 0.09 * n) < 5 * math.sqrt(n * 0.09)


def test_bernoulli_sample_size(tables):
    tr = tables["train"]
    n = tr.count()
    got = bernoulli_sample(tr, 0.12, seed=123).count()
    assert abs(got - 0.12 * n) < 5 * math.sqrt(n * 0.12 * 0.88)
    assert bernoulli_sample(tr, 0.12, seed=123).count() == got


def test_exact_n_sample_hot_duplicate_key(spark):
    # A third of the rows share one order key: still exactly k rows, and the
    # multiset equals the first k rows of the brute-force order.
    rows = [(1, "hot")] * 300 + [(i, f"v{i}") for i in range(2, 602)]
    df = spark.createDataFrame(rows, "id long, v string").repartition(4)
    for frac in (0.1, 0.4, 0.7):
        got = exact_n_sample(df, frac, order_cols=["id"], seed=7, target_bucket_rows=64)
        pdf = df.toPandas()
        want = _brute_exact_n(pdf, frac, ["id"], 7)
        g = got.toPandas()
        assert len(g) == round(frac * len(pdf))
        assert sorted(g.id) == sorted(want.id)


def test_sampling_job_csv_to_csv(spark, tables):
    import tempfile

    from clickpipe.plans.workflow import run_sampling_job
    from clickpipe.sources.schemas import EVENT_SCHEMA, TRAIN_SCHEMA
    from clickpipe.sources.tables import read_csv, write_csv

    root = tempfile.mkdtemp(prefix="clickpipe-sample-")
    inputs = {}
    for name, df in tables.items():
        inputs[name] = f"{root}/in/{name}"
        write_csv(df, inputs[name])
    out = run_sampling_job(spark, inputs, f"{root}/out", SAMPLE_PLAN_LARGE)
    tr = read_csv(spark, out["train"], schema=TRAIN_SCHEMA)
    ev = read_csv(spark, out["event"], schema=EVENT_SCHEMA)
    assert tr.exceptAll(key_sample(tables["train"], 0.12)).count() == 0
    assert ev.count() == key_sample(tables["event"], 0.09).count()
    # keys kept in event are kept in train too (when the display has clicks)
    assert ev.join(tables["train"], "display_id", "left_semi") \
             .join(tr, "display_id", "left_anti").count() == 0


def test_null_keys_are_kept(spark):
    rows = [(i if i % 3 else None, f"v{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "id long, v string").repartition(5)
    for frac in (0.1, 0.4, 0.7):
        for cols in (["id"], None):
            got = exact_n_sample(df, frac, order_cols=cols, target_bucket_rows=64)
            assert got.count() == round(frac * 900)
            assert got.exceptAll(df).count() == 0
    train, test = hash_split(df, key="id")
    assert train.count() + test.count() == 900
    assert key_sample(df, 1.0, "id").count() == 900


def test_exact_n_sample_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 600 + [(None, None)] * 300, "id long, v string").repartition(4)
    for frac in (0.1, 0.5, 0.9):
        got = exact_n_sample(df, frac, target_bucket_rows=64)
        assert got.count() == round(frac * 900) and got.exceptAll(df).count() == 0


def test_seed_changes_every_draw(tables):
    from clickpipe.plans.tuning import FOLD_COL, with_folds
    from clickpipe.plans.workflow import prepare

    def ids(df):
        return sorted(map(tuple, df.select("display_id").distinct().collect()))

    one, two = (sample_tables(tables, SAMPLE_PLAN_LARGE, seed=s)["train"] for s in (1, 2))
    assert ids(one) != ids(two)
    assert ids(prepare(tables, seed=1).train) != ids(prepare(tables, seed=2).train)
    folds = [with_folds(tables["event"], 5, seed=s).filter(f"{FOLD_COL} = 0") for s in (1, 2)]
    assert ids(folds[0]) != ids(folds[1])
