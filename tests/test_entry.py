import __spark_entry__ as E


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert [r.metric for r in rows] == ["TP", "FP", "TN", "FN", "Precision", "Recall"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_relational_queries_match_sql_small(spark, duck):
    """Every oracle'd relational query agrees with its SQL at sf0.001."""
    sql = E.oracle_sql()
    names = ["join_by_document", "split_hash_test", "minmax_scale", "classification_summary",
             "auc_roc", "sample_exact_n", "sample_by_key", "confusion_metrics"]
    for name in names:
        s = E.queries()[name](spark, "/root/testdata/sf0.001").toPandas()
        d = duck(sql[name])
        assert sorted(s.columns) == sorted(d.columns), name
        cols = sorted(s.columns)
        norm = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                                 for r in df[cols].itertuples(index=False))
        assert norm(s) == norm(d), name
