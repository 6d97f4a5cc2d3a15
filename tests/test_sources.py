import pytest
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from clickpipe.sources.schemas import EVENT_SCHEMA, TRAIN_SCHEMA
from clickpipe.sources.tables import (load_table, preview, read_csv, show_rows, write_csv)
from clickpipe.sources.fixtures import register_fixture_views


def _scratch():
    return tempfile.mkdtemp(prefix="clickpipe-test-")


def test_csv_with_pandas_index_column(spark):
    # The original sampling script writes pandas' index as an unnamed first column.
    path = os.path.join(_scratch(), "trains.csv")
    pd.DataFrame({"display_id": [3, 1, 2], "ad_id": [10, 11, 12], "clicked": [1, 0, 1]}).to_csv(path)
    df = read_csv(spark, path, schema=TRAIN_SCHEMA)
    assert df.columns == ["display_id", "ad_id", "clicked"]
    assert dict(df.dtypes) == {"display_id": "bigint", "ad_id": "bigint", "clicked": "int"}
    assert sorted(r.display_id for r in df.collect()) == [1, 2, 3]


def test_csv_infer_schema_and_malformed_values(spark):
    path = os.path.join(_scratch(), "t.csv")
    with open(path, "w") as fh:
        fh.write("display_id,ad_id,clicked\n1,5,1\nx,6,0\n3,7,1\n")
    inferred = read_csv(spark, path, infer_schema=True)
    assert dict(inferred.dtypes)["ad_id"] == "int"
    typed = read_csv(spark, path, schema=TRAIN_SCHEMA)
    rows = {r.ad_id: r.display_id for r in typed.collect()}
    assert rows == {5: 1, 6: None, 7: 3}  # malformed -> null, not a failed job


def test_csv_roundtrip_and_catalog(spark, tables):
    out = os.path.join(_scratch(), "event")
    write_csv(tables["event"], out)
    back = read_csv(spark, out, schema=EVENT_SCHEMA)
    assert back.count() == tables["event"].count()
    assert back.exceptAll(tables["event"]).count() == 0
    views = register_fixture_views(spark, "/root/testdata/sf0.001", suffix="_t")
    cat = load_table(spark, "event", source="catalog", table=views["event"])
    assert cat.schema == back.schema
    pq = os.path.join(_scratch(), "event_pq")
    tables["event"].write.parquet(pq)
    assert load_table(spark, "event", source="parquet", path=pq).count() == back.count()


def test_preview_and_show(tables):
    p = preview(tables["event"], 5, order_by=["display_id"]).collect()
    assert [r.display_id for r in p] == sorted(r.display_id for r in tables["event"].select("display_id").collect())[:5]
    assert show_rows(tables["train"], 100, order_by=["display_id", "ad_id"]).count() == 100
    assert preview(tables["event"]).count() == 5


def test_fixture_views_match_sql(tables, duck):
    from clickpipe.sources.fixtures import DUCKDB_FIXTURE_CTES

    sums = duck("WITH " + DUCKDB_FIXTURE_CTES + """
        SELECT (SELECT sum("timestamp") FROM event) AS ts, (SELECT sum(clicked) FROM train) AS c,
               (SELECT sum(campaign_id) FROM promoted_content) AS camp""")
    assert tables["event"].agg(F.sum("timestamp")).first()[0] == int(sums.ts[0])
    assert tables["train"].agg(F.sum("clicked")).first()[0] == int(sums.c[0])
    assert tables["promoted_content"].agg(F.sum("campaign_id")).first()[0] == int(sums.camp[0])


def test_load_table_argument_errors(spark):
    import pytest

    with pytest.raises(ValueError):
        load_table(spark, "event", source="csv")
    with pytest.raises(ValueError):
        load_table(spark, "event", source="parquet")
    with pytest.raises(ValueError):
        load_table(spark, "event", source="jdbc")


def test_csv_headers_and_invalid_policy(spark, tmp_path):
    from clickpipe.sources.invalid import count_invalid
    from clickpipe.sources.schemas import TRAIN_SCHEMA
    from clickpipe.sources.tables import read_csv

    for name, lines in {"a/x.csv": "ad_id,display_id,clicked\n7,1,1\n8,2,oops\n",
                        "b/y.csv": ",display_id,ad_id,clicked\n0,3,9,0\n1,,9,1\n"}.items():
        path = tmp_path / name
        path.parent.mkdir()
        path.write_text(lines)
    both = [str(tmp_path / "a"), str(tmp_path / "b")]
    kept = {tuple(r) for r in read_csv(spark, both, schema=TRAIN_SCHEMA, invalid="keep").collect()}
    assert kept == {(1, 7, 1), (2, 8, None), (3, 9, 0), (None, 9, 1)}
    skipped = {tuple(r) for r in read_csv(spark, both, schema=TRAIN_SCHEMA, invalid="skip").collect()}
    assert skipped == {(1, 7, 1), (3, 9, 0)}
    with pytest.raises(Exception, match="invalid value in column"):
        read_csv(spark, both, schema=TRAIN_SCHEMA, invalid="error").collect()
    with pytest.raises(ValueError):
        read_csv(spark, both, schema=TRAIN_SCHEMA, invalid="drop")
    lost = count_invalid(read_csv(spark, both, schema=TRAIN_SCHEMA), TRAIN_SCHEMA.names).first()
    assert (lost.n_rows, lost.n_invalid, lost.invalid_clicked, lost.invalid_display_id) == (4, 2, 1, 1)
    # files under one path must share their header
    (tmp_path / "a" / "z.csv").write_text("display_id,ad_id,clicked\n1,2,0\n")
    with pytest.raises(Exception):
        read_csv(spark, both[0], schema=TRAIN_SCHEMA).collect()


def test_inferred_types_over_paths_that_disagree(spark, tmp_path):
    from clickpipe.sources.inference import infer_types

    files = {"a": "id,n,big,x,t\n1,7,1,1.5,a\n2,,2147483648,2,b\n", "b": ",id,n,big,x,t\n0,x3,8,3,1e3,\n1,4,+9,4,,\n", "c": "id,only\n5,\n"}
    for name, lines in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(lines)
    paths = [str(tmp_path / c) for c in files]
    df = read_csv(spark, paths, infer_schema=True)
    assert dict(df.dtypes) == {"id": "string", "n": "int", "big": "bigint", "x": "double", "t": "string", "only": "string"}
    assert {(r.id, r.n, r.big, r.x, r.t) for r in df.collect()} == {
        ("1", 7, 1, 1.5, "a"), ("2", None, 2147483648, 2.0, "b"), ("x3", 8, 3, 1000.0, None), ("4", 9, 4, None, None), ("5", None, None, None, None)}
    assert load_table(spark, "any", source="csv", path=paths, infer_schema=True).schema == df.schema
    odd = spark.createDataFrame([("1.", "NaN", "1d", " 12 ", "9" * 30)], "a string, b string, c string, d string, e string")
    assert [t.simpleString() for t in infer_types(odd).values()] == ["double", "string", "string", "int", "double"]


def test_error_policy_fails_on_any_action(spark, tmp_path):
    (tmp_path / "clicks.csv").write_text("display_id,ad_id,clicked\n1,5,1\n2,6,n/a\n3,7,0\n")
    df = read_csv(spark, str(tmp_path / "clicks.csv"), schema=TRAIN_SCHEMA, invalid="error")
    for action in (lambda: df.count(), lambda: df.select("display_id").collect(), lambda: df.filter("ad_id = 6").count(),
                   lambda: df.agg(F.max("ad_id")).collect()):
        with pytest.raises(Exception, match="invalid value in column clicked"):
            action()


def test_quarantine_counts_every_row(spark, tmp_path):
    from clickpipe.sources.quarantine import quarantine, read_quarantine

    raw = spark.createDataFrame([("1", "5", "1", "x"), ("2", None, "n/a", "y"), ("z", "6", "0", None), ("4", "7", "1", "q")],
                                "display_id string, ad_id string, clicked string, extra string")
    path = str(tmp_path / "q")
    first = quarantine(raw, TRAIN_SCHEMA, path, batch="one")
    assert {tuple(r) for r in first.accepted.collect()} == {(1, 5, 1, "one"), (4, 7, 1, "one")}
    assert {(r.raw_display_id, r["column"], r.value, r.reason) for r in first.reasons().collect()} == {
        ("2", "ad_id", None, "missing"), ("2", "clicked", "n/a", "malformed"), ("z", "display_id", "z", "malformed")}
    quarantine(raw.filter("extra = 'x'"), TRAIN_SCHEMA, path, batch="two")
    found = read_quarantine(spark, TRAIN_SCHEMA, path)
    assert {tuple(r) for r in found.counts().collect()} == {("one", 4, 2, 2), ("two", 1, 1, 0)}
    assert found.accepted.schema.fieldNames() == [*TRAIN_SCHEMA.names, "batch"]
