"""Named queries of the closed-form learners, exact tuning, encoders, hot-key joins,
type inference and quarantine, with their SQL (see ``registry``)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpipe.operators.assemble import FEATURES, LABEL, TRUE_LABEL, join_ads_by_document, join_impressions_clicks, labelled_data
from clickpipe.operators.categories import find_categories
from clickpipe.operators.dictionary import build_dictionary, encode
from clickpipe.plans import node_table
from clickpipe.plans.closed_form import residual_moments
from clickpipe.plans.counts import fit_pipeline_counted
from clickpipe.plans.evaluate import auc_roc, metrics_table, probability_score
from clickpipe.plans.features import build_pipeline
from clickpipe.plans.models import make_learner
from clickpipe.plans.registry import _COUNTS, _DATA, _FOLD_HASH, _J1, _J2, _RATES, _SPLIT, SCALED, Query, _with
from clickpipe.plans.tuning import BAYES_MAPS, bayes_param_grid, cv_summary, param_text, train_validation_split
from clickpipe.plans.workflow import Split, _fit_shared, fit_and_score, fit_pipeline, prepare, training_input, tune
from clickpipe.session import ensure_checkpoint_dir, shared_scratch
from clickpipe.sources.fixtures import fixture_tables
from clickpipe.sources.invalid import apply_policy
from clickpipe.sources.quarantine import Quarantine, quarantine
from clickpipe.sources.schemas import TRAIN_SCHEMA
from clickpipe.sources.tables import read_csv, write_csv


# ---------------------------------------------------------------- sources
def q_csv_inferred_mixed(spark, sf_dir) -> DataFrame:
    """S1 over two folders that disagree: ids that need 64 bits, fractions and text in one
    of them only, and a column that the other lacks."""
    ads = fixture_tables(spark, sf_dir)["promoted_content"]
    base = shared_scratch(spark, "ads-mixed")
    even, odd = ads.filter("ad_id % 2 = 0"), ads.filter("ad_id % 2 <> 0")
    write_csv(even.withColumn("bid", F.col("advertiser_id")), f"{base}/a")
    write_csv(odd.select((F.col("ad_id") + F.lit(1 << 40)).alias("ad_id"), F.concat(F.lit("d"), F.col("document_id")).alias("document_id"),
                         "campaign_id", (F.col("advertiser_id") / 2).alias("bid")), f"{base}/b")
    return read_csv(spark, [f"{base}/a", f"{base}/b"], infer_schema=True).select(
        "ad_id", "document_id", "campaign_id", F.coalesce("advertiser_id", F.lit(-1)).alias("advertiser_id"), "bid")


def _quarantined(spark, sf_dir) -> Quarantine:
    """The click table with malformed clicks and missing ads, in two batches."""
    train = fixture_tables(spark, sf_dir)["train"]
    clicked = F.when(F.col("ad_id") % 7 == 0, "n/a").otherwise(F.col("clicked").cast("string"))
    ad = F.when(F.col("ad_id") % 11 == 0, None).otherwise(F.col("ad_id").cast("string"))
    raw = train.select("display_id", ad.alias("ad_id"), clicked.alias("clicked"))
    path, base = shared_scratch(spark, "quarantine"), shared_scratch(spark, "clicks-raw")
    found = None
    for batch in (0, 1):
        write_csv(raw.filter(F.col("display_id") % 2 == batch), f"{base}/{batch}")
        found = quarantine(read_csv(spark, f"{base}/{batch}"), TRAIN_SCHEMA, path, batch=f"b{batch}")
    return found


def q_csv_quarantine_accepted(spark, sf_dir):
    return _quarantined(spark, sf_dir).accepted


def q_csv_quarantine_rejected(spark, sf_dir):
    """A row for each faulty value, with the row as it was read."""
    found = _quarantined(spark, sf_dir).reasons()
    return found.select([F.coalesce(c, F.lit("(none)")).alias(c) for c in found.columns])


def q_csv_quarantine_counts(spark, sf_dir):
    return _quarantined(spark, sf_dir).counts()


# ---------------------------------------------------------------- hot keys
def _hot_tables(spark, sf_dir):
    """A third of the clicks on one display, a third of the displays on one document."""
    t = fixture_tables(spark, sf_dir)
    train = t["train"].withColumn("display_id", F.when(F.col("ad_id") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("display_id")))
    event = t["event"].withColumn("document_id", F.when(F.col("display_id") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("document_id")))
    return event, train, t["promoted_content"]


def q_join_display_hot(spark, sf_dir):
    event, train, _ = _hot_tables(spark, sf_dir)
    return join_impressions_clicks(event, train, hot_share=0.01)


def q_join_document_hot(spark, sf_dir):
    event, train, ads = _hot_tables(spark, sf_dir)
    joined = join_ads_by_document(join_impressions_clicks(event, train, hot_share=0.01), ads, hot_share=0.01)
    return joined.select("display_id", "uuid", "timestamp", "platform", "geo_location", "clicked", "ad_id", "document_id", "campaign_id", "advertiser_id")


# ---------------------------------------------------------------- encoders
def q_string_index(spark, sf_dir):
    """``uuid`` and ``geo_location`` of every impression by falling frequency."""
    event = fixture_tables(spark, sf_dir)["event"].select("display_id", "uuid", "geo_location")
    return encode(event, {c: build_dictionary(event, c) for c in ("uuid", "geo_location")})


def q_string_index_unseen(spark, sf_dir):
    """Dictionaries of the even displays on the odd ones: unseen values get the next index."""
    event = fixture_tables(spark, sf_dir)["event"].select("display_id", "uuid", "geo_location")
    known = event.filter("display_id % 2 = 0")
    return encode(event.filter("display_id % 2 <> 0"), {c: build_dictionary(known, c) for c in ("uuid", "geo_location")}, invalid="keep")


def q_vector_index(spark, sf_dir):
    """Slots of the feature vector with at most 30 values, numbered; the others as they are."""
    data = labelled_data(**fixture_tables(spark, sf_dir))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="v").transform(data)
    out = vector_to_array("indexed")
    indexed = find_categories(rows, "v", len(FEATURES), 30).transform(rows, "v", "indexed")
    return indexed.select("display_id", "ad_id", LABEL, *[out[i].alias(f"i_{c}") for i, c in enumerate(FEATURES)])


# ---------------------------------------------------------------- closed-form learners, tuning
def q_nb_predict(spark, sf_dir):
    """Naive Bayes on the job's features: every prediction and its probability, to six places."""
    pred = fit_and_score("nb", prepare(fixture_tables(spark, sf_dir)))[1]
    return pred.select("display_id", "ad_id", TRUE_LABEL, "prediction", F.round("score", 6).alias("score"))


def q_nb_auc(spark, sf_dir):
    found = auc_roc(fit_and_score("nb", prepare(fixture_tables(spark, sf_dir)))[1])
    return found.select(F.round("auc", 6).alias("auc"))


def q_cv_grid(spark, sf_dir):
    """M5, M6 by the default metric: a grid of learners that SQL can state, ten folds, exact AUC."""
    nb = make_learner("nb")
    model = tune(build_pipeline(nb), bayes_param_grid(nb), prepare(fixture_tables(spark, sf_dir)).train, metric="areaUnderROC", parallelism=4)
    found = cv_summary(spark, model, "areaUnderROC")
    return found.select("params", "metric", F.round("avg_metric", 6).alias("avg_metric"), F.round("std_metric", 6).alias("std_metric"), "best")


def q_validation_split(spark, sf_dir):
    """One hash split: all metrics of every map, and which map each of two metrics chooses."""
    nb = make_learner("nb")
    grid = bayes_param_grid(nb)
    with training_input(prepare(fixture_tables(spark, sf_dir)).train) as data:
        found = train_validation_split(build_pipeline(nb), grid, data, metric="areaUnderROC", parallelism=4)
    names = F.array(*[F.lit(param_text(m)) for m in grid])
    rates = [F.round(c, 9).alias(c) for c in ("accuracy", "test_error", "precision", "recall", "f1", "rmse")]
    return found.metrics.select(F.get(names, F.col("map")).alias("params"), "n", *rates, F.round("areaUnderROC", 6).alias("auc"),
                                F.when(F.col("map") == found.best, "yes").otherwise("no").alias("best"))


def q_linear_moments(spark, sf_dir):
    """Least squares on all features: the residual's mean and its products with each feature."""
    train = prepare(fixture_tables(spark, sf_dir)).train
    scored = fit_pipeline("linear", train).transform(train)
    x = vector_to_array("features")
    scored = scored.select(LABEL, "prediction", *[x[i].alias(f"s_{c}") for i, c in enumerate(SCALED)])
    found = residual_moments(scored, [f"s_{c}" for c in SCALED])
    return found.select("feature", (F.round("moment", 9) + F.lit(0.0)).alias("moment"))


def q_linear_platform(spark, sf_dir):
    """Least squares on one scaled feature: slope and intercept."""
    train = prepare(fixture_tables(spark, sf_dir)).train
    model = build_pipeline(make_learner("linear"), features=["platform"]).fit(train).stages[-1]
    return train.agg(F.count(F.lit(1)).alias("n"), F.lit(round(model.coefficients[0], 9)).alias("slope"), F.lit(round(model.intercept, 9)).alias("intercept"))


def xor_split(spark, sf_dir) -> Split:
    """Two 0/1 features of the labelled table and their exclusive or as the label."""
    data = labelled_data(**fixture_tables(spark, sf_dir))
    a, b = (F.col("platform") <= 2).cast("double"), (F.col("ad_id") % 2).cast("double")
    both = data.select("display_id", "ad_id", a.alias("a"), b.alias("b"), (a != b).cast("int").alias(LABEL))
    return Split(both.filter("display_id % 10 < 7"), both.filter("display_id % 10 >= 7").withColumnRenamed(LABEL, TRUE_LABEL))


def q_mlp_xor(spark, sf_dir):
    """The layered learner on a label that no single cut and no linear score can tell."""
    split = xor_split(spark, sf_dir)
    with training_input(split.train.select("a", "b", LABEL), counted_copies=True) as data:
        model = fit_pipeline_counted(build_pipeline(make_learner("mlp", layers=[2, 8, 2]), features=["a", "b"]), data)
    return metrics_table(probability_score(model.transform(split.test)))


#: Trees of the reference's depth; the forest with less of it, for the time of its fit.
NODE_LEARNERS = {"dt": {}, "gbt": {}, "rf": {"maxDepth": 12}}


def q_tree_nodes(spark, sf_dir):
    """Test rows whose prediction by the table of nodes equals the model's own.

    All learners share one training input and one test half, each made once."""
    split = prepare(fixture_tables(spark, sf_dir))
    ensure_checkpoint_dir(spark)
    test, out = split.test.checkpoint(eager=True), None
    with training_input(apply_policy(split.train, [LABEL], "error"), counted_copies=True) as data:
        for name, params in NODE_LEARNERS.items():
            model = _fit_shared(build_pipeline(make_learner(name, **params)), data)
            rows = model.transform(test).select("features", F.col("prediction").alias("own"))
            found = node_table.predict(model.stages[-1], rows).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("own") == F.col("prediction")).alias("n_equal"))
            found = found.select(F.lit(name).alias("learner"), "n_rows", "n_equal")
            out = found if out is None else out.unionByName(found)
    return out


QUERIES: dict[str, Query] = {
    "csv_inferred_mixed": q_csv_inferred_mixed,
    "csv_quarantine_accepted": q_csv_quarantine_accepted,
    "csv_quarantine_rejected": q_csv_quarantine_rejected,
    "csv_quarantine_counts": q_csv_quarantine_counts,
    "join_display_hot": q_join_display_hot,
    "join_document_hot": q_join_document_hot,
    "string_index": q_string_index,
    "string_index_unseen": q_string_index_unseen,
    "vector_index": q_vector_index,
    "nb_predict": q_nb_predict,
    "nb_auc": q_nb_auc,
    "cv_grid": q_cv_grid,
    "validation_split": q_validation_split,
    "linear_moments": q_linear_moments,
    "linear_platform": q_linear_platform,
    "mlp_xor": q_mlp_xor,
    "tree_nodes": q_tree_nodes,
}


# ====================================================================== SQL
def _all(form: str, glue: str = ", ") -> str:
    return glue.join(form.replace("@", c) for c in SCALED)


_SUM = _all("s_@", " + ")


def _bayes(fits: str, tests: str, maps=BAYES_MAPS) -> tuple[str, ...]:
    """CTEs from training rows ``fits`` and test rows ``tests`` (both with ``grp``) to
    ``scored``: grp, map, the test row's columns, prediction and score."""
    scaled = _all("CASE WHEN mx_@ = mn_@ THEN 0.5 ELSE (t.@ - mn_@) * (CAST(1 AS DOUBLE) / (mx_@ - mn_@)) END AS x_@")
    rows = ", ".join(f"({i}, '{kind}', CAST({smooth!r} AS DOUBLE))" for i, (kind, smooth) in enumerate(maps))
    var = "greatest(q_@ / n - (s_@ / n) * (s_@ / n), 0) + w.smooth * most"
    gauss = _all(f"- 0.5 * ln(2 * pi() * v_@) - (x_@ - m_@) * (x_@ - m_@) / (2 * v_@)", " ")
    multi = _all("+ x_@ * t_@", " ")
    return (
        f"mm AS (SELECT grp, {_all('min(@) AS mn_@, max(@) AS mx_@')} FROM {fits} GROUP BY grp)",
        f"fx AS (SELECT t.grp, t.label, {scaled} FROM {fits} t JOIN mm ON t.grp = mm.grp)",
        f"tx AS (SELECT t.*, {scaled} FROM {tests} t JOIN mm ON t.grp = mm.grp)",
        f"st AS (SELECT grp, label, CAST(count(*) AS DOUBLE) AS n, {_all('sum(x_@) AS s_@, sum(x_@ * x_@) AS q_@')} FROM fx GROUP BY grp, label)",
        f"al AS (SELECT grp, sum(n) AS whole, count(*) AS kinds, greatest({_all('sum(q_@) / sum(n) - (sum(s_@) / sum(n)) * (sum(s_@) / sum(n))')}) AS most FROM st GROUP BY grp)",
        f"w AS (SELECT * FROM (VALUES {rows}) AS v(map, kind, smooth))",
        f"md AS (SELECT st.grp, st.label, w.map, w.kind, CASE WHEN w.kind = 'gaussian' THEN ln(n) - ln(whole) ELSE ln(n + w.smooth) - ln(whole + w.smooth * kinds) END AS prior, "
        f"{_all('s_@ / n AS m_@')}, {_all(var + ' AS v_@')}, {_all('ln(s_@ + w.smooth) - ln(' + _SUM + f' + w.smooth * {len(SCALED)}) AS t_@')} "
        "FROM st JOIN al ON st.grp = al.grp, w)",
        f"lk AS (SELECT tx.*, a.map, a.prior + CASE WHEN a.kind = 'gaussian' THEN 0 {_side(gauss, 'a')} ELSE 0 {_side(multi, 'a')} END AS l0, "
        f"b.prior + CASE WHEN b.kind = 'gaussian' THEN 0 {_side(gauss, 'b')} ELSE 0 {_side(multi, 'b')} END AS l1 "
        "FROM tx JOIN md a ON tx.grp = a.grp AND a.label = 0 JOIN md b ON tx.grp = b.grp AND b.label = 1 AND a.map = b.map)",
        "scored AS (SELECT *, CASE WHEN l1 > l0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction, "
        "exp(l1 - greatest(l0, l1)) / (exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))) AS score FROM lk)",
    )


def _side(form: str, name: str) -> str:
    """Model columns (``m_``, ``v_``, ``t_``) of one class's row."""
    for c in SCALED:
        for p in "mvt":
            form = form.replace(f" {p}_{c}", f" {name}.{p}_{c}").replace(f"({p}_{c}", f"({name}.{p}_{c}")
    return form


def _aucs(keys: str) -> tuple[str, ...]:
    return (
        f"""sc AS (SELECT {keys}, score, count(*) FILTER (WHERE "trueLabel" = 1) AS pos, count(*) FILTER (WHERE "trueLabel" = 0) AS neg FROM scored GROUP BY {keys}, score)""",
        f"rk AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {keys} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sc)",
        f"auc AS (SELECT {keys}, sum(pos * (below + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM rk GROUP BY {keys})",
    )


_PARAMS = ", ".join(f"({i}, 'modelType={kind}, smoothing={smooth}')" for i, (kind, smooth) in enumerate(BAYES_MAPS))
_NAMED = f"nm AS (SELECT * FROM (VALUES {_PARAMS}) AS v(map, params))"
_ONE = ("fit AS (SELECT 0 AS grp, * FROM train_half)", "tst AS (SELECT 0 AS grp, * FROM test_half)")
_FOLDS = (f"fd AS (SELECT *, {_FOLD_HASH} AS fold FROM train_half)", "ten AS (SELECT unnest(range(10)) AS grp)",
          "fit AS (SELECT ten.grp, fd.* FROM fd JOIN ten ON fd.fold <> ten.grp)", 'tst AS (SELECT fold AS grp, * RENAME (label AS "trueLabel") FROM fd)')
_VALIDATION = _FOLD_HASH.replace("fold:", "validation:").replace("% 10", "% 1000")
_HALVES = (f"vb AS (SELECT 0 AS grp, *, {_VALIDATION} AS b FROM train_half)", "fit AS (SELECT * FROM vb WHERE b < 750)",
           'tst AS (SELECT * RENAME (label AS "trueLabel") FROM vb WHERE b >= 750)')
_BASE = (_J1, _J2, _DATA, _SPLIT)
_HOT_EVENT = """he AS (SELECT display_id, uuid, CASE WHEN display_id % 3 = 0 THEN 1 ELSE document_id END AS document_id, "timestamp", platform, geo_location FROM event),
ht AS (SELECT CASE WHEN ad_id % 3 = 0 THEN 1 ELSE display_id END AS display_id, ad_id, clicked FROM train),
hj AS (SELECT e.*, t.clicked FROM he e JOIN ht t ON e.display_id = t.display_id)"""
_QUARANTINE = """q AS (SELECT CAST(display_id AS VARCHAR) AS raw_display_id, CASE WHEN ad_id % 11 <> 0 THEN CAST(ad_id AS VARCHAR) END AS raw_ad_id,
         CASE WHEN ad_id % 7 = 0 THEN 'n/a' ELSE CAST(clicked AS VARCHAR) END AS raw_clicked, 'b' || (display_id % 2) AS batch, ad_id, display_id, clicked,
         ad_id % 7 = 0 OR ad_id % 11 = 0 AS bad FROM train)"""


def _index(column: str, source: str) -> str:
    return f"(SELECT {column} AS v, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i FROM {source} GROUP BY {column})"


def _slot(c: str) -> str:
    return f"ix_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY {c} <> 0, {c}) - 1 AS i, count(*) OVER () AS k FROM data GROUP BY {c})"


_MET = """SELECT 'TP' AS metric, CAST(count(*) FILTER (WHERE l = 1) AS DOUBLE) AS value FROM x
UNION ALL SELECT 'FP', CAST(0 AS DOUBLE) UNION ALL SELECT 'TN', CAST(count(*) FILTER (WHERE l = 0) AS DOUBLE) FROM x
UNION ALL SELECT 'FN', CAST(0 AS DOUBLE) UNION ALL SELECT 'Precision', CAST(1 AS DOUBLE) UNION ALL SELECT 'Recall', CAST(1 AS DOUBLE)"""

ORACLE_SQL: dict[str, str] = {
    "csv_inferred_mixed": _with() + """SELECT CASE WHEN ad_id % 2 = 0 THEN ad_id ELSE ad_id + 1099511627776 END AS ad_id,
       CASE WHEN ad_id % 2 = 0 THEN CAST(document_id AS VARCHAR) ELSE 'd' || document_id END AS document_id, campaign_id,
       CASE WHEN ad_id % 2 = 0 THEN CAST(advertiser_id AS INTEGER) ELSE -1 END AS advertiser_id,
       CASE WHEN ad_id % 2 = 0 THEN CAST(advertiser_id AS DOUBLE) ELSE advertiser_id / CAST(2 AS DOUBLE) END AS bid FROM promoted_content""",
    "csv_quarantine_accepted": _with(_QUARANTINE) + "SELECT display_id, ad_id, clicked, batch FROM q WHERE NOT bad",
    "csv_quarantine_rejected": _with(_QUARANTINE) + """SELECT batch, raw_display_id, coalesce(raw_ad_id, '(none)') AS raw_ad_id, raw_clicked,
       'ad_id' AS "column", '(none)' AS value, 'missing' AS reason FROM q WHERE ad_id % 11 = 0
UNION ALL SELECT batch, raw_display_id, coalesce(raw_ad_id, '(none)'), raw_clicked, 'clicked', 'n/a', 'malformed' FROM q WHERE ad_id % 7 = 0""",
    "csv_quarantine_counts": _with(_QUARANTINE) + """SELECT batch, count(*) AS n_rows, count(*) FILTER (WHERE NOT bad) AS n_accepted,
       count(*) FILTER (WHERE bad) AS n_rejected FROM q GROUP BY batch""",
    "join_display_hot": _with(_HOT_EVENT) + "SELECT * FROM hj",
    "join_document_hot": _with(_HOT_EVENT) + """SELECT hj.display_id, hj.uuid, hj."timestamp", hj.platform, hj.geo_location, hj.clicked,
       p.ad_id, p.document_id, p.campaign_id, p.advertiser_id FROM hj JOIN promoted_content p ON hj.document_id = p.document_id""",
    "string_index": _with() + f"""SELECT display_id, uuid, geo_location, a.i AS uuid_index, b.i AS geo_location_index
FROM event JOIN {_index('uuid', 'event')} a ON uuid = a.v JOIN {_index('geo_location', 'event')} b ON geo_location = b.v""",
    "string_index_unseen": _with("known AS (SELECT * FROM event WHERE display_id % 2 = 0)") + f"""SELECT display_id, uuid, geo_location,
       coalesce(a.i, (SELECT count(DISTINCT uuid) FROM known)) AS uuid_index, coalesce(b.i, (SELECT count(DISTINCT geo_location) FROM known)) AS geo_location_index
FROM event LEFT JOIN {_index('uuid', 'known')} a ON uuid = a.v LEFT JOIN {_index('geo_location', 'known')} b ON geo_location = b.v WHERE display_id % 2 <> 0""",
    "vector_index": _with(_J1, _J2, _DATA, *map(_slot, SCALED)) + "SELECT display_id, ad_id, label, " + ", ".join(
        f"CASE WHEN ix_{c}.k <= 30 THEN CAST(ix_{c}.i AS DOUBLE) ELSE d.{c} END AS i_{c}" for c in SCALED)
    + " FROM data d " + " ".join(f"JOIN ix_{c} ON d.{c} = ix_{c}.v" for c in SCALED),
    "nb_predict": _with(*_BASE, *_ONE, *_bayes("fit", "tst", BAYES_MAPS[:1])) + 'SELECT display_id, ad_id, "trueLabel", prediction, round(score, 6) AS score FROM scored',
    "nb_auc": _with(*_BASE, *_ONE, *_bayes("fit", "tst", BAYES_MAPS[:1]), *_aucs("map")) + "SELECT round(auc, 6) AS auc FROM auc",
    "cv_grid": _with(*_BASE, *_FOLDS, *_bayes("fit", "tst"), *_aucs("map, grp"), _NAMED,
                     "me AS (SELECT map, avg(auc) AS a, stddev_pop(auc) AS s FROM auc GROUP BY map)")
    + """SELECT params, 'areaUnderROC' AS metric, round(a, 6) AS avg_metric, round(s, 6) AS std_metric,
       CASE WHEN me.map = (SELECT map FROM me ORDER BY a DESC, map LIMIT 1) THEN 'yes' ELSE 'no' END AS best FROM me JOIN nm ON me.map = nm.map""",
    "validation_split": _with(*_BASE, *_HALVES, *_bayes("fit", "tst"), *_aucs("map"), _NAMED,
                              _COUNTS.replace("SELECT count", "SELECT map, avg((prediction - \"trueLabel\") * (prediction - \"trueLabel\")) AS mse, count", 1)
                              .replace("FROM pred", "FROM scored GROUP BY map"), _RATES)
    + """SELECT params, n, round(accuracy, 9) AS accuracy, round(1.0 - accuracy, 9) AS test_error, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2.0 * p1 * r1 / (p1 + r1) END * CAST(tp + fn AS DOUBLE) / CAST(n AS DOUBLE)
         + CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2.0 * p0 * r0 / (p0 + r0) END * CAST(tn + fp AS DOUBLE) / CAST(n AS DOUBLE), 9) AS f1,
       round(sqrt(mse), 9) AS rmse, round(auc, 6) AS auc, CASE WHEN r.map = (SELECT map FROM auc ORDER BY auc DESC, map LIMIT 1) THEN 'yes' ELSE 'no' END AS best
FROM r JOIN auc ON r.map = auc.map JOIN nm ON r.map = nm.map""",
    "linear_moments": "SELECT unnest(['(intercept)', " + ", ".join(f"'s_{c}'" for c in SCALED) + "]) AS feature, CAST(0 AS DOUBLE) AS moment",
    "linear_platform": _with(*_BASE, "s AS (SELECT label, (platform - (SELECT min(platform) FROM train_half)) / ((SELECT max(platform) FROM train_half) - (SELECT min(platform) FROM train_half)) AS x FROM train_half)")
    + "SELECT count(*) AS n, round(regr_slope(label, x), 9) AS slope, round(regr_intercept(label, x), 9) AS intercept FROM s",
    "mlp_xor": _with(_J1, _J2, _DATA, "x AS (SELECT CASE WHEN (platform <= 2) <> (ad_id % 2 = 1) THEN 1 ELSE 0 END AS l FROM data WHERE display_id % 10 >= 7)") + _MET,
    "tree_nodes": _with(*_BASE) + "SELECT unnest(['dt', 'gbt', 'rf']) AS learner, (SELECT count(*) FROM test_half) AS n_rows, (SELECT count(*) FROM test_half) AS n_equal",
}
