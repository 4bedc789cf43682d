"""Model fitting, search, scoring and streaming over the driver tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lodestat.bindings.drift import DAYS, event_sides, with_outages
from lodestat.bindings.features import SPLIT
from lodestat.bindings.registry import (
    FEATURES, NUMERIC, ORDERS_FEAT, PRIORITIES, docs_labeled, orders_feat, query, r6, table, union_all, with_ctes,
)
from lodestat.bindings.validation import ERRORS, RECORD_COLUMNS, RULES, records
from lodestat.operators import training as m
from lodestat.operators.calibration import calibrate
from lodestat.operators.drift import Draw, DriftPlan, Force, inject_drift
from lodestat.operators.evaluation import class_report
from lodestat.operators.kernels import PolynomialMap, RbfMap
from lodestat.operators.outofbag import fit_out_of_bag, tree_weight
from lodestat.operators.sampling import stratified_folds
from lodestat.operators.scoring import evaluate, score
from lodestat.plans.drift import drift_report
from lodestat.plans.train import refit, search, search_ordinal, train, train_ordinal
from lodestat.session import materialize, scratch_path
from lodestat.sources.models import choose_classifier, load_classifier, save_classifier
from lodestat.streaming.drift import count_windows, monitor
from lodestat.streaming.replay import BATCH_FILES, write_in_order
from lodestat.streaming.requests import sized_requests
from lodestat.streaming.scoring import score_stream

SMALL_FOREST = {"numTrees": 5, "maxDepth": 5}
#: Rows of a task that carries mapped vectors, 32 KB each.
MAPPED_ROWS = 1024


def vectors(spark, sf):
    """Embeddings as numeric columns: the dense training table."""
    df = table(spark, sf, "embeddings")
    width = df.select(F.max(F.size("embedding")).alias("w")).first()["w"]
    names = [f"e{i}" for i in range(width)]
    return df.select("vec_id", F.col("label").cast("string").alias("target"),
                     *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(names)]), names


def _status_model(df):
    names = ["o_orderpriority", "c_mktsegment", "r_name"]
    return m.fit_classifier(df, "o_orderstatus", names, NUMERIC, m.forest(**SMALL_FOREST))


@query("rf_classifier")
def rf_classifier(spark, sf):
    df, names = vectors(spark, sf)
    return train(df, ["vec_id"], "target", [], names, m.forest(**SMALL_FOREST)).metrics


@query("rf_report")
def rf_report(spark, sf):
    out = train(orders_feat(spark, sf), ["o_orderkey"], "o_orderpriority", FEATURES, NUMERIC, m.forest(**SMALL_FOREST))
    return class_report(out.counts)


@query("rf_ordinal")
def rf_ordinal(spark, sf):
    order = [p.lower() for p in reversed(PRIORITIES)]
    _, metrics = train_ordinal(
        orders_feat(spark, sf), ["o_orderkey"], "o_orderpriority", order, FEATURES, NUMERIC,
        m.ordinal_forest(**SMALL_FOREST))
    return metrics


# A single tree with one split and without resampling has an exact answer: the
# flag with the largest gain, and class shares or means on its two sides.
_FLAGS = "flags AS (" + union_all([
    f"SELECT o_orderkey, o_orderstatus, o_orderpriority, '{c}' || {c} AS flag_name, {c} AS value, '{c}' AS col FROM orders_feat"
    for c in ("c_mktsegment", "o_orderpriority")]) + ")"
_STUMP = ORDERS_FEAT + ", " + _FLAGS + """,
total AS (SELECT o_orderstatus AS y, count(*)::DOUBLE AS n FROM orders_feat GROUP BY 1),
sides AS (SELECT f.flag_name, t.y, count(o_orderkey)::DOUBLE AS a, any_value(t.n) - count(o_orderkey) AS b
  FROM (SELECT DISTINCT flag_name FROM flags) f CROSS JOIN total t
  LEFT JOIN flags ON flags.flag_name = f.flag_name AND flags.o_orderstatus = t.y GROUP BY 1, 2),
gains AS (SELECT flag_name, sum(a * a) / sum(a) + sum(b * b) / sum(b) AS purity FROM sides GROUP BY 1),
best AS (SELECT flag_name FROM gains ORDER BY purity DESC LIMIT 1),
leaves AS (SELECT true AS has, y, a / sum(a) OVER () AS p FROM sides JOIN best USING (flag_name)
  UNION ALL SELECT false, y, b / sum(b) OVER () FROM sides JOIN best USING (flag_name)),
winners AS (SELECT has, max_by(y, p) AS predicted, max(p) AS confidence, sum(p) AS total FROM leaves GROUP BY has),
marked AS (SELECT o_orderkey, bool_or(flag_name = (SELECT flag_name FROM best)) AS has FROM flags GROUP BY 1)"""


@query("tree_scoring", with_ctes(_STUMP) + """SELECT o_orderkey, predicted, round(confidence, 6) AS confidence,
  round(total, 6) AS total FROM marked JOIN winners USING (has)""")
def tree_scoring(spark, sf):
    """Fit one split, then score every row with class, probability and probability map."""
    df = orders_feat(spark, sf)
    one = m.forest(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")
    fitted = m.fit_classifier(df, "o_orderstatus", ["c_mktsegment", "o_orderpriority"], [], one)
    scored = score(df, fitted, ["o_orderkey"])
    total = F.aggregate(F.map_values("all_probabilities"), F.lit(0.0), lambda a, x: a + x)
    return scored.select("o_orderkey", "predicted", r6("confidence").alias("confidence"), r6(total).alias("total"))


@query("score_dirty", with_ctes(_STUMP) + "SELECT o_orderkey, predicted, round(confidence, 6) AS confidence FROM marked JOIN winners USING (has)")
def score_dirty(spark, sf):
    """Records in capitals, padded and under an alias get the class of the clean record."""
    df = orders_feat(spark, sf)
    one = m.forest(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")
    step = m.CleanStep(["c_mktsegment", "o_orderpriority"], [], {"o_orderpriority": ["priority"]})
    fitted = m.fit_classifier(df, "o_orderstatus", ["c_mktsegment", "o_orderpriority"], [], one, step)
    path = save_classifier(fitted, scratch_path(spark, "model"))
    dirty = df.select("o_orderkey", F.concat(F.lit("  "), F.upper("c_mktsegment"), F.lit(" ")).alias("c_mktsegment"),
                      F.concat(F.initcap("o_orderpriority"), F.lit("\t")).alias("priority"))
    scored = score(dirty, load_classifier(spark, path), ["o_orderkey"])
    return scored.select("o_orderkey", "predicted", r6("confidence").alias("confidence"))


@query("tree_ordinal", with_ctes(ORDERS_FEAT) + """, coded AS (
  SELECT o_orderkey, c_mktsegment, 5 - substr(o_orderpriority, 1, 1)::INT AS y FROM orders_feat),
gains AS (SELECT s.v, sum(y) FILTER (c_mktsegment = s.v) ** 2::DOUBLE / count(*) FILTER (c_mktsegment = s.v)
    + sum(y) FILTER (c_mktsegment <> s.v) ** 2::DOUBLE / count(*) FILTER (c_mktsegment <> s.v) AS purity
  FROM coded CROSS JOIN (SELECT DISTINCT c_mktsegment AS v FROM coded) s GROUP BY 1),
best AS (SELECT v FROM gains ORDER BY purity DESC LIMIT 1)
SELECT o_orderkey, round(avg(y) OVER (PARTITION BY c_mktsegment = (SELECT v FROM best)), 6) AS prediction FROM coded""")
def tree_ordinal(spark, sf):
    """One regression split on the ordinal label, applied to every row."""
    df = orders_feat(spark, sf)
    one = m.ordinal_forest(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")
    order = [p.lower() for p in reversed(PRIORITIES)]
    fitted = m.fit_ordinal(df, "o_orderpriority", order, ["c_mktsegment"], [], one)
    return fitted.predict(df).select("o_orderkey", r6("prediction").alias("prediction"))


@query("gbt_classifier")
def gbt_classifier(spark, sf):
    df = docs_labeled(spark, sf).filter("quality IS NOT NULL").withColumn("target", F.col("quality").cast("string"))
    return train(df, ["doc_id"], "target", ["lang", "source"], ["n_chars"], m.boosting(maxIter=3, maxDepth=3)).metrics


@query("svc_classifier")
def svc_classifier(spark, sf):
    df = docs_labeled(spark, sf).filter("quality IS NOT NULL").withColumn("target", F.col("quality").cast("string"))
    return train(df, ["doc_id"], "target", ["lang", "source"], ["n_chars"], m.support_vectors(C=10, components=64, maxIter=5)).metrics


# One round of one-split trees: for each class the flag that parts it best, a Newton step on both sides, softmax.
_ROUND = ORDERS_FEAT + ", " + _FLAGS + """,
folded AS (SELECT o_orderkey, o_orderstatus, ntile(3) OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || '|42')) - 1 AS fold
  FROM orders_feat),
fit AS (SELECT * FROM folded WHERE {rows}),
share AS (SELECT o_orderstatus AS y, count(*)::DOUBLE AS n_y, sum(count(*)) OVER ()::DOUBLE AS n FROM fit GROUP BY 1),
inside AS (SELECT flag_name, f.o_orderstatus AS y, count(*)::DOUBLE AS a_y FROM flags JOIN fit f USING (o_orderkey) GROUP BY ALL),
size AS (SELECT flag_name, sum(a_y) AS a FROM inside GROUP BY 1),
split AS (SELECT s.y, z.flag_name, n, n_y, a, coalesce(a_y, 0) AS a_y FROM share s CROSS JOIN size z
  LEFT JOIN inside i ON i.flag_name = z.flag_name AND i.y = s.y),
best AS (SELECT y, n_y / n AS p, a_y / a AS with_flag, (n_y - a_y) / (n - a) AS without_flag, flag_name FROM split
  QUALIFY row_number() OVER (PARTITION BY y ORDER BY a_y * a_y / a + (n_y - a_y) ** 2 / (n - a) DESC) = 1),
marked AS (SELECT o_orderkey, y, bool_or(flags.flag_name = best.flag_name) AS has, any_value(p) AS p,
  any_value(with_flag) AS with_flag, any_value(without_flag) AS without_flag FROM flags CROSS JOIN best GROUP BY o_orderkey, y),
margins AS (SELECT o_orderkey, y, has, ln(p) + 0.1 * 2 / 3 * (CASE WHEN has THEN with_flag ELSE without_flag END - p) / (p * (1 - p)) AS margin
  FROM marked)"""


def _one_round(df):
    return m.fit_classifier(df, "o_orderstatus", ["c_mktsegment", "o_orderpriority"], [], m.boosting(maxIter=1, maxDepth=1))


@query("boosting_round", with_ctes(_ROUND.format(rows="true")) + """, shares AS (
  SELECT o_orderkey, y, exp(margin) / sum(exp(margin)) OVER (PARTITION BY o_orderkey) AS p FROM margins)
SELECT o_orderkey, max_by(y, p) AS predicted, round(max(p), 6) AS confidence, round(sum(p), 6) AS total FROM shares GROUP BY 1""")
def boosting_round(spark, sf):
    """The first round of the softmax model, applied to every row."""
    df = orders_feat(spark, sf)
    scored = score(df, _one_round(df), ["o_orderkey"])
    total = F.aggregate(F.map_values("all_probabilities"), F.lit(0.0), lambda a, x: a + x)
    return scored.select("o_orderkey", "predicted", r6("confidence").alias("confidence"), r6(total).alias("total"))


@query("calibrated_confidence", with_ctes(_ROUND.format(rows="fold <> 0")) + """, held AS (
  SELECT y, has, any_value(margin) AS margin, count(*)::DOUBLE AS n, count(*) FILTER (o_orderstatus = y)::DOUBLE AS hits
  FROM margins JOIN folded USING (o_orderkey) WHERE fold = 0 GROUP BY y, has),
steps AS (SELECT y, has, CASE WHEN coalesce(hits / n < lag(hits / n) OVER w, false) OR coalesce(hits / n > lead(hits / n) OVER w, false)
  THEN sum(hits) OVER (PARTITION BY y) / sum(n) OVER (PARTITION BY y) ELSE hits / n END AS step FROM held WINDOW w AS (PARTITION BY y ORDER BY margin)),
shares AS (SELECT o_orderkey, y, margin, step / sum(step) OVER (PARTITION BY o_orderkey) AS p FROM margins JOIN steps USING (y, has))
SELECT o_orderkey, max_by(y, margin) AS predicted, round(max_by(p, margin), 6) AS confidence FROM shares GROUP BY 1""")
def calibrated_confidence(spark, sf):
    """Margins of a model fitted without one fold, calibrated on that fold by pooling neighbours out of order."""
    folded = materialize(stratified_folds(orders_feat(spark, sf), ["o_orderkey"], "o_orderstatus", 3), "folded")
    fitted = calibrate(_one_round(folded.filter("fold <> 0")), folded.filter("fold = 0"))
    return score(folded, fitted, ["o_orderkey"]).select("o_orderkey", "predicted", r6("confidence").alias("confidence"))


_BAGS = ORDERS_FEAT + ", " + _FLAGS + """,
limits AS (SELECT list_transform(range(0, 16), lambda k: list_sum(list_transform(range(0, k + 1), lambda j: exp(-1) / factorial(j::INT)))) AS l),
draws AS (SELECT o_orderkey, o_orderstatus, t, len(list_filter(l, lambda c: c <= ('0x' || substr(md5(o_orderkey::VARCHAR || '|888|' || t::VARCHAR), 1, 12))::BIGINT
    / 281474976710656.0::DOUBLE)) AS w FROM orders_feat CROSS JOIN (SELECT unnest(range(0, 4)) AS t) CROSS JOIN limits)"""


@query("poisson_weights", with_ctes(_BAGS) + "SELECT t::INT AS tree, w::INT AS weight, count(*) AS n FROM draws GROUP BY 1, 2")
def poisson_weights(spark, sf):
    """How often rows are in the samples of four trees."""
    df = orders_feat(spark, sf).select("o_orderkey")
    weights = df.select(F.array(*[tree_weight(["o_orderkey"], 888, t) for t in range(4)]).alias("w")).select(F.posexplode("w").alias("tree", "weight"))
    return weights.groupBy("tree", "weight").agg(F.count(F.lit(1)).alias("n"))


@query("out_of_bag_score", with_ctes(_BAGS) + """,
total AS (SELECT t, o_orderstatus AS y, sum(w)::DOUBLE AS n FROM draws GROUP BY ALL),
inside AS (SELECT t, flag_name, d.o_orderstatus AS y, sum(w)::DOUBLE AS a FROM draws d JOIN flags USING (o_orderkey) GROUP BY ALL),
sides AS (SELECT x.t, g.flag_name, x.y, coalesce(a, 0) AS a, n - coalesce(a, 0) AS b FROM total x CROSS JOIN (SELECT DISTINCT flag_name FROM flags) g
  LEFT JOIN inside i ON i.t = x.t AND i.flag_name = g.flag_name AND i.y = x.y),
best AS (SELECT t, flag_name FROM sides GROUP BY t, flag_name
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY sum(a * a) / sum(a) + sum(b * b) / sum(b) DESC) = 1),
parted AS (SELECT t, y, a, b, max_by(y, a) OVER (PARTITION BY t) = max_by(y, b) OVER (PARTITION BY t) AS same FROM sides JOIN best USING (t, flag_name)),
leaves AS (SELECT t, y, CASE WHEN same THEN (a + b) / sum(a + b) OVER (PARTITION BY t) ELSE a / sum(a) OVER (PARTITION BY t) END AS pa,
  CASE WHEN same THEN (a + b) / sum(a + b) OVER (PARTITION BY t) ELSE b / sum(b) OVER (PARTITION BY t) END AS pb FROM parted),
marked AS (SELECT o_orderkey, t, bool_or(flags.flag_name = best.flag_name) AS has FROM flags CROSS JOIN best GROUP BY ALL),
votes AS (SELECT o_orderkey, any_value(d.o_orderstatus) AS label, y, sum(CASE WHEN has THEN pa ELSE pb END) AS v
  FROM draws d JOIN marked USING (o_orderkey, t) JOIN leaves USING (t) WHERE w = 0 GROUP BY o_orderkey, y),
shown AS (SELECT o_orderkey, any_value(label) AS label, max_by(y, v) AS predicted FROM votes GROUP BY 1)
SELECT count(*) AS n, (SELECT count(*) FROM orders_feat) - count(*) AS n_without,
  round(count(*) FILTER (label = predicted)::DOUBLE / count(*), 6) AS accuracy FROM shown""")
def out_of_bag_score(spark, sf):
    """Every row scored by those of four one-split trees whose sample lacks it.

    A split whose sides have the same best class is taken back.
    """
    found = fit_out_of_bag(orders_feat(spark, sf), ["o_orderkey"], "o_orderstatus", ["c_mktsegment", "o_orderpriority"], seed=888,
                           numTrees=4, maxDepth=1, featureSubsetStrategy="all")
    return found.metrics.select("n", "n_without", r6("accuracy").alias("accuracy"))


@query("kernel_features", """WITH pairs AS (SELECT a.vec_id, a.embedding AS x, b.embedding AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
SELECT vec_id, round(exp(-0.5 * list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i]::DOUBLE - y[i]) ** 2))), 6) AS rbf,
  true AS rbf_near, round((0.5 * list_sum(list_transform(range(1, len(x) + 1), lambda i: x[i]::DOUBLE * y[i]))) ** 2, 6) AS poly, true AS poly_near FROM pairs""")
def kernel_features(spark, sf):
    """Kernels of neighbouring vectors, and whether the mapped vectors' inner products come near them."""
    df = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    seen = df.select(F.max(F.size("e")).alias("w"), F.count(F.lit(1)).alias("n")).first()
    other = df.select((F.col("vec_id") - 1).alias("vec_id"), F.col("e").alias("e2"))
    # The given vectors are joined and dealt out, then mapped: a mapped one is many times as long and never leaves its task.
    tasks = -(-max(seen["n"], 1) // MAPPED_ROWS)
    pairs = df.join(other, "vec_id")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    far = F.aggregate(F.zip_with("e", "e2", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x)
    pairs = pairs.withColumns({"x": array_to_vector("e"), "x2": array_to_vector("e2"), "rbf": F.exp(-0.5 * far), "poly": F.pow(0.5 * dot("e", "e2"), 2)})
    common = {"gamma": 0.5, "width": seen["w"], "components": 4096}

    def near(rows, kind, kernel, **own):  # both sides of one map at a time, as each holds a Python worker of its task
        names, rows = rows.columns, rows.repartition(tasks)
        for side in ("", "2"):
            rows = kind(inputCol=f"x{side}", outputCol=f"mapped{side}", **own, **common).transform(rows)
        inner = dot(vector_to_array("mapped"), vector_to_array("mapped2"))
        return materialize(rows.select(*names, (F.abs(inner - F.col(kernel)) < 0.1).alias(f"{kernel}_near")), "mapped")

    found = near(near(pairs, RbfMap, "rbf"), PolynomialMap, "poly", degree=2)
    return found.select("vec_id", r6("rbf").alias("rbf"), "rbf_near", r6("poly").alias("poly"), "poly_near")


@query("grid_search")
def grid_search(spark, sf):
    combos = m.combinations_of({"numTrees": [3, 5], "maxDepth": [3, 5]})
    summary, _ = search(orders_feat(spark, sf), ["o_orderkey"], "o_orderpriority", FEATURES, NUMERIC, combos)
    return summary


@query("refit_combinations")
def refit_combinations(spark, sf):
    """Boosting grid compared on the holdout, each combination refitted on all training rows."""
    df = docs_labeled(spark, sf).filter("quality IS NOT NULL").withColumn("target", F.col("quality").cast("string"))
    combos = m.combinations_of({"stepSize": [0.1, 0.2], "maxIter": [2]})
    return refit(df, ["doc_id"], "target", ["lang", "source"], ["n_chars"], combos, m.boosting)


@query("grid_search_ordinal")
def grid_search_ordinal(spark, sf):
    combos = m.combinations_of({"numTrees": [3], "maxDepth": [3, 5]})
    order = [p.lower() for p in reversed(PRIORITIES)]
    _, best = search_ordinal(orders_feat(spark, sf), ["o_orderkey"], "o_orderpriority", order, FEATURES, NUMERIC, combos)
    return best


@query("batch_scoring")
def batch_scoring(spark, sf):
    scored = score(orders_feat(spark, sf), _status_model(orders_feat(spark, sf)), ["o_orderkey"])
    total = F.aggregate(F.map_values("all_probabilities"), F.lit(0.0), lambda a, x: a + x)
    return scored.select("o_orderkey", "predicted", r6("confidence").alias("confidence"), r6(total).alias("total"))


def _tree(df):
    one = m.forest(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")
    return m.fit_classifier(df, "o_orderstatus", ["c_mktsegment", "o_orderpriority"], [], one)


_SCORED = _STUMP + """, scored AS (SELECT o_orderkey, predicted, o_orderstatus AS label
  FROM marked JOIN winners USING (has) JOIN orders_feat USING (o_orderkey)),
cells AS (SELECT label, predicted, count(*) AS n FROM scored GROUP BY ALL),
classes AS (SELECT class, sum(s)::BIGINT AS support, sum(p)::BIGINT AS predicted, sum(h)::BIGINT AS hits FROM (
    SELECT label AS class, n AS s, 0 AS p, CASE WHEN label = predicted THEN n ELSE 0 END AS h FROM cells
    UNION ALL SELECT predicted, 0, n, 0 FROM cells) GROUP BY class)"""


@query("saved_model_accuracy", with_ctes(_SCORED) + """SELECT round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy,
  round(sum(support * coalesce(2 * hits::DOUBLE / nullif(predicted + support, 0), 0)) / sum(support), 6) AS f1_weighted,
  sum(support)::BIGINT AS n, CAST(0 AS BIGINT) AS n_unknown FROM classes""")
def saved_model_accuracy(spark, sf):
    """A model saved, loaded again and evaluated with its own labels."""
    df = orders_feat(spark, sf)
    path = save_classifier(_tree(df), scratch_path(spark, "model"))
    found = evaluate(df, load_classifier(spark, path))
    return found.select(r6("accuracy").alias("accuracy"), r6("f1_weighted").alias("f1_weighted"), "n", "n_unknown")


@query("model_choice", with_ctes(_SCORED) + "SELECT predicted, count(*) AS n FROM scored GROUP BY 1")
def model_choice(spark, sf):
    """No model at the local path: the newest run with a model is loaded and scores the table."""
    df = orders_feat(spark, sf)
    path = save_classifier(_tree(df), scratch_path(spark, "run-model"))
    runs = table(spark, sf, "events").groupBy(F.col("event_type").alias("experiment"), F.col("user_id").cast("string").alias(
        "run_id")).agg(F.max("event_id").alias("end_time")).withColumn("has_model", F.lit(True)).withColumn(
        "model_path", F.lit(path))
    chosen = choose_classifier(spark, scratch_path(spark, "nothing-here"), runs, priority=["purchase", "view"])
    return score(df, chosen, ["o_orderkey"]).groupBy("predicted").agg(F.count(F.lit(1)).alias("n"))


# The same single split, fitted without one fold and scored on it.
_FOLD_TREES = ORDERS_FEAT + """, folded AS (SELECT o_orderkey, o_orderstatus AS y, c_mktsegment, o_orderpriority,
  ntile(3) OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || '|42')) - 1 AS fold FROM orders_feat),
flags AS (SELECT o_orderkey, y, fold, 'c_mktsegment' || c_mktsegment AS flag FROM folded
  UNION ALL SELECT o_orderkey, y, fold, 'o_orderpriority' || o_orderpriority FROM folded),
fits AS (SELECT DISTINCT fold AS f FROM folded),
totals AS (SELECT f, y, count(*)::DOUBLE AS n FROM fits JOIN folded ON fold <> f GROUP BY ALL),
inside AS (SELECT f, flag, y, count(*)::DOUBLE AS a FROM fits JOIN flags ON fold <> f GROUP BY ALL),
sides AS (SELECT t.f, g.flag, t.y, coalesce(i.a, 0) AS a, t.n - coalesce(i.a, 0) AS b
  FROM totals t CROSS JOIN (SELECT DISTINCT flag FROM flags) g
  LEFT JOIN inside i ON i.f = t.f AND i.flag = g.flag AND i.y = t.y),
gains AS (SELECT f, flag, sum(a * a) / sum(a) + sum(b * b) / sum(b) AS purity FROM sides GROUP BY ALL),
best AS (SELECT f, max_by(flag, purity) AS flag FROM gains GROUP BY f),
leaves AS (SELECT f, max_by(y, a) AS with_flag, max_by(y, b) AS without_flag FROM sides JOIN best USING (f, flag) GROUP BY f),
scored AS (SELECT f, y AS label, CASE WHEN bool_or(flags.flag = best.flag) THEN any_value(with_flag) ELSE any_value(without_flag)
  END AS predicted FROM flags JOIN best ON fold = f JOIN leaves USING (f) GROUP BY f, o_orderkey, y),
cells AS (SELECT f, label, predicted, count(*) AS n FROM scored GROUP BY ALL),
classes AS (SELECT f, class, sum(s)::DOUBLE AS support, sum(p)::DOUBLE AS predicted, sum(h)::DOUBLE AS hits FROM (
    SELECT f, label AS class, n AS s, 0 AS p, CASE WHEN label = predicted THEN n ELSE 0 END AS h FROM cells
    UNION ALL SELECT f, predicted, 0, n, 0 FROM cells) GROUP BY ALL),
scores AS (SELECT f, sum(hits) / sum(support) AS accuracy,
  sum(support * 2 * hits / (predicted + support)) / sum(support) AS f1_weighted,
  avg(2 * hits / (predicted + support)) AS f1_macro FROM classes GROUP BY f),
long AS (SELECT f, 'accuracy' AS scorer, accuracy AS score FROM scores UNION ALL SELECT f, 'f1_weighted', f1_weighted FROM scores
  UNION ALL SELECT f, 'f1_macro', f1_macro FROM scores)"""


@query("grid_search_tree", with_ctes(_FOLD_TREES) + """SELECT combo_id, scorer, round(avg(score), 6) AS mean,
  round(stddev_pop(score), 6) AS std, count(*) AS folds FROM long CROSS JOIN (SELECT unnest([0, 1])::INT AS combo_id) GROUP BY ALL""")
def grid_search_tree(spark, sf):
    """Cross-validated search over two settings that lead to the same single split."""
    build = lambda **p: m.forest(
        **{"numTrees": 1, "maxDepth": 1, "bootstrap": False, "featureSubsetStrategy": "all", **p})
    summary, _ = search(
        orders_feat(spark, sf), ["o_orderkey"], "o_orderstatus", ["c_mktsegment", "o_orderpriority"], [],
        m.combinations_of({"minInstancesPerNode": [1, 2]}), build)
    shown = summary.filter(F.col("scorer").isin("accuracy", "f1_weighted", "f1_macro"))
    return shown.select("combo_id", "scorer", r6("mean").alias("mean"), r6("std").alias("std"), "folds")


_HOLDOUT_TREE = SPLIT + """, folded AS (SELECT o_orderkey, o_orderpriority AS y, c_mktsegment, o_orderstatus, CASE split WHEN 'test' THEN 0 ELSE 1 END AS fold
  FROM split JOIN customer ON o_custkey = c_custkey),
flags AS (SELECT o_orderkey, y, fold, 'c_mktsegment' || c_mktsegment AS flag FROM folded
  UNION ALL SELECT o_orderkey, y, fold, 'o_orderstatus' || o_orderstatus FROM folded),
fits AS (SELECT 0 AS f),""" + _FOLD_TREES[_FOLD_TREES.index("\ntotals AS"):]


@query("refit_tree", with_ctes(_HOLDOUT_TREE) + """SELECT combo_id, round(accuracy, 6) AS accuracy, round(f1_weighted, 6) AS f1_weighted,
  round(f1_macro, 6) AS f1_macro FROM scores CROSS JOIN (SELECT unnest([0, 1])::INT AS combo_id)""")
def refit_tree(spark, sf):
    """Two settings that lead to the same single split, fitted on the training part and scored on the holdout."""
    build = lambda **p: m.forest(
        **{"numTrees": 1, "maxDepth": 1, "bootstrap": False, "featureSubsetStrategy": "all", **p})
    out = refit(orders_feat(spark, sf), ["o_orderkey"], "o_orderpriority", ["c_mktsegment", "o_orderstatus"], [],
                m.combinations_of({"minInstancesPerNode": [1, 2]}), build)
    return out.select("combo_id", r6("accuracy").alias("accuracy"), r6("f1_weighted").alias("f1_weighted"), r6("f1_macro").alias("f1_macro"))


@query("grid_search_ordinal_tree", with_ctes(ORDERS_FEAT) + """, folded AS (SELECT 5 - substr(o_orderpriority, 1, 1)::INT AS y, c_mktsegment AS v,
  ntile(3) OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey::VARCHAR || '|42')) - 1 AS fold FROM orders_feat),
fits AS (SELECT DISTINCT fold AS f FROM folded),
inside AS (SELECT f, v, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM fits JOIN folded ON fold <> f GROUP BY ALL),
sides AS (SELECT f, v, n, s, sum(n) OVER (PARTITION BY f) - n AS m, sum(s) OVER (PARTITION BY f) - s AS t FROM inside),
best AS (SELECT f, v, s / n AS with_flag, t / m AS without_flag FROM sides
  QUALIFY row_number() OVER (PARTITION BY f ORDER BY s * s / n + t * t / m DESC) = 1),
errors AS (SELECT f, -avg(abs(y - CASE WHEN folded.v = best.v THEN with_flag ELSE without_flag END)) AS score FROM folded JOIN best ON fold = f GROUP BY f)
SELECT combo_id, 'neg_mae' AS scorer, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, count(*) AS folds
FROM errors CROSS JOIN (SELECT unnest([0, 1])::INT AS combo_id) GROUP BY 1""")
def grid_search_ordinal_tree(spark, sf):
    """The ordinal search over two settings that lead to the same single split."""
    one = {"numTrees": 1, "maxDepth": 1, "bootstrap": False, "featureSubsetStrategy": "all"}
    order = [p.lower() for p in reversed(PRIORITIES)]
    summary, _ = search_ordinal(orders_feat(spark, sf), ["o_orderkey"], "o_orderpriority", order, ["c_mktsegment"], [],
                                [{**one, "minInstancesPerNode": n} for n in (1, 2)])
    return summary.select("combo_id", "scorer", r6("mean").alias("mean"), r6("std").alias("std"), "folds")


@query("drift_report")
def drift_report_query(spark, sf):
    """A perturbed copy of the table against the original, with a fitted model."""
    df = materialize(orders_feat(spark, sf), "feat")
    plan = DriftPlan("o_orderstatus", (
        Force("c_mktsegment", "BUILDING", 0.0, 0.4), Draw("r_name", 0.4, 0.7, smallest=2),
        Draw("o_orderpriority", 0.0, 0.5, preferred=("1-URGENT",)),
    ))
    changed = inject_drift(df.drop("o_orderdate"), ["o_orderkey"], plan)
    return drift_report(_status_model(df), df.drop("o_orderdate"), changed, ["o_orderkey"])[0]


# ---------------------------------------------------------------- streams
def event_stream(spark, sf):
    """The events table as a file stream, whether it is one file or a folder."""
    source = table(spark, sf, "events")
    return spark.readStream.schema(source.schema).parquet(f"{sf}/events.parquet*")


def _run_scoring(spark, sf) -> str:
    """Events validated and scored batch by batch; the model is fitted on the table."""
    rows = records(spark, sf).filter(F.col("kind").isNotNull()).withColumn("size", F.char_length("note")).fillna(0, ["size"])
    fitted = m.fit_classifier(rows, "kind", [], ["user_id", "size"], m.forest(numTrees=3, maxDepth=3))
    stream = event_stream(spark, sf).selectExpr(*RECORD_COLUMNS).withColumn("size", F.char_length("note"))
    out = scratch_path(spark, "scored")
    score_stream(stream, RULES, fitted, out, scratch_path(spark, "stream"), ["event_id", "kind", "note"]).awaitTermination()
    return out


@query("stream_scoring")
def stream_scoring(spark, sf):
    return spark.read.parquet(f"{_run_scoring(spark, sf)}/scored").select("event_id", "kind", "predicted", "confidence")


@query("stream_routing", with_ctes(ERRORS) + """SELECT sink, kind, count(*) AS n, sum(n_errors)::BIGINT AS n_errors FROM (
  SELECT event_id, CASE WHEN n IS NULL THEN 'scored' ELSE 'quarantine' END AS sink, kind, coalesce(n, 0) AS n_errors
  FROM records LEFT JOIN (SELECT event_id, count(*) AS n FROM errors GROUP BY 1) USING (event_id)) GROUP BY 1, 2""")
def stream_routing(spark, sf):
    """How the scoring stream divides the events between its two sinks."""
    out = _run_scoring(spark, sf)
    sinks = spark.read.parquet(f"{out}/scored").select(
        F.lit("scored").alias("sink"), "kind", F.lit(0).alias("e")
    ).unionByName(spark.read.parquet(f"{out}/quarantine").select(
        F.lit("quarantine").alias("sink"), "kind", F.size("errors").alias("e")))
    return sinks.groupBy("sink", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("e").alias("n_errors"))


_REQUESTS = """sent AS (SELECT user_id, event_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 10 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS turn FROM sent),
sized AS (SELECT *, count(*) OVER (PARTITION BY user_id, turn) AS n FROM numbered)"""


@query("stream_requests", with_ctes(_REQUESTS) + "SELECT n, count(*) AS n_rows, count(*) FILTER (n > 1)::BIGINT AS n_rejected FROM sized GROUP BY n")
def stream_requests(spark, sf):
    """Events as requests, a user's rows with no gap over ten minutes; the size of each is joined back to its rows, stream to stream."""
    source, out = scratch_path(spark, "requests"), scratch_path(spark, "sized")
    events = table(spark, sf, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    files = write_in_order(events, "ts", ["user_id", "event_id"], source)
    # A last row far ahead closes all requests before it.
    events.limit(1).select(F.lit(-1).cast("bigint").alias("user_id"), F.lit(-1).cast("bigint").alias("event_id"), F.expr("ts + INTERVAL 50 YEAR").alias("ts")).write.parquet(f"{source}/{files:06d}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", BATCH_FILES).parquet(f"{source}/*")
    sized = sized_requests(stream, "user_id", "ts", "10 minutes", "1 hour", "30 days")

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    sized.writeStream.outputMode("append").option("checkpointLocation", scratch_path(spark, "stream")).foreachBatch(write).trigger(
        availableNow=True).start().awaitTermination()
    found = spark.read.parquet(out).filter("user_id >= 0")
    return found.groupBy(F.col("__n").alias("n")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("__n") > 1).alias("n_rejected"))


@query("stream_psi_by_day", with_ctes(DAYS) + """SELECT day::VARCHAR AS day, "column", round(sum((a - e) * ln(a / e)), 6) AS psi
  FROM shares GROUP BY 1, 2""")
def stream_psi_by_day(spark, sf):
    """All days of the event stream against the first week."""
    baseline, _ = event_sides(spark, sf)
    stream = with_outages(event_stream(spark, sf)).select(
        "ts", "event_type", (F.col("user_id") % 12).cast("string").alias("user_group"))
    columns = ["event_type", "user_group"]
    out = scratch_path(spark, "windows")
    count_windows(stream, "ts", columns, out, scratch_path(spark, "stream")).awaitTermination()
    found = monitor(spark, out, baseline, columns)
    return found.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "column", r6("psi").alias("psi"))
