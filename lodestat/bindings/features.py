"""Scaling, encoding, label maps, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.bindings.registry import NUMERIC, ORDERS_FEAT, PRIORITIES, orders_feat, query, r6, table, with_ctes
from lodestat.operators import encoding, sampling
from lodestat.operators.wide import spread_rows

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
STATUSES = ["F", "O", "P"]


def _scaled(c: str, source: str = "orders_feat") -> str:
    return (f"round(({c} - (SELECT avg({c}) FROM {source})) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 "
            f"ELSE stddev_pop({c}) END FROM {source}), 6) AS {c}")


def _hot(c: str, values: list[str]) -> str:
    return ", ".join(f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"{c}_{v}\"" for v in values)


@query("standard_scale", """SELECT l_orderkey, l_linenumber, """ + ", ".join(
    _scaled(c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount")) + " FROM lineitem")
def standard_scale(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    scaled = encoding.fit_scaler(df, names).transform(df)
    return scaled.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in names])


@query("one_hot_columns", f"SELECT c_custkey, {_hot('c_mktsegment', SEGMENTS)} FROM customer")
def one_hot_columns(spark, sf):
    return encoding.one_hot_columns(table(spark, sf, "customer"), ["c_mktsegment"], ["c_custkey"])


@query("preprocess_advanced", with_ctes(ORDERS_FEAT) + f"""SELECT o_orderkey, {_scaled('o_totalprice')},
  {_scaled('c_acctbal')}, {_hot('o_orderstatus', STATUSES)}, {_hot('c_mktsegment', SEGMENTS)} FROM orders_feat""")
def preprocess_advanced(spark, sf):
    out = encoding.preprocess_advanced(
        orders_feat(spark, sf), NUMERIC, ["o_orderstatus", "c_mktsegment"], 0, keep=["o_orderkey"])
    return out.select(*[r6(c).alias(c) if c in NUMERIC else F.col(f"`{c}`") for c in out.columns])


@query("preprocess_for_training", with_ctes(ORDERS_FEAT) + f"""SELECT o_totalprice, c_acctbal,
  {_hot('o_orderstatus', STATUSES)}, o_orderkey, o_orderpriority FROM orders_feat""")
def preprocess_for_training(spark, sf):
    df = orders_feat(spark, sf).select("o_orderkey", "o_orderpriority", "o_orderstatus", *NUMERIC)
    return encoding.preprocess_for_training(df, NUMERIC, ["o_orderstatus"])


@query("pca")
def pca(spark, sf):
    """Three components of the full embedding width."""
    df = table(spark, sf, "embeddings")
    vector = F.transform("embedding", lambda x: x.cast("double"))
    width = df.select(F.max(F.size("embedding")).alias("w")).first()["w"]
    parts = encoding.fit_components(df, vector, [f"e{i}" for i in range(width)], 3)
    return df.select("vec_id", *[r6(c).alias(f"PC{i + 1}") for i, c in enumerate(parts.columns(vector))])


@query("pca_pair", """WITH m AS (SELECT avg(c_acctbal) AS mx, avg(c_nationkey) AS my, var_samp(c_acctbal) AS a,
  var_samp(c_nationkey) AS c, covar_samp(c_acctbal, c_nationkey) AS b FROM customer),
e AS (SELECT *, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l FROM m),
v AS (SELECT *, (l - c) / sqrt((l - c) * (l - c) + b * b) AS vx, b / sqrt((l - c) * (l - c) + b * b) AS vy FROM e)
SELECT c_custkey, round((c_acctbal - mx) * vx + (c_nationkey - my) * vy, 6) AS "PC1",
  round((c_nationkey - my) * vx - (c_acctbal - mx) * vy, 6) AS "PC2" FROM customer, v""")
def pca_pair(spark, sf):
    """Components of two columns, which have a closed form."""
    df = table(spark, sf, "customer")
    vector = F.array(F.col("c_acctbal"), F.col("c_nationkey").cast("double"))
    parts = encoding.fit_components(df, vector, ["c_acctbal", "c_nationkey"], 2)
    return df.select("c_custkey", *[r6(c).alias(f"PC{i + 1}") for i, c in enumerate(parts.columns(vector))])


@query("pca_wide", """WITH m AS (SELECT avg(c_acctbal / 1000) AS mx, avg(c_nationkey) AS my, var_samp(c_acctbal / 1000) AS a,
  var_samp(c_nationkey) AS c, covar_samp(c_acctbal / 1000, c_nationkey) AS b FROM customer),
e AS (SELECT *, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l FROM m),
u AS (SELECT *, b / sqrt((l - a) * (l - a) + b * b) AS x, (l - a) / sqrt((l - a) * (l - a) + b * b) AS y FROM e),
v AS (SELECT *, CASE WHEN abs(x) > abs(y) THEN sign(x) ELSE sign(y) END AS s1, CASE WHEN abs(x) > abs(y) THEN -sign(y) * sign(x) * sign(y) ELSE sign(y) * sign(x) * sign(x) END AS s2 FROM u)
SELECT c_custkey, round(s1 * ((c_acctbal / 1000 - mx) * x + (c_nationkey - my) * y), 6) AS "PC1",
  round(abs((c_acctbal / 1000 - mx) * y - (c_nationkey - my) * x), 6) AS "PC2" FROM customer, v""")
def pca_wide(spark, sf):
    """Components of 300 columns by the randomised search: two columns spread over 150 each keep their closed form (PC2 without its sign)."""
    df = table(spark, sf, "customer")
    share = 150 ** -0.5
    vector = F.concat(F.array_repeat(F.col("c_acctbal").cast("double") / 1000 * share, 150), F.array_repeat(F.col("c_nationkey").cast("double") * share, 150))
    parts = encoding.fit_components(df, vector, [f"v{i}" for i in range(300)], 2)
    first, second = parts.columns(vector)
    return spread_rows(df).select("c_custkey", r6(first).alias("PC1"), r6(F.abs(second)).alias("PC2"))


@query("preprocess_pca")
def preprocess_pca(spark, sf):
    out = encoding.preprocess_advanced(
        orders_feat(spark, sf), NUMERIC, ["o_orderstatus", "c_mktsegment"], 3, keep=["o_orderkey"])
    return out.select("o_orderkey", "PC1", "PC2", "PC3")


@query("one_hot_vector", """SELECT doc_id, (CASE WHEN doc_id % 6 <> 0 AND lang IS NOT NULL THEN 1.0 ELSE 0.0 END
  + CASE WHEN source IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS n_set FROM documents""")
def one_hot_vector(spark, sf):
    """The sparse training vector, as the number of set flags per row; a missing value sets none."""
    from pyspark.ml.functions import vector_to_array

    df = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 6 != 0, F.col("lang")).alias("lang"), "source")
    shown = encoding.feature_model(df, ["lang", "source"]).transform(df)
    return shown.select("doc_id", F.aggregate(
        vector_to_array("features"), F.lit(0.0), lambda a, x: a + x).alias("n_set"))


_CODES = "codes AS (SELECT label, (row_number() OVER (ORDER BY label) - 1)::INT AS label_id FROM (SELECT DISTINCT p_brand AS label FROM part))"


@query("label_encode", with_ctes(_CODES) + "SELECT p_partkey, p_brand, label_id FROM part JOIN codes ON label = p_brand")
def label_encode(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_brand")
    return encoding.encode_labels(df, "p_brand", encoding.label_map(df, "p_brand"))


@query("label_decode", with_ctes(_CODES) + """SELECT p_partkey, label AS predicted
  FROM part JOIN codes ON label_id = p_partkey % 25""")
def label_decode(spark, sf):
    df = table(spark, sf, "part")
    guesses = df.select("p_partkey", (F.col("p_partkey") % 25).cast("int").alias("guess"))
    return encoding.decode_labels(guesses, "guess", encoding.label_map(df, "p_brand"), "predicted").filter(
        F.col("predicted").isNotNull()).select("p_partkey", "predicted")


@query("ordinal_encode", """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1
  WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 END AS label_id FROM orders""")
def ordinal_encode(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("\t")).alias("priority"))
    order = [p.lower() for p in reversed(PRIORITIES)]
    return encoding.encode_ordinal(df, "priority", order).select("o_orderkey", "label_id")


# ---------------------------------------------------------------- splits
SPLIT = """sizes AS (SELECT o_orderpriority AS grp, count(*) AS n FROM orders GROUP BY 1),
total AS (SELECT sum(n)::BIGINT AS n, ceil(sum(n) * 2 / 10.0)::BIGINT AS n_test FROM sizes),
parts AS (SELECT grp, s.n * n_test // total.n AS base, s.n * n_test % total.n AS rest
  FROM sizes s, total),
placed AS (SELECT *, row_number() OVER (ORDER BY rest DESC, grp) AS place FROM parts),
quotas AS (SELECT grp, base + CASE WHEN place <= (SELECT n_test FROM total) - (SELECT sum(base) FROM parts)
  THEN 1 ELSE 0 END AS quota FROM placed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
  ORDER BY md5(o_orderkey::VARCHAR || '|42')) AS rn FROM orders),
split AS (SELECT ranked.*, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN quotas ON grp = o_orderpriority)"""


@query("stratified_split", with_ctes(SPLIT) + "SELECT o_orderkey, o_orderpriority, split FROM split")
def stratified_split(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.stratified_split(df, ["o_orderkey"], "o_orderpriority")


@query("holdout_semi_join", with_ctes(SPLIT) + """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
  WHERE o_orderkey IN (SELECT o_orderkey FROM split WHERE split = 'test')""")
def holdout_semi_join(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    split = sampling.stratified_split(df, ["o_orderkey"], "o_orderpriority")
    other = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sampling.holdout_rows(other, split, ["o_orderkey"])


@query("kfold_assign", """SELECT o_orderkey, o_orderpriority, (ntile(5) OVER (
  PARTITION BY o_orderpriority ORDER BY md5(o_orderkey::VARCHAR || '|42')) - 1)::INT AS fold FROM orders""")
def kfold_assign(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.stratified_folds(df, ["o_orderkey"], "o_orderpriority", 5)


@query("seeded_sample", """SELECT l_orderkey, l_linenumber, l_quantity FROM (
  SELECT *, md5(l_orderkey::VARCHAR || '|' || l_partkey::VARCHAR || '|' || l_suppkey::VARCHAR || '|' || l_linenumber::VARCHAR
    || '|' || l_extendedprice::VARCHAR || '|42') AS h FROM lineitem)
  QUALIFY row_number() OVER (ORDER BY h) <= (SELECT count(*) * 3 // 10 FROM lineitem)""")
def seeded_sample(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return sampling.seeded_sample(table(spark, sf, "lineitem"), keys, 0.3).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("split_shares", with_ctes(SPLIT) + """SELECT split, o_orderpriority AS class, count(*) AS n,
  round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY split), 6) AS share FROM split GROUP BY 1, 2""")
def split_shares(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    split = sampling.stratified_split(df, ["o_orderkey"], "o_orderpriority")
    return sampling.split_shares(split, "split", "o_orderpriority").withColumn("share", r6("share"))
