"""Small frames for tests."""

from pyspark.sql import functions as F


def texts(spark, values, name="s"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"row_id long, {name} string")


def column(df, name, key="row_id"):
    return [r[name] for r in df.orderBy(key).select(f"`{name}`").collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=30_000, partitions=8):
    """A third of the rows share one label, one category and one number."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, partitions).select(
        F.col("id").alias("key"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("label"),
        F.when(hot, "same").otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("text"),
        F.when(hot, 5.0).otherwise((F.pmod(F.xxhash64("id"), F.lit(1_000_003))).cast("double") / 7).alias("x"),
    )
