"""Scoring requests from a stream: size limit, verdict and envelope per request.

A request is the rows that share an id with no longer gap than ``gap`` between them, a session.
Once the watermark has passed its end, its size is known; the verdict is joined, stream to
stream, with the rows it counted, which wait in the join's state until then.  A row later than
the watermark belongs to no request any more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestat.operators.fitted import quoted
from lodestat.operators.scoring import score
from lodestat.operators.training import Classifier
from lodestat.operators.validation import ERROR_TYPE, REQUEST_MAX, Rule, score_envelope, trim_texts, with_errors

# Fixed value: error type of a request with too many rows.
TYPE_LARGE = "too_long"
MSG_LARGE = "request has {n} rows, at most {limit} are allowed"


def sized_requests(records: DataFrame, request: str, ts: str, gap: str = "1 minute", late: str = "1 minute",
                   longest: str = "1 hour") -> DataFrame:
    """``records`` with ``__n``, the rows of their request, and ``__closed``, its end.

    Rows wait at most ``longest``, the span within which a request must be over.
    """
    rows = records.withColumn("__ts", quoted(ts).cast("timestamp")).withWatermark("__ts", late)
    sessions = rows.groupBy(F.session_window("__ts", gap).alias("w"), quoted(request).alias("__request")).agg(F.count(F.lit(1)).alias("__n"))
    sessions = sessions.select("__request", "__n", F.col("w.start").alias("__opened"), F.window_time("w").alias("__closed"))
    # Bounds on both times let the state of the join be dropped.
    same = (quoted(request) == F.col("__request")) & (F.col("__ts") >= F.col("__opened")) & (F.col("__ts") <= F.col("__closed")) & (
        F.col("__closed") <= F.col("__ts") + F.expr(f"INTERVAL {longest}"))
    return rows.join(sessions, same).drop("__request", "__opened", "__ts")


def score_requests(
    records: DataFrame, rules: Sequence[Rule], classifier: Classifier, out: str, checkpoint: str, keep: Sequence[str],
    request: str, ts: str, limit: int = REQUEST_MAX, gap: str = "1 minute", late: str = "1 minute", longest: str = "1 hour",
    available_now: bool = True,
) -> StreamingQuery:
    """Write scored rows to ``out/scored``, rejected ones to ``out/quarantine``, and one line per request to ``out/envelopes``.

    A request of more than ``limit`` rows goes to quarantine whole.  An envelope holds the
    number of predictions, the count per class and the request's end.  Each batch owns one
    folder per sink and overwrites it, so a batch run again leaves its rows once; all rows of
    a request are in one batch.
    """
    sized = sized_requests(records, request, ts, gap, late, longest)

    def write(batch: DataFrame, number: int) -> None:
        large = F.col("__n") > limit
        message = F.concat(F.lit("request has "), F.col("__n").cast("string"), F.lit(f" rows, at most {limit} are allowed"))
        whole = F.array(F.struct(F.lit(request).alias("field"), message.alias("message"), F.lit(TYPE_LARGE).alias("type"),
                                 quoted(request).cast("string").alias("input"))).cast(ERROR_TYPE)
        checked = with_errors(batch, rules).withColumn("errors", F.when(large, whole).otherwise(F.col("errors")))
        valid = trim_texts(checked.filter(F.size("errors") == 0), rules)
        kept = list(dict.fromkeys([*keep, request, "__closed"]))
        scored = score(valid, classifier, kept)
        scored.drop("__closed", "all_probabilities").write.mode("overwrite").parquet(f"{out}/scored/batch={number}")
        checked.filter(F.size("errors") > 0).select(*[quoted(c) for c in keep], "errors").write.mode("overwrite").parquet(
            f"{out}/quarantine/batch={number}")
        ends = scored.groupBy(quoted(request).alias("request")).agg(F.max("__closed").alias("closed"))
        lines = score_envelope(scored, request, "predicted", F.lit(None).cast("timestamp")).drop("timestamp")
        lines.join(ends, "request").withColumnRenamed("closed", "timestamp").write.mode("overwrite").parquet(f"{out}/envelopes/batch={number}")

    writer = sized.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
