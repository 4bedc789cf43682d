"""Micro-batch scoring: validate, score, quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestat.operators.scoring import score
from lodestat.operators.training import Classifier
from lodestat.operators.validation import Rule, trim_texts, with_errors


def score_stream(
    records: DataFrame, rules: Sequence[Rule], classifier: Classifier, out: str, checkpoint: str,
    keep: Sequence[str], available_now: bool = True,
) -> StreamingQuery:
    """Write scored rows to ``out/scored`` and rejected rows to ``out/quarantine``.

    Each batch owns one folder per sink and overwrites it, so a batch that is
    run again after a failure leaves its rows once.  The batch is read once per
    sink; both reads are narrow, so nothing is cached.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = with_errors(batch, rules)
        valid = trim_texts(checked.filter(F.size("errors") == 0), rules)
        scored = score(valid, classifier, keep).drop("all_probabilities")
        scored.write.mode("overwrite").parquet(f"{out}/scored/batch={batch_id}")
        rejected = checked.filter(F.size("errors") > 0).select(*keep, "errors")
        rejected.write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch_id}")

    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
