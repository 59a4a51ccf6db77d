"""Row-local operators on streams, and representative rows of what a stream has brought so far."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from curaspark.functions import asciinorm, rules
from curaspark.operators import representative
from curaspark.operators.schema import quoted, renamed_in_place


def normalise(stream: DataFrame, column: str, output: str) -> DataFrame:
    """A stream with a column normalised to ASCII."""
    return renamed_in_place(stream, column, output, asciinorm.normalise(quoted(column)))


def checked(stream: DataFrame, column: str) -> DataFrame:
    """A stream with the response phrase of a column corrected, and violation, the first rule it breaks then."""
    fixed = stream.withColumn(column, rules.fix_response_phrase(quoted(column)))
    return fixed.withColumn("violation", rules.violation(quoted(column)))


def representatives(
    stream: DataFrame,
    keys: Sequence[str],
    value: Column,
    ties: Sequence[Column],
    *,
    history: str,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> StreamingQuery:
    """Medians need all rows of a group, so each batch is written to `history` (by batch number: a batch that runs again replaces
    itself), and sink gets the representatives of the groups that the batch touched."""

    def run(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{history}/batch={n}")
        so_far = spark.read.parquet(history).drop("batch")
        touched = spark.read.parquet(f"{history}/batch={n}").select(*[quoted(k) for k in keys]).distinct()
        on = None
        for i, k in enumerate(keys):
            touched = touched.withColumnRenamed(k, f"__{i}")
            same = quoted(k).eqNullSafe(touched[f"__{i}"])
            on = same if on is None else on & same
        sink(representative.medoids(so_far.join(touched, on, "left_semi"), keys, value, ties), n)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
