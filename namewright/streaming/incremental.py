"""A micro-batch front end: new source rows are normalised, typed and resolved against the current references.

The stages are those of the batch engine; streaming adds nothing to their semantics.  Each micro-batch is a complete
run over its rows, written under its batch number, so a batch that is replayed after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from namewright.config import Settings
from namewright.operators.preprocess import exact_index, preprocess, resolve


def resolve_stream(
    rows: DataFrame,
    references: Callable[[], tuple[DataFrame, DataFrame]],
    output: str,
    checkpoint: str,
    settings: Settings | None = None,
    source_sha256: str = "0" * 64,
) -> StreamingQuery:
    """Start a query over streaming (source_row_number, nombre_original) rows.

    ``references`` is called for each micro-batch, so promotions take effect without a restart.
    """
    config = settings or Settings()

    def batch(df: DataFrame, number: int) -> None:
        index = exact_index(*references())
        resolve(preprocess(df, config, source_sha256), index).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
