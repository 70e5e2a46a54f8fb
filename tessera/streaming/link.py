"""Linking of S1 records as they arrive: each micro-batch is linked against the pool and both outputs are written by batch id."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.plans.pipeline import link, records


def stream_links(source: DataFrame, pool: DataFrame, model: PipelineModel, threshold: float, out: str, checkpoint: str, k: int = 15, index: str | None = None) -> StreamingQuery:
    """Starts the query over a stream of source records. With `index`, a folder, the pool's token index is built once, not for each batch. A repeated batch overwrites its own folder, so both outputs are exactly once."""

    def write(batch: DataFrame, number: int) -> None:
        matches, cands = link(records(batch), pool, model, threshold, k, index=index)
        matches.write.mode("overwrite").parquet(f"{out}/matches/batch={number}")
        cands.write.mode("overwrite").parquet(f"{out}/candidates/batch={number}")

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
