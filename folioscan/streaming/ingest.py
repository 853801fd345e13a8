"""The item pass over a stream of page files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from folioscan.plans.ingest import ItemOptions, ingest_batch

# Spark's name for the id that a query keeps in its checkpoint.
QUERY_ID = "sql.streaming.queryId"


def ingest_stream(
    pages: DataFrame,
    root: str,
    checkpoint: str,
    options: ItemOptions = ItemOptions(),
    assets: DataFrame | None = None,
) -> StreamingQuery:
    """Take pages until none is left, and add each micro-batch to the catalogue below ``root``.

    A micro-batch that runs twice writes the same folders again, so replays are no-ops. The folders
    carry the query's id, which lives in the checkpoint: rows of other streams and of batch loads stay,
    and count as stored. When the files arrive in ``page_id`` order the tables equal those of one batch
    over all pages. One writer at a time may add to a root.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        ingest_batch(batch, batch_id, root, options, assets, run=run)

    return (
        pages.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
