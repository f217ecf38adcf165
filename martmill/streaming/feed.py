"""The incremental loads as sinks of a stream.

A batch that is delivered twice after a failure gives the same table: upserts and replaced periods by what they do,
additions because every batch has a partition of its own, which its second try overwrites.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martmill.operators.incremental import PeriodTable, insert_overwrite


def drain(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything the source has now, batch by batch, then stop."""
    query = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def feed_periods(stream: DataFrame, table: PeriodTable, order: Sequence[str], checkpoint: str) -> None:
    """Upsert into a table by period; the greatest ``order`` wins within a batch. Rows with a NULL key are inserted, once more
    if their batch is delivered again."""
    drain(stream, lambda batch, _: table.upsert(batch, order=order), checkpoint)


def feed_replace(stream: DataFrame, table: PeriodTable, checkpoint: str) -> None:
    """Replace every period a batch mentions; for sources that deliver whole periods."""
    drain(stream, lambda batch, _: table.replace_mentioned(batch), checkpoint)


def feed_append(stream: DataFrame, name: str, batch_column: str, checkpoint: str, source: str, location: str | None = None) -> None:
    """Add each batch once to the table ``name``, marked with its stream and number.

    ``source`` names the stream among those that feed the table; it is a column of the table, as the batch's number is. A stream
    with a new checkpoint delivers its source again from the start and numbers from 0: call ``forget_stream`` first.
    """

    def load(batch: DataFrame, number: int) -> None:
        marked = batch.withColumn("stream", F.lit(source)).withColumn(batch_column, F.lit(number).cast("bigint"))
        insert_overwrite(marked, name, ["stream", batch_column], location)

    drain(stream, load, checkpoint)
    if stream.sparkSession.catalog.tableExists(name):
        stream.sparkSession.catalog.refreshTable(name)  # loaded by the stream's own session


def forget_stream(table: DataFrame, name: str, source: str) -> None:
    """Remove the rows a stream has added to the table."""
    table.sparkSession.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (stream = '{source}')")
