"""The item rules on items as they arrive, against stored articles, headers and listing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfproof.operators import fused
from shelfproof.schema import REFERENCE_DATE, Tables


def item_exceptions(items: DataFrame, tables: Tables,
                    as_of: date = REFERENCE_DATE) -> DataFrame:
    """Exceptions of a stream of items. All joins are stream to table, so no state is kept."""
    return fused.item_exceptions(fused.enrich(tables.replace(promotion_item=items)), as_of)


def append_worklist(exceptions: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet worklist, each item once, and stop when the input is used up."""
    return (exceptions.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
