"""Bronze and silver as streams (beyond the batch pipeline): the checkpoint takes the high-water mark's place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.project import add_audit_columns
from ..sources.landing import Landing
from ..sources.store import TableStore


def bronze_stream(landing: Landing, config: dict, schema: StructType) -> DataFrame:
    """A feed's files as they arrive."""
    reader = landing.spark.readStream.format(config["source_format"]).options(**(config["read_options"] or {})).schema(schema)
    return reader.load(landing.path(config["entity"])).withColumn("ingest_date", F.col("ingest_date").cast("date"))


def ingest_available(landing: Landing, store: TableStore, config: dict, schema: StructType, checkpoint: str, then: Callable[[DataFrame, str], None] | None = None) -> StreamingQuery:
    """Commit what has arrived since the last run, once. A batch that is retried replaces its own rows by its tag, so
    each file counts once; ``then`` gets the batch, for instance to transform it into silver."""
    entity = config["entity"]

    def batch(df: DataFrame, n: int) -> None:
        tag = f"{entity}|stream|{n}"
        out = add_audit_columns(df, tag, config["partition_column"], source=False)
        store.write(out, "bronze", f"br_{entity}", "replace_tag", [config["partition_column"]], config["allow_schema_evolution"], tag)
        if then:
            then(out, tag)

    query = bronze_stream(landing, config, schema).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(events: DataFrame, at: str, keys: list[str], size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts for each key and window; rows later than the watermark don't change what was given out."""
    return events.withWatermark(at, late).groupBy(F.window(at, size), *keys).agg(F.count(F.lit(1)).alias("n"))
