"""Landing feeds: folders <root>/<entity>/ingest_date=YYYY-MM-DD of JSON, CSV or Parquet files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .filesystem import Files


class Landing:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)

    def path(self, entity: str, ingest_date: str | None = None) -> str:
        return self.files.at(entity, *([f"ingest_date={ingest_date}"] if ingest_date else []))

    def partitions(self, entity: str) -> list[str]:
        """Dates that have arrived, from folder names; [] for a feed that never did."""
        return [n.split("=", 1)[1] for n in self.files.names(self.path(entity)) if n.startswith("ingest_date=")]

    def read(self, config: dict, partitions: list[str], schema: StructType | None = None) -> DataFrame:
        """Just the partitions named. The base path keeps ingest_date as a column, which is a date by decision, not by
        inference; CSV stays text."""
        options = config.get("read_options") or {}
        options = json.loads(options) if isinstance(options, str) else dict(options)
        if config["source_format"] not in ("json", "csv", "parquet"):
            raise ValueError(f"unknown source_format {config['source_format']!r}")
        if config["source_format"] == "parquet":
            options.setdefault("mergeSchema", "true")
        reader = self.spark.read.format(config["source_format"]).options(**options).option("basePath", self.path(config["entity"]))
        reader = reader.schema(schema) if schema else reader
        df = reader.load([self.path(config["entity"], p) for p in partitions])
        return df.withColumn("ingest_date", F.col("ingest_date").cast("date"))

    def write(self, df: DataFrame, entity: str, source_format: str, mode: str = "overwrite") -> None:
        """One shuffle to one file for each arrival date."""
        out = df.repartition("ingest_date").write.mode(mode).partitionBy("ingest_date")
        {"json": out.json, "parquet": out.parquet, "csv": lambda p: out.option("header", "true").csv(p)}[source_format](self.path(entity))


def source_file() -> Column:
    """The file a row was read from."""
    return F.col("_metadata.file_path")


def literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small relation of known rows."""
    return spark.createDataFrame(rows, schema)


def calendar(spark: SparkSession, first: str, last: str, step: str = "1 day") -> DataFrame:
    """Column d from first to last, both included."""
    return spark.sql(f"SELECT explode(sequence(date'{first}', date'{last}', interval {step})) AS d")
