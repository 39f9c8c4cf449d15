"""A folder where line-protocol files land, ingested file by file.

Each trigger takes the files that are new, and the checkpoint remembers them, so
a restart repeats no file that was committed. Rows at or after ``end_ns`` are
counted and left out, as in batch.
"""

from __future__ import annotations

import gzip
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.functions import times
from tsforge.functions.identity import Registry
from tsforge.operators import ingest, store
from tsforge.operators.selection import Selection
from tsforge.schema import IDENTIFIED_POINTS
from tsforge.sources.line_protocol import batches_of, parser_of, records


def points(spark: SparkSession, folder: str, registry: Registry | None = None) -> DataFrame:
    """A stream of points with identities; a landed file is small, and read whole."""
    make = parser_of(registry)

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                stream = gzip.open(io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
                yield from batches_of(records(stream), make())

    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).load(folder)
    return files.select("content").mapInArrow(run, IDENTIFIED_POINTS)


def ingest_available(spark: SparkSession, folder: str, root: str, checkpoint: str, start_ns: int | None = None, end_ns: int | None = None, selection: Selection | None = None, registry: Registry | None = None) -> None:
    """Ingests what is there and stops."""

    def write(batch: DataFrame, number: int):
        done = ingest.classify(ingest.identified(batch, registry), start_ns, end_ns, selection).persist()
        place = f"{root}/facts/batch={number}"
        if not store.Files(spark).exists(f"{place}/_SUCCESS"):  # a batch that is run again is written once
            ingest.facts_of(done).write.mode("overwrite").options(**store.OPTIONS).parquet(place)
        quarantined = ingest.quarantine_of(done)
        quarantined.write.mode("overwrite").options(**store.OPTIONS).parquet(f"{root}/_quarantine/batch={number}")
        done.unpersist()

    points(spark, folder, registry).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def downsample(observations: DataFrame, width_s: int, expected: int, least_coverage: float = 0.5) -> DataFrame:
    """Means over windows, with the share of expected samples that each holds; thin windows have no mean."""
    window = times.floor_div(F.col("time_ns"), width_s * times.SECOND) * width_s
    found = observations.groupBy("series_id", "variable", window.alias("window_start_s")).agg(F.count("observed_value").alias("samples"), F.avg("observed_value").alias("mean"))
    share = F.col("samples") / F.lit(expected)
    return found.withColumn("coverage", share).withColumn("mean", F.when(share >= least_coverage, F.col("mean")))
