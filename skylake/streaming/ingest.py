"""Incremental ingest with Structured Streaming file sources.

Both jobs process what has arrived and stop (`availableNow`); the checkpoint remembers which files are
done, so a restart after a lost driver or executor neither skips nor repeats one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skylake import schemas
from skylake.sources import archive, landing


def _start(spark: SparkSession, rows: DataFrame, checkpoint: str, load) -> StreamingQuery:
    """Run `load(batch, part)` on every micro-batch. `part` names the batch for good: the id that Spark keeps in the
    checkpoint, and the number. A batch that is run again after a failure has the same name, one of another stream
    or of a new checkpoint never has."""
    name = f"skylake-{uuid.uuid4().hex}"

    def run(batch: DataFrame, batch_id: int) -> None:
        query = next(q for q in spark.streams.active if q.name == name)
        load(batch, f"{query.id}-{batch_id}")

    return rows.writeStream.queryName(name).foreachBatch(run).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def ingest_envelopes(
    spark: SparkSession, source: str, target: str, checkpoint: str, max_files: int = 10_000,
    suffix: str | None = ".jsonl", rejects: str | None = None,
) -> StreamingQuery:
    """New landed JSON lines below `source` to day rows in the Parquet dataset `target`, bad lines with their file to
    the dataset `rejects` (by default `target` with `-rejects`). A batch owns a folder in each."""
    lines = landing.text_lines(spark.readStream.option("maxFilesPerTrigger", max_files), source, suffix)
    aside = rejects or f"{target.rstrip('/')}-rejects"

    def load(batch: DataFrame, part: str) -> None:
        with landing.Scan(batch, schemas.ENVELOPE).split() as found:
            found.rejects.write.mode("overwrite").parquet(f"{aside}/part={part}")
            days = landing.to_warehouse_form(landing.flatten_envelopes(found.good))
            days.write.mode("overwrite").parquet(f"{target}/part={part}")

    return _start(spark, lines, checkpoint, load)


def archive_daily(
    spark: SparkSession, source: str, root: str, checkpoint: str, schema: T.StructType = schemas.MART_NEWDATA,
    max_files: int = 10_000,
) -> StreamingQuery:
    """New mart files below `source`, which carry an `extraction_date` column, to the archive.

    A micro-batch owns its folders, so a batch that is run again after a failure overwrites itself and nothing else;
    a day delivered twice is resolved by the latest-version read.
    """
    dated = T.StructType([*schema.fields, T.StructField("extraction_date", T.DateType())])
    arrivals = spark.readStream.schema(dated).option("maxFilesPerTrigger", max_files).parquet(source)
    return _start(spark, arrivals, checkpoint, lambda batch, part: archive.append_dated(batch, root, part))
