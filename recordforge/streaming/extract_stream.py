"""The extract split as a Structured Streaming job over a landing folder.

New extract files dropped into ``landing_dir`` are picked up by the file source, split with
the same operator as the batch job, and added to the four entity tables and the rejects
table.  ``foreachBatch`` writes all outputs of one micro-batch from one persisted parse,
each into its own ``batch_id=N`` folder (a readable partition column), overwriting it: the
sink is idempotent, so the at-least-once replay of a failed batch yields each row once.  The
checkpoint (offsets and commits) lives inside the output folder: batch numbers and the folders
named after them cannot part, and a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from recordforge import schemas
from recordforge.operators.extract import split_extract
from recordforge.schemas import conform
from recordforge.sources.text_source import HEADER_FIRST_FIELD

TEXT_SCHEMA = StructType([StructField("value", StringType(), True)])
TARGETS = {
    "application": schemas.NEW_APPLICATION, "job": schemas.NEW_JOB,
    "employer": schemas.NEW_EMPLOYER, "attorney": schemas.NEW_ATTORNEY, "rejects": None,
}


def _write_batch(out_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        from pyspark.sql import functions as F
        first = F.upper(F.btrim(F.substring_index(F.col("value"), "\t", 1)))
        lines = batch.filter(first != HEADER_FIRST_FIELD)
        parts = split_extract(lines, persist=True)
        try:
            for name, schema in TARGETS.items():
                df = parts[name] if schema is None else conform(parts[name], schema)
                # one folder per micro-batch, overwritten: a batch replayed after a failure
                # replaces its earlier (possibly partial) output instead of adding to it
                df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}/batch_id={batch_id}")
        finally:
            parts["parsed"].unpersist()
    return write


def start_extract_stream(spark: SparkSession, landing_dir: str, out_dir: str, query_name: str = "extract_split",
                         max_files_per_trigger: int = 100, available_now: bool = False) -> StreamingQuery:
    """Start the streaming split; ``available_now`` processes what is there and stops."""
    ckpt = f"{out_dir.rstrip('/')}/_checkpoint"
    stream = (spark.readStream.schema(TEXT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
              .text(landing_dir))
    writer = stream.writeStream.queryName(query_name).option("checkpointLocation", ckpt).foreachBatch(_write_batch(out_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
