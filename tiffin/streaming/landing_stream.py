"""The landing load as a stream: each new file of a source is loaded once, and recorded like one of a batch load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tiffin.sources.landing import file_key, load_listed

# The columns of Spark's binaryFile source, which lists files.
LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def stream_source(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    source: str,
    run_id: str,
    files_per_batch: int | None = None,
    continuous: bool = False,
) -> StreamingQuery:
    """Load the new files of a source into its raw table, with their control and lineage rows.

    The stream carries names of files; each micro-batch is loaded as a batch of
    files is, so fields may run over the ends of blocks, and a torn file leaves
    a failed row and no others. The checkpoint remembers which files came. A
    micro-batch that is played again after a crash, under whatever run, finds
    its rows and its records: files on record are skipped, rows without a record
    are counted. A failed file comes again by the batch load alone. By default
    the query stops when everything present has been loaded.
    """
    reader = spark.readStream.format("binaryFile").schema(LISTING).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Without ``content`` no file is opened here.
    files = reader.load(f"{landing}/{source}").select(file_key(source).alias("file_name"), "path")
    checkpoint = f"{warehouse}/checkpoints/raw/{source}"

    def load(batch: DataFrame, number: int) -> None:
        load_listed(batch.sparkSession, warehouse, source, batch, run_id)

    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer if continuous else writer.trigger(availableNow=True)).start()


def file_counts(raw: DataFrame) -> DataFrame:
    """Rows per file of a raw table."""
    return raw.groupBy("_source_file").agg(F.count("*").alias("row_count"))
