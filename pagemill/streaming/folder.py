"""Parse the files of a folder as they arrive.

Discovery and parsing are narrow, so the batch operators run on a file stream as they
are. The stream sees what the batch sees, empty and hidden files too, and its checkpoint holds the point in time up to
which files were read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pagemill.sources.folder_source import NAME, folder_options
from pagemill.sources.parsing import HTML_PARSERS, Parser, parse_files


def arriving_files(spark: SparkSession, folder: str, suffixes: Sequence[str]) -> DataFrame:
    """``file_path, content`` of files that arrive; one that changes arrives again."""
    stream = spark.readStream.format(NAME).options(**folder_options(spark, folder, suffixes, content=True))
    return stream.load().select(F.col("path").alias("file_path"), "content")


def parse_arriving(
    spark: SparkSession,
    folder: str,
    output: str,
    checkpoint: str,
    suffixes: Sequence[str] = (".html",),
    parsers: Sequence[tuple[str, Parser]] = tuple(HTML_PARSERS),
) -> StreamingQuery:
    """Parse what has arrived since the last call into the table at ``output``.

    A folder in a store that tasks cannot open is refused. Each batch is a partition of the table, overwritten if the batch is run again.
    """
    parsed = parse_files(arriving_files(spark, folder, suffixes), parsers, F.current_timestamp())

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch_id={number}")

    return (
        parsed.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
