"""Folder discovery, whole-file text and the file-type catalogue."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.config import FILE_TYPES
from pagemill.functions.formats import file_size, one_decimal
from pagemill.functions.text import basename, suffix
from pagemill.operators.numbering import number_rows
from pagemill.sources.folder_source import BATCH_BYTES, NAME, Folder, folder_options

CONTENTS = "file_path string, content binary"
# Bytes of files that one task reads.
READ_BYTES = 128 << 20


def suffix_glob(suffixes: Sequence[str]) -> str:
    """A case-insensitive file name pattern."""
    def either_case(text: str) -> str:
        return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)

    return "{" + ",".join("*" + either_case(s) for s in suffixes) + "}"


def _visible(spark: SparkSession, folder: str, suffixes: Sequence[str]) -> DataFrame:
    """What Spark's own source finds: neither empty nor hidden files, and no folder that is missing."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", suffix_glob(suffixes))
    try:
        return reader.load(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary")
        raise


def discover_files(spark: SparkSession, folder: str, suffixes: Sequence[str] = (".pdf",)) -> DataFrame:
    """Files directly inside ``folder`` with one of the suffixes; none if it is missing.

    Every file counts, empty and hidden ones too. Tasks list, each its range of names, and never read a file's
    content. A store that tasks cannot open themselves is listed by Spark's own source, which sees neither
    empty nor hidden files. Order and numbers are added by :func:`file_listing`.
    """
    if Folder.can_open(folder):
        return spark.read.format(NAME).options(**folder_options(spark, folder, suffixes)).load()
    return _visible(spark, folder, suffixes).select(
        "path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")
    )


def has_suffix(path: Column, suffixes: Sequence[str]) -> Column:
    return suffix(path).isin([s.lower() for s in suffixes])


def file_listing(files: DataFrame) -> DataFrame:
    """Files numbered in path order with their size in KB, MB and readable form."""
    size = F.col("size_bytes")
    return number_rows(files, ["path"], number="file_no").select(
        "file_no",
        "path",
        basename(F.col("path")).alias("file_name"),
        "size_bytes",
        one_decimal(size / 1024.0).alias("size_kb"),
        one_decimal(size / 1048576.0).alias("size_mb"),
        file_size(size).alias("size_text"),
    )


def file_type(path: Column) -> Column:
    """Description of a recognised document type, else NULL."""
    catalogue = F.create_map(*[F.lit(x) for pair in FILE_TYPES.items() for x in pair])
    return F.try_element_at(catalogue, suffix(path))


def load_text(spark: SparkSession, path: str) -> DataFrame:
    """One document per file with its path as ``source``."""
    files = spark.read.text(path, wholetext=True)
    return files.select(
        F.col("value").alias("page_content"), F.col("_metadata.file_path").alias("source")
    )


def write_files(df: DataFrame, folder: str, name: str, content: str) -> int:
    """Write one file per row, named and filled by two columns, and return their number.

    Tasks write, each file under another name first and renamed when it is whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = Folder(folder)
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1), strict=True):
                target.write(file.as_py(), data.as_py() or b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["files"])

    chosen = df.select(F.col(name).cast("string"), F.col(content).cast("binary"))
    return chosen.mapInArrow(run, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def read_files(paths: DataFrame) -> DataFrame:
    """``file_path, content`` for a table with ``path`` and ``size_bytes``; only these files are read.

    Files are dealt to tasks of about ``READ_BYTES`` each. One that cannot be read has no content.
    """
    size = paths.agg(F.coalesce(F.sum("size_bytes"), F.lit(0))).first()[0]
    tasks = max(paths.sparkSession.sparkContext.defaultParallelism, -(-size // READ_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for path in batch.column("path").to_pylist():
                folder, _, file = path.rpartition("/")
                rows.append((path, Folder(folder).read(file)))
                held += len(rows[-1][1] or b"")
                if held >= BATCH_BYTES:
                    yield _contents(rows)
                    rows, held = [], 0
            if rows:
                yield _contents(rows)

    return paths.select("path").repartition(tasks, "path").mapInArrow(run, CONTENTS)


def _contents(rows: list[tuple[str, bytes | None]]) -> pa.RecordBatch:
    columns = [pa.array([r[n] for r in rows], kind) for n, kind in enumerate((pa.string(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, names=["file_path", "content"])


def load_contents(
    spark: SparkSession, folder: str, suffixes: Sequence[str], only: DataFrame | None = None
) -> DataFrame:
    """``file_path, content`` of all files of :func:`discover_files`; an empty file has empty bytes.

    With ``only``, a table of ``file_path``, no other file is read.
    """
    if not Folder.can_open(folder):
        # Here only Spark's source reads, and drops after reading.
        found = _visible(spark, folder, suffixes).select(F.col("path").alias("file_path"), "content")
        return found if only is None else found.join(only, "file_path", "left_semi")
    listed = discover_files(spark, folder, suffixes)
    if only is not None:
        listed = listed.join(only.select(F.col("file_path").alias("path")), "path", "left_semi")
    return read_files(listed)
