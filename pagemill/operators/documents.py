"""Parsed files and flat page tables to documents with typed metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.functions.formats import iso_timestamp
from pagemill.functions.text import basename, choose_content, has_content
from pagemill.operators.numbering import number_rows

PAGE_TYPE = (
    "struct<md:string,text:string,layout:array<struct<kind:string,level:int,text:string>>,"
    "structured_data:string,images:array<string>>"
)


def _flags(layout: Column, structured_data: Column, images: Column) -> list[Column]:
    """Optional page facts: NULL, never false, where the page does not have them."""
    image_count = F.when(F.size(images) > 0, F.size(images))
    return [
        F.when(layout, F.lit(True)).alias("has_layout"),
        F.when(structured_data, F.lit(True)).alias("has_structured_data"),
        image_count.alias("image_count"),
        image_count.isNotNull().alias("_has_images"),
    ]


def page_flags(df: DataFrame, layout: Column, structured_data: Column, images: Column) -> DataFrame:
    flagged = df.select("*", *_flags(layout, structured_data, images))
    return flagged.withColumn("has_images", F.when(F.col("_has_images"), F.lit(True))).drop(
        "_has_images"
    )


def parsed_to_documents(parsed: DataFrame) -> DataFrame:
    """One document per non-blank page of each parsed file.

    ``parsed`` has ``file_path, pages, processed_at, loader_used``. Pages are numbered before blank
    ones are dropped and ``total_pages`` counts those too. The parser of a document is the one that
    worked, and its type says which content of the page was chosen. A narrow operator: the pages
    of a file are already in its row.
    """
    exploded = parsed.select(
        "file_path",
        F.col("processed_at"),
        F.col("loader_used"),
        F.size("pages").alias("total_pages"),
        F.posexplode("pages").alias("pos", "page_body"),
    )
    body = F.col("page_body")
    documents = exploded.select(
        F.concat_ws("#", "file_path", (F.col("pos") + 1).cast("string")).alias("document_key"),
        choose_content(body["md"], body["text"]).alias("page_content"),
        F.col("file_path").alias("source_file"),
        basename(F.col("file_path")).alias("file_name"),
        (F.col("pos") + 1).alias("page"),
        "total_pages",
        F.col("loader_used").alias("parser"),
        F.when(has_content(body["md"]), F.lit("markdown")).otherwise(F.lit("text")).alias("result_type"),
        iso_timestamp(F.col("processed_at")).alias("processed_at"),
        "loader_used",
        body["layout"].alias("layout"),
        body["structured_data"].alias("structured_data"),
        body["images"].alias("images"),
    ).where(has_content(F.col("page_content")))
    return page_flags(
        documents.withColumn("content_length", F.length("page_content")),
        F.size("layout") > 0,
        F.length("structured_data") > 0,
        F.col("images"),
    ).drop("structured_data", "images")


def pages_to_documents(
    pages: DataFrame, file: str, order_by: str, content: str, parser: str, result_type: str = "text"
) -> DataFrame:
    """The same for a flat table with one row per page and no page number yet.

    A file may hold any share of the rows, so pages are numbered in ranges.
    """
    numbered = number_rows(pages, [order_by], [file], number="page", total="total_pages")
    return numbered.where(has_content(F.col(content))).select(
        F.col(order_by),
        F.col(content).alias("page_content"),
        F.col(file).alias("source_file"),
        basename(F.col(file)).alias("file_name"),
        "page",
        "total_pages",
        F.lit(parser).alias("parser"),
        F.lit(result_type).alias("result_type"),
        F.length(content).alias("content_length"),
    )


def document_ids(df: DataFrame, order_by: str) -> DataFrame:
    """``doc_0``, ``doc_1`` ... in the order of a unique key, without a single-task sort."""
    numbered = number_rows(df, [order_by], number="_position")
    return numbered.withColumn(
        "document_id", F.concat(F.lit("doc_"), (F.col("_position") - 1).cast("string"))
    ).drop("_position")
