"""Chunk tables, the vector store and the run configuration on disk."""

from __future__ import annotations

import functools
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from pagemill.config import ChunkingConfig, EmbeddingConfig, RunConfig
from pagemill.operators.embedding import Embedder, memory_megabytes
from pagemill.session import delete_path, written


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ---------------------------------------------------------------- versions of a vector store
#
# ``versions/<folder>/bucket=<n>`` holds rows by hash of their key, sorted by it; ``manifests`` has one row per version
# that says in which folder each bucket is. The manifest is written last, by Spark's writer, which shows whole files
# only: a version is there with its manifest or not at all, and what it names never changes.

MANIFESTS = "manifests"
BUCKETS = 64
MANIFEST = (
    "version int, folders map<int,string>, schema string, key string, buckets int, model_name string, "
    "embedding_dimension int, normalize_embeddings boolean, chunk_size int, chunk_overlap int, total_chunks bigint"
)


def describe_vector_store(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row about a version, by default the last one that is complete; none if there is no store."""
    try:
        manifests = spark.read.schema(MANIFEST).parquet(f"{path}/{MANIFESTS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        manifests = spark.createDataFrame([], MANIFEST)
    found = manifests if version is None else manifests.where(F.col("version") == version)
    return found.orderBy(F.desc("version")).limit(1).select(
        "model_name", "embedding_dimension", "normalize_embeddings", "chunk_size", "chunk_overlap", "total_chunks",
        "version", "folders", "schema", "key", "buckets",
    )


def _write_buckets(rows: DataFrame, folder: str, key: str) -> None:
    """Rows by bucket and key; a large bucket is written by many tasks."""
    rows.repartitionByRange("bucket", key).sortWithinPartitions("bucket", key).write.partitionBy("bucket").parquet(folder)


def _read_buckets(spark: SparkSession, path: str, folders: dict[int, str], schema: T.StructType) -> DataFrame:
    """The rows of some buckets, each from the folder that its version names."""
    wanted = {}
    for bucket, folder in folders.items():
        wanted.setdefault(folder, []).append(bucket)
    kinds = T.StructType([*schema, T.StructField("bucket", T.IntegerType())])
    parts = [
        spark.read.schema(kinds).parquet(f"{path}/versions/{folder}").where(F.col("bucket").isin(buckets))
        for folder, buckets in sorted(wanted.items())
    ]
    return functools.reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], kinds)


def _commit(
    spark: SparkSession, path: str, version: int, folders: dict[int, str], schema: T.StructType, key: str, buckets: int,
    embedder: Embedder | EmbeddingConfig, sizes: tuple[int | None, int | None], total: int,
) -> None:
    row = (
        version, folders, schema.json(), key, buckets, embedder.name, embedder.dim, embedder.normalize, *sizes, total,
    )
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/{MANIFESTS}")


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))


def save_vector_store(
    store: DataFrame,
    path: str,
    embedder: Embedder | EmbeddingConfig,
    chunking: ChunkingConfig | None = None,
    key: str = "chunk_id",
    buckets: int = BUCKETS,
) -> int:
    """Write a new version that holds the rows of ``store`` and nothing else; returns its number.

    The description is the embedder's own, with the chunking and the number of chunks that were written. Readers
    see the version before until the new one is complete. One writer at a time.
    """
    spark = store.sparkSession
    before = describe_vector_store(spark, path).first()
    version = before["version"] + 1 if before else 1
    folder = f"{version}-{uuid.uuid4().hex}"
    _write_buckets(_bucketed(store, key, buckets), f"{path}/versions/{folder}", key)
    rows = _read_buckets(spark, path, dict.fromkeys(range(buckets), folder), store.schema)
    counts = dict(tuple(r) for r in rows.groupBy("bucket").count().collect())
    sizes = (chunking.chunk_size, chunking.chunk_overlap) if chunking else (None, None)
    folders = dict.fromkeys(sorted(counts), folder)
    _commit(spark, path, version, folders, store.schema, key, buckets, embedder, sizes, sum(counts.values()))
    return version


def upsert_vectors(rows: DataFrame, path: str, embedder: Embedder | EmbeddingConfig) -> int:
    """Add rows to the store, or put them in the place of those with the same key; returns the new version.

    Only buckets that get a row are written again, old and new rows merged by key; the new version goes on to use the
    folders of the others. ``rows`` has the columns of the store, and a key once. Of repeated keys one row stays.
    """
    spark = rows.sparkSession
    found = _checked(spark, path, embedder, None)
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    key, buckets, folders = found["key"], found["buckets"], dict(found["folders"])
    missing = set(schema.names) ^ set(rows.columns)
    if missing:
        raise ValueError(f"rows and store differ in {sorted(missing)}")
    folder = f"{found['version'] + 1}-{uuid.uuid4().hex}"
    new = written(_bucketed(rows.select(*schema.names), key, buckets).dropDuplicates([key]), "new_rows")
    touched = sorted(r[0] for r in new.select("bucket").distinct().collect())
    old = _read_buckets(spark, path, {b: folders[b] for b in touched if b in folders}, schema)
    stays = old.join(new.select("bucket", key), ["bucket", key], "left_anti").select(*new.columns)
    _write_buckets(new.unionByName(stays), f"{path}/versions/{folder}", key)
    total = found["total_chunks"] - old.count()
    folders |= dict.fromkeys(touched, folder)
    total += _read_buckets(spark, path, dict.fromkeys(touched, folder), schema).count()
    sizes = (found["chunk_size"], found["chunk_overlap"])
    _commit(spark, path, found["version"] + 1, folders, schema, key, buckets, embedder, sizes, total)
    return found["version"] + 1


def _checked(spark: SparkSession, path: str, embedder: Embedder | EmbeddingConfig, version: int | None) -> Row:
    found = describe_vector_store(spark, path, version).first()
    expected = (embedder.name, embedder.dim, embedder.normalize)
    if found is None or tuple(found)[:3] != expected:
        raise ValueError(f"store was written with {found and tuple(found)[:3]}, not {expected}")
    return found


def load_vector_store(
    spark: SparkSession,
    path: str,
    embedder: Embedder | EmbeddingConfig,
    vector: str = "embedding",
    version: int | None = None,
) -> DataFrame:
    """The vectors of a whole version, by default the last; refuses a store of another embedder or with vectors of another size."""
    found = _checked(spark, path, embedder, version)
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    store = _read_buckets(spark, path, found["folders"], schema).drop("bucket")
    sizes = store.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if set(sizes) - {None, -1, embedder.dim}:
        raise ValueError(f"stored vectors have {sizes} dimensions, not {embedder.dim}")
    return store


def drop_unused(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders that the last version does not use, those of writers that were killed too; returns their names.

    Older versions can no longer be read then. The number of folders is that of saves and upserts.
    """
    found = describe_vector_store(spark, path).first()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    versions = jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    names = [f.getPath().getName() for f in versions.getFileSystem(conf).listStatus(versions)]
    unused = sorted(set(names) - set(found["folders"].values()))
    for name in unused:
        delete_path(spark, f"{path}/versions/{name}")
    return unused


def store_statistics(store: DataFrame, dim: int) -> DataFrame:
    return store.agg(
        F.count(F.lit(1)).alias("total_vectors"),
        F.lit(dim).alias("embedding_dimension"),
        memory_megabytes(F.count(F.lit(1)), dim).alias("memory_mb"),
    )


def config_row(config: RunConfig, session: str, started_at: str, statistics: DataFrame) -> DataFrame:
    """One JSON document with the configuration and the counters of the run.

    File names and failures may be many; they are tables of their own beside it.
    """
    settings = json.dumps(config.to_dict(), default=str, ensure_ascii=False)
    return statistics.select(
        F.to_json(
            F.struct(
                F.lit(session).alias("session_id"),
                F.lit(started_at).alias("timestamp"),
                F.parse_json(F.lit(settings)).alias("config"),
                F.struct("*").alias("processing_stats"),
            )
        ).alias("value")
    )


def save_config(row: DataFrame, path: str) -> None:
    row.write.mode("overwrite").text(path)


def load_config(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])
