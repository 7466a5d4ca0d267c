"""Document ingestion and retrieval as PySpark DataFrame transformations."""

import sys

from pyspark import cloudpickle

from pagemill.config import ChunkingConfig, EmbeddingConfig, RunConfig

# Functions of this package travel to the Python workers with their code, so executors
# need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ChunkingConfig", "EmbeddingConfig", "RunConfig"]
