"""Run configuration: plain dataclasses that stay on the driver.

No secret is ever part of a configuration object; a parser that needs one takes
it from its own closure.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# Separators from the coarsest to the finest.
MARKDOWN_SEPARATORS = ["\n## ", "\n### ", "\n\n", "\n", ".", " ", ""]
PLAIN_SEPARATORS = ["\n\n", "\n", " ", ""]

# The retrieval smoke-test questions.
DEFAULT_TEST_QUERIES = [
    "investment fund regulations and compliance requirements",
    "trading restrictions and market access rules",
    "risk management framework and procedures",
    "financial reporting standards and disclosure requirements",
    "market data policies and data governance",
    "regulatory compliance and audit procedures",
]

# Recognised document types.
FILE_TYPES = {
    ".pdf": "PDF Document",
    ".docx": "Word Document",
    ".pptx": "PowerPoint Presentation",
    ".xlsx": "Excel Spreadsheet",
    ".html": "HTML Document",
}

# Percentiles tried by the threshold study.
SWEEP_THRESHOLDS = [85, 90, 95, 98]


# The defaults of the classes below.
@dataclass(frozen=True)
class ChunkingConfig:
    chunk_size: int = 1500
    chunk_overlap: int = 300
    separators: list[str] = field(default_factory=lambda: list(MARKDOWN_SEPARATORS))
    keep_separator: bool = True
    use_semantic_chunking: bool = False
    # Chunks along the block structure found by the parser, up to ``chunk_size`` characters.
    use_structure: bool = False
    buffer_size: int = 1
    breakpoint_percentile_threshold: int = 95

    def __post_init__(self):
        if self.chunk_size <= 0 or not 0 <= self.chunk_overlap < self.chunk_size:
            raise ValueError("need chunk_size > 0 and 0 <= chunk_overlap < chunk_size")
        if self.use_structure and self.use_semantic_chunking:
            raise ValueError("choose one of semantic and structure chunking")
        if self.buffer_size < 0:
            raise ValueError("buffer_size must not be negative")
        if not 0 <= self.breakpoint_percentile_threshold <= 100:
            raise ValueError("breakpoint_percentile_threshold must lie in 0..100")


@dataclass(frozen=True)
class EmbeddingConfig:
    model_name: str = "token-hash"
    dim: int = 384
    normalize: bool = True

    @property
    def name(self) -> str:
        return self.model_name


@dataclass(frozen=True)
class RunConfig:
    docs_folder: str = "docs"
    output_folder: str = "output"
    store_name: str = "vector_store"
    file_suffixes: tuple[str, ...] = (".html",)
    chunking: ChunkingConfig = field(default_factory=ChunkingConfig)
    embedding: EmbeddingConfig = field(default_factory=EmbeddingConfig)
    test_queries: tuple[str, ...] = tuple(DEFAULT_TEST_QUERIES)
    k: int = 3
    save_results: bool = True
    test_retrieval: bool = True
    create_report: bool = True

    def to_dict(self) -> dict:
        return asdict(self)
