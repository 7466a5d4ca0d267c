"""The same results in DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

from pagemill.config import DEFAULT_TEST_QUERIES, FILE_TYPES, MARKDOWN_SEPARATORS, PLAIN_SEPARATORS
from pagemill.functions.text import EMOJI_TAGS, WHITESPACE


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def _strip(text: str) -> str:
    return f"trim({text}, {WS})"


LISTING = """listing AS (
  SELECT page_id, regexp_extract(url, '^[^?#]*') AS path, CAST(octet_length(encode(html)) AS BIGINT) AS size_bytes
  FROM pages)"""

BLANKS = "blanks AS (SELECT doc_id, source, CASE WHEN doc_id % 11 = 0 THEN ' ' ELSE text END AS text FROM documents)"

PAGE_DOCS = f"""{BLANKS}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page,
         count(*) OVER (PARTITION BY source) AS total_pages FROM blanks),
page_docs AS (
  SELECT doc_id, text AS page_content, source AS source_file, source AS file_name, page, total_pages,
         'table' AS parser, 'text' AS result_type, CAST(length(text) AS INTEGER) AS content_length
  FROM numbered WHERE {_strip('text')} <> '')"""


def _windows(source: str, keys: str, text: str = "text", size: int = 1500, overlap: int = 300, name: str = "chunks") -> str:
    stride = size - overlap
    return f"""{name}_w AS (
  SELECT {keys}, {text} AS t, unnest(range(0, greatest(1, CAST(ceil((length({text}) - {overlap}) / {stride}.0) AS BIGINT)))) AS i
  FROM {source}),
{name}_c AS (SELECT {keys}, i, {_strip(f'substr(t, i * {stride} + 1, {size})')} AS chunk FROM {name}_w),
{name} AS (
  SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY i) - 1 AS INTEGER) AS chunk_index, chunk,
         CAST(length(chunk) AS INTEGER) AS chunk_length
  FROM {name}_c WHERE chunk <> '')"""


WINDOWS = _windows("documents", "doc_id, source")

OUTCOMES = """outcomes AS (
  SELECT doc_id, text, n_chars, 'docs/' || source || '/' || doc_id || '.html' AS file_path, doc_id || '.html' AS file_name,
    CASE doc_id % 13 WHEN 0 THEN 'nested async' WHEN 1 THEN 'quota exceeded' WHEN 2 THEN 'Invalid API Key'
      WHEN 3 THEN 'No content extracted' END AS error,
    CASE WHEN doc_id % 13 < 4 THEN 'failed' ELSE 'ok' END AS status,
    CASE WHEN doc_id % 13 < 4 THEN 0 ELSE 1 END AS n_pages
  FROM documents)"""

RUN_STATS = """run AS (
  SELECT count(*) AS total_files, count(*) FILTER (status = 'ok') AS successful, count(*) FILTER (status = 'failed') AS failed,
    CAST(sum(n_pages) AS BIGINT) AS total_pages, sum(n_chars / 1024.0::DOUBLE) AS processing_time FROM outcomes)"""

def _recursive(separators: list[str], size: int, overlap: int) -> str:
    """Recursive splitting as tables: pieces level by level, then the chain of chunks."""
    parts = ["big0 AS (SELECT doc_id, 0 AS s, length(text) AS e FROM documents)"]
    levels = [sep for sep in separators if sep]
    for n, sep in enumerate(levels):
        literal = " || ".join(f"chr({ord(c)})" for c in sep)
        parts.append(f"""pieces{n} AS (
  SELECT doc_id, span, s + off - len AS s, s + off AS e, len FROM (
    SELECT doc_id, s, s AS span, n, len, CAST(sum(len) OVER (PARTITION BY doc_id, s ORDER BY n) AS BIGINT) AS off FROM (
      SELECT doc_id, s, n, length(part) + CASE WHEN n > 0 THEN {len(sep)} ELSE 0 END AS len FROM (
        SELECT doc_id, s, unnest(range(0, len(p))) AS n, unnest(p) AS part FROM (
          SELECT b.doc_id, s, string_split(substr(text, s + 1, e - s), {literal}) AS p FROM big{n} b JOIN documents USING (doc_id)))))
  WHERE len > 0),
small{n} AS (SELECT doc_id, {n} AS level, span, sum((len >= {size})::INTEGER) OVER (PARTITION BY doc_id, span ORDER BY s) AS run, s, e, len FROM pieces{n}),
big{n + 1} AS (SELECT doc_id, s, e FROM pieces{n} WHERE len >= {size})""")
    last, stride = f"big{len(levels)}", size - overlap
    union = " UNION ALL ".join(f"SELECT * FROM small{n} WHERE len < {size}" for n in range(len(levels)))
    parts.append(f"""runs AS (SELECT doc_id, level, span, run, s, e, row_number() OVER (PARTITION BY doc_id, level, span, run ORDER BY s) AS i,
    count(*) OVER (PARTITION BY doc_id, level, span, run) AS n FROM ({union})),
reach AS (SELECT a.*, b.i AS l, b.e AS le FROM runs a JOIN runs b USING (doc_id, level, span, run)
  WHERE b.i >= a.i AND b.e - a.s <= {size} QUALIFY row_number() OVER (PARTITION BY doc_id, level, span, run, a.i ORDER BY b.i DESC) = 1),
after AS (SELECT r.doc_id, r.level, r.span, r.run, r.i, min(f.i) AS nxt
  FROM reach r JOIN runs z ON (z.doc_id, z.level, z.span, z.run) = (r.doc_id, r.level, r.span, r.run) AND z.i = r.l + 1
  JOIN runs f ON (f.doc_id, f.level, f.span, f.run) = (r.doc_id, r.level, r.span, r.run) AND f.i > r.i AND f.i <= r.l + 1
  WHERE f.i = r.l + 1 OR (r.le - f.s <= {overlap} AND z.e - f.s <= {size}) GROUP BY ALL),
chain AS (SELECT doc_id, level, span, run, 1::BIGINT AS i FROM runs WHERE i = 1
  UNION ALL SELECT c.doc_id, c.level, c.span, c.run, a.nxt FROM chain c JOIN after a USING (doc_id, level, span, run, i)),
spans AS (SELECT doc_id, s, le AS e FROM chain JOIN reach USING (doc_id, level, span, run, i)
  UNION ALL SELECT doc_id, s + w * {stride}, least(e, s + w * {stride} + {size}) FROM (
    SELECT doc_id, s, e, unnest(range(0, greatest(1, CAST(ceil((e - s - {overlap}) / {stride}.0) AS BIGINT)))) AS w FROM {last})),
cut AS (SELECT doc_id, source, s, {_strip('substr(text, CAST(s AS BIGINT) + 1, CAST(e - s AS BIGINT))')} AS chunk FROM spans JOIN documents USING (doc_id))
SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS chunk_index, chunk,
  CAST(length(chunk) AS INTEGER) AS chunk_length FROM cut WHERE chunk <> ''""")
    return "WITH RECURSIVE " + ",\n".join(parts)


TOKENS = r"list_filter(string_split_regex(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
BUCKET = "CAST(CAST(concat('0x', substr(md5({}), 1, 8)) AS BIGINT) % 384 AS INTEGER)"


def _cells(source: str, keys: str, text: str, name: str) -> str:
    """Sparse unit vectors in single precision."""
    return f"""{name}_t AS (SELECT {keys}, unnest({TOKENS.format(text)}) AS tok FROM {source}),
{name}_b AS (SELECT {keys}, {BUCKET.format('tok')} AS bucket, count(*) AS n FROM {name}_t GROUP BY ALL),
{name} AS (SELECT {keys}, bucket, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {keys})::DOUBLE) AS FLOAT) AS DOUBLE) AS weight FROM {name}_b)"""


def _search(chunks: str, store: str, store_keys: list[str], queries: str, query: str, query_cells: str, k: int) -> str:
    """All pairs of texts, their distance from sparse products, the k nearest."""
    sk = ", ".join(store_keys)
    return f"""sn AS (SELECT {sk}, sum(weight * weight) AS n FROM {store} GROUP BY {sk}),
qn AS (SELECT {query}, sum(weight * weight) AS n FROM {query_cells} GROUP BY {query}),
dots AS (SELECT q.{query}, {', '.join('s.' + c for c in store_keys)}, sum(q.weight * s.weight) AS dot
  FROM {query_cells} q JOIN {store} s USING (bucket) GROUP BY ALL),
scored AS (SELECT q.{query}, {', '.join('c.' + c for c in store_keys)},
    coalesce(qn.n, 0) + coalesce(sn.n, 0) - 2 * coalesce(dot, 0) AS score
  FROM {queries} q CROSS JOIN {chunks} c LEFT JOIN qn ON qn.{query} = q.{query}
  LEFT JOIN sn ON {' AND '.join(f'sn.{c} = c.{c}' for c in store_keys)}
  LEFT JOIN dots ON dots.{query} = q.{query} AND {' AND '.join(f'dots.{c} = c.{c}' for c in store_keys)}),
hits AS (SELECT *, CAST(row_number() OVER (PARTITION BY {query} ORDER BY round(score, 9), {sk}) AS INTEGER) AS rank
  FROM scored QUALIFY rank <= {k})"""


DEFAULT_QUERIES = "default_queries AS (SELECT * FROM (VALUES {}) t(query_id, query))".format(
    ", ".join(f"(CAST({i} AS INTEGER), {_quote(q)})" for i, q in enumerate(DEFAULT_TEST_QUERIES, 1))
)

SELF_HITS = """pairs AS (
  SELECT q.vec_id AS query_id, s.vec_id, s.label, list_distance(q.embedding::DOUBLE[], s.embedding::DOUBLE[]) ** 2 AS score
  FROM embeddings q CROSS JOIN embeddings s),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9), vec_id) AS INTEGER) AS rank FROM pairs)"""
# The same, asked by the rows whose id is divisible by 50.
ASKED_HITS = SELF_HITS.replace("embeddings s)", "embeddings s WHERE q.vec_id % 50 = 0)")

SENTENCES = r"""sentences AS (
  SELECT doc_id, CAST(unnest(range(0, len(s))) AS INTEGER) AS i, unnest(s) AS sentence
  FROM (SELECT doc_id, regexp_extract_all(text, '(?s)(.*?[.!?][\t-\r ]+|.+)', 1) AS s FROM documents))"""

DISTANCES = f"""{SENTENCES},
tok AS (SELECT doc_id, i, {BUCKET.format('t')} AS bucket, count(*) AS n
  FROM (SELECT doc_id, i, unnest({TOKENS.format('sentence')}) AS t FROM sentences) GROUP BY ALL),
grp AS (SELECT s.doc_id, s.i, tok.bucket, CAST(sum(tok.n) AS BIGINT) AS n
  FROM sentences s JOIN tok ON tok.doc_id = s.doc_id AND tok.i BETWEEN s.i - 1 AND s.i + 1 GROUP BY ALL),
nrm AS (SELECT doc_id, i, CAST(sum(n * n) AS BIGINT) AS n2 FROM grp GROUP BY ALL),
dot AS (SELECT a.doc_id, a.i, CAST(sum(a.n * b.n) AS BIGINT) AS d
  FROM grp a JOIN grp b ON a.doc_id = b.doc_id AND b.i = a.i + 1 AND a.bucket = b.bucket GROUP BY ALL),
distances AS (SELECT s.doc_id, s.i AS sentence_no,
    1 - coalesce(d, 0)::DOUBLE / sqrt(coalesce(x.n2, 1)::DOUBLE * coalesce(y.n2, 1)::DOUBLE) AS distance
  FROM sentences s JOIN sentences nxt ON nxt.doc_id = s.doc_id AND nxt.i = s.i + 1
  LEFT JOIN dot ON dot.doc_id = s.doc_id AND dot.i = s.i
  LEFT JOIN nrm x ON x.doc_id = s.doc_id AND x.i = s.i
  LEFT JOIN nrm y ON y.doc_id = s.doc_id AND y.i = s.i + 1)"""

CUT = "list_extract(list_sort(list(distance)), CAST(floor((count(*) - 1) * {p} / 100) AS INTEGER) + 1)"

SEMANTIC = f"""{DISTANCES},
cuts AS (SELECT doc_id, {CUT.format(p=95)} AS cut FROM distances GROUP BY doc_id),
flagged AS (SELECT s.doc_id, s.i, s.sentence, coalesce(d.distance > c.cut, false) AS brk
  FROM sentences s LEFT JOIN distances d ON d.doc_id = s.doc_id AND d.sentence_no = s.i LEFT JOIN cuts c ON c.doc_id = s.doc_id),
assigned AS (SELECT *, coalesce(sum(brk::INTEGER) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM flagged),
semantic AS (SELECT doc_id, CAST(c AS INTEGER) AS chunk_index, string_agg(sentence, '' ORDER BY i) AS chunk FROM assigned GROUP BY doc_id, c)"""

BLOCK_TAGS = (
    "address|article|aside|blockquote|body|dd|div|dl|dt|figure|footer|h[1-6]|header|html|li|main|nav|ol|"
    "p|pre|section|table|td|th|tr|ul"
)
# The semicolon of these entities is optional in HTML.
BLOCKS = rf"""visible AS (
  SELECT url AS file_path, regexp_replace(html, '(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<!DOCTYPE[^>]*>', '', 'g') AS h FROM pages),
marked AS (SELECT file_path, regexp_replace(regexp_replace(h, '(?i)<br\s*/?>', ' ', 'g'),
    '(?i)<(/?(?:{BLOCK_TAGS}))\b[^>]*>', chr(30) || '\1' || chr(31), 'g') AS h FROM visible),
clean AS (SELECT file_path, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '<[^>]*>', '', 'g'),
    '&quot;?', '"', 'g'), '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&amp;?', '&', 'g') AS h FROM marked),
parts AS (SELECT file_path, unnest(range(0, len(p))) AS n, unnest(p) AS part FROM (SELECT file_path, string_split(h, chr(30)) AS p FROM clean)),
typed AS (SELECT file_path, n, CASE WHEN contains(part, chr(31)) THEN lower(split_part(part, chr(31), 1)) ELSE '' END AS tag,
    trim(regexp_replace(CASE WHEN contains(part, chr(31)) THEN split_part(part, chr(31), 2) ELSE part END, '\s+', ' ', 'g')) AS text FROM parts),
blocks AS (SELECT file_path, CAST(row_number() OVER (PARTITION BY file_path ORDER BY n) - 1 AS INTEGER) AS block_no,
    CASE WHEN regexp_full_match(tag, 'h[1-6]') THEN 'heading' WHEN tag = 'li' THEN 'list_item' ELSE 'paragraph' END AS kind,
    CASE WHEN regexp_full_match(tag, 'h[1-6]') THEN CAST(substr(tag, 2) AS INTEGER) ELSE 0 END AS level, text
  FROM typed WHERE text <> '')"""


def _one_decimal(x: str) -> str:
    return f"printf('%.1f', {x})"


def _size_text(n: str) -> str:
    cases = [f"WHEN {n} = 0 THEN '0 B'"]
    for power, unit in enumerate(["B", "KB", "MB", "GB"]):
        shown = _one_decimal(f"{n} / {float(1024**power)}::DOUBLE")
        cases.append(f"WHEN {n} < {1024 ** (power + 1)} THEN {shown} || ' {unit}'")
    return "CASE " + " ".join(cases) + f" ELSE {_one_decimal(f'{n} / {float(1024**4)}::DOUBLE')} || ' TB' END"


def _duration(s: str) -> str:
    return (
        f"CASE WHEN {s} < 60 THEN {_one_decimal(s)} || 's' WHEN {s} < 3600 THEN {_one_decimal(f'{s} / 60.0::DOUBLE')} || 'm' "
        f"ELSE {_one_decimal(f'{s} / 3600.0::DOUBLE')} || 'h' END"
    )


def _tagged(text: str) -> str:
    for emoji, tag in EMOJI_TAGS.items():
        text = f"replace({text}, '{emoji}', '{tag}')"
    return text


EMOJI_LIST = "[" + ", ".join(f"'{e}'" for e in [*EMOJI_TAGS, "⚠"]) + "]"
NO_MARKS = "replace(replace({}, '#', ''), '*', '')"
TYPE_CASES = " ".join(f"WHEN '{ext}' THEN '{name}'" for ext, name in FILE_TYPES.items())

RUN_SUMMARY = f"""{OUTCOMES}, {RUN_STATS},
good AS (SELECT doc_id, text FROM outcomes WHERE status = 'ok'),
{_windows('good', 'doc_id')},
summary AS (SELECT successful, failed, total_pages, (SELECT count(*) FROM good) AS documents, (SELECT count(*) FROM chunks) AS chunks,
  CAST(384 AS INTEGER) AS embedding_dim, processing_time FROM run)"""

_LINES = [
    (0, ["'# Processing Report'", "'Generated: 2024-01-01 00:00:00'", "'## Summary'",
         "'- **Session ID**: session_20240101_000000'",
         "'- **Files Processed**: ' || successful || '/' || (successful + failed)",
         "'- **Total Pages**: ' || format('{:,}', total_pages)",
         "'- **Documents Created**: ' || format('{:,}', documents)",
         "'- **Chunks Generated**: ' || format('{:,}', chunks)",
         "'- **Processing Time**: ' || printf('%.2f', processing_time) || ' seconds'"]),
    (3, ["'## Configuration'", "'- **Parser**: layout, text'", "'- **Chunking**: ' || chunks || ' chunks'", "'- **Embeddings**: token-hash'",
         "'- **Vector Store**: Parquet, exact search'", "'- **Chunk Size**: 1500 characters'", "'- **Chunk Overlap**: 300 characters'"]),
    (4, ["'## Pipeline Configuration'"] + [
        "'- **" + name + "**: " + value.replace("'", "''") + "'" for name, value in [
            ("docs_folder", "'docs'"), ("output_folder", "'output'"), ("store_name", "'vector_store'"), ("file_suffixes", "('.html',)"),
            ("chunking.chunk_size", "1500"), ("chunking.chunk_overlap", "300"),
            ("chunking.separators", r"['\n## ', '\n### ', '\n\n', '\n', '.', ' ', '']"), ("chunking.keep_separator", "True"),
            ("chunking.use_semantic_chunking", "False"), ("chunking.use_structure", "False"), ("chunking.buffer_size", "1"),
            ("chunking.breakpoint_percentile_threshold", "95"), ("embedding.model_name", "'token-hash'"), ("embedding.dim", "384"),
            ("embedding.normalize", "True"), ("test_queries", "('" + "', '".join(DEFAULT_TEST_QUERIES) + "')"), ("k", "3"),
            ("save_results", "True"), ("test_retrieval", "True"), ("create_report", "True")]]),
]
REPORT = " UNION ALL ".join(
    [f"SELECT CAST({section} AS INTEGER) AS section, '' AS sort_key, CAST({n} AS INTEGER) AS line_no, {line} AS line FROM summary"
     for section, lines in _LINES for n, line in enumerate(lines)]
    + ["SELECT 1, '', 0, '## Successfully Processed Files'", "SELECT 2, '', 0, '## Failed Files'",
       "SELECT 1, file_path, 1, '- ' || file_name || ' (' || n_pages || ' pages)' FROM outcomes WHERE status = 'ok'",
       "SELECT 2, file_path, 1, '- ' || file_name || ': ' || error FROM outcomes WHERE status = 'failed'"]
)

ORACLES: dict[str, str] = {
    "discover_files": f"""WITH {LISTING} SELECT row_number() OVER (ORDER BY path) AS file_no, path,
        regexp_extract(path, '[^/]*$') AS file_name, size_bytes, {_one_decimal('size_bytes / 1024.0::DOUBLE')} AS size_kb,
        {_one_decimal('size_bytes / 1048576.0::DOUBLE')} AS size_mb, {_size_text('size_bytes')} AS size_text
        FROM listing WHERE lower(path) LIKE '%.html'""",
    "file_type_lookup": f"""WITH {LISTING} SELECT page_id, path,
        CASE lower(regexp_extract(path, '(\\.[^./]+)$', 1)) {TYPE_CASES} END AS file_type FROM listing""",
    "load_text_whole": """SELECT file_name, md5(line) AS line_md5, count(*) AS times
        FROM (SELECT source AS file_name, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY ALL""",
    "parse_pages": f"""WITH {BLOCKS} SELECT file_path, 'ok' AS status, 'layout' AS loader_used, block_no, kind, level, text FROM blocks""",
    "html_to_documents": f"""WITH {BLOCKS}, md AS (SELECT file_path, string_agg(CASE kind WHEN 'heading' THEN repeat('#', level) || ' '
          WHEN 'list_item' THEN '- ' ELSE '' END || text, chr(10) || chr(10) ORDER BY block_no) AS page_content FROM blocks GROUP BY file_path)
        SELECT file_path AS source_file, CAST(1 AS INTEGER) AS page, CAST(1 AS INTEGER) AS total_pages, 'layout' AS parser, 'markdown' AS result_type,
        '2024-01-01T00:00:00' AS processed_at, CAST(length(page_content) AS INTEGER) AS content_length, true AS has_layout,
        CAST(NULL AS BOOLEAN) AS has_images, page_content FROM md""",
    "parse_with_fallback": """SELECT doc_id, text AS page_content, source AS source_file, source AS file_name, 'chunks' AS processing_mode,
        CASE WHEN doc_id % 5 = 0 THEN 'text' ELSE 'layout' END AS loader_used FROM documents""",
    "parse_fallback_pages": f"""WITH {BLOCKS}, md AS (SELECT file_path, string_agg(CASE kind WHEN 'heading' THEN repeat('#', level) || ' '
          WHEN 'list_item' THEN '- ' ELSE '' END || text, chr(10) || chr(10) ORDER BY block_no) AS md, string_agg(text, ' ' ORDER BY block_no) AS plain
          FROM blocks GROUP BY file_path)
        SELECT file_path AS source_file, CAST(1 AS INTEGER) AS page, CAST(1 AS INTEGER) AS total_pages, parser AS loader_used, parser,
          CASE parser WHEN 'text' THEN 'text' ELSE 'markdown' END AS result_type, CASE parser WHEN 'layout' THEN true END AS has_layout,
          CASE parser WHEN 'text' THEN plain ELSE md END AS page_content
        FROM (SELECT *, CASE WHEN contains(file_path, '/de/') THEN 'text' ELSE 'layout' END AS parser FROM md)""",
    "structure_chunks": f"""WITH RECURSIVE {BLOCKS},
        packed AS (
          SELECT file_path, block_no, kind, text, length(text) AS used, CAST(0 AS INTEGER) AS chunk_index,
                 CASE WHEN kind = 'heading' THEN text END AS heading FROM blocks WHERE block_no = 0
          UNION ALL
          SELECT b.file_path, b.block_no, b.kind, b.text,
                 CASE WHEN b.kind = 'heading' OR p.used + 1 + length(b.text) > 1500 THEN length(b.text) ELSE p.used + 1 + length(b.text) END,
                 CASE WHEN b.kind = 'heading' OR p.used + 1 + length(b.text) > 1500 THEN p.chunk_index + 1 ELSE p.chunk_index END,
                 CASE WHEN b.kind = 'heading' THEN b.text ELSE p.heading END
          FROM packed p JOIN blocks b ON b.file_path = p.file_path AND b.block_no = p.block_no + 1)
        SELECT file_path, chunk_index, string_agg(text, chr(10) ORDER BY block_no) AS chunk, CAST(count(*) AS INTEGER) AS block_count,
          NULLIF(min_by(coalesce(heading, ''), block_no), '') AS heading,
          CAST(length(string_agg(text, chr(10) ORDER BY block_no)) AS INTEGER) AS chunk_length FROM packed GROUP BY file_path, chunk_index""",
    "heading_paths": """WITH RECURSIVE lines AS (SELECT doc_id, unnest(range(0, len(l))) AS i, unnest(l) AS text, len(l) AS n
          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
        heads AS (SELECT doc_id, i // 3 AS h, (doc_id + 2 * (i // 3)) % 5 + 1 AS level, text, least(3, n - i) AS blocks FROM lines WHERE i % 3 = 0),
        parents AS (SELECT c.doc_id, c.h, any_value(c.text) AS text, any_value(c.blocks) AS blocks, max(p.h) AS parent
          FROM heads c LEFT JOIN heads p ON p.doc_id = c.doc_id AND p.h < c.h AND p.level < c.level GROUP BY c.doc_id, c.h),
        paths AS (SELECT doc_id, h, blocks, 1 AS depth, text AS path FROM parents WHERE parent IS NULL
          UNION ALL SELECT c.doc_id, c.h, c.blocks, p.depth + 1, p.path || ' > ' || c.text FROM paths p JOIN parents c ON c.doc_id = p.doc_id AND c.parent = p.h)
        SELECT doc_id, CAST(h AS INTEGER) AS chunk_index, CAST(blocks AS INTEGER) AS block_count, CAST(depth AS INTEGER) AS depth, path FROM paths""",
    "recursive_chunks_words": f"""WITH RECURSIVE lines AS (SELECT doc_id, source, unnest(range(0, len(l))) AS i, unnest(l) AS line
          FROM (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents)),
        sized AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM lines),
        packed AS (SELECT doc_id, i, n, CASE WHEN n >= 60 THEN NULL ELSE n END AS used, 0 AS chunk FROM sized WHERE i = 0
          UNION ALL SELECT s.doc_id, s.i, s.n,
            CASE WHEN s.n >= 60 THEN NULL WHEN p.used IS NULL OR p.used + s.n > 60 THEN s.n ELSE p.used + s.n END,
            CASE WHEN s.n >= 60 OR p.used IS NULL OR p.used + s.n > 60 THEN p.chunk + 1 ELSE p.chunk END
          FROM packed p JOIN sized s ON s.doc_id = p.doc_id AND s.i = p.i + 1),
        joined AS (SELECT doc_id, any_value(source) AS source, chunk AS c, {_strip("string_agg(line, chr(10) ORDER BY i)")} AS chunk
          FROM packed JOIN sized USING (doc_id, i, n) GROUP BY doc_id, chunk)
        SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY c) - 1 AS INTEGER) AS chunk_index, chunk,
          CAST(length(chunk) AS INTEGER) AS chunk_length FROM joined WHERE chunk <> ''""",
    "run_config_json": f"""WITH {OUTCOMES}, {RUN_STATS} SELECT 'session_20240101_000000' AS session_id, 1500::BIGINT AS chunk_size,
        384::BIGINT AS embedding_dimension, total_files, failed, total_pages FROM run""",
    "chunks_roundtrip": f"WITH {_windows('conversations', 'conv_id, turn', size=200, overlap=50)} SELECT * FROM chunks",
    "vector_store_roundtrip": """SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dim,
        round(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)), 6) AS square FROM embeddings""",
    "store_upsert": """SELECT vec_id, CAST(label + CASE WHEN vec_id % 2 = 1 OR vec_id % 10 = 0 THEN 100 ELSE 0 END AS INTEGER) AS label,
        round(embedding[1], 6) AS x, count(*) OVER () AS total FROM embeddings""",
    "processing_report": f"WITH {RUN_SUMMARY} {REPORT}",
    "page_content_choice": """SELECT doc_id, CASE WHEN doc_id % 7 < 2 THEN text ELSE '# ' || text END AS content FROM documents""",
    "drop_blank_pages": f"WITH {BLANKS} SELECT doc_id, text FROM blanks WHERE {_strip('text')} <> ''",
    "pages_to_documents": f"WITH {PAGE_DOCS} SELECT * FROM page_docs",
    "page_flags": """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN true END AS has_layout, CASE WHEN doc_id % 4 = 1 THEN true END AS has_structured_data,
        CAST(NULLIF(doc_id % 3, 0) AS INTEGER) AS image_count, CASE WHEN doc_id % 3 > 0 THEN true END AS has_images FROM documents""",
    "doc_ids": "SELECT doc_id, source, 'doc_' || (row_number() OVER (ORDER BY doc_id) - 1) AS document_id FROM documents",
    "content_preview": f"""SELECT doc_id, {_strip("left(" + _strip("replace(" + NO_MARKS.format('text') + ", chr(10), ' ')") + ", 150)")} AS preview FROM documents""",
    "content_preview_legacy": f"""SELECT doc_id, {NO_MARKS.format(_strip('left(text, 150)'))} AS preview_150,
        {NO_MARKS.format(_strip('left(text, 200)'))} AS preview_200, replace({_strip('left(text, 150)')}, chr(10), ' ') AS preview_line FROM documents""",
    "sample_content": f"""SELECT doc_id, {_strip('left(text, 200)')} AS sample_200,
        CASE WHEN length(text) > 300 THEN left(text, 300) || '...' ELSE text END AS head_300, left(text, 100) AS head_100 FROM documents""",
    "ascii_safe_text": f"""SELECT doc_id, regexp_replace({_tagged(f"({EMOJI_LIST}[doc_id % 32 + 1] || ' ' || text)")}, '[^\\x00-\\x7F]+', '[?]', 'g') AS ascii_text FROM documents""",
    "format_file_size": f"""SELECT l_orderkey, l_linenumber, size_bytes, {_size_text('size_bytes')} AS size_text
        FROM (SELECT *, CAST(l_orderkey * l_partkey * l_linenumber * 1280 AS BIGINT) AS size_bytes FROM lineitem)""",
    "format_duration": f"SELECT event_id, {_duration('value')} AS duration, {_duration('(value * 60.0::DOUBLE)')} AS duration_x60 FROM events",
    "run_timestamps": """SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp,
        CASE WHEN ts = date_trunc('second', ts) THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS report_date, 'session_' || strftime(ts, '%Y%m%d_%H%M%S') AS session_id FROM events""",
    "redact_secret": """SELECT doc_id, CASE WHEN doc_id % 3 = 2 AND text <> '' THEN '...' END AS hidden,
        CASE WHEN doc_id % 3 = 2 AND text <> '' THEN left(text, 10) || '...' END AS first_ten FROM documents""",
    "error_triage": f"""WITH {OUTCOMES} SELECT doc_id, error,
        CASE doc_id % 13 WHEN 0 THEN 'other' WHEN 1 THEN 'quota' WHEN 2 THEN 'credentials' WHEN 3 THEN 'other' END AS error_class,
        CASE doc_id % 13 WHEN 1 THEN 'wait for the quota to reset or raise the limit'
          WHEN 2 THEN 'check the key, the remaining credits and the region'
          WHEN 0 THEN 'check the connection and the file, then retry' WHEN 3 THEN 'check the connection and the file, then retry' END AS remedy
        FROM outcomes""",
    "char_window_chunks": f"WITH {WINDOWS} SELECT * FROM chunks",
    "recursive_chunks_md": _recursive(MARKDOWN_SEPARATORS, 1500, 300),
    "recursive_chunks_plain": _recursive(PLAIN_SEPARATORS, 1000, 200),
    "split_sentences": f"""WITH {SENTENCES} SELECT doc_id, i AS sentence_no, sentence, CAST(length(sentence) AS INTEGER) AS sentence_length FROM sentences""",
    "abbreviation_scores": r"""WITH texts AS (SELECT CASE doc_id % 3 WHEN 0 THEN text || ' see z. b. there' WHEN 1 THEN text || ' by dr. no one' ELSE text END AS text FROM documents),
        runs AS (SELECT unnest(string_split_regex(lower(text), '[\t-\r ]+')) AS run FROM texts),
        counts AS (SELECT rtrim(run, '.') AS word, count(*) FILTER (run LIKE '%.') AS stopped, count(*) FILTER (run NOT LIKE '%.') AS plain
          FROM runs WHERE regexp_full_match(run, '\p{L}+(\.\p{L}+)*\.?') GROUP BY 1),
        total AS (SELECT sum(stopped)::DOUBLE / sum(stopped + plain) AS p FROM counts)
        SELECT word, stopped, plain, CASE WHEN score = 0 THEN 0.0::DOUBLE ELSE score END AS score FROM (
        SELECT word, stopped, plain, round(2 * ((stopped * ln(0.99::DOUBLE) + plain * ln(1 - 0.99::DOUBLE)) - (stopped * ln(p) + plain * ln(1 - p)))
          * exp(-length(replace(word, '.', ''))::DOUBLE) * (length(word) - length(replace(word, '.', '')) + 1), 6) AS score FROM counts, total)""",
    "sentences_with_abbreviations": r"""WITH found AS (SELECT doc_id, regexp_extract_all(text, '(?s)(.*?[.!?][\t-\r ]+|.+)', 1) AS s
          FROM (SELECT doc_id, 'Ask Dr# Who, z# B# now. ' || regexp_replace(replace(text, '#', chr(1)), '(?i)(^|[^\p{L}\p{N}.])(dr|z|b)\.([\t-\r ])', '\1\2#\3', 'g') AS text FROM documents)),
        listed AS (SELECT doc_id, CAST(unnest(range(0, len(s))) AS INTEGER) AS sentence_no, replace(replace(unnest(s), '#', '.'), chr(1), '#') AS sentence FROM found)
        SELECT *, CAST(length(sentence) AS INTEGER) AS sentence_length FROM listed""",
    "table_pages": r"""SELECT url AS source_file, CASE WHEN page_id % 3 = 0 THEN true END AS has_structured_data,
        CASE WHEN page_id % 3 = 0 THEN '[{"header": true, "rows": [["Page ' || page_id || '", "Page ' || page_id || '"], ["a & b", "' || page_id % 7 || '"], ["a & b", "x|y"]]}]' END AS structured_data,
        CASE WHEN page_id % 3 = 0 THEN '| Page ' || page_id || ' | Page ' || page_id || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| a & b | ' || page_id % 7 || ' |' || chr(10) || '| a & b | x\|y |' ELSE '' END AS shown
        FROM pages""",
    "sentence_groups": f"""WITH {SENTENCES} SELECT doc_id, i AS sentence_no, coalesce(lag(sentence) OVER w, '') || sentence || coalesce(lead(sentence) OVER w, '') AS sentence_group
        FROM sentences WINDOW w AS (PARTITION BY doc_id ORDER BY i)""",
    "neighbour_distance": f"WITH {DISTANCES} SELECT * FROM distances",
    "semantic_breakpoints": f"""WITH {DISTANCES}, cuts AS (SELECT doc_id, {CUT.format(p=95)} AS cut FROM distances GROUP BY doc_id),
        brk AS (SELECT d.doc_id, count(*) AS n, string_agg(CAST(sentence_no AS VARCHAR), ',' ORDER BY sentence_no) AS l
          FROM distances d JOIN cuts USING (doc_id) WHERE distance > cut GROUP BY d.doc_id)
        SELECT s.doc_id, cut, CAST(coalesce(n, 0) AS INTEGER) AS breaks, coalesce(l, '') AS break_after
        FROM (SELECT DISTINCT doc_id FROM sentences) s LEFT JOIN cuts USING (doc_id) LEFT JOIN brk USING (doc_id)""",
    "semantic_chunks": f"""WITH {SEMANTIC} SELECT doc_id, source, chunk_index, chunk, sha256(doc_id || '|' || chunk_index) AS chunk_id,
        CAST(length(chunk) AS INTEGER) AS chunk_length, 'semantic' AS chunking_method, CAST(95 AS INTEGER) AS semantic_threshold,
        CAST(1 AS INTEGER) AS buffer_size, 'token-hash' AS embedding_model, 'built-in' AS embedding_provider
        FROM semantic JOIN documents USING (doc_id)""",
    "threshold_sweep": f"""WITH {DISTANCES}, p AS (SELECT unnest([85, 90, 95, 98])::INTEGER AS threshold),
        cuts AS (SELECT doc_id, threshold, list_extract(list_sort(list(distance)), CAST(floor((count(*) - 1) * threshold / 100) AS INTEGER) + 1) AS cut
          FROM distances CROSS JOIN p GROUP BY doc_id, threshold),
        brk AS (SELECT threshold, count(*) AS n FROM distances JOIN cuts USING (doc_id) WHERE distance > cut GROUP BY threshold),
        docs AS (SELECT count(*) AS n, sum(length(text)) AS chars FROM documents WHERE text <> '')
        SELECT threshold, CAST(docs.n + coalesce(brk.n, 0) AS BIGINT) AS num_chunks, docs.chars::DOUBLE / (docs.n + coalesce(brk.n, 0)) AS avg_size
        FROM p LEFT JOIN brk USING (threshold) CROSS JOIN docs""",
    "chunking_comparison": f"""WITH {SEMANTIC}, {_windows('documents', 'doc_id')},
        sizes AS (SELECT 'semantic' AS method, length(chunk) AS n FROM semantic UNION ALL SELECT 'char_window', chunk_length FROM chunks),
        sums AS (SELECT method, count(*) AS chunks, sum(n)::HUGEINT AS s, sum(n * n)::HUGEINT AS q, min(n) AS min_size, max(n) AS max_size FROM sizes GROUP BY method)
        SELECT method, chunks, s::DOUBLE / chunks AS mean_size, sqrt((chunks::HUGEINT * q - s * s)::DOUBLE) / chunks AS std_size,
          min_size, max_size, sqrt((chunks::HUGEINT * q - s * s)::DOUBLE) / s::DOUBLE AS cv FROM sums""",
    "hash_embed": f"WITH {WINDOWS}, {_cells('chunks', 'doc_id, chunk_index', 'chunk', 'cells')} SELECT * FROM cells",
    "l2_normalize": """SELECT vec_id, CAST(unnest(range(0, 64)) AS INTEGER) AS position, round(unnest(list_transform(v, lambda x: x / n)), 6) AS x
        FROM (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n
          FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 2.5::DOUBLE) AS v FROM embeddings))""",
    "vector_store_stats": f"""WITH {WINDOWS} SELECT count(*) AS total_vectors, CAST(384 AS INTEGER) AS embedding_dimension,
        count(*) * 384 * 4 / 1024.0::DOUBLE / 1024.0::DOUBLE AS memory_mb FROM chunks""",
    "knn_l2": f"WITH {SELF_HITS} SELECT query_id, rank, vec_id, label, round(score, 6) AS score FROM ranked WHERE rank <= 4",
    "knn_l2_blocks": f"WITH {SELF_HITS} SELECT query_id, rank, vec_id, label, round(score, 6) AS score FROM ranked WHERE rank <= 4",
    "knn_pruned": f"WITH {ASKED_HITS} SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ranked WHERE rank <= 4",
    "knn_ties": """WITH copies AS (SELECT e.vec_id, o.embedding FROM embeddings e JOIN embeddings o ON o.vec_id = e.vec_id % 10),
        pairs AS (SELECT q.vec_id AS query_id, s.vec_id, list_distance(q.embedding::DOUBLE[], s.embedding::DOUBLE[]) ** 2 AS score
          FROM embeddings q CROSS JOIN copies s),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9), vec_id) AS INTEGER) AS rank FROM pairs)
        SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ranked WHERE rank <= 4""",
    "knn_threshold": f"WITH {SELF_HITS} SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ranked WHERE rank <= 4 AND score <= 1.3",
    "knn_batch": f"""WITH {WINDOWS}, {_cells('chunks', 'doc_id, chunk_index', 'chunk', 'cells')}, {DEFAULT_QUERIES},
        {_cells('default_queries', 'query_id', 'query', 'qcells')},
        {_search('chunks', 'cells', ['doc_id', 'chunk_index'], 'default_queries', 'query_id', 'qcells', 3)}
        SELECT query_id, rank, doc_id, chunk_index, round(score, 6) AS score FROM hits""",
    "knn_text": f"""WITH {WINDOWS}, {_cells('chunks', 'doc_id, chunk_index', 'chunk', 'cells')},
        {_cells('benchmark', 'item_id', 'text', 'qcells')},
        {_search('chunks', 'cells', ['doc_id', 'chunk_index'], 'benchmark', 'item_id', 'qcells', 4)}
        SELECT item_id, rank, doc_id, chunk_index, round(score, 6) AS score FROM hits""",
    "knn_score_stats": f"""WITH {SELF_HITS} SELECT query_id, count(*) AS hits, round(min(score), 6) AS best, round(max(score), 6) AS worst,
        round(max(score) - min(score), 6) AS score_range, round(avg(score), 6) AS average FROM ranked WHERE rank <= 5 GROUP BY query_id""",
    "hit_display": f"""WITH {PAGE_DOCS}, {_windows('page_docs', 'doc_id', 'page_content')},
        {_cells('chunks', 'doc_id, chunk_index', 'chunk', 'cells')}, {DEFAULT_QUERIES},
        {_cells('default_queries', 'query_id', 'query', 'qcells')},
        {_search('chunks', 'cells', ['doc_id', 'chunk_index'], 'default_queries', 'query_id', 'qcells', 3)}
        SELECT query_id, rank, CASE WHEN doc_id % 9 = 0 THEN 'Unknown' ELSE file_name END AS source, CAST(page AS VARCHAR) AS page, parser,
          chunk_length AS content_length, {_strip("left(" + _strip("replace(" + NO_MARKS.format('chunk') + ", chr(10), ' ')") + ", 150)")} AS preview,
          round(score, 6) AS score
        FROM hits JOIN chunks USING (doc_id, chunk_index) JOIN page_docs USING (doc_id)""",
    "chunk_statistics": f"""WITH {WINDOWS} SELECT count(*) AS count, CAST(sum(chunk_length) AS BIGINT) AS sum, avg(chunk_length) AS mean,
        min(chunk_length) AS min, max(chunk_length) AS max FROM chunks""",
    "chunk_size_histogram": f"""WITH {WINDOWS}, classes AS (SELECT * FROM (VALUES ('Small (0-500)', -1, 500), ('Medium (501-1000)', 500, 1000),
          ('Large (1001-1500)', 1000, 1500), ('Extra Large (1500+)', 1500, 2147483647)) t(size_class, lo, hi))
        SELECT size_class, count(chunk) AS chunks, round(count(chunk) * 100.0::DOUBLE / (SELECT count(*) FROM chunks), 6) AS percent
        FROM classes LEFT JOIN chunks ON chunk_length > lo AND chunk_length <= hi GROUP BY size_class""",
    "chunk_expansion": f"""WITH {WINDOWS} SELECT count(*) AS chunks, count(DISTINCT doc_id) AS documents,
        count(*)::DOUBLE / count(DISTINCT doc_id) AS expansion_ratio FROM chunks""",
    "file_summary": f"""WITH {PAGE_DOCS} SELECT file_name, count(*) AS page_count, CAST(sum(length(page_content)) AS BIGINT) AS total_chars,
        min_by({_strip('left(page_content, 200)')}, page) FILTER ({_strip('left(page_content, 200)')} <> '') AS sample_content FROM page_docs GROUP BY file_name""",
    "file_summary_loader": f"""WITH {PAGE_DOCS} SELECT file_name, count(*) AS documents, CAST(sum(length(page_content)) AS BIGINT) AS total_chars,
        CAST(sum(length(page_content)) // count(*) AS BIGINT) AS avg_chars, CASE WHEN min_by(doc_id, page) % 5 = 0 THEN 'text' ELSE 'layout' END AS loader_used,
        replace({_strip('left(min_by(page_content, page), 150)')}, chr(10), ' ') AS sample FROM page_docs GROUP BY file_name""",
    "loader_usage": "SELECT CASE WHEN doc_id % 5 = 0 THEN 'text' ELSE 'layout' END AS loader_used, count(*) AS documents FROM documents GROUP BY 1",
    "processing_stats": f"""WITH {OUTCOMES}, {RUN_STATS} SELECT *, processing_time / successful AS avg_time_per_success,
        total_pages::DOUBLE / successful AS avg_pages_per_success FROM run""",
    "conversion_summary": f"""WITH {PAGE_DOCS} SELECT (SELECT count(DISTINCT source) FROM documents) AS files_processed, count(*) AS total_documents,
        CAST(sum(content_length) AS BIGINT) AS total_content_length, avg(content_length) AS avg_content_length FROM page_docs""",
    "run_summary": f"WITH {RUN_SUMMARY} SELECT * FROM summary",
    "smallest_file": f"WITH {LISTING} SELECT path, size_bytes FROM listing ORDER BY size_bytes, path LIMIT 1",
    "head_and_rest": """SELECT doc_id, CASE WHEN length(text) > 300 THEN left(text, 300) || '...' ELSE text END AS head,
        CAST(length(text) AS INTEGER) AS content_length, (SELECT greatest(count(*) - 3, 0) FROM documents) AS more FROM documents ORDER BY doc_id LIMIT 3""",
    "discover_written_files": f"""SELECT file_name, size_bytes, {_size_text('size_bytes')} AS size_text
        FROM (SELECT page_id || '.html' AS file_name, CAST(strlen(html) + 1 AS BIGINT) AS size_bytes FROM pages)""",
    "ingest_tables": _recursive(MARKDOWN_SEPARATORS, 1500, 300).replace("WITH RECURSIVE ", f"""WITH RECURSIVE {BLOCKS},
        md AS (SELECT file_path, string_agg(CASE kind WHEN 'heading' THEN repeat('#', level) || ' ' WHEN 'list_item' THEN '- ' ELSE '' END || text,
          chr(10) || chr(10) ORDER BY block_no) AS text FROM blocks GROUP BY file_path),
        documents AS (SELECT page_id AS doc_id, '' AS source, text FROM md JOIN pages ON url = file_path), pieces AS (""", 1).replace(
            "big0 AS (SELECT doc_id, 0 AS s", "WITH RECURSIVE big0 AS (SELECT doc_id, 0 AS s", 1) + """)
        SELECT d.doc_id || '.html' AS file_name, 'ok' AS status, 'layout' AS loader_used, CAST(1 AS INTEGER) AS n_pages,
          CAST(length(d.text) AS BIGINT) AS chars, count(*) AS chunks FROM documents d JOIN pieces p USING (doc_id) GROUP BY d.doc_id, d.text""",
    "chunk_methods": f"""WITH r AS ({_recursive(MARKDOWN_SEPARATORS, 1500, 300)}), s AS (WITH {SEMANTIC} SELECT doc_id, chunk_index, length(chunk) AS n FROM semantic),
        every AS (SELECT 'recursive' AS chunking_method, doc_id, chunk_index, length(chunk) AS n FROM r UNION ALL SELECT 'semantic', doc_id, chunk_index, n FROM s
          UNION ALL SELECT 'structure', doc_id, 0, length(text) FROM documents)
        SELECT chunking_method, doc_id, CAST(chunk_index AS INTEGER) AS chunk_index, sha256(doc_id || '|' || chunk_index) AS chunk_id,
          CAST(n AS INTEGER) AS chunk_length FROM every""",
    "quarantine": f"WITH {OUTCOMES} SELECT file_path, 'parse' AS stage, status, error FROM outcomes",
    "retry_merge": """SELECT url AS file_path, CASE WHEN NOT first_ok AND NOT second_ok THEN 'failed' ELSE 'ok' END AS status,
          CASE WHEN first_ok THEN 'layout' WHEN second_ok THEN 'retry' END AS loader_used,
          CASE WHEN contains(url, '/fr/') AND NOT second_ok THEN 'layout: nested async' WHEN contains(url, '/es/') AND NOT contains(url, '/fr/')
            THEN 'layout: quota exceeded' END AS error,
          CASE WHEN NOT first_ok AND NOT second_ok THEN 0 ELSE 1 END AS n_pages
        FROM (SELECT url, NOT contains(url, '/fr/') AND NOT contains(url, '/es/') AS first_ok,
                contains(url, '/fr/') AND NOT contains(url, '?page=2') AS second_ok FROM pages)""",
    "retry_rounds": """SELECT page_id || '.html' AS file_name, CASE WHEN last_failed THEN 'failed' ELSE 'ok' END AS status,
          CASE WHEN last_failed THEN NULL WHEN attempts = 1 THEN 'first' WHEN attempts = 2 THEN 'second' ELSE 'third' END AS loader_used,
          CASE WHEN NOT last_failed THEN NULL WHEN attempts = 1 THEN 'first: quota exceeded' ELSE 'third: still nested async' END AS error,
          CASE WHEN last_failed THEN 0 ELSE 1 END AS n_pages, attempts, CAST(attempts AS INTEGER) AS last_round
        FROM (SELECT page_id, CASE WHEN page_id % 4 <> 1 THEN 1 WHEN page_id % 8 <> 5 THEN 2 ELSE 3 END::BIGINT AS attempts,
            page_id % 16 = 13 OR (page_id % 4 <> 1 AND page_id % 7 = 3) AS last_failed FROM pages)""",
    "run_lists": """SELECT page_id || '.html' AS file_name, CASE WHEN page_id % 5 = 2 THEN 'failed' ELSE 'processed' END AS list,
          CASE WHEN page_id % 5 <> 2 THEN 1 END AS n_pages, CASE WHEN page_id % 5 <> 2 THEN 'layout' END AS loader_used,
          CASE WHEN page_id % 5 = 2 THEN 'layout: quota exceeded' END AS error FROM pages""",
}
