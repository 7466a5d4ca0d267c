"""Best-fit packing of tokenized documents by hierarchical residual packing.

Documents become pieces of at most one sequence. Groups of pieces are packed best-fit on their own; nearly full
bins are emitted, underfull ones go up a tree of groups as items, where best-fit runs again. Only
places move between tasks: no text and no token ids are shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pagemill.llm.columns import whole_text
from pagemill.llm.tokens import encoder
from pagemill.session import written

CAPACITY = 2048
# A bin with at most this much room left is emitted.
SLACK = 8
# Pieces of one group. A round without fewer groups than the last is tried as long as it saves this share of the bins.
GROUP_ITEMS = 50_000
LEAST_GAIN = 1e-3
CHUNK_CHARS = 1 << 21

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
MEMBER = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>"


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for n, text in enumerate(texts):
        if size and size + len(text) > CHUNK_CHARS:
            yield first, n
            first, size = n, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def cut_points(length: int, capacity: int) -> list[int]:
    """Starts of the pieces of a document; only the first may be shorter than the capacity."""
    first = length % capacity or capacity
    return [0, *range(first, length, capacity)]


def tokenize(df: DataFrame, path: str, id_column: str, text: str, capacity: int, with_ids: bool) -> DataFrame:
    """The pieces of every document; with ``ids``, their token ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in _chunks(texts):
                tokens, offsets = coder.encode(texts[a:b])
                tokens = tokens.astype("<u4")
                rows = []
                for n in range(b - a):
                    size = int(offsets[n + 1] - offsets[n])
                    for piece, start in enumerate(cuts := cut_points(size, capacity)):
                        end = cuts[piece + 1] if piece + 1 < len(cuts) else size
                        part = tokens[offsets[n] + start : offsets[n] + end]
                        row = (ids[a + n], piece, start, end - start, zlib.crc32(part.tobytes()))
                        rows.append((*row, part.astype(np.int32)) if with_ids else row)
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)],
                )

    plain = df.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return plain.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: items by falling size, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin with room r is open
    for item in sorted(range(len(sizes)), key=lambda n: (-sizes[n], n)):
        size = sizes[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
            bins[number].append(item)
        else:
            room, number = capacity, len(bins)
            bins.append([item])
        left = room - size
        if left:
            open_bins[left].append(number)
            rooms |= 1 << left
    return bins


def _pack_group(table: pa.Table, capacity: int, slack: int, level: int) -> pa.Table:
    """Bins of one group, with those that are nearly full marked."""
    sizes, members = table["size"].to_pylist(), table["members"].to_pylist()
    group = table["group"][0].as_py() if table.num_rows else 0
    order = sorted(range(len(sizes)), key=lambda n: [(m["doc_id"] is None, m["doc_id"] or 0, m["piece"], m["ids_crc32"]) for m in members[n][:1]])
    sizes, members = [sizes[n] for n in order], [members[n] for n in order]
    rows = []
    for number, items in enumerate(best_fit(sizes, capacity)):
        placed, offset = [], 0
        for item in items:
            placed += [m | {"offset": m["offset"] + offset} for m in members[item]]
            offset += sizes[item]
        rows.append((offset, placed, offset >= capacity - slack, (level << 56) + (group << 24) + number))
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    fields = [("size", pa.int64()), ("members", table.schema.field("members").type), ("full", pa.bool_()), ("sequence_id", pa.int64())]
    return pa.table([pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _packer(capacity: int, slack: int, level: int):
    def run(table: pa.Table) -> pa.Table:
        return _pack_group(table, capacity, slack, level)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Place every piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``pieces`` should be a written table: its rows are dealt to groups by their number there, so equal ones are spread. The
    underfull bins of a round are the items of the next, in as many groups as their pieces ask for, dealt
    by hash. That ends with one group, or with bins that hardly fit together any more: a round that does not get along with
    fewer groups and leaves nearly as many bins as there were items.
    """
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    left = pieces.count()
    groups = max(1, -(-left // group_items))
    items = pieces.select(
        F.pmod(F.monotonically_increasing_id(), F.lit(groups)).alias("group"),
        F.col("length").alias("size"),
        F.array(member).cast(f"array<{MEMBER}>").alias("members"),
    )
    schema = f"size long, members array<{MEMBER}>, full boolean, sequence_id long"
    done, level, before = None, 0, groups
    while True:
        packed = written(items.groupBy("group").applyInArrow(_packer(capacity, slack, level), schema), f"bins_{level}")
        bins, open_bins, open_pieces = packed.agg(
            F.count(F.lit(1)), F.count_if(~F.col("full")),
            F.coalesce(F.sum(F.when(~F.col("full"), F.size("members"))), F.lit(0)),
        ).first()
        following = max(1, -(-open_pieces // group_items))
        stuck = level > 0 and groups >= before and bins > left * (1 - LEAST_GAIN)
        last = groups == 1 or stuck or not open_bins
        full = packed if last else packed.where("full")
        done = full if done is None else done.union(full)
        if last:
            break
        level, before, groups, left = level + 1, groups, following, open_bins
        items = packed.where("not full").select(
            F.pmod(F.xxhash64("sequence_id", F.lit(level)), F.lit(groups)).alias("group"), "size", "members"
        )
    return done.select("sequence_id", F.explode("members").alias("m")).select(
        "m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset"
    )


def pack_documents(
    df: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    A document is its token ids followed by id 0; only longer ones are cut, into pieces of
    ``capacity`` tokens of which the first may be shorter. NULL and empty texts are the one id 0. Repeated
    rows are packed as often as they occur; rows without an id are packed with a NULL id. A very long text is many pieces,
    made by one task. Other columns are passed over, and an empty table gives no rows. ``tokenizer`` is the path of the vocabulary, readable by all executors.
    """
    pieces = written(tokenize(df, tokenizer, id_column, text, capacity, with_ids=False), "pieces")
    return pack(pieces, capacity)


def sequences(
    df: DataFrame, placed: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, length, ids``, at most ``capacity`` ids each.

    The ids of repeated rows are equal, so each place takes those of any of them.
    """
    keys = ["doc_id", "piece", "ids_crc32"]
    parts = tokenize(df, tokenizer, id_column, text, capacity, with_ids=True)
    parts = parts.withColumn("key", F.struct(*keys)).groupBy("key").agg(F.first("ids").alias("ids"))
    joined = placed.withColumn("key", F.struct(*keys)).join(parts, "key")
    return joined.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.flatten(
            F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda part: part["ids"])
        ).alias("ids"),
    )
