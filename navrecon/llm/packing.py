"""Packing by shortest pack first over the histogram of lengths.

Documents become pieces of at most the sequence length. Only the histogram of piece
lengths, as many numbers as a sequence has tokens, decides the patterns: lengths are
placed longest first, each into the pattern with most room that fits, and a pattern
that has more copies than needed is split. Pieces then find their place by their
rank among pieces of equal length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navrecon.llm.common import SMALL_BATCH, importable, running, staged, text_of, trimmed
from navrecon.llm.tokens import CACHED, encode_all


def cut_documents(docs: DataFrame, vocabulary: str, size: int, id_col: str, text_col: str,
                  keep_ids: bool, cached: int = CACHED) -> DataFrame:
    """A row for each piece: __id, start, length, ids_crc32, doc_tokens, and ids if asked for."""
    importable(docs.sparkSession, SMALL_BATCH)
    key = docs.schema[id_col].dataType.simpleString()
    schema = f"__id {key}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids

    def pieces(batches):
        for batch in batches:
            rows, ids_of = [], encode_all(vocabulary, batch.column(1), cached=cached)
            for key, ids in zip(batch.column(0).to_pylist(), ids_of, strict=True):
                total = len(ids) // 4
                for start in range(0, total, size):
                    part = ids[4 * start:4 * (start + size)]
                    rows.append((key, start, len(part) // 4, zlib.crc32(part), total, part)[:5 + keep_ids])
                if len(rows) >= 20_000:
                    yield _batch(rows, batch.schema.field(0).type, keep_ids)
                    rows = []
            if rows:
                yield _batch(rows, batch.schema.field(0).type, keep_ids)

    return docs.select(F.col(f"`{id_col}`").alias("__id"), text_of(text_col).alias("__text")).mapInArrow(
        trimmed(pieces), schema)


def _batch(rows, key_type, keep_ids) -> pa.RecordBatch:
    names = ["__id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:5 + keep_ids]
    types = [key_type, *[pa.int64()] * 4, pa.binary()][:5 + keep_ids]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def patterns(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """(copies, lengths) of each pattern: every length is used exactly as often as the histogram says."""
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left, room = histogram[length], size
        while left > 0:
            while room >= length and not by_room[room]:
                room -= 1
            if room < length:  # nothing open has room: new sequences
                by_room[size - length].append((left, (length,)))
                break
            copies, used = by_room[room].pop()
            take = min(copies, left)
            if copies > take:
                by_room[room].append((copies - take, used))
            by_room[room - length].append((take, (*used, length)))
            left -= take
    return [p for room in sorted(by_room) for p in by_room[room]]


def places(found: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) for each slot of each pattern."""
    out, used, sequence = [], defaultdict(int), 0
    for copies, lengths in found:
        offset = 0
        for length in lengths:
            out.append((length, used[length], used[length] + copies, sequence, offset))
            used[length] += copies
            offset += length
        sequence += copies
    return out


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, id_col: str = "doc_id", text_col: str = "text",
         keep_ids: bool = False, cached: int = CACHED) -> DataFrame:
    """A row for each piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A document's ids end with id 1, so a null or empty text is one piece of one id.
    Pieces are cut at multiples of size. Sequences are numbered from 0 without gaps
    and filled from offset 0 without gaps; the rest of size is padding. Repeated rows
    and null ids are packed like others. Other columns are ignored. cached bounds the words
    that a worker keeps with their ids, in time and memory only; the result is the same.
    """
    pieces = staged(cut_documents(docs, vocabulary, size, id_col, text_col, keep_ids, cached), "pieces")
    lengths = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most size rows
    slots = places(patterns({r.length: r.n for r in lengths}, size))
    # The number of slots depends on size, not on the documents: a few for each length.
    # As an Arrow table: a list of tuples would go through an RDD of Python, whose daemon and workers stay beside ours.
    columns = zip(("length", "first", "last", "base", "offset"), [*zip(*slots, strict=True)] or [()] * 5, strict=True)
    slots = docs.sparkSession.createDataFrame(pa.table({c: pa.array(v, pa.int64()) for c, v in columns})).hint("broadcast")
    ranked = running(pieces, ["length"], ["__id", "start", "ids_crc32"], "rank")
    placed = ranked.join(slots, "length").where("rank >= first and rank < last")
    return placed.select(F.col("__id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
                         (F.col("base") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset",
                         *["ids"] * keep_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of each sequence in order, from pack(..., keep_ids=True)."""
    joined = F.aggregate(F.sort_array(F.collect_list(F.struct("offset", "ids"))), F.lit(b"").cast("binary"),
                         lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
