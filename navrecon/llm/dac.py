"""Token ids as directly addressable codes.

The ids of documents in ascending order are split into bytes: level 0 holds the low
byte of every id, and a bitmap says which ids go on; level 1 holds the next byte of
those only, and so on. A rank directory counts the set bits before each 512, so the
place of an id's next byte is a directory entry plus the bits since then, and any id
can be read without decoding what stands before it.

The file format is Parquet with one row for each segment of whole documents:
part, segment, n_tokens, doc_ids, doc_tokens, levels, bitmaps, ranks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navrecon.llm.common import importable, text_of
from navrecon.llm.tokens import encode_all

#: Ids that a segment is closed at; a longer document is a segment of its own.
SEGMENT = 1 << 18
DIRECTORY = 512


def encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """(levels, bitmaps, ranks) of unsigned ids. The last level has no bitmap and no ranks."""
    levels, bitmaps, ranks, rest = [], [], [], ids.astype(np.uint32)
    while True:
        levels.append((rest & 0xFF).astype(np.uint8).tobytes())
        more = rest > 0xFF
        if not more.any():
            return levels, bitmaps, ranks
        bits = np.packbits(more, bitorder="little")
        ends = np.add.reduceat(more, np.arange(0, len(more), DIRECTORY)).cumsum()
        bitmaps.append(bits.tobytes())
        ranks.append(np.concatenate([[0], ends[:-1]]).astype("<u4").tobytes())
        rest = rest[more] >> 8


def decode(levels: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a segment."""
    parts = [np.frombuffer(b, np.uint8).astype(np.uint32) for b in levels]
    out = parts[-1]
    for level in range(len(bitmaps) - 1, -1, -1):
        low = parts[level]
        more = np.unpackbits(np.frombuffer(bitmaps[level], np.uint8), count=len(low), bitorder="little").astype(bool)
        low[more] |= out << 8
        out = low
    return out


def token_at(levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes], i: int) -> int:
    """The i-th id of a segment: a few bytes of each level are read, nothing is decoded."""
    value = 0
    for level, data in enumerate(levels):
        value |= data[i] << (8 * level)
        if level == len(bitmaps) or not bitmaps[level][i >> 3] >> (i & 7) & 1:
            return value
        block = i // DIRECTORY
        before = int.from_bytes(ranks[level][4 * block:4 * block + 4], "little")
        first = block * DIRECTORY // 8
        word = int.from_bytes(bitmaps[level][first:i // 8 + 1], "little") & ((1 << (i - block * DIRECTORY)) - 1)
        i = before + word.bit_count()
    return value


def _segment(part: int, number: int, keys: list, counts: list[int], ids: list[bytes], schema) -> pa.RecordBatch:
    levels, bitmaps, ranks = encode(np.frombuffer(b"".join(ids), "<u4"))
    values = [part, number, sum(counts), keys, counts, levels, bitmaps, ranks]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def write_ids(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
              segment: int = SEGMENT) -> None:
    """Write the ids of whole texts, each ended by id 1, in ascending order of id.

    A null or empty text is id 1 alone; a null id comes first. Rows with equal ids are
    ordered by a hash of the text. Other columns are ignored; an empty table gives no segment.
    """
    importable(docs.sparkSession)
    key = docs.schema[id_col].dataType.simpleString()
    layout = (f"part int, segment int, n_tokens long, doc_ids array<{key}>, doc_tokens array<long>, "
              "levels array<binary>, bitmaps array<binary>, ranks array<binary>")

    def segments(batches):
        from pyspark import TaskContext
        part, number, keys, counts, held, n = TaskContext.get().partitionId(), 0, [], [], [], 0
        schema = None
        for batch in batches:
            kind = batch.schema.field(0).type
            schema = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()),
                                ("doc_ids", pa.list_(kind)), ("doc_tokens", pa.list_(pa.int64())),
                                *[(c, pa.list_(pa.binary())) for c in ("levels", "bitmaps", "ranks")]])
            for key, ids in zip(batch.column(0).to_pylist(), encode_all(vocabulary, batch.column(1)), strict=True):
                if held and n + len(ids) // 4 > segment:
                    yield _segment(part, number, keys, counts, held, schema)
                    number, keys, counts, held, n = number + 1, [], [], [], 0
                keys.append(key)
                counts.append(len(ids) // 4)
                held.append(ids)
                n += len(ids) // 4
        if held:
            yield _segment(part, number, keys, counts, held, schema)

    work = docs.select(F.col(f"`{id_col}`").alias("__id"), text_of(text_col).alias("__text"))
    # Texts are shuffled before they become ids: sampling for the ranges reads texts, never encodes them.
    order = ["__id", "__own"]
    dealt = (work.withColumn("__own", F.xxhash64("__text")).repartitionByRange(*order)
                 .sortWithinPartitions(*order).select("__id", "__text"))
    dealt.mapInArrow(segments, layout).write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with `first`, the number of ids before each: sums of parts, then within a part."""
    rows = spark.read.parquet(path)
    sizes = rows.select("part", "segment", "n_tokens")
    by_part = (sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(
                   Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("of_parts")))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(by_part, "part")
                   .select("part", "segment", (F.col("of_parts") + F.col("inside")).alias("first")))
    return rows.join(firsts, ["part", "segment"])


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """A row for each document, decoded from the files: id_col, start, n_tokens, ids (32-bit little-endian bytes)."""
    importable(spark)
    rows = read_segments(spark, path)
    key = rows.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data = decode(row["levels"], row["bitmaps"]).astype("<u4").tobytes()
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                keys = pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type)
                for i in range(0, len(ends), 1024):
                    a, b = starts[i:i + 1024], ends[i:i + 1024]
                    # The documents' ids lie one after the other: cut by offsets, without a copy for each.
                    cuts = (4 * (np.append(a, b[-1]) - a[0])).astype(np.int32)
                    ids = pa.Array.from_buffers(pa.binary(), len(a), [
                        None, pa.py_buffer(cuts), pa.py_buffer(data[4 * int(a[0]):4 * int(b[-1])])])
                    yield pa.RecordBatch.from_arrays(
                        [keys[i:i + 1024], pa.array(a + row["first"]), pa.array(b - a), ids],
                        [id_col, "start", "n_tokens", "ids"])

    narrow = rows.select("doc_ids", "doc_tokens", "levels", "bitmaps", "first")
    return narrow.mapInArrow(documents, f"`{id_col}` {key}, start long, n_tokens long, ids binary")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, token) for each distinct position in the corpus; one outside gives no row.

    A position's segment is found by its rank among segment starts, then addressed directly.
    """
    importable(spark)
    rows = read_segments(spark, path)
    last = F.col("first") + F.col("n_tokens")
    # Segments and positions meet in ranges of SEGMENT ids; a segment spans few of them.
    spread = rows.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("first") / SEGMENT), F.floor((last - 1) / SEGMENT))))
    asked = (positions.select(F.col("position").cast("long").alias("position")).distinct()
             .withColumn("cell", F.floor(F.col("position") / SEGMENT)))
    found = (asked.join(spread.select("cell", "part", "segment", "first", "n_tokens"), "cell")
             .where((F.col("position") >= F.col("first")) & (F.col("position") < last))
             .groupBy("part", "segment").agg(F.collect_list("position").alias("positions")))

    def pick(batches):
        for batch in batches:
            for row in batch.to_pylist():
                got = [token_at(row["levels"], row["bitmaps"], row["ranks"], p - row["first"]) for p in row["positions"]]
                yield pa.RecordBatch.from_arrays([pa.array(row["positions"], pa.int64()), pa.array(got, pa.int64())],
                                                 ["position", "token"])

    return (rows.join(found, ["part", "segment"]).select("levels", "bitmaps", "ranks", "first", "positions")
                .mapInArrow(pick, "position long, token long"))

