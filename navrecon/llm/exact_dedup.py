"""Exact dedup by composable polynomial fingerprints.

A text without white space is a polynomial in a fixed base over two primes. It is cut
into chunks of bytes that are hashed in parallel; a chunk's hash, shifted by the base
to the power of the bytes after it, adds up to the hash of the whole, so that a huge
document is the sum of partial results and no task needs it whole again. Equal
fingerprints are then compared chunk by chunk: within a group, each chunk must be the
same bytes in all texts, of which equal ones fold before the shuffle, so that it copes
with any number of copies. A fingerprint with unequal texts (a collision) is
split by the SHA-256 of its texts. Texts whose fingerprint nobody shares are not shuffled,
and the table is staged once, each text in it once.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navrecon.llm.common import SMALL_BATCH, SPACE, carried, importable, leave_room, staged, text_of, with_rows
from navrecon.llm.near_dedup import SENT, without

CHUNK = 1 << 16
#: Two primes below 2**31 and a base for each: products stay below 2**63.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)


@lru_cache(maxsize=8)
def powers(base: int, prime: int) -> np.ndarray:
    """base**(CHUNK-1) ... base**0 modulo prime."""
    out, value = np.empty(CHUNK, np.int64), 1
    for i in range(CHUNK - 1, -1, -1):
        out[i], value = value, value * base % prime
    return out


def chunk_hash(chunk: bytes | pa.Buffer, tail: int, base: int, prime: int) -> int:
    """Hash of the chunk, shifted by the tail bytes that follow it in its text."""
    data = np.frombuffer(chunk, np.uint8).astype(np.int64) + 1
    own = int(np.dot(data, powers(base, prime)[CHUNK - len(data):])) % prime
    return own * pow(base, tail, prime) % prime


def shifted_hashes(primes: tuple[int, int]):
    """Arrow function: the shifted hashes of binary chunks, one for each prime."""
    @F.arrow_udf("struct<a:long,b:long>")
    def hashes(chunk: pa.Array, tail: pa.Array) -> pa.Array:
        leave_room()
        # A chunk leaves Arrow when it is hashed, so that a batch is not held twice.
        return pa.StructArray.from_arrays(
            [pa.array([chunk_hash(c.as_buffer(), t, base, prime) for c, t in zip(chunk, tail.to_pylist(), strict=True)], pa.int64())
             for base, prime in zip(BASES, primes, strict=True)], ["a", "b"])
    return hashes


def stripped(column):
    """The text without [\\x20\\x09-\\x0D]."""
    return F.translate(column, SPACE, "")


def chunks(base: DataFrame, *columns: str) -> DataFrame:
    """__row, the columns, __at, __tail (bytes after the chunk), __chunk for each piece of each text."""
    return (base.select("__row", *columns, stripped(F.col("__text")).cast("binary").alias("__bin"))
                .withColumn("__size", F.octet_length("__bin").cast("long"))
                .withColumn("__at", F.explode(F.sequence(
                    F.lit(0), F.greatest(F.lit(0), F.floor((F.col("__size") - 1) / CHUNK).cast("int")))))
                .select("__row", *columns, "__at", "__size",
                        F.greatest(F.lit(0), F.col("__size") - (F.col("__at").cast("long") + 1) * CHUNK).alias("__tail"),
                        F.substring("__bin", F.col("__at") * CHUNK + 1, F.lit(CHUNK)).alias("__chunk")))


def groups(base: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row for each __row of base (__row, __id, __text): id, keep id, group_size, kept, text_sha256."""
    importable(base.sparkSession, SMALL_BATCH)
    hashed = (chunks(base).withColumn("__h", shifted_hashes(primes)("__chunk", "__tail"))
              .groupBy("__row").agg((F.sum("__h.a") % primes[0]).alias("__a"), (F.sum("__h.b") % primes[1]).alias("__b"),
                                    F.max("__size").alias("__size")))
    facts = base.select("__row", "__id", F.char_length("__text").alias("__points"),
                        F.sha2(stripped(F.col("__text")), 256).alias("__sha"))
    marks = staged(hashed.join(facts, "__row"), "fingerprints")
    mark = ["__a", "__b", "__size"]
    # Group tables are staged, so that joins with them have plain shuffles, whose hot partitions Spark can split.
    several = staged(marks.groupBy(*mark).agg(F.count("*").alias("__n")).where("__n > 1").drop("__n"), "several")
    rows = staged(marks.join(several, mark).select("__row", *mark), "equal-fingerprints")
    # Equal chunks fold to one row in each task and meet by their bytes, so that a text is shuffled once at most; then only places are counted.
    held = rows.drop("__size")
    compared = chunks(base.join(F.broadcast(held) if held.count() <= SENT else held, "__row"), "__a", "__b")
    different = compared.select(*mark, "__at", "__chunk").distinct().groupBy(*mark, "__at").agg(F.count("*").alias("__n"))
    clash = different.where("__n > 1").select(*mark).distinct().withColumn("__clash", F.lit(True))
    parted = (marks.join(clash, mark, "left")
              .withColumn("__part", F.when(F.col("__clash"), F.col("__sha")).otherwise(F.lit(""))))
    parted = staged(parted.drop("__clash"), "fingerprint-groups")
    best = F.struct((-F.col("__points")).alias("p"), F.col("__id").isNull().alias("none"), F.col("__id").alias("id"),
                    F.col("__row").alias("row"))
    kept = staged(parted.groupBy(*mark, "__part").agg(F.min(best).alias("__best"), F.count("*").alias("__n")), "kept")
    return parted.join(kept, [*mark, "__part"]).select(
        "__row", F.col("__id").alias("id"), F.col("__best.id").alias("keep_id"), F.col("__n").alias("group_size"),
        (F.col("__row") == F.col("__best.row")).alias("kept"), F.col("__sha").alias("text_sha256"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row for each row of docs: id_col, keep_id, group_size, kept, text_sha256 (of the text without white space).

    Of equal texts the row with the most code points in the original text stays,
    then the smallest id, then one of the repeated rows. Null text is empty, empty
    texts are equal to each other; a null id is the largest. Other columns are ignored.
    """
    base = with_rows(docs.select(F.col(f"`{id_col}`").alias("__id"), text_of(text_col).alias("__text")), "texts")
    return groups(base, primes).drop("__row").withColumnRenamed("id", id_col)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that exact_groups drops; all columns as they were."""
    held = with_rows(docs.select(carried(docs)), "texts")
    doc = F.col("__doc")
    base = held.select("__row", doc.getField(id_col).alias("__id"),
                       F.coalesce(doc.getField(text_col).cast("string"), F.lit("")).alias("__text"))
    gone = staged(groups(base).where("not kept").select("__row"), "copies")
    return without(held, "__row", gone).select("__doc.*")
