"""Near-duplicate groups by order MinHash and banded alignment.

A text is its run of five-word shingles, each labelled with its occurrence. A sketch
is the few labelled shingles with the smallest hashes, kept in the order of the text,
so that it depends on order as edits do, not on the set alone. Texts that share one
of several sketches meet in a bucket and are compared by aligning their shingles
inside a band as wide as the threshold lets edits shift them: similarity is aligned
shingles over all shingles of the two texts.

A bucket is never expanded into all its pairs at once. Each round compares the members
of a bucket with a few pivots of it, joins what is similar into classes, and goes on with
buckets that still hold several classes. A pivot was compared with everyone of another
class and leaves; nobody else does, so a bucket closes only when one class is left.
Members of large buckets of several classes (a passage in common) are dealt anew by
their rarest shingles: of n shingles, the n - ceil(threshold * n) + 1 first ones in one
order for all texts. Similar texts have at least one of them in common, so no pair is lost.
Of buckets that hold the same members one is gone through; near copies share many of them.

From the second round on a member meets a pivot only if their outlines allow it. An outline
is the parity of the number of shingles in each of OUTLINE bins: two texts differ in at least
as many shingles as their outlines do in bits, so a pair that differs in more than the
threshold permits is left out by the join itself, without its shingles. Unlike texts with a
passage in common thus cost a few machine words a pair and no row. Outlines of texts of
several thousand shingles are too full to tell; such pairs are aligned as before.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navrecon.llm.common import SMALL_BATCH, carried, importable, leave_room, staged, text_of, trimmed

WORDS, SKETCHES, PICKS = 5, 20, 4
#: Members from which a bucket of several classes counts as large.
LARGE = 64
#: Counters of the shingles' frequencies, and pivots of a bucket in the second and later rounds.
BINS, PIVOTS = 1 << 20, 8
GRAMS_AT_ONCE = 1 << 16
#: Bits of an outline.
OUTLINE = 2048
#: Counters in one row, and keys that are sent to all tasks at most (about 100 MB).
BLOCK, SENT = 1 << 14, 1 << 21
#: Rows of the corpus for each file of a staged table, from the size on at which cores do not decide.
FILE_ROWS = 4096


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SEEDS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(text: str) -> np.ndarray:
    return np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in text.lower().split()], np.uint32)


def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hashes of the occurrence-labelled shingles; fewer words than size make one; none make none."""
    size = min(size, len(words))
    if not size:
        return np.empty(0, np.uint64)
    n = len(words) - size + 1
    grams = np.zeros(n, np.uint64)
    for i in range(size):
        grams = mixed(grams + words[i:i + n].astype(np.uint64) + SEEDS[i])
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if not first.all():
        at = np.arange(n)
        grams[order] = mixed(ordered + (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64) * SEEDS[9])
    return grams


def sketches(grams: np.ndarray, number: int = SKETCHES, picks: int = PICKS) -> list[int]:
    """One signed 64-bit value for each sketch; none for no shingles."""
    if not len(grams):
        return []
    seeds = SEEDS[10:10 + number, None]
    held, values = np.empty((number, 0), np.int64), np.empty((number, 0), np.uint64)
    for start in range(0, len(grams), GRAMS_AT_ONCE):
        part = mixed(grams[None, start:start + GRAMS_AT_ONCE] ^ seeds)
        at = np.broadcast_to(np.arange(start, start + part.shape[1]), part.shape)
        values, held = np.concatenate([values, part], axis=1), np.concatenate([held, at], axis=1)
        if values.shape[1] > picks:
            best = np.argpartition(values, picks - 1, axis=1)[:, :picks]
            values, held = np.take_along_axis(values, best, 1), np.take_along_axis(held, best, 1)
    chosen = grams[np.sort(held, axis=1)]
    out = seeds[:, 0].copy()
    for i in range(chosen.shape[1]):
        out = mixed(out * np.uint64(31) + chosen[:, i])
    return out.view(np.int64).tolist()


def similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """Aligned shingles over all shingles, or 0.0 where it cannot reach the threshold."""
    total = len(a) + len(b)
    need = threshold * total / (1 + threshold)
    if not total or min(len(a), len(b)) < need - 1e-9:
        return 0.0
    order = np.argsort(b)
    place = np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)
    hit = b[order[place]] == a
    i, j = np.flatnonzero(hit), order[place[hit]]
    band = total - 2 * need  # shingles that may stay unaligned, and so the farthest a match can shift
    near = np.abs(i - j) <= band + 1
    j = j[near]
    if len(j) < need - 1e-9:
        return 0.0
    if (np.diff(j) > 0).all():
        aligned = len(j)
    else:  # labels make matches one to one: the longest increasing run is the best alignment
        ends: list[int] = []
        for x in j.tolist():
            at = bisect_left(ends, x)
            ends[at:at + 1] = [x]
        aligned = len(ends)
    found = aligned / (total - aligned)
    return found if found >= threshold - 1e-12 else 0.0


def parts_for(rows: DataFrame) -> int:
    """Files at most of a table with a few numbers for each of rows (staged): what is small is not written as
    a file for every shuffle partition."""
    return max(4 * rows.sparkSession.sparkContext.defaultParallelism, rows.count() // FILE_ROWS + 1)


def set_mark() -> list:
    """Aggregates that tell sets of nodes apart (by 128 bits): h1, h2."""
    return [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"h{i}") for i in (1, 2)]


def text_key():
    """A text's identity: its MD5."""
    return F.unhex(F.md5(F.col("__text").cast("binary")))


def sketch_rows(base: DataFrame) -> DataFrame:
    """(__row, __id, text_key, sketch array<long>) of base (__id, __text)."""
    def run(batches):
        leave_room()
        for batch in batches:
            *keys, texts = batch.columns
            made = pa.array([sketches(shingles(word_hashes(t.as_py()))) for t in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*keys, made], ["__row", "__id", "text_key", "sketch"])

    kind = base.schema["__id"].dataType.simpleString()
    return base.select(F.monotonically_increasing_id().alias("__row"), "__id", text_key().alias("text_key"),
                       "__text").mapInArrow(trimmed(run), f"__row long, __id {kind}, text_key binary, sketch array<long>")


def among(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows of df that a join on column with wanted (staged) can need, so that it shuffles no others.

    Hashes of up to SENT keys go to the tasks. With more keys df stays whole; the join is the same either way.
    """
    if wanted.count() > SENT:
        return df
    keys = wanted.select(F.xxhash64(column).alias("__key"))
    return df.join(F.broadcast(keys), F.xxhash64(df[column]) == keys["__key"], "left_semi")


def without(df: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """The rows of df whose column is not in gone (staged). Up to SENT keys go to the tasks, so that df is not shuffled."""
    return df.join(F.broadcast(gone) if gone.count() <= SENT else gone, column, "left_anti")


def shingle_rows(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, grams): the shingles of the wanted texts (node, text_key), once for each text."""
    def run(batches):
        for batch in batches:
            grams = [shingles(word_hashes(t.as_py())).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.binary())], ["node", "grams"])

    wanted = staged(wanted, "wanted-texts")
    # Copies fold to one row before the shuffle, and texts without a candidate are left out before it.
    once = among(base.select(text_key().alias("text_key"), "__text"), "text_key", wanted).groupBy("text_key").agg(
        F.first("__text").alias("__text"))
    return once.join(wanted, "text_key").select("node", "__text").mapInArrow(trimmed(run), "node long, grams binary")


def outline_type() -> pa.DataType:
    return pa.struct([(f"m{i}", pa.int64()) for i in range(OUTLINE // 64)])


def outlines(grams: DataFrame) -> DataFrame:
    """(node, size, outline) of grams: the number of shingles and, bit by bit, the parity of their number in each bin."""
    def run(batches):
        for batch in batches:
            held = [np.frombuffer(g.as_buffer(), np.uint64) for g in batch.column(1)]
            bits = np.zeros((len(held), OUTLINE), np.uint8)
            for i, g in enumerate(held):
                bits[i] = np.bincount((mixed(g) % np.uint64(OUTLINE)).astype(np.int64), minlength=OUTLINE) & 1
            words = np.packbits(bits, axis=1).view(np.int64)
            outline = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(words[:, i])) for i in range(words.shape[1])],
                                                 fields=list(outline_type()))
            size = pa.array([len(g) for g in held], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, outline], ["node", "size", "outline"])

    fields = ",".join(f"m{i}:bigint" for i in range(OUTLINE // 64))
    return grams.select("node", "grams").mapInArrow(trimmed(run), f"node long, size long, outline struct<{fields}>")


def verified(pairs: DataFrame, grams: DataFrame, threshold: float, parts: int) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    def run(batches):
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                left, right = (np.frombuffer(batch.column(i)[k].as_buffer(), np.uint64) for i in (2, 3))
                if similarity(left, right, threshold):
                    keep.append(k)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    pairs = staged(pairs.coalesce(parts), "pairs")
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    ends = staged(ends.coalesce(parts), "pair-ends")
    some = among(grams.select("node", "grams"), "node", ends)
    left = some.select(F.col("node").alias("a"), F.col("grams").alias("wa"))
    right = some.select(F.col("node").alias("b"), F.col("grams").alias("wb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb").mapInArrow(trimmed(run), "a long, b long")


def components(edges: DataFrame, parts: int | None = None) -> DataFrame:
    """(node, component): each linked node (a long) with the smallest node it is linked to over any way.

    Every round hangs a node's larger, then its smaller neighbours on the smallest one,
    until all are stars: rounds grow with the logarithm of the longest way. Its tables are
    written as at most parts files.
    """
    def kept(df: DataFrame, label: str) -> DataFrame:
        return staged(df if parts is None else df.coalesce(parts), label)

    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Staged: joins with them then have plain shuffles, whose hot partitions (a node with many links) Spark can split.
        least = kept(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = kept(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = kept(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "components")
        # Stars: a node hangs on one other at most, and none on a node that hangs itself.
        hung = now.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
            now.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
        hung = hung.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
        if hung.agg(F.max((F.col("hangs") > 1) | (F.col("hangs") > 0) & (F.col("holds") > 0))).first()[0] is not True:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def merged(found: DataFrame, links: DataFrame, parts: int) -> DataFrame:
    """found (node, component of every node) after new links: only links between components are followed."""
    ends = found.withColumnRenamed("node", "a").withColumnRenamed("component", "ca")
    others = found.withColumnRenamed("node", "b").withColumnRenamed("component", "cb")
    fresh = staged(links.join(ends, "a").join(others, "b").where("ca <> cb").select(
        F.col("ca").alias("a"), F.col("cb").alias("b")).distinct().coalesce(parts), "component-links")
    if fresh.isEmpty():
        return found
    moved = components(fresh, parts).select(F.col("node").alias("component"), F.col("component").alias("into"))
    return staged(found.join(moved, "component", "left").select(
        "node", F.coalesce("into", "component").alias("component")).coalesce(parts), "found")


def central(members: DataFrame, number: int, minor_first: bool = False) -> DataFrame:
    """(key, pivot, pivot_class, pivot_size) for the most central members (key, node, class, reach, size, major) of each bucket.

    What shares buckets with many others lies near the middle of its group, so most
    of the group is similar to it. minor_first takes those outside the bucket's largest
    class first: once all of them were pivots, one class is left. Spark cuts each map
    task's rows to the best ones before the shuffle, so a bucket of any size is a few rows here.
    """
    first = [F.col("class") == F.col("major")] if minor_first else []
    order = Window.partitionBy("key").orderBy(*first, F.desc("reach"), "node")
    return (members.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= number).select(
        "key", F.col("node").alias("pivot"), F.col("class").alias("pivot_class"), F.col("size").alias("pivot_size")))


def pairs_of(members: DataFrame, pivots: DataFrame, threshold: float, known: DataFrame | None = None) -> DataFrame:
    """Each member beside the pivots of its bucket that are of another class and not too short or long for it;
    with known outlines (node, outline), only where these do not differ in too many bits."""
    fits = F.least("size", "pivot_size") >= F.greatest("size", "pivot_size") * F.lit(threshold) - F.lit(1e-6)
    if known is not None:
        members = members.select("key", "node", "class", "size").join(known, "node")
        pivots = pivots.join(known.select(F.col("node").alias("pivot"), F.col("outline").alias("pivot_outline")), "pivot")
        unlike = sum((F.bit_count(F.col("outline")[f"m{i}"].bitwiseXOR(F.col("pivot_outline")[f"m{i}"]))
                      for i in range(OUTLINE // 64)), F.lit(0))
        # Of both texts' shingles, 2 * threshold / (1 + threshold) are aligned at least; the rest may differ.
        fits &= unlike <= (F.col("size") + F.col("pivot_size")) * F.lit((1 - threshold) / (1 + threshold)) + F.lit(1e-6)
    other = F.col("class") != F.col("pivot_class")
    return (members.join(pivots, (members["key"] == pivots["key"]) & other & fits)
                   .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())


def several_classes(told: DataFrame, parts: int) -> DataFrame:
    """told (key, node, class, ...) with n and major, the largest class, of the buckets of several classes;
    of buckets with the same members one."""
    counted = (told.groupBy("key", "class").agg(F.count("*").alias("n"), *set_mark()).groupBy("key").agg(
        F.sum("n").alias("n"), F.count("*").alias("classes"), F.max(F.struct("n", "class"))["class"].alias("major"),
        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")).where("classes > 1"))
    once = counted.groupBy("n", "h1", "h2").agg(F.min(F.struct("key", "major")).alias("first")).select("first.*", "n")
    return told.join(staged(once.coalesce(parts), "open-keys"), "key")


def counters(grams: DataFrame) -> DataFrame:
    """(block, at, n): what each task counts of the shingles of grams, a row for each block of BLOCK counters."""
    def count(batches):
        held = np.zeros(BINS, np.int64)
        for batch in batches:
            if batch.num_rows:
                bins, n = np.unique(np.concatenate([np.frombuffer(g.as_buffer(), np.uint64) for g in batch.column(0)])
                                    % np.uint64(BINS), return_counts=True)
                held[bins.astype(np.int64)] += n
        yield _blocks({b: held[b * BLOCK:(b + 1) * BLOCK] for b in range(BINS // BLOCK)})

    return grams.select("grams").mapInArrow(trimmed(count), "block int, at array<int>, n array<long>")


def _blocks(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    """A row for each block that is not all zeros."""
    at = {b: np.flatnonzero(x) for b, x in held.items() if x.any()}
    return pa.RecordBatch.from_arrays(
        [pa.array(list(at), pa.int32()), pa.array([x.astype(np.int32) for x in at.values()], pa.list_(pa.int32())),
         pa.array([held[b][x] for b, x in at.items()], pa.list_(pa.int64()))], ["block", "at", "n"])


def frequencies(grams: DataFrame) -> np.ndarray:
    """How many shingles of all texts of grams are in each of BINS counters."""
    def fold(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, at, n in zip(*batch.columns, strict=True):
                own = sums.setdefault(block.as_py(), np.zeros(BLOCK, np.int64))
                own[at.values.to_numpy()] += n.values.to_numpy()
        yield _blocks(sums)

    told = counters(grams).repartition("block").mapInArrow(trimmed(fold), "block int, at array<int>, n array<long>").toArrow()
    often = np.zeros(BINS, np.int64)
    for block, at, n in zip(*(told[c].to_pylist() for c in ("block", "at", "n")), strict=True):
        often[block * BLOCK + np.array(at)] = n
    return often


def rarest(members: DataFrame, grams: DataFrame, threshold: float, parts: int) -> DataFrame:
    """(key, node, class, reach, size) of members (node, class, reach, size), once for each of the rarest shingles.

    Texts of similarity threshold share at least threshold * n of either's n shingles.
    So the first one that they share, in any order that is the same for all, is among
    the first n - ceil(threshold * n) + 1 of both. Rare ones come first, a passage in
    common last; frequencies are counted in BINS counters, which only shape the order. What is alone
    in its counter is in no other of these texts and makes no row.
    """
    texts = staged(members.join(grams, "node").coalesce(parts), "large-members")

    often = frequencies(texts.select("grams"))

    def run(batches):
        for batch in batches:
            keys, at = [], []
            for i, data in enumerate(batch.column(4)):
                held = np.frombuffer(data.as_buffer(), np.uint64)
                first = len(held) - math.ceil(threshold * len(held) - 1e-6) + 1
                n = often[held % np.uint64(BINS)]
                chosen = np.lexsort((held, n))[:first]
                keys.append(held[chosen[n[chosen] > 1]].view(np.int64))
                at.append(np.full(len(keys[-1]), i))
            rows = batch.select([0, 1, 2, 3]).take(pa.array(np.concatenate(at)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *rows.columns], ["key", *rows.schema.names])

    return texts.select("node", "class", "reach", "size", "grams").mapInArrow(
        trimmed(run), "key long, node long, class long, reach long, size long")


def classes(texts: DataFrame, grams_of, threshold: float) -> DataFrame:
    """(node, component) of all texts (node, sketch) that are linked to another."""
    def kept(df: DataFrame, label: str) -> DataFrame:
        return staged(df.coalesce(parts), label)

    parts = parts_for(texts)
    keyed = texts.select("node", F.explode("sketch").alias("key"))
    several = keyed.groupBy("key").agg(F.count("*").alias("n"), *set_mark()).where("n > 1")
    several = kept(several.groupBy("n", "h1", "h2").agg(F.min("key").alias("key"), F.count("*").alias("times"))
                   .select("key", "n", "times"), "bucket-sizes")
    members = kept(keyed.join(several, "key"), "buckets")
    reach = kept(members.groupBy("node").agg(F.sum(F.col("n") * F.col("times")).alias("reach")), "reach")
    grams = kept(grams_of(reach.select("node")), "candidate-shingles")
    drawn = staged(outlines(grams), "outlines")
    sizes = kept(reach.join(drawn.select("node", "size"), "node"), "sizes")
    known = drawn.select("node", "outline")
    rest = kept(members.join(sizes, "node").select("key", "node", "reach", "size", "n"), "bucket-members")
    turn, found = 0, None
    while True:
        if found is None:
            open_ = rest.withColumn("class", F.col("node")).withColumn("major", F.col("node"))
        else:
            told = kept(rest.join(found.withColumnRenamed("component", "class"), "node"), "told-buckets")
            open_ = kept(several_classes(told, parts), "open-buckets")
        if open_.isEmpty():
            return found if found is not None else texts.select("node", F.col("node").alias("component")).limit(0)
        columns = ["key", "node", "class", "reach", "size", "n", "major"]
        if turn == 1:
            large = open_.where(F.col("n") > LARGE).select("node", "class", "reach", "size").distinct()
            parted = kept(rarest(large, grams, threshold, parts), "rarest-shingles")
            open_ = kept(several_classes(parted, parts).select(columns).unionByName(
                open_.where(F.col("n") <= LARGE).select(columns)), "parted-buckets")
        # More pivots a round where many classes stay apart, so that rounds do not grow with a bucket.
        width = 1 if turn == 0 else PIVOTS << 2 * (turn - 1)
        pivots = kept(central(open_, width, turn > 1), "pivots")
        links = kept(verified(pairs_of(open_, pivots, threshold, known if turn else None), grams, threshold, parts), "links")
        found = merged(reach.select("node", F.col("node").alias("component")) if found is None else found, links, parts)
        rest = open_.join(pivots.select("key", F.col("pivot").alias("node")), ["key", "node"], "left_anti")
        rest, turn = kept(rest.select("key", "node", "reach", "size"), "bucket-members"), turn + 1


def grouped(base: DataFrame, threshold: float) -> DataFrame:
    """(__row, __id, text_key, class_id, class_size, kept) for each row of base (__id, __text)."""
    importable(base.sparkSession, SMALL_BATCH)
    rows = staged(sketch_rows(base), "sketches")
    # Texts are numbered, so that all that follows moves short rows.
    parts = parts_for(rows)
    numbered = staged(rows.groupBy("text_key").agg(F.first("sketch").alias("sketch")).coalesce(parts)
                      .withColumn("node", F.monotonically_increasing_id()), "texts")
    texts = numbered.where(F.size("sketch") > 0)
    found = classes(texts.select("node", "sketch"),
                    lambda nodes: shingle_rows(base, texts.select("node", "text_key").join(nodes, "node", "left_semi")), threshold)
    linked = staged(numbered.select("text_key", "node").join(found, "node", "left").select(
        "text_key", F.coalesce("component", "node").alias("class")).coalesce(parts), "classes")
    told = staged(rows.select("__row", "__id", "text_key").join(linked, "text_key").coalesce(parts), "class-rows")
    order = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__row").alias("row"))
    best = staged(told.groupBy("class").agg(F.min(order).alias("best"), F.count("*").alias("class_size")).coalesce(parts), "class-heads")
    return told.join(best, "class").select("__row", "__id", "text_key", F.col("best.id").alias("class_id"), "class_size",
                                           (F.col("__row") == F.col("best.row")).alias("kept"))


def near_groups(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, class_id, class_size, kept.

    A class is what similar texts connect; class_id is its smallest id (a null id only
    where there is no other), kept marks the one row that stays. Words are split at
    white space and lower-cased. Texts of fewer than five words are one shingle: only
    equal words make them similar. Equal texts, empty and null ones too, are one
    class. Repeated rows are rows of their own. Other columns are ignored. Sets the session's
    spark.sql.execution.arrow.maxBytesPerBatch (common.importable), so that long texts reach
    Python workers a few at a time.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("__id"), text_of(text_col).alias("__text"))
    return grouped(base, threshold).select(F.col("__id").alias(id_col), "class_id", "class_size", "kept")


def drop_near_copies(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The one row of each class that stays, all columns as they were; of repeated rows with one id and text, any.

    Only rows whose text and id occur among those that go are shuffled; the others stay as they are.
    """
    base = docs.select(carried(docs), F.col(f"`{id_col}`").alias("__id"), text_of(text_col).alias("__text"))
    # Nulls in a struct are equal, so that a null id is an id like others.
    pair = F.struct("text_key", "__id").alias("__pair")
    several = (grouped(base.select("__id", "__text"), threshold).groupBy(pair)
               .agg(F.max("kept").alias("head"), F.min("kept").alias("alone")).where("not alone").drop("alone"))
    several = staged(several.withColumn("__hash", F.xxhash64("__pair")), "not-alone")
    rows = base.select("__doc", "__id", text_key().alias("text_key")).select("__doc", pair)
    told = among(rows, "__pair", several).join(several.drop("__hash"), "__pair", "left").where("head is null or head")
    told = told.dropDuplicates(["__pair"]).select("__doc.*")
    if several.count() > SENT:
        return told
    # An equal hash of another pair only brings a row to the join that need not be there.
    alone = without(rows.withColumn("__hash", F.xxhash64("__pair")), "__hash", several.select("__hash"))
    return alone.select("__doc.*").unionByName(told)
