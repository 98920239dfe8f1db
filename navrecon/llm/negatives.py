"""Hard negatives by a vertical scan of decomposed vectors (BOND).

Vectors lie in blocks, one array for each dimension. For an anchor, a block's
dimensions are read in the order of the anchor's descending magnitudes. After every
few of them a row's score lies between its partial sum plus the least and plus the
most that the dimensions not yet read can add, by their smallest and largest values
in the block. Rows whose interval can no longer matter leave the candidate bitmap:
those below the k-th best lower bound, or outside every score window of the anchor.
The first scan finds each anchor's positives; their scores give the windows of the
second, which finds the negatives.

Anchors go in groups of a fixed size to the blocks of vectors, which stay where they
are; a block sends at most k rows for each anchor and window.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navrecon.llm.common import finite, importable, quantised, running, staged

#: Rows of a block, dimensions read between two looks at the bounds, blocks of a task at least (of large tables).
BLOCK, STEP, BLOCKS = 4096, 8, 16
#: Anchors that are sent to all blocks at once: with 64 dimensions 8 MB.
ANCHORS = 16_384
#: Quantised components beyond this count as this; scores of up to 2047 dimensions then fit a long.
LIMIT = 2 ** 26


# ---- inside a task ---------------------------------------------------------

def vertical(q: np.ndarray, cols: np.ndarray, low: np.ndarray, high: np.ndarray, alive: np.ndarray,
             useful) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, exact scores) of the rows of a block that stay useful to the end.

    cols is (dimensions, rows), low and high are its smallest and largest values by
    dimension, alive the bitmap of rows to begin with. useful(lower, upper) tells which
    of the rows left may still matter, by bounds of their scores.
    """
    order = np.argsort(-np.abs(q), kind="stable")
    ends = np.stack([q * low, q * high])[:, order]
    # What the dimensions from place j of the order on add at least and at most.
    rest = np.zeros((2, len(q) + 1), ends.dtype)
    rest[0, :-1] = ends.min(axis=0)[::-1].cumsum()[::-1]
    rest[1, :-1] = ends.max(axis=0)[::-1].cumsum()[::-1]
    left, score = np.flatnonzero(alive), np.zeros(int(alive.sum()), cols.dtype)
    for j in range(0, len(q), STEP):
        if not len(left):
            break
        dims = order[j:j + STEP]
        read = cols[dims] if len(left) == cols.shape[1] else cols[dims[:, None], left]
        score += q[dims] @ read
        after = min(j + STEP, len(q))
        stays = useful(score + rest[0, after], score + rest[1, after])
        if not stays.all():
            left, score = left[stays], score[stays]
    return left, score.astype(np.int64)


def among_best(k: int):
    """A row matters while its upper bound reaches the k-th best lower bound."""
    def useful(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if len(lower) <= k:
            return np.ones(len(lower), bool)
        return upper >= np.partition(lower, -k)[-k]
    return useful


def in_windows(least: np.ndarray, most: np.ndarray, k: int):
    """A row matters while it may be among the k best of a window: scores from least to most."""
    def useful(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lower), bool)
        for a, b in zip(least, most, strict=True):
            may = (upper >= a) & (lower <= b)
            sure = lower[may & (lower >= a) & (upper <= b)]
            if len(sure) > k:
                may &= upper >= np.partition(sure, -k)[-k]
            out |= may
        return out
    return useful


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def exact_kind(cols: np.ndarray, q: np.ndarray) -> type:
    """A number type in which every partial sum is exact; the smaller ones are faster."""
    bound = float(np.abs(cols).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, cols.shape[0])
    return np.float32 if bound < 2 ** 24 else np.float64 if bound < 2 ** 53 else np.int64


def _pairs(batches):
    """For each block of vectors beside a group of anchors: its columns, and a scan for each anchor by its place."""
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            row = {n: batch.column(k)[i] for k, n in enumerate(names)}
            own = {n: np.asarray(row[n].values) for n in ("ids", "labels", "aids", "alabels")}
            dim = row["dim"].as_py()
            cols = np.frombuffer(row["cols"].as_buffer(), np.int32).reshape(dim, len(own["ids"]))
            asked = np.frombuffer(row["avs"].as_buffer(), np.int32).reshape(len(own["aids"]), dim)
            kind = exact_kind(cols, asked)
            cols, asked = cols.astype(kind), asked.astype(kind)
            own["positives"] = row.get("positives")
            yield own, partial(_scan, asked, cols, cols.min(axis=1), cols.max(axis=1))


def _scan(asked, cols, low, high, at, alive, useful):
    return vertical(asked[at], cols, low, high, alive, useful)


def _add(columns: list[list[np.ndarray]], values) -> None:
    for column, value in zip(columns, values, strict=True):
        column.append(value)


def _batch(columns: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    joined = [np.concatenate(c) if c else np.empty(0, np.int64) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in joined], names)


def _positives(k: int):
    def run(batches):
        for own, scan in _pairs(batches):
            out: list[list[np.ndarray]] = [[], [], []]
            for at, anchor in enumerate(own["aids"]):
                alive = (own["labels"] == own["alabels"][at]) & (own["ids"] != anchor)
                left, score = scan(at, alive, among_best(k))
                ids = own["ids"][left]
                top = best(ids, score, k)
                _add(out, (np.full(len(top), anchor), ids[top], score[top]))
            yield _batch(out, ["anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(k: int, share: int):
    def run(batches):
        for own, scan in _pairs(batches):
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for at, anchor in enumerate(own["aids"]):
                wanted = own["positives"][at].as_py()
                most = np.array([w["positive_score"] for w in wanted], np.int64)
                least = -((-share * most) // 100)
                left, score = scan(at, own["labels"] != own["alabels"][at], in_windows(least, most, k))
                ids = own["ids"][left]
                for w, a, b in zip(wanted, least, most, strict=True):
                    inside = np.flatnonzero((score >= a) & (score <= b))
                    top = inside[best(ids[inside], score[inside], k)]
                    _add(out, (*(np.full(len(top), x) for x in (anchor, w["positive_id"], w["positive_score"])),
                               ids[top], score[top]))
            yield _batch(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return run


def _decomposed(batches):
    """Rows (id, label, v, dim) to blocks of one length with an array for each dimension."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            for i in range(0, len(own), BLOCK):
                part = batch.take(pa.array(own[i:i + BLOCK]))
                flat = np.asarray(part.column("v").flatten()).astype(np.int32).reshape(part.num_rows, dim)
                yield pa.RecordBatch.from_arrays([
                    pa.array([dim], pa.int32()), *[pa.array([part.column(c).to_numpy()], pa.list_(pa.int64()))
                                                   for c in ("id", "label")],
                    pa.array([np.ascontiguousarray(flat.T).tobytes()], pa.binary())], ["dim", "ids", "labels", "cols"])


# ---- on Spark --------------------------------------------------------------

def label_number(rows: DataFrame, label: Column) -> Column:
    """Whole numbers stand for themselves, other labels for their hash of 64 bits."""
    kind = rows.select(label.alias("x")).schema["x"].dataType
    return label.cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(label)


def usable(rows: DataFrame, label: Column, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """(id, label, v, dim): one row for each id that takes part."""
    good = finite(vec_col) & label.isNotNull() & F.col(f"`{id_col}`").isNotNull()
    taken = rows.where(good).select(F.col(f"`{id_col}`").cast("long").alias("id"), label_number(rows, label).alias("label"),
                                    quantised(vec_col, scale, LIMIT).alias("v"))
    return (taken.groupBy("id").agg(F.min(F.struct("label", "v")).alias("s"))
                 .select("id", "s.label", "s.v").withColumn("dim", F.size("v")))


def mine_negatives(rows: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5,
                   share: int = 80, scale: float = 256.0, id_col: str = "vec_id",
                   vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score).

    Vectors are quantised to floor(scale * x) (components beyond LIMIT count as LIMIT);
    a score is the integer inner product with the anchor, ties go to the smaller id. An
    anchor's positives are its best `positives` rows with its label, its negatives for a
    positive the best `negatives` rows of other labels with scores from share percent of
    the positive's score up to it; fewer, if there are fewer, and none for a positive
    with a negative score. is_anchor and label are columns of rows. Rows with a null id
    or label, a null vector or one with a null or non-finite component take no part; of
    rows with one id the smallest by label and vector stands for the id. Vectors of
    unlike length are not compared, empty ones score 0. Other columns are ignored.
    """
    spark = rows.sparkSession
    importable(spark)
    anchor_ids = rows.where(is_anchor).select(F.col(f"`{id_col}`").cast("long").alias("id")).distinct()
    held = staged(usable(rows, label, scale, id_col, vec_col), "vectors")
    tasks = max(1, -(-held.count() // (BLOCK * BLOCKS)), min(spark.sparkContext.defaultParallelism, held.count() // 256))
    blocks = staged(held.repartition(tasks, "id").mapInArrow(
        _decomposed, "dim int, ids array<bigint>, labels array<bigint>, cols binary"), "vector-blocks")
    asked = staged(held.join(anchor_ids, "id"), "anchors")
    ranked = staged(running(asked, ["dim"], ["id"], "at").withColumn(
        "part", F.floor(F.col("at") / ANCHORS).cast("int")), "anchor-groups")
    parts = ranked.agg(F.max("part")).first()[0]
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                    "positive_score long, negative_score long")
    for part in range(0 if parts is None else parts + 1):
        out = out.unionByName(_one_group(blocks, ranked.where(F.col("part") == part), positives, negatives, share))
    return out


def _packed(anchors: DataFrame, *more: str) -> DataFrame:
    """A group of at most ANCHORS anchors of one length as one row, to be sent to every block of that length."""
    fields = ["id", "label", "v", *more]
    lists = anchors.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("r"))

    def bytes_of(batches):
        for batch in batches:
            vs = [np.asarray(batch.column("vs")[i].values).astype(np.int32).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) if n != "vs" else pa.array(vs, pa.binary()) for n in batch.schema.names],
                ["avs" if n == "vs" else n for n in batch.schema.names])

    listed = lists.select("dim", F.col("r.id").alias("aids"), F.col("r.label").alias("alabels"),
                          *[F.col(f"r.{m}").alias(m) for m in more], F.flatten("r.v").alias("vs"))
    schema = T.StructType([T.StructField("avs", T.BinaryType()) if f.name == "vs" else f for f in listed.schema])
    return listed.mapInArrow(bytes_of, schema)


def _one_group(blocks: DataFrame, anchors: DataFrame, positives: int, negatives: int, share: int) -> DataFrame:
    """The negatives of a group of anchors."""
    # At most ANCHORS vectors for each length: a bounded broadcast, no block of vectors travels.
    near = blocks.join(F.broadcast(_packed(anchors)), "dim").mapInArrow(
        _positives(positives), "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    kept = near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives)
    windows = staged(kept.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(
        F.struct("positive_id", "positive_score"))).alias("positives")), "positives")
    found = blocks.join(F.broadcast(_packed(anchors.join(windows, "id"), "positives")), "dim").mapInArrow(
        _negatives(negatives, share),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranks = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return staged(ranks.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
                  "negatives")
