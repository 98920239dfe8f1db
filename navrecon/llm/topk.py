"""Exact top-k by distributed histogram selection.

Every query is scored against every vector, block by block. Rounds of histograms
narrow the score of the k-th best: each round adds up, over all blocks, how many
scores lie in each bin of the query's current interval, and goes on inside the bin
that holds the k-th. When the bin is one score wide it is the k-th score; a last pass
keeps what reaches it and breaks ties by the smaller id. A block sends only the bins
above its own k-th best (the global k-th cannot be lower), so what is shuffled does
not grow with the size of a block.

Queries go in groups of a bounded size to the blocks of vectors, which stay where they
are: whatever Spark takes the size of a table for, no broadcast holds vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navrecon.llm.common import importable, staged
from navrecon.session import fresh_dir

QUERIES, VECTORS, BINS = 512, 4096, 256
#: Dimensions that the sizes of blocks and groups are meant for, components of the queries that are sent to all blocks at
#: once (8 MB), vectors of a block at least.
DIM, SENT, FEW = 64, 2 ** 20, 256
#: Components and scores beyond this count as this.
LIMIT = 2 ** 60
RESULT = "query_id long, rank int, vec_id long, score long"


def usable(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, v array<long>, dim): quantised vectors that take part."""
    v = F.col(f"`{vec_col}`")
    good = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.where(F.coalesce(good, F.lit(False)) & F.col(f"`{id_col}`").isNotNull())
            .select(F.col(f"`{id_col}`").cast("long").alias("id"),
                    F.transform(v, lambda x: F.floor(F.least(F.lit(float(2 ** 61)), F.greatest(
                        F.lit(float(-2 ** 61)), F.lit(scale) * x.cast("double"))))).alias("v"))
            .withColumn("dim", F.size("v")))


def load(rows: DataFrame) -> int:
    """The components of all rows; a short vector counts as DIM."""
    return rows.agg(F.sum(F.greatest("dim", F.lit(DIM)))).first()[0] or 0


def blocks(rows: DataFrame, n: int, name: str) -> DataFrame:
    """(dim, name, ids, vs): rows in n blocks of each length, dealt by a hash of the id."""
    return (rows.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
                .groupBy("dim", name).agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("r"))
                .select("dim", name, F.col("r.id").alias("ids"), F.flatten("r.v").alias("vs")))


def apart(df: DataFrame, label: str) -> DataFrame:
    """df staged with each row in a file of its own, so that rows are read by as many tasks as there is room for."""
    path = fresh_dir(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", 1).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of q and v."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    if bound < 2 ** 24:
        return (q.astype(np.float32) @ v.T.astype(np.float32)).astype(np.int64)
    if bound < 2 ** 53:
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    if bound < LIMIT:
        return q @ v.T
    return np.clip(q.astype(object) @ v.T.astype(object), -LIMIT, LIMIT).astype(np.int64)


def _rows(batches, step: int = 128):
    """For each block of vectors and each block of queries beside it, some queries at a time: the block's low and
    width, their ids, the vectors' ids, scores; own pairs are marked."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {n: batch.column(i)[k] for i, n in enumerate(batch.schema.names)}
            dim, ids, asked = row["dim"].as_py(), np.asarray(row["ids"].values), row["asked"].values
            v = np.asarray(row["vs"].values).reshape(len(ids), dim)
            for j in range(len(asked)):
                qids, qvs, low, width = (np.asarray(asked.field(n)[j].values) for n in ("qids", "qvs", "low", "width"))
                q = qvs.reshape(len(qids), dim)
                for i in range(0, len(qids), step):
                    part = slice(i, i + step)
                    yield low[part], width[part], qids[part], ids, scores(q[part], v), qids[part, None] != ids[None, :]


def _histograms(k: int):
    def run(batches):
        for low, width, qids, _, s, other in _rows(batches):
            out_q, out_b, out_n = [], [], []
            for i, qid in enumerate(qids):
                # Scores above the interval are counted in the last bin + 1.
                own = s[i][other[i] & (s[i] >= low[i])]
                if not len(own):
                    continue
                n = np.bincount(np.minimum((own - low[i]) // width[i], BINS), minlength=BINS + 1)
                above = n[::-1].cumsum()[::-1] - n
                bins = np.flatnonzero((n > 0) & (above < k))
                out_q += [qid] * len(bins)
                out_b += bins.tolist()
                out_n += n[bins].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_b, pa.int64()),
                                              pa.array(out_n, pa.int64())], ["query_id", "bin", "n"])
    return run


def _reached(k: int):
    def run(batches):
        for low, _, qids, ids, s, other in _rows(batches):
            out = []
            for i, qid in enumerate(qids):
                hit = np.flatnonzero(other[i] & (s[i] >= low[i]))
                # ids ascend, so a stable order by score keeps the smaller ids of a tie.
                for j in hit[np.argsort(-s[i][hit], kind="stable")[:k]]:
                    out.append((qid, ids[j], s[i][j]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))],
                                             ["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 64.0) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): each query's k best among the vectors with another id.

    Vectors are quantised to floor(scale * x). The score is the integer inner product
    (beyond LIMIT it counts as LIMIT); ties go to the smaller id; all are returned if there are fewer than k. Null
    vectors, vectors with a null or non-finite component and null ids take no part, on
    either side. Vectors of unlike length are not compared. Of rows with one id, the
    first by value stands for the id. Other columns are ignored.
    """
    spark = vectors.sparkSession
    importable(spark)
    once = lambda df: usable(df, id_col, vec_col, scale).groupBy("id").agg(
        F.min("v").alias("v")).withColumn("dim", F.size("v"))
    held, asked = staged(once(vectors), "vectors"), staged(once(queries), "queries")
    cores = spark.sparkContext.defaultParallelism
    held = apart(blocks(held, max(1, -(-load(held) // (VECTORS * DIM)), min(cores, held.count() // FEW)), "vblock"),
                 "vector-blocks")
    asks = load(asked)
    n = max(1, -(-asks // (QUERIES * DIM)), -(-asks // SENT))
    asked = staged(blocks(asked, n, "qblock"), "query-blocks")
    # No score is beyond |q| * |v|, bounded by the largest components of either side.
    most = lambda df: df.agg(F.max(F.array_max(F.transform("vs", F.abs))).alias("m"), F.max("dim").alias("d")).first()
    a, b = most(held), most(asked)
    if a.m is None or b.m is None:
        return spark.createDataFrame([], RESULT)
    bound = min(a.m * b.m * max(a.d, 1), LIMIT) + 1
    out, groups = fresh_dir(spark, "best"), -(-asks // SENT)
    for group in range(groups):
        best = _one_group(held, asked.where(F.col("qblock") % groups == group), k, bound)
        best.write.mode("append").parquet(out)
    return spark.read.schema(RESULT).parquet(out)


def _one_group(held: DataFrame, asked: DataFrame, k: int, bound: int) -> DataFrame:
    """The best for a group of query blocks: some SENT components, so whatever is joined with these is small."""
    width = 1
    while width * BINS <= 2 * bound:
        width *= BINS
    state = asked.select("dim", "qblock", F.explode("ids").alias("query_id")).select(
        "dim", "qblock", "query_id", F.lit(-bound).cast("long").alias("low"), F.lit(width).cast("long").alias("width"))

    def pairs(state: DataFrame) -> DataFrame:
        """Each block of vectors once, beside the query blocks of its length with their state."""
        now = state.groupBy("dim", "qblock").agg(F.sort_array(F.collect_list(F.struct("query_id", "low", "width"))).alias("s"))
        full = asked.join(now, ["dim", "qblock"]).groupBy("dim").agg(F.collect_list(F.struct(
            F.col("ids").alias("qids"), F.col("vs").alias("qvs"), F.col("s.low").alias("low"),
            F.col("s.width").alias("width"))).alias("asked"))
        return held.join(F.broadcast(full), "dim").select("dim", "ids", "vs", "asked")

    while True:
        counted = (pairs(state).mapInArrow(_histograms(k), "query_id long, bin long, n long")
                   .groupBy("query_id", "bin").agg(F.sum("n").alias("n")))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        # The first bin from above at which k scores are reached; else the lowest score that there is.
        found = (counted.withColumn("total", F.sum("n").over(down))
                        .groupBy("query_id").agg(F.max(F.when(F.col("total") >= k, F.col("bin"))).alias("bin")))
        low = F.col("low") + F.coalesce("bin", F.lit(0)) * F.col("width")
        last = width == 1
        state = staged(state.join(found, "query_id", "left").select(
            "dim", "qblock", "query_id", low.alias("low"),
            F.greatest(F.lit(1), F.floor(F.col("width") / BINS)).cast("long").alias("width")), "thresholds")
        if last:
            break
        width //= BINS
    best = pairs(state).mapInArrow(_reached(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
