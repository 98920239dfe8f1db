"""Codes of vectors by product quantisation, trained with a dual-tree Lloyd iteration.

Vectors are cut into equal parts; each part position has a codebook of a few entries.
Each block of rows holds a tree over its parts at each position, built once, with
bounding boxes, counts and sums of its nodes. In every round a tree is built over the
entries too, and pairs of nodes are followed down both trees. A pair goes when its
least distance exceeds the greatest distance of the same part node to another entry
node, or when one entry is nearer in the whole box. A part node with one entry left is
assigned as a whole by its cached count and sum; parts of leaves with several are
compared in integers. All is exact: ties go to the lower index.

What a round shuffles is one row of sums for each task, position and entry.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navrecon.llm.common import finite, importable, quantised, staged
from navrecon.session import broadcast_if_small

#: Rows of a block, parts of a leaf at most.
BLOCK, LEAF = 2048, 32
#: Quantised components beyond this count as this, so that distances of long vectors fit a long.
LIMIT = 2 ** 26


# ---- trees -----------------------------------------------------------------

class Tree:
    """A tree over points (n, width): nodes hold the points order[begin:end], their box, count and sum."""

    def __init__(self, points: np.ndarray, leaf: int):
        order = np.arange(len(points))
        begin, end, left, right = [0], [len(points)], [-1], [-1]
        node = 0
        while node < len(begin):
            a, b = begin[node], end[node]
            if b - a > leaf:
                own = points[order[a:b]]
                axis = int(np.argmax(own.max(axis=0) - own.min(axis=0))) if own.shape[1] else 0
                half = (b - a) // 2
                if own.shape[1]:
                    order[a:b] = order[a:b][np.argpartition(own[:, axis], half)]
                left[node], right[node] = len(begin), len(begin) + 1
                begin += [a, a + half]
                end += [a + half, b]
                left += [-1, -1]
                right += [-1, -1]
            node += 1
        self.order, self.points = order.astype(np.int32), points[order].astype(np.int32)
        self.begin, self.end, self.left, self.right = (np.array(x, np.int32) for x in (begin, end, left, right))
        inside = [self.points[a:b] for a, b in zip(begin, end, strict=True)]
        self.low = np.stack([p.min(axis=0) for p in inside]).astype(np.int64)
        self.high = np.stack([p.max(axis=0) for p in inside]).astype(np.int64)
        self.sums = np.stack([p.sum(axis=0, dtype=np.int64) for p in inside])

    def split(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each node's children, or itself if it is a leaf, beside its place in nodes."""
        inner = self.left[nodes] >= 0
        at = np.repeat(np.arange(len(nodes)), np.where(inner, 2, 1))
        second = np.zeros(len(at), bool)
        second[1:] = at[1:] == at[:-1]
        below = np.where(second, self.right[nodes[at]], self.left[nodes[at]])
        return at, np.where(inner[at], below, nodes[at])


def nearest(parts: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes assigned as a whole, their entries, other points, their entries); points by place in parts.points."""
    tree = Tree(entries, 1)
    p, e = np.zeros(1, np.int32), np.zeros(1, np.int32)
    whole, owner = [], []
    while True:
        at, p = parts.split(p)
        e = e[at]
        at, e = tree.split(e)
        p = p[at]
        # Bounds of the distances between the boxes of each pair, and between a box and a single entry.
        apart = np.maximum(0, np.maximum(tree.low[e] - parts.high[p], parts.low[p] - tree.high[e]))
        reach = np.maximum(parts.high[p] - tree.low[e], tree.high[e] - parts.low[p])
        least, most = (apart * apart).sum(axis=1), (reach * reach).sum(axis=1)
        limit = np.full(len(parts.begin), np.iinfo(np.int64).max)
        np.minimum.at(limit, p, most)
        stays = least <= limit[p]
        p, e, most = p[stays], e[stays], most[stays]
        p, e = _dominated(parts, tree, entries, p, e, most)
        alone = np.bincount(p, minlength=len(parts.begin))[p] == 1
        settled = alone & (tree.left[e] < 0)
        whole.append(p[settled])
        owner.append(tree.order[tree.begin[e[settled]]])
        p, e = p[~settled], e[~settled]
        if not ((parts.left[p] >= 0) | (tree.left[e] >= 0)).any():
            break
    # Leaves with several entries left: every point against these, in integers.
    sizes = (parts.end - parts.begin)[p]
    pair = np.repeat(np.arange(len(p)), sizes)
    point = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + parts.begin[p[pair]]
    entry = tree.order[tree.begin[e]][pair]
    gap = parts.points[point].astype(np.int64) - entries[entry]
    far = np.full((len(parts.points), len(entries)), np.iinfo(np.int64).max)
    far[point, entry] = (gap * gap).sum(axis=1)
    open_points = np.unique(point)
    return np.concatenate(whole), np.concatenate(owner), open_points, far[open_points].argmin(axis=1)


def _dominated(parts: Tree, tree: Tree, entries: np.ndarray, p: np.ndarray, e: np.ndarray, most: np.ndarray):
    """Pairs without the single entries that another one beats in the node's whole box."""
    single = np.flatnonzero(tree.left[e] < 0)
    if not len(single):
        return p, e
    by = single[np.lexsort((most[single], p[single]))]
    first = np.concatenate([[True], p[by][1:] != p[by][:-1]])
    star = np.full(len(parts.begin), -1)
    star[p[by[first]]] = tree.order[tree.begin[e[by[first]]]]
    own, other = entries[tree.order[tree.begin[e[single]]]], entries[star[p[single]]]
    # Distance to own less distance to other is linear in the point: its least value over the box.
    slope = own - other
    least = (own * own).sum(axis=1) - (other * other).sum(axis=1) - 2 * np.maximum(
        slope * parts.low[p[single]], slope * parts.high[p[single]]).sum(axis=1)
    keep = np.ones(len(p), bool)
    keep[single[least > 0]] = False
    return p[keep], e[keep]


# ---- inside a task ---------------------------------------------------------

def _planted(parts: int, width: int):
    """Blocks of rows (id, label, v) with a tree for each part position."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(i, BLOCK)
                n = piece.num_rows
                rows = np.zeros((n, parts * width), np.int64)
                lengths = np.asarray(piece.column("v").value_lengths())
                rows[np.arange(parts * width)[None, :] < lengths[:, None]] = np.asarray(piece.column("v").flatten())
                trees = [Tree(rows[:, k * width:(k + 1) * width], LEAF) for k in range(parts)]
                lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), piece.column(c)) for c in ("id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([pickle.dumps(trees)], pa.binary())],
                                                 ["ids", "labels", "trees"])
    return run


def _trees(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1), pickle.loads(batch.column("trees")[i].as_py())


def _summed(books: np.ndarray):
    """For each position and entry the count and the sums of its parts, over all blocks of a task."""
    def run(batches):
        count = np.zeros(books.shape[:2], np.int64)
        total = np.zeros(books.shape, np.int64)
        for _, trees in _trees(batches):
            for k, tree in enumerate(trees):
                nodes, owner, points, chosen = nearest(tree, books[k])
                np.add.at(count[k], owner, (tree.end - tree.begin)[nodes])
                np.add.at(total[k], owner, tree.sums[nodes])
                count[k] += np.bincount(chosen, minlength=books.shape[1])
                np.add.at(total[k], chosen, tree.points[points].astype(np.int64))
        part, entry = np.indices(count.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(count.ravel()),
             pa.array(list(total.reshape(len(part), -1)), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])
    return run


def _coded(books: np.ndarray):
    """(id, label, code, error) of every row."""
    def run(batches):
        for row, trees in _trees(batches):
            n = len(trees[0].order)
            codes, error = np.zeros((n, len(trees)), np.int64), np.zeros(n, np.int64)
            for k, tree in enumerate(trees):
                nodes, owner, points, chosen = nearest(tree, books[k])
                found = np.empty(n, np.int64)
                for node, e in zip(nodes.tolist(), owner.tolist(), strict=True):
                    found[tree.begin[node]:tree.end[node]] = e
                found[points] = chosen
                gap = tree.points.astype(np.int64) - books[k][found]
                codes[tree.order, k] = found
                error[tree.order] += (gap * gap).sum(axis=1)
            text = [bytes(c).hex() for c in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([row.column("ids").flatten(), row.column("labels").flatten(), pa.array(text),
                                              pa.array(error)], ["id", "label", "code", "error"])
    return run


# ---- on Spark --------------------------------------------------------------

def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096.0,
             id_col: str = "vec_id", vec_col: str = "embedding",
             label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(one row for each usable row of vectors: id_col, code, error, label_error; codebooks (part, entry, width)).

    Components become integers floor(scale * x) (beyond LIMIT they count as LIMIT).
    Codebooks (at most 256 entries) start as the parts of the rows with the smallest ids, fewer if there are
    fewer rows, and move to the floor of their parts' means `rounds` times; an unused
    entry stays. error is the row's squared distance to its entries, label_error the sum
    over the rows with its label, nulls together. Rows with a null vector or a null or
    non-finite component are left out; null ids count as the largest, repeated rows as
    rows of their own. Vectors shorter than the longest, or whose length the parts do
    not divide, are filled up with zeros. Other columns are ignored.
    """
    spark = vectors.sparkSession
    importable(spark)
    rows = staged(vectors.where(finite(vec_col)).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
        quantised(vec_col, scale, LIMIT).alias("v")), "vectors")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts)
    begin = rows.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()
    books = np.array([[(r.v + [0] * (parts * width))[k * width:(k + 1) * width] for r in begin] for k in range(parts)],
                     np.int64).reshape(parts, len(begin), width)
    kinds = {f.name: f.dataType for f in rows.schema}
    planted = staged(rows.mapInArrow(_planted(parts, width), T.StructType([
        T.StructField("ids", T.ArrayType(kinds["id"])), T.StructField("labels", T.ArrayType(kinds["label"])),
        T.StructField("trees", T.BinaryType())])), "trees")
    for _ in range(rounds if begin else 0):
        books = _moved(books, planted)
    coded = staged(planted.mapInArrow(_coded(books), T.StructType([
        T.StructField("id", kinds["id"]), T.StructField("label", kinds["label"]), T.StructField("code", T.StringType()),
        T.StructField("error", T.LongType())])), "codes")
    sums = broadcast_if_small(coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("same"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error"), books


def _moved(books: np.ndarray, planted: DataFrame) -> np.ndarray:
    """The codebooks after one round; as many sums come back as the codebooks have numbers."""
    width = books.shape[2]
    sums = planted.mapInArrow(_summed(books), "part long, entry long, n long, total array<bigint>").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)])
    out = books.copy()
    for r in sums.where("n > 0").collect():
        out[r.part, r.entry] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return out


def books_sha256(books: np.ndarray) -> str:
    """Digest of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
