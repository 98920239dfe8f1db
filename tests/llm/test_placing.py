"""Sharding and top-k against plain Python."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from navrecon.llm import sharding, topk


def test_quotas_keep_counts():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(2, 8)
        wishes = [[0 if a == b else rng.choice([0, rng.randint(0, 50)]) for b in range(n)] for a in range(n)]
        free = [rng.choice([0, rng.randint(0, 30)]) for _ in range(n)]
        allowed, back = sharding.quotas(wishes, free)
        for s in range(n):
            gain = sum(allowed[a][s] for a in range(n)) - sum(allowed[s])
            paid = sum(k for a, _, k in back if a == s) - sum(k for _, b, k in back if b == s)
            assert gain == paid and sum(k for a, _, k in back if a == s) <= free[s]
            assert all(0 <= allowed[s][b] <= wishes[s][b] for b in range(n))
    assert sharding.quotas([[0, 5], [3, 0]], [9, 9]) == ([[0, 5], [3, 0]], [(1, 0, 2)])


def check_shards(rows, docs, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in docs)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_shards(messy, messy_rows, clashing, empty):
    for docs in (messy, clashing):
        check_shards(sharding.assign_shards(docs, 4).collect(), messy_rows, 4)
    assert sharding.assign_shards(empty).count() == 0


def test_links_end_up_together(spark):
    rng = random.Random(6)
    docs = [(i, "text %d" % i) for i in range(2000)]
    for g in range(150):
        docs += [(10_000 + 100 * g + k, "copied text %d" % g) for k in range(rng.randint(2, 12))]
    docs += [(90_000 + k, "the one hot text") for k in range(900)]
    rng.shuffle(docs)
    trace = []
    placed = sharding.assign_shards(spark.createDataFrame(docs, "doc_id long, text string"), 8, trace=trace)
    rows = placed.collect()
    check_shards(rows, docs, 8)
    # The cut falls with every round, and the rounds make most of its fall, not the start or the end.
    assert all(a > b for a, b in zip(trace[:-1], trace[1:-1])) and trace[-1] <= trace[-2]
    assert trace[0] - trace[-2] > 0.9 * (trace[0] - trace[-1]) and trace[0] > 500
    small = defaultdict(Counter)
    for r in rows:
        if r.linked and r.doc_id < 90_000:
            small[r.text_crc32][r.shard] += 1
    together = sum(max(c.values()) for c in small.values()) / sum(sum(c.values()) for c in small.values())
    assert together > 0.95
    facts = sharding.cut_share(placed).first()
    assert facts.linked == sum(r.linked for r in rows) and facts.together <= facts.linked
    assert {r["rows"] for r in sharding.shard_rows(placed).collect()} <= {len(docs) // 8, len(docs) // 8 + 1}


def test_reserved_shards():
    bounds, room = sharding.reserved([10, 10, 10, 10, 10, 9], [26, 13])
    assert sum(room) == 59 - 39 and min(room) >= 0
    assert Counter(g for g, *_ in bounds) == {0: 3, 1: 2}
    assert sharding.filled([3, 5, 4], 7) == [0, 5, 2] and sharding.filled([0, 0], 0) == [0, 0]


def test_hot_groups_fill_whole_shards(spark):
    """A third and a fifth of all rows are one text each, and hardly a row is unlinked."""
    docs = [(i, "hot") for i in range(800)] + [(1000 + i, "warm") for i in range(480)]
    docs += [(2000 + i, "text %d" % (i // 4)) for i in range(1100)] + [(9000 + i, "alone %d" % i) for i in range(20)]
    random.Random(2).shuffle(docs)
    rows = sharding.assign_shards(spark.createDataFrame(docs, "doc_id long, text string"), 8).collect()
    check_shards(rows, docs, 8)
    places = defaultdict(Counter)
    for r in rows:
        if r.linked:
            places[r.text_crc32][r.shard] += 1
    assert sorted(places[zlib.crc32(b"hot")].values()) == [200, 300, 300]
    assert sorted(places[zlib.crc32(b"warm")].values()) == [180, 300]
    assert sum(len(p) > 1 for p in places.values()) <= 2 + 7


def brute_top(vectors, queries, k):
    ok = {i: np.floor(64 * np.array(v, float)).astype(np.int64) for i, v in vectors
          if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()}
    out = set()
    for q in queries:
        if q in ok:
            best = sorted((-int(ok[q] @ v), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(400)]
    rows += [(400 + i, [0.5] * 8) for i in range(150)]  # ties far beyond k
    rows += [(600, None), (601, [None] * 8), (602, [float("nan")] + [0.0] * 7), (603, [float("inf")] * 8), (604, []),
             (None, [0.1] * 8), (605, [1.0, 2.0]), (606, [3.0, -1.0]), (607, [1e6] * 8)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(topk, "VECTORS", 100)
    monkeypatch.setattr(topk, "QUERIES", 16)
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for k in (1, 20):
        got = topk.top_k(docs, docs.where("vec_id % 5 = 0"), k).collect()
        want = brute_top(single, [i for i, _ in single if i is not None and i % 5 == 0], k)
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_top_k_small(spark):
    docs = spark.createDataFrame([(0, [1.0]), (20, [0.5]), (3, [0.25])], "vec_id long, embedding array<float>")
    rows = topk.top_k(docs.selectExpr("*", "'x' as rank", "'y' as score"), docs.where("vec_id % 20 = 0"), 20).collect()
    assert sorted(map(tuple, rows)) == [(0, 1, 20, 2048), (0, 2, 3, 1024), (20, 1, 0, 2048), (20, 2, 3, 512)]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, none).count() == 0 and topk.top_k(docs, none).count() == 0
    big = spark.createDataFrame([(1, [1e7, 1e7]), (2, [-1e7, 3e6]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(big, big).collect()}
    assert got[(1, 2)] == 64 * 10**7 * (-64 * 10**7) + 64 * 10**7 * 64 * 3 * 10**6 and len(got) == 6
    huge = spark.createDataFrame([(1, [1e30, -1e30]), (2, [1e30, -1e30]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(huge, huge).collect()}
    assert got[(1, 1)] == (2, topk.LIMIT) and got[(3, 1)] == (1, topk.LIMIT)


def broadcasts(df):
    """Bytes of each broadcast, measured while the plan of df runs."""
    plan = df._jdf.queryExecution()
    plan.toRdd().count()
    nodes, out = [plan.executedPlan()], []
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "BroadcastExchangeExec":
            out.append(node.metrics().apply("dataSize").value())
        elif kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_top_k_broadcasts_no_vectors(spark, monkeypatch):
    """Vectors of equal components take hardly a byte on disk, so Spark takes their blocks for small."""
    rows = [(i, [float(i % 7 - 3)] * 64) for i in range(2000)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name, value in (("VECTORS", 100), ("QUERIES", 16), ("SENT", 2 ** 14)):
        monkeypatch.setattr(topk, name, value, raising=False)
    sent, plain = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a, **b: sent.append(self) or plain(self, *a, **b))
    got = {tuple(r) for r in topk.top_k(docs, docs.where("vec_id % 4 = 0"), 2).collect()}
    monkeypatch.undo()
    assert got == brute_top(rows, range(0, 2000, 4), 2)
    # A relation takes 1 MB at least; all vectors are 1 MB, beside each of the blocks of queries they were 32 MB.
    assert all(max(broadcasts(df)) <= 2 ** 21 for df in (sent[0], sent[-1]))


def test_top_k_groups(spark, monkeypatch):
    """Several groups of queries, several lengths in each of them, blocks that one query alone fills."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=(3, 64, 100, 300)[i % 4]).round(2).tolist()) for i in range(300)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name, value in (("VECTORS", 50), ("QUERIES", 8), ("SENT", 2 ** 12)):
        monkeypatch.setattr(topk, name, value, raising=False)
    got = topk.top_k(docs, docs.where("vec_id < 60"), 5).collect()
    assert {tuple(r) for r in got} == brute_top(rows, range(60), 5) and len(got) == 300
