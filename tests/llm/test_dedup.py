"""Exact and near dedup against plain Python."""
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from navrecon.llm import exact_dedup, near_dedup
from navrecon.llm.exact_dedup import BASES, CHUNK, PRIMES, chunk_hash
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"


def brute_exact(rows):
    strip = lambda t: "".join(c for c in t or "" if c not in SPACE)
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[strip(t)].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for s, members in groups.items():
        best = min(members)
        for k, m in enumerate(sorted(members)):
            out[(m[3], best[3], len(members), k == 0, hashlib.sha256(s.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("primes", [PRIMES, (3, 5)])
def test_exact(messy, messy_rows, primes):
    """With tiny primes unequal texts share fingerprints and must be told apart."""
    got = Counter(map(tuple, exact_dedup.exact_groups(messy, primes=primes).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))
    assert got == brute_exact(messy_rows)


def test_exact_drops(messy, clashing, empty):
    kept = exact_dedup.drop_copies(clashing)
    assert kept.columns == clashing.columns
    groups = exact_dedup.exact_groups(messy)
    assert kept.count() == groups.where("kept").count()
    assert exact_dedup.drop_copies(empty).count() == exact_dedup.exact_groups(empty).count() == 0


def test_fingerprints_compose():
    data = random.Random(1).randbytes(3 * CHUNK + 17)
    for base, prime in zip(BASES, PRIMES, strict=True):
        whole = 0
        for b in data:
            whole = (whole * base + b + 1) % prime
        parts = [data[i:i + CHUNK] for i in range(0, len(data), CHUNK)]
        tails = [max(0, len(data) - (i + 1) * CHUNK) for i in range(len(parts))]
        assert sum(chunk_hash(p, t, base, prime) for p, t in zip(parts, tails, strict=True)) % prime == whole


def varied(rng, words, edits):
    out = words[:]
    for _ in range(edits):
        out[rng.randrange(len(out))] = "edit%d" % rng.randrange(10**6)
    return out


@pytest.fixture(scope="module")
def near_rows():
    """Unlike texts that share a long passage, and groups of near copies of some."""
    rng = random.Random(5)
    passage = ["passage%d" % i for i in range(80)]
    rows, number = [], 0
    for g in range(60):
        words = ["w%d" % rng.randrange(5000) for _ in range(rng.randint(120, 400))] + passage
        for k in range(1 if g % 3 else 6):
            rows.append((number, " ".join(varied(rng, words, k))))
            number += 1
    return rows + [(number, rows[0][1]), (number + 1, rows[0][1].upper()), (number + 2, "too short"), (number + 3, "Too  short")]


def by_class(pairs):
    out = defaultdict(set)
    for c, i in pairs:
        out[c].add(i)
    return {frozenset(v) for v in out.values()}


def brute_near(rows, threshold=0.8):
    """Classes of all pairs, aligned over the whole table."""
    grams = {i: near_dedup.shingles(near_dedup.word_hashes(t)) for i, t in rows}
    parent = {i: i for i in grams}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in grams:
        for b in range(a):
            shared = aligned(grams[a], grams[b])
            if shared and shared / (len(grams[a]) + len(grams[b]) - shared) >= threshold:
                parent[find(a)] = find(b)
    return by_class((find(i), i) for i in grams)


def aligned(a, b):
    """Longest common subsequence; 0 where the texts share less than half."""
    common = len(np.intersect1d(a, b))
    if common < 0.5 * min(len(a), len(b)):
        return 0
    a, b = a[np.isin(a, b)].tolist(), b.tolist()
    before = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
        before = row
    return before[-1]


@pytest.mark.parametrize("large", [64, 4])
def test_near_groups(spark, near_rows, monkeypatch, large):
    """Also where buckets count as large from four members."""
    monkeypatch.setattr(near_dedup, "LARGE", large)
    docs = spark.createDataFrame(near_rows, "doc_id long, text string")
    rows = near_dedup.near_groups(docs).collect()
    assert by_class((r.class_id, r.doc_id) for r in rows) == brute_near(near_rows)
    sizes = Counter(r.class_id for r in rows)
    assert all(r.kept == (r.doc_id == r.class_id) and r.class_size == sizes[r.class_id] for r in rows)
    assert len(rows) == len(near_rows)


def classes_of(spark, texts):
    """Classes of texts {node: (sketch, shingles)}."""
    grams = spark.createDataFrame([(i, np.array(g, np.uint64).tobytes()) for i, (_, g) in texts.items()], "node long, grams binary")
    rows = spark.createDataFrame([(i, s) for i, (s, _) in texts.items()], "node long, sketch array<long>")
    found = near_dedup.classes(rows, lambda nodes: grams.join(nodes, "node", "left_semi"), 0.8).collect()
    assert len(found) == len({r.node for r in found})
    return by_class((r.component, r.node) for r in found)


def test_drift_in_one_bucket(spark):
    """Each version is similar to its neighbours only; all meet in one bucket alone, beside strangers with a passage of theirs."""
    passage = list(range(10**6, 10**6 + 12))
    texts = {i: ([7], [*passage, *range(i, i + 20)]) for i in range(300)}
    texts |= {1000 + i: ([7], [*passage, *range(5000 + 100 * i, 5000 + 100 * i + 20)]) for i in range(100)}
    assert classes_of(spark, texts) == {frozenset(range(300)), *(frozenset([1000 + i]) for i in range(100))}


def test_only_the_large_bucket_in_common(spark):
    """A similar pair agrees in no sketch but that of a large bucket."""
    texts = {i: ([7, *range(100 * i + 1000, 100 * i + 1019)], range(100 * i, 100 * i + 20)) for i in range(150)}
    texts |= {n: ([7, *range(10**6 * n, 10**6 * n + 19)], range(10**7 + n, 10**7 + n + 20)) for n in (500, 501)}
    assert frozenset([500, 501]) in classes_of(spark, texts)


def test_alignment_sees_order():
    words = near_dedup.word_hashes(" ".join("w%d" % i for i in range(200)))
    a = near_dedup.shingles(words)
    b = near_dedup.shingles(np.concatenate([words[100:], words[:100]]))
    assert near_dedup.similarity(a, a, 0.8) == 1.0
    assert near_dedup.similarity(a, b, 0.8) == 0.0
    assert set(near_dedup.sketches(a)) != set(near_dedup.sketches(b))


def test_sketches_of_a_text_in_parts(monkeypatch):
    grams = near_dedup.shingles(near_dedup.word_hashes(" ".join("w%d" % (i % 97) for i in range(500))))
    assert len(set(grams.tolist())) == len(grams)  # occurrences are labelled
    whole = near_dedup.sketches(grams)
    monkeypatch.setattr(near_dedup, "GRAMS_AT_ONCE", 64)
    assert near_dedup.sketches(grams) == whole


def test_near_messy(messy, messy_rows, clashing, empty):
    rows = near_dedup.near_groups(messy).collect()
    assert len(rows) == len(messy_rows)
    assert sum(r.kept for r in rows) == len({(r.class_id, r.class_size) for r in rows}) + 1  # id 7 has two texts
    classes = defaultdict(set)
    for r in rows:
        classes[r.class_id].add(r.doc_id)
    assert classes[8] == {8, 10} and classes[9] == {9}  # spaces part words, their number does not matter
    assert classes[1] == {1, 2, None}
    kept = near_dedup.drop_near_copies(clashing)
    assert kept.columns == clashing.columns and kept.count() == sum(r.kept for r in rows)
    assert near_dedup.drop_near_copies(empty).count() == near_dedup.near_groups(empty).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (7, 8), (7, 7)]
    found = near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.component) for r in found} == {(2, 1), (3, 1), (4, 1), (5, 1), (8, 7), (9, 7)}


def test_outlines_exclude_no_similar_pair(spark):
    """Bits that differ never outnumber shingles that differ; most pairs far below the threshold are told apart."""
    rng = random.Random(3)
    words = ["o%d" % i for i in range(300)]
    texts = [" ".join(varied(rng, words, k % 12)) for k in range(40)] + ["", "one", " ".join(["again"] * 90)]
    grams = [near_dedup.shingles(near_dedup.word_hashes(t)) for t in texts]
    df = spark.createDataFrame([(i, g.tobytes()) for i, g in enumerate(grams)], "node long, grams binary")
    told = {r.node: r for r in near_dedup.outlines(df).collect()}
    assert [told[i].size for i in range(len(grams))] == [len(g) for g in grams]
    for a in range(len(grams)):
        for b in range(a):
            bits = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(told[a].outline, told[b].outline))
            unlike = len(np.setxor1d(grams[a], grams[b]))
            assert bits <= unlike and (bits - unlike) % 2 == 0
            if unlike <= 200:
                assert bits >= 0.8 * unlike


def test_recall_on_documents(spark):
    """Every pair of similar documents of the small table ends in one class, and no class is larger than what such pairs link."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    found = by_class((r.class_id, r.doc_id) for r in near_dedup.near_groups(docs).collect())
    assert found == brute_near([r for r in rows if r[1].split()]) | by_class((0, i) for i, t in rows if not t.split())


def test_shingles_are_counted_in_blocks(spark):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 2**63, rng.integers(1, 3000), dtype=np.uint64) for _ in range(60)] + [np.empty(0, np.uint64)]
    df = spark.createDataFrame([(bytearray(t.tobytes()),) for t in texts], "grams binary").repartition(6)
    # A task's counts are one row for each block, not for each shingle.
    assert near_dedup.counters(df).count() <= 6 * near_dedup.BINS // near_dedup.BLOCK
    want = np.bincount((np.concatenate(texts) % np.uint64(near_dedup.BINS)).astype(np.int64), minlength=near_dedup.BINS)
    assert (near_dedup.frequencies(df) == want).all()
    assert not near_dedup.frequencies(df.limit(0)).any()


def test_only_wanted_rows_are_shuffled(spark, monkeypatch):
    df = spark.createDataFrame([(i, "text %d" % (i % 50)) for i in range(200)], "node long, text string")
    wanted = df.where("node in (3, 7)").select("text")
    assert {r.text for r in near_dedup.among(df, "text", wanted).collect()} == {"text 3", "text 7"}
    base = df.select(F.col("text").alias("__text"))
    keys = df.where("node in (3, 7)").select("node", F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_key"))
    rows = sorted(near_dedup.shingle_rows(base, keys).collect())
    assert [r.node for r in rows] == [3, 7]
    monkeypatch.setattr(near_dedup, "SENT", 1)
    assert near_dedup.among(df, "text", wanted).count() == 200
    assert sorted(near_dedup.shingle_rows(base, keys).collect()) == rows


def test_exact_stages_texts_once_and_shuffles_no_lone_text(messy, monkeypatch, capsys):
    from navrecon.llm import common
    seen = {}

    def seeing(df, label, staged=common.staged):
        seen[label] = staged(df, label)
        return seen[label]

    for module in (common, exact_dedup):
        monkeypatch.setattr(module, "staged", seeing)
    kept = exact_dedup.drop_copies(messy)
    assert seen["texts"].columns == ["__doc", "__row"]
    assert seen["equal-fingerprints"].count() < seen["texts"].count()
    kept.explain()
    plan = capsys.readouterr().out
    assert "LeftAnti" in plan and "hashpartitioning" not in plan
    rows = sorted(map(str, kept.collect()))
    monkeypatch.setattr(near_dedup, "SENT", 0)
    again = exact_dedup.drop_copies(messy)
    assert sorted(map(str, again.select("doc_id", "text").distinct().collect())) == sorted(
        map(str, kept.select("doc_id", "text").distinct().collect())) and again.count() == len(rows)


def test_near_copies_go_without_shuffling_the_rest(messy, monkeypatch, capsys):
    kept = near_dedup.drop_near_copies(messy)
    kept.explain()
    assert "LeftAnti" in capsys.readouterr().out
    rows = sorted(map(str, kept.collect()))
    monkeypatch.setattr(near_dedup, "SENT", 0)
    assert sorted(map(str, near_dedup.drop_near_copies(messy).collect())) == rows


def test_equal_buckets_are_one(spark):
    told = spark.createDataFrame([(1, 10, 10), (1, 11, 11), (2, 10, 10), (2, 11, 11), (3, 10, 10), (3, 12, 12),
                                  (4, 10, 10), (4, 11, 11), (4, 12, 12), (5, 20, 20), (5, 21, 20)],
                                 "key long, node long, class long")
    found = near_dedup.several_classes(told, 2).select("key", "node").collect()
    assert sorted(map(tuple, found)) == [(1, 10), (1, 11), (3, 10), (3, 12), (4, 10), (4, 11), (4, 12)]


def test_small_tables_are_few_files(spark, monkeypatch):
    texts = [" ".join(f"w{j}" if (i, j) != (i, 3 * i) else "other" for j in range(60)) for i in range(20)]
    seen = []

    def seeing(df, label, staged=near_dedup.staged):
        seen.append((label, staged(df, label)))
        return seen[-1][1]

    monkeypatch.setattr(near_dedup, "staged", seeing)
    most = 4 * spark.sparkContext.defaultParallelism
    settings = {"spark.sql.shuffle.partitions": str(3 * most), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame([(i, texts[i % 20]) for i in range(5 * most)], "doc_id long, text string")
        # As many unlike texts, so that the tables have rows for more files than allowed.
        docs = docs.unionByName(spark.range(10_000, 10_000 + 5 * most).selectExpr("id as doc_id", "concat('one ', id, ' of its own') as text"))
        near_dedup.near_groups(docs).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {label: len(df.inputFiles()) for label, df in seen if label != "sketches"}
    assert {"texts", "bucket-sizes", "reach", "found", "class-rows"} <= set(files)
    assert max(files.values()) <= most


def test_compared_texts_are_shuffled_once(spark, monkeypatch, capsys):
    """Fifty copies of a text in one task are one row of a shuffle, and no later shuffle holds texts."""
    plans = {}

    def seeing(df, label, staged=exact_dedup.staged):
        if label == "fingerprint-groups":
            df.explain()
            plans[label] = capsys.readouterr().out
        return staged(df, label)

    monkeypatch.setattr(exact_dedup, "staged", seeing)
    docs = spark.createDataFrame([(i, f"text {i % 2}" * 9) for i in range(100)], "doc_id long, text string")
    assert exact_dedup.exact_groups(docs).where("group_size = 50").count() == 100
    # The one shuffle of texts is that by their bytes; no row of texts is sorted or sent to meet its fingerprint before.
    sent = [x for x in plans["fingerprint-groups"].splitlines() if "hashpartitioning" in x]
    assert sum("__chunk" in x for x in sent) == 1 and "min(__chunk" not in plans["fingerprint-groups"]
    assert not any("hashpartitioning(__row" in x for x in sent)
