"""Line dedup, mixing, secrets, ranks: against plain Python."""
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from navrecon.llm import common, line_dedup, mixing, secrets
from navrecon.llm.queries import QUERIES
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def test_running_is_gapless_over_blocks(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), "id", (F.col("id") % 7).alias("v"))
    ranks = common.running(df, ["k"], ["id"], "rank").collect()
    for k in range(3):
        assert sorted(r["rank"] for r in ranks if r.k == k) == list(range(sum(r.k == k for r in ranks)))
    sums = sorted((r["before"], r.v) for r in common.running(df, [], ["id"], "before", F.col("v")).collect())
    reached = 0
    for before, v in sorted(sums, key=lambda x: (x[0], x[1])):
        assert before <= reached + 7
        reached = max(reached, before + v)
    assert reached == sum(v for _, v in sums)


def brute_lines(rows):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).strip(SPACE)
    none = common.NO_ID
    held = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(none if i is None else i)
    out = []
    for i, t, *_ in rows:
        own, lines = none if i is None else i, (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == own]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def test_lines(messy, messy_rows, clashing, empty):
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(messy).collect())
    assert got == brute_lines(messy_rows)
    assert sum(n for (*_, dropped), n in got.items() if dropped) >= 2
    wide = line_dedup.dedup_lines(clashing)
    assert {"rank", "__row", "n_lines", "source"} <= set(wide.columns) and wide.columns.count("n_lines") == 1
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in wide.collect()) == got
    assert line_dedup.dedup_lines(empty).count() == 0


def test_lines_threshold(spark):
    rows = [(i, "a line in many documents\nline number %d alone" % i) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup.dedup_lines(docs, min_docs=4).collect()} == {0}
    assert sorted(r.n_dropped for r in line_dedup.dedup_lines(docs, min_docs=3).collect()) == [0, 1, 1]


BASE = [("assign", re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?i:passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]


def brute_base(text):
    spans = []
    for n, (kind, rx, group, least) in enumerate(BASE):
        spans += [(m.start(), n, kind, m.end()) for m in rx.finditer(text or "") if len(m[group]) >= least]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)]


@pytest.fixture
def leaks(spark, messy_rows):
    h, a, own, copied = "0123456789abcdef" * 2, "AKIA" + "B2C3" * 5, "zQ9" * 8, "eXample0" * 4
    texts = [f"Password = '{h}' and token:{own}", f"é token: a secret: abcdef1 x {a}", "token=token:abcdefgh", f"{a}{h} {copied}",
             f"API_KEY=\"{copied}\" {own}", f"apikey : short, passwd:'longer.one' {copied}", "secret=" * 5 + "a1b2c3d4",
             f"{own} {own} twice é {copied}", "token=abcdef " * 400]
    rows = [(500 + i, t, "en", "owner%d" % (i % 3), len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(messy_rows + rows, "doc_id long, text string, lang string, source string, n_chars long"), messy_rows + rows


def test_secrets_base(leaks):
    docs, rows = leaks
    got = Counter((r.doc_id, secrets_of(r, secrets.BASE)) for r in secrets.find_secrets(docs).collect())
    assert got == Counter((i, ",".join(brute_base(t))) for i, t, *_ in rows)


def secrets_of(row, kinds):
    return ",".join(f"{s.kind_name}:{s.start}:{s.end}" for s in row.secrets if s.kind_name in kinds)


def test_secrets_ownership(leaks, clashing, empty):
    docs, rows = leaks
    run = re.compile(r"[A-Za-z0-9+/_-]{20,}")
    owners = defaultdict(set)
    for _, t, _, source, _ in rows:
        t = t or ""
        for _, rx, group, least in BASE:
            for m in rx.finditer(t):
                if len(m[group]) >= least:
                    owners[m[group]].add(source or "")
        for m in run.finditer(t):
            if re.search("[0-9]", m[0]):
                owners[m[0]].add(source or "")
    want, copied = Counter(), 0
    for i, t, *_ in rows:
        hits = [m for m in run.finditer(t or "") if re.search("[0-9]", m[0])]
        want[(i, ",".join(f"owned:{m.start()}:{m.end()}" for m in hits if len(owners[m[0]]) == 1))] += 1
        copied += sum(len(owners[m[0]]) > 1 for m in hits)
    found = secrets.find_secrets(docs).collect()
    assert Counter((r.doc_id, secrets_of(r, ("owned",))) for r in found) == want
    assert sum(r.n_copied for r in found) == copied > 0
    assert secrets.find_secrets(clashing).count() == clashing.count()
    assert secrets.find_secrets(empty).count() == 0


def test_secrets_copied_by_repositories(spark):
    """One owner's example in many documents is copied, and base kinds get the verdict too."""
    example, own = "eXample0" * 4, "zQ9" * 8
    rows = [(i, f"see {example}", "hot") for i in range(11)]
    rows += [(20 + i, f"see {own}", "hot") for i in range(10)]
    rows += [(40, "password=changeme", "a"), (41, "password=changeme", "b"), (42, "password=private1", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    verdict = lambda r: (r.n_assign, r.n_owned, r.n_copied, r.n_live_all, r.n_copied_all)
    assert {verdict(got[i]) for i in range(11)} == {(0, 0, 1, 0, 1)}
    assert {verdict(got[20 + i]) for i in range(10)} == {(0, 1, 0, 1, 0)}
    assert verdict(got[40]) == verdict(got[41]) == (1, 0, 0, 0, 1) and verdict(got[42]) == (1, 0, 0, 1, 0)
    assert [s.copied for i in (40, 42) for s in got[i].secrets] == [True, False]
    wide = {r.doc_id: r for r in secrets.find_secrets(docs, max_owners=2, max_repos=11).collect()}
    assert sum(r.n_copied_all for r in wide.values()) == 0


def test_exponent_and_passes(spark, messy, clashing, empty):
    rows = [(i, "w " * (i % 5 + 1), "big" if i % 10 < 7 else "s%d" % (i % 10)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = Counter()
    for _, t, s in rows:
        tokens[s] += len(t.split()) + 1
    mixed = mixing.mix_sources(docs, target_entropy=0.97, max_passes=None, block_tokens=64).collect()
    got = Counter()
    for r in mixed:
        got[r.source] += len(r.text.split()) + 1
    assert {(r.doc_id, 0) for r in mixed} <= {(r.doc_id, r.mix_copy) for r in mixed}
    assert {r.doc_id for r in mixed} == set(range(2000))
    weights = {r.source: r.source_weight for r in mixed}
    assert math.isclose(sum(weights.values()), 1, rel_tol=1e-9)
    entropy = -sum(w * math.log(w) for w in weights.values())
    assert math.isclose(entropy, 0.97 * math.log(4), rel_tol=1e-4)
    goal = tokens["big"] / weights["big"]  # the largest source has exactly one pass
    for s, w in weights.items():
        assert abs(got[s] - goal * w) <= 2 * 64 + 12, s
    limited = mixing.mix_sources(docs, target_entropy=1.0, max_passes=2.0, block_tokens=64).collect()
    assert max(r.mix_copy for r in limited) <= 1 and all(0 <= r.mix_at < 1 for r in limited)
    budgeted = mixing.mix_sources(docs, target_entropy=1.0, max_passes=None, budget=2000, block_tokens=64).collect()
    part = Counter()
    for r in budgeted:
        part[r.source] += len(r.text.split()) + 1
    assert all(500 <= n <= 500 + 200 for n in part.values()), part
    kept = mixing.mix_sources(messy, max_passes=2.0)
    assert Counter(map(tuple, kept.where("mix_copy = 0").select(*messy.columns).collect())) == Counter(map(tuple, messy.collect()))
    assert mixing.mix_sources(clashing).where("mix_copy = 0").count() == clashing.count()
    assert mixing.mix_sources(empty).count() == 0


def test_mixture_order(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"),
                                    F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("source"))
    rows = sorted(mixing.mix_sources(docs, 1.0, None, block_tokens=100).collect(), key=lambda r: r.mix_at)
    half = Counter(r.source for r in rows[:len(rows) // 2])
    assert abs(half["a"] - half["b"]) < 0.15 * len(rows)


def test_sha_of_query_equals_text(spark):
    got = {r.doc_id: r for r in QUERIES["op5_owned_secrets"](spark, DATA).collect()}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        spans = brute_base(r.text)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [got[r.doc_id][f"n_{k}"] for k, *_ in BASE] == [sum(s.startswith(k) for s in spans) for k, *_ in BASE]


def test_long_runs_of_letters_take_seconds(spark):
    import time
    docs = spark.createDataFrame([(1, "a" * 1_000_000 + " AKIA" + "B" * 30 + " " + "x" * 19 + "7", "s"), (2, "-" * 300_000 + "1", "s")],
                                 "doc_id long, text string, source string")
    begun = time.time()
    rows = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    assert time.time() - begun < 30
    assert (rows[1].n_owned, rows[1].n_access, rows[2].n_owned) == (1, 1, 1)
    assert rows[1].secrets[-1].end == 1_000_000 + 1 + 34 + 1 + 20


def test_small_sources_meet_their_weights_with_the_default_block(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(3, 12)), "big" if i % 10 < 7 else "mid" if i % 10 < 9 else "small") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs, target_entropy=None, max_passes=1.3).collect()
    tokens = {}
    for r in mixed:
        size = len(r.text.split()) + 1
        got = tokens.setdefault(r.source, [0, r.source_weight])
        got[0] += size
    total = sum(t for t, _ in tokens.values())
    assert set(tokens) == {"big", "mid", "small"}
    for found, weight in tokens.values():
        assert abs(found / total - weight) < 0.02 * weight
    assert {r.doc_id for r in mixed} == set(range(6000))
