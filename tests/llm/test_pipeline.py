"""Stages against each other, whole queries, and the library without this subpackage."""
import pickle
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pyarrow as pa
import pytest
from checks.compare import duck, rows_of
from navrecon.llm import near_dedup
from navrecon.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, DATA)
    result = duck(DATA).execute(ORACLE[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in result.description], result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_all_documents(spark, name):
    ids = {r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in QUERIES[name](spark, DATA).select("doc_id").collect()} == ids


def test_stages(spark):
    """Every stage's decisions hold in its result, and clean documents get through."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], DATA))
        assert kept[-1].columns == columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in kept]
    told = {r.doc_id: r.predicted for r in QUERIES["op10_chain_field"](spark, DATA).collect()}
    assert ids[1] == {i for i, p in told.items() if p == 0}
    squeezed = {"".join(c for c in r.text or "" if c not in " \t\n\x0b\x0c\r") for r in kept[1].collect()}
    assert len(ids[2]) == kept[2].count() == len(squeezed)
    assert ids[3] == {r.doc_id for r in near_dedup.near_groups(kept[2]).where("kept").collect()}
    assert ids[4] == ids[3]
    pieces = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in pieces} == ids[4]
    assert sum(r.length for r in pieces if r.start == 0) <= sum(r.length for r in pieces)


def test_run_on_odd_tables(spark, messy, clashing, empty, tmp_path):
    """Nulls, long and empty texts, repeated rows, columns named like results, and no rows at all."""
    labels = spark.createDataFrame([(1, 0), (5, 0), (None, 1), (100, None)], "doc_id long, toxic int")
    columns = [c for c in clashing.columns if not c.startswith("__")]
    found = []
    for name, docs, told in (("messy", messy, labels), ("clashing", clashing.select(columns), labels),
                             ("empty", empty, labels.limit(0))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        told.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        found.append(corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect())
    assert not found[2] and found[0]
    # Ids 8 to 10 are one text, 1 to 3 and a null id are empty; one row of each stays.
    ids = [{r.doc_id for r in rows} for rows in found[:2]]
    assert ids[0] == ids[1] and {4, 7, 100} <= ids[0]
    assert len(ids[0] & {8, 9, 10}) == 1 and len(ids[0] & {1, 2, 3}) == 1
    for rows in found[:2]:
        assert {r.offset for r in rows if r.sequence_id == 0} and max(r.offset + r.length for r in rows) <= 2048
        ends = {(r.doc_id, r.start + r.length) for r in rows}
        assert all((r.doc_id, r.doc_tokens) in ends for r in rows)


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("navrecon/**/*.py"), *ROOT.glob("checks/*.py"), *ROOT.glob("tests/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
    hidden = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['navrecon.llm'] = None;"
              "import __spark_entry__ as e; assert not [k for k in e.queries() if k.startswith('op') or k == 'pipeline']")
    assert subprocess.run([sys.executable, "-c", hidden], cwd=ROOT, timeout=120).returncode == 0


def test_workers_keep_one_operators_state(spark):
    from navrecon.llm import common, tokens, toxicity
    from navrecon.llm.queries import WORDS

    model = {"weights": {}, "bias": 0.0, "step": [[0.0, 0.0], [0.0, 0.0]], "score": [0.0]}
    blobs = [pickle.dumps({**model, "bias": float(i)}) for i in range(2)]
    list(tokens.encode_all(WORDS, pa.array(["a text"])))
    for blob in blobs:
        toxicity._scorer(blob)
    # Of scorers the last one stays; the other operators' state goes where an operator begins.
    assert toxicity._scorer.cache_info().currsize == 1
    common.leave_room("toxicity")
    assert toxicity._scorer.cache_info().currsize == 1 and tokens.encoder.cache_info().currsize == 0
    list(tokens.encode_all(WORDS, pa.array(["a text"])))
    assert toxicity._scorer.cache_info().currsize == 0 and tokens.encoder.cache_info().currsize == 1
    common.importable(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == common.BATCH_BYTES


def test_stages_bound_their_batches_alike(spark, messy):
    """What one stage leaves in an executor must not crowd out the next: all get small batches."""
    from navrecon.llm import common, exact_dedup, near_dedup, packing, toxicity
    from navrecon.llm.queries import WORDS

    for stage in (lambda d: toxicity.score_documents(d, None), exact_dedup.drop_copies, near_dedup.drop_near_copies,
                  lambda d: packing.pack(d, WORDS, 2048)):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(common.BATCH_BYTES))
        stage(messy.limit(3))
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == common.SMALL_BATCH < common.BATCH_BYTES


def test_left_state_goes_back_to_the_system(monkeypatch):
    from navrecon.llm import common, toxicity

    calls = []
    monkeypatch.setattr(common, "trim", lambda: calls.append(1))
    common.leave_room()
    calls.clear()
    common.leave_room()
    assert not calls  # nothing was held
    toxicity._scorer(pickle.dumps({"weights": {}, "bias": 0.0, "step": [[0.0]], "score": [0.0]}))
    common.leave_room()
    assert calls == [1] and toxicity._scorer.cache_info().currsize == 0
    monkeypatch.undo()
    common.trim()
