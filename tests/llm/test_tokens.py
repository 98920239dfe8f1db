"""Token ids, packing and addressable codes: exact round trips."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from navrecon.llm import common, dac, packing
from navrecon.llm.queries import WORDS
from navrecon.llm.tokens import WordEncoder, encoder
from navrecon.session import fresh_dir
from tokenizers import Tokenizer

ODD = ["", " ", "\n\n", "it's I'LL we've 'tis o'clock's", "é ́x à́b", "İstanbul ΣΑΣ ß ﬁ K", "a b\tc\r\nd\x0be",
       "<|endoftext|> <|startoftext|>x", "a<|endoftext|>b<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> a<|EndOfText|> <|endoftext |>",
       "é\u0301<|endoftext|>\u0301x  <|startoftext|>  ", "a < b <| <|endoftext|", "12345 ½ ② x2y", "日本語 テスト 🙂🙂 ...!!! --", "x" * 5000, "\x00\x01 �", "...)). (a.b,c"]


@pytest.fixture(scope="module")
def direct():
    tokenizer = Tokenizer.from_file(WORDS)
    return lambda t: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


def test_words_give_the_ids_of_the_text(direct, spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + ODD
    small = WordEncoder(WORDS, cached=500)  # starts anew again and again
    for i in range(0, len(texts), 3):
        part = texts[i:i + 3]
        want = [direct(t)[:-4] for t in part]
        assert encoder(WORDS).encode(part) == want and small.encode(part) == want
    rng = random.Random(1)
    assert list(direct("a <|endoftext|> b")) != list(direct("a <|ENDOFTEXT|> b"))
    letters = "ab 'é́s.\n\t1Σİ"
    for _ in range(300):
        t = "".join(rng.choice([*letters, "<|endoftext|>"]) for _ in range(rng.randint(0, 30)))
        assert encoder(WORDS).encode([t]) == [direct(t)[:-4]], repr(t)


def test_patterns_use_every_length_once():
    rng = random.Random(2)
    for size in (8, 64, 300):
        histogram = {n: rng.randint(1, 50) for n in rng.sample(range(1, size + 1), min(size, 40))}
        found = packing.patterns(histogram, size)
        used = Counter()
        for copies, lengths in found:
            assert copies > 0 and sum(lengths) <= size
            for n in lengths:
                used[n] += copies
        assert used == histogram


def check_packed(rows, docs, size, direct):
    pieces, sequences = Counter(), defaultdict(list)
    for r in rows:
        pieces[(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
    want = Counter()
    for key, text in docs:
        own = direct(text)
        for start in range(0, len(own) // 4, size):
            part = own[4 * start:4 * (start + size)]
            want[(key, start, len(part) // 4, zlib.crc32(part), len(own) // 4)] += 1
    assert pieces == want


def test_pack(messy, messy_rows, clashing, empty, direct):
    for docs in (messy, clashing):
        check_packed(packing.pack(docs, WORDS, 256).collect(), [r[:2] for r in messy_rows], 256, direct)
    packed = packing.pack(messy, WORDS, 256, keep_ids=True)
    places = {(r.sequence_id, r.offset): bytes(r.ids) for r in packed.collect()}
    for r in packing.sequences(packed).collect():
        parts = [v for (s, o), v in sorted(places.items()) if s == r.sequence_id]
        assert bytes(r.ids) == b"".join(parts)
    assert packing.pack(empty, WORDS).count() == 0


def test_little_padding(spark):
    rows = packing.pack(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), WORDS, 2048).collect()
    sequences = {r.sequence_id for r in rows}
    assert 1 - sum(r.length for r in rows) / (2048 * len(sequences)) < 0.01


def test_codes_round_trip():
    rng = np.random.default_rng(3)
    for ids in (np.array([0]), np.array([255, 256, 65535, 65536, 2**32 - 1, 0]), rng.integers(0, 49408, 5000),
                rng.integers(0, 200, 700), (2 ** rng.integers(0, 32, 3000)).astype(np.int64)):
        levels, bitmaps, ranks = dac.encode(ids)
        assert (dac.decode(levels, bitmaps) == ids).all()
        assert [dac.token_at(levels, bitmaps, ranks, i) for i in range(len(ids))] == ids.tolist()


def test_files(spark, messy, messy_rows, clashing, empty, direct):
    for docs in (messy, clashing):
        path = fresh_dir(spark, "codes")
        dac.write_ids(docs, path, WORDS, segment=1000)
        rows = dac.read_documents(spark, path).collect()
        assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == Counter((r[0], direct(r[1])) for r in messy_rows)
        at, order = 0, sorted(rows, key=lambda r: r.start)
        for r in order:
            assert r.start == at and r.n_tokens == len(r.ids) // 4
            at += r.n_tokens
        keys = [-1 if r.doc_id is None else r.doc_id for r in order]
        assert keys == sorted(keys)
    whole = np.frombuffer(b"".join(bytes(r.ids) for r in order), "<u4")
    asked = [(i,) for i in range(0, len(whole), 97)] + [(len(whole) - 1,), (len(whole),), (-1,), (None,)]
    got = dac.tokens_at(spark, path, spark.createDataFrame(asked, "position long")).collect()
    assert {(r.position, r.token) for r in got} == {(i, int(whole[i])) for i, in asked if i is not None and 0 <= i < len(whole)}
    path = fresh_dir(spark, "codes")
    dac.write_ids(empty, path, WORDS)
    assert dac.read_documents(spark, path).count() == 0


def test_packing_starts_no_other_python_workers(messy, empty):
    """The table of slots is Arrow's: a list of tuples goes through an RDD of Python with a daemon and workers of its own."""
    for docs in (messy, empty):
        plan = packing.pack(docs, WORDS, 256)._jdf.queryExecution().executedPlan().toString()
        assert "ExistingRDD" not in plan


def test_both_tokenizers_share_one_model():
    own = WordEncoder(WORDS)
    token = own.tokenizer.id_to_token(300)
    own.tokenizer.model.unk_token = token
    assert own.bare.model.unk_token == token


def test_a_worker_gives_memory_back_after_each_task(monkeypatch):
    told = []
    monkeypatch.setattr(common, "trim", lambda: told.append("trim"))

    def run(batches):
        for batch in batches:
            yield batch
        told.append("ended")

    assert list(common.trimmed(run)(iter([1, 2]))) == [1, 2] and told == ["ended", "trim"]
    early = common.trimmed(run)(iter([1, 2]))
    assert next(early) == 1
    early.close()
    assert told == ["ended", "trim", "trim"]


def test_pack_with_few_cached_words(messy, messy_rows, direct):
    check_packed(packing.pack(messy, WORDS, 256, cached=100).collect(), [r[:2] for r in messy_rows], 256, direct)
