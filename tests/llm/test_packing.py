import random
import zlib

import numpy as np
import pytest
from corpus_data import awkward, empty
from tokenizers import Tokenizer

from quarry.llm import packing as pk


def test_tokens_are_the_tokenizers(monkeypatch):
    path = pk.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    texts = ["", "   ", "Don't STOP, it's 3.14!", "İstanbul Σας ²x a_b", "a\x1cb c\x85d\xa0e", "<|endoftext|> x",
             "été Straße", "日本語 ｆｕｌｌ é", "x" * 300, "!!'s'll ''re 12a3"]
    draw = random.Random(3)
    texts += ["".join(draw.choices("ab éÉß's'll.d,;01</w><|x\t\n ÀŸİz-_#", k=draw.randint(0, 60))) for _ in range(2000)]
    want = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert [ids.tolist() for ids in pk.WordTokenizer(path).ids(texts)] == want
    monkeypatch.setattr(pk, "CACHE_WORDS", 5)
    assert [ids.tolist() for ids in pk.WordTokenizer(path).ids(texts)] == want


def check(rows, docs, capacity=pk.CAPACITY):
    tokenizer = Tokenizer.from_file(pk.default_tokenizer())
    want = []
    for r in docs:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [pk.END_ID], "<u4")
        for n, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want.append((r.doc_id, n, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(str, [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows])) == sorted(map(str, want))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(w[3] for w in want)


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(pk.pack_documents(docs).collect(), docs.collect())
    check(pk.pack_documents(docs, capacity=64).collect(), docs.collect(), 64)
    assert pk.pack_documents(empty(spark)).count() == 0


def test_packs_tightly_in_several_rounds(spark):
    lengths = spark.range(6000).selectExpr("id as unit", "cast(1 + pmod(xxhash64(id), 3000) as bigint) as length", "xxhash64(id, 1) as draw")
    rows = pk.pack(lengths, rows=700).join(lengths, "unit").collect()
    assert len(rows) == 6000
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= pk.CAPACITY
    assert len(sequences) <= 1.02 * sum(r.length for r in rows) / pk.CAPACITY + 1


@pytest.mark.parametrize("small", [0, 1, 30])
def test_ends_when_units_do_not_fit_together(spark, monkeypatch, small):
    tables = []

    def bounded(df, name):
        tables.append(name)
        assert len(tables) <= 12, "rounds without end"
        return materialize(df, name)

    materialize = pk.materialize
    monkeypatch.setattr(pk, "materialize", bounded)
    lengths = spark.range(200 + small).selectExpr("id as unit", "if(id < 200, 2500L, 1500L) as length", "xxhash64(id, 1) as draw")
    rows = pk.pack(lengths, rows=50).join(lengths, "unit").collect()
    assert sorted(r.unit for r in rows) == list(range(200 + small))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        assert sorted(members) in ([(0, 2500)], [(0, 2500), (2500, 1500)])
    assert len(sequences) == 200
