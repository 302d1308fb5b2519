"""Encoder, packing, token store: against the library's own encoding of whole texts."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadcast.llm import packing, tokenstore
from loadcast.llm.tokens import END_ID, encode_all, tokenizer_path
from loadcast.session import scratch_path

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")


def library(path, text):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, END_ID]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_gives_the_librarys_ids(path, docs):
    random.seed(5)
    texts = ["", " ", "  a  b ", "x\n \ny", "<|endoftext|>a <|endoftext|>", "İ ǅ ﬁ ΑΣ", "\x1c a\x85b", "it's 12 “q”", "日本\n\n z"]
    texts += ["".join(random.choices("aB ς\n\t '1.-é\u0301sΣİ", k=random.randint(1, 25))) for _ in range(3000)]
    texts += [r[0] for r in docs.select("text").limit(60).collect()]
    own = Tokenizer.from_file(path)
    for text, got in zip(texts, encode_all(path, texts, None)):
        assert np.frombuffer(got, "<u4").tolist() == own.encode(text or "", add_special_tokens=False).ids, repr(text)


def check_packed(rows, given, length):
    """Every id in one piece, sequences gapless and full but the last."""
    total = sum(len(ids) for _, ids in given)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] > 0
        by_doc[(r["doc_id"], r["doc_tokens"])].append((r["start"], ids))
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for doc_id, ids in given:
        want[(doc_id, len(ids))].append(ids)
    assert set(want) == set(by_doc)
    for key, copies in want.items():
        if len({tuple(c) for c in copies}) == 1:
            pieces = sorted(by_doc[key])
            assert sum(len(p) for _, p in pieces) == len(copies) * key[1]
            for start, ids in pieces:
                assert copies[0][start : start + len(ids)] == ids
    assert sorted(by_seq) == list(range(-(-total // length)))
    for seq, pieces in by_seq.items():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == (length if seq < max(by_seq) else total - length * max(by_seq))


@pytest.mark.parametrize("length", [4096, 50])
def test_packing(spark, docs, odd, length):
    for df in (docs, odd):
        rows = packing.pack(df, WORD, length).collect()
        own = Tokenizer.from_file(WORD)
        given = [
            (r["doc_id"], [*own.encode(r["text"] or "", add_special_tokens=False).ids, END_ID])
            for r in df.select("doc_id", "text").collect()
        ]
        check_packed(rows, given, length)


def test_packing_of_nothing(nothing):
    assert packing.pack(nothing, WORD).collect() == []


def test_hilbert_neighbours():
    """All cells of a grid once, and cells next on the curve are next in the grid."""
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), -1).reshape(-1, n)
        keys = packing.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_similar_documents_are_neighbours(spark):
    """Copies with a few changed words lie closer together on the curve than documents at large."""
    random.seed(3)
    vocab = [["".join(random.choices("abcdefgh", k=5)) for _ in range(40)] for _ in range(12)]
    rows = [(k, " ".join(random.choices(vocab[k % 12], k=200))) for k in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = {r[0]: r[1] for r in packing.pack(df, WORD).select("doc_id", "curve_key").distinct().collect()}
    line = [d % 12 for d, _ in sorted(keys.items(), key=lambda x: x[1])]
    together = sum(a == b for a, b in zip(line, line[1:])) / len(line)
    assert together > 0.3  # 1/12 by chance


def test_token_store(spark, docs, odd):
    for df in (docs, odd):
        path = scratch_path(spark, "test-store")
        tokenstore.write_tokens(df, path, BYTE)
        stored = tokenstore.with_starts(tokenstore.read_tokens(spark, path))
        got = [tuple(r) for r in tokenstore.checksums(stored).collect()]
        rows = sorted(df.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        want, start = [], 0
        for doc_id, text in rows:
            ids = library(BYTE, text)
            want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert sorted(got, key=lambda r: r[1]) == want


def test_token_store_skips_by_id(spark, docs, nothing):
    path = scratch_path(spark, "test-store")
    tokenstore.write_tokens(docs, path, BYTE)
    found = tokenstore.read_tokens(spark, path, [7, 10**12])
    assert [r[0] for r in found.select("doc_id").collect()] == [7]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert tokenstore.summary_of(path)["rows"].sum() == docs.count()
    empty = scratch_path(spark, "test-store")
    tokenstore.write_tokens(nothing, empty, BYTE)
    assert tokenstore.with_starts(tokenstore.read_tokens(spark, empty)).count() == 0


def test_ids_are_written_as_integer_arrays(spark, docs):
    path = scratch_path(spark, "test-store")
    tokenstore.write_tokens(docs, path, BYTE)
    assert dict(spark.read.orc(path).dtypes)["ids"] == "array<int>"
    assert tokenstore.read_tokens(spark, path).select(F.max("n_tokens")).first()[0] > 1
