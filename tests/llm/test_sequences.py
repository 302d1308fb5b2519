"""Periodic runs, byte-level BPE and fill-in-the-middle against brute force, the library and exact round trips."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from loadcast.llm import bytebpe, fim, periodic
from loadcast.llm.queries import QUERIES, periodic_edit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def hexed(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def plain_runs(words, least=periodic.LEAST):
    """Every period in turn, every stretch that keeps it; the smallest period of equal stretches."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def found_runs(texts):
    return [[tuple(map(int, (s, e - s, q))) for s, e, q in runs] for runs, _ in periodic._describe(texts)]


def repetitive(rng):
    """Powers of short words strung together, random words with stretches made periodic and broken again."""
    if rng.random() < 0.5:
        parts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(3)]
        text = ""
        while len(text) < rng.randrange(50, 500):
            text += rng.choice(parts) * rng.randrange(1, 60)
        return list((text * rng.randrange(1, 4))[:700])
    words = [str(rng.randrange(rng.choice([1, 2, 3, 50]))) for _ in range(rng.randrange(0, 300))]
    for _ in range(rng.randrange(0, 4)):
        if len(words) > 40:
            a = rng.randrange(len(words) - 20)
            p = rng.randrange(1, max(2, (len(words) - a) // 2))
            for i in range(a, rng.randrange(a, len(words))):
                words[i] = words[a + (i - a) % p]
    return words


def test_runs_of_hard_words():
    fib, new = "a", "ab"
    while len(new) < 600:
        fib, new = new, new + fib
    hard = ["ab" * 100 + "a" + "ab" * 150, "a" * 400, new, ("ab" * 60 + "a") * 4, "abc" * 80 + "ab" + "abc" * 90 + "b" + "abc" * 50,
            "aab" * 40 + "aabb" * 50 + "aab" * 40, "", "x", "ab" * 6, "a" * 11, "a" * 12, "abcdefg" * 2]
    texts = [*[list(t) for t in hard], ["a\0b", "a\0c"] * 20, ["a\0", "a"] * 9]
    assert found_runs(texts) == [plain_runs(t) for t in texts]
    assert len(plain_runs(texts[0])) > 90  # every odd period across the border of two runs


def test_runs_of_random_words():
    rng = random.Random(11)
    for _ in range(15):
        texts = [repetitive(rng) for _ in range(12)]
        for (runs, kept), text in zip(periodic._describe(texts), texts):
            want = plain_runs(text)
            assert [tuple(map(int, (s, e - s, q))) for s, e, q in runs] == want
            assert kept == collapsed(text, want)


def test_runs_in_long_texts():
    """A period of thousands of words, in a text longer than a go of several documents."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in rng.integers(0, 40_000, 70_000)]
    text = base[:5000] + (base[5000:17_345] * 9)[:100_000] + base[20_000:]
    ((runs, kept),) = periodic._describe([text])
    assert [(int(q), int(e - s)) for s, e, q in runs if q > 1000] == [(12_345, 100_000)]
    assert len(kept.split(" ")) == len(text) - sum(int(e - s - q) for s, e, q in runs)
    assert [len(go) for go in periodic._goes([text, ["a"], ["b"], text])] == [1, 2, 1]


def edited(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_edit_and_query(spark, sf_dir, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    made = {r["doc_id"]: WORD.findall(r["text"] or "") for r in periodic_edit(docs).collect()}
    assert made == {i: edited(i, t) for i, t in rows}
    short = {i: w for i, w in made.items() if len(w) < 900}
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in short) > 5
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, words in short.items():
        runs = plain_runs(words)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        assert tuple(got[i]) == (i, len(runs), s, n, q, 1000 * n // q if runs else None, hexed(listed), hexed(collapsed(words, runs)))


def test_runs_of_odd_rows(odd, nothing):
    got = Counter((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in periodic.periodic_runs(odd).collect())
    want = Counter()
    for r in odd.collect():
        words = WORD.findall(r["text"] or "")
        runs = plain_runs(words) if len(words) < 1000 else [tuple(map(int, (s, e - s, q))) for s, e, q in next(periodic._describe([words]))[0]]
        want[(r["doc_id"], len(words), tuple(runs), collapsed(words, runs) if len(words) < 1000 else next(periodic._describe([words]))[1])] += 1
    assert got == want
    assert periodic.periodic_runs(nothing).count() == 0


@pytest.fixture(scope="module")
def codec():
    return bytebpe.Codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_perfect_hash(codec):
    keys = list(codec.ranks)
    at = codec.hash._place(codec.hash._hash(keys))
    assert sorted(at.tolist()) == list(range(len(keys)))  # no gap, no two keys in one place
    assert (codec.hash.find(keys) == np.arange(len(keys))).all()
    others = [k + b"\xff\x00" for k in keys[:5000]] + [b"", b"x" * 1000]
    assert (codec.hash.find(others) == -1).all()
    for n in (0, 1, 2, 5):
        assert bytebpe.PerfectHash(keys[:n]).find(keys[:6]).tolist() == [k if k < n else -1 for k in range(6)]


def odd_texts():
    rng = random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", "é", "日本", "1", "!", "'s", " the", " ", "😀", "\r\n", "\t", "<|endoftext|>", "x́", "\x1c", "\x85"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    every = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    return [*made, "a" * 5000, "ab" * 3000, "", "x", " " * 4000, *["x" + c + " " + c + "1" + c for c in every]]


def test_encode_as_the_library(codec, library, monkeypatch):
    texts = odd_texts()
    want = [library.encode_ordinary(t) for t in texts]
    assert [x.tolist() for x in codec.encode(texts)] == want
    assert all(codec.decode(np.array(w, np.uint32)) == t.encode() for w, t in zip(want, texts))
    monkeypatch.setattr(bytebpe, "ROUND_PIECES", 40)  # long texts over many rounds
    monkeypatch.setattr(bytebpe, "MEMORY", 50)
    assert [x.tolist() for x in bytebpe.Codec(PATH, PATTERN).encode(texts)] == want


def test_merges_by_rank(codec, library):
    for piece in (b"indivisibilities", "überraschend".encode(), b"\xff\xfe\x00abc", b"aaaaaaaaaaaaaaab"):
        assert bytebpe.merge_bytes(piece, codec.ranks) == library._core_bpe.encode_single_piece(piece) or piece in codec.ranks


def test_decode_refuses_unknown_ids(codec):
    with pytest.raises(ValueError):
        codec.decode(np.array([50256], np.uint32))
    assert codec.decode(np.zeros(0, np.uint32)) == b""


def test_byte_bpe_query(spark, sf_dir, docs, library, odd, nothing):
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hexed(np.array(ids, "<u4").tobytes()), hexed(r["text"] or ""))
    assert {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_byte_bpe"](spark, sf_dir).collect()} == want
    got = bytebpe.decode(bytebpe.encode(odd, PATH, PATTERN), PATH, PATTERN).collect()
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in got) == Counter((r["doc_id"], (r["text"] or "").encode()) for r in odd.collect())
    assert bytebpe.encode(nothing, PATH, PATTERN).count() == 0


def plain_fim(doc_id, text, fim_percent, spm_percent, seed=fim.SEED):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hexed(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    x, y, z = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return (doc_id, len(units), "plain", text, None, None)
    if h[3] % 100 < spm_percent:
        return (doc_id, len(units), "spm", f"<S>{z}<P>{x}<M>{y}", len(x), len(y))
    return (doc_id, len(units), "psm", f"<P>{x}<S>{z}<M>{y}", len(x), len(y))


def test_fill_in_middle(spark, docs, odd, nothing):
    hard = ["a\n" * 50_000, "\n" * 3000, "x" * 200_000, "<\n<P\n<S\n", "P>\nM>\n<", "$1\\2\n$3\n\\", "a<P>b\nc", "<M>", "é\n😀\n\r\nx\n\n", "one line", "\n"]
    made = spark.createDataFrame([(100 * k + j, t) for j, t in enumerate(hard) for k in range(6)], "doc_id long, text string")
    for df in (docs, odd, made):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        for shares in ((100, 50), (60, 30)):
            out = fim.fill_in_middle(df, fim_percent=shares[0], spm_percent=shares[1])
            got = out.withColumn("back", fim.restored("output", "form")).collect()
            columns = ("doc_id", "n", "form", "output", "prefix_chars", "middle_chars")
            assert Counter(tuple(r[c] for c in columns) for r in got) == Counter(plain_fim(*r, *shares) for r in rows)
            assert all(r["back"] == r["text"] for r in got)
    assert fim.fill_in_middle(nothing).count() == 0


def test_fill_in_middle_shuffles_nothing(docs):
    plan = fim.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
