"""MinHash near-dedup against all pairs of shingle sets."""

import random
import re

import numpy as np
import pytest

from loadcast.llm import hyperminhash as H
from loadcast.llm.shingles import shingle_set


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_set(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, percent):
    """{(doc_id, text): (n, component, kept)} over all pairs."""
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[max(root(i), root(j))] = min(root(i), root(j))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        low = min((rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None), default=None)
        out.append((doc_id, len(sets[i]), low, doc_id is None or doc_id == low))
    return sorted(out, key=str)


def judged(df, percent):
    return sorted([tuple(r) for r in H.near_documents(df, percent).drop("content").collect()], key=str)


def copies(seed, groups, size, n_words, edits):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(3000)]
    rows = []
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.randint(*n_words))
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return [(k * 2 + 1, t) for k, t in enumerate(rows)]


def test_shingle_sets(docs):
    odd = ["", None, " \n", "a", "a b", "A b\tC d", "x" * 1000 + " y", "é É ß\x0bq r s t", "a b c d e a b c d e a b c d e"]
    for text in odd + [r[0] for r in docs.select("text").limit(80).collect()]:
        assert len(shingle_set(text)) == len(plain_set(text)), text
    assert (shingle_set("One two THREE four five six") == shingle_set("one  two\nthree four FIVE six ")).all()
    assert not set(shingle_set("a b c d")) & set(shingle_set("a b c d e"))


@pytest.mark.parametrize("percent,groups,size,n_words,edits", [(85, 40, 6, (5, 60), 2), (80, 30, 5, (100, 300), 8), (80, 3, 60, (80, 90), 4)])
def test_links_of_all_pairs(spark, percent, groups, size, n_words, edits):
    rows = copies(percent + groups, groups, size, n_words, edits)
    assert judged(spark.createDataFrame(rows, "doc_id long, text string"), percent) == brute(rows, percent)


def test_hot_group_in_blocks(spark, monkeypatch):
    """Buckets cut into blocks of a few nodes give the same components as all pairs."""
    monkeypatch.setattr(H, "BLOCK", 7)
    rows = copies(7, 4, 50, (60, 70), 5)
    assert judged(spark.createDataFrame(rows, "doc_id long, text string"), 80) == brute(rows, 80)


def test_shared_counts():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 6000)).astype(np.uint64)) for _ in range(9)]
    got = H.shared_counts(sets)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            assert i == j or got[i, j] == len(np.intersect1d(x, y))


def test_given_documents(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert judged(docs, 85) == brute(rows, 85)


def test_odd_rows(odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert judged(odd, 85) == brute(rows, 85)
    assert judged(nothing, 85) == []


def test_dropping(odd, docs):
    for df in (odd, docs):
        out = H.drop_near_documents(df, 85)
        assert out.columns == df.columns
        want = {(r["doc_id"], r["content"]) for r in H.near_documents(df, 85).collect() if r["kept"] and r["doc_id"] is not None}
        without = df.where("doc_id is null").count()
        assert out.count() == len(want) + without


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(4)
    for n, j in ((600, 0.9), (600, 0.3), (20000, 0.85), (20000, 0.0), (100, 0.6)):
        got = []
        for _ in range(60):
            both = int(round(2 * n * j / (1 + j)))
            pool = np.unique(rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            rng.shuffle(pool)
            a, b = np.sort(np.concatenate([pool[:both], pool[both:n]])), np.sort(np.concatenate([pool[:both], pool[n : 2 * n - both]]))
            got.append(H.estimate(H.registers(a)[None], H.registers(b)[None], np.array([n]), np.array([n]))[0])
        assert abs(np.mean(got) - j) < 0.02, (n, j, np.mean(got))


def test_register_holds_zeros_and_mantissa():
    h = np.array([(3 << 55) | (0b1011 << 40)], np.uint64)
    r = H.registers(h)
    value = (0b1011 << 40) >> 2
    zeros = 53 - value.bit_length()
    assert (r == r[0]).all() and r[0] >> H.MANTISSA == zeros and r[0] & 1023 == 0b011 << 7
