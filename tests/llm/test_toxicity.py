"""The network: gradients, windows, learning, and its use on tables."""

import zlib

import numpy as np
import pytest

from loadcast.llm import toxicity as X


def test_gradients():
    """Against differences of the loss, in double precision."""
    rng = np.random.default_rng(0)
    model = X.Model.fresh(rng)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    read = X.Windows(["one two three one", "four two five six seven", "one"])
    table, vocab = read.take(np.arange(len(read.owner)))
    side = rng.standard_normal(len(table))
    loss = lambda: float((model.forward(model.inputs(vocab).astype(np.float64), table) * side).sum())
    trace = {}
    x = model.inputs(vocab).astype(np.float64)
    model.forward(x, table, trace)
    grads, d_x = model.backward(x, table, trace, side)
    for name, g in grads.items():
        at = tuple(rng.integers(0, n) for n in g.shape)
        old = model.p[name][at]
        model.p[name][at] = old + 1e-3
        up = loss()
        model.p[name][at] = old - 1e-3
        down = loss()
        model.p[name][at] = old
        assert np.isclose((up - down) / 2e-3, g[at], rtol=2e-2, atol=2e-3), name
    assert d_x.shape == x.shape


def test_windows_cover_every_word():
    for n in (0, 1, X.WINDOW, X.WINDOW + 1, 100, 1000):
        first = X.windows(n)
        assert {w for f in first for w in range(f, min(n, f + X.WINDOW))} == set(range(n))
        for k in range(n - X.WINDOW // 2):  # a passage of half a window and one word lies whole in some window
            assert any(f <= k and k + X.WINDOW // 2 < f + X.WINDOW for f in first)


def test_words_and_trigrams():
    numbers, per_text, (rows, grams, length) = X.read_words(["The the, THE!", "", " é x", "thé" * 40])
    assert per_text.tolist() == [3, 0, 2, 1] and len(set(numbers[:3])) == 1
    assert len(rows) == len(length) == len(set(numbers)) and len(grams) == length.sum()
    alone = X.read_words(["x"])[2]
    assert alone[1].tolist() == grams[np.cumsum(length)[numbers[4] - 1] - 1 : np.cumsum(length)[numbers[4] - 1]].tolist()


def plain_logit(model, text):
    """Word by word and window by window, without masks, blocks or shared vocabularies."""
    p, h = model.p, X.HIDDEN
    numbers, _, (rows, grams, length) = X.read_words([text], pieces=True)
    firsts = np.cumsum(length) - length
    words = [np.concatenate([p["words"][rows[w - 1]], p["grams"][grams[firsts[w - 1] : firsts[w - 1] + length[w - 1]]].mean(axis=0)]) for w in numbers]
    best = -np.inf
    starts = [0] if len(words) <= X.WINDOW else [*range(0, len(words) - X.WINDOW, X.STRIDE), len(words) - X.WINDOW]
    for first in starts if words else []:
        window = words[first : first + X.WINDOW]
        states = {}
        for way, order in (("f", range(len(window))), ("b", range(len(window) - 1, -1, -1))):
            state = np.zeros(h)
            for t in order:
                given = window[t] @ p[f"in_{way}"] + p[f"bias_{way}"]
                gates = 1 / (1 + np.exp(-(given[: 2 * h] + state @ p[f"gates_{way}"])))
                fresh = np.tanh(given[2 * h :] + (gates[h:] * state) @ p[f"state_{way}"])
                state = (1 - gates[:h]) * state + gates[:h] * fresh
                states[way, t] = state
        both = [np.concatenate([states["f", t], states["b", t]]) for t in range(len(window))]
        heed = np.exp([np.tanh(s @ p["look"] + p["look_bias"]) @ p["focus"] for s in both])
        pooled = sum(w * s for w, s in zip(heed / heed.sum(), both))
        best = max(best, pooled @ p["out"] + p["out_bias"][0])
    return best if words else model.base


def test_scores_against_plain_windows(monkeypatch):
    """Every score is that of a plain walk over the text, whatever the stretches and blocks it is read in."""
    model = X.Model.fresh(np.random.default_rng(5))
    rng = np.random.default_rng(6)
    texts = ["", " ", "one", "日本語é x " * 30, "a" * 500, *[" ".join(f"w{k}" for k in rng.integers(0, 90, n)) for n in (5, 31, 32, 33, 48, 49, 700)]]
    want = [plain_logit(model, t) for t in texts]
    for read, block in ((X.READ, X.BLOCK), (100, 7), (1, 1)):
        monkeypatch.setattr(X, "READ", read)
        monkeypatch.setattr(X, "BLOCK", block)
        assert np.allclose(model.logits(texts), want, atol=1e-4)
    assert model.logits([]).tolist() == []


def test_training_reads_every_window(monkeypatch):
    """The only foul passage of each toxic text is far beyond any first windows, and is learned."""
    rng = np.random.default_rng(7)
    said = lambda n: " ".join(f"calm{k}" for k in rng.integers(0, 60, n))
    monkeypatch.setattr(X, "UPDATES", 150)
    y = np.arange(80) % 2
    model = X.train([said(1500) + (" foul words here " if k else " ") + said(200) for k in y], y, np.ones(80))
    low, high = model.logits([said(1600), said(1500) + " foul words here " + said(100)])
    assert low < 0 < high


def test_sample_is_bounded_in_bytes(tables, monkeypatch):
    """Texts beyond the bound are passed over; those that fit still train."""
    monkeypatch.setattr(X, "UPDATES", 20)
    rows, docs, labels = tables
    longer = docs.withColumn("text", X.F.when(X.F.col("doc_id") % 10 == 5, X.F.concat("text", X.F.repeat(X.F.lit(" x"), 10_000))).otherwise(X.F.col("text")))
    got = X.fit(longer, labels, sample_bytes=20_000)
    kept = X.fit(docs.where("doc_id % 10 != 5"), labels, sample_bytes=20_000)
    texts = [r[1] for r in rows[:50]]
    assert np.allclose(got.logits(texts), kept.logits(texts), atol=1e-4)
    alone = X.fit(docs, labels, sample_bytes=0)
    assert np.allclose(alone.logits(texts), alone.base)


def made(n, seed=1):
    rng = np.random.default_rng(seed)
    vocab = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 7))) for _ in range(400)]
    rows = []
    for k in range(n):
        w = list(rng.choice(vocab, rng.integers(5, 150)))
        toxic = int(k % 5 == 0)
        if toxic:
            for _ in range(3):
                w[rng.integers(len(w))] = ("vile" + str(rng.choice(["ly", "ness", "st", "r"]))) if rng.random() < 0.5 else "awful"
        rows.append((k, " ".join(w), toxic))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = made(900)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_held_out_accuracy(tables):
    rows, docs, labels = tables
    got = {r["doc_id"]: r for r in X.toxicity(docs, labels).collect()}
    assert len(got) == len(rows)
    right = []
    for i, _, y in rows:
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"]:
            right.append(r["predicted"] == y)
    assert np.mean(right) > 0.95


def test_held_out_labels_are_not_learned(spark, tables):
    """Turned held-out labels change no score."""
    rows, docs, labels = tables
    turned = labels.withColumn("toxic", X.F.when(X.held_out(X.F.col("doc_id")), 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    one, two = ({r["doc_id"]: r["score"] for r in X.toxicity(docs, y).collect()} for y in (labels, turned))
    assert max(abs(one[k] - two[k]) for k in one) < 1e-6


def test_odd_rows(odd, nothing, tables):
    _, docs, labels = tables
    model = X.fit(docs, labels)
    got = X.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert X.toxicity(nothing, labels).count() == 0
    alike = X.toxicity(odd, labels.limit(0)).collect()
    assert {r["predicted"] for r in alike} == {0} and len(alike) == odd.count()
    assert X.drop_toxic(odd, labels.limit(0)).columns == odd.columns
    assert X.drop_toxic(nothing, labels).count() == 0


def test_every_window_counts(tables):
    """One foul passage deep in a long text is found."""
    rows, _, _ = tables
    known = [r for r in rows if r[0] % 7]
    y = np.array([r[2] for r in known])
    model = X.train([r[1] for r in known], y, np.ones(len(y)))
    calm = " ".join(r[1] for r in rows if not r[2])
    foul = calm[: len(calm) // 2] + " awful vileness awful " + calm[len(calm) // 2 :]
    low, high = model.logits([calm, foul])
    assert high > low + 1


def test_long_runs_are_read_whole():
    """Every byte of a run is in one piece of at most 64 bytes that starts with a character."""
    for text in ("日本語" * 100, "a" * 64, "a" * 65, "xé" * 99 + " é" * 3, "😀" * 50 + "a" * 61, "é" + "日" * 70):
        raw = np.frombuffer(text.encode(), np.uint8)
        numbers, per_text, (_, _, length) = X.read_words([text], pieces=True)
        assert length[numbers - 1].sum() == X._LETTER[raw].sum() and per_text[0] == len(numbers) and length.max() <= 64
        a, b = X._pieces(raw, np.array([0]), np.array([len(raw)]))
        assert a[0] == 0 and b[-1] == len(raw) and (a[1:] == b[:-1]).all()
        assert all(raw[k:m].tobytes().decode() for k, m in zip(a, b))
    apart = X.read_words(["日本。語　é\u00a0x、「y」"], pieces=True)
    assert apart[1].tolist() == [5]


def test_passage_deep_in_unspaced_text():
    """A foul passage counts where words have no spaces, thousands of characters into one run."""
    rng = np.random.default_rng(3)
    clean, foul = [chr(0x4E00 + k) for k in range(400)], "毒罵糞殺"
    said = lambda n: "".join(rng.choice(clean, n))
    texts, y = [], np.arange(300) % 3 == 0
    for toxic in y:
        t = said(rng.integers(30, 400))
        at = rng.integers(len(t))
        texts.append(t[:at] + foul * 3 + t[at:] if toxic else t)
    model = X.train(texts, y.astype(np.int64), np.ones(300))
    calm = said(6000)
    low, high = model.logits([calm, calm[:3000] + foul * 3 + calm[3012:]])
    assert high > low + 1
