"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is a learned vector of the word and the mean of learned vectors of its letter trigrams, so unseen words
of a known make are understood. Gated recurrent units read a window of words in both directions, attention weighs the
positions, and a logistic output scores the window. A document is scored by its highest window, over windows that
overlap and cover the whole text; training sends the error through that window, since a label says only that some
passage is toxic.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mixed, python_ready, text_of

WINDOW = 32  # words
STRIDE = 16  # every passage of 17 words lies whole in some window
WORD_ROWS, GRAM_ROWS = 1 << 14, 1 << 13  # hashed vocabulary of words and of trigrams
WORD_SIZE, GRAM_SIZE = 6, 8
HIDDEN = 10
ATTENTION = 8
# The sample a model is trained on: labelled documents of either class in the order of a hash of the id, so many and of
# so many bytes in all, with all their windows. Everything is scored; only training is bounded.
SAMPLE = 1500
SAMPLE_BYTES = 12 << 20
READ = 1 << 19  # characters read at a time
BLOCK = 4096  # windows scored at a time
EPOCHS, UPDATES, LOT, RATE = 5, 500, 24, 0.01  # at least so many updates, however few the documents
UNKNOWN = 0.25  # of the words of a step, read by their trigrams alone, as a word never met is
HOLD_OUT = 5  # one document in so many is never learned from
BOUNDARY = 0.5

LONGEST, PIECE = 64, 60  # bytes: of a run read as one word, and of the pieces a longer run is read in

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_POWERS = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(LONGEST - 1, _BASE)]))
_NO_WORD = 0  # row of the vocabulary that pads
_BLANK = re.compile("[ \t\n\r]")
#: Spaces and punctuation beyond ASCII; all of them lie in the first two planes.
_APART = re.compile("[" + "".join(re.escape(c) for c in map(chr, range(128, 1 << 17)) if unicodedata.category(c)[0] in "PZ") + "]")


def _pieces(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs, those longer than LONGEST cut every PIECE bytes, at most 3 bytes earlier where a character starts."""
    sizes = ends - starts
    n = np.where(sizes > LONGEST, -(-sizes // PIECE), 1)
    nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    cuts = np.repeat(starts, n) + PIECE * nth
    for _ in range(3):
        cuts -= (nth > 0) & (raw[cuts] & 0xC0 == 0x80)
    return cuts, np.where(np.append(nth[1:], 0) > 0, np.append(cuts[1:], 0), np.repeat(ends, n))


def read_words(texts: list[str], pieces: bool = False) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Words of texts: number of each occurring word (1 .., 0 pads), words per text, and per word the trigram rows.

    Words are runs of letters and digits with A-Z lower-cased, between ASCII separators and Unicode spaces and
    punctuation. With ``pieces``, as the network reads, a run of more than 64 bytes is several words, which cover it;
    without, it is one word, told apart by its first 64 bytes and its length. Returns (numbers in order, words per
    text, [word rows, trigram rows, trigrams per word]).
    """
    texts = [t if t.isascii() else _APART.sub(" ", t) for t in texts]
    raw = np.frombuffer("\n".join([*texts, ""]).encode("utf-8", "surrogatepass"), np.uint8)
    ends_of = np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts])
    solid = _LETTER[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if pieces and len(starts):
        starts, ends = _pieces(raw, starts, ends)
    per_text = np.diff(np.searchsorted(starts, ends_of, "left"), prepend=0)
    if not len(starts):
        return np.zeros(0, np.int64), per_text, [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.int64)]
    sizes = ends - starts
    firsts = np.cumsum(sizes) - sizes
    letters = _LOWER[raw[solid]]
    place = np.arange(len(letters)) - np.repeat(firsts, sizes)
    part = np.where(place < LONGEST, letters * _POWERS[np.minimum(place, LONGEST - 1)], np.uint64(0))
    codes = mixed(np.add.reduceat(part, firsts) + sizes.astype(np.uint64))
    known, first, number = np.unique(codes, return_index=True, return_inverse=True)
    # Trigrams of each distinct word between two marks.
    length = np.minimum(sizes[first], LONGEST)
    padded = length + 2
    at = np.cumsum(padded) - padded
    spelled = np.full(int(padded.sum()), 1, np.uint64)
    inner = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    spelled[np.repeat(at + 1, length) + inner] = letters[np.repeat(firsts[first], length) + inner]
    grams = np.concatenate([spelled[:-2] * np.uint64(1 << 16) + spelled[1:-1] * np.uint64(1 << 8) + spelled[2:], np.zeros(2, np.uint64)])
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(at, length)
    gram_rows = (mixed(grams[inside]) % np.uint64(GRAM_ROWS)).astype(np.int64)
    return number + 1, per_text, [(known % np.uint64(WORD_ROWS)).astype(np.int64), gram_rows, length]


def windows(n_words: int) -> list[int]:
    """First word of each window; the last one ends with the text."""
    if n_words <= WINDOW:
        return [0] if n_words else []
    return [*range(0, n_words - WINDOW, STRIDE), n_words - WINDOW]


def stretches(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in lots of about READ characters, with the number of each; a longer text is cut at ASCII blanks."""
    numbers, lot, size = [], [], 0
    for k, text in enumerate(texts):
        at = 0
        while at < len(text) or at == 0:
            end = _end(text, at)
            numbers.append(k)
            lot.append(text[at:end])
            size += end - at
            at = max(end, 1)
            if size >= READ:
                yield numbers, lot
                numbers, lot, size = [], [], 0
    if lot:
        yield numbers, lot


def _end(text: str, at: int) -> int:
    """Where a stretch from ``at`` ends: behind the first blank after READ characters, or with the text."""
    blank = _BLANK.search(text, at + READ) if len(text) - at > READ else None
    return blank.end() if blank else len(text)


def read_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """As ``read_words`` with pieces, in stretches, so that memory beside the result is bounded; words of different
    stretches have different numbers."""
    numbers, per_text, parts, known = [], np.zeros(len(texts), np.int64), [], 0
    for of, lot in stretches(texts):
        n, per, vocabulary = read_words(lot, pieces=True)
        numbers.append((n + known).astype(np.int32))
        np.add.at(per_text, of, per)
        parts.append([v.astype(np.int32) for v in vocabulary])
        known += len(vocabulary[0])
    none = [np.zeros(0, np.int32)]
    return np.concatenate(numbers or none), per_text, [np.concatenate([p[k] for p in parts] or none) for k in range(3)]


def window_starts(per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows: the first word, the end of the text's words, and the text each belongs to."""
    first = [np.array(windows(int(n)), np.int64) for n in per_text]
    owner = np.repeat(np.arange(len(per_text)), [len(f) for f in first])
    ends = np.cumsum(per_text)
    begins = np.concatenate([*first, np.zeros(0, np.int64)]) + (ends - per_text)[owner]
    return begins, ends[owner], owner


def window_table(numbers: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Word numbers of the windows that begin there, 0 beyond the end of a text."""
    spot = begins[:, None] + np.arange(WINDOW)[None, :]
    if not len(numbers):
        return np.zeros(spot.shape, np.int64)
    return np.where(spot < ends[:, None], numbers[np.minimum(spot, len(numbers) - 1)], _NO_WORD)


class Windows:
    """All windows of texts; words and windows are numbers, tables and inputs are made for some windows at a time."""

    def __init__(self, texts: list[str]):
        self.numbers, self.per_text, self.vocabulary = read_texts(texts)
        self.begins, self.ends, self.owner = window_starts(self.per_text)
        self.gram_first = np.cumsum(self.vocabulary[2]) - self.vocabulary[2]

    def words_of(self, words: np.ndarray) -> list[np.ndarray]:
        """The part of the vocabulary that belongs to ``words``, numbered from 0."""
        word_rows, gram_rows, length = self.vocabulary
        n = length[words].astype(np.int64)
        at = np.repeat(self.gram_first[words] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return [word_rows[words], gram_rows[at], n]

    def rows_by_text(self, kind: int) -> Iterator[np.ndarray]:
        """Rows of words (0) or of trigrams (1) of each text."""
        ends = np.cumsum(self.per_text)
        for a, b in zip(ends - self.per_text, ends):
            yield self.words_of(np.unique(self.numbers[a:b]) - 1)[kind]

    def take(self, which: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Table of some windows and the vocabulary of their words, numbered anew."""
        table = window_table(self.numbers, self.begins[which], self.ends[which])
        words, inverse = np.unique(table, return_inverse=True)
        inverse = inverse.reshape(table.shape)
        if words[0] == _NO_WORD:
            return inverse, self.words_of(words[1:] - 1)
        return inverse + 1, self.words_of(words - 1)

    def logits(self, model: Model, which: np.ndarray) -> np.ndarray:
        out = np.zeros(len(which), np.float32)
        for k in range(0, len(which), BLOCK):
            table, vocabulary = self.take(which[k : k + BLOCK])
            out[k : k + BLOCK] = model.forward(model.inputs(vocabulary), table)
        return out


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Model:
    """Parameters; ``p`` holds word and trigram vectors, input, recurrent and attention weights."""

    p: dict[str, np.ndarray]
    base: float  # score of a text without words

    @staticmethod
    def fresh(rng: np.random.Generator) -> Model:
        d = WORD_SIZE + GRAM_SIZE
        p = {"words": 0.1 * rng.standard_normal((WORD_ROWS, WORD_SIZE)), "grams": 0.1 * rng.standard_normal((GRAM_ROWS, GRAM_SIZE))}
        for way in ("f", "b"):
            p[f"in_{way}"] = rng.standard_normal((d, 3 * HIDDEN)) / np.sqrt(d)
            p[f"bias_{way}"] = np.zeros(3 * HIDDEN)
            p[f"gates_{way}"] = rng.standard_normal((HIDDEN, 2 * HIDDEN)) / np.sqrt(HIDDEN)
            p[f"state_{way}"] = rng.standard_normal((HIDDEN, HIDDEN)) / np.sqrt(HIDDEN)
        p["look"] = rng.standard_normal((2 * HIDDEN, ATTENTION)) / np.sqrt(2 * HIDDEN)
        p["look_bias"], p["focus"] = np.zeros(ATTENTION), rng.standard_normal(ATTENTION)
        p["out"], p["out_bias"] = rng.standard_normal(2 * HIDDEN) / np.sqrt(2 * HIDDEN), np.zeros(1)
        return Model({k: v.astype(np.float32) for k, v in p.items()}, 0.0)

    def inputs(self, vocabulary: list[np.ndarray]) -> np.ndarray:
        """Input vector per word number; zeros for the padding."""
        word_rows, gram_rows, length = vocabulary
        out = np.zeros((len(word_rows) + 1, WORD_SIZE + GRAM_SIZE), np.float32)
        if len(word_rows):
            out[1:, :WORD_SIZE] = self.p["words"][word_rows]
            firsts = np.cumsum(length) - length
            out[1:, WORD_SIZE:] = np.add.reduceat(self.p["grams"][gram_rows], firsts, axis=0) / length[:, None]
        return out

    def forward(self, x: np.ndarray, table: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logit of each window of word numbers; ``trace`` takes what the backward pass needs."""
        p, h_all = self.p, {}
        steps, n = table.shape[1], len(table)
        mask = (table != _NO_WORD).astype(np.float32)
        for way in ("f", "b"):
            given = x @ p[f"in_{way}"] + p[f"bias_{way}"]
            h = np.zeros((n, HIDDEN), np.float32)
            states = np.zeros((steps, n, HIDDEN), np.float32)
            kept = []
            for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
                xt = given[table[:, t]]
                gates = _sigmoid(xt[:, : 2 * HIDDEN] + h @ p[f"gates_{way}"])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                rh = r * h
                c = np.tanh(xt[:, 2 * HIDDEN :] + rh @ p[f"state_{way}"])
                m = mask[:, t : t + 1]
                step = m * z * (c - h)
                if trace is not None:
                    kept.append((t, h, z, r, rh, c, m))
                h = h + step
                states[t] = h
            h_all[way] = states
            if trace is not None:
                trace[way] = kept
        h = np.concatenate([h_all["f"], h_all["b"]], axis=2)
        seen = np.tanh(h @ p["look"] + p["look_bias"])
        score = seen @ p["focus"] + 1e4 * (mask.T - 1)
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * h).sum(axis=0)
        if trace is not None:
            trace.update(h=h, seen=seen, weight=weight, pooled=pooled)
        return pooled @ p["out"] + p["out_bias"][0]

    def backward(self, x: np.ndarray, table: np.ndarray, trace: dict, d_logit: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weights, and of the word inputs."""
        p, g = self.p, {}
        h, seen, weight, pooled = trace["h"], trace["seen"], trace["weight"], trace["pooled"]
        g["out"], g["out_bias"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = (h * d_pooled).sum(axis=2)
        d_h = weight[:, :, None] * d_pooled
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["focus"] = (seen * d_score[:, :, None]).sum(axis=(0, 1))
        d_pre = d_score[:, :, None] * p["focus"] * (1 - seen**2)
        g["look"], g["look_bias"] = np.tensordot(h, d_pre, axes=([0, 1], [0, 1])), d_pre.sum(axis=(0, 1))
        d_h = d_h + d_pre @ p["look"].T
        d_x = np.zeros_like(x)
        for way, part in (("f", d_h[:, :, :HIDDEN]), ("b", d_h[:, :, HIDDEN:])):
            into = np.zeros((len(x), 3 * HIDDEN), np.float32)
            g_gates, g_state = np.zeros_like(p[f"gates_{way}"]), np.zeros_like(p[f"state_{way}"])
            later = np.zeros((len(table), HIDDEN), np.float32)
            for t, h0, z, r, rh, c, m in reversed(trace[way]):
                d = part[t] + later
                d_c = d * m * z * (1 - c**2)
                d_rh = d_c @ p[f"state_{way}"].T
                d_gates = np.concatenate([d * m * (c - h0) * z * (1 - z), d_rh * h0 * r * (1 - r)], axis=1)
                g_state += rh.T @ d_c
                g_gates += h0.T @ d_gates
                later = d * (1 - m * z) + d_rh * r + d_gates @ p[f"gates_{way}"].T
                np.add.at(into, table[:, t], np.concatenate([d_gates, d_c], axis=1))
            g[f"gates_{way}"], g[f"state_{way}"] = g_gates, g_state
            g[f"in_{way}"], g[f"bias_{way}"] = x.T @ into, into.sum(axis=0)
            d_x += into @ p[f"in_{way}"].T
        return g, d_x

    def logits(self, texts: list[str]) -> np.ndarray:
        """Highest window logit per text, over all its windows; the base score without words."""
        best = np.full(len(texts), -np.inf)
        read = Windows(texts)
        np.maximum.at(best, read.owner, read.logits(self, np.arange(len(read.owner))))
        return np.where(np.isfinite(best), best, self.base)


def _signs(rows: Iterator[np.ndarray], toxic: np.ndarray, size: int) -> np.ndarray:
    """Shrunken log-odds per vocabulary row, of the share of toxic and of clean documents that have it."""
    seen = np.zeros((2, size))
    for r, y in zip(rows, toxic):
        seen[int(y), np.unique(r)] += 1
    n = np.array([max(1, (toxic == 0).sum()), max(1, (toxic == 1).sum())])
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    return np.clip(odds, -3, 3) * (seen.sum(axis=0) >= 3)


def _amid(table: np.ndarray, calm: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Every second short window amid words of a clean one: these don't change its label, but where its words stand."""
    out = table.copy()
    for row, other in zip(out, calm):
        n = np.count_nonzero(row)
        room = min(len(row) - n, np.count_nonzero(other))
        if room and rng.random() < 0.5:
            before = rng.integers(room + 1)
            row[: n + room] = np.concatenate([other[:before], row[:n], other[before:room]])
    return out


def train(texts: list[str], toxic: np.ndarray, weights: np.ndarray, seed: int = 0) -> Model:
    """Fit by Adam; each document trains the window that scores highest, clean ones a random window besides.

    Short windows are read amid clean words half of the time, so that short texts teach to score long ones.
    """
    rng = np.random.default_rng(seed)
    model = Model.fresh(rng)
    rate = float((weights * toxic).sum() / weights.sum()) if len(toxic) else 0.0
    model.base = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    read = Windows(texts)
    if not len(read.numbers) or len(set(toxic)) < 2:
        model.base = min(model.base, -1.0) if not toxic.any() else max(model.base, 1.0) if len(toxic) else -1.0
        model.p["out"][:] = 0
        model.p["out_bias"][:] = model.base
        return model
    model.base = min(model.base, -1.0)
    owner = read.owner
    model.p["words"][:, 0] = _signs(read.rows_by_text(0), toxic, WORD_ROWS)
    model.p["grams"][:, 0] = _signs(read.rows_by_text(1), toxic, GRAM_ROWS)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    texts_with = np.unique(owner)
    first = np.searchsorted(owner, texts_with)
    spans = dict(zip(texts_with.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(owner)])))
    calm = np.flatnonzero(toxic[owner] == 0)
    step = 0
    lots = max(1, len(texts_with) // LOT)
    epochs = max(EPOCHS, -(-UPDATES // lots))
    for epoch in range(epochs):
        speed = RATE * (1 - epoch / (epochs + 1))
        for lot in np.array_split(rng.permutation(texts_with), lots):
            at = np.concatenate([np.arange(*spans[int(k)]) for k in lot])
            own, logits = owner[at], read.logits(model, at)
            chosen = []
            for k in lot:
                mine = np.flatnonzero(own == k)
                chosen.append(mine[logits[mine].argmax()])
                if not toxic[k] and len(mine) > 1:
                    chosen.append(rng.choice(mine))
            chosen = at[np.array(chosen)]
            sub, vocab = read.take(np.concatenate([chosen, rng.choice(calm, len(chosen))]))
            sub = _amid(sub[: len(chosen)], sub[len(chosen) :], rng)
            x, y, trace = model.inputs(vocab), toxic[owner[chosen]].astype(np.float32), {}
            known = rng.random((len(x) - 1, 1)) >= UNKNOWN
            x[1:, :WORD_SIZE] *= known
            got = model.forward(x, sub, trace)
            d = ((_sigmoid(got) - y) * weights[owner[chosen]] / len(chosen)).astype(np.float32)
            grads, d_x = model.backward(x, sub, trace, d)
            d_x[1:, :WORD_SIZE] *= known
            grads["words"], grads["grams"] = np.zeros_like(model.p["words"]), np.zeros_like(model.p["grams"])
            np.add.at(grads["words"], vocab[0], d_x[1:, :WORD_SIZE])
            np.add.at(grads["grams"], vocab[1], np.repeat(d_x[1:, WORD_SIZE:] / vocab[2][:, None], vocab[2], axis=0))
            step += 1
            for name, value in model.p.items():
                mean, var = moments[name]
                mean += 0.1 * (grads[name] - mean)
                var += 0.001 * (grads[name] ** 2 - var)
                value -= (speed * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: those whose crc32 of the id as text is divisible by five, and those without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model of a bounded sample of ``labels`` (doc_id, toxic) with their texts: of each class at most ``sample``
    documents and, in all, ``sample_bytes``; in the order of a hash of the id, passing over what no longer fits.

    Labels other than 0 and 1 are left out; a document with both counts as toxic. Held-out documents are never used.
    """
    doc_id = F.col("doc_id").cast("long")
    known = labels.select(doc_id.alias("id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    picked = None
    for y in (0, 1):
        some = known.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(sample)
        picked = some if picked is None else picked.union(some)
    # At most twice ``sample`` ids; first the sizes of their texts, then the texts that fit.
    given = docs.select(doc_id.alias("doc_id"), text_of().alias("text"))
    sizes = given.join(F.broadcast(picked), F.col("doc_id") == F.col("id")).groupBy("doc_id", "toxic").agg(F.max(F.octet_length("text")).alias("size"))
    room, fitting = {0: sample_bytes, 1: sample_bytes}, []
    for r in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if r["size"] <= room[r["toxic"]]:
            room[r["toxic"]] -= r["size"]
            fitting.append((r["doc_id"], r["toxic"]))
    chosen = F.broadcast(docs.sparkSession.createDataFrame(fitting, "id long, toxic int"))
    met = given.join(chosen, F.col("doc_id") == F.col("id"))
    rows = met.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    toxic = np.array([r["toxic"] for r in rows], np.int64)
    # Each class weighs as among all labels.
    taken = {y: max(1, int((toxic == y).sum())) for y in (0, 1)}
    total = sum(counts.values()) or 1
    weights = np.array([counts[y] / taken[y] for y in toxic]) * (len(toxic) / total) if len(toxic) else np.zeros(0)
    return train([r["text"] for r in rows], toxic, weights)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, content (a hash of the text), score of every row; null text is empty and scores as one without words."""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            logits = model.logits(list(b["text"]))
            yield pd.DataFrame({"doc_id": b["doc_id"], "no_id": b["no_id"], "content": b["content"], "score": 1 / (1 + np.exp(-logits))})

    doc_id = F.col("doc_id").cast("long")
    given = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"), text_of().alias("text"), F.xxhash64(text_of()).alias("content"))
    made = given.mapInPandas(run, "doc_id long, no_id boolean, content long, score double")
    return made.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "content", "score")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from a score of one half) of every row of ``docs``.

    Without labels of both classes every text scores alike. Repeated rows repeat; an empty table gives no rows; a row
    without doc_id is scored and counts as held out. Texts of any length are read whole. Other columns are not read.
    """
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= BOUNDARY).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score below one half; columns unchanged.

    The score is a column made in one pass over the text, so no row is shuffled.
    """
    python_ready(docs.sparkSession)
    model = fit(docs, labels)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(1 / (1 + np.exp(-model.logits(list(texts)))))

    return docs.where(scored(text_of()) < BOUNDARY)
