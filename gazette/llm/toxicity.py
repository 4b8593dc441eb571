r"""Toxicity: a bidirectional gated recurrent network with attention over character and word inputs.

A word (\w+, lower-cased) enters as a trained vector of its hash, the mean of trained
vectors of its character five-grams, and two statistics of the training sample: how far
the word, and the most telling of its five-grams, lean to toxic documents. Two gated
recurrent layers of 8 units read a window of 64 words in both directions, attention pools
their states, and a linear layer gives the window's logit. Windows overlap by half, so
that a passage of up to 33 words is whole in one, and all of them are scored; a document's score is that of its worst window. Training is
plain numpy on the driver, on a sample of labelled documents of all lengths, bounded in
documents and in windows: all windows of fewer documents where these are long. A toxic document
teaches through the window that scores highest, a clean one through its worst and one
other.

Rows: one for each document. Texts without words, null among them, score 0. Repeated
rows give repeated results. Labels are matched by doc_id; a null label or id teaches
nothing, and a document labelled more than once is taken as toxic if any label is.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import Pool, in_arrow, kept, numbered, pick, slices

#: Labelled documents in the sample, toxic and clean, and the most windows of either; of any length.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 3000
SAMPLE_WINDOWS = {1: 20_000, 0: 40_000}
WINDOW, STEP = 64, 32
HIDDEN = 8
WORD_BITS, GRAM_BITS, GRAM = 15, 16, 5
WORD_DIM, GRAM_DIM = 5, 5
INPUT = 2 + WORD_DIM + GRAM_DIM
_EPOCHS, _STEPS, _BATCH, _RATE = 5, 60, 256, 0.01
#: Parts of the sample; a document's statistics, in training and calibration, are those of the other parts.
FOLDS = 4
#: Words whose gates a task remembers (192 bytes each); forgetting costs time only.
_REMEMBERED = 60_000
_WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text leaves no remainder by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def inputs_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, hashes of all words' five-grams one after another, and where each word's begin."""
    marked = [b"^" + w.encode("utf-8", "replace").ljust(GRAM - 1, b"_") for w in words]
    points = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) for w in marked], np.int64)
    ends = np.cumsum(sizes)
    inside = np.ones(len(points), bool)
    for back in range(1, GRAM):
        inside[ends - back] = False
    code = np.zeros(max(0, len(points) - GRAM + 1), np.uint64)
    for i in range(GRAM):
        code = code * np.uint64(257) + points[i:len(code) + i]
    grams = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS)
    starts = np.zeros(len(words), np.int64)
    np.cumsum(sizes[:-1] - GRAM + 1, out=starts[1:])
    hashes = np.array([zlib.crc32(w) & ((1 << WORD_BITS) - 1) for w in marked], np.int64)
    return hashes, grams[inside[:len(code)]].astype(np.int64), starts


def windows_of(n: int) -> list[tuple[int, int]]:
    """(start, end) of the overlapping windows over n words; the last ends at n."""
    return [(s, min(n, s + WINDOW)) for s in range(0, max(1, n - WINDOW + STEP), STEP)] if n else []


def _leaning(documents: list[np.ndarray], toxic: np.ndarray, size: int) -> np.ndarray:
    """How far each feature leans to toxic documents: standard deviations beyond 1.5, in fours, -1 to 3."""
    both = [np.zeros(size), np.zeros(size)]
    for features, label in zip(documents, toxic):
        both[int(label)][features] += 1
    expected = (both[0] + both[1]) * toxic.mean()
    far = (both[1] - expected) / np.sqrt(expected + 1)
    return np.clip(np.sign(far) * np.maximum(np.abs(far) - 1.5, 0) / 4, -1, 3).astype(np.float32)


def _summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of values by row number."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    out = np.zeros((n, values.shape[1]), np.float32)
    out[rows[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters, the forward pass, and one training step."""

    def __init__(self, word_leaning: np.ndarray, gram_leaning: np.ndarray, seed: int = 11):
        draw = np.random.default_rng(seed)
        normal = lambda *shape: draw.normal(0, 0.3, shape).astype(np.float32)
        self.word_leaning, self.gram_leaning = word_leaning, gram_leaning
        self.p = {
            "word": normal(1 << WORD_BITS, WORD_DIM) * 0.1, "gram": normal(1 << GRAM_BITS, GRAM_DIM) * 0.1,
            "out": normal(2 * HIDDEN), "look": normal(2 * HIDDEN), "bias": np.array([-1.0], np.float32),
        }
        for way in "fb":
            self.p |= {f"in_{way}": normal(INPUT, 3 * HIDDEN), f"rec_{way}": normal(HIDDEN, 3 * HIDDEN),
                       f"add_{way}": np.zeros(3 * HIDDEN, np.float32)}
            # the first unit of each direction begins by following the statistics
            self.p[f"in_{way}"][:2, 2 * HIDDEN] = 2
        for weights in (self.p["out"], self.p["look"]):
            weights[[0, HIDDEN]] = 2
        self.scale = np.array([1.0, 0.0])

    def inputs(self, hashes: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        counts = np.diff(np.r_[starts, len(grams)])[:, None]
        return np.concatenate([
            self.word_leaning[hashes][:, None], np.maximum.reduceat(self.gram_leaning[grams], starts)[:, None],
            self.p["word"][hashes], np.add.reduceat(self.p["gram"][grams], starts, axis=0) / counts,
        ], axis=1).astype(np.float32)

    def gates(self, x: np.ndarray) -> list[np.ndarray]:
        """What each word adds to the gates of both directions; row 0 is padding, which keeps the state."""
        out = []
        for way in "fb":
            rows = x @ self.p[f"in_{way}"] + self.p[f"add_{way}"]
            blank = np.zeros((1, 3 * HIDDEN), np.float32)
            blank[0, :HIDDEN] = 30
            out.append(np.concatenate([blank, rows]))
        return out

    def forward(self, gates: list[np.ndarray], at: np.ndarray, keep: bool = False):
        """Logits of windows given as rows of word numbers (0 is padding, at the end only)."""
        n, length = at.shape
        states = np.zeros((length, n, 2 * HIDDEN), np.float32)
        kept = {}
        for w, way in enumerate("fb"):
            u, h = self.p[f"rec_{way}"], np.zeros((n, HIDDEN), np.float32)
            own = slice(w * HIDDEN, (w + 1) * HIDDEN)
            for t in (range(length) if way == "f" else range(length - 1, -1, -1)):
                a, rec = gates[w][at[:, t]], h @ u
                zr = 1 / (1 + np.exp(-(a[:, :2 * HIDDEN] + rec[:, :2 * HIDDEN])))
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = np.tanh(a[:, 2 * HIDDEN:] + r * rec[:, 2 * HIDDEN:])
                if keep:
                    kept[way, t] = (h, z, r, new, rec[:, 2 * HIDDEN:])
                h = new + z * (h - new)
                states[t, :, own] = h
        look = states @ self.p["look"]
        look[at.T == 0] = -np.inf
        weight = np.exp(look - look.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (states, weight, pooled, kept)) if keep else logit

    def gradients(self, features, at: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss of windows over the distinct words `features` = (hashes, grams, starts)."""
        hashes, grams, starts = features
        x = self.inputs(hashes, grams, starts)
        gates = self.gates(x)
        logit, (states, weight, pooled, kept) = self.forward(gates, at, keep=True)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d = ((_sigmoid(logit) - labels) * weights / weights.sum()).astype(np.float32)
        g["bias"][0], g["out"] = d.sum(), d @ pooled
        d_pooled = d[:, None] * self.p["out"]
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_look = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["look"] = np.einsum("tn,tnh->h", d_look, states)
        d_states = weight[:, :, None] * d_pooled + d_look[:, :, None] * self.p["look"]
        d_x = np.zeros_like(x)
        length = at.shape[1]
        for w, way in enumerate("fb"):
            u, own = self.p[f"rec_{way}"], slice(w * HIDDEN, (w + 1) * HIDDEN)
            d_h = np.zeros((len(at), HIDDEN), np.float32)
            d_steps = np.empty((length, len(at), 3 * HIDDEN), np.float32)
            for t in (range(length - 1, -1, -1) if way == "f" else range(length)):
                h, z, r, new, rec = kept[way, t]
                d_h = d_h + d_states[t][:, own]
                d_new = d_h * (1 - z) * (1 - new * new)
                d_z = d_h * (h - new) * z * (1 - z)
                d_r = d_new * rec * r * (1 - r)
                d_rec = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g[f"rec_{way}"] += h.T @ d_rec
                d_steps[t] = np.concatenate([d_z, d_r, d_new], axis=1)
                d_h = d_h * z + d_rec @ u.T
            d_gates = _summed(at.T.ravel(), d_steps.reshape(-1, 3 * HIDDEN), len(gates[w]))[1:]
            g[f"in_{way}"] = x.T @ d_gates
            g[f"add_{way}"] = d_gates.sum(axis=0)
            d_x += d_gates @ self.p[f"in_{way}"].T
        g["word"] = _summed(hashes, d_x[:, 2:2 + WORD_DIM], 1 << WORD_BITS)
        counts = np.diff(np.r_[starts, len(grams)])
        g["gram"] = _summed(grams, np.repeat(d_x[:, 2 + WORD_DIM:] / counts[:, None], counts, axis=0), 1 << GRAM_BITS)
        return g

    def scores(self, logits: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale[0] * logits.astype(np.float64) + self.scale[1])


class _Sample:
    """The sampled documents over one vocabulary, with word numbers from 1."""

    def __init__(self, texts: list[str], toxic: np.ndarray):
        self.toxic, number = toxic, {}
        self.fold = np.random.default_rng(3).permutation(len(texts)) % FOLDS
        self.docs = [np.array([number.setdefault(w, len(number) + 1) for w in words_of(t)], np.int64) for t in texts]
        self.hashes, self.grams, self.starts = inputs_of(list(number)) if number else ([], [], [])
        self.windows = [[d[a:b] for a, b in windows_of(len(d))] for d in self.docs]

        ends = np.r_[self.starts[1:], len(self.grams)]
        self.word_sets = [np.unique(self.hashes[np.unique(d) - 1]) if len(d) else np.empty(0, np.int64) for d in self.docs]
        self.gram_sets = [np.unique(np.concatenate([self.grams[self.starts[w - 1]:ends[w - 1]] for w in np.unique(d)]))
                          if len(d) else np.empty(0, np.int64) for d in self.docs]

    def leanings(self, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Statistics of words and of five-grams over the sample, or over all of its parts but one."""
        rows = [i for i in range(len(self.docs)) if self.fold[i] != without]
        return tuple(_leaning([sets[i] for i in rows], self.toxic[rows], size)
                     for sets, size in ((self.word_sets, 1 << WORD_BITS), (self.gram_sets, 1 << GRAM_BITS)))

    def some(self, windows: list[np.ndarray]):
        """The distinct words of windows as features, and the windows in their numbers."""
        used, back = np.unique(np.concatenate(windows), return_inverse=True)
        ends = np.r_[self.starts[1:], len(self.grams)]
        spans = [self.grams[self.starts[w - 1]:ends[w - 1]] for w in used]
        starts = np.cumsum([0, *map(len, spans[:-1])])
        at = np.zeros((len(windows), max(map(len, windows))), np.int64)
        edge = np.cumsum([0, *map(len, windows)])
        for i, w in enumerate(windows):
            at[i, :len(w)] = back[edge[i]:edge[i + 1]] + 1
        return (self.hashes[used - 1], np.concatenate(spans), starts), at


def fit(texts: list[str], toxic: list[int], seed: int = 11) -> Network:
    """A network trained on texts and labels (1 is toxic); fixed by its arguments."""
    sample = _Sample(texts, np.array(toxic, bool))
    usable = [i for i, d in enumerate(sample.docs) if len(d)]
    if not usable or sample.toxic.all() or not sample.toxic.any():
        # nothing to tell apart: every text with words scores the share of toxic ones
        net = Network(np.zeros(1 << WORD_BITS, np.float32), np.zeros(1 << GRAM_BITS, np.float32), seed)
        share = float(np.clip(sample.toxic.mean(), 0.01, 0.99)) if len(sample.toxic) else 0.01
        net.scale = np.array([0.0, np.log(share / (1 - share))])
        return net
    net, draw = Network(*sample.leanings(), seed), np.random.default_rng(seed)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    parts = [(sample.leanings(fold), [i for i in usable if sample.fold[i] == fold]) for fold in range(FOLDS)]
    step, epochs = 0, max(_EPOCHS, -(-_STEPS * _BATCH // (2 * len(usable))))
    for epoch in range(epochs):
        batches, best = [], {}
        for own, docs in parts:
            net.word_leaning, net.gram_leaning = own
            best |= _worst_windows(net, sample, docs, by_leaning=epoch == 0)
            chosen = [(i, best[i][0]) for i in docs]
            chosen += [(i, int(draw.integers(len(sample.windows[i])))) for i in docs if not sample.toxic[i]]
            order = draw.permutation(len(chosen))
            batches += [(own, [chosen[j] for j in order[lo:lo + _BATCH]]) for lo in range(0, len(order), _BATCH)]
        share = sample.toxic[[i for _, some in batches for i, _ in some]].mean()
        for b in draw.permutation(len(batches)):
            (net.word_leaning, net.gram_leaning), some = batches[b]
            features, at = sample.some([sample.windows[i][w] for i, w in some])
            labels = sample.toxic[[i for i, _ in some]].astype(np.float32)
            weights = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
            step += 1
            for k, g in net.gradients(features, at, labels, weights).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                rate = _RATE * (1 - epoch / epochs) * (0.2 if k in ("word", "gram") else 1)
                net.p[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    worst = {}
    for (net.word_leaning, net.gram_leaning), docs in parts:
        worst |= _worst_windows(net, sample, docs)
    net.scale = _calibrated(np.array([worst[i][1] for i in usable]), sample.toxic[usable].astype(float))
    net.word_leaning, net.gram_leaning = sample.leanings()
    return net


def _worst_windows(net: Network, sample: _Sample, docs: list[int], by_leaning: bool = False) -> dict[int, tuple[int, float]]:
    """For each document the window of the highest logit (or leaning), and that value."""
    flat = [(i, w) for i in docs for w in range(len(sample.windows[i]))]
    x = net.inputs(sample.hashes, sample.grams, sample.starts)
    if by_leaning:
        each = np.r_[0, x[:, :2].max(axis=1)]
        values = np.array([each[sample.windows[i][w]].max() for i, w in flat])
    else:
        gates, values = net.gates(x), np.empty(len(flat))
        for lo in range(0, len(flat), 2048):
            windows = [sample.windows[i][w] for i, w in flat[lo:lo + 2048]]
            at = np.zeros((len(windows), WINDOW), np.int64)
            for k, w in enumerate(windows):
                at[k, :len(w)] = w
            values[lo:lo + 2048] = net.forward(gates, at)
    best: dict[int, tuple[int, float]] = {}
    for (i, w), value in zip(flat, values):
        if i not in best or value > best[i][1]:
            best[i] = (w, float(value))
    return best


def _calibrated(logits: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Slope and shift that turn worst logits into probabilities, by Newton steps with a small penalty."""
    x, w = np.c_[logits, np.ones(len(logits))], np.array([1.0, 0.0])
    for _ in range(25):
        p = _sigmoid(x @ w)
        slope = x.T @ (labels - p) - 0.01 * (w - [1, 0])
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        w = w + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return w if w[0] > 0 else np.array([1.0, 0.0])


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """A network from a sample of the labelled documents that are not held out, drawn by hash of the id.

    Ids are drawn first, then the texts of these at most SAMPLE_TOXIC + SAMPLE_CLEAN ids are
    fetched: no shuffle carries texts.
    """
    known = pick(labels, doc_id="long", toxic="int").where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = pick(docs, doc_id="long", text="string").where("length(text) > 0")
    present = kept(known.where("toxic in (0, 1)").join(texts.select("doc_id"), "doc_id", "left_semi"), "labelled")
    drawn = [
        r.doc_id for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))
        for r in present.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()]
    # at most 4,500 ids: a broadcast of a few kilobytes
    ids = docs.sparkSession.createDataFrame([(i,) for i in drawn], "doc_id long")
    order = F.struct(F.xxhash64("doc_id").alias("drawn"), "doc_id", F.xxhash64("text").alias("text_key"))
    n_words = F.size(F.split("text", r"(?U)\W+"))
    rows = kept(
        texts.join(F.broadcast(ids), "doc_id").join(F.broadcast(present.join(F.broadcast(ids), "doc_id")), "doc_id")
        .select("toxic", "text", order.alias("order"),
                F.greatest(F.ceil((n_words - WINDOW) / F.lit(STEP)) + 1, F.lit(1)).cast("long").alias("n")), "sample")
    texts, toxic = [], []
    for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        bound = SAMPLE_WINDOWS[label]
        some = rows.where((F.col("toxic") == label) & (F.col("n") <= bound))
        # texts come to the driver only once it is known how many fit
        lean = some.select("order", "n").orderBy("order").limit(most).collect()
        fits = [r for r, so_far in zip(lean, accumulate(r.n for r in lean)) if so_far <= bound]
        if not fits:
            continue
        last = F.struct(*[F.lit(v).cast("long").alias(k) for k, v in fits[-1].order.asDict().items()])
        found = some.where(F.col("order") <= last).orderBy("order").limit(len(fits)).select("text").collect()
        texts += [r.text for r in found]
        toxic += [label] * len(found)
    return fit(texts, toxic)


class Scorer:
    """Scores texts in bulk, remembering the gates of words."""

    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.gates = [Pool(x) for x in self.net.gates(np.zeros((0, INPUT), np.float32))]

    def __call__(self, texts: Iterator[str]) -> np.ndarray:
        if len(self.known) > _REMEMBERED:
            self.forget()
        words, sizes = [], []
        for text in texts:
            found = words_of(text)
            words += found
            sizes.append(len(found))
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known) + 1, len(self.known) + len(new) + 1)))
            more = self.net.gates(self.net.inputs(*inputs_of(new)))
            for pool, rows in zip(self.gates, more):
                pool.add(rows[1:])
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))
        numbers = np.concatenate([numbers, np.zeros(WINDOW, np.int32)])
        first = np.cumsum(sizes) - sizes
        spans = [(i, first[i] + a, b - a) for i, n in enumerate(sizes) for a, b in windows_of(n)]
        scores, gates = np.zeros(len(sizes)), [pool.rows for pool in self.gates]
        spans.sort(key=lambda s: s[2])
        for lo in range(0, len(spans), 2048):
            doc, start, size = (np.array(x) for x in zip(*spans[lo:lo + 2048]))
            longest = int(size[-1])
            place = np.arange(longest)
            at = np.where(place < size[:, None], numbers[start[:, None] + place], 0)
            np.maximum.at(scores, doc, self.net.scores(self.net.forward(gates, at)))
        return scores


def _score(net: Network):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for whole in batches:
            for batch in slices(whole, "text", 500):
                scores = scorer(text.as_py() or "" for text in batch.column("text"))
                yield pa.record_batch({
                    "text_key": batch.column("text_key"), "doc_id": batch.column("doc_id"),
                    "score": pa.array(scores, pa.float64())})

    return work


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text) and score, for each document."""
    rows = pick(docs, doc_id="long", text="string").withColumn("text_key", F.xxhash64("text"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _score(shared.value)(batches)

    return in_arrow(rows, work, "text_key long, doc_id long, score double")


def not_toxic(docs: DataFrame, net: Network, most: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores below `most`."""
    plain, at = numbered(docs)
    column, shared = at("text"), docs.sparkSession.sparkContext.broadcast(net)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for batch in slices(whole, column, 500):
                scores = scorer(text.as_py() or "" for text in batch.column(column))
                yield batch.filter(pa.array(scores < most))

    return in_arrow(plain, work, plain.schema).toDF(*docs.columns)
