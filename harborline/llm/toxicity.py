"""Toxicity by a bidirectional gated recurrent network over words, with attention pooling, in numpy.

A word enters as an embedding of the word, if the vocabulary has it, and hashed embeddings of its character
trigrams.  The vocabulary holds the words that several documents of the training sample share, so that a rare word is
known by its characters only and labels cannot be memorised by it; in training some words are hidden for the same end.
The network reads windows of WINDOW words, one every STRIDE words, so that a passage of up to WINDOW - STRIDE words
lies whole in one of them; a document's score is that of its most toxic window, over the whole
text.  It is trained the same way: in every epoch the window of a document that scores highest carries its label.

Rows: a NULL text, or one without words, scores 0; repeated rows score alike; repeated labels count each; with fewer
than two labelled classes every score is the share of toxic rows; extra columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import in_arrow, sampled
from harborline.llm.shingles import chunks, word_hashes, words

WINDOW, STRIDE = 64, 32
VOCABULARY, LEAST_DOCS, HIDDEN_WORDS = 8000, 4, 0.3  # words at most, documents a word is in, share hidden in training
CHAR_BITS, WIDTH, HIDDEN, ATTENTION = 15, 10, 8, 8
# Bounds of the training sample: rows of a class, windows of a row, letters of a word.
SAMPLE_PER_CLASS, SAMPLE_WINDOWS, SAMPLE_LETTERS = 1500, 48, 64
EPOCHS, BATCH, RATE, DECAY, SEED = 14, 48, 0.02, 0.02, 7
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_START, _END = np.uint32(94), np.uint32(36)


@dataclass
class Text:
    """Words of a chunk: the distinct ones with their character trigrams, and the place of each word among them."""

    hashes: np.ndarray  # of each distinct word
    trigrams: np.ndarray  # character cells of all distinct words, one after the other
    bounds: np.ndarray  # where each distinct word's trigrams begin
    index: np.ndarray  # distinct word of each word
    rows: np.ndarray  # first word of each row, one more than rows


def read(data: np.ndarray, offsets: np.ndarray) -> Text:
    starts, ends, rows = words(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Text(none.view(np.uint64), none, none, none, rows)
    hashes = word_hashes(data, starts, ends)
    distinct, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    low = _FOLD[data].astype(np.uint32)
    before, after = np.roll(low, 1), np.roll(low, -1)
    before[starts], after[ends - 1] = _START, _END
    code = (before * np.uint32(0x9E3779B1)) ^ (low * np.uint32(0x85EBCA77)) ^ (after * np.uint32(0xC2B2AE3D))
    code = ((code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - CHAR_BITS)
    sizes = (ends - starts)[first]
    bounds = np.cumsum(sizes) - sizes
    places = np.arange(sizes.sum()) + np.repeat(starts[first] - bounds, sizes)
    return Text(distinct, code[places].astype(np.int64), bounds, index, rows)


def windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and row of every window; the last one ends with its row."""
    count = np.diff(rows)
    per = np.where(count > 0, np.maximum(0, -(-(count - WINDOW) // STRIDE)) + 1, 0)
    row = np.repeat(np.arange(len(count)), per)
    start = rows[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)) * STRIDE
    return start, np.minimum(WINDOW, rows[1:][row] - start), row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _root(sizes: np.ndarray) -> np.ndarray:
    return np.sqrt(sizes)[:, None].astype(np.float32)


class Network:
    """Parameters by name and the sorted word hashes of the vocabulary."""

    def __init__(self, known: np.ndarray, seed: int = SEED):
        self.known = known
        rng = np.random.default_rng(seed)

        def random(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"word": random(len(known) + 1, WIDTH, scale=0.1), "char": random(1 << CHAR_BITS, WIDTH, scale=0.2)}
        for way in "fb":
            self.p |= {f"w{way}": random(2 * WIDTH, 3 * HIDDEN, scale=0.3), f"u{way}": random(HIDDEN, 3 * HIDDEN, scale=0.3),
                       f"c{way}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"wa": random(2 * HIDDEN, ATTENTION, scale=0.3), "ca": np.zeros(ATTENTION, np.float32),
                   "va": random(ATTENTION, scale=0.3), "wo": random(2 * HIDDEN, scale=0.3), "co": np.full(1, -1, np.float32)}

    def cells(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word in the vocabulary; the last one is that of all other words."""
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        place = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[place] == hashes, place, len(self.known))

    def inputs(self, text: Text, cells: np.ndarray) -> np.ndarray:
        """One input vector per distinct word."""
        sizes = np.diff(np.append(text.bounds, len(text.trigrams)))
        chars = np.add.reduceat(self.p["char"][text.trigrams], text.bounds, axis=0) / _root(sizes)
        return np.concatenate([self.p["word"][cells], chars], axis=1)

    def run(self, way: str, projected: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states (step, window, unit) of one direction; ``keep`` collects what the way back needs."""
        steps, n = index.shape
        h = np.zeros((n, HIDDEN), projected.dtype)
        out = np.empty((steps, n, HIDDEN), projected.dtype)
        u, k = self.p[f"u{way}"], HIDDEN
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            x, s = projected[index[t]], h @ u
            gates = _sigmoid(x[:, :2 * k] + s[:, :2 * k])
            z, r = gates[:, :k], gates[:, k:]
            new = np.tanh(x[:, 2 * k:] + r * s[:, 2 * k:])
            m = mask[t][:, None]
            after = h + m * (1 - z) * (new - h)
            if keep is not None:
                keep.append((t, h, z, r, new, s[:, 2 * k:], m))
            h = out[t] = after
        return out

    def pooled(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
        inner = np.tanh(states @ self.p["wa"] + self.p["ca"])
        weight = inner @ self.p["va"]
        weight = np.where(mask > 0, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        return inner, weight, np.einsum("tn,tnd->nd", weight, states)

    def logits(self, text: Text, start: np.ndarray, length: np.ndarray, block: int = 2048) -> np.ndarray:
        """The score of each window before the logistic."""
        if not len(start):
            return np.zeros(0, np.float32)
        x = self.inputs(text, self.cells(text.hashes))
        projected = {way: x @ self.p[f"w{way}"] + self.p[f"c{way}"] for way in "fb"}
        out = []
        for a in range(0, len(start), block):
            index, mask = _grid(text.index, start[a:a + block], length[a:a + block])
            states = np.concatenate([self.run(way, projected[way], index, mask) for way in "fb"], axis=2)
            out.append(self.pooled(states, mask)[2] @ self.p["wo"] + self.p["co"])
        return np.concatenate(out)

    def gradients(self, text: Text, start: np.ndarray, length: np.ndarray, target: np.ndarray,
                  hidden: np.ndarray | None = None) -> tuple[float, dict]:
        """Log loss of the windows and its gradient; ``hidden``: distinct words to treat as unknown."""
        p, k = self.p, HIDDEN
        cells = self.cells(text.hashes)
        if hidden is not None:
            cells = np.where(hidden, len(self.known), cells)
        x = self.inputs(text, cells)
        index, mask = _grid(text.index, start, length)
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.run(w, x @ p[f"w{w}"] + p[f"c{w}"], index, mask, kept[w]) for w in "fb"], axis=2)
        inner, weight, pooled = self.pooled(states, mask)
        prob = _sigmoid(pooled @ p["wo"] + p["co"])
        loss = -np.log(np.maximum(np.where(target > 0, prob, 1 - prob), 1e-7)).mean()
        d = (prob - target) / np.float32(len(target))
        g = {"wo": pooled.T @ d, "co": d.sum(keepdims=True)}
        d_pooled = d[:, None] * p["wo"]
        d_weight = np.einsum("nd,tnd->tn", d_pooled, states)
        d_weight = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_inner = d_weight[:, :, None] * p["va"] * (1 - inner ** 2)
        g |= {"va": np.einsum("tn,tna->a", d_weight, inner), "wa": np.einsum("tnd,tna->da", states, d_inner),
              "ca": d_inner.sum(axis=(0, 1))}
        d_states = weight[:, :, None] * d_pooled + d_inner @ p["wa"].T
        d_x = np.zeros_like(x)
        for half, way in enumerate("fb"):
            d_u, d_proj = np.zeros_like(p[f"u{way}"]), np.zeros((len(x), 3 * k), x.dtype)
            d_h = np.zeros((len(target), k), x.dtype)
            for t, h, z, r, new, s_new, m in reversed(kept[way]):
                d_h = d_h + d_states[t, :, half * k:(half + 1) * k]
                d_after = m * d_h
                d_new = d_after * (1 - z) * (1 - new ** 2)
                d_z = d_after * (h - new) * z * (1 - z)
                d_r = d_new * s_new * r * (1 - r)
                d_gate = np.concatenate([d_z, d_r, d_new], axis=1)
                d_s = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(d_proj, index[t], d_gate)
                d_u += h.T @ d_s
                d_h = d_h * (1 - m) + d_after * z + d_s @ p[f"u{way}"].T
            g |= {f"u{way}": d_u, f"w{way}": x.T @ d_proj, f"c{way}": d_proj.sum(axis=0)}
            d_x += d_proj @ p[f"w{way}"].T
        sizes = np.diff(np.append(text.bounds, len(text.trigrams)))
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], cells, d_x[:, :WIDTH])
        np.add.at(g["char"], text.trigrams, np.repeat(d_x[:, WIDTH:] / _root(sizes), sizes, axis=0))
        return float(loss), g


def _grid(index: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word and mask of each step (rows) of each window (columns)."""
    step = np.arange(max(int(length.max()), 1))[:, None]
    mask = (step < length).astype(np.float32)
    return index[np.minimum(start + step, len(index) - 1)], mask


def _part(text: Text, start: np.ndarray, length: np.ndarray) -> Text:
    """The text with only the distinct words that some window holds."""
    used = np.unique(np.concatenate([text.index[a:a + n] for a, n in zip(start, length)]))
    sizes = np.diff(np.append(text.bounds, len(text.trigrams)))[used]
    bounds = np.cumsum(sizes) - sizes
    places = np.arange(sizes.sum()) + np.repeat(text.bounds[used] - bounds, sizes)
    renamed = np.zeros(len(text.hashes), np.int64)
    renamed[used] = np.arange(len(used))
    return Text(text.hashes[used], text.trigrams[places], bounds, renamed[text.index], text.rows)


def vocabulary(text: Text) -> np.ndarray:
    """The hashes of the words that most rows share, LEAST_DOCS at least."""
    row = np.repeat(np.arange(len(text.rows) - 1), np.diff(text.rows))
    held = np.unique(text.index * len(text.rows) + row) // len(text.rows)
    count = np.bincount(held, minlength=len(text.hashes))
    common = np.lexsort((text.hashes, -count))[:VOCABULARY]
    return np.sort(text.hashes[common[count[common] >= LEAST_DOCS]])


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Adam over the windows that score highest in their documents; at first over windows at random."""
    rng = np.random.default_rng(seed)
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    text = read(np.frombuffer(b"".join(data), np.uint8), offsets)
    net = Network(vocabulary(text), seed)
    start, length, row = windows(text.rows)
    docs, first = np.unique(row, return_index=True)
    bound = np.append(first, len(row))
    target = np.array(labels, np.float32)[docs]
    seen = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        scores = rng.random(len(row)) if epoch < 2 else net.logits(text, start, length)
        best = np.array([a + int(np.argmax(scores[a:b])) for a, b in zip(bound[:-1], bound[1:])])
        for batch in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // BATCH)):
            s, n = start[best[batch]], length[best[batch]]
            part = _part(text, s, n)
            _, g = net.gradients(part, s, n, target[batch], rng.random(len(part.hashes)) < HIDDEN_WORDS)
            step += 1
            rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            norm = np.sqrt(sum(float((v ** 2).sum()) for v in g.values()))
            for k, v in g.items():
                v = v * np.float32(min(1.0, 1.0 / (norm + 1e-6)))
                one, two = seen[k]
                one += np.float32(0.1) * (v - one)
                two += np.float32(0.001) * (v * v - two)
                net.p[k] -= np.float32(rate) * one / (np.sqrt(two) + np.float32(1e-6))
                if k not in ("co", "ca", "cf", "cb"):
                    net.p[k] *= np.float32(1 - rate * DECAY)
    return net


def excerpt(text: str, seed: int) -> str:
    """The text, or of a text of more than SAMPLE_WINDOWS windows that many, drawn over all of it, one after the other."""
    found = [word[:SAMPLE_LETTERS] for word in WORD.findall(text)]
    if len(found) <= SAMPLE_WINDOWS * WINDOW:
        return " ".join(found)
    rng = np.random.default_rng(seed)
    first = int(rng.integers(WINDOW))  # so that no place is always a seam
    drawn = np.sort(rng.permutation((len(found) - first) // WINDOW)[:SAMPLE_WINDOWS])
    return " ".join(" ".join(found[first + i * WINDOW:first + (i + 1) * WINDOW]) for i in drawn.tolist())


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic",
          per_class: int = SAMPLE_PER_CLASS) -> Network | float:
    """Trains on a bounded sample: of each class the ``per_class`` rows with the smallest id hash, of any length, with an
    excerpt of the long ones.  With one class or none: the share of class 1."""
    marked = labels.where(F.col(label).isin(0, 1) & ~held_out).select("doc_id", F.col(label).cast("int").alias("label"))
    known = docs.where("text IS NOT NULL").select("doc_id").join(marked, "doc_id")
    picked = F.broadcast(sampled(known, "doc_id", "label", per_class))  # 2 * per_class ids at most
    sample = docs.where("text IS NOT NULL").select("doc_id", "text").join(picked, "doc_id").select("doc_id", "text", "label")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cuts = pa.array([excerpt(t, crc32(str(i).encode())) for i, t in zip(ids, texts)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), cuts, batch.column(2)], names=["doc_id", "text", "label"])

    rows = sorted((r.doc_id, r.text, r.label) for r in in_arrow(sample, cut, sample.schema).collect() if r.text)
    if len({r[2] for r in rows}) < 2:
        return float(np.mean([r[2] for r in rows])) if rows else 0.0
    return train([r[1] for r in rows], [r[2] for r in rows])


def score_texts(texts: pa.Array, net: Network | float) -> np.ndarray:
    out = np.zeros(len(texts))
    for first, end, data, offsets in chunks(texts):
        text = read(data, offsets)
        start, length, row = windows(text.rows)
        if not len(row):
            continue
        logits = net.logits(text, start, length) if isinstance(net, Network) else np.zeros(len(row))
        heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        peak = 1 / (1 + np.exp(-np.maximum.reduceat(logits.astype(np.float64), heads)))
        out[first + row[heads]] = peak if isinstance(net, Network) else net
    return out


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic") -> DataFrame:
    """Per document: doc_id and score, over the whole text.  ``held_out``: which labels are not learned from."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, held_out, label))  # of fixed size

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score_texts(batch.column(1), shared.value))],
                                             names=["doc_id", "score"])

    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), score,
                    "doc_id long, score double")
