"""Language identification with string kernels.

A text is cut into windows of whole bytes; a window is the set of its letter n-grams (presence, not counts) of several
lengths, hashed into one block of cells per length.  The blended-spectrum kernel of two windows is the mean over the
lengths of the normalised number of n-grams that both have.  Nystroem landmarks turn the kernel into a small feature
space, and one-versus-rest kernel ridge regression is solved there; landmarks and solution fold into one matrix, so
scoring is two matrix products per batch.  A document's score is the mean of its windows by length.

Rows: a NULL text, or one without any letter, is ``und`` with score 0; ties between languages go to the first by name;
repeated rows are scored alike; without any learned language every text is ``und``; extra columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import in_arrow, sampled
from harborline.llm.shingles import chunks

LENGTHS = (2, 3, 4)
CELLS = 2048  # per length
WINDOW_BYTES = 4096
SAMPLE_PER_LANGUAGE, LANDMARKS, RIDGE, SHARPNESS = 1500, 192, 1e-3, 6.0
LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.full(256, 32, np.uint8)  # what is not a letter separates
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def grams(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Presence of hashed n-grams, one row per window (its first bytes in ``starts``), scaled to unit blocks."""
    low = _FOLD[data]
    accented = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    low[1:][accented] += 32
    row = np.zeros(len(data) + 1, np.int32)
    np.add.at(row, starts[1:], 1)
    row = np.cumsum(row[:-1], dtype=np.int32)
    out = np.zeros((len(starts), len(LENGTHS), CELLS), np.float32)
    wide = low.astype(np.uint32)
    for block, length in enumerate(LENGTHS):
        n = len(data) - length + 1
        if n <= 0:
            continue
        code = np.zeros(n, np.uint32)
        for k in range(length):
            code += wide[k:k + n] * _MIX[k]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        inside = row[:n] == row[length - 1:]
        out[row[:n][inside], block, (code >> np.uint32(21))[inside]] = 1
    norm = np.sqrt(out.sum(axis=2, keepdims=True))
    out /= np.maximum(norm, 1) * np.sqrt(len(LENGTHS))
    return out.reshape(len(starts), -1)


def window_starts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each window and the row it belongs to; an empty row has none, a short rest joins its neighbour."""
    sizes = np.diff(offsets)
    per = np.where(sizes > 0, np.maximum(1, (sizes + WINDOW_BYTES // 2) // WINDOW_BYTES), 0)
    row = np.repeat(np.arange(len(sizes)), per)
    index = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    return offsets[:-1][row] + index * WINDOW_BYTES, row


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: np.ndarray  # one column each
    weights: np.ndarray  # landmarks x languages

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = (features @ self.landmarks) @ self.weights
        out = np.exp(SHARPNESS * (out - out.max(axis=1, keepdims=True)))
        return out / out.sum(axis=1, keepdims=True)


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression, one language against the rest, over evenly spread landmarks.

    Only the landmarks' features are kept; of the other texts, their kernel with these.
    """
    def features(text: str) -> np.ndarray:
        return grams(np.frombuffer(text.encode(), np.uint8), np.array([0]))

    names = sorted(set(languages))
    order = sorted(range(len(languages)), key=lambda i: (languages[i], i))
    picked = [order[i] for i in np.unique(np.linspace(0, len(order) - 1, min(landmarks, len(order))).astype(int))]
    marks = np.concatenate([features(texts[i]) for i in picked])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = np.concatenate([features(text) @ marks.T for text in texts]).astype(np.float64) @ root
    target = np.array([[1.0 if x == name else -1.0 for name in names] for x in languages])
    balance = np.array([1.0 / max(1, languages.count(x)) for x in names])[[names.index(x) for x in languages]] * len(languages) / len(names)
    weighted = mapped * balance[:, None]
    solved = np.linalg.solve(mapped.T @ weighted + ridge * len(languages) * np.eye(mapped.shape[1]), weighted.T @ target)
    return Model(names, marks.T, (root @ solved).astype(np.float32))


def learn(rows: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fits on a bounded sample: per language the ``per_language`` documents with the smallest id hash, and of each one
    window, picked by its id; every language with a document is learned."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    picked = F.broadcast(sampled(rows.select("doc_id", "lang"), "doc_id", "lang", per_language))  # ids only, so many a language
    parts = F.greatest(F.lit(1), F.ceil(F.length("text") / F.lit(WINDOW_BYTES)).cast("int"))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), parts).cast("int")
    piece = F.substring("text", place * F.lit(WINDOW_BYTES) + 1, F.lit(WINDOW_BYTES))
    sample = rows.join(picked, ["doc_id", "lang"]).select("lang", piece.alias("piece")).collect()
    sample = sorted((r.lang, r.piece) for r in sample if LETTER.search(r.piece))
    if not sample:
        return None
    return fit([text for _, text in sample], [lang for lang, _ in sample])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row: doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks x cells numbers, whatever the corpus

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            known = np.array([t is not None and LETTER.search(t) is not None for t in batch.column(1).to_pylist()], bool)
            best, score = np.zeros(len(known), np.int64), np.zeros(len(known))
            for first, end, data, offsets in chunks(batch.column(1)) if model else ():
                starts, row = window_starts(offsets)
                if not len(starts):
                    continue
                sizes = np.diff(np.append(starts, offsets[-1]))
                total = np.zeros((end - first, len(model.languages)))
                for a in range(0, len(starts), 512):
                    b = min(a + 512, len(starts))
                    stop = starts[b] if b < len(starts) else len(data)
                    part = model.scores(grams(data[starts[a]:stop], starts[a:b] - starts[a]))
                    np.add.at(total, row[a:b], part * sizes[a:b, None])
                total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-12)
                best[first:end], score[first:end] = total.argmax(axis=1), total.max(axis=1)
            names = [model.languages[b] if k else "und" for b, k in zip(best, known)] if model else ["und"] * len(known)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))],
                names=["doc_id", "lang_pred", "score"])

    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), score,
                    "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learns from the rows that are not held out and predicts every row: doc_id, held_out, lang_pred, score."""
    model = learn(docs.where(~held_out).select("doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
