"""A quality classifier: regularised quadratic discriminant analysis over document statistics.

Each text becomes a short vector of statistics (word and character shares, repetition, entropy), transformed to be
roughly normal.  Per class the mean and covariance come from sums that Spark aggregates over all labelled rows; the
class covariances are shrunk towards the pooled one and that towards a multiple of the identity.  The score is the
logistic of the difference of the two Mahalanobis log-densities, tempered, with Cholesky factors computed once.

Rows: a NULL text is read as empty and scored; an unlabelled row is scored and not learned from; a label row that is
repeated counts each time; without two labelled classes every score is the share of class 1 among the labelled rows,
or 0.5; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import in_arrow, written
from harborline.llm.shingles import chunks, mix, word_hashes, words

NAMES = ["n_words", "word_length", "word_spread", "upper", "digits", "symbols", "points", "marks", "spaces", "line_words",
         "entropy", "distinct", "echo", "pairs", "top_word", "top_char"]
POOLED = (0.02, 0.1, 0.3, 0.7)  # shrinkage of a class covariance towards the pooled one
ROUND = (0.001, 0.01, 0.1)  # shrinkage of that towards a multiple of the identity
TEMPERATURES = (1.0, 2.0, 4.0, 8.0)
SPLIT = 5  # one fifth of the learned rows picks the three
_KIND = np.zeros(256, np.uint8)  # 0 letters, 1 capitals, 2 digits, 3 symbols, 4 points and commas, 5 other marks, 6 spaces
_KIND[65:91], _KIND[48:58] = 1, 2
_KIND[[ord(c) for c in "#*$%&|<>@^~_=+{}[]\\/"]] = 3
_KIND[[ord(c) for c in ".,;"]] = 4
_KIND[[ord(c) for c in "!?:'\"()-`"]] = 5
_KIND[[32, 9, 10, 11, 12, 13]] = 6


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The arcsine of the root of a share, which evens out its variance."""
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def statistics(texts: pa.Array) -> Iterator[np.ndarray]:
    """The transformed statistics of each row of a text column, chunk by chunk."""
    for first, end, data, offsets in chunks(texts):
        n = end - first
        sizes = np.diff(offsets).astype(np.float64)
        row = np.repeat(np.arange(n), np.diff(offsets))
        kind = np.bincount(row * 8 + _KIND[data], minlength=n * 8).reshape(n, 8).astype(np.float64)
        chars = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256).astype(np.float64)
        share = chars / np.maximum(sizes, 1)[:, None]
        entropy = -(share * np.log2(np.maximum(share, 1e-12))).sum(axis=1)
        starts, ends, bounds = words(data, offsets)
        count = np.diff(bounds).astype(np.float64)
        lengths = (ends - starts).astype(np.float64)
        mean = _sums(lengths, bounds) / np.maximum(count, 1)
        spread = np.sqrt(np.maximum(_sums(lengths ** 2, bounds) / np.maximum(count, 1) - mean ** 2, 0))
        hashes = word_hashes(data, starts, ends)
        same = np.zeros(len(hashes))
        pair = hashes.copy()
        if len(hashes) > 1:
            same[1:] = hashes[1:] == hashes[:-1]
            pair[:-1] = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
        heads = bounds[:-1][count > 0]
        same[heads] = 0
        distinct, pairs, top = np.zeros(n), np.zeros(n), np.zeros(n)
        for i in np.flatnonzero(count > 0):
            a, b = bounds[i], bounds[i + 1]
            sorted_ = np.sort(hashes[a:b])
            edges = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1], [True]]))
            distinct[i], top[i] = len(edges) - 1, np.diff(edges).max()
            two = np.sort(pair[a:b - 1])
            pairs[i] = 1 + np.count_nonzero(two[1:] != two[:-1]) if len(two) else 1
        lines = chars[:, 10] + 1
        # Repetition is normal in long texts, so shares of distinct words are taken in logarithms of both counts.
        yield np.column_stack([
            np.log1p(count), np.log1p(mean), np.log1p(spread), _share(kind[:, 1], sizes), _share(kind[:, 2], sizes),
            _share(kind[:, 3], sizes), _share(kind[:, 4], count), _share(kind[:, 5], sizes), _share(kind[:, 6], sizes),
            np.log1p(count / lines), entropy, np.log1p(distinct) / np.maximum(np.log1p(count), 0.5),
            _share(_sums(same, bounds), count), np.log1p(pairs) / np.maximum(np.log1p(count), 0.5),
            _share(top, count), _share(np.delete(chars, 32, axis=1).max(axis=1), sizes)])


FEATURES = "key long, x array<double>"


def featured(docs: DataFrame) -> DataFrame:
    """Per row: key (doc_id) and x, its statistics."""
    schema = pa.schema([("key", pa.int64()), ("x", pa.list_(pa.float64()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(statistics(batch.column(1)))
            x = np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(NAMES), dtype=np.int32), x.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists.cast(pa.list_(pa.float64()))], schema=schema)

    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), measure, FEATURES)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(rows: DataFrame, function, n: int) -> dict[tuple[int, int], np.ndarray]:
    """Per (label, part) the sum over all rows of ``function(x)``, ``n`` numbers a row; rows are (label, part, x)."""
    schema = pa.schema([("label", pa.int32()), ("part", pa.int32()), ("place", pa.int32()), ("value", pa.float64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            label, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            x = _matrix(batch.column(2))
            for key in sorted(set(zip(label.tolist(), part.tolist()))):
                own = (label == key[0]) & (part == key[1])
                totals[key] = totals.get(key, 0) + function(key[0], x[own])
        for (label, part), total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, label), pa.int32()), pa.array(np.full(n, part), pa.int32()),
                                              pa.array(np.arange(n), pa.int32()), pa.array(total)], schema=schema)

    sums = in_arrow(rows, add, "label int, part int, place int, value double")
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in sums.groupBy("label", "part", "place").agg(F.sum("value").alias("value")).collect():  # a few hundred rows
        out.setdefault((r.label, r.part), np.zeros(n))[r.place] = r.value
    return out


def _moments(_: int, x: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])


@dataclass(frozen=True)
class Model:
    prior: np.ndarray  # log share of each class
    means: list[np.ndarray]
    factors: list[np.ndarray]  # inverse Cholesky factors
    log_dets: list[float]
    centre: np.ndarray
    scale: np.ndarray
    temperature: float = 1.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, with priors."""
        z = np.clip((x - self.centre) / self.scale, -12, 12)
        density = []
        for k in (0, 1):
            d = (z - self.means[k]) @ self.factors[k].T
            density.append(self.prior[k] - 0.5 * self.log_dets[k] - 0.5 * (d * d).sum(axis=1))
        return density[1] - density[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.difference(x) / self.temperature, -40, 40)))


def build(sums: list[np.ndarray], pooled: float, rounded: float, temperature: float) -> Model:
    """The model from the sums of the two classes."""
    d = len(NAMES)
    count = np.array([s[0] for s in sums])
    both = sums[0] + sums[1]
    centre = both[1:d + 1] / both[0]
    scale = np.sqrt(np.maximum(np.diag(both[d + 1:].reshape(d, d)) / both[0] - centre ** 2, 1e-6))
    means, scatter = [], []
    for s in sums:
        mean = s[1:d + 1] / s[0]
        means.append((mean - centre) / scale)
        scatter.append((s[d + 1:].reshape(d, d) / s[0] - np.outer(mean, mean)) / np.outer(scale, scale))
    common = (count[0] * scatter[0] + count[1] * scatter[1]) / count.sum()
    factors, log_dets = [], []
    for k in (0, 1):
        cov = (1 - pooled) * scatter[k] + pooled * common
        cov = (1 - rounded) * cov + (rounded * np.trace(cov) / d + 1e-6) * np.eye(d)
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        log_dets.append(2 * np.log(np.diag(low)).sum())
    return Model(np.log(count / count.sum()), means, factors, log_dets, centre, scale, temperature)


def fit(labelled: DataFrame) -> Model | float:
    """The model of rows (label, part, x), part 0 being the rows that choose shrinkage and temperature.

    Both passes run over all rows and bring back a few hundred sums.  Without two classes: the share of class 1.
    """
    d = len(NAMES)
    sums = _summed(labelled, _moments, 1 + d + d * d)
    whole = [sum((sums[k] for k in sums if k[0] == label), np.zeros(1 + d + d * d)) for label in (0, 1)]
    if min(whole[0][0], whole[1][0]) < 2:
        return float(whole[1][0] / (whole[0][0] + whole[1][0])) if whole[0][0] + whole[1][0] else 0.5
    grid = [(p, r, t) for p in POOLED for r in ROUND for t in TEMPERATURES]
    part = [sums.get((label, 1)) for label in (0, 1)]
    if any(s is None or s[0] < 2 for s in part) or not any(k[1] == 0 for k in sums):
        return build(whole, 0.3, 0.01, 4.0)
    models = [build(part, *g) for g in grid]

    def loss(label: int, x: np.ndarray) -> np.ndarray:
        s = [np.clip(m.scores(x), 1e-6, 1 - 1e-6) for m in models]
        return np.array([-np.log(p if label == 1 else 1 - p).sum() for p in s])

    losses = _summed(labelled.where(F.col("part") == 0), loss, len(grid))
    return build(whole, *grid[int(np.argmin(sum(losses.values())))])


def score_rows(features: DataFrame, model: Model | float) -> DataFrame:
    """Per row of features: key and score."""
    shared = features.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            x = _matrix(batch.column(1)) if len(batch) else np.zeros((0, len(NAMES)))
            out = model.scores(x) if isinstance(model, Model) else np.full(len(x), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["key", "score"])

    return in_arrow(features.select("key", "x"), score, "key long, score double")


def learn(features: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality") -> Model | float:
    """The model from the written statistics of the labelled documents that are not held out."""
    marked = labels.where(F.col(label).isin(0, 1) & ~held_out).select("doc_id", F.col(label).cast("int").alias("label"))
    part = F.least(F.pmod(F.xxhash64("key"), F.lit(SPLIT)), F.lit(1)).cast("int")
    labelled = features.join(marked, features["key"] == marked["doc_id"]).select("label", part.alias("part"), "x")
    return fit(labelled)


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality") -> DataFrame:
    """Per document: doc_id and score.  ``held_out``: over doc_id, which labels are not to be learned from.

    One pass over the texts writes the statistics; learning and scoring read those.
    """
    features = written(featured(docs), "quality-statistics")
    return score_rows(features, learn(features, labels, held_out, label)).select(F.col("key").alias("doc_id"), "score")


def accepted(docs: DataFrame, labels: DataFrame, held_out: Column, least: float = 0.7, label: str = "quality") -> DataFrame:
    """The documents, all columns, that score ``least`` or more.

    They are scored where they are read, a second pass over the texts, so that no text is shuffled.
    """
    model = learn(written(featured(docs), "quality-statistics"), labels, held_out, label)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            parts = list(statistics(batch.column(place)))
            x = np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
            scores = model.scores(x) if isinstance(model, Model) else np.full(len(x), model)
            yield batch.filter(pa.array(scores >= least))

    return in_arrow(docs, keep, docs.schema)
