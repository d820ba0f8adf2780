"""Components of documents whose sets of word shingles have a Jaccard similarity of 0.75 or more, exactly.

Set-relation skipping, dealt out over Spark:

1.  Equal sets are one set, named by a 64-bit hash.
2.  Two similar sets share a shingle among the first quarter of each, in any one order of all shingles.  The order is by
    estimated frequency (a sketch of fixed size, counted over all texts), then by hash, so that passages that many
    documents share come last.  These index entries meet in lists, one per shingle, as packed arrays.
3.  A list is cut into blocks by position.  The first entries of a list are its pivots; a pivot reads the list only up to
    the last block whose position still allows enough overlap, and skips the rest.
4.  Pairs are verified where their sets lie together in regions of bounded size, first by short marks of the shingles,
    which rule most pairs out, then by the shingles.  A set's answers (its overlaps with
    all sets of the region) come from the answers of the set before it: only the shingles in which the two differ are
    looked up.
5.  What links joins components, and a pair inside one component needs no verification.  Lists that still hold more
    than one component are finished: short ones pair by pair, long ones by holding the few sets outside the largest
    component against all sets of the list, again in regions, without writing the pairs down.

Rows: NULL and empty texts and texts without words have no shingles and are components of their own; fewer than five
words are one shingle; a row without doc_id is its own component, named NULL; repeated rows are each returned, and rows
that share a doc_id but not a text are separate sets; an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import bitmap, bitmap_hits, in_arrow, shuffle_partitions, numbered, without, written
from harborline.llm.components import components
from harborline.llm.shingles import mix, set_id, shingle_sets

WORDS = 5
CELLS, CELL_BLOCK = 1 << 23, 1 << 14  # of the frequency sketch
PIVOTS, SHORT_LIST, PIVOT_REGION, REGION = 4, 64, 256, 1024
POSITION_BLOCK, LIST_PARTS = 16, 16
SPLIT_CLASS = 17  # shingles of some 2**17 documents and more have their list dealt out over several tasks
FLUSH = 1 << 18  # index entries packed at a time
SLICE = 256  # rows of a batch taken into Python at a time
_U = np.uint64


def needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least overlap of sets of n and m shingles with 100 * overlap >= 75 * union."""
    return (3 * (n + m) + 6) // 7


def prefix_length(n: int) -> int:
    """How many of the first shingles must hold one of any similar set."""
    return n - (3 * n + 3) // 4 + 1


# ---- 1. sets and the frequency sketch


def survey(docs: DataFrame, cells: int) -> DataFrame:
    """One row per document (doc_id, n, set_id) and, per task, its counts of shingles by cell (block, counts)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("set_id", pa.int64()), ("block", pa.int32()), ("counts", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, held = np.zeros(cells, np.uint16), [], 0
        for batch in batches:
            sizes, names = [], []
            for values in shingle_sets(batch.column(1), WORDS):
                sizes.append(len(values))
                names.append(set_id(values) if len(values) else None)
                waiting.append((values & _U(cells - 1)).astype(np.uint32))
                held += len(values)
                if held >= FLUSH:
                    _count(counts, waiting)
                    waiting, held = [], 0
            n = len(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(names, pa.int64()),
                                              pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
        _count(counts, waiting)
        used = [b for b in range(-(-cells // CELL_BLOCK)) if counts[b * CELL_BLOCK:(b + 1) * CELL_BLOCK].any()]
        for a in range(0, len(used), 64):
            part = used[a:a + 64]
            blobs = [zlib.compress(counts[b * CELL_BLOCK:(b + 1) * CELL_BLOCK].tobytes(), 1) for b in part]
            none = pa.nulls(len(part), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none.cast(pa.int32()), none, pa.array(part, pa.int32()), pa.array(blobs, pa.binary())], schema=schema)

    return in_arrow(docs, read, "doc_id long, n int, set_id long, block int, counts binary")


def _count(counts: np.ndarray, found: list[np.ndarray]) -> None:
    """Adds one to the cells for each time they are found, up to 65535; sorted first, so that memory is walked in order."""
    cells = np.sort(np.concatenate([*found, np.zeros(0, np.uint32)]))
    heads = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, np.int64)
    found_now = counts[cells[heads]] + np.diff(np.append(heads, len(cells)))
    counts[cells[heads]] = np.minimum(found_now, 65535).astype(np.uint16)


def classes(sketch: DataFrame, cells: int, total: int) -> bytes:
    """One byte per cell: 0, or the binary logarithm of its count where that stands out from chance.

    The counts of all tasks are added up in Spark, block by block; the driver gets one byte per cell.
    """
    mean = total / cells
    limit = mean + 4 * np.sqrt(mean) + 2

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                have = np.frombuffer(zlib.decompress(counts), np.uint16).astype(np.int64)
                sums[block] = sums[block] + have if block in sums else have
        out = [np.where(s > limit, np.log2(np.maximum(s, 1)), 0).astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(out, pa.binary())], names=["block", "classes"])

    found = np.zeros(cells, np.uint8)
    for r in in_arrow(sketch.repartition("block"), add, "block int, classes binary").collect():
        found[r.block * CELL_BLOCK:r.block * CELL_BLOCK + len(r.classes)] = np.frombuffer(r.classes, np.uint8)
    return found.tobytes()


# ---- 2. index entries

ENTRY = np.dtype([("token", "<u4"), ("set", "<i8"), ("n", "<u2"), ("pos", "<u2")])
LARGE = 65535  # stands for all sizes from here on, and rules nothing out
SPLIT, LAST_POS = 1 << 15, (1 << 15) - 1  # a bit of pos where a shingle's list is dealt out; later positions read as the last


def index_entries(docs: DataFrame, shared_classes, buckets: int, split_class: int = SPLIT_CLASS) -> DataFrame:
    """The first shingles of every set, packed by bucket of the shingle: bucket and a block of ENTRY.

    A token keeps 32 bits besides its bucket; two shingles that fall together only make more pairs to verify.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = np.frombuffer(shared_classes.value, np.uint8), set()
        waiting, held = [], 0
        for batch in batches:
            for values in shingle_sets(batch.column(1), WORDS):
                n = len(values)
                name = set_id(values) if n else None
                if not n or name in seen:
                    continue
                seen.add(name)
                kind = known[(values & _U(len(known) - 1)).astype(np.int64)]
                length = prefix_length(n)
                first = values[:length] if not kind[:length].any() else values[np.argsort(kind, kind="stable")[:length]]
                waiting.append((first.copy(), name, n))  # not a view, which would keep the whole set
                held += length
                if held >= FLUSH:
                    yield from _packed(waiting, known, buckets, split_class)
                    waiting, held = [], 0
        if waiting:
            yield from _packed(waiting, known, buckets, split_class)

    return in_arrow(docs, cut, "bucket int, entries binary")


def _packed(sets: list[tuple], known: np.ndarray, buckets: int, split_class: int) -> Iterator[pa.RecordBatch]:
    lengths = np.array([len(s[0]) for s in sets])
    values = np.concatenate([s[0] for s in sets])
    entry = np.empty(len(values), ENTRY)
    mixed = mix(values)
    entry["token"] = (mixed & _U(0xFFFFFFFF)).astype(np.uint32)
    entry["set"] = np.repeat(np.array([s[1] for s in sets], np.int64), lengths)
    entry["n"] = np.repeat(np.array([min(s[2], LARGE) for s in sets], np.uint16), lengths)
    entry["pos"] = np.minimum(np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths), LAST_POS)
    bucket = (mixed >> _U(32)) & _U(buckets - 1)
    kind = known[(values & _U(len(known) - 1)).astype(np.int64)]
    hot = kind >= split_class
    if hot.any():  # a list for each part of the sets
        part = mix(entry["set"][hot].view(np.uint64)) & ((_U(1) << (kind[hot] - split_class + 1).astype(np.uint64)) - _U(1))
        bucket[hot] = (bucket[hot] + part * _U(0x9E3779B1)) & _U(buckets - 1)
        entry["pos"][hot] |= SPLIT
    order = np.argsort(bucket, kind="stable")
    bucket, entry = bucket[order], entry[order]
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    tails = np.append(heads[1:], len(bucket))
    for a in range(0, len(heads), 1024):
        blocks = [entry[i:j].tobytes() for i, j in zip(heads[a:a + 1024], tails[a:a + 1024])]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[heads[a:a + 1024]].astype(np.int32)), pa.array(blocks, pa.binary())],
                                         names=["bucket", "entries"])


# ---- 3. lists, pivots and the entries left open

FOUND = "kind int, home long, a long, b long, x int, y int, z int"
_FOUND = pa.schema([("kind", pa.int32()), ("home", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("x", pa.int32()),
                    ("y", pa.int32()), ("z", pa.int32())])
PAIR, OPEN = 0, 1


def possible(n, i, m, j):
    """Whether sets of n and m shingles that share the ones at positions i and j can be similar."""
    return (n == LARGE) | (m == LARGE) | (4 * np.minimum(n, m) >= 3 * np.maximum(n, m)) & (
        np.minimum(i, j) + np.minimum(n - i, m - j) >= needed(n, m))


def read_lists(bucket: int, entry: np.ndarray) -> tuple[dict, dict]:
    """Pairs of the pivots of every list of a bucket, and the entries of the lists that pivots do not finish."""
    split = (entry["pos"] & SPLIT) > 0
    pos = (entry["pos"] & LAST_POS).astype(np.int64)
    block = pos // POSITION_BLOCK
    order = np.lexsort((entry["set"], block, entry["token"]))
    entry, block, pos, split = entry[order], block[order], pos[order], split[order]
    fresh = np.concatenate([[True], (entry["token"][1:] != entry["token"][:-1]) | (entry["set"][1:] != entry["set"][:-1])])
    entry, block, pos, split = entry[fresh], block[fresh], pos[fresh], split[fresh]
    new = np.concatenate([[True], entry["token"][1:] != entry["token"][:-1]])
    size = np.diff(np.append(np.flatnonzero(new), len(entry)))
    keep = (np.repeat(size, size) > 1) | split
    entry, block, pos, split = entry[keep], block[keep], pos[keep], split[keep]
    if not len(entry):
        return {}, {}
    heads = np.flatnonzero(np.concatenate([[True], entry["token"][1:] != entry["token"][:-1]]))
    size = np.diff(np.append(heads, len(entry)))
    row = np.repeat(np.arange(len(heads)), size)
    rank = np.arange(len(entry)) - heads[row]
    n = entry["n"].astype(np.int64)
    place = row * (1 << 20) + block  # rises along the lists, so a pivot's last useful block is a binary search
    left, right = [], []
    for k in range(PIVOTS):
        pivot = heads[size > k + 1] + k
        last = np.where(n[pivot] == LARGE, (1 << 20) - 1, (pos[pivot] + n[pivot] // 3) // POSITION_BLOCK)
        stop = np.searchsorted(place, row[pivot] * (1 << 20) + last, "right")
        count = np.maximum(stop - pivot - 1, 0)
        i = np.repeat(pivot, count)
        j = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + i + 1
        fine = possible(n[i], pos[i], n[j], pos[j]) & (entry["set"][i] != entry["set"][j])
        left.append(i[fine])
        right.append(j[fine])
    i, j = np.concatenate(left), np.concatenate(right)
    a, b = np.minimum(entry["set"][i], entry["set"][j]), np.maximum(entry["set"][i], entry["set"][j])
    home = (np.int64(bucket) << 32) | entry["token"][i].astype(np.int64)
    order = np.lexsort((home, b, a))
    first = order[np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])] if len(a) else order
    zero = np.zeros(len(first), np.int32)
    pairs = {"home": home[first], "a": a[first], "b": b[first], "x": (rank[i] // PIVOT_REGION)[first], "y": (rank[j] // PIVOT_REGION)[first], "z": zero}
    part = split[heads][row]
    left_open = (size[row] > PIVOTS + 1) | part
    e = entry[left_open]
    token = e["token"].astype(np.int64) | np.where(part[left_open], 0, np.int64(bucket) << 32)
    opened = {"home": token, "a": e["set"], "b": e["set"], "x": n[left_open], "y": pos[left_open],
              "z": rank[left_open] + PIVOTS * part[left_open]}  # across parts, no pair has been looked at
    return pairs, opened


def _rows(kind: int, columns: dict) -> pa.RecordBatch:
    n = len(columns["a"])
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind), pa.int32()), *[
        pa.array(np.asarray(columns[c]), _FOUND.field(c).type) for c in ("home", "a", "b", "x", "y", "z")]], schema=_FOUND)


def meet(entries: DataFrame, partitions: int) -> DataFrame:
    """Pairs and open entries of all lists; buckets come one after the other, each held alone."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            for kind, columns in enumerate(read_lists(now, np.frombuffer(b"".join(held), ENTRY)) if held else ()):
                if columns and len(columns["a"]):
                    yield _rows(kind, columns)

        for batch in batches:
            for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now:
                    yield from finish()
                    now, held = bucket, []
                held.append(block.as_py())
        yield from finish()

    return in_arrow(entries.repartition(partitions, "bucket").sortWithinPartitions("bucket"), work, FOUND)


# ---- 4. regions: overlaps of sets that lie together


class Answers:
    """Overlaps among the sets of a region, each set's derived from those of the set asked for before."""

    def __init__(self, sets: list[np.ndarray]):
        lengths = np.array([len(s) for s in sets], np.int64)
        _, local = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), lengths)
        self.tokens = np.split(local, np.cumsum(lengths)[:-1])
        order = np.argsort(local, kind="stable")
        self.owners = owner[order]
        self.bounds = np.searchsorted(local[order], np.arange(local.max() + 2 if len(local) else 1))
        self.n, self.last, self.counts = lengths, None, None

    def _holders(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the tokens each set holds, by the tokens' index lists."""
        start, count = self.bounds[tokens], self.bounds[tokens + 1] - self.bounds[tokens]
        places = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
        return np.bincount(self.owners[places], minlength=len(self.n))

    def of(self, i: int) -> np.ndarray:
        """Overlap of set i with every set."""
        own = self.tokens[i]
        if self.last is not None:
            lost = np.setdiff1d(self.tokens[self.last], own, assume_unique=True)
            won = np.setdiff1d(own, self.tokens[self.last], assume_unique=True)
        if self.last is not None and len(lost) + len(won) < len(own):
            counts = self.counts - self._holders(lost) + self._holders(won)
        else:
            counts = self._holders(own)
        self.last, self.counts = i, counts
        return counts


def linked_pairs(sets: dict[int, np.ndarray], pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Which of the pairs are similar."""
    names = sorted(sets)
    place = {name: i for i, name in enumerate(names)}
    if len(names) == 2:
        x, y = (sets[n] for n in names)
        return pairs[:1] if len(np.intersect1d(x, y, assume_unique=True)) >= needed(len(x), len(y)) else []
    answers = Answers([sets[n] for n in names])
    by_hub: dict[int, list[int]] = {}
    for a, b in pairs:
        by_hub.setdefault(place[a], []).append(place[b])
    out = []
    for hub in sorted(by_hub):
        other = np.array(by_hub[hub])
        fine = answers.of(hub)[other] >= needed(answers.n[hub], answers.n[other])
        out.extend((names[hub], names[j]) for j in other[fine].tolist())
    return out


def linked_outsiders(sets: dict[int, np.ndarray], label: dict[int, int], outside: list[int], inside: list[int]) -> list[tuple[int, int]]:
    """For each outside set and each component among the inside sets that it is similar to, one link."""
    names = sorted(sets)
    place = {name: i for i, name in enumerate(names)}
    answers = Answers([sets[n] for n in names])
    other = np.array([place[n] for n in inside])
    theirs = np.array([label[n] for n in inside])
    out = []
    for name in sorted(outside):
        hub = place[name]
        fine = (answers.of(hub)[other] >= needed(answers.n[hub], answers.n[other])) & (theirs != label[name])
        for component in np.unique(theirs[fine]).tolist():
            j = int(np.flatnonzero(fine & (theirs == component))[0])
            out.append((min(name, inside[j]), max(name, inside[j])))
    return out


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Consecutive rows with the same first ``keys`` columns."""
    now, held = None, []
    for batch in batches:
        for a in range(0, len(batch), SLICE):
            for row in zip(*[c.to_pylist() for c in batch.slice(a, SLICE).columns]):
                if row[:keys] != now:
                    if held:
                        yield held
                    now, held = row[:keys], []
                held.append(row)
    if held:
        yield held


LINK = "a long, b long, home long, x int, y int"


def _links(found: list[tuple[int, int]], region: tuple) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    home, x, y = ([part] * len(a) for part in region)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(home, pa.int64()),
                                       pa.array(x, pa.int32()), pa.array(y, pa.int32())], names=["a", "b", "home", "x", "y"])


def bring(docs: DataFrame, members: DataFrame, sets_of: DataFrame, rough: bool) -> DataFrame:
    """The members (sets named ``a``) with the shingles of their sets, ``values``, or with short marks of these.

    Texts whose document is outside a bitmap of fixed size are not read; the exact join follows.
    """
    wanted = members.select("a").distinct()
    wanted = written(wanted.join(sets_of, wanted["a"] == sets_of["set_id"]).select("set_id", "doc_id"), "wanted-sets")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, F.xxhash64("doc_id")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = bitmap_hits(bits.value, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64))
            part = batch.filter(pa.array(fine))
            for a in range(0, len(part), 512):
                piece = part.slice(a, 512)
                values = list(shingle_sets(piece.column(1), WORDS))
                names = [set_id(v) if len(v) else None for v in values]
                blobs = [marks(v) if rough else v.tobytes() for v in values]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(names, pa.int64()), pa.array(blobs, pa.binary())],
                                                 names=["_doc", "_set", "values"])

    read = in_arrow(docs.withColumn("h", F.xxhash64("doc_id")), cut, "_doc long, _set long, values binary")
    columns = members.columns
    members = members.join(wanted, members["a"] == wanted["set_id"])
    return members.join(read, (F.col("set_id") == F.col("_set")) & (F.col("doc_id") == F.col("_doc"))).select(*columns, "values")


def marks(values: np.ndarray) -> bytes:
    """The leading bits of sorted hashes, 16 or, for a large set, 32 of each: equal shingles have equal marks."""
    if len(values) < 4096:
        return b"2" + (values >> _U(48)).astype("<u2").tobytes()
    return b"4" + (values >> _U(32)).astype("<u4").tobytes()


def read_marks(blobs: dict[int, bytes]) -> dict[int, np.ndarray]:
    """Marks as distinct numbers, repeated ones counted up, all of the same width."""
    wide = all(b[:1] == b"4" for b in blobs.values())
    out = {}
    for name, blob in blobs.items():
        found = np.frombuffer(blob[1:], "<u4" if blob[:1] == b"4" else "<u2").astype(np.uint64)
        if blob[:1] == b"4" and not wide:
            found >>= _U(16)
        head = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else found.astype(int)
        nth = np.arange(len(found)) - np.repeat(head, np.diff(np.append(head, len(found))))
        out[name] = (found << _U(32)) | nth.astype(np.uint64)
    return out


def verify(docs: DataFrame, pairs: DataFrame, sets_of: DataFrame, rough: bool) -> DataFrame:
    """The similar ones of the pairs (a, b, home, x, y); sets and pairs of a region (home, x, y) come together.

    ``rough``: by marks, which can only add to an overlap, so no similar pair is lost.
    """
    region = ["home", "x", "y"]
    members = pairs.select(*region, F.col("a").alias("a")).union(pairs.select(*region, F.col("b").alias("a"))).distinct()
    members = bring(docs, members, sets_of, rough).select(*region, "a", F.lit(None).cast("long").alias("b"), "values")
    rows = members.union(pairs.select(*region, "a", "b", F.lit(None).cast("binary").alias("values")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, 3):
            held = {r[3]: r[5] for r in group if r[4] is None}
            sets = read_marks(held) if rough else {k: np.frombuffer(v, np.uint64) for k, v in held.items()}
            found = linked_pairs(sets, sorted({(r[3], r[4]) for r in group if r[4] is not None}))
            yield _links(found, group[0][:3])

    rows = rows.repartition(shuffle_partitions(docs.sparkSession), *region).sortWithinPartitions(*region, F.col("b").asc_nulls_first())
    return in_arrow(rows, work, LINK)


def similar(docs: DataFrame, pairs: DataFrame, sets_of: DataFrame) -> DataFrame:
    """The similar ones of the pairs, written: first those that marks leave, then exactly."""
    left = written(verify(docs, written(pairs, "pairs"), sets_of, True), "rough-links")
    return written(verify(docs, left, sets_of, False).select("a", "b"), "links")


def verify_outsiders(docs: DataFrame, rows: DataFrame, sets_of: DataFrame) -> DataFrame:
    """Links of the rows (home, x, y, a, label, out): in each region the outside sets against all others."""
    region = ["home", "x", "y"]
    rows = bring(docs, written(rows, "regions"), sets_of, False)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, 3):
            held = {r[3]: np.frombuffer(r[6], np.uint64) for r in group}
            label = {r[3]: r[4] for r in group}
            outside, inside = ([r[3] for r in group if r[5] == flag] for flag in (True, False))
            if outside and inside:
                yield _links(linked_outsiders(held, label, outside, inside), group[0][:3])

    rows = rows.select(*region, "a", "label", "out", "values").repartition(
        shuffle_partitions(docs.sparkSession), *region).sortWithinPartitions(*region, "a", "out")
    return in_arrow(rows, work, LINK).select("a", "b")


# ---- 5. the join


def relabel(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels of sets after more links: the links between labels are a small graph of its own."""
    if labels is None:
        return components(links)
    ours, theirs = (labels.select(F.col("node").alias(f"_{c}"), F.col("label").alias(f"l{c}")) for c in "ab")
    lifted = links.join(ours, links["a"] == ours["_a"], "left").join(theirs, links["b"] == theirs["_b"], "left").select(
        F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where(F.col("a") != F.col("b"))
    lifted = written(lifted, "lifted-links")
    if lifted.isEmpty():
        return labels
    moved = components(lifted)
    up = moved.select(F.col("node").alias("_n"), F.col("label").alias("up"))
    old = labels.join(up, labels["label"] == up["_n"], "left").select("node", F.coalesce("up", "label").alias("label"))
    known = labels.select(F.col("node").alias("_k"))
    new = moved.join(known, moved["node"] == known["_k"], "left_anti")
    return written(old.union(new), "set-labels")


def labelled(opened: DataFrame, labels: DataFrame) -> DataFrame:
    """Open entries with their component, of the lists that hold more than one."""
    tagged = opened.join(labels, opened["a"] == labels["node"], "left").select(
        "home", "a", "x", "y", "z", F.coalesce("label", "a").alias("label"))
    tagged = written(tagged, "open-entries")
    mixed = tagged.groupBy(F.col("home").alias("_home")).agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")).where("low <> high")
    return written(with_list(tagged, mixed.select("_home", "size")), "open-lists")


def with_list(entries: DataFrame, lists: DataFrame) -> DataFrame:
    """Entries with what is known of their list (one row per ``_home``), a list's entries dealt over LIST_PARTS tasks."""
    part = F.pmod(F.xxhash64("a"), F.lit(LIST_PARTS)).cast("int")
    lists = lists.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(LIST_PARTS - 1))))
    return entries.join(lists, (F.col("home") == F.col("_home")) & (part == F.col("_part"))).drop("_home", "_part")


def pairs_of_short(lists: DataFrame) -> DataFrame:
    """The possible pairs, in different components, of lists of at most SHORT_LIST entries.

    A pair that no pivot has met is found in every list that both are in, unless one of these is long and they meet
    there later.  So the lists can be counted: similar sets share at least their needed overlap, less what lies behind
    the first shingles of one of them.
    """
    short = lists.where((F.col("size") <= SHORT_LIST) & (F.col("z") >= PIVOTS))
    hub = short.select("home", *[F.col(c).alias(f"h{c}") for c in ("a", "x", "y", "z", "label")])
    n, i, m, j = F.col("hx"), F.col("hy"), F.col("x"), F.col("y")
    large = (n == LARGE) | (m == LARGE)
    overlap = F.floor((3 * (n + m) + 6) / 7)
    fits = large | (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (F.least(i, j) + F.least(n - i, m - j) >= overlap)
    order = (F.col("hz") < F.col("z")) | ((F.col("hz") == F.col("z")) & (F.col("ha") < F.col("a")))
    both = hub.join(short, "home").where(order & (F.col("hlabel") != F.col("label")) & (F.col("ha") != F.col("a")) & fits)
    behind = F.floor((3 * F.greatest(n, m) + 3) / 4) - 1
    least = F.when(large, F.lit(1)).otherwise(F.greatest(F.lit(1), overlap - behind))
    both = both.select(F.least("ha", "a").alias("a"), F.greatest("ha", "a").alias("b"), "home", least.alias("least"))
    both = both.groupBy("a", "b", "least").agg(F.count("*").alias("shared"), F.min("home").alias("home"))
    return both.where(F.col("shared") >= F.col("least")).select(
        "a", "b", "home", F.lit(0).alias("x"), F.lit(0).alias("y"))


def outsiders_of_long(lists: DataFrame) -> DataFrame:
    """Regions for lists of more than SHORT_LIST entries.

    Lists with the same largest component are taken together.  Their sets outside it are dealt into blocks, and so are
    all their sets; a region is one block of each.
    """
    long = lists.where(F.col("size") > SHORT_LIST)
    per = long.groupBy("home", "label").agg(F.count("*").alias("c"))
    top = per.groupBy(F.col("home").alias("_home")).agg(F.max(F.struct("c", "label")).getField("label").alias("main"))
    sets = with_list(long, top).select("main", "a", "label").distinct()
    sets = written(sets, "long-lists")
    outside = F.col("label") != F.col("main")
    sizes = sets.groupBy(F.col("main").alias("_main")).agg(
        F.greatest(F.lit(1), F.ceil(F.count_if(outside) / REGION)).cast("int").alias("outs"),
        F.ceil(F.count("*") / REGION).cast("int").alias("alls"))
    sets = sets.join(sizes, sets["main"] == F.col("_main")).drop("_main")

    def block(n: str):
        return F.pmod(F.xxhash64("a"), F.col(n)).cast("int")

    out = sets.where(outside).withColumn("x", block("outs")).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("alls") - 1)))
    every = sets.withColumn("y", block("alls")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("outs") - 1)))
    columns = [F.col("main").alias("home"), "x", "y", "a", "label"]
    return out.select(*columns, F.lit(True).alias("out")).union(every.select(*columns, F.lit(False).alias("out")))


def set_labels(docs: DataFrame, found: DataFrame, sets_of: DataFrame) -> DataFrame:
    """Labels of all sets that are linked with another one."""
    opened = found.where(F.col("kind") == OPEN).select("home", "a", "x", "y", "z")
    pairs = found.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.min(F.struct("home", "x", "y")).alias("r"))
    labels = relabel(None, similar(docs, pairs.select("a", "b", "r.home", "r.x", "r.y"), sets_of))
    lists = labelled(opened, labels)
    if not lists.isEmpty():
        labels = relabel(labels, similar(docs, pairs_of_short(lists), sets_of))
        lists = labelled(opened, labels)
        labels = relabel(labels, written(verify_outsiders(docs, outsiders_of_long(lists), sets_of), "links"))
    return labels


def near_components(docs: DataFrame, cells: int = CELLS, split_class: int = SPLIT_CLASS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    surveyed = written(survey(docs, cells), "survey")
    rows = surveyed.where(F.col("block").isNull()).select("doc_id", "n", "set_id")
    total = rows.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    known = classes(surveyed.where(F.col("block").isNotNull()).select("block", "counts"), cells, total)
    own = docs.where(F.col("doc_id").isNotNull())
    buckets = 1 << max(10, (4 * partitions - 1).bit_length())
    found = written(meet(index_entries(own, spark.sparkContext.broadcast(known), buckets, split_class), partitions), "list-pairs")
    named = rows.where(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull())
    sets_of = written(named.groupBy("set_id").agg(F.min("doc_id").alias("doc_id")), "set-documents")
    labels = written(set_labels(own, found, sets_of), "set-labels")
    lowest = sets_of.join(labels, sets_of["set_id"] == labels["node"], "left").select(
        "set_id", "doc_id", F.coalesce("label", "set_id").alias("label"))
    lowest = written(lowest, "labelled-sets")
    least = written(lowest.groupBy(F.col("label").alias("_label")).agg(F.min("doc_id").alias("component_id")), "components")
    names = written(lowest.join(least, lowest["label"] == least["_label"]).select(F.col("set_id").alias("_set"), "component_id"), "set-components")
    out = rows.join(names, rows["set_id"] == names["_set"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """The first row of each component, whatever ids the rows have."""
    rows = numbered(docs, "near-join-input")
    found = near_components(rows.select(F.col("key").alias("doc_id"), F.col("row").getField("text").alias("text")))
    copies = found.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("key"))
    return without(rows, written(copies, "near-copies"))
