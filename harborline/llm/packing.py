"""Packing of documents into sequences of a fixed number of tokens by best-fit decreasing.

A document longer than a sequence is first cut into full windows, which need no search.  What is left of each document
is dealt into groups of bounded size by hash; in a group the pieces go, longest first, into the open sequence that they
fill most tightly.  That sequence is found in a segment tree over remaining capacity.

Rows: a NULL or empty text is its end token alone; repeated rows are packed each; an empty table gives no rows; ties
are taken by document, start and row; extra columns are not carried.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import in_arrow, written

SEQUENCE = 1024
GROUP_ROWS = 50_000
LONG_RUN = 20_000  # texts with longer unbroken runs go to the slower library, whose merges stay cheap there
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
ROW = "row long"  # which input row a piece is of; ids may repeat or lack
_encoders: dict[str, object] = {}


def encoder(name: str, marker: str = "<|endoftext|>"):
    """A function from a text to its ids with a byte-level vocabulary of the public tokenizers, kept per process.

    The rank file next to the vocabulary holds the same merges and encodes several times faster; tests hold the two
    against each other.
    """
    if name not in _encoders:
        import public_tokenizers
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        special = {marker: whole.token_to_id(marker)}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        run = regex.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")

        def encode(text: str) -> list[int]:
            if len(text) >= LONG_RUN and run.search(text):
                return whole.encode(text, add_special_tokens=False).ids
            return fast.encode(text, allowed_special="all")

        _encoders[name] = encode
    return _encoders[name]


def pieces_of(doc_id, ids: np.ndarray, size: int) -> Iterator[tuple]:
    """The full windows of one document and what is left."""
    for start in range(0, len(ids), size):
        part = ids[start:start + size]
        yield doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)


def tokenized(docs: DataFrame, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """The pieces of all documents with the number of their row: whole texts to ids, the end id after each."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "row")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text, row in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                rows.extend((*piece, row) for piece in pieces_of(doc_id, ids, size))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.monotonically_increasing_id().alias("row"))
    return in_arrow(docs, cut, f"{PIECE}, {ROW}")


class Capacities:
    """Open sequences by remaining capacity, under a segment tree that finds the tightest fit."""

    def __init__(self, size: int):
        self.leaves = 1 << (size + 1 - 1).bit_length()
        self.any = [0] * (2 * self.leaves)  # how many open sequences lie below a node
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        node = self.leaves + capacity
        while node:
            self.any[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Removes and gives (capacity, sequence) of the tightest sequence with room for ``length``."""
        node = self.leaves + length
        while not self.any[node]:  # climb until a subtree to the right has an open sequence
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
            if node & (node - 1) == 0:  # past the last leaf of a level
                return None
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        while node:
            self.any[node] -= 1
            node >>= 1
        return capacity, self.open[capacity].pop()


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; lengths come in decreasing order."""
    tree, used = Capacities(size), 0
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        found = tree.take(length) if length < size else None
        if found is None:
            found, used = (size, used), used + 1
        capacity, sequence[i] = found
        offset[i] = size - capacity
        if capacity > length:
            tree.add(capacity - length, found[1])
    return sequence, offset


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k", end_id: int = 0, size: int = SEQUENCE,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padding of its sequence.

    Pieces are written once; their number gives the number of groups, so that a group stays at some ``group_rows``.
    """
    pieces = written(tokenized(docs, vocabulary, end_id, size), "pieces")
    groups = max(1, -(-pieces.count() // group_rows))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("row", "start"), F.lit(groups)))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "row"], ascending=[False, True, True, True], kind="stable")
        sequence, offset = best_fit(group["length"].to_numpy(), size)
        filled = np.bincount(sequence, group["length"].to_numpy()).astype(np.int64)
        padding = np.where(filled & (filled - 1), size - filled, 0)  # a power of two is left as it is
        return group.drop(columns=["part", "row"]).assign(
            sequence_id=(group["part"].to_numpy() << 32) + sequence, offset=offset, padding=padding[sequence])

    return pieces.groupBy("part").applyInPandas(place, f"{PIECE}, sequence_id long, offset long, padding long")
