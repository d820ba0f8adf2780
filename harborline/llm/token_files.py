"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits, the lowest first.  A level holds one chunk of each id that reaches it, a bitmap
that says which ids go on, and a rank directory: how many go on before each block of 512.  The place of an id in the next
level is its rank among those that go on, so any token, and any run of tokens, is read where it lies.

A store is a folder with two Parquet tables.  ``segments``: consecutive documents of one range of the order by document
id, some SEGMENT ids each, with the code, the document ids and where each document ends.  ``directory``: the first id of
each range.  Both go through Spark's writer, so a lost executor leaves no half-written segment.

Rows: a NULL or empty text is its end id alone; NULL ids come first; repeated ids are stored each, in an order that
depends on their texts; a document never spans segments; extra columns are not carried; an empty table gives an empty
store.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.llm.common import in_arrow, shuffle_partitions

SEGMENT = 1 << 18  # ids after which a segment is closed
BLOCK = 512  # bits between two entries of a rank directory
CACHED, LONGEST_CACHED = 600_000, 64
MAGIC = b"DAC8"
_encoders: dict[str, Callable] = {}


def encoder(name: str) -> Callable[[pa.Array], list[bytes]]:
    """A function from texts to their ids (unsigned 32-bit, as bytes) with a public tokenizer; kept per process.

    White space is dropped and letters are lower-cased by the vocabulary's own rules, and symbols after a letter or
    digit are tokens apart.  So texts are encoded word by word, in lower case, and each word only once while it is remembered;
    new words of letters alone are one stretch of tokens each and go to the library many at a time.  Tests hold this
    against encoding texts whole.
    """
    if name not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has given the cores out already
        import public_tokenizers
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        suffix = whole.model.end_of_word_suffix
        closes = np.zeros(whole.get_vocab_size(), bool)  # the tokens that end a stretch
        closes[[i for token, i in whole.get_vocab().items() if token.endswith(suffix)]] = True
        symbols = bytes(b for b in range(128) if not chr(b).isalnum() and not chr(b).isspace())
        known: dict[bytes, bytes] = {b"": b""}

        def learn(words: list[bytes]) -> None:
            for word, found in zip(words, whole.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)):
                known[word] = array("I", found.ids).tobytes()

        def learn_letters(words: list[bytes]) -> None:
            lots = [b" ".join(words[at:at + 64]).decode() for at in range(0, len(words), 64)]
            found = [array("I", e.ids) for e in whole.encode_batch_fast(lots, add_special_tokens=False)]
            ids = np.concatenate([np.frombuffer(f, np.uint32) for f in found])
            ends = np.flatnonzero(closes[ids]) + 1
            if len(ends) != len(words):  # a letter that falls apart in lower case
                return learn(words)
            data, at = ids.tobytes(), 0
            for word, end in zip(words, (4 * ends).tolist()):
                known[word] = data[at:end]
                at = end

        def learn_all(new: set[bytes]) -> None:
            stems = {}
            for word in new:
                if word.isalpha() or b"<|" in word:
                    continue
                stem = word.rstrip(symbols)
                if stem and stem != word and (stem[-1:].isalnum() or not stem.isascii() and stem.decode()[-1].isalpha()):
                    stems[word] = stem, word[len(stem):]
            single = {word for word in new if word not in stems}
            single.update(part for both in stems.values() for part in both if part not in known)
            letters = {word for word in single if word.isalpha() or not word.isascii() and word.decode().isalpha()}
            if letters:
                learn_letters(list(letters))
            learn(list(single - letters))
            for word, (stem, stops) in stems.items():
                known[word] = known[stem] + known[stops]

        def encode(texts: pa.Array) -> list[bytes]:
            texts = texts.fill_null("")
            as_it_is = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, "[\u0300-\u036f]"))
            texts = pc.if_else(as_it_is, texts, pc.ascii_lower(texts))
            words = pc.ascii_split_whitespace(texts)
            flat = words.flatten().dictionary_encode()
            distinct = flat.dictionary.cast(pa.binary()).to_pylist()
            if len(known) > CACHED:
                known.clear()
                known[b""] = b""
            learn_all({word for word in distinct if word not in known})
            ids = pa.array([known[word] for word in distinct], pa.large_binary()).take(flat.indices)
            for word in distinct:
                if len(word) > LONGEST_CACHED:
                    known.pop(word, None)
            if not len(ids):
                return [b""] * len(texts)
            ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:][words.offsets.to_numpy() - words.offsets[0].as_py()]
            data = memoryview(ids.buffers()[2] or b"")
            return [bytes(data[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

        _encoders[name] = encode
    return _encoders[name]


def pack(ids: np.ndarray) -> bytes:
    """The code of an array of unsigned 32-bit ids."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)])
        held = np.bitwise_count(bits.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(held)]).astype("<u4")
        levels.append((len(rest), rest.astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()))
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    head = MAGIC + np.array([len(levels), *[level[0] for level in levels]], "<u4").tobytes()
    return head + b"".join(part for level in levels for part in level[1:])


class Code:
    """Reads tokens out of a code without decoding what lies around them."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a code of this format")
        count = int.from_bytes(blob[4:8], "little")
        sizes = np.frombuffer(blob, "<u4", count, 8).tolist()
        at, self.levels = 8 + 4 * count, []
        for n in sizes:
            blocks = -(-(-(-n // 8)) // (BLOCK // 8))
            chunks = np.frombuffer(blob, np.uint8, n, at)
            bits = np.frombuffer(blob, np.uint8, blocks * BLOCK // 8, at + n)
            at += n + len(bits)
            self.levels.append((chunks, bits, np.frombuffer(blob, "<u4", blocks + 1, at)))
            at += 4 * (blocks + 1)
        self.n = sizes[0]

    def rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """How many ids go on before each place of a level: an entry of the directory and the bits of one block."""
        _, bits, ranks = self.levels[level]
        block = at // BLOCK
        words = np.append(bits, np.zeros(BLOCK // 8, np.uint8)).view(np.uint64)
        words = words[block[:, None] * (BLOCK // 64) + np.arange(BLOCK // 64)]
        left = np.clip((at % BLOCK)[:, None] - np.arange(BLOCK // 64) * 64, 0, 64).astype(np.uint64)
        full = left == 64
        mask = np.where(full, ~np.uint64(0), (np.uint64(1) << np.where(full, np.uint64(0), left)) - np.uint64(1))
        return ranks[block] + np.bitwise_count(words & mask).sum(axis=1, dtype=np.int64)

    def tokens(self, at: np.ndarray) -> np.ndarray:
        """The ids at any places, in any order."""
        at = np.asarray(at, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("place outside the code")
        out, where = np.zeros(len(at), np.uint32), np.arange(len(at))
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[where] |= chunks[at].astype(np.uint32) << np.uint32(8 * level)
            more = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            if not more.any():
                break
            where, at = where[more], self.rank(level, at[more])
        return out

    def run(self, start: int, end: int) -> np.ndarray:
        """The ids from start to end: in every level they lie side by side, between the ranks of both."""
        if not 0 <= start <= end <= self.n:
            raise IndexError("run outside the code")
        out, where, a, b = np.zeros(end - start, np.uint32), slice(None), start, end
        for level, (chunks, bits, _) in enumerate(self.levels):
            part = chunks[a:b].astype(np.uint32) << np.uint32(8 * level)
            if level == 0:
                out |= part
            else:
                out[where] |= part
            more = np.unpackbits(bits[a >> 3:(b + 7) >> 3], bitorder="little")[a & 7:(a & 7) + b - a] == 1
            if not more.any():
                break
            where = np.flatnonzero(more) if level == 0 else where[more]
            a = int(self.rank(level, np.array([a]))[0])
            b = a + len(where)
        return out


SEGMENT_SCHEMA = "range int, seq int, first long, n_ids long, doc_ids array<long>, ends binary, code binary"
_ARROW = pa.schema([("range", pa.int32()), ("seq", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("ends", pa.binary()), ("code", pa.binary())])


def segments(ordered: DataFrame, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """Segments of some ``size`` ids of rows (range, doc_id, text) that come sorted; ``first``: ids of the range before."""
    closing = np.array([end_id], "<u4").tobytes()

    def close(held: list[tuple], at: int, seq: int, first: int) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(h[1] for h in held), "<u4")
        ends = np.cumsum([len(h[1]) // 4 for h in held]).astype("<i8").tobytes()
        return pa.RecordBatch.from_pylist([{"range": at, "seq": seq, "first": first, "n_ids": len(ids), "ends": ends,
                                            "doc_ids": [h[0] for h in held], "code": pack(ids)}], schema=_ARROW)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(vocabulary)
        held, now, seq, first, n = [], None, 0, 0, 0
        for batch in batches:
            for some in (batch.slice(at, 4096) for at in range(0, batch.num_rows, 4096)):
                found = ids_of(some.column("text"))
                for at, doc_id, ids in zip(some.column("range").to_pylist(), some.column("doc_id").to_pylist(), found):
                    if held and (at != now or n + len(ids) // 4 >= size):
                        yield close(held, now, seq, first)
                        held, seq, first, n = [], seq + 1, first + n, 0
                    if at != now:
                        now, seq, first = at, 0, 0
                    held.append((doc_id, ids + closing))
                    n += len(ids) // 4 + 1
        if held:
            yield close(held, now, seq, first)

    return in_arrow(ordered.select("range", "doc_id", "text"), cut, SEGMENT_SCHEMA)


def write(docs: DataFrame, path: str, vocabulary: str = "word_bpe_49k", end_id: int = 1, size: int = SEGMENT,
          ranges: int | None = None) -> None:
    """Encodes all documents and writes them as a store, in ascending order of their ids.

    Texts move once, to ``ranges`` ranges (as many as shuffle partitions) of the order by id, text and place in the
    input, so that neither a repeated id nor a repeated row is tied to one task.  The directory has one row per range.
    """
    spark = docs.sparkSession
    order = ["doc_id", "tie", "place"]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(ranges or shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    rows = rows.withColumn("range", F.spark_partition_id())
    segments(rows, vocabulary, end_id, size).write.parquet(f"{path}/segments")
    totals = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{path}/segments").groupBy("range").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("range", F.coalesce(before, F.lit(0)).alias("start")).write.parquet(f"{path}/directory")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a store with ``start``: the ids of all documents before."""
    directory = spark.read.schema("range int, start long").parquet(f"{path}/directory")
    parts = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{path}/segments").join(directory, "range")
    return parts.withColumn("start", F.col("start") + F.col("first")).drop("first")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: doc_id, start, n_tokens and ids, each read by its own run of the code."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                code, ends = Code(row["code"]), np.frombuffer(row["ends"], "<i8")
                starts = np.concatenate([[0], ends[:-1]])
                runs = [code.run(a, b).astype("<u4").tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"]), pa.array(ends - starts),
                     pa.array(runs, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return in_arrow(stored(spark, path).select("start", "doc_ids", "ends", "code"), read,
                    "doc_id long, start long, n_tokens long, ids binary")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: doc_id, start, n_tokens and the crc32 of its ids as read back."""
    return documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def tokens_at(positions: DataFrame, path: str, name: str = "position") -> DataFrame:
    """position, token of every distinct position of the store that a row names; others give no row.

    Positions find their segment by equal keys, gather by segment in lots of bounded size, and each is then read out of
    the code by itself.
    """
    spark = positions.sparkSession
    parts = stored(spark, path)
    lots = F.explode(F.sequence(F.shiftright("start", 16), F.shiftright(F.col("start") + F.col("n_ids") - 1, 16)))
    where = parts.select("range", "seq", "start", (F.col("start") + F.col("n_ids")).alias("stop"), lots.alias("lot"))
    wanted = positions.select(F.col(name).cast("long").alias("at")).distinct().withColumn("lot", F.shiftright("at", 16))
    wanted = wanted.join(where, "lot").where((F.col("at") >= F.col("start")) & (F.col("at") < F.col("stop")))
    wanted = wanted.groupBy("range", "seq", "lot").agg(F.collect_list("at").alias("places"))
    wanted = parts.join(wanted, ["range", "seq"]).select("start", "code", "places")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = np.array(row["places"], np.int64)
                found = Code(row["code"]).tokens(places - row["start"]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(found)], names=["position", "token"])

    return in_arrow(wanted, read, "position long, token long")
