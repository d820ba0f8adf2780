"""Benchmark decontamination by template canonicalisation.

Texts are read as words; numbers, names (capitalised inside a sentence) and units (known words after a number) become
typed placeholders whose values are kept apart as slots.  Template windows of WINDOW words are hashed and joined with
those of the benchmark.  Hits of one document and item that lie on one diagonal are consistent when their slots map
one to one: equal values stay equal, different ones different.  A document is contaminated by an item when consistent
hits cover at least ``least_cover`` of the item's words; a re-parameterised question is caught like a verbatim one.

With ``literal``, windows of the lower-cased words themselves are joined beside the templates, and a word counts when
either kind covers it: an unchanged copy, or one in other case, is found however many numbers and names it holds and
whatever stands before it.

With ``least_run``, so many words in a row on one diagonal are enough too, however long the item is.

A line that many items share, such as an instruction, makes no pairs of all documents and all items that hold it: only
items that consist of such lines for the most part, or hold a whole passage of them, are looked up by those.

Rows: NULL and empty texts and items match nothing; template windows with fewer than half of their words literal are
left out.  Items of fewer than SHORTEST words have no template; with ``literal`` they are compared with the signs between
their words, and a single word is no passage.  Repeated documents are found each once per id, those without an id not at
all; ``without_contaminated`` decides by row, whatever the ids, and keeps all columns.  Else extra columns are not
carried; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import bitmap, bitmap_hits, in_arrow, numbered, without, written
from harborline.llm.shingles import chunks, mix, powers, word_hashes

WINDOW, SHORTEST, LEAST_COVER = 8, 4, 0.5
LEAST_RUN = 13  # words in a row that are a passage by themselves
SHORTEST_LITERAL = 2  # a single word is no passage
COMMON = 64  # items that share a window before it is looked up by the pairs of others only
TEMPLATE, LITERAL = 0, 1  # kinds of windows
# Words that are units when a number stands before them.
UNITS = ("kg g mg km m cm mm l ml s ms min h hour hours day days week weeks month months year years minute minutes second "
         "seconds mile miles foot feet inch inches pound pounds ounce ounces ton tons liter liters litre litres meter "
         "meters metre metres gram grams degree degrees percent dollar dollars euro euros cent cents").split()
_U = np.uint64
NUMBER, NAME, UNIT, WORDS = (mix(np.array([i], np.uint64))[0] for i in (101, 102, 103, 104))
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:\n\r"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _folded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes (ASCII and the accented letters of Latin-1), and where a capital begins."""
    capital = (data >= 65) & (data <= 90)
    accented = np.zeros(len(data), bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    capital[:-1] |= accented[1:]
    return np.where(accented, data + np.uint8(32), data), capital


def _bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD[data]
    digit = _DIGIT[data]
    if len(data) > 2:  # 4.0 and 1,000 are one word
        inside[2:-2] |= digit[:-2] & digit[2:] & ((data[1:-1] == 46) | (data[1:-1] == 44))
    start = inside[1:] & ~inside[:-1]
    stop = inside[:-1] & ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    cut = cut[inside[cut] & inside[cut + 1]]
    start[cut] = stop[cut] = True
    return np.flatnonzero(start), np.flatnonzero(stop)


def templates(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: first row, end row, first word of each row, template hash, value hash and slot flag of each word."""
    units = np.sort(np.concatenate([h for h in map(_one_word, UNITS)]))
    for first, end, data, offsets in chunks(texts):
        low, capital = _folded(data)
        digit = _DIGIT[data]
        starts, ends = _bounds(data, offsets)
        rows = np.searchsorted(starts, offsets)
        values = word_hashes(low, starts, ends)
        if not len(starts):
            yield first, end, rows, values, values, np.zeros(0, bool)
            continue
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        opens = np.ones(len(starts), bool)  # words that open a sentence
        opens[1:] = stops[starts[1:]] > stops[ends[:-1]]
        opens[rows[:-1][rows[:-1] < len(starts)]] = True
        number = digit[starts]
        name = capital[starts] & ~opens & ~number
        unit = np.zeros(len(starts), bool)
        place = np.minimum(np.searchsorted(units, values[1:]), len(units) - 1)
        unit[1:] = (units[place] == values[1:]) & number[:-1] & ~number[1:]
        unit[rows[:-1][rows[:-1] < len(starts)]] = False
        shape = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, values)))
        yield first, end, rows, shape, values, number | name | unit


def _one_word(word: str) -> np.ndarray:
    data = np.frombuffer(word.encode(), np.uint8)
    return word_hashes(data, np.array([0]), np.array([len(data)]))


def windows(shape: np.ndarray, slot: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each window that stays in one row and is at least half literal."""
    n = len(shape) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    factors = powers(0xA24BAED4963EE407, size)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled += shape[k:k + n] * factors[k]
    slots = np.concatenate([[0], np.cumsum(slot)])
    row = np.zeros(len(shape), np.int64)
    inner = rows[1:-1]
    np.add.at(row, inner[inner < len(shape)], 1)
    row = np.cumsum(row)
    fine = (row[:n] == row[size - 1:]) & (2 * (slots[size:] - slots[:n]) <= size)
    at = np.flatnonzero(fine)
    return at, mix(rolled[at] + _U(size))


def literal_words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: first row, end row, first word of each row, and of each word the hash of the lower-cased word and the
    hash of the signs between it and the word before it (0 where a row begins)."""
    for (first, end, rows, _, values, _), (_, _, data, offsets) in zip(templates(texts), chunks(texts)):
        starts, ends = _bounds(data, offsets)
        seen = np.concatenate([[0], np.cumsum(~_SPACE[data])])
        between = np.zeros(len(starts), np.uint64)
        between[1:] = word_hashes(data[~_SPACE[data]], seen[ends[:-1]], seen[starts[1:]])
        between[rows[:-1][rows[:-1] < len(starts)]] = 0
        yield first, end, rows, values, between


HIT = "key long, hash long, at int, size int, words int, kind int, slots array<struct<t:int,v:long>>"
_HIT = pa.schema([("key", pa.int64()), ("hash", pa.int64()), ("at", pa.int32()), ("size", pa.int32()), ("words", pa.int32()),
                  ("kind", pa.int32()), ("slots", pa.list_(pa.struct([("t", pa.int32()), ("v", pa.int64())])))])


def windowed(rows: DataFrame, key: str, text: str, sizes: list[int] | None, bits=None, literal: bool = False) -> DataFrame:
    """Windows of all rows: key, hash, at (first word), size, words of the row, kind, slots (place, value).

    ``sizes`` None: one size per row, WINDOW or the row's own words if it has fewer.  ``bits``: a broadcast bitmap of
    the hashes that matter.  ``literal``: also the windows of the lower-cased words, without slots.
    """
    def kinds(texts: pa.Array) -> Iterator[tuple]:
        for first, end, rows_, shape, values, slot in templates(texts):
            yield first, rows_, shape, values, slot, TEMPLATE, None
        if literal:
            for first, end, rows_, values, between in literal_words(pc.utf8_lower(texts)):
                yield first, rows_, values, values, np.zeros(len(values), bool), LITERAL, between

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, rows_, shape, values, slot, kind, between in kinds(batch.column(1)):
                counts = np.diff(rows_)
                parts = []
                for size in sizes or range(SHORTEST_LITERAL, WINDOW + 1):
                    if size < SHORTEST and kind == TEMPLATE:
                        continue
                    at, hashes = windows(shape, slot, rows_, size)
                    if kind == LITERAL:
                        hashes = mix(hashes ^ WORDS)
                        for k in range(1, size if size < SHORTEST else 0):  # so few words count with the signs between them
                            hashes = mix(hashes + between[at + k])
                    row = np.searchsorted(rows_, at, "right") - 1
                    if sizes is None:
                        fine = np.minimum(counts[row], WINDOW) == size
                        at, hashes, row = at[fine], hashes[fine], row[fine]
                    if bits is not None:
                        fine = bitmap_hits(bits.value, hashes)
                        at, hashes, row = at[fine], hashes[fine], row[fine]
                    for a, h, r in zip(at.tolist(), hashes.view(np.int64).tolist(), row.tolist()):
                        places = np.flatnonzero(slot[a:a + size])
                        parts.append({"key": int(keys[first + r]), "hash": h, "at": a - int(rows_[r]), "size": size,
                                      "words": int(counts[r]), "kind": kind, "slots": [
                                          {"t": int(p), "v": int(values[a + p].view(np.int64))} for p in places]})
                    if len(parts) >= 10_000:
                        yield pa.RecordBatch.from_pylist(parts, schema=_HIT)
                        parts = []
                if parts:
                    yield pa.RecordBatch.from_pylist(parts, schema=_HIT)

    rows = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long"), F.col(text).cast("string"))
    return in_arrow(rows, cut, HIT)


def longest_run(ats: Column, size: Column) -> Column:
    """The most words in a row that windows of one size cover, from their sorted first words."""
    start = F.struct(F.lit(0).alias("begin"), F.lit(-1).alias("end"), F.lit(0).alias("longest"))

    def step(acc: Column, at: Column) -> Column:
        begin = F.when(at <= acc.end, acc.begin).otherwise(at)
        return F.struct(begin.alias("begin"), (at + size).alias("end"), F.greatest(acc.longest, at + size - begin).alias("longest"))

    return F.aggregate(ats, start, step, lambda acc: acc.longest)


def stock(known: DataFrame, least_cover: float, least_run: int | None) -> DataFrame:
    """The benchmark's windows, with ``stock`` where they bring no document and item together by themselves.

    Those are windows that more than COMMON items share, such as a line of instructions, in items of which such windows
    cover too little to be a passage: a document that holds a passage of the item then holds another window of it too.
    """
    rows = known.withColumn("window", F.struct("hash", "kind"))
    common = rows.groupBy("window").agg(F.count_distinct("key").alias("items")).where(F.col("items") > COMMON)
    spread = rows.join(common.select("window"), "window", "left_semi")
    ats = spread.groupBy("key", "size", "words").agg(F.array_sort(F.collect_set("at")).alias("ats"))
    run = longest_run(F.col("ats"), F.col("size"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda at: F.sequence(at, at + F.col("size") - 1)))))
    enough = covered >= least_cover * F.col("words")
    if least_run is not None:
        enough = enough | (run >= least_run)
    short = ats.groupBy("key").agg(F.bool_or(enough).alias("enough")).where("NOT enough").select("key")
    marked = spread.select("key", "window").distinct().join(short, "key").withColumn("found", F.lit(True))
    return rows.join(marked, ["key", "window"], "left").withColumn("stock", F.coalesce("found", F.lit(False))).drop("found", "window")


def _aligned(pairs: DataFrame) -> DataFrame:
    """Windows of documents beside the items' windows of the same hash: their diagonal, and the slots of both."""
    return pairs.select("key", "item", "item_words", "size", "kind", "item_at", (F.col("at") - F.col("item_at")).alias("diagonal"),
                        F.transform(F.arrays_zip("slots", "item_slots"), lambda z: F.struct(
                            z.item_slots.v.alias("theirs"), z.slots.v.alias("ours"))).alias("slots"))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text", least_cover: float = LEAST_COVER, literal: bool = False,
                 least_run: int | None = None) -> DataFrame:
    """Per contaminated document and item: doc_id, item_id, covered, item_words, cover, n_slots.

    The bitmap of benchmark hashes that every task gets has a fixed size; the windows that pass it, few unless the
    benchmark is huge, meet the benchmark's in a plain join that Spark may split.  Windows that many items share are
    looked up only for documents and items that another window has brought together (``stock``).
    """
    spark = docs.sparkSession
    known = written(windowed(benchmark, item, item_text, None, literal=literal), "benchmark-windows")
    sizes = sorted(r[0] for r in known.select("size").distinct().collect())  # WINDOW - 1 values at most
    bits = spark.sparkContext.broadcast(bitmap(known, F.col("hash")))
    hits = written(windowed(docs, key, text, sizes or [WINDOW], bits, literal), "document-windows")
    known = written(stock(known, least_cover, least_run).select(
        "hash", "kind", "stock", F.col("key").alias("item"), F.col("at").alias("item_at"), F.col("words").alias("item_words"),
        F.col("slots").alias("item_slots")), "benchmark-stock")
    near = written(_aligned(hits.join(known.where("NOT stock"), ["hash", "kind"])), "window-pairs")
    shared = known.where("stock")
    pairs = near.select("key", "item").join(shared.select("item"), "item", "left_semi").distinct()
    pair = near.union(_aligned(pairs.join(shared, "item").join(hits, ["key", "hash", "kind"])))
    pair = written(pair, "all-window-pairs")
    line = ["key", "item", "diagonal", "kind"]
    values = pair.select(*line, F.explode("slots").alias("s")).groupBy(*line).agg(
        F.count_distinct("s").alias("pairs"), F.count_distinct("s.theirs").alias("theirs"),
        F.count_distinct("s.ours").alias("ours"))
    lines = pair.join(values, line, "left").where(
        F.col("pairs").isNull() | ((F.col("pairs") == F.col("theirs")) & (F.col("pairs") == F.col("ours"))))
    # Both kinds of one diagonal together; an item has windows of one size, so its first words tell what they cover.
    lines = lines.groupBy("key", "item", "item_words", "size", "diagonal").agg(
        F.max(F.coalesce("pairs", F.lit(0))).alias("pairs"), F.array_sort(F.collect_set("item_at")).alias("ats"))
    words = lines.select("key", "item", "item_words", "pairs", longest_run(F.col("ats"), F.col("size")).alias("run"), F.explode(
        F.array_distinct(F.flatten(F.transform("ats", lambda at: F.sequence(at, at + F.col("size") - 1))))).alias("word"))
    cover = words.groupBy("key", "item", "item_words", "word").agg(
        F.max("pairs").alias("pairs"), F.max("run").alias("run")).groupBy("key", "item", "item_words").agg(
        F.count("*").alias("covered"), F.max("pairs").alias("n_slots"), F.max("run").alias("run"))
    cover = cover.withColumn("cover", F.round(F.col("covered") / F.col("item_words"), 6))
    enough = F.col("covered") >= least_cover * F.col("item_words")
    if least_run is not None:
        enough = enough | (F.col("run") >= least_run)
    return cover.where(enough).select(
        F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "covered", F.col("item_words").cast("long"), "cover",
        F.col("n_slots").cast("long"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that no benchmark item contaminates, whatever ids they have."""
    rows = numbered(docs, "decontamination-input")
    texts = rows.select(F.col("key").alias("doc_id"), F.col("row").getField("text").alias("text"))
    found = contaminated(texts, benchmark, literal=True, least_run=LEAST_RUN).select(F.col("doc_id").alias("key")).distinct()
    return without(rows, written(found, "contaminated"))
