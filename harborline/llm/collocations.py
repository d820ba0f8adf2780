"""Phrase collocations by Rabin-Karp fingerprints.

A text is cut into pieces at stops and line ends, and pieces into words.  Prefix polynomials over bytes give every word a
hash, prefix polynomials over word hashes give every run of words one, both for whole batches in numpy.  Per task, equal
fingerprints are counted before the shuffle; what moves is the fingerprint, a second one, the count and a pointer to an
occurrence (the text's key and the byte).  Only phrases that reach ``least`` are read back from the texts through their
pointers.  A fingerprint whose second ones differ, or whose text does not give it again, stands for several phrases:
those are counted again by their own words, so the result is exact.  Longer phrases are looked for only where all shorter
ones inside them are frequent, by a bitmap of fixed size that lets some too many through and loses none.

Rows: a NULL or empty text has no words; a NULL language is ``und``; repeated rows count each; a phrase equal in two
languages is two phrases; ties in the ranking go by phrase in byte order; extra columns are not carried; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import bitmap, bitmap_hits, in_arrow, shuffle_partitions, written
from harborline.llm.shingles import _BACK, _BYTE, _STEP, chunks, mix, powers

_U = np.uint64
CUTS, GAPS = ".,;:!?\n\x0b\x0c\r", " \t"  # what ends a piece; what parts words
LONGEST, LEAST, SHARE_PCT, SCALE, TOP = 3, 10, 50, 1_000_000, 2000
BLOCK = 2_000_000  # occurrences that a task counts at a time
BITS = 1 << 24  # of the bitmap of frequent fingerprints
PARTIAL = "fp long, second long, n long, key long, at long"
_CUT = np.zeros(256, bool)
_CUT[[ord(c) for c in CUTS]] = True
_OUT = _CUT.copy()
_OUT[[ord(c) for c in GAPS]] = True
_WORD_STEP, _SECOND = 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
_WORD_BACK, _SECOND_BACK = pow(_WORD_STEP, -1, 2**64), pow(_SECOND, -1, 2**64)


def language_hash(lang: str) -> np.uint64:
    return _U(int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little"))


class Words:
    """The words of consecutive texts: first and end byte, first word of each text, piece, and prefix polynomials."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~_OUT[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True  # words end where a text ends
        self.start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        self.end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        self.first = np.searchsorted(self.start, offsets)
        piece = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_CUT[data], out=piece[1:])
        self.piece = piece[self.start] + np.repeat(np.arange(len(offsets) - 1), np.diff(self.first)) * (len(data) + 1)
        size = (self.end - self.start).astype(_U)
        self.sums = []  # (prefix polynomial over words, inverse step): one for fingerprints, one for the second ones
        for step, back, word_step, word_back in ((_STEP, _BACK, _WORD_STEP, _WORD_BACK),
                                                 (_WORD_STEP, _WORD_BACK, _SECOND, _SECOND_BACK)):
            over = np.zeros(len(data) + 1, _U)
            np.cumsum(_BYTE[data] * powers(step, len(data)), out=over[1:])
            hashed = mix((over[self.end] - over[self.start]) * powers(back, len(data) + 1)[self.start] + size)
            total = np.zeros(len(hashed) + 1, _U)
            np.cumsum(hashed * powers(word_step, len(hashed)), out=total[1:])
            self.sums.append((total, word_back))

    def at(self, n: int) -> np.ndarray:
        """The words at which a run of n words in one piece starts."""
        last = max(len(self.start) - n + 1, 0)
        return np.flatnonzero(self.piece[:last] == self.piece[n - 1:n - 1 + last]) if n > 1 else np.arange(last)

    def prints(self, at: np.ndarray, n: int, langs: np.ndarray, which: int = 0) -> np.ndarray:
        """Fingerprints of the runs of n words from ``at``; ``langs`` has the hash of each one's language."""
        total, back = self.sums[which]
        return mix((total[at + n] - total[at]) * powers(back, len(total))[at] + langs + _U(n))


def counted(fp: np.ndarray, second: np.ndarray, key: np.ndarray, at: np.ndarray) -> tuple:
    """One entry per (fp, second), with its count and the pointer of one occurrence."""
    order = np.argsort(fp)
    new = np.ones(len(fp), bool)
    new[1:] = fp[order[1:]] != fp[order[:-1]]
    group = np.cumsum(new) - 1
    if (second[order] != second[order[new]][group]).any():  # a fingerprint of several phrases
        order = np.lexsort((second, fp))
        new[1:] = (fp[order[1:]] != fp[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
    first = np.flatnonzero(new)
    some = order[first]
    return fp[some], second[some], np.diff(np.append(first, len(fp))), key[some], at[some]


def as_batch(columns: tuple) -> pa.RecordBatch:
    names = ("fp", "second", "n", "key", "at")
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).view(np.int64)) for c in columns], names=list(names))


def _masked(prints: np.ndarray, bits: int) -> np.ndarray:
    return prints if bits == 64 else prints & _U((1 << bits) - 1)


def partial_counts(keyed: DataFrame, n: int, known: bytes | None, bits: int) -> DataFrame:
    """fp, second, n, key, at: phrases of n words counted per task; n = 1 also counts all words, as the phrase of none.

    ``known``: the bitmap of frequent shorter phrases, both of which a longer one must hold.
    """
    sent = keyed.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            names = batch.column(1).dictionary_encode()
            hashes = np.array([language_hash(x) for x in names.dictionary.to_pylist()], _U)[names.indices.to_numpy()]
            for first, end, data, offsets in chunks(batch.column(2)):
                words = Words(data, offsets)
                row = np.repeat(np.arange(first, end), np.diff(words.first))
                at = words.at(n)
                if known is not None:
                    for shift in (0, 1):
                        shorter = _masked(words.prints(at + shift, n - 1, hashes[row[at]]), bits)
                        at = at[bitmap_hits(sent.value, shorter)]
                lang, begin = hashes[row[at]], words.start[at] - offsets[row[at] - first]
                found = [_masked(words.prints(at, n, lang), bits), words.prints(at, n, lang, 1), keys[row[at]], begin]
                if n == 1:  # every word is also an occurrence of the phrase without words
                    none = _masked(mix(lang), bits)
                    found = [np.concatenate(x) for x in zip(found, (none, mix(~lang), keys[row[at]], begin))]
                held.append(found)
                size += len(found[0])
                if size >= BLOCK:
                    yield as_batch(counted(*map(np.concatenate, zip(*held))))
                    held, size = [], 0
        if size:
            yield as_batch(counted(*map(np.concatenate, zip(*held))))

    return in_arrow(keyed, count, PARTIAL)


def frequent(keyed: DataFrame, least: int, bits: int, longest: int) -> DataFrame:
    """size, fp, f, key, at, mixed (whether second fingerprints differ) of all fingerprints that reach ``least``."""
    known, levels = None, []
    for n in range(1, longest + 1):
        partial = partial_counts(keyed, n, known, bits).repartition(shuffle_partitions(keyed.sparkSession), "fp")
        found = partial.groupBy("fp").agg(
            F.sum("n").alias("f"), F.min("second").alias("low"), F.max("second").alias("high"),
            F.min_by("at", "key").alias("at"), F.min("key").alias("key"))
        found = found.where(F.col("f") >= least).select(
            F.lit(n).alias("size"), "fp", "f", "key", "at", (F.col("low") != F.col("high")).alias("mixed"))
        levels.append(written(found, f"phrases-{n}"))
        if n < longest:
            known = bitmap(levels[-1].select("fp"), F.col("fp"), BITS)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def read_back(keyed: DataFrame, pointers: DataFrame, bits: int) -> DataFrame:
    """size, fp, lang, phrase: the words at each pointer (size, fp, key, at), where they give the fingerprint again.

    Only texts that hold a pointer move, one of equal ones.
    """
    spark = keyed.sparkSession
    wanted = pointers.groupBy("key").agg(F.collect_list(F.struct("size", "fp", "at")).alias("found"))
    holds = bitmap(wanted, F.col("key"))
    sent = spark.sparkContext.broadcast(holds)

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bitmap_hits(sent.value, batch.column(0).to_numpy().view(_U))))

    texts = in_arrow(keyed, holders, "key long, lang string, text string").distinct()
    joined = texts.join(wanted, "key").select("lang", "text", "found")
    schema = "size int, fp long, lang string, phrase string"
    arrow = pa.schema([("size", pa.int32()), ("fp", pa.int64()), ("lang", pa.string()), ("phrase", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(text.encode(), np.uint8)
                lower = data.tobytes().translate(_LOWER)
                words, hashed = Words(data, np.array([0, len(data)])), language_hash(lang)
                for item in found:
                    i, n = int(np.searchsorted(words.start, item["at"])), item["size"]
                    if i + n <= len(words.start) and words.start[i] == item["at"] and words.piece[i] == words.piece[i + n - 1]:
                        again = _masked(words.prints(np.array([i]), n, np.array([hashed])), bits)
                        if again.view(np.int64)[0] == item["fp"]:
                            phrase = b" ".join(lower[words.start[j]:words.end[j]] for j in range(i, i + n)).decode()
                            rows.append((n, item["fp"], lang, phrase))
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r)) for r in rows], schema=arrow)

    return in_arrow(joined, read, schema).distinct()


def recounted(keyed: DataFrame, mixed: DataFrame, least: int, bits: int, longest: int) -> DataFrame:
    """size, fp, lang, phrase, f: occurrences of the fingerprints (size, fp) counted by their own words."""
    sent = keyed.sparkSession.sparkContext.broadcast(bitmap(mixed, F.col("fp")))
    schema = "size int, fp long, lang string, phrase string, n long"
    arrow = pa.schema([("size", pa.int32()), ("fp", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple, int] = {}
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = np.frombuffer((text or "").encode(), np.uint8)
                lower = data.tobytes().translate(_LOWER)
                words, hashed = Words(data, np.array([0, len(data)])), language_hash(lang)
                if len(words.start):
                    none = _masked(np.array([mix(np.array([hashed]))[0]]), bits)
                    if bitmap_hits(sent.value, none)[0]:
                        key = (0, int(none.view(np.int64)[0]), lang, "")
                        rows[key] = rows.get(key, 0) + len(words.start)
                for n in range(1, longest + 1):
                    at = words.at(n)
                    prints = _masked(words.prints(at, n, np.full(len(at), hashed, _U)), bits)
                    hit = bitmap_hits(sent.value, prints)
                    for i, fp in zip(at[hit].tolist(), prints[hit].view(np.int64).tolist()):
                        phrase = b" ".join(lower[words.start[j]:words.end[j]] for j in range(i, i + n)).decode()
                        rows[n, fp, lang, phrase] = rows.get((n, fp, lang, phrase), 0) + 1
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, (*k, v))) for k, v in rows.items()], schema=arrow)

    found = in_arrow(keyed, read, schema).groupBy("size", "fp", "lang", "phrase").agg(F.sum("n").alias("f"))
    # The phrase without words is counted beside the single ones.
    return found.join(mixed, (found["fp"] == mixed["fp"]) & (F.greatest(found["size"], F.lit(1)) == mixed["size"]), "left_semi").where(
        F.col("f") >= least)


def parts_of(phrases: DataFrame, bits: int) -> DataFrame:
    """The phrases with ``cuts``: the fingerprints of the first part and of the rest per place of cutting, and ``every``:
    the fingerprint that all words of the language share."""
    names = phrases.columns
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in phrases.schema.fields)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            langs = np.array([language_hash(x) for x in langs.dictionary.to_pylist()], _U)[langs.indices.to_numpy()]
            for first, end, data, offsets in chunks(batch.column("phrase")):
                words, hashes = Words(data, offsets), langs[first:end]
                start, n = words.first[:-1], np.diff(words.first)
                cuts = [[] for _ in range(end - first)]
                for k in range(1, int(n.max(initial=1))):
                    row = np.flatnonzero(n > k)
                    left = _masked(words.prints(start[row], k, hashes[row]), bits).view(np.int64)
                    right = np.zeros(len(row), np.int64)
                    for rest in range(1, int(n.max()) - k + 1):
                        some = n[row] == k + rest
                        right[some] = _masked(words.prints(start[row[some]] + k, rest, hashes[row[some]]), bits).view(np.int64)
                    for i, a, b in zip(row.tolist(), left.tolist(), right.tolist()):
                        cuts[i].append({"k": k, "left_fp": a, "right_fp": b})
                every = _masked(mix(hashes), bits).view(np.int64)
                columns = [*batch.slice(first, end - first).columns, pa.array(cuts, _CUTS), pa.array(every)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "cuts", "every"])

    return in_arrow(phrases, split, f"{kept}, cuts array<struct<k:int,left_fp:long,right_fp:long>>, every long")


_CUTS = pa.list_(pa.struct([("k", pa.int32()), ("left_fp", pa.int64()), ("right_fp", pa.int64())]))


def _looked_up(rows: DataFrame, counts: DataFrame, sizes: Column, fp: str, phrase: Column, name: str) -> DataFrame:
    """``rows`` with the count of a fingerprint; one that stands for several phrases is looked up with its words."""
    side = counts.select(F.col("size").alias("_size"), F.col("fp").alias("_fp"), F.col("f").alias(name),
                         F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"))
    same = (F.col(fp) == F.col("_fp")) & (sizes == F.col("_size"))
    same = same & (F.col("_phrase").isNull() | ((F.col("_phrase") == phrase) & (F.col("_lang") == F.col("lang"))))
    return rows.join(side, same).drop("_size", "_fp", "_lang", "_phrase")


def exact(c: str) -> Column:
    return F.col(c).cast("decimal(15,0)")


def not_below_top(scored: DataFrame, top: int) -> DataFrame:
    """The rows that may be among the first ``top`` of their language.

    A language's scores are counted in a thousand steps; rows of the steps below the one that holds the row of rank
    ``top`` go before anything is sorted.  Of the others each part of a language keeps its first ``top``.
    """
    at = F.floor(F.col("score") / (SCALE // 1000)).cast("int")
    held = scored.groupBy("lang", at.alias("at")).count()
    above = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1))
    lowest = held.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < top)
    lowest = lowest.groupBy(F.col("lang").alias("_lang")).agg(F.min("at").alias("_least"))
    lowest = written(lowest, "phrases-least")  # read from a table, so that its size is known before the rows move
    kept = scored.join(lowest, (F.col("lang") == F.col("_lang")) & (at >= F.col("_least"))).drop("_lang", "_least")
    parts = shuffle_partitions(scored.sparkSession)
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    order = Window.partitionBy("lang", "part").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).drop("part", "rank")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int | None = TOP,
         bits: int = 64, longest: int = LONGEST) -> DataFrame:
    """Per language the phrases by score: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``longest`` words that occurs ``a`` >= ``least`` times scores floor(10**6 a a / (l r)) at the cut
    where that is least; one inside a longer candidate with at least half its count is left out.  ``bits``: how many of
    the fingerprints' bits are kept; fewer give more phrases per fingerprint and the same result.
    """
    keyed = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text}`").cast("string").alias("text")).where("text <> ''")
    keyed = keyed.select(F.xxhash64("lang", "text").alias("key"), "lang", "text")
    found = frequent(keyed, least, bits, longest)
    nothing = F.lit(None).cast("string")
    # The phrase without words has the size of single words in the first table; its fingerprint tells it apart.
    counts = found.where("NOT mixed").select("size", "fp", "f", nothing.alias("lang"), nothing.alias("phrase"))
    mixed = written(found.where("mixed").select("size", "fp"), "phrases-mixed")
    phrases = read_back(keyed, found.where("NOT mixed AND size > 1").select("size", "fp", "key", "at"), bits)
    phrases = phrases.join(found.select("size", "fp", "f"), ["size", "fp"])
    if not mixed.isEmpty():
        again = written(recounted(keyed, mixed, least, bits, longest), "phrases-again")
        counts = counts.unionByName(again.select(F.greatest("size", F.lit(1)).alias("size"), "fp", "f", "lang", "phrase"))
        phrases = phrases.unionByName(again.where("size > 1").select(*phrases.columns))
    phrases = written(parts_of(phrases.select("size", "fp", "lang", "phrase", "f"), bits), "phrases")
    counts = written(counts, "phrase-counts")
    cut = phrases.select("lang", "phrase", "every", "size", F.col("f").alias("a"), F.explode("cuts").alias("c")).select("*", "c.*").drop("c")
    split, k = F.split("phrase", " "), F.col("k")
    cut = _looked_up(cut, counts, k, "left_fp", F.array_join(F.slice(split, F.lit(1), k), " "), "l")
    cut = _looked_up(cut, counts, F.col("size") - k, "right_fp", F.array_join(F.slice(split, k + 1, F.size(split)), " "), "r")
    score = (F.lit(SCALE).cast("decimal(7,0)") * (exact("a") * exact("a")))
    cut = cut.withColumns({"above": score, "below": exact("l") * exact("r")}).withColumn("score", F.expr("above div below"))
    best = cut.groupBy("lang", "phrase", "every").agg(
        F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("b")).select("lang", "phrase", "every", "a", "b.*")
    inner = phrases.where("size > 2").select("lang", F.col("f").alias("longer"), F.col("phrase").alias("whole"))
    words = F.split("whole", " ")
    inside = F.array(*[F.array_join(F.slice(words, i + 1, n), " ") for n in range(2, longest) for i in range(longest - n + 1)])
    sizes = F.filter(F.array_distinct(inside), lambda p: (p != F.col("whole")))
    inner = inner.select("lang", F.explode(sizes).alias("phrase"), "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    best = best.join(inner, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("longer") < SHARE_PCT * F.col("a"), F.lit(True)))
    best = written(best, "phrases-scored")
    if top:
        best = not_below_top(best, top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))))
    best = written(best.where(F.col("rank") <= top) if top else best, "phrases-ranked")
    best = _looked_up(best, counts, F.lit(1), "every", F.lit(""), "n")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
