"""Packing, decontamination and the trained classifiers against brute force, round trips and held-out rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harborline.llm import decontaminate, language_id, near_join, packing, quality_model, toxicity
from harborline.llm.common import bitmap, bitmap_hits, numbered, sampled, without, written
from harborline.llm.queries import fold

DOCS = "doc_id long, text string"
ODD = [None, "", " ", "\n", "a", "<|endoftext|>", "x <|endoftext|> y", "é" * 3000, "word " * 3000, "😀 ß \x00 \x1c", "1" * 2500, "  \t\n " * 900]


# ---- packing


def reference_encoder():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=120, deadline=None)
@given(st.text(max_size=60))
def test_fast_ids_are_the_vocabulary_files(text):
    whole = reference_encoder() if not hasattr(reference_encoder, "kept") else reference_encoder.kept
    reference_encoder.kept = whole
    assert packing.encoder("byte_bpe_50k")(text) == whole.encode(text, add_special_tokens=False).ids


def test_long_runs_encode(monkeypatch):
    monkeypatch.setattr(packing, "_encoders", {})
    whole, encode = reference_encoder(), packing.encoder("byte_bpe_50k")
    for text in ["a" * 30_000, " " * 25_000 + "x", "ab " * 9000, "é" * 21_000]:
        assert encode(text) == whole.encode(text, add_special_tokens=False).ids


def check_packing(rows, docs, size):
    whole = reference_encoder()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == {d for d, _ in docs}
    for doc_id, text in docs:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size and {r.padding for r in pieces} == {0 if at & (at - 1) == 0 else size - at}
    return by_sequence


def test_every_id_lies_in_one_place(spark):
    docs = list(enumerate(ODD + ["some words of text " * n for n in range(1, 300, 7)]))
    frame = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS part", "2 AS start")
    sequences = check_packing(packing.pack(frame).collect(), docs, packing.SEQUENCE)
    total = sum(r.length for s in sequences.values() for r in s)
    assert len(sequences) <= total / packing.SEQUENCE * 1.1 + 1
    check_packing(packing.pack(frame, group_rows=10).collect(), docs, packing.SEQUENCE)


def test_packing_of_empty_and_repeated_rows(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0
    rows = packing.pack(spark.createDataFrame([(1, "same words"), (1, "same words"), (None, "no id")], DOCS)).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 16), min_size=1, max_size=60))
def test_best_fit_takes_the_tightest_open_sequence(lengths):
    lengths = sorted(lengths, reverse=True)
    sequence, offset = packing.best_fit(np.array(lengths), 16)
    left = []
    for length, s, o in zip(lengths, sequence.tolist(), offset.tolist()):
        fits = [c for c in left if c >= length]
        if s == len(left):
            assert not fits or length == 16
            left.append(16)
        assert left[s] == (min(fits) if fits and s < len(left) and length < 16 else 16) and o == 16 - left[s]
        left[s] -= length


# ---- decontamination


ITEMS = [(1, "If Anna buys 3 apples and 4 pears for 12 dollars, how many apples does Anna own after eating one of the fruits?"),
         (2, "The quick brown fox jumps over the lazy dog near the old river bank every single morning of the year."),
         (3, "Short one here now"), (4, None), (5, ""), (6, "too few")]


def flagged(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).selectExpr("*", "1 AS item", "2 AS hash")
    return {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()}


def test_verbatim_and_reparameterised_questions_are_found(spark):
    fill = "some other words go here and there without any meaning at all. "
    texts = [
        fill + ITEMS[0][1] + " " + fill,
        fill + ITEMS[1][1].upper().capitalize() + " " + fill,
        fill * 3,
        "so If Maria buys 7 apples and 9 pears for 31 dollars, how many apples does Maria own after eating one of the fruits? yes",
        "so If Maria buys 7 apples and 9 pears for 31 dollars, how many apples does Peter own after eating one of the fruits? yes",
        "if anna buys no fruit", None, "", "well. Short one here now! and more",
        ITEMS[1][1] + " " + ITEMS[1][1], "The quick brown fox jumps over the lazy dog near the new house",
    ]
    got = flagged(spark, texts)
    assert {(0, 1), (1, 2), (3, 1), (8, 3), (9, 2)} <= got
    assert not {(2, 1), (2, 2), (4, 1), (5, 1), (6, 4), (7, 5)} & got


WORD = re.compile(r"(?:[A-Za-z0-9]|[^\x00-\x7f]|(?<=[0-9])[.,](?=[0-9]))+")


def brute_template(text):
    """(shape, value, is slot) of every word, one by one."""
    out, end = [], None
    for m in WORD.finditer(text or ""):
        word = "".join(c.lower() if c.isascii() or "\xc0" <= c <= "\xde" and c != "\xd7" else c for c in m.group())
        opens = end is None or any(c in ".!?:\n\r" for c in text[end:m.start()])
        number = m.group()[0] in "0123456789"
        capital = m.group()[0] != word[0]
        unit = bool(out) and out[-1][0] == "<number>" and not number and word in decontaminate.UNITS
        shape = "<number>" if number else "<unit>" if unit else "<name>" if capital and not opens else word
        out.append((shape, word, shape[0] == "<"))
        end = m.end()
    return out


def brute_contaminated(docs, items):
    found = set()
    for item, item_text in items:
        theirs = brute_template(item_text)
        size = min(decontaminate.WINDOW, len(theirs))
        if size < decontaminate.SHORTEST:
            continue
        windows = {}
        for q in range(len(theirs) - size + 1):
            if 2 * sum(w[2] for w in theirs[q:q + size]) <= size:
                windows.setdefault(tuple(w[0] for w in theirs[q:q + size]), []).append(q)
        for doc, text in docs:
            ours, lines = brute_template(text), {}
            for p in range(len(ours) - size + 1):
                for q in windows.get(tuple(w[0] for w in ours[p:p + size]), []):
                    lines.setdefault(p - q, set()).update(range(q, q + size))
            covered, slots = set(), 0
            for shift, words in lines.items():
                pairs = {(theirs[w][1], ours[w + shift][1]) for w in words if theirs[w][2]}
                if len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}):
                    covered |= words
                    slots = max(slots, len(pairs))
            if covered and len(covered) >= decontaminate.LEAST_COVER * len(theirs):
                found.add((doc, item, len(covered), len(theirs), slots))
    return found


@pytest.mark.parametrize("common", [decontaminate.COMMON, 1])
def test_decontamination_against_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(decontaminate, "COMMON", common)
    rng = random.Random(3)
    parts = ["Anna", "Bob", "Öl", "ÉCOLE", "12", "3.5", "1,000", "kg", "hours", "apples", "the", "of", "a", "b", "c", "x7", "É", "straße", "."]
    items = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(2, 26)))) for i in range(12)] + ITEMS
    docs = [(i, t) for i, t in enumerate(ODD)]
    for i in range(100, 260):
        words = [rng.choice(parts) for _ in range(rng.randrange(0, 20))] + (rng.choice(items)[1] or "").split()
        for _ in range(rng.randrange(0, 4)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(parts)
        docs.append((i, rng.choice([" ", "\n", ". "]).join(words)))
    got = decontaminate.contaminated(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    rows = {(r.doc_id, r.item_id, r.covered, r.item_words, r.n_slots) for r in got.collect()}
    want = brute_contaminated(docs, items)
    assert rows == want and len(want) > 30 and any(w[4] for w in want)


def test_copies_are_found_in_any_case_and_slot_density(spark):
    items = [(1, "Which river runs through Paris today"), (2, "12 + 7 = 19"), (3, "12 + 7 - 3 * 4 / 2 = 13, 9 - 4 = 5 and 8 * 8 = 64"),
             (4, "Anna Bob Carla David Emil Frida Gustav Helga Ida Jonas Karl Lena"), (5, ITEMS[0][1]), (6, "paris"),
             (7, "Ёлка стоит в лесу под Москвой у Волги")]
    fill = "some other words go here, "
    texts = [fill + change(text) + " and more of it" for _, text in items for change in (str, str.upper, str.lower)]
    texts += [fill + "(1) " + text for _, text in items] + [fill + '7, "' + text for _, text in items] + ["12 7 19 is no sum, nor 12 - 7 = 19"]
    got = decontaminate.contaminated(spark.createDataFrame(list(enumerate(texts)), DOCS),
                                     spark.createDataFrame(items, "item_id long, text string"), literal=True)
    found = {(r.doc_id, r.item_id): r.cover for r in got.collect()}
    held = [i for i, _ in items for _ in range(3)] + 2 * [i for i, _ in items]
    assert {(d, i) for d, i in enumerate(held) if i != 6} == set(found) and set(found.values()) == {1.0}
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    left = decontaminate.without_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in left.collect()} == {d for d, i in enumerate(held) if i == 6} | {len(held)}


def test_a_long_run_of_a_longer_item_is_enough(spark):
    item = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(250)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    texts = ["before " + " ".join(item[100:200]) + " after", "before " + " ".join(item[237:]), "before " + " ".join(item[20:32]) + " after",
             "x ".join(" ".join(item[i:i + 8]) + " " for i in range(0, 40, 10))]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = decontaminate.contaminated(docs, items, literal=True, least_run=decontaminate.LEAST_RUN)
    assert {(r.doc_id, r.covered) for r in got.collect()} == {(0, 100), (1, 13)}
    assert {r.doc_id for r in decontaminate.without_contaminated(docs, items).collect()} == {2, 3}


def test_a_line_of_many_items_makes_no_pairs_by_itself(spark, monkeypatch):
    rng, line = random.Random(9), "please answer the next question with one short word only"
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    items = [(i, line + " " + " ".join(word() for _ in range(30))) for i in range(200)]
    items += [(1000 + i, line + " " + word()) for i in range(100)] + [(1, items[1][1].replace("only", "only " + word()))]  # mostly the line; an id twice
    docs = [(i, word() + " " + line + " " + word()) for i in range(150)] + [(200 + i, items[i][1]) for i in range(5)]
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    counts = {}

    def counted(df, label):
        out = written(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(decontaminate, "written", counted)
    results, pairs = [], []
    for common in (decontaminate.COMMON, 10**9):  # the second one looks up everything
        monkeypatch.setattr(decontaminate, "COMMON", common)
        found = decontaminate.contaminated(*frames, literal=True, least_run=decontaminate.LEAST_RUN)
        results.append(sorted(map(tuple, found.collect())))
        pairs.append(counts["all-window-pairs"])
    assert results[0] == results[1] and len(results[0]) == 155 * 100 + 6  # all hold most of the last hundred; five copies, one of both items 1
    of_line = 2 * 3  # windows of the line, of both kinds
    assert pairs[1] - pairs[0] >= of_line * 149 * 200  # none of these for the first two hundred


def test_slots_must_map_one_to_one(spark):
    items = [(1, "Mix 5 kg of flour with 5 kg of sugar and 2 litres of water before baking for 40 minutes")]
    docs = [(1, "Mix 8 kg of flour with 8 kg of sugar and 3 litres of water before baking for 50 minutes"),
            (2, "Mix 8 kg of flour with 9 kg of sugar and 3 litres of water before baking for 50 minutes"),
            (3, "Mix 2 kg of flour with 2 kg of sugar and 2 litres of water before baking for 2 minutes")]
    got = decontaminate.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in got.collect()} == {1}


def test_decontamination_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, ITEMS[1][1])], DOCS), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0 and decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.without_contaminated(docs, items.limit(0)).count() == 1
    more = spark.createDataFrame([(1, ITEMS[1][1]), (None, ITEMS[1][1]), (2, "clean")], DOCS).selectExpr("*", "3 AS _gone")
    left = decontaminate.without_contaminated(more, items)
    assert {r.doc_id for r in left.collect()} == {2} and left.columns == more.columns


def test_planted_passages_of_the_test_tables(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    verbatim = {(d, i.item_id) for i in items.collect() for d, t in texts.items() if i.text in t}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert verbatim and verbatim <= got
    key = {r.item_id: r.text.split() for r in items.collect()}
    for doc, item in got - verbatim:  # whatever else is found shares most of the words
        assert len(set(key[item]) & set(texts[doc].split())) >= 0.5 * len(set(key[item]))


# ---- helpers


def test_bitmap_loses_nothing(spark):
    ids = spark.range(0, 3000, 7)
    bits = bitmap(ids, F.xxhash64("id"), 1 << 12)
    hashes = np.array([r[0] for r in ids.select(F.xxhash64("id")).collect()], np.int64).view(np.uint64)
    assert len(bits) == 512 and bitmap_hits(bits, hashes).all()
    assert not bitmap_hits(bitmap(ids.limit(0), F.xxhash64("id")), hashes).any()


def test_without_is_an_anti_join_by_row(spark):
    columns = ["k", "_gone", "_may_be_gone", "row", "key", "a.b"]
    rows = numbered(spark.range(60).selectExpr("if(id % 5 = 0, null, id) k", "id _gone", "1 _may_be_gone", "2 row", "3 key", "4 `a.b`"), "t")
    gone = rows.where("row._gone % 2 = 0").select("key")
    got = without(rows, gone)
    assert got.columns == columns and sorted(r._gone for r in got.collect()) == list(range(1, 60, 2))


def test_rows_without_ids_of_their_own(spark):
    """Of rows with one text one stays whatever their ids; a benchmark passage goes whatever its id."""
    text, odd = " ".join(f"q{i}" for i in range(40)), " ".join(f"z{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text), (None, text), (1, odd), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 _gone", "2 _may_be_gone", "3 row", "4 key").repartition(3)
    kept = near_join.one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(Counter(r.text for r in kept.collect()).items(), key=str) == sorted({None: 2, text: 1, odd: 1}.items(), key=str)
    items = spark.createDataFrame([(7, " ".join(f"q{i}" for i in range(5, 35)))], "item_id long, text string")
    clean = decontaminate.without_contaminated(docs, items)
    assert clean.columns == docs.columns and sorted((r.text for r in clean.collect()), key=str) == [None, None, odd]


def test_packing_groups_rows_without_ids(spark):
    docs = spark.range(6_000).selectExpr("cast(null as long) doc_id", "'one two three' text", "id row")
    packed = packing.pack(docs, group_rows=500)
    groups = {r[0]: r[1] for r in packed.groupBy((F.col("sequence_id") / 2**32).cast("long")).count().collect()}
    assert len(groups) == 12 and max(groups.values()) < 700 and sum(groups.values()) == 6_000


def test_sample_is_bounded_and_even(spark):
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'rare', 'hot') AS g").where("g = 'hot' OR id < 30")
    got = Counter(r.g for r in sampled(rows, "id", "g", 50).collect())
    assert got == {"hot": 50, "rare": 10}
    assert sampled(rows.limit(0), "id", "g", 5).count() == 0


# ---- classifiers


def accuracy(spark, query, labels, column, least):
    held = [(r.predicted, r[column]) for r in query.join(labels, "doc_id").where("held_out").collect()]
    return np.mean([p == y for p, y in held]), len(held)


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    return read("documents"), read("labels")


def test_quality_on_held_out_rows(spark, tables):
    docs, labels = tables
    scored = quality_model.classify(docs, labels, fold(4, 2)).join(labels, "doc_id").where(fold(4, 2)).collect()
    assert np.mean([(r.score >= 0.7) == (r.quality == 1) for r in scored]) >= 0.95
    assert all(0 <= r.score <= 1 for r in scored)


def test_quality_of_odd_rows_and_tables(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(ODD)] + [(None, "x"), (0, "again"), (0, "again")], DOCS)
    both = docs.select("doc_id", "text").union(odd)
    scored = quality_model.classify(both, labels, fold(4, 2))
    assert scored.count() == both.count() and scored.where("score IS NULL OR isnan(score) OR score NOT BETWEEN 0 AND 1").count() == 0
    assert quality_model.classify(odd.limit(0), labels, fold(4, 2)).count() == 0
    one = quality_model.classify(docs, labels.where("quality = 1"), fold(4, 2)).select("score").distinct().collect()
    none = quality_model.classify(docs, labels.limit(0), fold(4, 2)).select("score").distinct().collect()
    assert [r.score for r in one] == [1.0] and [r.score for r in none] == [0.5]
    wide = docs.selectExpr("*", "1 AS key", "2 AS x", "'q' AS score")
    kept = quality_model.accepted(wide, labels, fold(4, 2))
    assert kept.columns == wide.columns and 0.7 * docs.count() < kept.count() < docs.count()


def test_quadratic_discriminant_is_the_textbook_one():
    rng = np.random.default_rng(1)
    d = len(quality_model.NAMES)
    x = [rng.normal(k, 1 + k, (400, d)) for k in (0, 1)]
    model = quality_model.build([quality_model._moments(0, p) for p in x], 0.0, 0.0, 1.0)
    probe = rng.normal(0.5, 1.5, (50, d))
    want = []
    for p in x:
        z, m, c = (probe - model.centre) / model.scale, ((p - model.centre) / model.scale).mean(axis=0), np.cov(p.T, bias=True)
        c = c / np.outer(model.scale, model.scale) + 1e-6 * np.eye(d)
        want.append(-0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", z - m, np.linalg.inv(c), z - m))
    assert np.allclose(model.difference(probe), want[1] - want[0])


def test_language_on_held_out_rows(spark, tables):
    docs, _ = tables
    got = language_id.identify(docs, fold(3, 1)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) >= 0.98 and all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_rows_and_tables(spark, tables):
    docs, _ = tables
    odd = spark.createDataFrame([(-i - 1, t, None) for i, t in enumerate([*ODD, "123 !!", "ß"])], DOCS + ", lang string")
    both = docs.select("doc_id", "text", "lang").union(odd).selectExpr("*", "1 AS lang_pred")
    got = {r.doc_id: r for r in language_id.identify(both, fold(3, 1)).collect()}
    for i, t in enumerate([*ODD, "123 !!", "ß"]):
        und = t is None or not any(c.isalpha() for c in t)
        assert (got[-i - 1].lang_pred == "und") == und and (got[-i - 1].score == 0) == und, t
    assert language_id.identify(docs.limit(0), fold(3, 1)).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")), fold(3, 1)).collect()} == {"und"}


def test_grams_are_presence_of_letter_grams():
    def brute(text, n):
        low = "".join(c.lower() if c.isalpha() else " " for c in text).encode()
        return len({low[i:i + n] for i in range(len(low) - n + 1)})

    text = "Él Ñandú! corre 12 él ñandú"
    features = language_id.grams(np.frombuffer(text.encode(), np.uint8), np.array([0])).reshape(len(language_id.LENGTHS), -1)
    for block, n in zip(features, language_id.LENGTHS):
        assert brute(text, n) - 1 <= (block > 0).sum() <= brute(text, n)  # two may share a cell
    assert np.isclose((features ** 2).sum(), 1)


def toxic_corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 300))]
        bad = i % 3 == 0
        if bad:
            for _ in range(1 + len(text) // 60):
                text[rng.randrange(len(text))] = rng.choice(["zqxvile", "zqxmean", "zqxfoul"]) + rng.choice(["", "s", "er", ","])
        out.append((i, " ".join(text), int(bad)))
    return out


def test_network_learns_words_and_characters():
    rows, fresh = toxic_corpus(240, 1), toxic_corpus(90, 2)
    net = toxicity.train([r[1] for r in rows], [r[2] for r in rows])
    scores = toxicity.score_texts(pa.array([r[1] for r in fresh]), net)
    assert np.mean((scores >= 0.3) == (np.array([r[2] for r in fresh]) == 1)) >= 0.9
    # A toxic word is seen wherever it stands in a long text.
    long = " ".join(r[1] for r in fresh if not r[2])
    marked = f"{long} zqxvile zqxfoul {long}"
    assert toxicity.score_texts(pa.array([marked]), net)[0] >= 0.3


def test_gradients_are_those_of_the_loss():
    rows = toxic_corpus(8, 3)
    data = [r[1][:200].encode() for r in rows]
    text = toxicity.read(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]))
    net = toxicity.Network(np.sort(text.hashes[:30]))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    start, length, _ = toxicity.windows(text.rows)
    target = np.arange(len(start)) % 2.0
    _, g = net.gradients(text, start, length, target)
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        place = {"word": (net.cells(text.hashes)[3], 1), "char": (text.trigrams[5], 1)}.get(name) or tuple(rng.integers(0, n) for n in value.shape)
        old = value[place]
        value[place] = old + 1e-5
        up = net.gradients(text, start, length, target)[0]
        value[place] = old - 1e-5
        down = net.gradients(text, start, length, target)[0]
        value[place] = old
        assert np.isclose((up - down) / 2e-5, g[name][place], rtol=2e-2, atol=2e-6), name


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=8))
def test_windows_overlap_and_cover_every_word(counts):
    rows = np.concatenate([[0], np.cumsum(counts)])
    start, length, row = toxicity.windows(rows)
    seen = [set() for _ in counts]
    for s, n, r in zip(start, length, row):
        assert rows[r] <= s and s + n <= rows[r + 1] and 0 < n <= toxicity.WINDOW
        seen[r] |= set(range(s, s + n))
    assert [len(s) for s in seen] == counts


def test_toxicity_of_odd_rows_and_tables(spark):
    rows = toxic_corpus(60, 4)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(-i - 1, t) for i, t in enumerate(ODD)] + [(None, "x")], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 1), (-1, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    scored = toxicity.classify(docs.selectExpr("*", "1 AS score", "2 AS label"), labels, fold(4, 2)).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert [r.score for r in scored if r.doc_id in (-1, -2, -3, -4)] == [0.0] * 4
    assert toxicity.classify(docs.limit(0), labels, fold(4, 2)).count() == 0
    assert {r.score for r in toxicity.classify(docs, labels.limit(0), fold(4, 2)).collect()} == {0.0}


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = toxic_corpus(60, 5)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], DOCS)
    labels = pd.DataFrame([(i, y) for i, _, y in rows], columns=["doc_id", "toxic"])
    turned = labels.copy()
    held = turned.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    turned.loc[held, "toxic"] = 1 - turned.loc[held, "toxic"]
    scores = [sorted(map(tuple, toxicity.classify(docs, spark.createDataFrame(t), fold(4, 2)).collect())) for t in (labels, turned)]
    assert scores[0] == scores[1]


def test_toxicity_learns_from_long_rows_only(spark):
    """Labels lie on rows of some 4000 words only, the toxic passage anywhere in them; short rows are scored."""
    rng = random.Random(8)
    mild = [f"w{i}" for i in range(300)]
    bad = ["vile", "scum", "trash", "filth", "rotten"]

    def text(n, toxic):
        out = rng.choices(mild, k=n)
        for _ in range(max(1, n // 100) if toxic else 0):
            at = rng.randrange(n)
            out[at:at] = rng.choices(bad, k=6)
        return " ".join(out)

    rows = [(i, text(4000, i % 2), i % 2) for i in range(160)] + [(1000 + i, text(40, i % 2), i % 2) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 1000], "doc_id long, toxic int")
    score = {r.doc_id: r.score for r in toxicity.classify(docs, labels, fold(4, 2)).collect()}
    wrong = sum((score[i] >= 0.5) != bool(y) for i, _, y in rows if i >= 1000)
    assert wrong <= 3
    assert len(toxicity.excerpt(text(4000, 0), 1).split()) == toxicity.SAMPLE_WINDOWS * toxicity.WINDOW
    assert toxicity.excerpt("a  b\nc " + "x" * 100, 1) == "a b c " + "x" * toxicity.SAMPLE_LETTERS


def test_a_passage_across_any_seam_lies_whole_in_a_window():
    rows = np.array([0, 500])
    start, length, _ = toxicity.windows(rows)
    for at in range(500 - 32):
        assert any(s <= at and at + 32 <= s + n for s, n in zip(start.tolist(), length.tolist()))
