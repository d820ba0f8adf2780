"""Collocations against counting by hand, also with fingerprints so short that they collide."""

import random
import re
from collections import Counter

import pytest

from harborline.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs, least, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words, lang = re.findall(r"[^\x20\x09]+", piece), "und" if lang is None else lang
            n[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, tuple(words[i:i + size])) for i in range(len(words) - size + 1))
    out = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            if any(len(q) > len(p) and m == lang and 100 * b >= 50 * a and b >= least
                   and p in [q[i:i + len(p)] for i in range(len(q) - len(p) + 1)] for (m, q), b in f.items()):
                continue
            score, k = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((" ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    rows = []
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        rows += [(lang, i + 1, *x) for i, x in enumerate(found[:top])]
    return sorted(rows)


def some_docs(seed=4):
    rng = random.Random(seed)
    words = ["the", "New", "new", "york", "city", "hall", "of", "a", "é", "日本", "x1", "'t", "#", "\x00", "\x85", "In"]
    docs = []
    for i in range(160):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b ", ""]) for _ in range(rng.randrange(60)))
        docs.append((rng.choice(["en", "en", "de", None, "und", ""]), text))
    docs += [("en", "New York City Hall. " * 300), ("en", None), (None, None), ("fr", ""), ("fr", " \n ."), docs[3], docs[3]]
    docs += [("xx", "same tie here. " * 12 + "other tie here. " * 12)]
    return docs


@pytest.mark.parametrize("bits", [64, 7, 12])
def test_against_counting(spark, bits, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 500)
    docs = some_docs()
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    for top in (2000, 7):
        got = collocations.mine(df, top=top, bits=bits)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == by_hand(docs, 10, top)


def test_very_large_counts_stay_exact(spark):
    rows = spark.createDataFrame([(10**13, 10**13 + 7, 10**13 + 9)], "a long, l long, r long")
    e = collocations.exact
    got = rows.selectExpr("*").withColumn("above", collocations.F.lit(10**6).cast("decimal(7,0)") * (e("a") * e("a"))).withColumn(
        "below", e("l") * e("r")).selectExpr("above div below").first()[0]
    assert got == 10**32 // ((10**13 + 7) * (10**13 + 9))


def test_empty_table_and_clashing_columns(spark):
    schema = "key long, lang string, text string, fp long, phrase string, size int, found string"
    empty = spark.createDataFrame([], schema)
    assert collocations.mine(empty).collect() == []
    full = spark.createDataFrame([(1, "en", "a b " * 12, 2, "p", 3, "f")], schema)
    assert sorted((r.phrase, r.a) for r in collocations.mine(full).collect()) == [("a b a", 11), ("b a b", 11)]
