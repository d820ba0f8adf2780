"""The prefix trie against building it from rebuilt conversations, with seams, hot conversations and collisions."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from harborline.llm import prefix_trie


def by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = c % 5 if c >= 0 else -(-c % 5)
        rebuilt[c] = tuple(own.get(c - rest, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    for key, found in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += key not in children
            saved[key[:d]] += (len(found) - 1) * len(key[-1][1].encode()) if key else 0
    out = []
    for key, found in members.items():
        ends = ",".join(map(str, sorted(c for c in found if len(rebuilt[c]) == len(key))))
        out.append((min(found), len(key), min(members[key[:-1]]) if key else None, len(found), children.get(key, 0), leaves[key], saved[key],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def some_rows(seed=2):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-12, 90), 10**12, 10**12 + 1]:
        if c % 11 == 3:
            continue
        for turn in range(rng.choice([1, 2, 3, 9, 12])):
            rows.append((c, turn, ["user", "assistant"][turn % 2], rng.choice(["hi", "hi", "hi", "é", "", None, f"x{rng.randrange(3)}"])))
    rows += [(40, t, "user", "same") for t in range(700)] + [(41, t, "user", "same") for t in range(400)]  # a third of all rows
    rows += [(7, None, None, None), (7, None, "user", "tie"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (None, 0, "user", "lost")]
    rows += [(c, 0, "user", "only") for c in range(1000, 1400, 5)]  # many that end at one node
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("bits,per_range", [(64, 250_000), (64, 60), (2, 60)])
def test_against_building_it(spark, bits, per_range, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = some_rows()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 conv", "2 depth", "'x' hash", "3 range").repartition(5)
    got = prefix_trie.trie(df, bits=bits, rows_per_range=per_range)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == by_hand(rows)


def test_products_compose_over_seams(spark):
    rows = [(g, i, (g * 7919 + i * 104729) % 1000 - 500) for g, n in ((1, 3), (2, 900), (3, 1), (4, 350)) for i in range(n)]
    df = spark.createDataFrame(rows, "g long, i long, v long").repartition(4)
    base = prefix_trie.step(0)
    got = prefix_trie.scanned(df, "g", ["i"], "v", base, ["g", "i"], rows_per_range=30).collect()
    want = {}
    for g, n in ((1, 3), (2, 900), (3, 1), (4, 350)):
        h = 0
        for i in range(n):
            before, h = h, (h * base + (g * 7919 + i * 104729) % 1000 - 500) % 2**64
            want[g, i] = (i + 1, h, before)
    assert {(r.g, r.i): (r.place, r.product % 2**64, r.before % 2**64) for r in got} == want


def test_shared_content_hash_is_refused(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "user", "b")], SCHEMA)
    real = prefix_trie.F.xxhash64
    monkeypatch.setattr(prefix_trie.F, "xxhash64", lambda *c: prefix_trie.F.lit(5).cast("long"))
    with pytest.raises(ValueError):
        prefix_trie.trie(df)
    monkeypatch.setattr(prefix_trie.F, "xxhash64", real)
    assert prefix_trie.trie(df).count() == len(by_hand([(1, 0, "user", "a"), (2, 0, "user", "b")]))


def test_empty_tables(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []
    one = prefix_trie.trie(spark.createDataFrame([(1, 0, "user", "gone")], SCHEMA)).collect()  # crc32("1") % 9 > 0, no base
    assert [tuple(r)[:7] for r in one] == [(1, 0, None, 1, 0, 1, 0)] and one[0].ends_sha256 == hashlib.sha256(b"1").hexdigest()
