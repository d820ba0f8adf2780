"""Directly addressable codes: the code by itself, and stores against the library and counting."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from harborline.llm import token_files

WHOLE = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
ODD = ["J̌ok J̌x, ok. \"end\". dogs'. a.b, c?! d., é! ½? _.", "<|ENDOFTEXT|>. x, Y", "Á, B", "á ́b",
       "ΣΑΣ Σ\x1cx\x85y z", "<|endoftext|>a <|startoftext|> b", "it's 's  x\x0b\x0cy", "", "  ", "ﬁ ẛ̣", "\x00 a\x00", "İI",
       "a" * 3000 + " " + "é" * 500, "Zum Beispiel. Und? ...!, x,", "　a　. b"]


@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 49407), st.integers(0, 2**32 - 1)), max_size=1600), st.data())
@settings(max_examples=60, deadline=None)
def test_any_place_and_any_run(ids, data):
    ids = np.array(ids, np.uint32)
    code = token_files.Code(token_files.pack(ids))
    places = np.array(data.draw(st.lists(st.integers(0, max(len(ids) - 1, 0)), max_size=20 if len(ids) else 0)), np.int64)
    assert (code.tokens(places) == ids[places]).all()
    a, b = sorted(data.draw(st.tuples(st.integers(0, len(ids)), st.integers(0, len(ids)))))
    assert (code.run(a, b) == ids[a:b]).all()


def test_places_outside_are_refused():
    code = token_files.Code(token_files.pack(np.arange(10)))
    for bad in (lambda: code.tokens([10]), lambda: code.tokens([-1]), lambda: code.run(3, 11), lambda: token_files.Code(b"none")):
        with pytest.raises((IndexError, ValueError)):
            bad()


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n.,;:!?'<|>aAéÉ̌ß"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=4))
@settings(max_examples=150, deadline=None)
def test_words_give_the_ids_of_whole_texts(texts):
    texts = texts + ODD[:1]
    got = token_files.encoder("word_bpe_49k")(pa.array(["cut off", *texts, None], pa.string())[1:])[:-1]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("size,ranges", [(64, 9), (1 << 18, None)])
def test_store_against_the_library(spark, tmp_path, size, ranges):
    texts = ODD + ["word " * n for n in (1, 30, 700)] + [None] * 3
    docs = [(i * 7 % 23, t) for i, t in enumerate(texts)]
    docs += [(500, f"copy {i % 3}") for i in range(40)] + [(None, "without id"), (-4, "first"), (-4, "first")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 range", "2 seq", "3 ids").repartition(4)
    token_files.write(df, str(tmp_path / "s"), size=size, ranges=ranges)
    got = token_files.documents(spark, str(tmp_path / "s")).collect()
    assert len(got) == len(docs)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in docs), key=lambda d: (d is not None, d or 0))
    at, stream = 0, []
    for r in got:
        assert r.start == at
        at += r.n_tokens
        stream += np.frombuffer(r.ids, "<u4").tolist()
    want = sorted((str(d), tuple([*WHOLE.encode(t or "", add_special_tokens=False).ids, 1])) for d, t in docs)
    assert sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    sums = token_files.digests(spark, str(tmp_path / "s")).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in sums) == sorted(
        (d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in want)
    places = spark.range(-2, at + 3).selectExpr("id as position").union(spark.range(5).selectExpr("id as position"))
    found = {r.position: r.token for r in token_files.tokens_at(places, str(tmp_path / "s")).collect()}
    assert found == dict(enumerate(stream))


def test_empty_table(spark, tmp_path):
    token_files.write(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "e"))
    assert token_files.digests(spark, str(tmp_path / "e")).collect() == []
    assert token_files.tokens_at(spark.range(3), str(tmp_path / "e"), "id").collect() == []
