"""BPE transducer against the tokenizer library."""

import hashlib
import json

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def machine():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Transducer(f.read())


def equal(machine, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert machine.encode(text) == ids
    assert machine.decode(ids) == library.decode(ids, skip_special_tokens=False)


TEXTS = ["", " \n", "Hello world's don'T I'LL", "ΑΣ Σ σ", "İstanbul ﬁ ＡＢ Å̀", "x<|endoftext|> Y<|startoftext|>z", "1234 ½²"]
TEXTS += ["中文字🙂🙂🏽", "à́ ́b", "\x1c\x85 　​﻿", "!!!???...$$$" * 40, "a" * 20_001, "ab" * 9000]


@pytest.mark.parametrize("text", TEXTS)
def test_examples(machine, library, text):
    equal(machine, library, text)


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("aeinorst 'lvEÉéß中🙂!?.<|>\n"), max_size=200))
def test_random_texts(machine, library, text):
    equal(machine, library, text)


@settings(max_examples=40, deadline=None)
@given(unit=st.text(st.sampled_from("aeinorst!"), min_size=1, max_size=6), times=st.integers(1000, 3000), tail=st.text("aeinst", max_size=9))
def test_long_words_are_stable_after_the_lookahead(machine, library, unit, times, tail):
    equal(machine, library, unit * times + tail)


def test_slices_do_not_change_the_result(machine, monkeypatch):
    text = "Some wörds, ánd̀ <|endoftext|> more " * 200
    whole = machine.encode(text)
    monkeypatch.setattr(bpe, "_SLICE", 17)
    assert machine.encode(text) == whole


def test_small_buffers_do_not_change_the_result(monkeypatch):
    merges = ["a a", "aa a", "b a", "ba b", "aaa b", "c ba", "aa aa"]
    tokens = sorted({p for m in merges for p in m.split()} | {m.replace(" ", "") for m in merges})
    tokens += [f"{t}</w>" for t in tokens]
    rules = {
        "added_tokens": [],
        "normalizer": None,
        "decoder": None,
        "pre_tokenizer": {"type": "Split", "pattern": {"Regex": r"\S+"}},
        "model": {"vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges, "end_of_word_suffix": "</w>"},
    }
    machine = bpe.Transducer(json.dumps(rules))
    assert machine.lookahead < 40
    word = "aaabacbabaaaababbaaaacba" * 30
    symbols = list(word)
    symbols[-1] += "</w>"
    monkeypatch.setattr(bpe, "_BUFFER", 1)
    assert list(machine.word_tokens(word)) == machine.merge(symbols)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["Ã", "©", "a", "ð", "Ł", "ĻĤ", "Ġb", "é"]), max_size=12))
def test_byte_decoder_is_incremental(parts):
    class Rules:
        tokens = dict(enumerate(parts))
        joins, special = False, {}
        letters = bpe.byte_alphabet()

    values = {c: b for b, c in enumerate(Rules.letters)}
    decoder = bpe.Decoder(Rules)
    got = "".join(decoder.feed(i) for i in range(len(parts))) + decoder.end()
    assert got == bytes(values[c] for p in parts for c in p).decode("utf-8", "replace")


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = queries.op5_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))


def test_columns(spark, documents, odd_columns, library):
    df = odd_columns(documents([(1, "One two"), (2, None), (3, ""), (1, "One two")]))
    source = bpe.load(spark, PATH)
    ids = df.withColumn("ids", bpe.encode_column(F.col("text"), source))
    rows = ids.select("doc_id", "ids", bpe.decode_column(F.col("ids"), source).alias("back")).collect()
    assert [r.ids for r in rows if r.doc_id > 1] == [[], []]
    assert {r.back for r in rows if r.doc_id == 1} == {"one</w> two</w>"}
    assert ids.where("false").count() == 0
