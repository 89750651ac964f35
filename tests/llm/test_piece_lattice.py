"""Operator 10 against the library that reads the same pieces as a unigram model, and by round trip.

The library is given words, and scores of at least -40,000, as its 32-bit sums lose small scores beside one of -1e9.
"""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skillweave.llm import piece_lattice, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [(1, None), (2, ""), (3, " "), (4, "a  b\n\tc "), (5, "Ünïcödé 日本 😀🙂 x²."), (5, "Ünïcödé 日本 😀🙂 x²."), (None, "naïve 12345,67 e.g. U.S.A."), (7, "abcdefghij" * 40), (8, "    indented\n    twice"), (9, "¤" * 70), (10, "é" + "́" + "ß")]


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The path of a unigram model with the given pieces, and its encoding word by word by the library."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40_000.0)
    path = str(tmp_path_factory.mktemp("model") / "unigram.model")
    with open(path, "wb") as file:
        file.write(proto.SerializeToString())
    proto.normalizer_spec.add_dummy_prefix = False
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    model = piece_lattice.Model(path)
    return path, lambda text: [i for word in model.split(text) for i in library.encode(word.replace(piece_lattice.SPACE, " "))]


def test_ids_equal_the_library(spark, sf, unigram):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("length(text) < 20000")
    texts = {r.doc_id: r.text for r in docs.collect()}
    wrong = [r.doc_id for r in piece_lattice.encode(docs, unigram[0]).collect() if list(np.frombuffer(r.ids, "<i4")) != unigram[1](texts[r.doc_id])]
    assert not wrong


def test_odd_rows_and_round_trip(spark, unigram):
    docs = spark.createDataFrame([(*r, 1, "w") for r in ODD], "doc_id long, text string, block long, word string")
    encoded = piece_lattice.encode(docs, unigram[0])
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(((r.doc_id, list(np.frombuffer(r.ids, "<i4"))) for r in encoded.collect()), key=key)
    assert got == sorted(((i, unigram[1](t or "")) for i, t in ODD), key=key)
    back = sorted(((r.doc_id, r.text) for r in piece_lattice.decode(encoded, unigram[0]).collect()), key=key)
    assert back == sorted(((i, t or "") for i, t in ODD), key=key)
    empty = docs.where("doc_id > 99")
    assert piece_lattice.decode(piece_lattice.encode(empty, PATH), PATH).count() == 0


def test_fold_equals_the_plain_recursion(spark):
    model = piece_lattice.Model(PATH)
    words = ["▁the", "▁▁▁", "▁unbelievable", "x", "日", "▁aaaaaaa", "ÿÿ", "▁" + "q" * 63, "▁" + "r" * 64]
    got = {r.word: list(r.pieces) for r in piece_lattice.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    assert got == {w: model.best(w) for w in words}


def test_query_decodes_to_the_text(spark, sf):
    got = {r.doc_id: r.decoded_sha256 for r in queries.op10_piece_lattice(spark, sf).collect()}
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert got == {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in given}


def test_blocks_are_large_and_hold_the_words_of_every_text(spark):
    """More words than 16 bits number stay one block, odd texts included; the words of each document are those the model cuts."""
    import pyarrow as pa

    model = piece_lattice.Model(PATH)
    texts = [" ".join(f"w{i}x" for i in range(70_000)), *(t or "" for _, t in ODD), "a\x01b c,d", "x▁y,▁z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    (block,) = piece_lattice._blocks(docs, model).collect()
    width = np.dtype("<u4")
    places = np.frombuffer(pa.decompress(bytes(block.numbers), decompressed_size=width.itemsize * sum(block.counts), codec="zstd", asbytes=True), width)
    ends = np.cumsum(block.counts)
    got = {i: [block.words[p] for p in places[end - n : end]] for i, n, end in zip(block.doc_ids, block.counts, ends, strict=True)}
    assert len(block.words) > 70_000 and got == {i: model.split(t) for i, t in enumerate(texts)}


def test_the_setting_for_groups_comes_back(spark):
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    with piece_lattice._groups_in_memory(spark, 7):
        assert spark.conf.get(name) == "7"
    before = spark.conf.get(name)
    piece_lattice.encode(spark.createDataFrame([(1, "the cat")], "doc_id long, text string"), PATH).collect()
    assert spark.conf.get(name) == before != "7"
