"""Pieces of words from a lattice that Spark joins build (operator 10).

A text is cut into words at places that no piece of the table crosses, so the best pieces of a text are those of its words, and each
different word is worked out once. The substrings of a word, no longer than the longest piece, are joined to the piece table; those that
are pieces are the edges of the word's lattice. They are grouped by word, and a higher-order aggregate folds them from
the first to the last character: the best way to each end is the best of the edges that arrive there. The words then return to their
documents a block at a time, a block being some documents and the words they use.

Scores add up as 32-bit floats and equal sums go to the longer last piece, as the reference implementation of unigram models does it. A model
file of another type is read as such a table of pieces and scores too.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm.common import map_batches
from skillweave.session import shared_root, written

SPACE = "▁"
BLOCK_WORDS = 400_000  # the larger a block, the fewer words are in several
BLOCK_CHARS = 8_000_000
SLICE_CHARS = 1_000_000  # texts that are cut together; a longer one is cut alone
FOLD_CHARS = 64  # words beyond are folded by the same recursion outside of an expression, whose state would be copied at each step
_NORMAL, _BYTE = (1, 4), 6
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏͰ-ϿЀ-ӿ"
_WORD = re.compile(f"{SPACE}*[{_LETTER}]+|{SPACE}*[^{_LETTER}{SPACE}]+|{SPACE}+")
_COARSE = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_TOKEN = re.compile(" *[^ ]+| +")
_MARK = "\x01"
WORDS_PER_TASK = 20_000
MAX_TASKS = 20_000


class Model:
    """The piece table of a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kinds = [p.type for p in proto.pieces]
        self.pieces = {p.piece: (i, float(np.float32(p.score))) for i, p in enumerate(proto.pieces) if p.type in _NORMAL}
        self.byte_ids = np.array([i for i, k in enumerate(kinds) if k == _BYTE], np.int32)
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no piece for every byte")
        self.longest = max(map(len, self.pieces))
        self.unknown = float(np.float32(min(s for _, s in self.pieces.values()) - 10.0))
        names = [p.piece.replace(SPACE, " ").encode() if k in _NORMAL else b"" for p, k in zip(proto.pieces, kinds, strict=True)]
        for value, i in enumerate(self.byte_ids):
            names[i] = bytes([value])
        self.flat = np.frombuffer(b"".join(names), np.uint8)
        self.start = np.r_[0, np.cumsum([len(n) for n in names])]
        letter = re.compile(f"[{_LETTER}]")
        kind = lambda c: 0 if c == SPACE else 1 if letter.match(c) else 2
        steps = {(kind(a), kind(b)) for p in self.pieces for a, b in zip(p, p[1:])}
        if steps & {(1, 0), (2, 0)}:
            raise ValueError("a piece has a space behind another character")
        self.words = _COARSE if steps & {(1, 2), (2, 1)} else _WORD

    def split(self, text: str) -> list[str]:
        """The words of a text, in a row."""
        return [word for token in tokens(text) for word in self.parts(token)]

    def parts(self, token: str) -> list[str]:
        return self.words.findall(SPACE + token.replace(" ", SPACE))

    def best(self, word: str) -> list[int]:
        """The fold over one word; characters that are no piece come as minus their code point minus one."""
        f32 = np.float32
        score, back = [f32(0)] + [None] * len(word), [(0, 0)] * (len(word) + 1)
        for start in range(len(word)):
            for end in range(start + 1, min(len(word), start + self.longest) + 1):
                found = self.pieces.get(word[start:end])
                if found is None and end > start + 1:
                    continue
                piece, value = found or (-ord(word[start]) - 1, self.unknown)
                value = f32(score[start] + f32(value))
                if score[end] is None or value > score[end]:
                    score[end], back[end] = value, (start, piece)
        out, at = [], len(word)
        while at:
            at, piece = back[at]
            out.append(piece)
        return out[::-1]

    def expand(self, pieces: list[int]) -> np.ndarray:
        """Ids; a character without a piece becomes its bytes."""
        if min(pieces) >= 0:
            return np.array(pieces, np.int32)
        return np.concatenate([[p] if p >= 0 else self.byte_ids[list(chr(-p - 1).encode())] for p in pieces]).astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space that encoding puts in front."""
        count = self.start[ids + 1] - self.start[ids]
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return self.flat[np.repeat(self.start[ids], count) + at].tobytes().decode(errors="replace").removeprefix(" ")


def tokens(text: str) -> list[str]:
    """What stands behind single spaces, the one in front of the text included; a longer run leads its token."""
    if not text:
        return []
    found = text.split(" ")
    return [t[1:] for t in _TOKEN.findall(" " + text)] if "" in found else found


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """``piece, id, score``: as large as the vocabulary, whatever the corpus."""
    return spark.createDataFrame([(p, i, s) for p, (i, s) in model.pieces.items()], "piece string, id int, score float")


def encode_words(words: DataFrame, model: Model) -> DataFrame:
    """``word, pieces`` for the distinct, non-empty ``word``s of a table, characters without a piece as in ``Model.best``."""
    chars = F.col("chars") if "chars" in words.columns else F.char_length("word")
    short = words.where(chars <= FOLD_CHARS)
    ends = F.sequence(F.lit(1), F.least(F.lit(model.longest), F.char_length("word") - F.col("start") + 1))
    spans = short.select("word", F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("start")).select("word", "start", F.explode(ends).alias("size"))
    spans = spans.withColumn("piece", F.expr("substring(word, start, size)"))
    met = spans.join(F.broadcast(piece_table(words.sparkSession, model)), "piece", "left").where("id IS NOT NULL OR size = 1")
    edge = F.struct(
        (F.col("start") + F.col("size") - 1).alias("end"), "start",
        F.coalesce("id", -_code_point("piece") - 1).alias("id"), F.coalesce("score", F.lit(model.unknown).cast("float")).alias("score"),
    )
    lattice = met.groupBy("word").agg(F.collect_list(edge).alias("edges"))
    way = "array<struct<score:float,path:array<int>>>"

    def step(ways, end):
        arriving = F.filter("edges", lambda x: x["end"] == end)
        options = F.transform(arriving, lambda x: F.struct((F.get(ways, x["start"] - 1)["score"] + x["score"]).alias("score"), (-x["start"]).alias("back"), x["id"].alias("id")))
        # The path is put together for the best option only; an array of one hands it on.
        return F.concat(ways, F.transform(F.array(F.array_max(options)), lambda x: F.struct(x["score"].alias("score"), F.concat(F.get(ways, -x["back"] - 1)["path"], F.array(x["id"])).alias("path")))).cast(way)

    begin = F.array(F.struct(F.lit(0.0).cast("float").alias("score"), F.array().cast("array<int>").alias("path"))).cast(way)
    folded = lattice.select("word", F.aggregate(F.sequence(F.lit(1), F.char_length("word")), begin, step, lambda ways: F.element_at(ways, -1)["path"]).alias("pieces"))

    def fold(batch: pa.RecordBatch) -> dict:
        return {"word": batch.column(0), "pieces": [model.best(w) for w in batch.column(0).to_pylist()]}

    return folded.unionByName(map_batches(words.where(chars > FOLD_CHARS).select("word"), fold, "word string, pieces array<int>"))


def _code_point(name: str):
    """The code point of a one-character string, from its UTF-32 bytes."""
    return F.conv(F.hex(F.encode(F.col(name), "UTF-32")), 16, 10).cast("int")


def _blocks(docs: DataFrame, model: Model) -> DataFrame:
    """``block, doc_ids, counts, words, numbers``: consecutive documents of a task with the words they use.

    A block has at most ``BLOCK_WORDS`` words and ``BLOCK_CHARS`` characters, or one slice. ``numbers`` is compressed.
    """

    def cut(names: pa.Array) -> pa.Array:
        """The words of each token, as ``Model.parts`` cuts them."""
        if pc.any(pc.match_substring(names, _MARK)).as_py():
            return pa.array([model.parts(t) for t in names.to_pylist()], pa.list_(pa.string()))
        whole = pc.binary_join_element_wise(pa.scalar(SPACE), pc.replace_substring(names, " ", SPACE), "")
        marked = pc.replace_substring_regex(whole, f"({model.words.pattern})", f"\\1{_MARK}")
        return pc.split_pattern(pc.utf8_slice_codeunits(marked, 0, -1), _MARK)

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, pa.Array, np.ndarray, int]]:
        """Of some documents: their ids, words each, different words, the places of all words in these, characters."""
        for batch in batches:
            every = pc.fill_null(batch.column(1), "")
            ends = np.cumsum(pc.utf8_length(every).to_numpy(zero_copy_only=False), dtype=np.int64)
            start = 0
            while start < len(every):
                done = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_CHARS, "right")))
                texts, keys = every.slice(start, stop - start), batch.column(0).slice(start, stop - start)
                odd = pc.or_(pc.match_substring_regex(texts, "^ | $|  "), pc.equal(texts, ""))
                plain = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
                rest = [tokens(t) for t in texts.filter(odd).to_pylist()]
                sizes = np.r_[plain.value_lengths().to_numpy(zero_copy_only=False), [len(r) for r in rest]].astype(np.int64)
                coded = pa.concat_arrays([plain.flatten(), pa.array([t for r in rest for t in r], pa.string())]).dictionary_encode()
                parts = cut(coded.dictionary)
                count = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                words = parts.flatten().dictionary_encode()
                at = coded.indices.to_numpy(zero_copy_only=False)
                each, begin = count[at], (np.cumsum(count) - count)[at]
                total = np.r_[0, np.cumsum(each)]
                where = np.repeat(begin - total[:-1], each) + np.arange(int(total[-1]))
                order = pa.concat_arrays([keys.filter(pc.invert(odd)), keys.filter(odd)]).to_pylist()
                yield order, np.diff(total[np.r_[0, np.cumsum(sizes)]]), words.dictionary, words.indices.to_numpy(zero_copy_only=False)[where], int(ends[stop - 1]) - done
                start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, chars = TaskContext.get().partitionId() << 32, 0
        keys, counts, held, known = [], [], [], {}

        def close() -> pa.RecordBatch:
            raw = np.concatenate(held).astype("<u4" if len(known) > 1 << 16 else "<u2").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([keys], pa.list_(pa.int64())), pa.array([np.concatenate(counts)], pa.list_(pa.int64())), pa.array([list(known)], pa.list_(pa.string())), pa.array([pa.compress(raw, codec="zstd", asbytes=True)], pa.binary())],
                names=["block", "doc_ids", "counts", "words", "numbers"],
            )

        for ids, each, words, places, size in sliced(batches):
            names = words.to_pylist()
            if keys and (chars + size > BLOCK_CHARS or len(known) + sum(w not in known for w in names) > BLOCK_WORDS):
                yield close()
                block, chars = block + 1, 0
                keys, counts, held, known = [], [], [], {}
            number = np.fromiter((known.setdefault(w, len(known)) for w in names), np.uint32, len(names))
            held.append(number[places])
            counts.append(each)
            keys += ids
            chars += size
        if keys:
            yield close()

    return docs.mapInArrow(run, "block long, doc_ids array<long>, counts array<long>, words array<string>, numbers binary")


def _by_block(blocks: DataFrame) -> DataFrame:
    """``blocks`` as a table in buckets of whole blocks, which a later join by block reads where they are."""
    spark = blocks.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = blocks.write.format("parquet").bucketBy(buckets, "block").option("path", f"{shared_root(spark).rstrip('/')}/{name}")
    writer.saveAsTable(name)
    return spark.table(name)


@contextmanager
def _groups_in_memory(spark: SparkSession, groups: int):
    """Lists of so many groups are collected in memory before Spark turns to sorting."""
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(groups))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as ``doc_id, n_words, ids`` (little-endian 32-bit piece ids, binary).

    A null or empty text has no pieces. Repeated rows and null ids are documents like others. An empty table gives an empty result; other columns are ignored.
    """
    model = Model(model_path)
    spark = docs.sparkSession
    blocks = _by_block(_blocks(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), model))
    used = blocks.select("block", F.posexplode("words").alias("pos", "word")).where("word IS NOT NULL")
    pairs = blocks.agg(F.sum(F.size("words"))).first()[0] or 0
    placed = used.repartition(min(MAX_TASKS, max(1, math.ceil(pairs / WORDS_PER_TASK))), "word")  # the lattices of a task fit its memory
    # What is filtered here is known only behind the grouping, and all columns are used, so Spark shuffles the words once for all branches.
    words = placed.groupBy("word").agg(F.max(F.char_length("word")).alias("chars"), F.max("block").alias("last"), F.max("pos").alias("far"))
    words = words.where("last IS NOT NULL AND far IS NOT NULL")
    with _groups_in_memory(spark, 2 * WORDS_PER_TASK):
        pieces = written(encode_words(words, model).join(placed, "word").select("block", "pos", "pieces"), "word-pieces")

    def run(key: tuple, met: pa.Table, block: pa.Table) -> pa.Table:
        keys, counts = block.column("doc_ids")[0].as_py(), block.column("counts")[0].as_py()
        ids, ends = _block_ids(model, block.column("numbers")[0].as_py(), met.combine_chunks(), counts)
        rows = [ids[a:b].tobytes() for a, b in zip([0, *ends], ends)]
        return pa.table({"doc_id": pa.array(keys, pa.int64()), "n_words": pa.array(counts, pa.int64()), "ids": pa.array(rows, pa.binary())})

    whole = blocks.select("block", "doc_ids", "counts", "numbers").groupBy("block")
    return pieces.groupBy("block").cogroup(whole).applyInArrow(run, "doc_id long, n_words long, ids binary")


def _block_ids(model: Model, numbers: bytes, met: pa.Table, counts: list[int]) -> tuple[np.ndarray, list[int]]:
    """The ids of all documents of a block, and where each document ends."""
    if not met.num_rows:
        return np.zeros(0, np.int32), [0] * len(counts)
    pos, pieces = met.column("pos").to_numpy(), met.column("pieces").combine_chunks()
    size = len(pos)
    raw, count = pieces.flatten().to_numpy(), pieces.value_lengths().to_numpy().astype(np.int64)
    if len(raw) and raw.min() < 0:
        parts = [model.expand(list(raw[a:b])) for a, b in zip(np.cumsum(count) - count, np.cumsum(count), strict=True)]
        raw, count = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(count) - count
    first, many = np.zeros(size, np.int64), np.zeros(size, np.int64)
    first[pos], many[pos] = begin, count
    kind = np.dtype("<u4" if size > 1 << 16 else "<u2")
    at = np.frombuffer(pa.decompress(numbers, decompressed_size=kind.itemsize * sum(counts), codec="zstd", asbytes=True), kind).astype(np.int64)
    each = many[at]
    total = np.cumsum(each)
    ids = raw[np.repeat(first[at], each) + np.arange(int(each.sum())) - np.repeat(total - each, each)].astype("<i4")
    return ids, [int(total[e - 1]) if e else 0 for e in np.cumsum(counts)]


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """The columns of ``encoded`` with ``ids`` replaced by ``text``; no ids are an empty text."""
    model = Model(model_path)
    other = [c for c in encoded.columns if c != "ids"]

    @F.pandas_udf("string")
    def text(ids):
        return ids.map(lambda raw: model.decode(np.frombuffer(raw, "<i4")) if raw else "")

    return encoded.select(*other, text("ids").alias("text"))
