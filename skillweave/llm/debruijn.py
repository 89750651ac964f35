"""Substring deduplication over a compacted De Bruijn graph of word windows (operator 4).

An edge of the graph is a window of ``width`` consecutive words; it is repeated if it starts at two places.
Listing every edge would shuffle one row per word, so edges are compacted before they are counted:

* A *path* is a run of consecutive edges of one document that share their minimizer, the least hash of
  the ``SEED``-word sequences in a window. Equal windows have equal minimizers at equal offsets, so equal
  edges always lie in paths with the same anchor, at the same distance from it.
* Paths meet by anchor in a Spark aggregation. An anchor seen once ends there. Where all paths at an
  anchor are the same, the path does not branch and is repeated as a whole.
* Where paths at an anchor differ, it branches: one source occurrence of each distinct path is looked up
  by its coordinates, its edges are listed, and a second aggregation counts each edge with the number of
  occurrences of its paths.

The repeated edges return to their documents by coordinates, where the words they cover are removed.
Counts are aggregated before each shuffle, so a passage that a third of all documents share is one row per
task. An edge is identified by 128 bits: its anchor and an independent hash of all its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillweave.llm.common import WordHashes, map_batches, packed
from skillweave.session import written

WIDTH = 35
SEED = 8
_KEY = ["row_key", "text_key"]
_ODD = np.array(0x9E3779B97F4A7C15, np.uint64)
_ODD2 = np.array(0xD6E8FEB86659FD93, np.uint64)
_WORDS = WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _windows(h: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """A polynomial hash of each run of ``width`` values; 64-bit arithmetic wraps."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, part, size, power = np.zeros(n, np.uint64), 0, h, 1, base
    while done < width:
        if width & size:
            out = out * power + part[done : done + n]
            done += size
        if done < width:
            part, power, size = part[:-size] * power + part[size:], np.multiply(power, power), size * 2
    return out


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` keys."""
    size = 1
    while size * 2 <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    rest = width - size
    return np.minimum(key[: len(key) - rest], key[rest:]) if rest else key


def split_words(text: str | None) -> list[bytes]:
    """Words between the six white-space characters of ASCII."""
    return (text or "").encode().split()


def paths_of(words: list[bytes], width: int = WIDTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Anchor hash, path hash, first window and number of windows of every path of one document."""
    none = np.zeros(0, np.uint64)
    if len(words) < width:
        return none, none, none.astype(np.int64), none.astype(np.int64)
    h = _mixed(_WORDS.of(words))
    seeds = _mixed(_windows(h, seed, _ODD))
    order = np.arange(len(seeds), dtype=np.uint64)
    bits = np.uint64(30)  # a text has fewer words; equal leading bits: the first one counts, in every document
    key = (seeds >> bits << bits) | order
    at = (_least(key, width - seed + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    count = np.diff(np.r_[first, len(at)])
    edge = edges_of(words)
    order = _powers(_ODD2, int(count.max()))
    terms = np.r_[edge, np.zeros(1, np.uint64)]
    place = np.arange(len(at)) - np.repeat(first, count)
    path = np.add.reduceat(terms[:-1] * order[place], first)
    return seeds[at[first]], _mixed(path + count.astype(np.uint64)), first, count


def edges_of(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """A hash of every window, independent of the anchors."""
    return _mixed(_windows(_mixed(_WORDS.of(words) ^ _ODD2), width, _ODD2))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with ``row_key, text_key``: equal only for rows with the same id and text, whose results are the same too."""
    text = F.col(text_col).cast("string")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)).alias("row_key"), F.hash(text).alias("text_key"), text.alias("text"), F.struct("*").alias("row"))


def _paths(texts: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        found, owner = [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            part = paths_of(split_words(text))
            found.append(part)
            owner.append(np.full(len(part[0]), i, np.int64))
        anchor, path, first, count = (np.concatenate(x) for x in zip(*found, strict=True))
        at = pa.array(np.concatenate(owner))
        return {"row_key": batch.column(0).take(at), "text_key": batch.column(1).take(at), "anchor": anchor, "path": path, "first": first, "n": count}

    return map_batches(texts.select(*_KEY, "text"), run, "row_key long, text_key int, anchor long, path long, first int, n int")


def _edges(asked: DataFrame) -> DataFrame:
    """Every edge of the paths asked for, read from the text at the coordinates of one occurrence."""

    def run(batch: pa.RecordBatch) -> dict:
        wanted = batch.column(1)
        owner, w = wanted.value_parent_indices().to_numpy(), wanted.flatten()
        first, count = (w.field(k).to_numpy() for k in ("first", "n"))
        edges, last = np.zeros(int(count.sum()), np.uint64), -1
        ends = np.cumsum(count)
        texts = batch.column(0)
        for i in range(len(owner)):
            if owner[i] != last:
                last = owner[i]
                own = edges_of(split_words(texts[int(last)].as_py()))
            edges[ends[i] - count[i] : ends[i]] = own[first[i] : first[i] + count[i]]
        each = pa.array(np.repeat(np.arange(len(owner)), count))
        place = np.arange(len(edges)) - np.repeat(ends - count, count)
        return {k: w.field(k).take(each) for k in ("anchor", "path", "seen")} | {"place": place, "edge": edges}

    return map_batches(asked.select("text", "wanted"), run, "anchor long, path long, place int, edge long, seen long")


def _repeats(keyed: DataFrame) -> DataFrame:
    """``row_key, text_key, spans``: windows that are repeated, as (first window, bits of the windows from there)."""
    paths = written(_paths(keyed), "paths")
    anchors = paths.groupBy("anchor").agg(F.count("*").alias("seen"), (F.min("path") != F.max("path")).alias("branches")).where("seen > 1").select("anchor", "branches")
    shared = written(paths.join(anchors, "anchor"), "shared-paths")
    whole = shared.where("NOT branches").select(*_KEY, "first", F.expr("shiftleft(1L, n) - 1").alias("bits"))
    crossing = shared.where("branches")
    distinct = crossing.groupBy("anchor", "path").agg(F.count("*").alias("seen"), F.min(F.struct(*_KEY, "first", "n")).alias("at"))
    wanted = distinct.select("at.row_key", "at.text_key", F.struct("anchor", "path", "at.first", "at.n", "seen").alias("w")).groupBy(*_KEY).agg(F.collect_list("w").alias("wanted"))
    edges = written(_edges(keyed.select(*_KEY, "text").join(wanted, _KEY)), "branching-edges")
    # Rows that repeat an id and its text answer twice; their edges are repeated anyway, and bits are or-ed.
    counted = edges.groupBy("anchor", "edge").agg(F.sum("seen").alias("seen")).where("seen > 1").select("anchor", "edge")
    good = edges.join(counted, ["anchor", "edge"]).groupBy("anchor", "path").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))
    parts = crossing.join(good, ["anchor", "path"]).select(*_KEY, "first", "bits")
    return whole.unionByName(parts).groupBy(*_KEY).agg(F.collect_set(F.struct("first", "bits")).alias("spans"))


def kept_words(words: list[bytes], first: np.ndarray, bits: np.ndarray, width: int = WIDTH) -> list[bytes]:
    """The words that none of the marked windows covers."""
    if not len(first):
        return words
    edge = np.zeros(len(words) + 1, np.int32)
    for place in range(int(bits.max()).bit_length()):
        starts = first[bits >> place & 1 == 1] + place
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + width, -1)
    covered = np.cumsum(edge[:-1]) != 0
    return words if not covered.any() else list(np.array(words, object)[~covered])


def _cut(batch_texts: pa.Array, spans: pa.Array) -> list[tuple[int, list[bytes]]]:
    """Number of words and kept words of each text."""
    out = []
    starts, values = spans.offsets.to_numpy(), spans.values
    first, bits = (values.field(k).to_numpy(zero_copy_only=False) for k in ("first", "bits"))
    for i, text in enumerate(batch_texts.to_pylist()):
        words = split_words(text)
        at = slice(starts[i], starts[i + 1]) if spans[i].is_valid else slice(0, 0)
        out.append((len(words), kept_words(words, first[at].astype(np.int64), bits[at])))
    return out


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as ``doc_id, n_words, n_removed, kept_text`` (kept words joined by one space).

    A word goes if some window of 35 words that covers it starts at another place as well, in the same or
    another row; rows that repeat an id are other rows. Null and empty texts have no words; texts shorter than a
    window lose nothing. An empty table gives an empty result; other columns are ignored.
    """
    rows = _keyed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), "doc_id", "text")
    met = rows.join(_repeats(rows), _KEY, "left").select("row.doc_id", "text", "spans")

    def run(batch: pa.RecordBatch) -> dict:
        cut = _cut(batch.column(1), batch.column(2))
        return {"doc_id": batch.column(0), "n_words": [n for n, _ in cut], "n_removed": [n - len(k) for n, k in cut], "kept_text": [b" ".join(k).decode() for _, k in cut]}

    return map_batches(met, run, "doc_id long, n_words long, n_removed long, kept_text string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with repeated spans taken out of ``text`` and ``n_chars`` counted anew.

    A row that loses nothing keeps its text as it is; all rows stay.
    """
    rows = _keyed(docs, "doc_id", "text")
    met = rows.join(_repeats(rows), _KEY, "left").select("text", "spans", "row")

    def run(batch: pa.RecordBatch) -> dict:
        cut = _cut(batch.column(1), batch.column(2))
        given = batch.column(1).to_pylist()
        return {"row": batch.column(0), "text": [t if n == len(k) else b" ".join(k).decode() for t, (n, k) in zip(given, cut, strict=True)]}

    kind = met.select("row", "text").schema
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    done = map_batches(met.select("row", "text", "spans"), run, kind)
    return done.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])
