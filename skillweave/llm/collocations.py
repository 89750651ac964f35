"""Phrase collocations counted in quotient filters (operator 13).

Texts are cut into pieces at stops and line ends, pieces into words. Words seen at least ``MIN_COUNT`` times in their language get
small ids: a word's hash bucket plus its rank inside the bucket, so no task numbers a whole vocabulary. A phrase of m words packs
into one 128-bit number, b bits an id. An invertible permutation (a Feistel network over two 64-bit halves) spreads the packed
numbers of a level (as wide as m ids, rounded up to an even number of bits); the top ``QUOTIENT_BITS`` bits are the quotient and the
other bits the full remainder, so (quotient, remainder) gives the phrase back and a count never mixes two phrases. The language's
code and the quotient form one integer key, and a remainder of at most 63 bits travels as one long. Each task keeps a filter sorted by (quotient, remainder) with a count per slot for
every batch it reads; Spark merges the filters of all tasks by quotient and remainder, adding counts.

Phrases are counted level by level from two to ``MAX_WORDS`` words. A phrase of m words can reach ``MIN_COUNT`` only if both its
phrases of m - 1 words do, so a level counts only those; the frequent phrases of the level before travel to the tasks when their
number is below ``BROADCAST_GRAMS``, and otherwise every phrase of frequent words is counted, which gives the same counts.
Frequent phrases have exact counts; the score of a cut is ``floor(1000 a n / (l r))`` in 38-digit decimals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillweave.session import written

# Fixed values of the contract: least count, phrase lengths, rows per language, cut points of pieces and words.
MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
PIECE_CUT = r"[.,;:!?\x0A-\x0D]"
WORD_CUT = r"[\x20\x09]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Parameters of the layout.
BUCKETS = 4096
QUOTIENT_BITS = 16
BROADCAST_WORDS = 2_000_000
BROADCAST_GRAMS = 4_000_000

_ROUNDS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_REM = np.uint64((1 << (64 - QUOTIENT_BITS)) - 1)
_LOWER_TABLE = str.maketrans(UPPER, LOWER)
_PIECES, _WORDS = re.compile(PIECE_CUT), re.compile(WORD_CUT)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x ^ np.uint64(key)) * _M1
    x ^= x >> np.uint64(31)
    x *= _M2
    return x ^ (x >> np.uint64(29))


def _split(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """A number below 2^(2 half) as its upper and lower ``half`` bits."""
    if half == 64:
        return hi, lo
    mask = np.uint64((1 << half) - 1)
    return ((lo >> np.uint64(half)) | (hi << np.uint64(64 - half))) & mask, lo & mask


def _unsplit(upper: np.ndarray, lower: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    if half == 64:
        return upper, lower
    return upper >> np.uint64(64 - half), lower | (upper << np.uint64(half))


def permute(hi: np.ndarray, lo: np.ndarray, width: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """An invertible map of numbers below 2^width (width even, at most 128) onto themselves: a Feistel network on two halves."""
    half = width // 2
    mask = np.uint64((1 << half) - 1)
    upper, lower = _split(hi, lo, half)
    for key in _ROUNDS:
        upper, lower = lower, upper ^ (_mix(lower, key) & mask)
    return _unsplit(upper, lower, half)


def unpermute(hi: np.ndarray, lo: np.ndarray, width: int = 128) -> tuple[np.ndarray, np.ndarray]:
    half = width // 2
    mask = np.uint64((1 << half) - 1)
    upper, lower = _split(hi, lo, half)
    for key in reversed(_ROUNDS):
        upper, lower = lower ^ (_mix(upper, key) & mask), upper
    return _unsplit(upper, lower, half)


def width_of(m: int, bits: int) -> int:
    """Bits of the filter of phrases of m words: the packed width, rounded up to an even number."""
    return max(2, m * bits + (m * bits) % 2)


def pack(ids: np.ndarray, starts: np.ndarray, m: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The m ids from each start as one 128-bit number (hi, lo), the first id highest."""
    hi, lo = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for j in range(m):
        shift, v = bits * (m - 1 - j), ids[starts + j]
        if shift >= 64:
            hi |= v << np.uint64(shift - 64)
        else:
            lo |= v << np.uint64(shift)
            if shift + bits > 64:
                hi |= v >> np.uint64(64 - shift)
    return hi, lo


def unpack(hi: np.ndarray, lo: np.ndarray, m: int, bits: int) -> np.ndarray:
    """Ids (rows of m) of packed numbers."""
    mask, out = np.uint64((1 << bits) - 1), np.zeros((len(hi), m), np.uint64)
    for j in range(m):
        shift = bits * (m - 1 - j)
        if shift >= 64:
            out[:, j] = (hi >> np.uint64(shift - 64)) & mask
        elif shift + bits <= 64:
            out[:, j] = (lo >> np.uint64(shift)) & mask
        else:
            out[:, j] = ((lo >> np.uint64(shift)) | (hi << np.uint64(64 - shift))) & mask
    return out


def _parts(width: int) -> tuple[int, int]:
    """Bits of quotient and of remainder."""
    q = min(QUOTIENT_BITS, width)
    return q, width - q


def quotient_filter(hi: np.ndarray, lo: np.ndarray, width: int = 128) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Quotients, remainders (bits above 64, and the lower 64 bits) and counts of the packed numbers, sorted by quotient and
    remainder. The quotient is the top bits of the permuted number, the remainder all the others."""
    ph, pl = permute(hi, lo, width)
    order = np.lexsort((pl, ph))
    ph, pl = ph[order], pl[order]
    new = np.ones(len(ph), bool)
    new[1:] = (ph[1:] != ph[:-1]) | (pl[1:] != pl[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(ph)))
    ph, pl = ph[at], pl[at]
    _, r = _parts(width)
    if r >= 64:
        q, rh, rl = ph >> np.uint64(r - 64), ph & np.uint64((1 << (r - 64)) - 1), pl
    elif r:
        q, rh, rl = (ph << np.uint64(64 - r)) | (pl >> np.uint64(r)), np.zeros_like(ph), pl & np.uint64((1 << r) - 1)
    else:
        q, rh, rl = pl, np.zeros_like(ph), np.zeros_like(pl)
    return q.astype(np.int32), rh.view(np.int64), rl.view(np.int64), counts.astype(np.int64)


def restore(quotient: np.ndarray, rem_hi: np.ndarray, rem_lo: np.ndarray, width: int = 128) -> tuple[np.ndarray, np.ndarray]:
    _, r = _parts(width)
    q, rh, rl = quotient.astype(np.int64).view(np.uint64), rem_hi.view(np.uint64), rem_lo.view(np.uint64)
    if r >= 64:
        ph, pl = (q << np.uint64(r - 64)) | rh, rl
    elif r:
        ph, pl = q >> np.uint64(64 - r), (q << np.uint64(r)) | rl
    else:
        ph, pl = np.zeros_like(q), q
    return unpermute(ph, pl, width)


class Known:
    """Exact membership of packed numbers per language: sorted 64-bit fingerprints, then both halves compared.

    ``sets`` holds plain arrays only, so that it can travel to the tasks as a broadcast value.
    """

    def __init__(self, langs: list[str], hi: np.ndarray, lo: np.ndarray, sets: dict | None = None):
        self.sets = {} if sets is None else sets
        if sets is not None:
            return
        langs = np.asarray(langs, object)
        for lang in set(langs.tolist()):
            pick = langs == lang
            h, l = hi[pick], lo[pick]
            fp = _mix(h, 1) ^ l
            order = np.argsort(fp, kind="stable")
            fp, h, l = fp[order], h[order], l[order]
            run = 1 if len(fp) < 2 else int(np.max(np.diff(np.flatnonzero(np.append(np.append(True, fp[1:] != fp[:-1]), True)))))
            self.sets[lang] = (fp, h, l, run)

    def has(self, lang: str, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hi), bool)
        if lang not in self.sets or not len(hi):
            return found
        fp, h, l, run = self.sets[lang]
        want = _mix(hi, 1) ^ lo
        at = np.searchsorted(fp, want)
        for step in range(run):  # equal fingerprints of different phrases sit side by side
            i = np.minimum(at + step, len(fp) - 1)
            found |= (fp[i] == want) & (h[i] == hi) & (l[i] == lo)
        return found


def _words(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    pieces = docs.select(lang, F.explode(F.split(text, PIECE_CUT)).alias("piece"))
    return pieces.select("lang", F.explode(F.split("piece", WORD_CUT)).alias("word")).where(F.col("word") != "")


def _encode(docs: DataFrame, vocab: dict) -> DataFrame:
    """Per document with a frequent word: its language and ids (little-endian int32), 0 where a piece ends or a rare word stands."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            langs, blobs = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lang = "und" if lang is None else lang
                words = table.get(lang)
                if not words or not text:
                    continue
                ids = []
                for piece in _PIECES.split(text.translate(_LOWER_TABLE)):
                    ids += [words.get(w, 0) for w in _WORDS.split(piece) if w]
                    ids.append(0)
                if any(ids):
                    langs.append(lang)
                    blobs.append(np.asarray(ids, "<i4").tobytes())
            if langs:
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(blobs, pa.binary())], names=["lang", "ids"])

    return docs.select(F.col("lang").cast("string"), F.col("text").cast("string")).mapInArrow(run, "lang string, ids binary")


def _count_level(encoded: DataFrame, m: int, bits: int, known: Known | None, codes: dict[str, int]) -> DataFrame:
    """Phrases of m frequent words whose two phrases of m - 1 words are known (all, if ``known`` is None), merged from the quotient
    filters of the tasks: ``key`` (language code and quotient), remainder, count; only counts of at least ``MIN_COUNT``."""
    shared = encoded.sparkSession.sparkContext.broadcast(None if known is None else known.sets)
    width = width_of(m, bits)
    one = _parts(width)[1] <= 63  # the remainder fits one long
    names = ["key", "rem_lo", "f"] if one else ["key", "rem_hi", "rem_lo", "f"]
    schema = ", ".join(f"{n} {'int' if n == 'key' else 'long'}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = None if shared.value is None else Known([], np.zeros(0, np.uint64), np.zeros(0, np.uint64), shared.value)
        for batch in batches:
            langs = np.asarray(batch.column(0).to_pylist(), object)
            blobs = batch.column(1).to_pylist()
            for lang in set(langs.tolist()):
                ids = np.concatenate([np.frombuffer(blobs[i], "<i4") for i in np.flatnonzero(langs == lang)]).astype(np.uint64)
                zeros = np.concatenate([[0], np.cumsum(ids == 0)])
                starts = np.flatnonzero(zeros[m:] - zeros[:-m] == 0)
                if have is not None and len(starts):
                    ok = have.has(lang, *pack(ids, starts, m - 1, bits)) & have.has(lang, *pack(ids, starts + 1, m - 1, bits))
                    starts = starts[ok]
                if not len(starts):
                    continue
                q, rh, rl, c = quotient_filter(*pack(ids, starts, m, bits), width)
                cols = {"key": (q | np.int32(codes[lang] << QUOTIENT_BITS)).astype(np.int32), "rem_hi": rh, "rem_lo": rl, "f": c}
                yield pa.RecordBatch.from_arrays([pa.array(cols[n]) for n in names], names=names)

    counted = encoded.mapInArrow(run, schema)
    return counted.groupBy(*names[:-1]).agg(F.sum("f").alias("f")).where(F.col("f") >= MIN_COUNT)


def _decoded(merged: DataFrame, m: int, bits: int, codes: dict[str, int]) -> DataFrame:
    """Frequent phrases of a level: language, m, ids, packed halves, count."""
    width = width_of(m, bits)
    langs = {c: lang for lang, c in codes.items()}
    one = "rem_hi" not in merged.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            rl = batch.column("rem_lo").to_numpy()
            rh = np.zeros_like(rl) if one else batch.column("rem_hi").to_numpy()
            hi, lo = restore(key & ((1 << QUOTIENT_BITS) - 1), rh, rl, width)
            ids = unpack(hi, lo, m, bits).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([langs[int(k) >> QUOTIENT_BITS] for k in key], pa.string()), pa.array(np.full(len(key), m, np.int32)),
                                              pa.array(list(ids), pa.list_(pa.int32())), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), batch.column("f")],
                                             names=["lang", "m", "ids", "hi", "lo", "f"])

    return merged.mapInArrow(run, "lang string, m int, ids array<int>, hi long, lo long, f long")


def frequent_phrases(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grams, vocabulary, totals): every phrase of 1 to ``MAX_WORDS`` words with count at least ``MIN_COUNT`` per language
    (``lang, m, ids, f``), the ids of frequent words (``lang, word, id, f``) and the words of each language (``lang, n``)."""
    spark = docs.sparkSession
    counts = written(_words(docs).groupBy("lang", "word").agg(F.count("*").alias("f")), "collocation_words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS))
    ranked = counts.where(F.col("f") >= MIN_COUNT).withColumn("bucket", bucket)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("word")))
    vocab = written(ranked.select("lang", "word", ((F.col("rank") - 1) * BUCKETS + F.col("bucket") + 1).cast("int").alias("id"), "f"), "collocation_vocabulary")
    size, top = vocab.agg(F.count("*"), F.max("id")).first()
    grams = vocab.select("lang", F.lit(1).alias("m"), F.array("id").alias("ids"), "f")
    if not size:
        return grams, vocab, totals
    if size > BROADCAST_WORDS:
        raise ValueError(f"{size} frequent words; the vocabulary travels to the tasks up to {BROADCAST_WORDS}")
    bits = int(top).bit_length()
    if bits * MAX_WORDS > 128:
        raise ValueError(f"ids of {bits} bits do not pack {MAX_WORDS} words into 128 bits")
    words: dict[str, dict[str, int]] = {}
    for lang, word, i in vocab.select("lang", "word", "id").toLocalIterator():
        words.setdefault(lang, {})[word] = i
    codes = {lang: c for c, lang in enumerate(sorted(words))}
    if len(codes) > 1 << (31 - QUOTIENT_BITS):
        raise ValueError(f"{len(codes)} languages; the filter key holds {1 << (31 - QUOTIENT_BITS)}")
    encoded = written(_encode(docs, words), "collocation_ids")
    level = vocab.select("lang", F.col("id").cast("long").alias("hi"))
    known_rows = [(r.lang, 0, r.hi) for r in level.toLocalIterator()]
    for m in range(2, MAX_WORDS + 1):
        known = None
        if known_rows is not None:
            known = Known([r[0] for r in known_rows], np.array([r[1] for r in known_rows], np.int64).view(np.uint64), np.array([r[2] for r in known_rows], np.int64).view(np.uint64))
        found = written(_decoded(_count_level(encoded, m, bits, known, codes), m, bits, codes), f"collocation_level_{m}")
        grams = grams.unionByName(found.select("lang", "m", "ids", "f"))
        many = found.count()
        if not many:
            break
        known_rows = [(r.lang, r.hi, r.lo) for r in found.select("lang", "hi", "lo").toLocalIterator()] if many <= BROADCAST_GRAMS else None
    return grams, vocab, totals


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of each language.

    ``docs``: ``text`` and ``lang``; null texts are empty, a null language is ``und``, other columns are ignored. Repeated rows count
    as often as they occur. Candidates are phrases of 2 to ``MAX_WORDS`` words seen at least ``MIN_COUNT`` times; one that lies
    contiguously inside a longer candidate seen as often is dropped. The cut with the lowest score counts, ties to the shortest
    first part; rows are ordered by score and count descending, then phrase in UTF-8 byte order. A table without such
    phrases, or an empty table, gives no rows.
    """
    grams, vocab, totals = frequent_phrases(docs)
    grams = written(grams, "collocation_grams")
    cands = grams.where("m >= 2").select("lang", "ids", F.col("f").alias("a"))
    longer = grams.where("m >= 3").select("lang", F.col("ids").alias("big"), F.col("f").alias("big_f"))
    subs = longer.select("lang", F.slice("big", 1, F.size("big") - 1).alias("ids"), "big_f").unionByName(
        longer.select("lang", F.slice("big", 2, F.size("big") - 1).alias("ids"), "big_f"))
    inside = cands.join(subs, ["lang", "ids"]).where(F.col("big_f") * 100 >= F.col("a") * 100).select("lang", "ids").distinct()
    kept = cands.join(inside, ["lang", "ids"], "left_anti")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ids", 1, F.col("k")).alias("left"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("right"))
    counts = grams.select("lang", "ids", "f")
    cuts = cuts.join(counts.withColumnRenamed("ids", "left").withColumnRenamed("f", "l"), ["lang", "left"]).join(counts.withColumnRenamed("ids", "right").withColumnRenamed("f", "r"), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    big = "decimal(38,0)"
    score = F.expr(f"(cast(1000 as {big}) * cast(a as {big}) * cast(n as {big})) div (cast(l as {big}) * cast(r as {big}))")
    best = cuts.select("lang", "ids", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "ids", "a", "n").agg(F.min("cut").alias("cut"))
    words = vocab.select("lang", F.col("id").alias("word_id"), "word")
    spelled = best.select("lang", "ids", F.posexplode("ids").alias("pos", "word_id")).join(F.broadcast(words), ["lang", "word_id"])  # size checked above
    phrases = spelled.groupBy("lang", "ids").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rows = best.join(phrases, ["lang", "ids"]).select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])
