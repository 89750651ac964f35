"""Toxicity of texts whose words may be disguised (operator 2).

A noisy channel turns letters into look-alikes, repeats them, or puts separators between them. Spans that may have
passed it become a lattice of letters; a Viterbi decoder picks the path with the best sum of channel costs and
log-probability under a character trigram model, which is counted over all words of all documents. What remains are plain
words, and these are scored.

The scorer is a logistic regression on words and beginnings of words. It is fitted on a bounded sample of labelled rows, in which near copies
count once, and on the features that lean most to toxic rows there.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillweave.session import written

SAMPLE_ROWS = 20_000  # labelled rows the scorer is fitted on, at most
MAX_FEATURES = 500  # of the scorer
MIN_SUPPORT = 4
MIN_LEAN = 5.0  # standard deviations above what the share of toxic rows predicts
RIDGE = 0.05
THRESHOLD = 0.7

# Letters with a symbol of their own in the character model, and look-alikes of letters.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = " .-_*~'"

SIZE = 64
_EDGE, _OTHER = 0, 63
_CODES = np.full(0x180, _OTHER, np.int64)
_CODES[[ord(c) for c in LETTERS]] = np.arange(1, len(LETTERS) + 1)
_AT = {c: i + 1 for i, c in enumerate(LETTERS)}

_TRIM = "".join(c for c in "!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~«»“”„’…¿·")
_SUSPECT = re.compile(r"[^\W\d_][\d@$!|+(€£¡.\-_*~']+[^\W\d_]|^[\d@$|+€£]+[^\W\d_]|[^\W\d_][\d@$€£]+$|([^\W\d_])\1\1")
_SPACED = re.compile(r"(?<!\S)(?:[^\s.\-_*~'][ .\-_*~']{1,3}){2,}[^\s.\-_*~'](?!\S)")
_LETTER_RUN = re.compile(r"[^\W\d_]+")


def gram_counts(words: Counter[str]) -> np.ndarray:
    """Weighted counts of three symbols in a row; each run of letters stands between edges."""
    runs: Counter[str] = Counter()
    for word, n in words.items():
        for run in _LETTER_RUN.findall(word):
            runs[run] += n
    if not runs:
        return np.zeros(SIZE**3, np.int64)
    points = np.frombuffer("".join(f"\0\0{r}" for r in runs).encode("utf-32-le") + b"\0" * 8, "<u4").astype(np.int64)
    symbols = np.where(points == 0, _EDGE, np.where(points < len(_CODES), _CODES[np.minimum(points, len(_CODES) - 1)], _OTHER))
    weights = np.repeat(np.fromiter(runs.values(), np.int64), np.fromiter((len(r) + 2 for r in runs), np.int64))
    weights = np.r_[weights, 0, 0]
    grams = (symbols[:-2] * SIZE + symbols[1:-1]) * SIZE + symbols[2:]
    use = (symbols[1:-1] != _EDGE) | (symbols[:-2] == _EDGE) & (symbols[2:] != _EDGE)
    return np.bincount(grams[use], weights[:-2][use], SIZE**3).astype(np.int64)


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-probability of a symbol after two others, from the words of every document.

    The table has 64 x 64 x 64 cells whatever the size of the corpus; tasks send their sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words = np.zeros(SIZE**3, np.int64), Counter()
        for batch in batches:
            for text in batch.column(0):
                words.update((text.as_py() or "").lower().split())
                if len(words) > 150_000:
                    total += gram_counts(words)
                    words = Counter()
        total += gram_counts(words)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(SIZE**3)
    n[counted["gram"].to_numpy(np.int64)] = counted["n"].to_numpy(np.float64)
    n = n.reshape(SIZE, SIZE, SIZE)
    pair = n.sum(axis=0)
    one = pair.sum(axis=0) + 1.0
    p1 = one / one.sum()
    p2 = (pair + 4.0 * p1) / (pair.sum(axis=1, keepdims=True) + 4.0)
    p3 = (n + 4.0 * p2[None]) / (n.sum(axis=2, keepdims=True) + 4.0)
    return np.log(p3).astype(np.float32)


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Readings of each character with their channel costs; an empty reading leaves it out."""
    out: list[list[tuple[str, float]]] = []
    for i, ch in enumerate(span):
        readings = []
        run = i > 0 and span[i - 1] == ch and (i > 1 and span[i - 2] == ch or i + 1 < len(span) and span[i + 1] == ch)
        if ch.isalpha():
            readings.append((ch, 0.0 if not run else 0.5))
        for letter in LOOK_ALIKES.get(ch, ""):
            readings.append((letter, 1.0))
        if run:
            readings.append(("", 0.3))
        if ch in SEPARATORS:
            readings.append(("", 0.5))
        out.append(readings or [("", 4.0)])
    return out


def restore(span: str, model: np.ndarray) -> str:
    """The best path through the lattice of ``span``; equal sums: the first in the order of symbols."""
    best: dict[tuple[int, int], tuple[float, str]] = {(_EDGE, _EDGE): (0.0, "")}
    for readings in lattice(span):
        nxt: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, text) in best.items():
            for letter, cost in readings:
                if letter:
                    c = _AT.get(letter, _OTHER)
                    state, value, more = (b, c), score - cost + float(model[a, b, c]), text + letter
                else:
                    state, value, more = (a, b), score - cost, text
                if state not in nxt or (-value, more) < (-nxt[state][0], nxt[state][1]):
                    nxt[state] = (value, more)
        best = nxt
    ends = [(-(s + float(model[a, b, _EDGE])), t) for (a, b), (s, t) in best.items()]
    return min(ends)[1]


def features(word: str) -> list[str]:
    """A plain word and its beginnings."""
    return [word] + [word[:n] + "*" for n in range(4, 9) if len(word) >= n]


class Restored(dict):
    """Plain words behind a token as it stands in a text (in lower case); forgets all at ``bound`` tokens."""

    def __init__(self, model: np.ndarray, view: Callable[[tuple[str, ...]], object] = lambda words: words, bound: int = 200_000):
        super().__init__()
        self.model, self.view, self.bound = model, view, bound

    def plain(self, token: str) -> tuple[str, ...]:
        core = token.strip(_TRIM)
        found = _LETTER_RUN.findall(core)
        if _SUSPECT.search(core):
            found.append(restore(core, self.model))
        return tuple(found)

    def __missing__(self, token: str) -> object:
        if len(self) >= self.bound:
            self.clear()
        self[token] = value = self.view(self.plain(token))
        return value

    def spaced(self, text: str) -> Iterator[str]:
        """Words written letter by letter; a one-letter word before them may belong to the run, so its tails count as well."""
        for span in _SPACED.findall(text):
            word = restore(span, self.model)
            yield from (word[i:] for i in range(max(1, len(word) - 2)))

    def all(self, text: str | None) -> set[str]:
        """Every plain word of a text."""
        low = (text or "").lower()
        words = {w for token in set(low.split()) for w in self.plain(token)}
        return words | set(self.spaced(low))


def learnable(doc_id: Column | str) -> Column:
    return F.pmod(F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")), F.lit(3)) != 1


def signature(text: str | None) -> int:
    """The least hash of three words in a row: near copies mostly share it, other texts do not."""
    words = (text or "").lower().encode().split()
    return min((zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0)


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample_rows: int = SAMPLE_ROWS) -> dict[str, float]:
    """Weights of features, and the constant under the empty name, from at most ``sample_rows`` labelled documents.

    The rows are those with the least hashes of their id among all that may be learnt from. Of near copies one is learnt from.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(learnable("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Restored(shared.value)
        parts = (batch.slice(at, 100) for batch in batches for at in range(0, batch.num_rows, 100))
        for part in parts:
            rows = [(i, x, signature(t), sorted({f for w in words.all(t) for f in features(w)})) for i, x, t in zip(*(c.to_pylist() for c in part.columns), strict=True)]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "toxic", "alike", "found"])

    found = written(texts.select("doc_id", F.col("toxic").cast("int"), "text").mapInArrow(run, "doc_id long, toxic int, alike long, found array<string>"), "features")
    one = found.groupBy("alike").agg(F.min("doc_id").alias("doc_id"))
    found = written(found.join(F.broadcast(one), ["alike", "doc_id"]).dropDuplicates(["doc_id"]), "features")
    rows = found.select("doc_id", "toxic").toPandas()
    share = float(rows["toxic"].mean()) if len(rows) else 0.0
    if not 0 < share < 1:
        return {"": -4.0 if share == 0 else 4.0}
    pairs = found.select("doc_id", "toxic", F.explode("found").alias("feature"))
    counts = pairs.groupBy("feature").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    lean = (F.col("bad") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    best = counts.where(F.col("bad") >= MIN_SUPPORT).withColumn("lean", lean).where(F.col("lean") >= MIN_LEAN).orderBy(F.desc("lean"), "feature").limit(MAX_FEATURES)
    met = pairs.join(F.broadcast(best.select("feature")), "feature").select("doc_id", "feature").toPandas()
    return _fit(rows, met)


def _fit(rows: pd.DataFrame, met: pd.DataFrame) -> dict[str, float]:
    """Ridge logistic regression by Newton steps; the constant is not drawn to zero."""
    names = sorted(set(met["feature"]))
    x = np.zeros((len(rows), len(names) + 1), np.float32)
    x[:, -1] = 1
    at = {d: i for i, d in enumerate(rows["doc_id"])}
    column = {f: j for j, f in enumerate(names)}
    x[met["doc_id"].map(at).to_numpy(int), met["feature"].map(column).to_numpy(int)] = 1
    y = rows["toxic"].to_numpy(np.float32)
    w = np.zeros(x.shape[1])
    w[-1] = math.log(y.mean() / (1 - y.mean()))
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - ridge * w
        hessian = (x * (p * (1 - p))[:, None].astype(np.float32)).T @ x + np.diag(ridge)
        move = np.linalg.solve(hessian, gradient)
        w += move
        if np.abs(move).max() < 1e-4:
            break
    return {f: float(w[j]) for f, j in column.items()} | {"": float(w[-1])}


def scorer(docs: DataFrame, labels: DataFrame) -> Callable[[Column | str], Column]:
    """A column function from text to score; model and features are learnt here."""
    model = character_model(docs)
    weights = learn(docs, labels, model)
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, weights = shared.value

        def hits(words: tuple[str, ...]) -> tuple[str, ...] | None:
            return tuple(f for w in words for f in features(w) if f in weights) or None

        words = Restored(model, hits)
        for texts in batches:
            out = []
            for text in texts:
                low = (text or "").lower()
                found = {f for x in map(words.__getitem__, set(low.split())) if x for f in x}
                for word in words.spaced(low):
                    found.update(hits((word,)) or ())
                out.append(1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, weights[""] + sum(weights[f] for f in sorted(found)))))))
            yield pd.Series(out, dtype="float64")

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row as ``doc_id, held_out, score, predicted``.

    A null or empty text has no feature and gets the score of the constant alone, as do texts without letters. Null labels and labels of ids that
    are not there teach nothing; with labels of one kind only every score is the same. A null id is not held out. Of labels that disagree
    the toxic one counts. Repeated rows get equal scores; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    score = scorer(rows, labels)
    held = F.coalesce(~learnable("doc_id"), F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), score("text").alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns."""
    score = scorer(docs.select("doc_id", "text"), labels)
    return docs.where(score(F.col("text").cast("string")) < THRESHOLD)
