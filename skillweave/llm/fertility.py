"""Quality rules from how public vocabularies split a text (operator 1).

Text that a vocabulary was not made for falls into many short pieces, junk falls into bytes, and text that repeats itself has
a low entropy of pieces. A text is rejected if a measure leaves the band of its script, or falls below what texts of its language
and length have under either of two vocabularies.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillweave.llm.packing import WordIds
from skillweave.session import written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEATED_PERCENT = 50

# Bands per script: characters per piece (least, most), largest share of byte pieces, least entropy of pieces in bits.
# Scripts that the vocabulary mostly spells in bytes have wide ones.
BANDS = {
    "latin": (1.3, 9.0, 0.10, 3.0),
    "cyrillic": (1.2, 8.0, 0.15, 3.0),
    "greek": (0.8, 6.0, 0.30, 3.0),
    "cjk": (0.4, 3.0, 0.75, 3.0),
    "other": (0.3, 9.0, 0.90, 2.0),
}
# Fitted bands end so many standard deviations below the median; the deviation comes from the quartiles and is at least a share of the median.
DEVIATIONS = 3.5
LEAST_SPREAD = 0.01
LEAST_TEXTS = 30  # different texts that a length class needs for a band of its own
FITTED = ("chars_per_piece", "piece_entropy", "second_per_piece", "second_entropy")
_SCRIPTS = {
    "latin": ("AZ", "az", "Àɏ"),
    "cyrillic": ("Ѐԯ",),
    "greek": ("ͰϿ",),
    "cjk": ("぀ヿ", "㐀鿿", "가힯"),
}
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "script string, n_pieces long, chars_per_piece double, byte_share double, piece_entropy double"
)


class Vocabulary:
    """Pieces of numbered words in flat arrays."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            parts = WordIds(path, bound=200_000)
            self.encode = parts.encode
            self.bytes = np.zeros(parts.tokenizer.get_vocab_size(), bool)
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda words: [array("i", found).tobytes() for found in model.encode(words, num_threads=1)]
            self.bytes = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        self.forget()

    def forget(self) -> None:
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> None:
        found = self.encode(words) if words else []
        self.start = np.r_[self.start, self.start[-1] + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)]
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), np.int32)])

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """Pieces of words in a row."""
        counts = self.start[numbers + 1] - self.start[numbers]
        at = np.arange(int(counts.sum())) + np.repeat(self.start[numbers] - (np.cumsum(counts) - counts), counts)
        return self.ids[at]


class Pieces(dict):
    """Word to its number, the same in all vocabularies. Starts anew when ``bound`` words are held; a text's windows allow up to 2,097,152."""

    def __init__(self, *paths: str, bound: int = 600_000):
        super().__init__()
        self.vocabularies = [Vocabulary(path) for path in paths]
        self.bound = bound
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.chars: np.ndarray = np.zeros(0, np.int64)
        for vocabulary in self.vocabularies:
            vocabulary.forget()

    def learn(self, words: list[str]) -> None:
        new = [w for w in words if w not in self]
        if self and len(self) + len(new) > self.bound:
            self.forget()
            new = words
        self.update(zip(new, range(len(self), len(self) + len(new))))
        self.chars = np.r_[self.chars, np.fromiter(map(len, new), np.int64, len(new))]
        for vocabulary in self.vocabularies:
            vocabulary.learn(new)

    def numbered(self, texts: pa.Array) -> list[np.ndarray]:
        """The words of every text by number; words that are new are learnt together, and a word of many texts is looked up once."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.flatten()
        real = pc.greater(pc.binary_length(words), 0)
        ends = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))][np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)]
        coded = words.filter(real).dictionary_encode()
        different = coded.dictionary.to_pylist()
        self.learn(different)
        numbers = np.fromiter(map(self.__getitem__, different), np.int64, len(different))[coded.indices.to_numpy(zero_copy_only=False)]
        return [numbers[a:b] for a, b in zip([0, *ends], ends)]


@lru_cache(maxsize=1)
def _worker_pieces(*paths: str) -> Pieces:
    """Words that a worker has learnt serve its next tasks too."""
    return Pieces(*paths)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: the place of its script in the table or 4, plus 8 for a letter."""
    kinds = np.full(0x110000, len(_SCRIPTS), np.uint8)
    for place, ranges in enumerate(_SCRIPTS.values()):
        for first, last in ranges:
            kinds[ord(first) : ord(last) + 1] = place
    return kinds + 8 * np.fromiter(map(str.isalpha, map(chr, range(0x110000))), np.uint8, 0x110000)


def script_of(text: str) -> str:
    """The script of most letters; ties go to the first in the table, a text without letters is other."""
    kinds = np.bincount(_letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")], minlength=16)
    counts = dict(zip(_SCRIPTS, (kinds[:8] + kinds[8:]).tolist()))
    other = int(kinds[8:].sum()) - sum(counts.values())
    best = max(counts, key=counts.get)
    return best if counts[best] and counts[best] >= other else "other"


def _script(text: str) -> str:
    return "latin" if text.isascii() else script_of(text)


def repeated_words(numbers: np.ndarray) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(numbers) < 4:
        return 0
    n = numbers.astype(np.uint64)
    key = (n[:-2] << np.uint64(42)) | (n[1:-1] << np.uint64(21)) | n[2:]
    _, group, seen = np.unique(key, return_inverse=True, return_counts=True)
    twice = seen[group] > 1
    covered = np.zeros(len(numbers), bool)
    for i in range(3):
        covered[i : len(numbers) - 2 + i] |= twice
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def entropy(ids: np.ndarray) -> float:
    if not len(ids):
        return 0.0
    ordered = np.sort(ids)
    p = np.diff(np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1], True])) / len(ids)
    return float(-(p * np.log2(p)).sum()) + 0.0


def measure_all(texts: list[str | None], pieces: Pieces, bands: dict[str, tuple[float, float, float, float]] = BANDS) -> list[tuple]:
    """The columns of ``SCHEMA`` behind the id, for some texts whose new words are learnt together."""
    return [measure(t or "", numbers, pieces, bands) for t, numbers in zip(texts, pieces.numbered(pa.array(texts, pa.string())), strict=True)]


def measure(text: str, numbers: np.ndarray, pieces: Pieces, bands: dict[str, tuple[float, float, float, float]]) -> tuple:
    repeats = repeated_words(numbers)
    failed = len(numbers) < MIN_WORDS or 100 * repeats > REPEATED_PERCENT * len(numbers)
    vocabulary = pieces.vocabularies[0]
    ids = vocabulary.of(numbers)
    chars = int(pieces.chars[numbers].sum())
    per_piece = chars / len(ids) if len(ids) else 0.0
    share = float(vocabulary.bytes[ids].mean()) if len(ids) else 0.0
    bits = entropy(ids)
    script = _script(text)
    least, most, byte_share, least_bits = bands.get(script, bands["other"])
    inside = least <= per_piece <= most and share <= byte_share and bits >= least_bits
    symbols = sum(map(text.count, SYMBOLS))
    return len(numbers), chars, symbols, repeated_lines(text), repeats, failed, not failed and inside, script, len(ids), per_piece, share, bits


def fertility(docs: DataFrame, model_path: str, bands: dict[str, tuple[float, float, float, float]] = BANDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of words, symbols and repeats, the measures of its pieces, and whether it is kept.

    Words are split at the six ASCII white-space characters and cut into pieces one by one. A null, empty or blank text has no words, measures
    of zero, and is not kept. Repeated rows give equal results; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches):
        pieces = _worker_pieces(model_path)
        parts = (batch.slice(at, 500) for batch in batches for at in range(0, batch.num_rows, 500))
        for part in parts:
            rows = measure_all(part.column(1).to_pylist(), pieces, bands)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=names)

    names = [part.split()[0] for part in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string(), pa.int64()] + [pa.float64()] * 3
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def length_class(n_words: int) -> int:
    """Two classes for every doubling of the words."""
    return int(2 * np.log2(max(n_words, 1)))


def _measured(docs: DataFrame, model_path: str, second_path: str, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The columns of ``SCHEMA`` under the bands per script, the language, the class of length, and the measures under the second vocabulary."""

    def run(batches):
        pieces = _worker_pieces(model_path, second_path)
        parts = (batch.slice(at, 500) for batch in batches for at in range(0, batch.num_rows, 500))
        for part in parts:
            rows = []
            for t, numbers in zip(part.column(1).to_pylist(), pieces.numbered(part.column(1)), strict=True):
                ids = pieces.vocabularies[1].of(numbers)
                more = (length_class(len(numbers)), int(pieces.chars[numbers].sum()) / len(ids) if len(ids) else 0.0, entropy(ids))
                rows.append(measure(t or "", numbers, pieces, BANDS) + more)
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns, part.column(2)], names=names)

    schema = f"{SCHEMA}, length int, second_per_piece double, second_entropy double, lang string"
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string(), pa.int64()] + [pa.float64()] * 3 + [pa.int32()] + [pa.float64()] * 2
    given = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), given.alias("lang")).mapInArrow(run, schema)


def fit_bands(measured: DataFrame) -> DataFrame:
    """``script, lang, length, least``: the least values of ``FITTED`` among texts that the base rules and the bands per script keep.

    Copies count once. Values are counted in cells of 0.001, so quartiles are exact on these and do not depend on the partitioning. A length class
    with few texts takes the band of the next shorter class that has one, which is lower; without one its texts have no fitted band.
    """
    texts = measured.where("kept").select("script", "lang", "length", "n_words", "word_chars", "n_pieces", *FITTED).distinct()
    cells = F.array(*[F.struct(F.lit(i).alias("measure"), F.round(F.col(m), 3).alias("cell")) for i, m in enumerate(FITTED)])
    counted = texts.select("script", "lang", "length", F.explode(cells).alias("c")).groupBy("script", "lang", "length", "c.measure", "c.cell").agg(F.count("*").alias("n"))
    quartiles = counted.groupBy("script", "lang", "length", "measure").agg(F.expr("percentile(cell, array(0.25, 0.5, 0.75), n)").alias("q"), F.sum("n").alias("n"))
    spread = F.greatest((F.get("q", 2) - F.get("q", 0)) / 1.349, F.get("q", 1) * LEAST_SPREAD)
    own = quartiles.groupBy("script", "lang", "length").agg(F.min("n").alias("n"), F.array_sort(F.collect_list(F.struct("measure", (F.get("q", 1) - DEVIATIONS * spread).alias("low")))).alias("bands"))
    bands = own.withColumn("own", F.when(F.col("n") >= LEAST_TEXTS, F.col("bands.low")))
    shorter = Window.partitionBy("script", "lang").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    return bands.select("script", "lang", "length", F.last("own", ignorenulls=True).over(shorter).alias("least")).where("least IS NOT NULL")


def fitted_fertility(docs: DataFrame, model_path: str, second_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """As ``fertility``, and a text is also rejected if it falls below a band fitted to all texts of its script, language and length.

    A null language is one of its own; without the column bands are fitted per script. The bands are a row per script, language and
    length class.
    """
    measured = written(_measured(docs, model_path, second_path, id_col, text_col, lang_col), "fertility")
    met = measured.join(F.broadcast(fit_bands(measured)), ["script", "lang", "length"], "left")
    below = F.lit(False)
    for i, name in enumerate(FITTED):
        below = below | F.coalesce(F.col(name) < F.get("least", i), F.lit(False))
    return met.withColumn("kept", F.col("kept") & ~below).select(*[part.split()[0] for part in SCHEMA.split(", ")])
