"""SimHash near-duplicates by covering locality-sensitive hashing (operator 7).

Bit position i of a fingerprint has a label, a non-zero vector of radius + 1 bits. Table v (a non-zero
vector as well) keeps the positions whose label has an odd product with v. Two fingerprints that differ
at no more than ``radius`` positions agree on all kept positions of at least one table: the labels of the
differing positions span less than the whole space, so some v is orthogonal to all of them.

Members of a bucket are never compared pair by pair. Within a bucket, two fingerprints differ only at
the positions that the table leaves out, so each member names itself and its neighbours with one such bit
flipped: two members at distance two or less name a common word, and members that name a common word are at
distance two or less. Everyone who names a word is linked to the least of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillweave.llm.common import join_groups, map_batches, packed, salted
from skillweave.llm.digest_index import text_digest
from skillweave.llm.graph import components
from skillweave.session import written

RADIUS = 2
_CHUNK = 200_000


def fingerprint(text: str | None, width: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of the word shingles; 0 without words."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = max(1, len(words) - width + 1)
    votes = np.zeros(64, np.int64)
    for at in range(0, shingles, _CHUNK):
        part = words[at : at + _CHUNK + width - 1]
        joined = map(b" ".join, zip(*[part[i:] for i in range(width)])) if len(words) >= width else [b" ".join(words)]
        hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in joined], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > shingles, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a long); null text counts as empty."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "fp": np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)}

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, "doc_id long, fp long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One mask of kept bit positions per table; labels go round the non-zero vectors."""
    vectors = range(1, 2 ** (radius + 1))
    labels = [1 + i % len(vectors) for i in range(64)]
    return [sum(1 << i for i in range(64) if bin(labels[i] & v).count("1") % 2) for v in vectors]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame) -> DataFrame:
    """``a``, ``b``: links that connect exactly the distinct fingerprints (``fp``) within two bits, as stars."""
    masks = [_signed(m) for m in covering_masks()]
    tables = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("bucket")) for v, m in enumerate(masks)])
    members = fps.select("fp", F.explode(tables).alias("t")).select("fp", "t.v", "t.bucket")
    shared = members.groupBy("v", "bucket").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("v", "bucket")
    crowded = members.join(shared, ["v", "bucket"])
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64) if not covering_masks()[v] >> i & 1]) for v in range(len(masks))])
    named = crowded.select("v", "fp", F.explode(F.get(flips, F.col("v"))).alias("flip")).select("v", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))
    stars = named.groupBy("v", "word").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("v", "word", "low")
    return named.join(stars, ["v", "word"]).where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as ``doc_id, fingerprint, component_id``, the least id among all rows it can reach by links.

    A link: fingerprints differ at two bits or fewer. Texts without words have fingerprint zero and are linked
    like any other. Null ids take part but are never the least; a component of null ids only has a null id.
    Repeated rows give repeated results; an empty table gives an empty result; other columns are ignored.
    """
    rows = written(fingerprints(docs, id_col, text_col).withColumn("salt", salted(F.monotonically_increasing_id())), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    roots = components(links(fps))
    fps = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = fps.groupBy("root").agg(F.min("least_id").alias("component_id"))
    known = fps.select("fp", "root").join(least, "root").select("fp", "component_id")
    return join_groups(rows, known, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component: that of the least id, null ids last, and of the least text digest among rows that share it.

    Rows meet the verdicts by (id, digest); of rows that repeat both one stays.
    """

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "digest": batch.column(1), "fp": np.array([fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64)}

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest("text").alias("digest"), F.col("text").cast("string").alias("text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("first")
    fps = written(map_batches(given, run, "doc_id long, digest binary, fp long").groupBy("fp").agg(first), "distinct-fingerprints")
    roots = components(links(fps.select("fp"))).withColumnRenamed("node", "fp")
    chosen = fps.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    kept = chosen.select("first.doc_id", "first.digest")
    rows = packed(docs, doc_id=F.col("doc_id").cast("long"), digest=text_digest("text"))
    met = rows.join(kept, rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["digest"] == kept["digest"]), "left_semi")
    one = F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy(F.lit(1)))
    return met.withColumn("nth", one).where("nth = 1").select("row.*")
