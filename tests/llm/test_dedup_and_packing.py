"""Operators 3, 4, 6 and 7 against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from skillweave.llm import debruijn, digest_index, packing, queries, simhash
from skillweave.llm.graph import components

SPACE = re.compile("[\x20\x09-\x0d]+")
WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = [(1, None, 1), (2, "", 2), (3, " \n ", 3), (4, "a  b", 4), (5, "a\tb", 5), (5, "a\tb", 5), (None, "a b", 6), (None, "lone", 7), (8, "x" * 5000, 8), (9, "é ß " * 300, 9)]
EDGE = "doc_id long, text string, digest long"


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10_000 + i, ("shared words " + " ".join(f"p{j}" for j in range(60 + i % 3)))) for i in range(150)], "doc_id long, text string")
    )


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, EDGE)


def digest(text):
    return hashlib.sha256(SPACE.sub(" ", text or "").encode()).hexdigest()


def test_exact_dedup(docs, texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[digest(t)].append(i)
    expect = {(i, min(groups[digest(t)]), len(groups[digest(t)]), min(groups[digest(t)]) == i, digest(t)) for i, t in texts}
    assert {tuple(r) for r in digest_index.exact_dedup(docs).collect()} == expect


def test_exact_dedup_odd_rows(spark, odd):
    got = digest_index.exact_dedup(odd).collect()
    assert Counter(r.text_sha256 for r in got) == Counter(digest(t) for _, t, _ in ODD)
    assert sum(r.kept for r in got) == len({digest(t) for _, t, _ in ODD})
    assert {r.keep_id for r in got if r.text_sha256 == digest("a b")} == {4}
    kept = digest_index.drop_exact_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len({digest(t) for _, t, _ in ODD})
    empty = spark.createDataFrame([], EDGE)
    assert digest_index.exact_dedup(empty).count() == 0 == digest_index.drop_exact_copies(empty).count()


def test_index_outlives_its_session_and_takes_more(spark, odd, tmp_path):
    path = str(tmp_path / "index")
    digest_index.exact_dedup(odd, digest_index.DigestIndex(spark, path, 4))
    again = digest_index.DigestIndex(spark.newSession(), path, 4)
    more = again.spark.createDataFrame([(0, "a b"), (99, "new text"), (98, "new  text")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.kept) for r in digest_index.exact_dedup(more, again).collect()}
    assert got == {0: (4, False), 98: (98, True), 99: (98, False)}
    assert again.table().count() == len({digest(t) for _, t, _ in ODD}) + 1


def removed(texts, width=35):
    words = [WORD.findall(t or "") for _, t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (key, _), w in zip(texts, words, strict=True):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), kept))
    return out


def test_substring_dedup(docs, texts):
    got = sorted(tuple(r) for r in debruijn.substring_dedup(docs).collect())
    expect = sorted(removed(texts))
    assert got == expect
    assert any(0 < gone < n for _, n, gone, _ in expect)


def test_substring_dedup_branches_and_overlaps(spark):
    a = [f"a{i}" for i in range(120)]
    rows = [a, a[:80] + ["x"] + a[81:], a[20:70], ["q"] + a[40:75] + ["z"], ["r"] + a[41:75] + ["s"], ["o"] * 90, ["b", "c"] * 30, a[:34], [], a, a[60:] + a[:60]]
    texts = [(i, " \n".join(w)) for i, w in enumerate(rows)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert sorted(tuple(r) for r in debruijn.substring_dedup(df).collect()) == sorted(removed(texts))


def test_substring_dedup_odd_rows(spark, odd):
    rows = [(i, t) for i, t, _ in ODD] + [(8, "y " * 60), (8, " ".join(map(str, range(70)))), (8, " ".join(map(str, range(70))))]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, row int, spans string")
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in debruijn.substring_dedup(df).collect()), key=key) == sorted(removed(rows), key=key)
    left = debruijn.without_repeats(df)
    assert left.columns == df.columns and left.count() == df.count()
    assert debruijn.substring_dedup(spark.createDataFrame([], EDGE)).count() == 0


def test_pieces_are_whole_and_gapless(docs, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts}
    pieces = packing.pack(docs, path).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes())
        assert p.doc_tokens == len(ids[p.doc_id])
    assert by_doc.keys() == ids.keys()
    for key, parts in by_doc.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.length > 0
            at += p.length
        assert at == len(ids[key])
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 4096 or at & (at - 1) == 0


def test_packing_odd_rows(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(odd, path).collect()
    assert sum(p.length for p in pieces if p.doc_id == 1) == 1
    assert sum(p.start == 0 for p in pieces) == len(ODD)
    assert packing.pack(spark.createDataFrame([], EDGE), path).count() == 0


def test_assignment_balances_cost():
    lengths = [4096, 3000, 2000, 1500, 1000, 596, 96, 4, 1, 9000]
    parts = list(packing.assign(lengths))
    assert sum(p[2] for p in parts) == sum(lengths)
    assert packing.capacities(0) == [] and packing.capacities(4097) == [4096, 1]
    alone = [d for d, _, n, s, _ in parts if n == 4096]
    assert set(alone) == {0, 9}


def finger(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(found):
    """Least id by component over (id, fingerprint) rows."""
    fps = sorted({f for _, f in found})
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                root[top(a)] = top(b)
    least = {}
    for i, f in found:
        if i is not None:
            least[top(f)] = min(i, least.get(top(f), i))
    return [(i, f"{f:016x}", least.get(top(f))) for i, f in found]


def test_simhash_components(docs, texts):
    got = sorted(tuple(r) for r in simhash.simhash_components(docs).collect())
    assert got == sorted(reach([(i, finger(t)) for i, t in texts]))


def test_simhash_odd_rows(spark, odd):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted((tuple(r) for r in simhash.simhash_components(odd).collect()), key=key)
    assert got == sorted(reach([(i, finger(t)) for i, t, _ in ODD]), key=key)
    assert simhash.keep_one_of_each(odd).columns == odd.columns
    assert simhash.simhash_components(spark.createDataFrame([], EDGE)).count() == 0


def test_links_find_every_pair_within_two_bits(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = {int(b) ^ sum(1 << int(x) for x in set(rng.integers(0, 64, 2))) for b in base for _ in range(12)} | {int(b) for b in base}
    signed = [(simhash._signed(f),) for f in near]
    pairs = components(simhash.links(spark.createDataFrame(signed, "fp long"))).collect()
    root = {r.node: r.root for r in pairs}
    got = defaultdict(set)
    for (f,) in signed:
        got[root.get(f, f)].add(f % 2**64)
    expect = defaultdict(set)
    for i, (_, f, c) in enumerate(reach([(i, f) for i, f in enumerate(near)])):
        expect[c].add(int(f, 16))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expect.values()))


def test_masks_cover_all_pairs():
    masks = simhash.covering_masks()
    for a in range(64):
        for b in range(a + 1):
            assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def test_components_of_a_chain(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.node, r.root) for r in components(chain).collect()} == {(i, 0) for i in range(1, 201)}
    assert components(chain.where("a < 0")).count() == 0


def test_ids_of_words_equal_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    words = packing.WordIds(path)
    for text in ["", " ", "The the, THE. don't it's I'm! x1 ²a naïve Straße İstanbul ΣΑΣ éa. a.. b!? 'tis", "Éa éa! <|endoftext|> 日本, l'été a b c", "ſt ŉa Ǆ ß ÿ."]:
        assert words.of(text).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_one_row_of_each_component_stays(spark):
    words = lambda k: " ".join(f"{k}{i * 7 % 31}" for i in range(80))
    rows = [(None, words("a")), (None, words("b")), (None, words("b")), (1, words("c")), (1, words("d")), (2, words("c").upper()), (None, words("d")), (3, words("e")), (3, words("e"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in simhash.keep_one_of_each(docs).collect()]
    expect = [(None, words("a")), (None, words("b")), (1, words("c")), (1, words("d")), (3, words("e"))]
    assert sorted(got, key=repr) == sorted(expect, key=repr)
