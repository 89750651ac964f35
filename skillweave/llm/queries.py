"""One registered query per operator, over whole tables, and the SQL twin where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm import bestfit, chat, collocations, deobfuscate, debruijn, digest_index, fertility, packing, piece_lattice, repair, simhash, warc, wrapper
from skillweave.llm.common import table


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.fitted_fertility(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json"))


def op2_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deobfuscate.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.exact_dedup(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = debruijn.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_pages(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_page").alias("refers_to"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.drop("ids")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op8_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = spark.sql("SELECT -7L AS conv_id, stack(2, 0L, 'user', '</s>[INST] ok [/INST]', 1L, 'assistant', '</s>[INST] ok [/INST]') AS (turn, role, text)")
    return chat.read_back(chat.format_conversations(given.unionByName(fixed)))


def op10_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_lattice.encode(table(spark, sf_dir, "documents"), path)
    counted = encoded.select("doc_id", "n_words", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "ids")
    return piece_lattice.decode(counted, path).select("doc_id", "n_words", "n_pieces", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def op12_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).drop("doc_tokens")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_fertility, op2_deobfuscation, op3_exact_dedup, op4_substring_dedup, op5_warc, op6_packing, op7_simhash, op8_wrapper, op9_chat, op10_piece_lattice, op11_repair, op12_bestfit, op13_collocations)}

ORACLES = {
    "op13_collocations": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
        s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
        g AS (SELECT lang, ws[i:i + m - 1] AS g, count(*) AS f FROM s, (VALUES (1), (2), (3), (4), (5)) v(m) WHERE i + m - 1 <= len(ws) GROUP BY ALL),
        tot AS (SELECT lang, sum(f) AS n FROM g WHERE len(g) = 1 GROUP BY lang),
        fr AS (SELECT * FROM g WHERE f >= 100),
        c AS (SELECT lang, g, f AS a, ' ' || array_to_string(g, ' ') || ' ' AS padded FROM fr WHERE len(g) >= 2),
        kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS o WHERE o.lang = c.lang AND len(o.g) > len(c.g) AND contains(o.padded, c.padded) AND 100 * o.a >= 100 * c.a)),
        cuts AS (SELECT kept.lang, kept.g, kept.a, k FROM kept, (VALUES (1), (2), (3), (4)) v(k) WHERE k < len(kept.g)),
        sc AS (SELECT cuts.lang, cuts.g, cuts.a, k, l.f AS l, r.f AS r, tot.n,
                      (1000::HUGEINT * cuts.a * tot.n) // (l.f::HUGEINT * r.f) AS score
               FROM cuts JOIN fr AS l ON l.lang = cuts.lang AND l.g = cuts.g[1:k] JOIN fr AS r ON r.lang = cuts.lang AND r.g = cuts.g[k + 1:] JOIN tot ON tot.lang = cuts.lang),
        b AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS pick FROM sc),
        ranked AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score,
                          row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM b WHERE pick = 1)
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000""",
    "op3_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""",
    "op5_warc": """
        WITH t AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM t),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes < 1000 OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
        FROM g""",
    "op9_chat": """
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, length(replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')) + 23 AS chars,
            CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss FROM t)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            sum(length(loss))::BIGINT AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
            sum(chars)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
}
