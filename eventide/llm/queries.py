"""Registered queries of the operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import (decontaminate, exact_dedup, jaccard_join, language_id, licenses, packing, resample, sentence_pieces,
                          spelling, suffix_dedup, token_files, topk, warc)
from eventide.llm.common import table

END_ID = 2


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.search(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), END_ID).drop("ids", "width")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), END_ID)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.groups(table(spark, sf_dir, "documents"))
    return out.select(out["id"].alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.groups(table(spark, sf_dir, "documents"), width=4, num=85, den=100)
    return out.select("doc_id", "n_shingles", "component_id")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), min_revisit=1_000)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.spans(table(spark, sf_dir, "documents"), length=400).drop("spans")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(table(spark, sf_dir, "documents"))


def _noisy(doc_id: str) -> Callable[[bytes], bytes]:
    """The query's noise: a letter is left out of one run in 31, by the crc32 of identifier and run."""
    start = crc32(f"{doc_id}:".encode())

    def change(word: bytes) -> bytes:
        h = crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % 31:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1:]

    return change


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), least=7, occurrences=2, ratio=10, change=_noisy)


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, min_words=20,
                         ngrams=1, buckets=10_000, seed=2024)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


_OP1 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""

_OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     r AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
                  CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS response FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response IS NULL OR response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to FROM r
"""

_OP4 = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept, sha256(body) AS text_sha256 FROM n
"""

#: CRC-32 in SQL: its table by rule, then byte by byte.
_CRC = """
RECURSIVE crc_step(b, i, v) AS (
    SELECT b, 0, b::BIGINT FROM range(256) t(b)
    UNION ALL SELECT b, i + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM crc_step WHERE i < 8),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM crc_step WHERE i = 8)
"""


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text's UTF-8 bytes; ``t`` is the table's list."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {octets}), "
            "lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256)))")


_ASCII = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_ASCII}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP11 = rf"""
WITH {_CRC},
     runs AS (SELECT doc_id, unnest(regexp_extract_all({_ASCII}, '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
     -- shorter runs can't give a word
     met AS (SELECT doc_id, w, count(*) AS c FROM runs WHERE length(w) >= 7 GROUP BY ALL),
     hashed AS (SELECT w, c, {_crc32("(coalesce(doc_id::VARCHAR, '') || ':' || w)")} AS h FROM met, crc_table),
     changed AS (SELECT CASE WHEN h % 31 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, c FROM hashed),
     words AS (SELECT word, sum(c)::BIGINT AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
     holes AS (SELECT word, n, i, word[:i - 1] || '*' || word[i + 1:] AS hole, word[:i - 1] || word[i + 1:] AS less
               FROM words, range(1, length(word) + 1) r(i)),
     near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
              UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN words b ON a.less = b.word
              UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN words b ON a.less = b.word),
     best AS (SELECT word, count(*) AS n_near, min({{'less': -other_n, 'word': encode(other)}}) AS b FROM near GROUP BY word),
     formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 10 * n THEN decode(b.word) END AS form,
                       CASE WHEN -b.less >= 10 * n THEN -b.less END AS form_n FROM words w LEFT JOIN best USING (word)),
     chain(word, root, next) AS (
         SELECT word, word, form FROM formed
         UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN formed f ON f.word = c.next)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM chain WHERE next IS NULL) USING (word)
"""

_OP12 = rf"""
WITH {_CRC},
     read AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_WORDS}, []) AS words FROM documents),
     met AS (SELECT r, unnest(words) AS w FROM read),
     wanted AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
     bucket AS (SELECT w, {_crc32("w")} % 10000 AS b FROM (SELECT DISTINCT w FROM (FROM met SELECT w UNION ALL FROM wanted)), crc_table),
     corpus AS (SELECT b, count(*) AS s FROM met JOIN bucket USING (w) GROUP BY b),
     target AS (SELECT b, count(*) AS t FROM wanted JOIN bucket USING (w) GROUP BY b),
     total AS (SELECT (SELECT count(*) FROM met) AS sa, (SELECT count(*) FROM wanted) AS ta),
     gain AS (SELECT b, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (sa + 10000)) / ((coalesce(s, 0) + 1)::DOUBLE * (ta + 10000))))::BIGINT AS g
              FROM (SELECT DISTINCT b FROM bucket) LEFT JOIN corpus USING (b) LEFT JOIN target USING (b), total),
     weighed AS (SELECT r, sum(g)::BIGINT AS weight FROM met JOIN bucket USING (w) JOIN gain USING (b) GROUP BY r),
     scored AS (SELECT doc_id, r, len(words) AS n_features, coalesce(weight, 0) AS weight,
                       coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT + 0.5::DOUBLE)
                                                               / 4294967296::DOUBLE)))::BIGINT AS score
                FROM read LEFT JOIN weighed USING (r)),
     placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) * 10 // 100 FROM placed) THEN rank END AS rank
FROM scored LEFT JOIN placed USING (r)
"""

_OP13 = rf"""
WITH read AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_WORDS}, []) AS words FROM documents),
     items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
     windows AS (SELECT DISTINCT item_id, size, list_slice(words, s + 1, s + size) AS w
                 FROM (SELECT *, least(len(words), 10) AS size FROM items WHERE len(words) > 0), range(0, len(words) - size + 1) t(s)),
     places AS (SELECT r, s, size, list_slice(words, s + 1, s + size) AS w
                FROM read, (SELECT DISTINCT size FROM windows), range(0, len(words) - size + 1) t(s)),
     found AS (SELECT r, s, size, item_id FROM places JOIN windows USING (size, w)),
     hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + size)) AS p FROM (SELECT DISTINCT r, s, size FROM found)) GROUP BY r),
     held AS (SELECT r, list(DISTINCT item_id::VARCHAR) FILTER (item_id IS NOT NULL) AS ids FROM found GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
       sha256(array_to_string(list_sort(coalesce(ids, [])), ',')) AS items_sha256, n IS NOT NULL AS contaminated
FROM read LEFT JOIN hit USING (r) LEFT JOIN held USING (r)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_packing": op2_packing,
    "op3_token_files": op3_token_files,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_licenses": op6_licenses,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_warc": op8_warc,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_language_id": op10_language_id,
    "op11_spelling": op11_spelling,
    "op12_resample": op12_resample,
    "op13_decontaminate": op13_decontaminate,
}

ORACLE_SQL: dict[str, str] = {
    "op1_topk": _OP1,
    "op4_exact_dedup": _OP4,
    "op8_warc": _OP8,
    "op11_spelling": _OP11,
    "op12_resample": _OP12,
    "op13_decontaminate": _OP13,
}
