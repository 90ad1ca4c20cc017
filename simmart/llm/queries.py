"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from simmart.llm import (
    archive, covertree, language, lexical, neardup, packing, pieces, quality, rollup, spots, substrings, toxicity, variants,
)
from simmart.llm.common import prepared, table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archived(table(prepared(spark), sf_dir, "pages"))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    versions = {"byte_bpe_50k": "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}
    return rollup.maintained(
        table(prepared(spark), sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        {name: tokenizer_file(file) for name, file in versions.items()},
        public_tokenizers.PATTERN,
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    return pieces.encoded(docs, tokenizer_file("piece_bpe_32k.model"), with_ids=False)


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.ring(table(prepared(spark), sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.nearest(table(prepared(spark), sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    return quality.rated(docs, table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(prepared(spark), sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"), with_ids=False)


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(prepared(spark), sf_dir, "documents"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    return substrings.without_repeats(docs, with_text=False)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(prepared(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rated(table(prepared(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(prepared(spark), sf_dir, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_tokens": op2_tokens,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_spotsigs": op4_spotsigs,
    "op5_topk": op5_topk,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_packing": op8_packing,
    "op9_neardup": op9_neardup,
    "op10_substrings": op10_substrings,
    "op11_lexical": op11_lexical,
    "op12_toxicity": op12_toxicity,
    "op13_variants": op13_variants,
}

# SHA-1 in base 32: the bits of the hex digits in groups of five.
_BASE32 = """
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + CAST(list_sum(list_transform(range(5), lambda j:
            (((instr('0123456789abcdef', substr(h, CAST((5 * i + j) // 4 + 1 AS INTEGER), 1)) - 1)
              >> CAST(3 - (5 * i + j) % 4 AS INTEGER)) & 1) * (16 >> CAST(j AS INTEGER)))) AS INTEGER), 1)), '')
"""

ORACLE = {
    "op1_warc": f"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url, sha1(coalesce(html, '')) AS h FROM pages
        ),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to, url
        FROM f
    """,
    "op5_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(d.e AS DOUBLE[])) AS BIGINT) AS score
            FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.e) = len(d.e)
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scored
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
    """,
    "op10_substrings": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ),
        windows AS (
            SELECT doc_id, unnest(range(1, len(words) - 11)) AS i, words FROM w WHERE len(words) >= 13
        ),
        keyed AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS k FROM windows),
        firsts AS (SELECT k, min(doc_id) AS first_id FROM keyed GROUP BY k HAVING min(doc_id) < max(doc_id)),
        gone AS (
            SELECT DISTINCT doc_id, i + unnest(range(13)) AS place
            FROM keyed JOIN firsts USING (k) WHERE first_id < doc_id
        ),
        gone_of AS (SELECT doc_id, list(place) AS places, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
               sha256(coalesce(array_to_string(
                   CASE WHEN places IS NULL THEN words
                        ELSE list_filter(words, lambda x, i: NOT list_contains(places, i)) END, ' '), '')) AS kept_sha256
        FROM w LEFT JOIN gone_of USING (doc_id)
    """,
    "op11_lexical": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ),
        i AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        c AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_all FROM d WHERE len(terms) > 0),
        f AS (
            SELECT row, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
            FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
            WHERE term IN (SELECT term FROM i) GROUP BY row, term
        ),
        w AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM f, c GROUP BY term, n_docs
        ),
        s AS (
            SELECT item_id, row, any_value(doc_id) AS doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_all)))) AS BIGINT) AS score
            FROM i JOIN f USING (term) JOIN w USING (term), c GROUP BY item_id, row
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM s WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
    # The checksum: a byte at a time, by a table made of its polynomial.
    "op13_variants": r"""
        WITH RECURSIVE crc(n, k, c) AS (
            SELECT n, 0, n FROM range(256) t(n)
            UNION ALL
            SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
        ),
        crcs AS (SELECT list(c ORDER BY n) AS t FROM crc WHERE k = 8),
        runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents)
            GROUP BY ALL
        ),
        coded AS (SELECT *, hex(encode(concat(doc_id, ':', run))) AS x FROM runs),
        summed AS (
            SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i:
                16 * (instr('0123456789ABCDEF', substr(x, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(x, 2 * i + 2, 1)) - 1)),
                lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) + 1 AS INTEGER)]))) AS h
            FROM coded, crcs
        ),
        edited AS (
            SELECT n, CASE WHEN h % 31 = 0 THEN concat(left(run, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word
            FROM summed
        ),
        v AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
        ),
        p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
        holes AS (SELECT word, n, concat(left(word, i - 1), '_', substr(word, i + 1)) AS hole FROM p),
        shorter AS (SELECT DISTINCT word, n, concat(left(word, i - 1), substr(word, i + 1)) AS short FROM p),
        pairs AS (
            SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
            UNION ALL SELECT s.word, s.n, v.word, v.n FROM shorter s JOIN v ON v.word = s.short
            UNION ALL SELECT v.word, v.n, s.word, s.n FROM shorter s JOIN v ON v.word = s.short
        ),
        near AS (
            SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n
            FROM pairs GROUP BY word
        ),
        rated AS (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * v.n THEN form END AS form,
                   CASE WHEN form_n >= 10 * v.n THEN form_n END AS form_n
            FROM v LEFT JOIN near USING (word)
        ),
        chain(word, root, k) AS (
            SELECT word, word, 0 FROM v
            UNION ALL
            SELECT chain.word, rated.form, k + 1 FROM chain JOIN rated ON rated.word = chain.root WHERE rated.form IS NOT NULL
        ),
        roots AS (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word)
        SELECT word, form, root, n, n_near, form_n FROM rated JOIN roots USING (word)
    """,
}
