"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavespark.llm.common import crc_remainder, table
from pavespark.llm.langid import Model


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies; the package has to be installed on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.pii_crf import found, trained

    documents = table(spark, sf_dir, "documents")
    return found(documents, trained(documents))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.packing import packed

    return packed(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.warc_index import capture_index

    return capture_index(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "capture_seq")


def toxicity_model(documents: DataFrame, labels: DataFrame) -> dict[str, float]:
    """Weights from the labels of the three quarters that are not held out."""
    from pavespark.llm.toxicity import trained

    known = labels.where(crc_remainder(4) != 2).select("doc_id", F.col("toxic").alias("label"))
    return trained(documents, known)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.toxicity import scored

    documents = table(spark, sf_dir, "documents")
    weights = toxicity_model(documents, table(spark, sf_dir, "labels"))
    return scored(documents, weights, crc_remainder(4) == 2)


def language_model(documents: DataFrame) -> Model:
    """A model from the two thirds of the rows that are not held out."""
    from pavespark.llm.langid import trained

    known = documents.where("text IS NOT NULL AND lang IS NOT NULL").where(crc_remainder(3) != 1)
    return trained(known.select("doc_id", "text", "lang"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.langid import identified

    documents = table(spark, sf_dir, "documents")
    return identified(documents, language_model(documents), crc_remainder(3) == 1)


def op6_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.weak_rules import judged

    return judged(table(spark, sf_dir, "documents"))


def op7_topk_bnb(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.topk_bnb import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_bpe_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.bpe_count import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.byte_bpe import round_trip_digests

    return round_trip_digests(table(spark, sf_dir, "documents"),
                              vocabulary("byte_bpe_multi_50k.tiktoken"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.whitening import whitened

    return whitened(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.divergence import divergence

    return divergence(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pavespark.llm.license_scan import scanned

    return scanned(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_index": op1_warc_index,
    "op2_toxicity": op2_toxicity,
    "op3_pii_crf": op3_pii_crf,
    "op4_packing": op4_packing,
    "op5_langid": op5_langid,
    "op6_weak_rules": op6_weak_rules,
    "op7_topk_bnb": op7_topk_bnb,
    "op8_near_dup": op8_near_dup,
    "op9_bpe_count": op9_bpe_count,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_whitening": op11_whitening,
    "op12_source_divergence": op12_source_divergence,
    "op13_license_scan": op13_license_scan,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def license_sql() -> str:
    """Every block of every text against every template, without an index or a filter."""
    from pavespark.llm import license_scan as ls

    def strings(words: list[bytes]) -> str:
        return "[" + ", ".join(f"'{w.decode()}'" for w in words) + "]"

    named = ", ".join(f"({strings(ls.words_of(p))}, '{label}')" for p, label in ls.PHRASES)
    templates = []
    for number, (label, text) in enumerate(ls.TEMPLATES):
        words = ls.words_of(text)
        templates.append(f"({number}, '{label}', {strings(sorted(set(words)))}, "
                         f"{1 << (len(words) - 1).bit_length()}, {ls.needed(len(set(words)), ls.THRESHOLD)})")
    return f"""
        WITH w AS (
            SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM documents),
        named(phrase, label) AS (VALUES {named}),
        templates(number, label, own, size, need) AS (VALUES {", ".join(templates)}),
        base AS (
            SELECT id, i - 1 AS place, label
            FROM (SELECT id, words, unnest(range(1, len(words) + 1)) AS i FROM w), named
            WHERE words[i] = phrase[1] AND list_slice(words, i, i + len(phrase) - 1) = phrase),
        blocks AS (
            SELECT id, size, list_distinct(list_slice(words, k * size + 1, (k + 2) * size)) AS block
            FROM (SELECT id, words, size, unnest(range(0, greatest(1, (len(words) + size - 1) // size))) AS k
                  FROM w, (SELECT DISTINCT size FROM templates))),
        met AS (
            SELECT id, label, max(len(list_intersect(block, own)) / len(own)) AS share
            FROM blocks JOIN templates USING (size)
            WHERE len(list_intersect(block, own)) >= need GROUP BY ALL),
        said AS (SELECT id, label FROM base UNION SELECT id, label FROM met)
        SELECT doc_id, len(words) AS n_words,
               (SELECT count(*) FROM base b WHERE b.id = w.id) AS n_base,
               (SELECT min(place) FROM base b WHERE b.id = w.id) AS first_word,
               (SELECT max(place) FROM base b WHERE b.id = w.id) AS last_word,
               coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM base b WHERE b.id = w.id), '')
                   AS base_labels,
               coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM said s WHERE s.id = w.id), '') AS labels,
               CASE WHEN EXISTS (SELECT 1 FROM base b WHERE b.id = w.id) THEN 1.0::DOUBLE
                    ELSE coalesce((SELECT max(share) FROM met m WHERE m.id = w.id), 0)::DOUBLE END AS score
        FROM w
    """


ORACLE: dict[str, str] = {
    "op1_warc_index": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url,
                   octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
        k AS (
            SELECT *, max(page_id) OVER (PARTITION BY html) AS original,
                   array_to_string(list_reverse(string_split(lower(regexp_extract(url,
                       '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^#]*)', 1)), '.')), ',') || ')' ||
                   regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^#]*)', 2) AS url_key
            FROM p)
        SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END
                   AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to,
               url_key, row_number() OVER (ORDER BY url_key, page_id) - 1 AS capture_seq
        FROM k
    """,
    "op8_near_dup": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle,
                   least(len(words), 5) AS k
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i
                  FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.k = b.k AND a.doc_id <> b.doc_id
            JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n
            HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
        reach AS (
            SELECT doc_id AS x, doc_id AS y FROM w
            UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
        SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.y) AS component_id,
               w.doc_id = min(reach.y) AS kept
        FROM w JOIN reach ON reach.x = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
        GROUP BY w.doc_id
    """,
    "op7_topk_bnb": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (SELECT vec_id, len(q) AS n, unnest(q) AS x, unnest(range(len(q))) AS i FROM v),
        scored AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
            FROM parts a JOIN parts b ON a.i = b.i AND a.n = b.n AND a.vec_id <> b.vec_id
            WHERE a.vec_id % 20 = 0 GROUP BY ALL),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM scored)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op12_source_divergence": f"""
        WITH d AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
        t AS (
            SELECT id, lang, source, unnest(regexp_extract_all(
                text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 30),
        kinds AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
        cells AS (
            SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n
            FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
        p AS (
            SELECT *, 1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p
            FROM cells JOIN kinds USING (lang)),
        q AS (
            SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
            FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) JOIN kinds USING (lang)),
        far AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
              FROM found)
        WHERE part = 'pair' OR rank <= 50
    """,
    "op13_license_scan": license_sql(),
}
