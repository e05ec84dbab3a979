"""One registered query per operator, over the whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import arc_warc, block_whitening, bpe_lexicon, cgk_decontam, cross_entropy, fm_quality, ngram_join, pivot_index, quote_links, secret_dfa, storage, token_files, treap_search, wrapper_extract
from cohortlens.llm.registry import register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _word_bpe() -> str:
    import public_tokenizers
    return token_files.tokenizer_text(public_tokenizers.path("word_bpe_49k.json"))


@register("op1_ngram_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(_table(spark, sf_dir, "documents"), storage.work_folder(spark, "op1"), k=4, percent=85)


@register("op2_bpe_lexicon")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, model = _table(spark, sf_dir, "documents"), _word_bpe()
    lexicon = bpe_lexicon.build_lexicon(docs, model, storage.work_folder(spark, "op2"))
    return bpe_lexicon.encode_documents(docs, model, lexicon)


@register("op3_pivot_index")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_duplicates(_table(spark, sf_dir, "embeddings"), storage.work_folder(spark, "op3"), threshold=0.98)


@register("op4_fm_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@register("op5_secret_dfa")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_dfa.secret_digests(_table(spark, sf_dir, "documents"))


@register("op6_cross_entropy")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy.cross_entropy_difference(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "conversations"),
                                                  storage.work_folder(spark, "op6"))


# base32 by twenty bits (five hex digits, four characters) at a time
_OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes,
             list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + CAST(((('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INT), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) AS INT), 1)),
               'string_agg', '') AS payload_digest
      FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM d)
"""


@register("op7_arc_to_warc", _OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = arc_warc.archive_digests(_table(spark, sf_dir, "pages"), storage.work_folder(spark, "op7"), least=0)
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# What linking must find: every turn replies to the one before it, and its own text is left.
_OP8_SQL = """
SELECT c.conv_id, c.turn, c.role, trim(c.text, chr(10)) AS body,
       CAST((p.turn IS NOT NULL)::INT + (pp.turn IS NOT NULL AND p.turn IS NOT NULL)::INT AS INT) AS n_quotes,
       CAST((p.turn IS NOT NULL)::INT + (pp.turn IS NOT NULL AND p.turn IS NOT NULL)::INT AS INT) AS max_level,
       p.conv_id AS reply_conv, p.turn AS reply_turn,
       row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn) AS position
FROM conversations c
LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
LEFT JOIN conversations pp ON pp.conv_id = c.conv_id AND pp.turn = c.turn - 2
"""


@register("op8_quote_links", _OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = quote_links.as_mail(_table(spark, sf_dir, "conversations"))
    return quote_links.link_quotes(mail, storage.work_folder(spark, "op8"))


@register("op9_cgk_decontam")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cgk_decontam.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@register("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = storage.work_folder(spark, "op10")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, _word_bpe(), end_id=1)
    return token_files.token_digests(spark, folder)


@register("op11_wrapper_extract")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper_extract.extract(_table(spark, sf_dir, "pages"), storage.work_folder(spark, "op11"))


@register("op12_block_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_whitening.whiten(_table(spark, sf_dir, "embeddings"), storage.work_folder(spark, "op12"), k=4)


# Every document's terms against every item's, by the formula.
_OP13_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
c AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""


@register("op13_treap_search", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap_search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), storage.work_folder(spark, "op13"), k=20)
