"""Registered queries of this package: ``opN_<name>`` and their SQL twins."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import bpe, html_cut, licenses, mixing, pivots, prefix_trie, quality, sharding, simhash, \
    spelling, token_files, toxicity, url_rules
from basketflow.llm.common import stage, table
from basketflow.session import shared_dir

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole document, decode the ids, digest both."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    e = bpe.encode(docs, RANKS, outputs=("n_tokens", "ids_le", "decoded"), keep_text=False)
    return e.select("doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of one label at cosine 0.98 or more."""
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


SQL_OP2 = r"""
WITH RECURSIVE
     v AS (SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
     ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
              AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     l AS (SELECT a.rid, b.rid AS other FROM ok a JOIN ok b
             ON a.label = b.label AND a.rid <> b.rid AND len(a.e) = len(b.e)
             AND list_cosine_similarity(a.e, b.e) >= 0.98),
     r AS (SELECT rid, other FROM l UNION SELECT r.rid, l.other FROM r JOIN l ON l.rid = r.other),
     n AS (SELECT rid, count(*) AS n FROM l GROUP BY rid),
     c AS (SELECT r.rid, min(v.vec_id) AS first FROM r JOIN v ON v.rid = r.other GROUP BY r.rid)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(c.first, v.vec_id)) AS component_id,
       coalesce(v.vec_id <= coalesce(c.first, v.vec_id), false) AS kept
FROM v LEFT JOIN n USING (rid) LEFT JOIN c USING (rid)
"""


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of all documents, sizes near equal, equal texts together."""
    s = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), 8)
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes from every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.copies(docs).select("doc_id", "size", "source_size", "target",
                                      (F.col("copies") * F.col("size")).alias("taken"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = html_cut.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the quality cascade for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.annotate(docs).drop("text")


SQL_OP6 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
           FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
     r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1),
     c AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
     l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
     m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
                  coalesce(c.n, 0)::BIGINT AS n_repeat_words
           FROM d JOIN l USING (rid) LEFT JOIN c USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM m
"""


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding site rule and verdict of every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


SQL_OP7 = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
           FROM pages),
     p AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(r, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM u),
     q AS (SELECT *, CASE
             WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1')
               THEN 'example.org/en/1'
             WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/')
               THEN 'example.org/es/'
             WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
             WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
             WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
         WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
         WHEN regexp_matches(host, '(^|[.-])(casino|poker|bets|betting|jackpot|pills|viagra|porn|xxx|escort|payday|warez|torrent)([.-]|$)')
           THEN 'block' ELSE 'allow' END AS verdict
FROM q
"""


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License matches of every document and the longest of them."""
    docs = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    best = F.array_max(F.transform("licenses", lambda m: F.struct(
        m["n_words"].alias("n"), m["coverage"].alias("coverage"), (-m["first_word"]).alias("at"),
        m["license"].alias("license"))))
    return docs.select("doc_id", F.size("licenses").cast("long").alias("n_matches"),
                       best["license"].alias("license"), best["coverage"].alias("coverage"),
                       F.array_sort(F.array_distinct(F.transform("licenses", lambda m: m["license"]))).alias("licenses"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 4-word shingles, at most 4 differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels only of rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep_text=False).select(
        "doc_id", F.coalesce(toxicity.remainder("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written as files of directly addressable codes and read back from them."""
    path = f"{shared_dir(spark).rstrip('/')}/llm-token-files-{uuid.uuid4().hex[:12]}"
    token_files.write(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=2)
    back = token_files.documents(spark, path)
    digests = stage(back.withColumn("ids_crc32", F.crc32("ids_le")).drop("ids_le"), "token-digests")
    return token_files.with_start(digests).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt on the openings of every hundredth."""
    turns = prefix_trie.number_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.summary(*prefix_trie.share_openings(turns))


_CRC_BYTE = ("list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: "
             "CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)")
_CRC = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda y: ascii(y)::BIGINT)), "
        f"lambda a, b: {_CRC_BYTE}), 4294967295)")

SQL_OP12 = f"""
WITH d AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
     k AS (SELECT c, c - c % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT c FROM d)),
     o AS (SELECT k.c, 0 AS part, pos, r, t FROM k JOIN d ON d.c = k.base WHERE pos <= h
           UNION ALL SELECT k.c, 1, pos, r, t FROM k JOIN d ON d.c = k.c WHERE pos > h),
     q AS (SELECT c, list(md5(length(r) || ':' || r || t) ORDER BY part, pos) AS a, list(length(t) ORDER BY part, pos) AS n
           FROM o GROUP BY c),
     s AS (SELECT k.c, coalesce(a, []) AS a, coalesce(n, []) AS n FROM k LEFT JOIN q ON q.c = k.c),
     m AS (SELECT c, u AS depth, a[1:u] AS path, array_to_string(a[1:u], ',') AS p, array_to_string(a[1:u - 1], ',') AS up,
                  CASE WHEN u > 0 THEN n[u] ELSE 0 END AS chars, len(a) = u AS ends
           FROM (SELECT *, unnest(range(0, len(a) + 1)) AS u FROM s)),
     g AS (SELECT depth, p, any_value(up) AS up, any_value(path) AS path, min(c) AS conv_id, count(*) AS n_convs,
                  any_value(chars) AS chars, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '') AS e
           FROM m GROUP BY depth, p),
     b AS (SELECT depth - 1 AS depth, up AS p, count(*) AS n FROM g WHERE depth > 0 GROUP BY depth, up),
     w AS (SELECT g.*, coalesce(b.n, 0) AS n_children, CASE WHEN b.n IS NULL THEN 1 ELSE 0 END AS leaf,
                  (n_convs - 1) * chars AS saved FROM g LEFT JOIN b ON b.depth = g.depth AND b.p = g.p),
     z AS (SELECT v AS depth, array_to_string(path[1:v], ',') AS p, sum(leaf) AS n_leaves, sum(saved) AS saved
           FROM (SELECT *, unnest(range(0, depth + 1)) AS v FROM w) GROUP BY 1, 2)
SELECT w.conv_id, w.depth, f.conv_id AS parent_conv_id, w.n_convs, w.n_children, z.n_leaves::BIGINT AS n_leaves,
       z.saved::BIGINT AS saved_tokens, sha256(w.e) AS ends_sha256
FROM w JOIN z ON z.depth = w.depth AND z.p = w.p LEFT JOIN w f ON f.depth = w.depth - 1 AND f.p = w.up
"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of all words of the corpus (with its planted deletions)."""
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents"), drop_every=97))


_CRC_WORD = ("xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda y: "
             f"('0x' || substr(x, 2 * y + 1, 2))::BIGINT)), lambda a, b: {_CRC_BYTE}), 4294967295)")

SQL_OP13 = f"""
WITH RECURSIVE
     r AS (SELECT doc_id, w, count(*) AS k, hex(encode(doc_id || ':' || w)) AS x FROM (
             SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS w FROM documents) GROUP BY doc_id, w),
     h AS (SELECT w, k, {_CRC_WORD} AS h FROM r),
     e AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, k FROM h),
     v AS (SELECT w, sum(k)::BIGINT AS n FROM e WHERE length(w) >= 5 GROUP BY w HAVING sum(k) >= 3),
     d AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS s
           FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM v)),
     p AS (SELECT a.w, b.w AS o, b.n AS m FROM d a JOIN d b ON a.s = b.s AND a.i = b.i AND a.w <> b.w
           UNION SELECT d.w, v.w, v.n FROM d JOIN v ON v.w = d.s
           UNION SELECT v.w, d.w, d.n FROM d JOIN v ON v.w = d.s),
     f AS (SELECT w, o, m, count(*) OVER (PARTITION BY w) AS n_near,
                  row_number() OVER (PARTITION BY w ORDER BY m DESC, encode(o)) AS nth FROM p),
     g AS (SELECT v.w, v.n, coalesce(f.n_near, 0) AS n_near, CASE WHEN f.m >= 2 * v.n THEN f.o END AS form,
                  CASE WHEN f.m >= 2 * v.n THEN f.m END AS form_n FROM v LEFT JOIN f ON f.w = v.w AND f.nth = 1),
     t AS (SELECT w, w AS root, form AS next FROM g
           UNION ALL SELECT t.w, t.next, g.form FROM t JOIN g ON g.w = t.next)
SELECT g.w AS word, g.form, t.root, g.n, g.n_near::BIGINT AS n_near, g.form_n
FROM g JOIN t ON t.w = g.w AND t.next IS NULL
"""


QUERIES = {f.__name__: f for f in (op1_bpe, op2_embeddings, op3_sharding, op4_mixing, op5_html, op6_quality, op7_urls, op8_licenses, op9_simhash, op10_toxicity,
                                  op11_token_ids, op12_prefix_trie, op13_spelling)}

SQL: dict[str, str] = {"op2_embeddings": SQL_OP2, "op6_quality": SQL_OP6, "op7_urls": SQL_OP7,
                       "op12_prefix_trie": SQL_OP12, "op13_spelling": SQL_OP13}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
