"""The registered training-data queries and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from kwpulse.llm import (bpe, decontam, jaccard, licenses, line_dedup, pii, prefix_trie, ranked_search, token_counts, topk, toxicity,
                         url_filter, warc)
from kwpulse.llm.common import table

VOCABULARY_FILE = "word_bpe_49k.json"
COUNTED_FILE = "byte_bpe_50k.json"

URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def op1_warc(spark, sf_dir):
    r = warc.roundtrip(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return r.selectExpr("id AS page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_url_filters(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"),
                            url_filter.rules_frame(spark, URL_RULES))


def vocabulary_path(name: str = VOCABULARY_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_bpe(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary_path())


def op3_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op4_jaccard(spark, sf_dir):
    return jaccard.groups(table(spark, sf_dir, "documents", "doc_id", "text"), k=3, num=90, den=100)


def op5_decontamination(spark, sf_dir):
    out = decontam.mark(table(spark, sf_dir, "documents", "doc_id", "text"),
                        table(spark, sf_dir, "benchmark", "item_id", "text"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_line_dedup(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_pii(spark, sf_dir):
    return pii.summary(pii.find(table(spark, sf_dir, "documents", "doc_id", "text")))


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_ranked_search(spark, sf_dir):
    return ranked_search.search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_token_counts(spark, sf_dir):
    return token_counts.prefix_counts(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary_path(COUNTED_FILE),
                                      with_steps=False)


def queries():
    return {f.__name__: f for f in (
        op1_warc, op2_bpe, op3_topk, op4_jaccard, op5_decontamination, op6_line_dedup, op7_pii, op8_toxicity,
        op9_licenses, op10_url_filters, op11_ranked_search, op12_prefix_trie, op13_token_counts)}


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return f"""
WITH rules(verdict, rhost, rpath) AS (VALUES {rules}),
parts AS (
  SELECT row_number() OVER () AS rn, page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
hits AS (
  SELECT rn, arg_max(rhost || rpath, length(rhost) + length(rpath)) AS rule,
         arg_max(verdict, length(rhost) + length(rpath)) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY rn)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN hits USING (rn)"""


# CRC-32 as its definition has it: eight steps for each value of a byte, then a step for each character of the number.
_TRIE_SQL = """
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || coalesce(text, ''))) AS pos,
         struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS turn
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, list(turn ORDER BY pos) AS own FROM turns GROUP BY conv_id),
heads AS (
  SELECT conv_id, own, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
           lambda a, b: xor(a // 256, t[1 + xor(a % 256, b)])), 4294967295) % 6 AS h FROM convs, steps),
whole AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS s
  FROM heads c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100),
members AS (SELECT conv_id, s, len(s) AS n, unnest(range(len(s) + 1)) AS d FROM whole),
nodes AS (
  SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM members GROUP BY 1, 2),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
facts AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN d > 0 THEN (n_convs - 1) * length(p[d].x) ELSE 0 END AS own_saved
  FROM nodes LEFT JOIN kids USING (p)),
below AS (SELECT p[1:e] AS p, own_saved, n_children FROM (SELECT *, unnest(range(d + 1)) AS e FROM facts)),
sums AS (SELECT p, sum(own_saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM below GROUP BY p)
SELECT f.conv_id, f.d::BIGINT AS depth, CASE WHEN f.d > 0 THEN u.conv_id END AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM facts f JOIN sums USING (p) LEFT JOIN nodes u ON u.p = f.p[1:f.d - 1] AND u.d = f.d - 1"""


_SEARCH_SQL = r"""
WITH cut AS (
  SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
facts AS (SELECT rn, doc_id, len(t) AS n, t FROM cut WHERE len(t) > 0),
sums AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM facts),
tfs AS (SELECT rn, term, count(*) AS tf FROM (SELECT rn, unnest(t) AS term FROM facts) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, sums GROUP BY term, docs),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
scores AS (
  SELECT item_id, rn, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tfs USING (term) JOIN facts USING (rn), sums GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50"""


def oracle_sql():
    return {"op10_url_filters": _url_sql(), "op11_ranked_search": _SEARCH_SQL, "op12_prefix_trie": _TRIE_SQL}
