"""Registered queries of the training-data operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickforge.llm import (
    bbit_minhash, contamination, dual_tree, main_text, mixing, packing, pii_tagger, projection_forest, quality_ftrl, spelling,
    subword_lattice, topk_search, warc)
from tickforge.llm.common import id_remainder, prepare, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
    return fn


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_subword_lattice(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return subword_lattice.score(docs, subword_lattice.read_vocabulary(tokenizer_file("piece_bpe_32k.model")),
                                 held=id_remainder(F.col("doc_id"), 7) == 2)


@query
def op2_quality_ftrl(spark, sf_dir):
    return quality_ftrl.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                              held=id_remainder(F.col("doc_id"), 3) == 1)


@query
def op3_pii_tagger(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii_tagger.find(docs, pii_tagger.fit(docs))


@query
def op4_warc_index(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    # the table has no capture times; one second after the other, by id
    captured = F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce("page_id", F.lit(0))),
                             "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return warc.capture(pages, captured=captured).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                         "refers_to")


ORACLE["op4_warc_index"] = """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages),
q AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM q WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM q LEFT JOIN f USING (payload_digest)"""


@query
def op5_main_text(spark, sf_dir):
    return main_text.main_text(table(spark, sf_dir, "pages"))


@query
def op6_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                        public_tokenizers.PATTERN)


@query
def op7_bbit_minhash(spark, sf_dir):
    return bbit_minhash.groups(table(spark, sf_dir, "documents"), words=3, percent=85).drop("tie", "group")


@query
def op9_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("tie")


@query
def op8_topk_search(spark, sf_dir):
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op10_projection_forest(spark, sf_dir):
    return projection_forest.groups(table(spark, sf_dir, "embeddings"))


@query
def op12_decontamination(spark, sf_dir):
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop(
        "items", "spans")


_CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE["op12_decontamination"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, {_CAPITALS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(text, {_CAPITALS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
places AS (
  SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
  FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS v FROM places),
sizes AS (SELECT DISTINCT k FROM windows),
spots AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, sizes WHERE len(w) >= k),
found AS (
  SELECT r, p, k, item_id FROM (SELECT r, p, k, array_to_string(w[p:p + k - 1], ' ') AS v FROM spots)
  JOIN windows USING (k, v)),
words AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT r, p, k FROM found))
  GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN named USING (r)"""


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


# The check sum has no function there: bytes are folded over a table of 256 remainders made by shifting eight times.
ORACLE["op13_spelling_variants"] = rf"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS r
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, {_CAPITALS}), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
summed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, [
      CAST(('0x' || substr(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), 2 * i + 1, 2)) AS BIGINT)
      for i in range(CAST(octet_length(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS BIGINT))]),
    lambda c, x: xor(c >> 8, r[CAST(xor(c, x) & 255 AS BIGINT) + 1])), 4294967295) AS h
  FROM counted, t),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM summed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS key FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, key) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON b.word = a.key
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON b.word = a.key),
best AS (
  SELECT word, n, count(*) AS n_near, max(other_n) AS top_n FROM near GROUP BY word, n),
forms AS (
  SELECT word, any_value(n_near) AS n_near, min(CASE WHEN top_n >= 5 * n THEN other END) AS form,
         any_value(CASE WHEN top_n >= 5 * n THEN top_n END) AS form_n
  FROM best JOIN near USING (word, n) WHERE other_n = top_n GROUP BY word),
walk AS (
  SELECT word, form AS step FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.step WHERE forms.form IS NOT NULL),
ends AS (
  SELECT word, step AS root FROM walk WHERE step NOT IN (SELECT word FROM forms WHERE form IS NOT NULL))
SELECT word, form, coalesce(root, word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)"""


@query
def op11_dual_tree_search(spark, sf_dir):
    return dual_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op11_dual_tree_search"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, {_CAPITALS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM documents),
totals AS (SELECT count(*) AS nd, sum(len(t))::BIGINT AS nw FROM d WHERE len(t) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY term),
norms AS (SELECT r, doc_id, 100 - 90 + ((90 * len(t) * nd) // nw) AS m FROM d, totals WHERE len(t) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (
  SELECT DISTINCT q, item_id,
         unnest(regexp_extract_all(translate(text, {_CAPITALS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM i),
scored AS (
  SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN norms USING (r) GROUP BY q, item_id, r, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0) WHERE rank <= 10"""


ORACLE["op7_bbit_minhash"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_CAPITALS}), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS v
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (v) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(least_b, w.doc_id)) AS component_id,
       w.doc_id <= coalesce(least_b, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT a, min(b) AS least_b FROM reach GROUP BY a) ON a = w.doc_id"""

_USABLE = """
  vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

ORACLE["op8_topk_search"] = f"""
WITH v AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE {_USABLE}),
m AS (SELECT vec_id, i, CAST(floor(1024 * x) AS BIGINT) AS x FROM v),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM m q JOIN m c USING (i) WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id GROUP BY ALL)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
WHERE rank <= 10"""

ORACLE["op10_projection_forest"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
  WHERE label IS NOT NULL AND {_USABLE}),
size AS (SELECT vec_id, sqrt(sum(x * x)) AS size FROM v GROUP BY vec_id HAVING sum(x * x) > 0),
links AS (
  SELECT a, b FROM (
    SELECT p.vec_id AS a, q.vec_id AS b, sum(p.x * q.x) AS dot FROM v p JOIN v q USING (label, i)
    WHERE p.vec_id <> q.vec_id GROUP BY ALL)
  JOIN size sa ON sa.vec_id = a JOIN size sb ON sb.vec_id = b WHERE dot / (sa.size * sb.size) >= 0.98),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, least(e.vec_id, coalesce(least_b, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(least_b, e.vec_id) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) l ON l.a = e.vec_id
LEFT JOIN (SELECT a, min(b) AS least_b FROM reach GROUP BY a) r ON r.a = e.vec_id"""
