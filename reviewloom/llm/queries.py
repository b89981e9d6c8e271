"""The operators over the given tables, each with its SQL counterpart where SQL has one."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..catalog.registry import Catalog, Entry, Tables
from .chat import format_chats
from .decontaminate import decontaminate
from .exact_dedup import exact_dedup
from .language import identify_language
from .licenses import scan_licenses
from .mixing import mix_sources
from .ngram_join import ngram_join
from .order_minhash import order_fingerprints
from .prefix_trie import prefix_trie
from .privacy import digest, find_personal_data
from .resampling import resample
from .token_counts import count_tokens
from .url_filter import filter_urls

CATALOG = Catalog()

#: The vocabulary of the token counts; its folder is a parameter.
VOCABULARY = os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), "piece_bpe_32k.model")

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) END AS g
  FROM w),
e AS (SELECT doc_id, unnest(g) AS x FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT p.a, p.b FROM p JOIN s x ON x.doc_id = p.a JOIN s y ON y.doc_id = p.b
  WHERE 100 * k >= 75 * (len(x.g) + len(y.g) - k)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.doc_id)
SELECT doc_id, any_value(len(g))::BIGINT AS n_shingles, min(c) AS component_id
FROM s JOIN r USING (doc_id) GROUP BY doc_id
"""

EXACT_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT norm, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

DECONTAMINATE_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
t AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
g AS (
  SELECT DISTINCT item_id, n, unnest([array_to_string(w[i:i+n-1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS p
  FROM t),
sizes AS (SELECT DISTINCT n FROM t),
x AS (
  SELECT doc_id, n, unnest([{{'i': i, 'p': array_to_string(w[i:i+n-1], ' ')}} FOR i IN range(1, len(w) - n + 2)]) AS s
  FROM d CROSS JOIN sizes WHERE len(w) >= n),
o AS (SELECT doc_id, x.n, s.i AS i, item_id FROM x JOIN g ON x.n = g.n AND x.s.p = g.p),
h AS (SELECT doc_id, count(*) AS n_hit FROM (
  SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM o) GROUP BY 1),
l AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN l USING (doc_id)
"""


@CATALOG.query(NGRAM_SQL)
def op1_ngram_jaccard_join(t: Tables):
    return ngram_join(t.documents)


@CATALOG.query(EXACT_SQL)
def op2_exact_dedup(t: Tables):
    return exact_dedup(t.documents)


@CATALOG.query()
def op3_source_mixing(t: Tables):
    return mix_sources(t.documents)


@CATALOG.query(DECONTAMINATE_SQL)
def op4_benchmark_decontamination(t: Tables):
    return decontaminate(t.documents, t.benchmark)

CHAT_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (
  SELECT conv_id, turn, '<|' || replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '|>', '| >') || '|>' || chr(10)
    || replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') || chr(10)
    || '<|end|>' || chr(10) AS piece, turn::VARCHAR || ':' || role || ':' || text || chr(0) AS exact FROM t),
r AS (
  SELECT conv_id, turn, string_agg(exact, '') OVER (PARTITION BY conv_id ORDER BY turn) AS prefix,
    turn = max(turn) OVER (PARTITION BY conv_id) AS is_end FROM p),
k AS (
  SELECT min(conv_id) AS conv_id FROM r WHERE is_end
    AND prefix NOT IN (SELECT prefix FROM r WHERE NOT is_end) GROUP BY prefix)
SELECT conv_id, turn // 64 AS part, count(*) AS n_turns, string_agg(piece, '' ORDER BY turn) AS rendered
FROM p JOIN k USING (conv_id) GROUP BY 1, 2
"""


@CATALOG.query(CHAT_SQL)
def op7_chat_formatting(t: Tables):
    return format_chats(t.conversations)


@CATALOG.query()
def op9_language_id(t: Tables):
    return identify_language(t.documents)


@CATALOG.query()
def op5_license_scan(t: Tables):
    return scan_licenses(t.documents)


@CATALOG.query()
def op6_url_filter(t: Tables):
    return filter_urls(t.pages)


@CATALOG.query()
def op8_personal_data(t: Tables):
    return find_personal_data(t.documents).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )


@CATALOG.query()
def op10_token_counts(t: Tables):
    return count_tokens(t.documents, VOCABULARY)


#: crc32 of a text, one step for each bit of its bytes.
CRC = """
  xor(list_reduce([4294967295::BIGINT] || [('0x' || substr(hex(encode({0})), 2 * i - 1, 2))::INT::BIGINT
      FOR i IN range(1, octet_length(encode({0})) + 1)],
    lambda c, b: list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1],
      lambda v, one: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)),
    4294967295::BIGINT)"""

RESAMPLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
df AS (SELECT doc_id, unnest(w || [w[i] || ' ' || w[i+1] FOR i IN range(1, len(w))]) AS f FROM d),
bf AS (SELECT unnest(w || [w[i] || ' ' || w[i+1] FOR i IN range(1, len(w))]) AS f FROM b),
h AS (SELECT f, {CRC.format("f")} % 10000 AS k FROM (SELECT f FROM df UNION SELECT f FROM bf)),
s AS (SELECT k, count(*) AS s FROM df JOIN h USING (f) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM bf JOIN h USING (f) GROUP BY k),
n AS (SELECT (SELECT count(*) FROM df) AS s, (SELECT count(*) FROM bf) AS t),
g AS (
  SELECT k, floor(1000 * ln((coalesce(t.t, 0)::DOUBLE + 1) * (n.s::DOUBLE + 10000)
    / ((coalesce(s.s, 0)::DOUBLE + 1) * (n.t::DOUBLE + 10000))))::BIGINT AS gain
  FROM (SELECT DISTINCT k FROM h) LEFT JOIN s USING (k) LEFT JOIN t USING (k) CROSS JOIN n),
x AS (
  SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM df JOIN h USING (f) JOIN g USING (k) GROUP BY doc_id),
y AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('7:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN x USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM y WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score,
  CASE WHEN rank <= 25 * (SELECT count(*) FROM r) // 100 THEN rank END AS rank
FROM y LEFT JOIN r USING (doc_id)
"""


@CATALOG.query(RESAMPLE_SQL)
def op11_importance_resampling(t: Tables):
    return resample(t.documents, t.benchmark)


@CATALOG.query()
def op12_document_fingerprints(t: Tables):
    return order_fingerprints(t.documents)


TRIE_SQL = rf"""
WITH RECURSIVE o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    CASE WHEN conv_id % 20 = 0 THEN 0 ELSE {CRC.format("conv_id::VARCHAR")} % 4 END AS h FROM o GROUP BY 1),
p AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN o ON o.conv_id = c.base WHERE pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN o USING (conv_id) WHERE pos > h),
s AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d, role, text FROM p),
l AS (SELECT c.conv_id, count(d) AS length FROM c LEFT JOIN s USING (conv_id) GROUP BY 1),
x AS (
  SELECT conv_id, 0::BIGINT AS d, '' AS prefix, '' AS text FROM c
  UNION ALL SELECT conv_id, d, string_agg(len(role) || ':' || role || len(text) || ':' || text, '')
    OVER (PARTITION BY conv_id ORDER BY d), text FROM s),
n AS (
  SELECT prefix, d, min(conv_id) AS r, count(*) AS n_convs,
    (count(*) - 1) * max(len(regexp_extract_all(text, '[^ 	-
]+'))) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = length), '')) AS ends_sha256
  FROM x JOIN l USING (conv_id) GROUP BY prefix, d),
e AS (
  SELECT DISTINCT n.d, n.r, m.r AS pr FROM x JOIN n ON n.prefix = x.prefix AND n.d = x.d
  JOIN x y ON y.conv_id = x.conv_id AND y.d = x.d - 1 JOIN n m ON m.prefix = y.prefix AND m.d = y.d),
k AS (SELECT pr AS r, d - 1 AS d, count(*) AS n_children FROM e GROUP BY 1, 2),
u AS (
  SELECT n.r, n.d, n.r AS ur, n.d AS ud FROM n
  UNION ALL SELECT u.r, u.d, e.pr, u.ud - 1 FROM u JOIN e ON e.r = u.ur AND e.d = u.ud),
t AS (
  SELECT ur AS r, ud AS d, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM u JOIN n ON n.r = u.r AND n.d = u.d LEFT JOIN k ON k.r = u.r AND k.d = u.d GROUP BY 1, 2)
SELECT n.r AS conv_id, n.d AS depth, e.pr AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children,
  t.n_leaves, t.saved_tokens, n.ends_sha256
FROM n JOIN t ON t.r = n.r AND t.d = n.d LEFT JOIN e ON e.r = n.r AND e.d = n.d LEFT JOIN k ON k.r = n.r AND k.d = n.d
"""


@CATALOG.query(TRIE_SQL)
def op13_conversation_trie(t: Tables):
    return prefix_trie(t.conversations)


def entries() -> dict[str, Entry]:
    return dict(CATALOG)
