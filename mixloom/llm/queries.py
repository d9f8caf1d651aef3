"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mixloom.llm import decontam, pii, secrets
from mixloom.llm.langid import predict_languages, train
from mixloom.llm.linededup import dedup_lines
from mixloom.llm.mixing import mix_sources
from mixloom.llm.neardup import near_duplicates
from mixloom.llm.packing import pack, tokenizer_path
from mixloom.llm.pii import find_pii
from mixloom.llm.prefixtrie import prefix_trie
from mixloom.llm.quality import quality_rules
from mixloom.llm.quotes import link_quotes
from mixloom.llm.scratch import Scratch
from mixloom.llm.spelling import spelling_variants
from mixloom.llm.topk import quantized, top_k


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest of the base spans of every document, and all spans."""
    found = find_pii(_table(spark, folder, "documents").select("doc_id", "text"), Scratch(spark))
    counts = [_count("base", kind) for kind in pii.KINDS]
    digest = F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, _joined("all").alias("spans"), F.size("added").cast("long").alias("n_added"))


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines, deleted lines, their spans and a digest of the remaining text of every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    done = dedup_lines(docs, Scratch(spark))
    spans = F.transform("_l_runs", lambda r: F.concat_ws("-", r["from"], r["to"]))
    return done.select(
        "doc_id",
        F.col("_l_lines").cast("long").alias("n_lines"),
        F.col("_l_deleted").cast("long").alias("n_deleted"),
        F.array_join(spans, ",").alias("deleted"),
        F.col("_l_emptied").alias("emptied"),
        F.length("text").cast("long").alias("kept_chars"),
        F.md5(F.col("text").cast("binary")).alias("kept_md5"),
    )


def quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts, distances to the best-fitting language and the verdict on every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    judged = quality_rules(docs, Scratch(spark), columns=["doc_id"])
    return judged.select("doc_id", *[F.col(c).alias(c.removeprefix("_q_")) for c in judged.columns if c.startswith("_q_")])


def near_duplicate_components(spark: SparkSession, folder: str) -> DataFrame:
    """Size of the shingle set, component and verdict of every document, for 3-word shingles and 85 %."""
    return near_duplicates(_table(spark, folder, "documents").select("doc_id", "text"), Scratch(spark), width=3, percent=85)


NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
           WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other)
SELECT d.doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id,
       d.doc_id = min(r.other) AS kept
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id
GROUP BY d.doc_id
"""

def mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents the mixture takes, in which pass, and their place in its permutation."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    mixed = mix_sources(docs, Scratch(spark))
    kept = ("tokens", "pass", "block", "place", "weight", "exponent")
    return mixed.select("doc_id", "source", *[F.col(f"_m_{c}").alias(c) for c in kept])


MIX_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens
  FROM documents),
stats AS (SELECT src, CAST(sum(tokens) AS BIGINT) AS t, count(*) AS docs FROM sized WHERE tokens > 0 GROUP BY src),
total AS (SELECT CAST(sum(t) AS BIGINT) AS budget FROM stats),
share AS (SELECT list(t / budget) AS ps, ln(count(*)) AS top FROM stats, total),
search AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0.0::DOUBLE AS lo2, 1.0::DOUBLE AS hi2
  UNION ALL
  SELECT i + 1,
         CASE WHEN even <= 0.9 THEN lo ELSE (lo + hi) / 2 END, CASE WHEN even <= 0.9 THEN (lo + hi) / 2 ELSE hi END,
         CASE WHEN most <= 2.0 THEN lo2 ELSE (lo2 + hi2) / 2 END, CASE WHEN most <= 2.0 THEN (lo2 + hi2) / 2 ELSE hi2 END
  FROM (
    SELECT i, lo, hi, lo2, hi2,
           (ln(list_sum(list_transform(ps, lambda p: p ** ((lo + hi) / 2))))
            - (lo + hi) / 2 * list_sum(list_transform(ps, lambda p: p ** ((lo + hi) / 2) * ln(p)))
              / list_sum(list_transform(ps, lambda p: p ** ((lo + hi) / 2)))) / top AS even,
           list_max(list_transform(ps, lambda p: p ** ((lo2 + hi2) / 2 - 1)))
             / list_sum(list_transform(ps, lambda p: p ** ((lo2 + hi2) / 2))) AS most
    FROM search, share WHERE i < 50) q),
found AS (
  SELECT greatest(ceil(round(hi * 1e6, 1)), ceil(round(hi2 * 1e6, 1))) / 1e6 AS exponent FROM search WHERE i = 50),
weighted AS (
  SELECT src, t, docs, exponent,
         ((t / budget) ** exponent) / list_sum(list_transform(ps, lambda p: p ** exponent)) AS weight, budget
  FROM stats, total, share, found),
plan AS (
  SELECT src, exponent, round(weight, 12) AS weight, CAST(floor(round(weight * budget) / t) AS BIGINT) AS passes,
         CAST(round(weight * budget) AS BIGINT) - CAST(floor(round(weight * budget) / t) AS BIGINT) * t AS rest,
         CAST(greatest(0, ceil(ln(docs / 1024) / ln(16))) AS INT) AS digits
  FROM weighted),
docs AS (
  SELECT s.*, p.exponent, p.weight, p.passes, p.rest,
         substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, digits) AS b
  FROM sized s JOIN plan p ON p.src = s.src WHERE tokens > 0),
partial AS (
  SELECT *, md5('mix|' || (passes + 1) || '|' || src || '|' || b) AS k,
         md5('mix|' || (passes + 1) || '|' || src || '|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS q
  FROM docs),
filled AS (
  SELECT *, sum(tokens) OVER (PARTITION BY src ORDER BY k, q RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM partial),
turns AS (SELECT *, unnest(range(1, passes + CASE WHEN rest > 0 AND upto <= rest THEN 2 ELSE 1 END)) AS pass FROM filled)
SELECT doc_id, source, tokens, pass, md5('mix|' || pass || '|' || src || '|' || b) AS block,
       md5('mix|' || pass || '|' || src || '|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place, weight, exponent
FROM turns
"""


def packed_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document, with its sequence and place, at the documents' own source mixture."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    return pack(docs, Scratch(spark), tokenizer_path())


def quoted_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """What every message replies to, how deep it is, and a digest of its text without quotes."""
    linked = link_quotes(_table(spark, folder, "conversations"), Scratch(spark))
    facts = ("reply_to", "by_quote", "depth", "passages", "linked")
    return linked.select(
        "conv_id",
        "turn",
        "role",
        *[F.col(f"_c_{c}").alias(c) for c in facts],
        F.length("text").cast("long").alias("own_chars"),
        F.md5(F.col("text").cast("binary")).alias("own_md5"),
    )


def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest of the base spans of every document, and all spans."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.fit(docs, Scratch(spark)))
    counts = [_count("base", kind) for kind in secrets.KINDS]
    digest = F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, _joined("all").alias("spans"), F.size("added").cast("long").alias("n_added"))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document and its calibrated probability."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    return predict_languages(docs, train(docs))


def top_products(spark: SparkSession, folder: str) -> DataFrame:
    """The five largest integer inner products of every fiftieth vector."""
    return top_k(quantized(_table(spark, folder, "embeddings").select("vec_id", "embedding")), Scratch(spark))


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


def decontaminated(spark: SparkSession, folder: str) -> DataFrame:
    """Hit words and occurring benchmark items of every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontam.decontaminate(docs, _table(spark, folder, "benchmark"), Scratch(spark), columns=["doc_id"])
    return decontam.digest(found)


DECONTAMINATION_SQL = r"""
WITH folded AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, w, least(10, len(w)) AS k
  FROM (SELECT item_id, regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark) WHERE len(w) > 0),
known AS (
  SELECT DISTINCT k, array_to_string(w[i:i + k - 1], ' ') AS s, item
  FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM item)),
place AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM folded, (SELECT DISTINCT k FROM known) WHERE len(w) >= k)),
found AS (SELECT r, i, k, item FROM place JOIN known USING (k, s)),
hit AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS p FROM found) GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM folded LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every shared or single beginning of the rebuilt conversations."""
    return prefix_trie(_table(spark, folder, "conversations"), Scratch(spark))


#: CRC-32 of a list of bytes, from the table of its polynomial.
CRC_SQL = """list_reduce(
      {bytes},
      lambda c, b: xor(c >> 8, crc_values[xor(c & 255, b) + 1]),
      4294967295::BIGINT)"""
CRC_TABLE_SQL = """crc_steps AS (
  SELECT i, i AS v, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(CAST(v AS BIGINT) ORDER BY i) AS crc_values FROM crc_steps WHERE k = 8)"""

TRIE_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 AS base, xor({CRC_SQL.format(bytes="list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))")},
         4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns), crc_table),
rebuilt AS (
  SELECT v.c, t.role, t.text, 0 AS part, t.p FROM convs v JOIN turns t ON t.c = v.base AND t.p <= v.h
  UNION ALL
  SELECT v.c, t.role, t.text, 1, t.p FROM convs v JOIN turns t ON t.c = v.c AND t.p > v.h),
whole AS (
  SELECT c, list(struct_pack(role := role, text := text) ORDER BY part, p) AS w FROM rebuilt GROUP BY c),
prefix AS (
  SELECT c, len(w) AS n, unnest(range(0, len(w) + 1)) AS d, w
  FROM (SELECT v.c, coalesce(w, []) AS w FROM convs v LEFT JOIN whole USING (c))),
member AS (
  SELECT c, n, d, sha256(CAST(w[1:d] AS JSON)) AS k, CASE WHEN d > 0 THEN sha256(CAST(w[1:d - 1] AS JSON)) END AS up,
         CASE WHEN d > 0 THEN length(w[d].text) ELSE 0 END AS chars
  FROM prefix),
node AS (SELECT d, k, min(c) AS rep, count(*) AS n, min(up) AS up, max(chars) AS chars FROM member GROUP BY d, k),
child AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
sub AS (
  SELECT m.d, m.k, sum(CASE WHEN child.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((u.n - 1) * u.chars) AS saved
  FROM node u LEFT JOIN child ON child.d = u.d AND child.k = u.k JOIN member m ON m.c = u.rep AND m.d <= u.d
  GROUP BY m.d, m.k),
ends AS (SELECT d, k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM member WHERE d = n GROUP BY d, k)
SELECT v.rep AS conv_id, CAST(v.d AS BIGINT) AS depth, p.rep AS parent_conv_id, v.n AS n_convs,
       CAST(coalesce(child.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node v JOIN sub ON sub.d = v.d AND sub.k = v.k LEFT JOIN child ON child.d = v.d AND child.k = v.k
LEFT JOIN node p ON p.d = v.d - 1 AND p.k = v.up LEFT JOIN ends ON ends.d = v.d AND ends.k = v.k
"""

def spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of six letters and five occurrences, its more frequent form one edit away, and the root of that."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return spelling_variants(docs, Scratch(spark), misprint_every=199)


SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w
  FROM documents),
counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS s, w, count(*) AS n FROM runs GROUP BY ALL),
checked AS (
  SELECT w, n, xor({CRC_SQL.format(bytes="flatten(list_transform(string_split(s, ''), lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [195::BIGINT, CAST(ord(x) - 64 AS BIGINT)] END))")},
         4294967295) AS h
  FROM counted, crc_table),
word AS (
  SELECT w, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN left(w, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS w, n FROM checked)
  WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
letters AS (
  SELECT string_agg(chr(CAST(i AS INT)), '' ORDER BY i) AS wide, string_agg(chr(CAST(i - 159 AS INT)), '' ORDER BY i) AS narrow FROM range(192, 256) t(i)),
narrowed AS (SELECT w, n, translate(w, wide, narrow) AS b FROM word, letters),
near AS (
  SELECT x.w, x.n, y.w AS v, y.n AS m
  FROM narrowed x JOIN narrowed y ON length(y.b) BETWEEN length(x.b) - 1 AND length(x.b) + 1 AND levenshtein(x.b, y.b) = 1),
best AS (
  SELECT w, count(*) AS n_near, max(m) AS m, min(struct_pack(less := -m, v := v)).v AS v FROM near GROUP BY w),
formed AS (
  SELECT word.w, word.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN m >= 5 * word.n THEN v END AS form, CASE WHEN m >= 5 * word.n THEN m END AS form_n
  FROM word LEFT JOIN best USING (w)),
walk AS (
  SELECT w, w AS here, form AS next FROM formed
  UNION ALL
  SELECT walk.w, walk.next, formed.form FROM walk JOIN formed ON formed.w = walk.next)
SELECT w AS word, form, here AS root, n, n_near, form_n FROM formed JOIN (SELECT w, here FROM walk WHERE next IS NULL) USING (w)
"""

QUERIES = {
    "op1_personal_data": personal_data,
    "op2_top_products": top_products,
    "op3_line_dedup": line_dedup,
    "op4_source_mixing": mixed_sources,
    "op5_chat_quotes": quoted_conversations,
    "op6_packing": packed_windows,
    "op7_quality_rules": quality,
    "op8_secrets": secret_spans,
    "op9_language_id": languages,
    "op10_near_duplicates": near_duplicate_components,
    "op11_spelling_variants": spelling_groups,
    "op12_decontamination": decontaminated,
    "op13_conversation_trie": conversation_trie,
}
ORACLE: dict[str, str] = {
    "op2_top_products": TOP_SQL,
    "op4_source_mixing": MIX_SQL,
    "op10_near_duplicates": NEAR_SQL,
    "op11_spelling_variants": SPELLING_SQL,
    "op12_decontamination": DECONTAMINATION_SQL,
    "op13_conversation_trie": TRIE_SQL,
}
