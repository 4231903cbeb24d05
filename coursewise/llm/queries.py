"""The operators' registered queries over the given tables, and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, bpe, chat, exact_dedup, language, lattice, lexical, line_dedup, packing, quality, simhash, token_counts
from .common import table

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"
TOKEN_LIMIT = 4096


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its cross-site boilerplate lines: lines cut, characters left, digest of the text."""
    out = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "lines_removed", F.char_length("text").cast("long").alias("n_chars_left"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


_BLANKS = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"
OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS site, text, string_split(text, chr(10)) AS parts FROM documents),
l AS (SELECT r, text, site, trim(line, {_BLANKS}) AS own, line, k FROM (SELECT r, text, site, unnest(parts) AS line, unnest(range(len(parts))) AS k FROM d)),
wide AS (SELECT own FROM l WHERE own <> '' GROUP BY own HAVING count(DISTINCT site) >= {line_dedup.MIN_SITES}),
t AS (SELECT DISTINCT text, site FROM l WHERE own IN (SELECT own FROM wide)),
z AS (SELECT site, count(*) AS texts FROM t GROUP BY site),
one AS (SELECT text, arg_min(t.site, (texts, t.site)) AS site FROM t JOIN z ON t.site = z.site GROUP BY text),
spread AS (SELECT own FROM l JOIN one ON l.text = one.text WHERE own IN (SELECT own FROM wide) GROUP BY own HAVING count(DISTINCT one.site) >= {line_dedup.MIN_SITES}),
m AS (SELECT l.r, l.k, l.line, s.own IS NOT NULL AS cut FROM l LEFT JOIN spread s ON l.own = s.own),
c AS (SELECT r, count(*) FILTER (WHERE cut) AS n, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT cut), '') AS rest FROM m GROUP BY r),
f AS (SELECT d.doc_id, coalesce(c.n, 0) AS lines_removed, CASE WHEN c.n > 0 THEN c.rest ELSE d.text END AS text FROM d LEFT JOIN c ON d.r = c.r)
SELECT doc_id, lines_removed, length(text) AS n_chars_left, sha256(text) AS text_sha256 FROM f
"""


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy of its text that stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="max")


OP3_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text by the digest cache, which earlier runs over these tables have filled."""
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE), token_counts.shared_cache(spark, sf_dir))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op5_curve_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from its text, markup, address and host."""
    model = language.fit(table(spark, sf_dir, "documents"))
    html, url = F.col("html"), F.col("url")
    found = language.identify(table(spark, sf_dir, "pages"), model, "page_id", language.page_text(html), *language.page_evidence(html, url))
    return found.select("page_id", "lang", "posterior", "text_lang", language.accepted().alias("accepted"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's turns as linked, ordered and checked calls in canonical JSON."""
    return chat.link_calls(*chat.turn_calls(table(spark, sf_dir, "conversations")), chat.TURN_TOOLS)


OP8_SQL = """
WITH RECURSIVE m AS (SELECT conv_id, turn, lower(role) AS role, text, md5(conv_id::VARCHAR || ':' || turn::VARCHAR) AS own,
    md5(conv_id::VARCHAR || ':' || (turn - 1)::VARCHAR) AS one_back, md5(conv_id::VARCHAR || ':' || (turn - 2)::VARCHAR) AS two_back FROM conversations),
c AS (SELECT conv_id, turn, role, text, own, CASE WHEN turn >= 2 THEN two_back WHEN turn = 1 THEN one_back END AS after FROM m WHERE role IN ('user', 'system') AND own IS NOT NULL),
r AS (SELECT conv_id, turn, one_back AS own, text FROM m WHERE role = 'assistant' AND one_back IS NOT NULL),
u AS (SELECT DISTINCT conv_id, turn, text FROM m WHERE own IS NULL OR role IS NULL OR role NOT IN ('user', 'system', 'assistant')),
p AS (SELECT c.*, q.own AS parent FROM c LEFT JOIN c q ON q.conv_id = c.conv_id AND q.own = c.after),
l AS (SELECT conv_id, own, 0 AS level FROM p WHERE parent IS NULL
      UNION ALL SELECT p.conv_id, p.own, l.level + 1 FROM l JOIN p ON p.conv_id = l.conv_id AND p.parent = l.own),
j AS (SELECT p.conv_id, l.level, p.turn, p.own AS call_id,
    CASE WHEN p.role = 'system' THEN CASE WHEN p.text IS NULL THEN '$.instructions: missing' WHEN p.text = '' THEN '$.instructions: too short' ELSE '' END
         WHEN p.text IS NULL THEN '$.question: missing' WHEN p.text = '' THEN '$.question: too short' WHEN length(p.text) > 300 THEN '$.question: too long' ELSE '' END AS bad,
    CASE WHEN p.after IS NOT NULL AND p.parent IS NULL THEN 'no call ' || p.after ELSE '' END AS dangling, r.own IS NOT NULL AS answered,
    '{"after":[' || coalesce('"' || p.parent || '"', '') || '],"arguments":{' || CASE WHEN p.role = 'system'
        THEN coalesce('"instructions":' || to_json(p.text)::VARCHAR, '') ELSE coalesce('"question":' || to_json(p.text)::VARCHAR || ',', '') || '"turn":' || p.turn END ||
    '},"call_id":"' || p.own || '","name":"' || CASE WHEN p.role = 'system' THEN 'configure' ELSE 'answer' END || '","result":' || coalesce(to_json(r.text)::VARCHAR, 'null') || '}' AS json
  FROM p JOIN l ON l.conv_id = p.conv_id AND l.own = p.own LEFT JOIN r ON r.conv_id = p.conv_id AND r.own = p.own)
SELECT conv_id, level, turn, call_id, CASE WHEN bad <> '' THEN 'invalid' WHEN answered THEN 'ok' ELSE 'no_result' END AS status,
    bad || CASE WHEN bad <> '' AND dangling <> '' THEN '; ' ELSE '' END || dangling AS errors, json FROM j
UNION ALL
SELECT conv_id, NULL, turn, own, 'orphan_result', '', '{"call_id":"' || own || '","result":' || coalesce(to_json(text)::VARCHAR, 'null') || '}'
FROM r WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.conv_id = r.conv_id AND c.own = r.own)
UNION ALL
SELECT conv_id, NULL, turn, NULL, 'unidentified', '', '{"call_id":null,"result":' || coalesce(to_json(text)::VARCHAR, 'null') || '}' FROM u
"""


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded; digests of ids and decoded text."""
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; held-out rows teach nothing."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~quality.held_out()))
    scored = docs.select("doc_id", quality.held_out().alias("held_out"), quality.scores(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op11_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of all for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents),
n AS (SELECT r, doc_id, len(words) AS n FROM d WHERE len(words) > 0),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
i AS (SELECT item_id, text, term, count(*) AS qtf FROM (SELECT item_id, text, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
s AS (SELECT i.item_id, i.text, n.doc_id, f.r, sum(i.qtf * w.weight * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (100 - 75 + (75 * n.n * c.docs) // c.terms))))::BIGINT AS score
  FROM i JOIN f USING (term) JOIN w USING (term) JOIN n ON n.r = f.r, c GROUP BY ALL),
o AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= {lexical.K}
"""


def op12_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate component of every vector."""
    found = lattice.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"), "kept")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's tokens of two tokenizers in groups that cover the same bytes, and how usual their links are."""
    return alignment.align_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_line_dedup, op3_exact_dedup, op4_token_counts, op5_curve_neighbours, op6_language_id,
    op7_simhash_near_dedup, op8_tool_calls, op9_bpe_round_trip, op10_quality_classifier,
    op11_dual_tree_search, op12_lattice_dedup, op13_token_alignment)}
ORACLES = {"op2_line_dedup": OP2_SQL, "op3_exact_dedup": OP3_SQL, "op8_tool_calls": OP8_SQL, "op11_dual_tree_search": OP11_SQL}
