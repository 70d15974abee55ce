"""The registered query of each operator (production parameters, whole tables) and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (bagminhash, langid, mixing, packing, preference, quality, ranking, sharding, tokenfile, trie,
                           vectors, warc, winnowing)
from ordermill.llm.common import table
from ordermill.session import scratch_path

SHARDS = 16


def _fresh(spark: SparkSession, name: str) -> str:
    import uuid

    return scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def op1_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents"), SHARDS)


def op2_bagminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_pstable_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = preference.format_pairs(*preference.reply_pairs(table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("+", s["start"], s["length"])), ",")
    return found.withColumns({c: spans(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def op6_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "token-files")
    tokenfile.write(table(spark, sf_dir, "documents"), path)
    return tokenfile.read(spark, path)


def op7_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read(spark, path))


def op8_rank_order_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_bin_completion_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_bag_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_nodes(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _bits(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


#: Table of the crc32 polynomial (3988292384, a fixed value), as SQL makes it.
_CRC_TABLE = """crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (
  WITH RECURSIVE b(i, k, v) AS (
    SELECT range, 0, range::BIGINT FROM range(256)
    UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM b WHERE k < 8)
  SELECT i, v FROM b WHERE k = 8))"""


def _crc(text: str) -> str:
    """A crc32 subquery over table ``crc``: bytes of the text folded through the table."""
    bytes_ = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return (f"xor(list_reduce({bytes_}, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), "
            "4294967295::BIGINT)")


def _op1_sql() -> str:
    def jump(n: int, name: str) -> str:
        return f"""{name}(doc_id, state, shard, ahead) AS (
  SELECT doc_id, key::UHUGEINT, 0::BIGINT, 0::BIGINT FROM keys
  UNION ALL
  SELECT doc_id, s, ahead, floor((ahead + 1) * (2147483648.0::DOUBLE / ((s // 8589934592::UHUGEINT)::DOUBLE + 1)))::BIGINT
  FROM (SELECT *, (state * 2862933555777941757::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT AS s
        FROM {name} WHERE ahead < {n}))"""
    return f"""WITH RECURSIVE {_CRC_TABLE},
keys AS (SELECT doc_id, {_bits("doc_id::VARCHAR")} AS key FROM documents),
{jump(SHARDS, "j")}, {jump(SHARDS + 1, "g")},
rows AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_crc("coalesce(text, '')")} AS text_crc32
         FROM documents, crc)
SELECT r.doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, j.shard::INT AS shard,
  row_number() OVER (PARTITION BY j.shard ORDER BY {_bits("'slot:' || r.doc_id::VARCHAR || ':' || text_crc32::VARCHAR || ':' || size::VARCHAR")} % {sharding.SLOT_PIECES}, r.doc_id) - 1 AS slot,
  g.shard::INT AS grown_shard
FROM rows r JOIN j ON j.doc_id = r.doc_id AND j.ahead >= {SHARDS} JOIN g ON g.doc_id = r.doc_id AND g.ahead >= {SHARDS + 1}"""


OP2_SQL = """WITH RECURSIVE texts AS (SELECT min(doc_id) AS id, text FROM documents WHERE text IS NOT NULL GROUP BY text),
w AS (SELECT id, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS w FROM texts),
s AS (SELECT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
c AS MATERIALIZED (SELECT id, g, count(*) AS n FROM s GROUP BY ALL),
t AS (SELECT id, sum(n) AS n FROM c GROUP BY id),
p AS (SELECT a.id AS a, b.id AS b, sum(least(a.n, b.n)) AS o FROM c a JOIN c b ON a.g = b.g AND a.id < b.id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN t x ON x.id = a JOIN t y ON y.id = b WHERE o >= 0.8 * (x.n + y.n - o)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, other) AS (SELECT id, id FROM texts UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other),
k AS (SELECT id, min(other) AS class_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(class_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN texts x ON x.text = d.text LEFT JOIN k ON k.id = x.id"""

OP3_SQL = """WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
e AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
r(id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other)
SELECT v.vec_id, (SELECT count(*) FROM e WHERE e.a = v.vec_id) AS n_links,
  (SELECT min(other) FROM r WHERE r.id = v.vec_id) AS component_id,
  (SELECT min(other) FROM r WHERE r.id = v.vec_id) = v.vec_id AS kept FROM v"""

OP5_SQL = """WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, max({'turn': turn, 'text': text}) AS l FROM rows WHERE role = 'assistant' GROUP BY conv_id),
swap AS (SELECT a.conv_id, a.l, coalesce(b.l.text, '') AS other FROM last a LEFT JOIN last b ON b.conv_id = xor(a.conv_id, 1)),
turns AS (
  SELECT 'c' AS side, conv_id AS pair_id, turn, role, text FROM rows
  UNION ALL
  SELECT 'r', r.conv_id, r.turn, r.role, CASE WHEN r.role = 'assistant' AND r.turn = s.l.turn AND r.text = s.l.text THEN s.other ELSE r.text END
  FROM rows r LEFT JOIN swap s USING (conv_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY side, pair_id ORDER BY turn, role, text) AS k FROM turns),
differ AS (SELECT coalesce(a.pair_id, b.pair_id) AS pair_id,
    min(CASE WHEN a.role = b.role AND a.text = b.text THEN NULL ELSE coalesce(a.k, b.k) END) AS first, count(*) AS n
  FROM (SELECT * FROM placed WHERE side = 'c') a FULL JOIN (SELECT * FROM placed WHERE side = 'r') b ON a.pair_id = b.pair_id AND a.k = b.k
  GROUP BY 1),
cut AS (SELECT pair_id, coalesce(first - 1, n) AS common FROM differ),
said AS (SELECT p.*, common, k <= common AS shared, '<|' || role || '|>' || chr(10) AS head, text || chr(10) || '<|end|>' || chr(10) AS body
  FROM placed p JOIN cut USING (pair_id)),
spans AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY side, pair_id, shared ORDER BY k) - length(body) AS pos FROM said),
side AS (SELECT pair_id, side, common, coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE shared), '') AS prompt,
    coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE NOT shared), '') AS rest,
    coalesce(string_agg(pos::VARCHAR || '+' || length(body)::VARCHAR, ',' ORDER BY k) FILTER (WHERE NOT shared AND role = 'assistant'), '') AS mask
  FROM spans GROUP BY 1, 2, 3)
SELECT c.pair_id, c.common::INT AS common_turns, c.prompt, c.rest AS chosen, c.mask AS chosen_mask, r.rest AS rejected, r.mask AS rejected_mask
FROM side c JOIN side r ON r.pair_id = c.pair_id AND c.side = 'c' AND r.side = 'r'"""

OP7_SQL = """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first,
  translate(""" + " || ".join(f"lpad(to_base(('0x' || substr(h, {1 + 10 * i}, 10))::BIGINT, 32), 8, '0')" for i in range(4)) + \
    f""", '{warc.DIGITS}', '{warc.BASE32}') AS payload_digest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM d"""

OP9_SQL = f"""WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
total AS (SELECT sum(n) AS rows, sum(pow(n, {mixing.SMOOTHING})) AS w FROM sizes),
rates AS (SELECT source, pow(n, {mixing.SMOOTHING}) / w * rows / n AS rate FROM sizes, total),
ks AS (SELECT source, rate, unnest(range(floor(rate + 14 * sqrt(rate) + 30)::BIGINT)) AS k FROM rates),
cdf AS (SELECT source, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p FROM ks),
drawn AS (SELECT d.*, {_bits(f"'{mixing.SEED}:' || doc_id::VARCHAR")} / {float(1 << 60)!r} AS u FROM documents d),
counts AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.rate, count(*) FILTER (WHERE c.p <= d.u) AS copies
  FROM drawn d JOIN cdf c ON c.source IS NOT DISTINCT FROM d.source GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, rate, copy::INT AS copy FROM counts, unnest(range(0, copies)) t(copy)"""

OP12_SQL = r"""WITH spelt AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), $UPPER, $LOWER), $TERM) AS t FROM documents),
d AS MATERIALIZED (SELECT r, doc_id, len(t)::BIGINT AS n, t FROM spelt WHERE len(t) > 0),
asked AS (SELECT DISTINCT item_id, text FROM benchmark),
i AS MATERIALIZED (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), $UPPER, $LOWER), $TERM)) AS term FROM asked),
q AS (SELECT i, item_id, term, count(*) AS k FROM i GROUP BY ALL),
f AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
a AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term), a),
m AS (SELECT r, doc_id, 100 - 75 + (75 * n * docs) // terms AS m FROM d, a),
s AS (SELECT i, item_id, r, doc_id, sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""
for _name, _text in (("$UPPER", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("$LOWER", "abcdefghijklmnopqrstuvwxyz"),
                     ("$TERM", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
    OP12_SQL = OP12_SQL.replace(_name, f"'{_text}'")

OP13_SQL = f"""WITH RECURSIVE {_CRC_TABLE},
t AS MATERIALIZED (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (SELECT conv_id, {_crc("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t), crc),
r AS (SELECT c.conv_id, 0 AS own, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND k <= h
  UNION ALL SELECT c.conv_id, 1, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND k > h),
p AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY own, k) AS depth FROM r),
m AS MATERIALIZED (SELECT conv_id, depth, list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY depth) AS path,
    len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words FROM p
  UNION ALL SELECT conv_id, 0, [], 0 FROM c),
l AS (SELECT conv_id, max(depth) AS last FROM m GROUP BY conv_id),
n AS MATERIALIZED (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = last), '')) AS ends_sha256
  FROM m JOIN l USING (conv_id) GROUP BY depth, path),
k AS (SELECT path[:-2] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
x AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
u AS (SELECT m.path, count(*) FILTER (WHERE x.n_children = 0) AS n_leaves, sum((x.n_convs - 1) * x.words) AS saved_tokens
  FROM x JOIN m ON m.conv_id = x.conv_id AND m.depth <= x.depth GROUP BY m.path)
SELECT x.conv_id, x.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves,
  saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM x JOIN u USING (path) LEFT JOIN n up ON up.depth = x.depth - 1 AND up.path = x.path[:-2]"""

QUERIES = {f.__name__: f for f in (
    op1_jump_sharding, op2_bagminhash_dedup, op3_pstable_embeddings, op4_winnowing, op5_preference_format,
    op6_repair_token_files, op7_warc_chain, op8_rank_order_langid, op9_poisson_mixing, op10_bin_completion_packing,
    op11_additive_quality, op12_bag_ranking, op13_prefix_trie, pipeline)}
ORACLE = {"op1_jump_sharding": _op1_sql(), "op2_bagminhash_dedup": OP2_SQL, "op3_pstable_embeddings": OP3_SQL,
          "op5_preference_format": OP5_SQL, "op7_warc_chain": OP7_SQL, "op9_poisson_mixing": OP9_SQL,
          "op12_bag_ranking": OP12_SQL, "op13_prefix_trie": OP13_SQL}
