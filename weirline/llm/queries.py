"""The operators as registered queries, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversations,
    decontam,
    line_dedup,
    packing,
    phrases,
    pii,
    quality,
    secret_scan,
    sentence_pieces,
    sharding,
    simhash,
    token_files,
    topk,
)
from .common import shared_path



def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark, sf_dir):
    """Each document's words, hit words and benchmark items."""
    return decontam.scan(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark")).drop("spans")


def op2_sentence_pieces(spark, sf_dir, model=None):
    """Pieces of every document under merge-dropout: their count, checksum, and whether they decode to the text."""
    model = model or vocabulary("piece_bpe_32k.model")
    return sentence_pieces.round_trip(_t(spark, sf_dir, "documents"), model, dropout=0.1, seed=1)


def op3_secret_scan(spark, sf_dir):
    """Findings of every document, each with its word's number and a digest instead of the secret itself."""
    found = secret_scan.scan(_t(spark, sf_dir, "documents"))
    return found.select("doc_id", "word", F.sha2("candidate", 256).alias("candidate_sha256"), "probability")


def op4_personal_data(spark, sf_dir):
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    return pii.find(_t(spark, sf_dir, "documents"))


def op5_quality(spark, sf_dir):
    """Each document's perplexity, its language's threshold and whether it is accepted."""
    return quality.assess(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


def op6_line_dedup(spark, sf_dir):
    """Each document's lines, dropped lines and a digest of what stays."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op7_exact_top_k(spark, sf_dir):
    """The 20 nearest vectors of every twentieth one."""
    table = _t(spark, sf_dir, "embeddings")
    return topk.top_k(table, table.filter(F.col("vec_id") % 20 == 0))


def op8_simhash(spark, sf_dir):
    """Each document's fingerprint and component."""
    found = simhash.near_duplicates(_t(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op9_sharding(spark, sf_dir):
    """Each document's shard and place under the law of near-equal bytes."""
    return sharding.assign(_t(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_token_files(spark, sf_dir, tokenizer=None):
    """Where each document's ids lie in the files, and their checksum, as read back from them."""
    path = shared_path(spark, "tokens")
    token_files.write(_t(spark, sf_dir, "documents"), tokenizer or vocabulary("word_bpe_49k.json"), path)
    files = spark.read.schema(token_files.FILE).parquet(path)
    return token_files.placed(files, token_files.digests(files)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_packing(spark, sf_dir, tokenizer=None):
    """Each piece's sequence of at most 2048 ids and its place there."""
    return packing.pack(_t(spark, sf_dir, "documents"), tokenizer or vocabulary("word_bpe_49k.json"), capacity=2048, end_id=0)


def op12_phrases(spark, sf_dir):
    """Each language's first 2000 phrases that occur at least 100 times."""
    return phrases.collocations(_t(spark, sf_dir, "documents"), least=100, top=2000)


def op13_conversations(spark, sf_dir):
    """Each damaged conversation's faults, cheapest edits and the digest of what they make of it."""
    return conversations.repair(conversations.damage(_t(spark, sf_dir, "conversations")))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT o.doc_id, o.k, o.n, win.item_id FROM occ o JOIN win ON o.n = win.n AND o.g = win.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS sha
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6_SQL = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS keep_doc FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(common.key) FILTER (doc_id <> keep_doc) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (common.key IS NULL OR doc_id = keep_doc), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id
"""

OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)))
WHERE rank <= 20
"""

OP12_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
size AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM split GROUP BY lang),
counts AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k))
  GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2),
covered AS (SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN (
    SELECT lang, f, array_to_string(w[i:i + j - 1], ' ') AS phrase FROM (
      SELECT *, unnest(range(1, k - j + 2)) AS i FROM cand, (SELECT unnest([2, 3, 4]) AS j) WHERE j < k)) o
  ON c.lang = o.lang AND c.phrase = o.phrase AND 100 * o.f >= 100 * c.f),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, n, cut, l.f AS l, r.f AS r, 1000 * c.f * n // (l.f * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c JOIN size USING (lang)
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
  WHERE NOT EXISTS (SELECT 1 FROM covered v WHERE v.lang = c.lang AND v.phrase = c.phrase)),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best) WHERE rank <= 2000
"""

#: The CRC-32 of a key bit by bit; then costs from the end on, a row at a time, and edits from the begin on.
OP13_SQL = r"""
WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
cases AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    range(1, len(key) + 1), lambda i: [CAST(ascii(key[i]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)), 4294967295) % 20 AS k FROM keyed),
damaged AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE k WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM cases WHERE k <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    count(*) OVER (PARTITION BY conv_id) AS n, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
told AS (SELECT *, body = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    right(body, 1) NOT IN ('.', '!', '?') AS cut, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS j
  FROM placed),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated,
    count(*) FILTER (j IS NOT NULL AND j || i NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY conv_id),
turns AS (SELECT conv_id, pos, n, role, text, i, CASE WHEN blank OR again THEN NULL WHEN cut THEN 5 ELSE 0 END AS stay FROM told),
-- b0 to b3: costs to the end where the repaired rows end in nothing, s, u, a
back AS (SELECT conv_id, n + 1 AS pos, 0 AS b0, 10 AS b1, 5 AS b2, 0 AS b3 FROM turns WHERE pos = n
  UNION ALL SELECT conv_id, pos, least(d0, 5 + d2, 10 + d3), least(d1, 5 + d2, 10 + d3), least(d2, 5 + d3), least(d3, 5 + d2) FROM (
    SELECT t.conv_id, t.pos,
      least(2 + b0, stay + 1 + b2, CASE i WHEN 's' THEN stay + b1 WHEN 'u' THEN stay + b2 END) AS d0,
      least(2 + b1, stay + 1 + b2, CASE i WHEN 'u' THEN stay + b2 END) AS d1,
      least(2 + b2, stay + 1 + b3, CASE i WHEN 'a' THEN stay + b3 END) AS d2,
      least(2 + b3, stay + 1 + b2, CASE i WHEN 'u' THEN stay + b2 END) AS d3
    FROM back JOIN turns t ON back.conv_id IS NOT DISTINCT FROM t.conv_id AND t.pos = back.pos - 1)),
costs AS (SELECT conv_id, pos, unnest([0, 1, 2, 3]) AS q, unnest([b0, b1, b2, b3]) AS b FROM back),
ways AS (  -- each state's next edits, of which the cheapest and then the least is taken
  SELECT conv_id, pos, q, arg_min(struct_pack(e := edit, p := to_pos, q := to_q, line := line), (cost, edit)) AS way FROM (
    SELECT c.conv_id, c.pos, c.q, edit, to_pos, to_q, line, step + f.b AS cost FROM (
      SELECT c.*, 'I' AS edit, c.pos AS to_pos, CASE c.q WHEN 2 THEN 3 ELSE 2 END AS to_q, 5 AS step,
        CASE c.q WHEN 2 THEN 'assistant:' ELSE 'user:' END AS line FROM costs c
      UNION ALL SELECT c.*, 'D', c.pos + 1, c.q, 2, NULL FROM costs c JOIN turns t ON c.conv_id IS NOT DISTINCT FROM t.conv_id AND c.pos = t.pos
      UNION ALL SELECT c.*, 'R', c.pos + 1, CASE c.q WHEN 2 THEN 3 ELSE 2 END, 1 + stay,
        CASE c.q WHEN 2 THEN 'assistant:' ELSE 'user:' END || text
        FROM costs c JOIN turns t ON c.conv_id IS NOT DISTINCT FROM t.conv_id AND c.pos = t.pos WHERE stay IS NOT NULL
      UNION ALL SELECT c.*, 'K', c.pos + 1, CASE i WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, stay, role || ':' || text
        FROM costs c JOIN turns t ON c.conv_id IS NOT DISTINCT FROM t.conv_id AND c.pos = t.pos
        WHERE stay IS NOT NULL AND (i = 'u' AND c.q <> 2 OR i = 'a' AND c.q = 2 OR i = 's' AND c.q = 0)) c
    JOIN costs f ON c.conv_id IS NOT DISTINCT FROM f.conv_id AND f.pos = to_pos AND f.q = to_q
    WHERE step + f.b = c.b) GROUP BY conv_id, pos, q),
walk AS (SELECT conv_id, 1 AS pos, 0 AS q, '' AS audit, CAST(NULL AS VARCHAR) AS body FROM turns WHERE pos = 1
  UNION ALL SELECT w.conv_id, way.p, way.q, audit || way.e,
    CASE WHEN way.line IS NULL THEN body WHEN body IS NULL THEN way.line ELSE body || chr(10) || way.line END
  FROM walk w JOIN ways USING (pos, q) WHERE w.conv_id IS NOT DISTINCT FROM ways.conv_id),
done AS (SELECT w.conv_id, audit, body, b.b0 AS cost FROM walk w JOIN back f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.pos = f.pos
  JOIN back b ON w.conv_id IS NOT DISTINCT FROM b.conv_id AND b.pos = 1
  WHERE w.q IN (0, 3) AND NOT EXISTS (SELECT 1 FROM turns t WHERE t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.pos = w.pos))
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN done d ON c.conv_id IS NOT DISTINCT FROM d.conv_id
"""

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_sentence_pieces": op2_sentence_pieces,
    "op3_secret_scan": op3_secret_scan,
    "op4_personal_data": op4_personal_data,
    "op5_quality": op5_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_simhash": op8_simhash,
    "op9_sharding": op9_sharding,
    "op10_token_files": op10_token_files,
    "op11_packing": op11_packing,
    "op12_phrases": op12_phrases,
    "op13_conversations": op13_conversations,
}

ORACLE_SQL = {
    "op1_decontamination": OP1_SQL,
    "op6_line_dedup": OP6_SQL,
    "op7_exact_top_k": OP7_SQL,
    "op12_phrases": OP12_SQL,
    "op13_conversations": OP13_SQL,
}
