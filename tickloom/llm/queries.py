"""The registered queries of the text operators; each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import chat_digest
from .decontaminate import decontaminate
from .exact_dedup import exact_groups
from .fill_middle import fill_in_middle, restored
from .importance import resample
from .langid import identify
from .line_dedup import drop_repeated_lines
from .ngram_join import ngram_components
from .passages import near_passages
from .perplexity import quality
from .sentencepieces import digests
from .token_file import token_file_digest
from .url_rules import filter_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "body")


def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_passages(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "line_counts.n_lines", "line_counts.n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: a conversation of control strings, formatted beside those of the table
CONTROL = r"\### Assistant: </turn> ok"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], rows.schema)
    return chat_digest(rows.unionByName(extra))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op10_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"), digests=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle(table(spark, sf_dir, "documents")).select("doc_id", "text", "fim.*")
    digests = F.sha2("text", 256).alias("output_sha256"), F.sha2(restored(F.col("text"), F.col("form")), 256).alias("restored_sha256")
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_perplexity": op2_perplexity,
    "op3_passages": op3_passages,
    "op4_line_dedup": op4_line_dedup,
    "op5_chat_format": op5_chat_format,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_language_id": op7_language_id,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_url_rules": op9_url_rules,
    "op10_token_file": op10_token_file,
    "op11_importance": op11_importance,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_fill_middle": op13_fill_middle,
}
_ESCAPED = r"replace(replace(replace({0}, '\', '\\'), '</turn>', '\l/turn>'), '### ', '\h## ')"

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = f"list_filter(regexp_split_to_array({_LOW}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
_WORDS = f"list_filter(regexp_split_to_array({_LOW}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

ORACLES: dict[str, str] = {
    "op11_importance": f"""
WITH crc AS (  -- the table of the polynomial, one byte at a time
  SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c FROM range(256) x(b))
), texts AS (
  SELECT 's' AS side, doc_id, {_ITEM_WORDS} AS ws FROM documents UNION ALL SELECT 't', item_id, {_ITEM_WORDS} FROM benchmark
), runs AS (
  SELECT side, doc_id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS f FROM texts
), hashed AS (
  SELECT f, xor(list_reduce(list_transform(range(octet_length(encode(f))), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM runs), crc
), counts AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM runs JOIN hashed USING (f) GROUP BY 1),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM counts) + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST((SELECT sum(t) FROM counts) + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM counts
), sums AS (SELECT doc_id, sum(gain) AS total FROM runs JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 's' GROUP BY 1),
weighed AS (
  SELECT doc_id, len(ws) AS n_words, len(ws) + greatest(0, len(ws) - 1) AS n_features,
    CAST(coalesce((total - ((total % (len(ws) + len(ws) - 1)) + (len(ws) + len(ws) - 1)) % (len(ws) + len(ws) - 1)) // (len(ws) + len(ws) - 1), 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM texts LEFT JOIN sums USING (doc_id) WHERE side = 's'
), scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM weighed),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= n * 25 // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
""",
    "op12_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents),
g AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(s) AS text_sha256 FROM g
""",
    "op13_fill_middle": r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS s, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS d FROM documents),
c AS (
  SELECT doc_id, s, u, len(u) AS n, CAST('0x' || substr(d, 1, 8) AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || substr(d, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
    CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 AS p, CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 AS q FROM h
), f AS (
  SELECT *, CASE WHEN s = '' OR contains(s, '<P>') OR contains(s, '<S>') OR contains(s, '<M>') OR p >= 90 THEN 'plain' WHEN q < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1 : least(x, y)], '') AS a, array_to_string(u[least(x, y) + 1 : greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1 :], '') AS z FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN s WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256, sha256(s) AS restored_sha256 FROM f
""",
    "op1_decontaminate": f"""
WITH iw AS (SELECT item_id, {_ITEM_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS m, array_to_string(ws[i : i + 12], ' ') AS k
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, least(len(ws), 1)) + 1)) AS i FROM iw)
), dw AS (SELECT doc_id, {_ITEM_WORDS} AS ws FROM documents),
g AS (
  SELECT doc_id, m, i, array_to_string(ws[i : i + m - 1], ' ') AS k
  FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM dw, (SELECT DISTINCT m FROM win))
), hit AS (SELECT doc_id, item_id, i, g.m FROM g JOIN win ON g.m = win.m AND g.k = win.k),
n_hit AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS w FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN n_hit USING (doc_id) LEFT JOIN it USING (doc_id)
""",
    "op8_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, ways.b FROM r JOIN ways ON r.reach = ways.a)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(reach) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
""",
    "op5_chat_format": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL}'
  UNION ALL SELECT -7, 1, 'assistant', '{CONTROL}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(4 + length(replace({_ESCAPED.format("role")}, ':', '\\c')) + 2 + length({_ESCAPED.format("text")}) + 8) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
""",
    "op4_line_dedup": """
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), lost AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN keeper <> doc_id THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN keeper <> doc_id THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM lines LEFT JOIN lost USING (k) GROUP BY doc_id
""",
}
