"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from . import (
    chunks,
    decontam,
    jaccard,
    line_dedup,
    mixing,
    prefix_trie,
    quality,
    quotes,
    resampling,
    suffix_dedup,
    token_counts,
    tokens_binary,
    toxicity,
)
from .common import save, table

Query = Callable[[SparkSession, str], DataFrame]

MIX_WEIGHTS = (3, 1, 2)
MIX_SHARE = 1.5
MIX_CAP = 2


def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: sources weigh 3, 1, 2 in turn and share 150 % of all words."""
    items = mixing.size_table(spark, table(spark, sf_dir, "documents"))
    targets = mixing.source_targets(items, MIX_WEIGHTS, MIX_SHARE, MIX_CAP)
    mixed = mixing.entropy_mix(spark, items, targets, MIX_CAP)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "rate", "copies")


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules per document and the verdict of its source as host."""
    found = quality.features(table(spark, sf_dir, "documents"), F.col("source"))
    judged = quality.judge(save(spark, found, "quality"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
), r AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c >= 2
), covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM r, (SELECT unnest(range(0, 5)) AS j) GROUP BY doc_id
), base AS (
  SELECT doc_id, host, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base
), hosts AS (
  SELECT host, count(*) AS docs, count(*) FILTER (base_failed) AS failures FROM judged GROUP BY host
), prior AS (
  SELECT m, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE 0.0 END AS s
  FROM (SELECT avg(failures / docs) AS m, var_pop(failures / docs) AS v FROM hosts)
), verdicts AS (
  SELECT host, (failures + m * s) / (docs + s) >= 0.5 AS rejected FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged JOIN verdicts USING (host)
"""


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents: words hit, items found."""
    found = decontam.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), win AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM (SELECT *, least(len(ws), 10) AS k FROM b WHERE len(ws) > 0))
), lens AS (
  SELECT DISTINCT k FROM win
), g AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, lens WHERE len(ws) >= k)
), hits AS (
  SELECT doc_id, g.k AS k, i, item_id FROM g JOIN win ON g.w = win.w AND g.k = win.k
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS l
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op4_mil_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy-or toxicity of all documents, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(spark, docs, table(spark, sf_dir, "labels").filter(~toxicity.held_out()))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer file (the same on driver and executors)."""
    import public_tokenizers

    return public_tokenizers.path(name)


END_ID = 2


def op6_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as coded token blocks and read back: place, count and checksum of their ids."""
    path = tokens_binary.write_tokens(
        spark, table(spark, sf_dir, "documents"), fresh_path(spark, "token-file"), tokenizer_path(), END_ID
    )
    read = tokens_binary.read_tokens(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotations."""
    return quotes.reply_ordered(spark, table(spark, sf_dir, "conversations"))


def op7_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that a smaller document holds in a string of 50 bytes, removed."""
    return suffix_dedup.removal_digest(spark, table(spark, sf_dir, "documents"))


def op8_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated chunks: bytes removed, removed spans and the rest's checksum."""
    out = chunks.dedup_chunks(spark, table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2(F.coalesce("kept", F.lit("").cast("binary")), 256).alias("kept_sha256"),
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose shingle sets are similar."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.similar_documents(spark, docs).select("doc_id", "n_shingles", "component_id")


def op10_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every sentence of all documents, each document encoded once as a whole."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return token_counts.section_tokens(docs, tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


# crc32 in SQL: the 256-entry table by its rule (fixed value: the reflected polynomial), then one step per byte.
CRC_TABLE = """
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) AS crc
"""


def _crc_sql(text: str) -> str:
    """DuckDB's crc32 of the UTF-8 bytes of the expression ``text``; ``crc`` is the table."""
    steps = f"""list_transform(range(octet_length(encode({text}))),
         lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"""
    return f"xor(list_reduce(list_concat([4294967295], {steps}), lambda a, x: xor(a // 256, crc[xor(a % 256, x) + 1])), 4294967295)"


FAMILY = 20
HEADS = 4


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt on the head of its family's first."""
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % HEADS
    return prefix_trie.prefix_trie(spark, table(spark, sf_dir, "conversations"), conv - conv % FAMILY, head, HEADS - 1)


OP11_SQL = rf"""
WITH table256 AS ({CRC_TABLE}), t AS (
  SELECT CAST(conv_id AS BIGINT) AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations
  WHERE conv_id IS NOT NULL
), hashed AS (
  SELECT *, sha256(length(role) || ':' || role || text) AS turn_hash,
         CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS words FROM t
), turns AS (
  SELECT c, turn_hash, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, turn_hash) AS pos FROM hashed
), convs AS (
  SELECT c, c - c % 20 AS b, {_crc_sql("CAST(c AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT c FROM turns), table256
), rebuilt AS (
  SELECT convs.c, 0 AS part, pos, turn_hash, words FROM convs JOIN turns ON turns.c = convs.b AND pos <= h
  UNION ALL SELECT convs.c, 1, pos, turn_hash, words FROM convs JOIN turns ON turns.c = convs.c AND pos > h
), paths AS (
  SELECT c, row_number() OVER w AS depth, md5(string_agg(turn_hash, '') OVER w) AS key, words
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, pos)
  UNION ALL SELECT c, 0, '', 0 FROM convs
), steps AS (
  SELECT *, lag(key) OVER w AS parent, lead(key) OVER w AS next FROM paths WINDOW w AS (PARTITION BY c ORDER BY depth)
), nodes AS (
  SELECT depth, key, min(c) AS conv_id, min(parent) AS parent, count(*) AS n_convs, count(DISTINCT next) AS n_children,
         (count(*) - 1) * min(words) AS charge,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (next IS NULL), '')) AS ends_sha256
  FROM steps GROUP BY depth, key
), sums AS (
  SELECT p.depth, p.key, CAST(sum(charge) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM nodes n JOIN paths p ON p.c = n.conv_id AND p.depth <= n.depth GROUP BY p.depth, p.key
), whole AS (
  SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256, n.key
  FROM nodes n JOIN sums USING (depth, key) LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.key = n.parent
)
SELECT conv_id, whole.depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256,
       CASE WHEN whole.depth > 0 THEN CASE WHEN part = 0 THEN b ELSE whole.conv_id END END AS source, pos AS place
FROM whole LEFT JOIN (
  SELECT c, part, pos, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth FROM rebuilt
) r ON r.c = whole.conv_id AND r.depth = whole.depth
LEFT JOIN convs ON convs.c = whole.conv_id
"""


def op12_cuckoo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that at least three hold, the largest holder aside."""
    out = line_dedup.dedup_lines(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.coalesce("kept", F.lit("")).cast("binary")
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT doc_id, i, line, keeper IS NOT NULL AND doc_id < keeper AS dropped FROM k LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed by how much they resemble the benchmark; a tenth of those long enough is drawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = resampling.score(spark, docs, resampling.learn_gains(docs, table(spark, sf_dir, "benchmark")))
    return resampling.draw(spark, scored).select("doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = rf"""
WITH table256 AS ({CRC_TABLE}), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
), dw AS (
  SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM d) GROUP BY doc_id, w
), distinct_words AS (
  SELECT w FROM dw UNION SELECT w FROM b
), codes AS (
  SELECT w, {_crc_sql("w")} % 10000 AS bucket FROM distinct_words, table256
), source AS (
  SELECT bucket, sum(n) AS s FROM dw JOIN codes USING (w) GROUP BY bucket
), target AS (
  SELECT bucket, count(*) AS t FROM b JOIN codes USING (w) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM source) + 10000) AS DOUBLE)
         / CAST((s + 1) * ((SELECT coalesce(sum(t), 0) FROM target) + 10000) AS DOUBLE))) AS gain
  FROM source LEFT JOIN target USING (bucket)
), weights AS (
  SELECT doc_id, CAST(sum(n * CAST(gain AS BIGINT)) AS BIGINT) AS weight
  FROM dw JOIN codes USING (w) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000.0 * ln(-ln((CAST(CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT)
         AS DOUBLE) + 0.5) / 4294967296.0))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""


QUERIES: dict[str, Query] = {
    "op1_entropy_mix": op1_entropy_mix,
    "op2_host_rules": op2_host_rules,
    "op3_decontaminate": op3_decontaminate,
    "op4_mil_toxicity": op4_mil_toxicity,
    "op5_quote_linking": op5_quote_linking,
    "op6_rans_tokens": op6_rans_tokens,
    "op7_run_length_index": op7_run_length_index,
    "op8_gear_chunks": op8_gear_chunks,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_section_tokens": op10_section_tokens,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_cuckoo_lines": op12_cuckoo_lines,
    "op13_importance_resample": op13_importance_resample,
}

ORACLE_SQL: dict[str, str] = {
    "op2_host_rules": OP2_SQL,
    "op3_decontaminate": OP3_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_cuckoo_lines": OP12_SQL,
    "op13_importance_resample": OP13_SQL,
}
