"""The registered queries of the operators for training data, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstone.llm import (
    bpe,
    chat,
    decontamination,
    filter_audit,
    jaccard_join,
    language_model,
    merkle,
    packing,
    quality_classifier,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


_CONTROLS = (chat.TURN, chat.BODY, chat.NEXT, chat.END, *chat.ChatTemplate().controls)
# No control string starts inside another one's first two characters, so replacing one after
# the other is the same as all at once.
_ESCAPED = "replace({}, '\\', '\\\\')"
for _c in _CONTROLS:
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\{_c[1:]}')"

CHAT_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NOT DISTINCT FROM role AS same,
         length({_ESCAPED.format("text")}) AS size, length({_ESCAPED.format("role")}) AS role_size
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size + CASE WHEN same THEN {len(chat.NEXT)}
                ELSE role_size + {len(chat.TURN + chat.BODY + chat.END)} END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id"""


@register("op3_chat_format", CHAT_SQL)
def op3_chat_format(spark: SparkSession, root: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    out = chat.format_conversations(rows.unionByName(probe))
    read = out.select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
    )
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


_RULES = quality_rules.LineRules()
_PHRASES = " OR ".join(f"contains(lower(line), '{p}')" for p in _RULES.boilerplate)
_GAP = r"[\x20\x09-\x0D]"

QUALITY_SQL = rf"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS text FROM documents),
word AS (
  SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) AS p
  FROM (SELECT k, list_filter(string_split_regex(text, '{_GAP}+'), lambda x: x <> '') AS ws FROM doc)),
win AS (
  SELECT k, p, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3
  FROM word WINDOW o AS (PARTITION BY k ORDER BY p)),
rep AS (
  SELECT k, p, count(*) OVER (PARTITION BY k, w, w2, w3) > 1 AS twice FROM win WHERE w3 IS NOT NULL),
covered AS (
  SELECT k, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT k, p + unnest([0, 1, 2]) AS q FROM rep WHERE twice) GROUP BY k),
lines AS (
  SELECT k, unnest(string_split(text, chr(10))) AS line FROM doc),
judged AS (
  SELECT k, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         length(line) - length(regexp_replace(line, '{_GAP}', '', 'g')) AS spaces
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
per AS (
  SELECT k, count(*) - count(DISTINCT line) AS n_dup_lines,
         sum(CASE WHEN (n >= {_RULES.min_bare_words} AND NOT regexp_matches(line, '{_RULES.sentence_mark}'))
               OR len(regexp_extract_all(line, '{_RULES.noise}')) * {_RULES.noise_every} >= n
               OR len(regexp_extract_all(line, '{_RULES.separator}')) * {_RULES.separator_every} >= n
               OR (n <= {_RULES.max_menu_words} AND regexp_matches(lower(line), '{_RULES.menu}'))
               OR {_PHRASES} THEN length(line) - spaces ELSE 0 END) AS lost
  FROM judged GROUP BY k),
base AS (
  SELECT d.doc_id, (SELECT count(*) FROM word w WHERE w.k = d.k) AS n_words,
         length(regexp_replace(text, '{_GAP}', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(lost, 0) AS lost
  FROM doc d LEFT JOIN per USING (k) LEFT JOIN covered USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
       NOT failed AND NOT 100 * lost > {_RULES.max_lost_percent} * word_chars AS kept
FROM (SELECT *, n_words < {_RULES.min_words} OR 100 * n_repeat_words > 50 * n_words AS failed FROM base)"""


@register("op6_quality_rules", QUALITY_SQL)
def op6_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    return quality_rules.clean_documents(table(spark, root, "documents")).drop("cleaned", "lost_chars")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    return bpe.digests(table(spark, root, "documents"), tokenizer_path())


@register("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    return quality_classifier.classify(
        table(spark, root, "documents"), table(spark, root, "labels")
    )


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.classify(table(spark, root, "documents"), table(spark, root, "labels"))


# Brute force: every window of every document with the smallest document that has it.
SUBSTRING_SQL = r"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS k,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (
  SELECT doc_id, k, p, list_slice(ws, p, p + 49) AS seq
  FROM (SELECT *, unnest(range(1, len(ws) - 48)) AS p FROM doc)),
owned AS (SELECT k, p, doc_id, min(doc_id) OVER (PARTITION BY seq) AS low FROM win),
gone AS (SELECT DISTINCT k, p + unnest(range(0, 50)) AS q FROM owned WHERE low < doc_id),
word AS (SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) AS q FROM doc),
kept AS (
  SELECT word.k, string_agg(w, ' ' ORDER BY q) AS text FROM word ANTI JOIN gone USING (k, q) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN (SELECT k, count(*) AS n FROM gone GROUP BY k) USING (k) LEFT JOIN kept USING (k)"""


@register("op1_substring_dedup", SUBSTRING_SQL)
def op1_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(documents, output="digest").withColumnRenamed(
        "kept", "kept_sha256"
    )


# Brute force: all pairs of sets that share a shingle; components by repeated least labels.
JACCARD_SQL = r"""
WITH RECURSIVE doc AS (SELECT doc_id, row_number() OVER () AS k,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, k, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i : i + 4], ' ') for i in range(1, len(ws) - 3)]) END AS s FROM doc),
gram AS (SELECT k, len(s) AS n, unnest(s) AS g FROM sets),
pair AS (
  SELECT a.k AS a, b.k AS b FROM gram a JOIN gram b ON a.g = b.g AND a.k <> b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (
  SELECT a AS k, a AS r FROM pair UNION SELECT reach.k, pair.b FROM reach JOIN pair ON reach.r = pair.a),
low AS (SELECT reach.k, min(doc_id) AS low FROM reach JOIN doc ON doc.k = reach.r GROUP BY reach.k)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(low, doc_id) AS component_id
FROM sets LEFT JOIN low USING (k)"""


@register("op8_jaccard_join", JACCARD_SQL)
def op8_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    return jaccard_join.classes(table(spark, root, "documents")).drop("key", "class")


@register("op9_decontamination")
def op9_decontamination(spark: SparkSession, root: str) -> DataFrame:
    return decontamination.findings(
        table(spark, root, "documents"), table(spark, root, "benchmark")
    ).select("doc_id", "item_id", "covered_words", "longest_run", "item_words", "n_slots")


@register("op7_lm_score")
def op7_lm_score(spark: SparkSession, root: str) -> DataFrame:
    return language_model.score(table(spark, root, "documents"))


@register("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(documents, digest=True).withColumnRenamed("kept", "kept_sha256")


# The trees are grown and the tampered rows folded level by level in recursive queries.
MERKLE_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
doc AS (
  SELECT *, row_number() OVER () AS k, (SELECT t FROM crc_table) AS t,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END ||
    CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END ||
    CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END ||
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head
  FROM documents),
rows AS (
  SELECT doc_id, source, k,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '') END AS changed, head
  FROM doc),
leaves AS (
  SELECT *, CASE WHEN crc % 2 = 0 THEN sha256(head || changed) ELSE leaf END AS start,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n FROM rows),
-- Nodes of the trees of the sources: level, place, digest; n is what the level has.
node AS (
  SELECT source, 0 AS level, i, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT source, level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (n + 2) // 3
  FROM node WHERE n > 1 GROUP BY source, level, i // 3, n),
sub AS (
  SELECT source, digest, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j, count(*) OVER () AS n
  FROM node WHERE n = 1),
top AS (
  SELECT 0 AS level, j, digest, n FROM sub
  UNION ALL
  SELECT level + 1, j // 3, sha256(string_agg(digest, '' ORDER BY j)), (n + 2) // 3
  FROM top WHERE n > 1 GROUP BY level, j // 3, n),
lower_step AS (
  SELECT a.source, a.level, a.i, string_agg(b.digest, '' ORDER BY b.i) FILTER (WHERE b.i < a.i) AS l,
         string_agg(b.digest, '' ORDER BY b.i) FILTER (WHERE b.i > a.i) AS r
  FROM node a JOIN node b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.i // 3 = b.i // 3
  WHERE a.n > 1 GROUP BY a.source, a.level, a.i),
upper_step AS (
  SELECT a.level, a.j, string_agg(b.digest, '' ORDER BY b.j) FILTER (WHERE b.j < a.j) AS l,
         string_agg(b.digest, '' ORDER BY b.j) FILTER (WHERE b.j > a.j) AS r
  FROM top a JOIN top b ON a.level = b.level AND a.j // 3 = b.j // 3 WHERE a.n > 1 GROUP BY a.level, a.j),
-- Each row's steps from the leaf to the root, numbered.
step AS (
  SELECT k, level AS s, coalesce(l, '') AS l, coalesce(r, '') AS r
  FROM leaves JOIN lower_step p ON leaves.source IS NOT DISTINCT FROM p.source AND p.i = CAST(floor(leaves.i / pow(3, p.level)) AS BIGINT)
  UNION ALL
  SELECT k, height + u.level, coalesce(l, ''), coalesce(r, '')
  FROM leaves JOIN sub ON leaves.source IS NOT DISTINCT FROM sub.source
  JOIN upper_step u ON u.j = CAST(floor(sub.j / pow(3, u.level)) AS BIGINT)),
folded AS (
  SELECT k, 0 AS s, start AS h FROM leaves
  UNION ALL
  SELECT f.k, f.s + 1, sha256(l || h || r) FROM folded f JOIN step ON step.k = f.k AND step.s = f.s),
ends AS (SELECT k, arg_max(h, s) AS h FROM folded GROUP BY k),
proof AS (SELECT k, string_agg(l || r, '' ORDER BY s) AS p FROM step GROUP BY k),
root AS (SELECT digest FROM top WHERE n = 1)
SELECT doc_id, leaf, sub.digest AS subroot, (SELECT digest FROM root) AS root, sha256(coalesce(p, '')) AS proof_sha256,
       h AS folded_root, h = (SELECT digest FROM root) AS verified
FROM leaves JOIN sub ON leaves.source IS NOT DISTINCT FROM sub.source JOIN ends USING (k) LEFT JOIN proof USING (k)"""


@register("op11_merkle_manifest", MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Every second row or so is checked after its line ends were taken away."""
    tampered = merkle.leaf({"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))})
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    proved = merkle.prove(
        table(spark, root, "documents"),
        {"doc_id": F.col("doc_id"), "changed": F.when(chosen, tampered)},
    )
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root")
    return proved.select(
        "doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"), folded
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@register("op12_best_fit_packing")
def op12_best_fit_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(table(spark, root, "documents"), tokenizer_path())


# Every order is applied filter by filter to every document's failures.
AUDIT_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
failed AS (
  SELECT doc_id, part, coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic,
    concat(CASE WHEN len(ws) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' END,
      CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 'C' END,
      CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
      CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 'E' END) AS f
  FROM doc LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) USING (doc_id)),
orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x) AND length(o) < 5),
steps AS (
  SELECT o AS filter_order, CAST(step AS INTEGER) AS step, substr(o, step, 1) AS x, substr(o, 1, step - 1) AS before
  FROM (SELECT o, unnest(range(1, 6)) AS step FROM orders WHERE length(o) = 5)),
counted AS (
  SELECT part, filter_order, step, x,
    count(*) FILTER (WHERE NOT contains(f, x) AND translate(before, f, '') = before) AS kept,
    count(*) FILTER (WHERE contains(f, x) AND translate(before, f, '') = before) AS removed,
    count(*) FILTER (WHERE contains(f, x) AND translate(before, f, '') <> before) AS redundant,
    count(*) FILTER (WHERE f = x) AS unique_fails,
    count(*) FILTER (WHERE good AND contains(f, x) AND translate(before, f, '') = before) AS good_lost,
    count(*) FILTER (WHERE toxic AND contains(f, x) AND translate(before, f, '') = before) AS toxic_lost
  FROM failed, steps GROUP BY ALL)
SELECT * EXCLUDE x, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM counted"""


@register("op13_filter_audit", AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, root: str) -> DataFrame:
    flagged = filter_audit.flags(table(spark, root, "documents"))
    return filter_audit.audit(flagged, table(spark, root, "labels"))
