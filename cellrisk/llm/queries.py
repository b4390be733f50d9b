"""Registered queries of the training-data operators and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrisk.llm import langid, toxicity
from cellrisk.llm.alignment import align_documents
from cellrisk.llm.chat import format_conversations, formatted_digests
from cellrisk.llm.chatrepair import repair_digests
from cellrisk.llm.decontaminate import contaminated
from cellrisk.llm.exactdedup import exact_dedup
from cellrisk.llm.jaccard import jaccard_groups
from cellrisk.llm.linededup import line_digests
from cellrisk.llm.packing import pack_documents
from cellrisk.llm.passages import passage_digests
from cellrisk.llm.secretscan import secret_digests
from cellrisk.llm.urlfilter import judge_urls, labelled_by_rules


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_digests(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.held_out(F.col("doc_id"))
    model = langid.learn(docs.where(~out))
    return langid.identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    out = langid.held_out(F.col("doc_id"))
    model = toxicity.learn(docs, labels.where(~out))
    return (toxicity.with_toxicity(docs, model)
            .select("doc_id", out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted")))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return formatted_digests(format_conversations(turns.union(extra)))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, labelled_by_rules(pages)).select("page_id", "host", "path", "rule", "verdict")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digests(_table(spark, sf_dir, "conversations"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_packing": op8_packing,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_url_filter": op10_url_filter,
    "op11_secret_scan": op11_secret_scan,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
#: What the chat template escapes.
CONTROL = r"\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE>>|<<TEXT>>|<</ROLE>>"

#: kind -> (pattern, measured part of a match, its least length), base kinds first.  RE2's (?i) folds beyond ASCII, hence the classes.
SECRETS = {
    "assign": (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
    "pem": (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0),
    "forge": (r"gh[opsru]_[A-Za-z0-9]{36,}", 0, 0),
    "chat": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    "cloud": (r"AIza[A-Za-z0-9_-]{35}", 0, 0),
}


def _secrets() -> str:
    """A match's place is the length of what stands before it: the parts that the
    pattern splits the text into, and the matches before."""
    kinds = " UNION ALL ".join(f"""SELECT doc_id, '{kind}' AS kind, {i} AS o, {least} AS least, regexp_split_to_array(t, '{pattern}') AS parts,
  regexp_extract_all(t, '{pattern}') AS found, regexp_extract_all(t, '{pattern}', {group}) AS measured FROM t""" for i, (kind, (pattern, group, least)) in enumerate(SECRETS.items()))
    span = "kind || ':' || a || ':' || b"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS ({kinds}),
m AS (SELECT doc_id, kind, o, least, unnest(found) AS f, unnest(measured) AS g, unnest(parts[1:len(found)]) AS before, generate_subscripts(found, 1) AS p FROM k WHERE len(found) > 0),
s AS (SELECT *, CAST(sum(length(before) + length(f)) OVER (PARTITION BY doc_id, kind ORDER BY p) AS BIGINT) AS b FROM m),
spans AS (SELECT doc_id, kind, o, b - length(f) AS a, b FROM s WHERE length(g) >= least)
SELECT t.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg({span}, ',' ORDER BY a, o) FILTER (o < 3), '')) AS base_sha256, coalesce(string_agg({span}, ',' ORDER BY a, o), '') AS spans
FROM t LEFT JOIN spans ON t.doc_id = spans.doc_id GROUP BY t.doc_id"""


ORACLES: dict[str, str] = {
    "op11_secret_scan": _secrets(),
    "op1_decontamination": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
v AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
d AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM w WHERE len(w) > 0)),
b AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 4], ' ') AS g FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM v WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b ON d.g = b.g GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment FROM s JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_shingles""",
    "op2_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM i JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT d, b FROM reach JOIN links ON r = a)
SELECT d AS doc_id, coalesce(max(n), 0) AS n_shingles, min(r) AS component_id FROM reach LEFT JOIN n ON d = doc_id GROUP BY d""",
    "op3_substring_dedup": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS p FROM d WHERE len(w) >= 13)),
lost AS (SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS first FROM s) WHERE doc_id > first),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 12)) AS p FROM lost),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT w.* FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM kept GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op6_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
each AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM lines),
keyed AS (SELECT *, translate(regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g'), '{UPPER}', '{LOWER}') AS k FROM each),
bad AS (SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT e.*, (b.k IS NOT NULL AND e.doc_id <> b.keep) AS dropped FROM keyed e LEFT JOIN bad b ON e.k = b.k)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op7_exact_dedup": f"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS cp, regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g') AS norm FROM documents),
w AS (SELECT *, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n
      WINDOW g AS (PARTITION BY norm ORDER BY cp DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w""",
    "op9_chat_formatting": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -1, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]'))),
o AS (SELECT *, lag(r) OVER w AS before, row_number() OVER w AS p FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x)),
s AS (SELECT *, coalesce((before IS NULL AND r IN ('system', 'user')) OR (before = 'system' AND r = 'user') OR (before = 'user' AND r = 'assistant') OR (before = 'assistant' AND r = 'user'), false) AS fits,
  CASE r WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 ELSE 30 + length(r) + len(regexp_extract_all(r, '{CONTROL}')) END
    + length(x) + len(regexp_extract_all(x, '{CONTROL}')) AS chars FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY p)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY p) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, bool_and(fits) AND arg_max(r, p) = 'assistant' AS valid
FROM s GROUP BY conv_id""",
}
