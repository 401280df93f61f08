"""The registered queries of this subpackage and, where SQL can express one, its DuckDB SQL.

Of operators that SQL can't express as a whole, a second query shows the columns that it can: their rows come from the
same operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import table
from millrace.llm import chat, decontamination, licenses, line_dedup, lm_scoring, media, mixing, near_dedup, quality, warc



def licenses_base(spark, sf_dir: str) -> DataFrame:
    """first_word and last_word are -1 where there is none."""
    found = licenses.op2_licenses(spark, sf_dir)
    return found.select("doc_id", "n_words", "n_base", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("first_word", "last_word")], "base_labels")


def quality_held_out(spark, sf_dir: str) -> DataFrame:
    return quality.op3_quality(spark, sf_dir).groupBy("held_out").agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("predicted") == 1) != (F.col("score") >= 0.3)).alias("unlike"), F.count_if(~F.col("score").between(0, 1)).alias("outside"))


def near_dedup_sets(spark, sf_dir: str) -> DataFrame:
    """Set sizes, and the representative of each exact text: copies of a text are in one class."""
    found = near_dedup.op5_near_dedup(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return found.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.countDistinct("component_id").alias("classes")).drop("text")


def mixing_targets(spark, sf_dir: str) -> DataFrame:
    """Per source size its target, and whether the words taken miss it by more than a document's size."""
    most = F.max("size")
    per = mixing.op9_mixing(spark, sf_dir).groupBy("source_size", F.round("target", 3).alias("target")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"), (F.abs(F.sum("taken") - F.first("target")) > most).alias("missed"), F.count_if(F.col("taken") > 2 * F.col("size")).alias("above"))
    return per


def media_payload(spark, sf_dir: str) -> DataFrame:
    return media.op10_media(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


#: The schema of the tool that chat_tools calls.
SAY = {"say": {"type": "object", "required": ["turn", "text"], "properties": {"turn": {"type": "integer"}, "text": {"type": "string"}, "even": {"enum": [True]}}}}


def chat_tools(spark, sf_dir: str) -> DataFrame:
    """Conversations as tool traffic: a turn of a user is a call that quotes it, with a flag that only even turns may have,
    and a turn of an assistant is the result of the call at the turn before, if there is one."""
    turns = table(spark, sf_dir, "conversations")
    even = F.col("turn") % 2 == 0
    arguments = F.struct("turn", F.col("text").alias("text"), F.when(F.col("turn") % 3 == 0, even).alias("even"))
    call = F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("c"), F.col("turn")).alias("id"), F.lit("say").alias("name"), arguments.alias("arguments"))).alias("tool_calls")))
    result = F.to_json(F.struct(F.concat(F.lit("c"), (F.col("turn") - 1)).alias("tool_call_id"), F.col("text").alias("content")))
    traffic = turns.select("conv_id", "turn", F.when(F.col("role") == "user", "assistant").otherwise("tool").alias("role"), F.when(F.col("role") == "user", call).otherwise(result).alias("text"))
    made = chat.format_chats(traffic, SAY)
    return made.select("conv_id", "turn", "order_turn", "order_depth", "link", F.size("calls").alias("n_calls"), F.get("calls", F.lit(0))["check"].alias("check"), F.get("calls", F.lit(0))["answered"].alias("answered"), "message")


QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_licenses": licenses.op2_licenses,
    "op3_quality": quality.op3_quality,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_warc": warc.op6_warc,
    "op7_lm_scoring": lm_scoring.op7_lm_scoring,
    "op8_chat": chat.op8_chat,
    "op8_chat_calls": chat.op8_chat_calls,
    "op9_mixing": mixing.op9_mixing,
    "op10_media": media.op10_media,
    "licenses_base": licenses_base,
    "quality_held_out": quality_held_out,
    "near_dedup_sets": near_dedup_sets,
    "mixing_targets": mixing_targets,
    "media_payload": media_payload,
    "chat_tools": chat_tools,
}

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLACES = " UNION ALL ".join(f"SELECT doc_id, i, '{label}' AS label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE w[i:i + {len(phrase.split()) - 1}] = [{', '.join(repr(x) for x in phrase.split())}]" for phrase, label in licenses.BASE)

LICENSES_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS ({_PLACES})
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, count(b.i) AS n_base, coalesce(min(b.i), 0) - 1 AS first_word, coalesce(max(b.i), 0) - 1 AS last_word,
       coalesce(string_agg(DISTINCT b.label, ',' ORDER BY b.label), '') AS base_labels
FROM d LEFT JOIN b ON b.doc_id = d.doc_id GROUP BY d.doc_id, d.w"""

# CRC-32 bit by bit, a fold over the bytes of the id
HELD_OUT_SQL = """
WITH c AS (SELECT list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT), lambda a, x: list_reduce([xor(a, x)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda r, _z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END), 4294967295::BIGINT) AS r FROM documents)
SELECT xor(r, 4294967295) % 5 = 0 AS held_out, count(*) AS n, 0::BIGINT AS unlike, 0::BIGINT AS outside FROM c GROUP BY 1"""

SETS_SQL = f"""
WITH t AS (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text),
d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM t)
SELECT doc_id, CASE WHEN len(w) < 2 THEN len(w) ELSE len(list_distinct(list_zip(w[:-2], w[2:]))) END::BIGINT AS n_shingles, 1::BIGINT AS classes FROM d"""

# Every level at which some sources are filled up to twice their size is tried; the one that spends the whole share holds.
TARGETS_SQL = """
WITH d AS (SELECT source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS full_at FROM s),
l AS (SELECT a.full_at / a.weight AS cut FROM w a UNION SELECT 0),
v AS (SELECT cut, (1.5 * (SELECT sum(source_size) FROM w) - coalesce(sum(w.full_at) FILTER (w.full_at / w.weight <= cut), 0)) / nullif(sum(w.weight) FILTER (w.full_at / w.weight > cut), 0) AS level FROM l, w GROUP BY cut),
g AS (SELECT max(level) AS level FROM v WHERE level >= cut)
SELECT source_size, round(least(full_at, weight * level), 3) AS target, sum(n)::BIGINT AS n, sum(source_size)::BIGINT AS words, false AS missed, 0::BIGINT AS above FROM w, g GROUP BY 1, 2"""

PAYLOAD_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents), p AS (SELECT *, greatest(1, (n_bytes + 63) // 64) * 64 AS payload_bytes FROM d)
SELECT doc_id, n_bytes, payload_bytes, sha256(t || repeat(chr(0), (payload_bytes - n_bytes)::BIGINT)) AS payload_sha256 FROM p"""

TOOLS_SQL = """
WITH c AS (SELECT conv_id, turn, role = 'user' AS called, turn % 3 <> 0 OR turn % 2 = 0 AS fits, text FROM conversations),
j AS (SELECT c.*, p.turn IS NOT NULL AS linked, a.turn IS NOT NULL AS got FROM c LEFT JOIN c p ON NOT c.called AND p.called AND p.conv_id = c.conv_id AND p.turn = c.turn - 1
      LEFT JOIN c a ON c.called AND NOT a.called AND a.conv_id = c.conv_id AND a.turn = c.turn + 1)
SELECT conv_id, turn, turn AS order_turn, (CASE WHEN linked THEN 1 ELSE 0 END) AS order_depth, CASE WHEN called THEN NULL WHEN linked THEN 'linked' ELSE 'orphan' END AS link,
       (CASE WHEN called THEN 1 ELSE 0 END) AS n_calls, CASE WHEN NOT called THEN NULL WHEN fits THEN 'valid' ELSE '$.even: not in enum' END AS "check", CASE WHEN called THEN got END AS answered,
       CASE WHEN called THEN '{"content":null,"role":"assistant","tool_calls":[{"arguments":{' || CASE WHEN turn % 3 = 0 THEN '"even":' || (turn % 2 = 0)::VARCHAR || ',' ELSE '' END || '"text":' || to_json(text)::VARCHAR || ',"turn":' || turn || '},"id":"c' || turn || '","name":"say"}]}'
            ELSE '{"content":' || to_json(text)::VARCHAR || ',"role":"tool","tool_call_id":"c' || (turn - 1) || '"}' END AS message
FROM j"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op6_warc": warc.OP6_SQL,
    "op8_chat": chat.OP8_SQL,
    "licenses_base": LICENSES_SQL,
    "quality_held_out": HELD_OUT_SQL,
    "near_dedup_sets": SETS_SQL,
    "mixing_targets": TARGETS_SQL,
    "media_payload": PAYLOAD_SQL,
    "chat_tools": TOOLS_SQL,
}
