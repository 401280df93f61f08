"""The registered queries of the core operators over the test tables, and the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import keys, parsing, techniques, text, transforms
from millrace.operators import conversations, planning, relational, telemetry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(oracle: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if oracle:
            ORACLES[name or f.__name__] = oracle
        return f

    return add


# -- scans, unions, keys -----------------------------------------------------------------------------------------------


@query("""
SELECT 'documents' AS dataset_type, count(*) AS n FROM documents
UNION ALL SELECT 'benchmark', count(*) FROM benchmark UNION ALL SELECT 'conversations', count(*) FROM conversations
UNION ALL SELECT 'labelled', count(*) FILTER (quality = 1) FROM labels""")
def build_union(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("text", "source")
    labelled = _table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "True").otherwise("False").alias("accepted"))
    parts = [relational.Part(docs, "documents"), relational.Part(_table(spark, sf_dir, "benchmark"), "benchmark"), relational.Part(_table(spark, sf_dir, "conversations"), "conversations"), relational.Part(labelled, "labelled", True)]
    return relational.union_parts(parts).groupBy("dataset_type").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT text, CAST(doc_id AS VARCHAR) AS doc_id, NULL::VARCHAR AS role, 'documents' AS dataset_type FROM documents
UNION ALL SELECT text, NULL, role, 'conversations' FROM conversations""")
def union_by_name(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("text", F.col("doc_id").cast("string").alias("doc_id"))
    return relational.union_parts([relational.Part(docs, "documents"), relational.Part(_table(spark, sf_dir, "conversations").select("text", "role"), "conversations")])


@query("SELECT doc_id, substr(md5(text), 1, 16) AS sample_id FROM documents")
def content_id(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", keys.content_id("text").alias("sample_id"))


@query("""
SELECT doc_id, CASE WHEN given IS NULL OR trim(given) = '' OR lower(trim(given)) = 'nan' THEN substr(md5(text), 1, 16) ELSE trim(given) END AS sample_id
FROM (SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' NaN ' WHEN 2 THEN '' ELSE ' id' || doc_id || ' ' END AS given FROM documents)""")
def row_id(spark, sf_dir):
    given = F.expr("CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' NaN ' WHEN 2 THEN '' ELSE ' id' || doc_id || ' ' END")
    return _table(spark, sf_dir, "documents").withColumn("given", given).select("doc_id", keys.row_id("text", "given").alias("sample_id"))


@query("SELECT doc_id, substr(sha256('42::' || doc_id || '::0'), 1, 16) AS seed_hex FROM documents")
def stable_seed(spark, sf_dir):
    seed = keys.stable_seed(F.lit("42"), F.col("doc_id").cast("string"), F.lit("0"))
    return _table(spark, sf_dir, "documents").select("doc_id", F.lower(F.lpad(F.conv(seed.cast("string"), 10, 16), 16, "0")).alias("seed_hex"))


@query("SELECT doc_id, strpos('0123456789abcdef', right(sha256('42:' || doc_id || ':1'), 1)) - 1 AS bucket FROM documents")
def hash_bucket(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", keys.hash_bucket(16, F.lit("42"), F.col("doc_id").cast("string"), F.lit("1")).alias("bucket"))


@query("SELECT DISTINCT conv_id, CAST(turn AS INTEGER) AS turn FROM conversations")
def keys_in(spark, sf_dir):
    from millrace.sources.artifacts import keys_in as distinct_keys

    return distinct_keys(_table(spark, sf_dir, "conversations"), {"conv_id": "bigint", "turn": "int"})


# -- filters, dedup, joins, windows ------------------------------------------------------------------------------------


@query("SELECT min(doc_id) AS doc_id, substr(md5(text), 1, 16) AS sample_id FROM documents GROUP BY text")
def dedup_first_wins(spark, sf_dir):
    return relational.first_wins(_table(spark, sf_dir, "documents").select("doc_id", keys.content_id("text").alias("sample_id")), "sample_id", "doc_id")


@query("""
SELECT doc_id, lang, source FROM (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS n
FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL) WHERE n <= 2""")
def take_per_group(spark, sf_dir):
    return relational.take_per_group(_table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), 2, "doc_id", ("lang", "source"))


@query("""
SELECT min(doc_id) AS doc_id, substr(md5(text), 1, 16) AS sample_id FROM documents d
WHERE doc_id % 2 = 1 AND text NOT IN (SELECT text FROM documents WHERE doc_id % 2 = 0) GROUP BY text""")
def append_new(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    existing = docs.where("doc_id % 2 = 0").select(keys.content_id("text").alias("sample_id"))
    return relational.append_new(existing, docs.where("doc_id % 2 = 1"), text="text", order="doc_id").select("doc_id", "sample_id")


@query("SELECT d.doc_id AS sample_id, 0 AS iteration FROM documents d WHERE doc_id % 3 <> 0 AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def pending_units(spark, sf_dir):
    plan = relational.with_iterations(_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample_id")), 1)
    return relational.pending(plan, _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("sample_id")), plan.where("sample_id % 3 = 0"))


@query("SELECT count(*) AS missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def inputs_without_plan(spark, sf_dir):
    return _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id", "left_anti").agg(F.count(F.lit(1)).alias("missing"))


@query("SELECT sample_id, arg_max(doc_id, doc_id) AS doc_id FROM (SELECT substr(md5(text), 1, 16) AS sample_id, doc_id FROM documents) GROUP BY sample_id")
def last_input(spark, sf_dir):
    return relational.last_input(_table(spark, sf_dir, "documents").select(keys.content_id("text").alias("sample_id"), "doc_id"), "doc_id")


@query("SELECT doc_id, i AS iteration FROM documents, range(3) t(i)")
def iterations(spark, sf_dir):
    return relational.with_iterations(_table(spark, sf_dir, "documents").select("doc_id"), 3).select("doc_id", F.col("iteration").cast("bigint").alias("iteration"))


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY substr(md5(text), 1, 16)) AS parent_id FROM documents WHERE text IS NOT NULL")
def lineage(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", keys.content_id("text").alias("sample_id"))
    parents = relational.first_wins(docs, "sample_id", "doc_id")
    joined = relational.lineage(docs.select("doc_id", F.col("sample_id").alias("input_id")), parents)
    return joined.select("doc_id", F.col("parent.doc_id").alias("parent_id"))


@query("SELECT quality, count(*) AS extracted, count(*) FILTER (toxic = 1) AS n_accepted, count(*) FILTER (toxic <> 1) AS n_rejected, count(*) FILTER (toxic = 1) / count(*)::DOUBLE AS rate FROM labels GROUP BY quality")
def acceptance_rate(spark, sf_dir):
    return relational.acceptance(_table(spark, sf_dir, "labels"), ("quality",), F.col("toxic") == 1)


@query("SELECT count(*) AS rows, count(*) FILTER (quality = 1) AS accepted FROM labels WHERE toxic = 0")
def file_counts(spark, sf_dir):
    rows = _table(spark, sf_dir, "labels").withColumn("accepted", F.when(F.col("quality") == 1, "True").otherwise("no"))
    return relational.file_counts(rows, {"toxic": 0})


@query("""
SELECT lang, source, doc_id, position, floor(0.33 * position + 0.25) > floor(0.33 * (position - 1) + 0.25) AS include
FROM (SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS position FROM documents)""")
def deal_targets(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").select("lang", "source", "doc_id")
    return relational.deal_targets(rows, 0.33, F.lit(0.25), "doc_id", ("lang", "source")).withColumn("position", F.col("position").cast("bigint"))


# -- coverage, plan, registry ------------------------------------------------------------------------------------------


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t.name}', '{t.layer}', {t.complexity})" for t in techniques.technique_pool(pure_only=True)) + ") t(technique, layer, complexity)")
def pure_pool(spark, sf_dir):
    return techniques.registry_frame(spark, techniques.technique_pool(pure_only=True)).select("technique", "layer", "complexity")


_TRAITS = [(t.name, trait) for t in techniques.all_techniques() for trait in sorted(t.traits)]


@query(
    "WITH t(name, trait) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _TRAITS) + "), x(p, q) AS (VALUES " + ", ".join(f"('{a}', '{b}'), ('{b}', '{a}')" for a, b in techniques.EXCLUSIONS) + """),
f(name, family) AS (VALUES """ + ", ".join(f"('{t.name}', '{f}')" for t in techniques.all_techniques() for f in t.families) + """)
SELECT a.name AS a, b.name AS b FROM t a JOIN x ON x.p = a.trait JOIN t b ON b.trait = x.q WHERE a.name <> b.name
UNION SELECT a.name, b.name FROM f a JOIN f b ON a.family = b.family AND a.name <> b.name"""
)
def incompatible_pairs(spark, sf_dir):
    return techniques.incompatible_pairs(spark)


def _inputs(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("sample_id"), F.col("lang").alias("category"), F.col("source").alias("entry_type"))


@query()
def augmentation_plan(spark, sf_dir):
    return planning.plan(_inputs(spark, sf_dir), techniques.technique_pool(pure_only=True), rounds=planning.ESCALATION)


# How often a layer is due in n places is floor(rate * n + offset), the offset being 52 bits of the key's hash.
_OFFSET = "(('0x' || substr(sha256('42::' || category || '::' || entry_type || '::0::' || iteration || '::hacking'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


@query(f"""
WITH g AS (SELECT coalesce(lang, '') AS category, coalesce(source, '') AS entry_type, count(*) AS units FROM documents GROUP BY ALL),
r(iteration, rate) AS (VALUES (2, 0.7::DOUBLE), (3, 0.9::DOUBLE))
SELECT category, entry_type, iteration, units, floor(rate * units + {_OFFSET})::BIGINT AS hacking, (2 * units)::BIGINT AS picks_of_exact_rounds FROM g, r""")
def plan_counts(spark, sf_dir):
    """Per group: units, picks of the hacking layer in the rounds with a budget, and how many of exactly one technique
    and of exactly two there are in the rounds before."""
    pool = techniques.technique_pool(pure_only=True)
    planned = planning.plan(_inputs(spark, sf_dir), pool, rounds=planning.ESCALATION)
    layer = F.create_map(*[F.lit(x) for t in pool for x in (t.name, t.layer)])
    hacking = F.exists("combination", lambda n: F.element_at(layer, n) == "hacking")
    per = planned.groupBy("category", "entry_type", "iteration").agg(F.count(F.lit(1)).alias("units"), F.count_if(hacking).alias("hacking"), F.count_if(F.size("combination") == F.col("iteration") + 1).alias("exact"))
    exact = per.where("iteration < 2").groupBy("category", "entry_type").agg(F.sum("exact").alias("picks_of_exact_rounds"))
    return per.where("iteration >= 2").drop("exact").join(exact, ["category", "entry_type"])


_PICKS = ("to_rot13", "to_uppercase", "to_abbreviations", "to_summarize")


@query("""
WITH p AS (SELECT lang AS category, source AS entry_type, unnest(CASE WHEN doc_id % 2 = 0 THEN ['to_rot13', 'to_summarize'] ELSE ['to_uppercase'] END) AS t FROM documents),
r(technique, family, layer) AS (VALUES ('to_rot13', 'encode', 'obfuscation'), ('to_uppercase', 'casual_writing', 'obfuscation'), ('to_abbreviations', 'casual_writing', 'obfuscation'), ('to_summarize', 'indirect', 'requests')),
j AS (SELECT * FROM p JOIN r ON t = technique),
x AS (SELECT 'technique' AS level, technique AS name, category, entry_type FROM j UNION ALL SELECT 'family', family, category, entry_type FROM j UNION ALL SELECT 'layer', layer, category, entry_type FROM j)
SELECT level, name, category, entry_type, '0' AS iteration, count(*)::BIGINT AS count FROM x GROUP BY ALL
UNION ALL SELECT 'technique', 'to_abbreviations', NULL, NULL, NULL, 0""")
def technique_coverage(spark, sf_dir):
    plan = _inputs(spark, sf_dir).withColumn("iteration", F.lit(0)).withColumn("combination", F.when(F.col("sample_id").cast("bigint") % 2 == 0, F.array(F.lit("to_rot13"), F.lit("to_summarize"))).otherwise(F.array(F.lit("to_uppercase"))))
    registry = techniques.registry_frame(spark, [t for t in techniques.all_techniques() if t.name in _PICKS])
    return relational.coverage(plan, registry).withColumn("iteration", F.col("iteration").cast("string"))


# -- telemetry ---------------------------------------------------------------------------------------------------------


def _calls(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.lit("call").alias("ev"), F.col("event_type").alias("model"), F.when(F.col("user_id") % 3 == 0, "vllm").otherwise("api").alias("backend"), F.lit(1).alias("n_items"),
        F.col("user_id").alias("in_tok"), F.col("event_id").alias("out_tok"), F.lit(0.5).alias("ms"), (F.col("event_id") % 7 == 0).alias("cut"), F.when(F.col("event_id") % 11 == 0, "timeout").alias("error"), F.lit("outputs").alias("stage"),
    )


@query("""
SELECT event_type AS model, count(*) AS calls, count(*)::BIGINT AS items, sum(user_id)::BIGINT AS in_tok, sum(event_id)::BIGINT AS out_tok, sum(0.5::DOUBLE) AS ms,
       count(*) FILTER (event_id % 7 = 0) AS cut, count(*) FILTER (event_id % 11 = 0) AS errors, count(*) FILTER (user_id % 3 <> 0) AS hosted,
       CASE WHEN event_type IN ('click', 'view') AND count(*) FILTER (user_id % 3 <> 0) > 0 THEN
         round(coalesce(sum(user_id) FILTER (user_id % 3 <> 0), 0) / 1e6 * 0.2 + coalesce(sum(event_id) FILTER (user_id % 3 <> 0), 0) / 1e6 * CASE event_type WHEN 'click' THEN 0.9 ELSE 0.0 END, 4) END AS cost_usd
FROM events GROUP BY event_type""")
def usage_rollup(spark, sf_dir):
    prices = spark.createDataFrame([("click", 0.2, 0.9), ("view", 0.2, None)], "model string, price_in double, price_out double")
    return telemetry.usage(_calls(spark, sf_dir), prices)


@query("SELECT 'outputs' AS stage, event_type AS model, count(*) AS n FROM events WHERE event_id % 7 = 0 GROUP BY event_type")
def cut_replies(spark, sf_dir):
    return telemetry.cut_replies(_calls(spark, sf_dir))


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS in_window FROM events")
def sliding_window(spark, sf_dir):
    return telemetry.window_count(_table(spark, sf_dir, "events").select("event_id", "ts", "user_id"), 3600, ("user_id",)).select("event_id", "in_window")


@query("""
WITH s AS (SELECT user_id, (epoch_us(ts) // 1000000) AS s, (epoch_us(ts) // 1000000) + CAST(floor(value) AS BIGINT) * 60 AS e FROM events),
w AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM s)
SELECT user_id, CAST(sum(greatest(e - greatest(s, coalesce(r, s)), 0)) AS DOUBLE) AS covered_s FROM w GROUP BY user_id""")
def interval_union(spark, sf_dir):
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).cast("double")
    return telemetry.covered_seconds(_table(spark, sf_dir, "events"), start, start + F.floor("value") * 60, ("user_id",))


# -- transcripts -------------------------------------------------------------------------------------------------------


@query("SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS first_message, arg_max(text, turn) FILTER (role = 'assistant') AS last_reply FROM conversations GROUP BY conv_id")
def first_last_turn(spark, sf_dir):
    return conversations.edges_of_turns(_table(spark, sf_dir, "conversations"))


@query("SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript FROM conversations WHERE text IS NOT NULL GROUP BY conv_id")
def render_transcript(spark, sf_dir):
    return conversations.render_turns(_table(spark, sf_dir, "conversations"))


# -- verdicts, cleaning, parsing ---------------------------------------------------------------------------------------

_REPLY = "CASE conv_id % 6 WHEN 0 THEN '**Yes**, it is' WHEN 1 THEN '> ok.' WHEN 2 THEN 'Yesterday' WHEN 3 THEN '\"Passed\"' WHEN 4 THEN 'Verdict: yes' ELSE text END"


@query(f"""
WITH r AS (SELECT conv_id, turn, {_REPLY} AS reply FROM conversations),
v AS (SELECT *, lower(regexp_extract(reply, '^[\\s*_#>"''`“”‘’]*([\\pL\\pN]+)', 1)) IN ('yes', 'ok', 'okay', 'accept', 'accepted', 'pass', 'passed') AS accepted FROM r)
SELECT conv_id, turn, accepted, CASE WHEN accepted THEN '' ELSE reply END AS reasoning FROM v""")
def verdict(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(_REPLY).alias("reply"))
    return rows.select("conv_id", "turn", text.verdict("reply").alias("v")).select("conv_id", "turn", "v.*")


@query("SELECT conv_id, string_agg(n || '. ' || text, chr(10) ORDER BY n) AS listed FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) GROUP BY conv_id")
def ordinal_list(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return rows.select("conv_id", text.ordinal_list(F.col("t.text")).alias("listed"))


@query("SELECT item_id, 'Task ' || item_id || ': {' || text || '} end' AS message FROM benchmark")
def render_template(spark, sf_dir):
    rows = _table(spark, sf_dir, "benchmark")
    return rows.select("item_id", text.render(F.lit("Task {id}: {{{body}}} end"), id=F.col("item_id"), body=F.col("text")).alias("message"))


@query("""
SELECT conv_id, turn, CASE WHEN text = '' THEN '**** x' WHEN contains(text, chr(10)) THEN '**' || text || '** x' ELSE text || ' x' END AS cleaned FROM conversations""")
def clean_sample(spark, sf_dir):
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", text.clean_sample(F.concat(F.lit("**"), F.col("text"), F.lit("** `x` <|im_end|>"))).alias("cleaned"))


@query("SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS pos, regexp_replace(text, '^[\\s]+|[\\s]+$', '', 'g') AS item FROM conversations WHERE text <> ''")
def numbered_list(spark, sf_dir):
    listed = ordinal_list(spark, sf_dir)
    return listed.lateralJoin(parsing.NumberedList(F.col("listed").outer(), F.lit(True))).select("conv_id", "pos", "item")


@query("SELECT item_id, 'Topic ' || item_id AS category, 'Part' AS subcategory, 'sample ' || item_id AS sample, 0 AS pos FROM benchmark")
def outline_entries(spark, sf_dir):
    reply = F.concat(F.lit("# title\n## 1. **Topic "), F.col("item_id"), F.lit("**\n### 1.1 Part:\n- (sample "), F.col("item_id"), F.lit(")\n- not one\n## broken\n- (lost)\n[END]"))
    return parsing.outline_rows(_table(spark, sf_dir, "benchmark").select("item_id", reply.alias("reply"))).select("item_id", "category", "subcategory", "sample", "pos")


# -- transforms --------------------------------------------------------------------------------------------------------

_CHARS = "list_filter(string_split(text, ''), lambda c: c <> '')"


def _sql_map(table: dict[str, str]) -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    return "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in table.items()) + "}"


def _by_char(table: dict[str, str], sep: str = "", key: str = "c") -> str:
    return f"array_to_string(list_transform({_CHARS}, lambda c: coalesce({_sql_map(table)}[{key}], c)), '{sep}')"


def _translate(a: str, b: str) -> str:
    return "translate(text, '" + a.replace("'", "''") + "', '" + b.replace("'", "''") + "')"


def _by_place(one: str) -> str:
    return f"array_to_string(list_transform(range(1, length(text) + 1), lambda i: {one}), '')"


def _abbreviated_sql() -> str:
    out = "text"
    for word, short in transforms.ABBREVIATIONS.items():
        out = f"regexp_replace({out}, '(?i)\\b{word}\\b', '{short}', 'g')"
    return out


_U, _L, _D, _P = transforms._UPPER, transforms._LOWER, transforms._DIGITS, transforms._PRINTABLE
_TRANSFORM_SQL = {
    "to_rot13": _translate(_U + _L, _U[13:] + _U[:13] + _L[13:] + _L[:13]),
    "to_rot18": _translate(_U + _L + _D, _U[13:] + _U[:13] + _L[13:] + _L[:13] + _D[5:] + _D[:5]),
    "to_rot47": _translate(_P, _P[47:] + _P[:47]),
    "to_unicode_escape": f"array_to_string(list_transform({_CHARS}, lambda c: '\\u' || lpad(lower(to_hex(unicode(c))), greatest(4, length(to_hex(unicode(c)))::INTEGER), '0')), '')",
    "to_ascii_ordinal": f"array_to_string(list_transform({_CHARS}, lambda c: unicode(c)::VARCHAR), ' ')",
    "to_leetspeak_basic": _by_char(transforms._leet(transforms.LEET_BASIC)),
    "to_leetspeak_intermediate": _by_char(transforms._leet(transforms.LEET_INTERMEDIATE)),
    "to_leetspeak_advanced": _by_char(transforms._leet(transforms.LEET_ADVANCED)),
    "to_morse": _by_char(transforms.MORSE, " ", "upper(c)"),
    "to_braille": _translate(_L + _U, transforms.BRAILLE * 2),
    "to_lowercase": "lower(text)",
    "to_uppercase": "upper(replace(text, 'ß', 'SS'))",
    "to_dropped_punctuation": "regexp_replace(text, '[.,;:!?'']+([^\\d.,;:!?'']|$)', '\\1', 'g')",
    "to_base64": "regexp_replace(base64(encode(text)), '(.{1,76})', '\\1' || chr(10), 'g')",
    "to_no_sentence_capitals": _by_place("CASE WHEN text[i] BETWEEN 'A' AND 'Z' AND (i = 1 OR regexp_matches(text[1:i - 1], '[.!?]\\s+$')) THEN lower(text[i]) ELSE text[i] END"),
    "to_doubled_punctuation": _by_place("CASE WHEN text[i] IN ('.', '!', '?') AND (i = 1 OR text[i - 1] NOT IN ('.', '!', '?')) AND (i = length(text) OR regexp_matches(text[i + 1], '\\s')) THEN text[i] || text[i] ELSE text[i] END"),
    "to_abbreviations": _abbreviated_sql(),
}


def _transform(name: str):
    return lambda spark, sf_dir: _table(spark, sf_dir, "conversations").select("conv_id", "turn", transforms.EXPRESSIONS[name](F.col("text")).alias("result"))


for _name, _sql in _TRANSFORM_SQL.items():
    query(f"SELECT conv_id, turn, {_sql} AS result FROM conversations" if _sql else None, _name)(_transform(_name))


def _seeded(name: str):
    def run(spark, sf_dir):
        rows = _table(spark, sf_dir, "conversations")
        seed = keys.stable_seed(F.lit("42"), F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.lit(name)).cast("string")
        return rows.select("conv_id", "turn", transforms.seeded_transform(F.lit(name), F.col("text"), seed).alias("r")).select("conv_id", "turn", F.col("r.text").alias("result"), F.col("r.info").alias("info"))

    return run


_SEEDED_SQL = {"to_stripped_accents": "SELECT conv_id, turn, strip_accents(text) AS result, '' AS info FROM conversations"}

for _name in transforms.SEEDED:
    if _name != "to_ascii_art":
        query(_SEEDED_SQL.get(_name), _name)(_seeded(_name))


@query("""
SELECT item_id, CASE item_id % 3 WHEN 0 THEN 'note: ' || text WHEN 1 THEN '[plain] ' || text ELSE text END AS new_text,
       CASE item_id % 3 WHEN 0 THEN 'directive=note;variant=0' WHEN 1 THEN 'directive=plain;variant=0' ELSE '' END AS info FROM benchmark""")
def template_transform(spark, sf_dir):
    wordings = transforms.template_table(spark, {"note": ["note: {prompt}"], "plain": ["[{directive}] {prompt}"]})
    directive = F.element_at(F.array(F.lit("note"), F.lit("plain"), F.lit("unknown")), (F.col("item_id") % 3 + 1).cast("int"))
    rows = _table(spark, sf_dir, "benchmark").select("item_id", "text", directive.alias("directive"), F.col("item_id").cast("string").alias("seed"))
    return transforms.apply_templates(rows, wordings).select("item_id", "new_text", "info")


_CHAIN = ("to_uppercase", "to_rot13", "to_rot47", "to_ascii_ordinal")


@query(f"""
WITH u AS (SELECT conv_id, turn, upper(replace(text, 'ß', 'SS')) AS text, text AS given FROM conversations), r AS (SELECT conv_id, turn, given, text AS up, {_TRANSFORM_SQL['to_rot13']} AS text FROM u),
s AS (SELECT conv_id, turn, given, up, text AS rot, {_TRANSFORM_SQL['to_rot47']} AS text FROM r)
SELECT conv_id, turn, {_TRANSFORM_SQL['to_ascii_ordinal']} AS result,
  array_to_string(list_filter([CASE WHEN up = given THEN 'noop=to_uppercase' END, CASE WHEN rot = up THEN 'noop=to_rot13' END, CASE WHEN text = rot THEN 'noop=to_rot47' END, CASE WHEN text = '' THEN 'noop=to_ascii_ordinal' END], lambda x: x IS NOT NULL), ';') AS info
FROM s""")
def chain_without_chance(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.lit("42").alias("seed"), F.col("conv_id").alias("sample_id"), F.col("turn").alias("iteration"), F.array(*map(F.lit, _CHAIN)).alias("combination"))
    return transforms.run_chains(rows).select("conv_id", "turn", "result", "info")


@query()
def run_chain(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.lit("42").alias("seed"), F.col("conv_id").alias("sample_id"), F.col("turn").alias("iteration"), F.array(F.lit("to_uppercase"), F.lit("to_separator"), F.lit("to_rot13")).alias("combination"))
    return transforms.run_chains(rows).select("conv_id", "turn", "result", "info")


@query("""
SELECT item_id, regexp_replace(text, '(?i)(' || w || ')', array_to_string(list_filter(string_split(w, ''), lambda c: c <> ''), '-'), 'g') AS result
FROM (SELECT item_id, text, regexp_extract(text, '[A-Za-z]+') AS w FROM benchmark)""")
def selective_edit(spark, sf_dir):
    rows = _table(spark, sf_dir, "benchmark").withColumn("w", F.array(F.regexp_extract("text", "[A-Za-z]+", 0)))
    return rows.select("item_id", transforms.separated_words(F.col("text"), F.col("w"), "-").alias("result"))


# -- units, ledgers, streams -------------------------------------------------------------------------------------------


@query("""
SELECT doc_id AS sample_id, CASE WHEN doc_id % 5 IN (0, 3) THEN 'pending' ELSE 'done' END AS state FROM documents
UNION ALL SELECT -1, 'torn saves: 0' UNION ALL SELECT -2, 'rows: ' || count(*) FROM documents WHERE doc_id % 5 IN (1, 2, 4)""")
def ledger_resume(spark, sf_dir):
    """A ledger with two saves, one that is sent twice, one that was cut off before its commit, and a drop."""
    from millrace.operators.ledger import Ledger
    from millrace.sources.scratch import scratch_folder

    ledger = Ledger(spark, scratch_folder(spark, "ledger"), "sample_id bigint")
    units = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample_id"))
    of = lambda *remainders: units.where(F.pmod("sample_id", F.lit(5)).isin(*remainders))
    done = lambda rows: (rows, rows.withColumn("status", F.lit("done")))
    ledger.commit(*done(of(1, 0)))
    for _ in range(2):
        ledger.commit(*done(of(2)), source="job:1")
    ledger._write(of(3), "rows", ledger.next_save())
    ledger.drop(of(0), "sample_id bigint")
    ledger.commit(*done(of(4)))
    state = units.join(ledger.acks().select("sample_id", "status"), "sample_id", "left").select("sample_id", F.coalesce("status", F.lit("pending")).alias("state"))
    notes = spark.createDataFrame([(-1, f"torn saves: {ledger.torn().count()}"), (-2, f"rows: {ledger.rows('sample_id bigint').count()}")], "sample_id bigint, state string")
    return state.unionAll(notes)


@query("""
SELECT event_type AS model, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) // 1000000 AS begins, count(*) AS calls, sum(user_id)::BIGINT AS in_tok,
       sum(event_id)::BIGINT AS out_tok, count(*) FILTER (event_id % 11 = 0) AS errors FROM events GROUP BY ALL""")
def usage_windows(spark, sf_dir):
    """The streaming roll-up over the table as a batch: the same plan, all windows closed."""
    from millrace.streaming import jobs

    ts = F.col("ts").cast("timestamp")
    calls = _calls(spark, sf_dir).join(_table(spark, sf_dir, "events").select(F.col("event_id").alias("out_tok"), ts.alias("ts")), "out_tok")
    rolled = jobs.usage_windows(calls, width="1 hour")
    return rolled.select("model", F.unix_seconds("window.start").alias("begins"), "calls", "in_tok", "out_tok", "errors")


@query("""
WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events), g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) < 1800000000 THEN 0 ELSE 1 END AS new FROM e),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS n FROM g)
SELECT user_id, min(t) // 1000000 AS begins, count(*) AS events FROM s GROUP BY user_id, n""")
def session_windows(spark, sf_dir):
    from millrace.streaming import jobs

    rolled = jobs.sessions(_table(spark, sf_dir, "events").select("ts", "user_id"), "user_id")
    return rolled.select("user_id", F.unix_seconds("session_window.start").alias("begins"), "events")


@query("SELECT DISTINCT substr(md5(text), 1, 16) AS sample_id FROM documents WHERE text IS NOT NULL")
def first_arrivals(spark, sf_dir):
    """Arrival-order dedup as a stream over a folder of JSON lines."""
    from millrace.sources.scratch import scratch_folder
    from millrace.streaming import jobs

    folder = scratch_folder(spark, "arrivals")
    _table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.col("text").alias("sample")).write.json(f"{folder}/in")
    arrived = jobs.first_arrivals(jobs.read_events(spark, f"{folder}/in", "sample string")).select("sample_id")
    query_ = arrived.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out").trigger(availableNow=True).start()
    query_.awaitTermination()
    return spark.read.schema("sample_id string").parquet(f"{folder}/out")


@query("""
WITH g AS (SELECT lang AS category, source AS entry_type, count(*) AS units FROM documents GROUP BY ALL), r(layer, rate) AS (VALUES ('hacking', 0.5), ('requests', 0.7))
SELECT category, entry_type, 0 AS iteration, layer, units, floor(rate * units)::BIGINT AS target, 0 AS n FROM g, r WHERE floor(rate * units) >= 2""")
def short_layers(spark, sf_dir):
    """A plan without a pick of two layers that have rates."""
    planned = _inputs(spark, sf_dir).select("category", "entry_type", F.lit(0).alias("iteration"), F.array(F.lit("to_rot13")).alias("combination"))
    return planning.short_layers(planned, techniques.registry_frame(spark), {"hacking": 0.5, "requests": 0.7}).drop("rate")


@query("""
WITH r(provider, gpu, rate) AS (VALUES ('click', 'g0', 1.5::DOUBLE), ('view', 'g1', 2.5::DOUBLE), ('*', 'g1', 0.5::DOUBLE), ('*', 'g2', 0.25::DOUBLE))
SELECT e.event_id, coalesce(o.rate, a.rate) AS rate FROM events e LEFT JOIN r o ON o.provider = e.event_type AND o.gpu = 'g' || e.user_id % 4
LEFT JOIN r a ON a.provider = '*' AND a.gpu = 'g' || e.user_id % 4""")
def hourly_rate(spark, sf_dir):
    rates = spark.createDataFrame([("click", "g0", 1.5), ("view", "g1", 2.5), ("*", "g1", 0.5), ("*", "g2", 0.25)], "provider string, gpu string, rate double")
    cards = _table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("provider"), F.concat(F.lit("g"), (F.col("user_id") % 4).cast("string")).alias("gpu"))
    return telemetry.hourly_rate(cards, rates).select("event_id", "rate")


# -- messages ----------------------------------------------------------------------------------------------------------


@query("""
SELECT conv_id, string_agg(role || '=' || text, '|' ORDER BY turn) AS messages, count(*)::INTEGER AS n FROM conversations GROUP BY conv_id""")
def as_messages(spark, sf_dir):

    steps = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.struct("role", "text").alias("m")))).alias("l"))
    shaped = F.transform("l", lambda x: F.struct(F.lit("message").alias("type"), x["m"]["role"].alias("actor"), x["m"]["text"].alias("content"), x["m"]["role"].alias("role"), F.lit(None).cast("string").alias("model"), F.expr("CAST(map() AS map<string,string>)").alias("meta")))
    said = conversations.as_messages(shaped)
    return steps.select("conv_id", F.array_join(F.transform(said, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|").alias("messages"), F.size(said).alias("n"))


@query("""
SELECT conv_id, turn, CASE WHEN text <> lower(text) AND text = upper(text) THEN 'WORD' WHEN upper(text) <> lower(text) AND text = lower(text) THEN 'word'
  WHEN substr(text, 1, 1) <> lower(substr(text, 1, 1)) THEN 'Word' ELSE 'wORD' END AS matched FROM conversations""")
def match_case(spark, sf_dir):
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", text.match_case(F.col("text"), F.lit("wORD")).alias("matched"))


@query("""
SELECT conv_id, string_agg('- ' || text, chr(10) ORDER BY turn) FILTER (n <= 2) || CASE WHEN count(*) > 2 THEN chr(10) || '… and ' || (count(*) - 2) || ' more' ELSE '' END AS note
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) GROUP BY conv_id""")
def prohibited_note(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return rows.select("conv_id", text.prohibited_note(F.col("t.text"), 2).alias("note"))


@query("""
SELECT conv_id, coalesce(string_agg('- ' || substr(text, 1, 20), chr(10) ORDER BY turn) FILTER (role = 'assistant' AND n <= 3), '') AS feedback
FROM (SELECT *, sum(CASE WHEN role = 'assistant' AND text <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations WHERE role <> 'assistant' OR text <> '') GROUP BY conv_id""")
def rejection_feedback(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", (F.col("role") != "assistant").alias("accepted"), F.col("text").alias("reasoning")))).alias("t"))
    return rows.select("conv_id", text.rejection_feedback(F.col("t"), 3, 20).alias("feedback"))


@query("SELECT item_id, 'a' || item_id || ',b' AS names FROM benchmark")
def field_names(spark, sf_dir):
    template = F.concat(F.lit("{{no}} {a"), F.col("item_id"), F.lit("} {b} {b.x} {{{b}}}"))
    return _table(spark, sf_dir, "benchmark").select("item_id", F.array_join(text.field_names(template), ",").alias("names"))


@query("SELECT item_id, 0 AS pos, 'Q ' || item_id AS question, 'A ' || item_id AS answer FROM benchmark UNION ALL SELECT item_id, 1, 'second', 'two' || chr(10) || 'lines' FROM benchmark")
def question_answers(spark, sf_dir):
    reply = F.concat(F.lit("Sure:\n**Prompt 1:**\n**Question:** Q "), F.col("item_id"), F.lit("\n**Answer:** A "), F.col("item_id"), F.lit("\n**Prompt 2:**\n**Question:**\nsecond\n**Answer:** two\nlines"))
    rows = _table(spark, sf_dir, "benchmark").select("item_id", reply.alias("reply"))
    return rows.lateralJoin(parsing.QuestionAnswers(F.col("reply").outer(), F.lit(2))).select("item_id", "pos", "question", "answer")


# -- files -------------------------------------------------------------------------------------------------------------


@query("""
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE text END AS sample, lang AS category FROM documents
UNION ALL SELECT doc_id, 'x,"y"' || chr(10) || 'z', NULL FROM documents WHERE doc_id % 10 = 0""")
def csv_round_trip(spark, sf_dir):
    """Two appends to a CSV artifact, read back with the missing cells as null and the texts that look like one as they were."""
    from millrace.sources import artifacts
    from millrace.sources.scratch import scratch_folder

    path, schema = scratch_folder(spark, "csv"), "doc_id bigint, sample string, category string"
    docs = _table(spark, sf_dir, "documents")
    artifacts.append_rows(docs.select("doc_id", F.when(F.col("doc_id") % 4 == 0, "NaN").otherwise(text.text_cell("text")).alias("sample"), text.text_cell("lang").alias("category")), path, schema)
    artifacts.append_rows(docs.where("doc_id % 10 = 0").select("doc_id", F.lit('x,"y"\nz').alias("sample")), path, schema)
    return artifacts.read_rows(spark, path, schema, na_to_null=True, text_cells=True)


@query("SELECT d.doc_id, lang AS category FROM documents d JOIN labels l USING (doc_id) WHERE quality = 1 AND lang = 'en'")
def category_tree(spark, sf_dir):
    """A tree of categories, of which one is overwritten, read by category and accepted rows."""
    from millrace.sources import artifacts
    from millrace.sources.scratch import scratch_folder

    path, schema = scratch_folder(spark, "tree"), "doc_id bigint, accepted boolean, category string"
    rows = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id").select("doc_id", (F.col("quality") == 1).alias("accepted"), F.col("lang").alias("category"))
    artifacts.write_tree(rows.withColumn("accepted", F.lit(False)), path)
    artifacts.write_tree(rows.where("category = 'en'"), path)
    return artifacts.read_tree(spark, path, schema, ["en"], accepted_only=True).select("doc_id", "category")


@query("""
SELECT d.doc_id, lang AS category, 'plain' AS tree FROM documents d JOIN labels l USING (doc_id) WHERE quality = 1 AND lang IS NOT NULL
UNION ALL SELECT d.doc_id, lang, 'seeded' FROM documents d JOIN labels l USING (doc_id) WHERE quality = 1 AND lang = 'en'""")
def input_tree(spark, sf_dir):
    """The accepted inputs of a run before and after its seeded tree is written."""
    from millrace.sources import artifacts
    from millrace.sources.scratch import scratch_folder

    seeded, plain, schema = scratch_folder(spark, "seeded"), scratch_folder(spark, "plain"), "doc_id bigint, accepted boolean, category string"
    rows = _table(spark, sf_dir, "documents").where("lang IS NOT NULL").join(_table(spark, sf_dir, "labels"), "doc_id").select("doc_id", (F.col("quality") == 1).alias("accepted"), F.col("lang").alias("category"))
    read = lambda tag: artifacts.read_inputs(spark, seeded, plain, schema).select("doc_id", "category", F.lit(tag).alias("tree"))
    artifacts.write_tree(rows, plain)
    before = read("plain")
    artifacts.write_tree(rows.where("category = 'en'"), seeded)
    return before.unionAll(read("seeded"))


@query(ORACLES["usage_rollup"])
def usage_trace(spark, sf_dir):
    """The roll-up of call events that went through a trace of JSON lines."""
    from millrace.sources.scratch import scratch_folder

    path = scratch_folder(spark, "trace")
    telemetry.append_events(_calls(spark, sf_dir), path)
    prices = spark.createDataFrame([("click", 0.2, 0.9), ("view", 0.2, None)], "model string, price_in double, price_out double")
    return telemetry.usage(telemetry.read_trace(spark, path), prices)


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def most_common(spark, sf_dir):
    return relational.most_common(_table(spark, sf_dir, "documents"), "source")


# -- generation --------------------------------------------------------------------------------------------------------


@query("""
SELECT item_id, 'system=Be {brief}. Give 2 items.|user=q|assistant=a|user=' || text || ' {' || item_id || '} of kind x' AS messages FROM benchmark""")
def prompt_messages(spark, sf_dir):
    from millrace.functions.prompts import Prompt

    config = {"system_prompt": "Be {{brief}}.", "template": "{text} {{{item}}} of kind {kind}", "few_shot_examples": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}
    prompt = Prompt(config, {"num_samples": "2", "kind": "x"}, "numbered", {"numbered": " Give {num_samples} items."})
    said = prompt.messages(text=F.col("text"), item=F.col("item_id"))
    return _table(spark, sf_dir, "benchmark").select("item_id", F.array_join(F.transform(said, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|").alias("messages"))


@query("""
SELECT item_id, CASE WHEN item_id % 3 = 2 THEN 'item ' || item_id || ';two' ELSE '' END AS strict,
  'item ' || item_id || CASE item_id % 3 WHEN 0 THEN '' WHEN 1 THEN chr(10) || '3. two' ELSE ';two' END AS loose FROM benchmark""")
def strict_samples(spark, sf_dir):
    """Replies with one item, a wrong number, and two items, read with and without the number that was asked for."""
    reply = F.concat(F.lit("1. **item "), F.col("item_id"), F.lit("**"), F.expr("CASE item_id % 3 WHEN 0 THEN '' WHEN 1 THEN '\\n3. two' ELSE '\\n2. two' END"))
    rows = _table(spark, sf_dir, "benchmark").select("item_id", reply.alias("reply"))
    return rows.select("item_id", F.array_join(parsing.samples("reply", 2), ";").alias("strict"), F.array_join(parsing.samples("reply"), ";").alias("loose"))


@query("""
WITH c AS (SELECT DISTINCT lang AS category FROM documents WHERE lang IS NOT NULL), t AS (SELECT category, turn, pos, (category = 'en')::INTEGER + 2 * turn + pos AS k FROM c, range(3) a(turn), range(2) b(pos))
SELECT category, category || ' ' || k AS sample, turn::INTEGER AS turn, pos::INTEGER AS pos, k % 2 = 0 AS accepted, CASE k % 2 WHEN 0 THEN '' ELSE 'no: odd' END AS reasoning FROM t""")
def standalone_turns(spark, sf_dir):
    """Turns until three samples of each category are accepted. The generator counts on from what it is told is known,
    and the checker refuses odd numbers."""
    from millrace.operators import generation, model_steps
    from millrace.sources.scratch import scratch_folder

    langs = _table(spark, sf_dir, "documents").where("lang IS NOT NULL").select(F.col("lang").alias("category")).distinct()
    known = F.when(F.col("prohibited") == "", 0).otherwise(F.size(F.split("prohibited", "\n")))
    numbered = lambda k: F.concat(F.lit(f"{k + 1}. "), F.col("category"), F.lit(" "), (known + k).cast("string"))
    odd = F.regexp_extract("sample", "\\d+$", 0).cast("int") % 2 == 1
    return generation.until_target(
        langs,
        lambda r: r.withColumn("reply", F.concat_ws("\n", numbered(0), numbered(1))),
        lambda reply: parsing.samples(reply, 2),
        lambda r: r.withColumn("reply", F.when(odd, "no: odd").otherwise("yes")).withColumn("error", F.lit(None).cast("string")),
        model_steps.saver(scratch_folder(spark, "turns")),
        target=3,
        per_request=2,
        existing=spark.createDataFrame([("en", "en 0")], "category string, sample string"),
    )
