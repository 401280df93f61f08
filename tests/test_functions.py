import base64
import codecs
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import keys, parsing, prompts, techniques, text, transforms

SF = "/root/testdata/sf0.001"


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t")).alias("r")).first()[0]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 1000])
def test_hash_bucket_is_the_256_bit_modulus(spark, n):
    rows = spark.range(50).select("id", keys.hash_bucket(n, F.lit("42"), F.col("id").cast("string")).alias("b")).collect()
    assert all(r.b == int(hashlib.sha256(f"42:{r.id}".encode()).hexdigest(), 16) % n for r in rows)


def test_stable_seed_matches_the_driver(spark):
    rows = spark.range(20).select("id", keys.stable_seed(F.lit("7"), F.col("id").cast("string")).alias("s")).collect()
    assert all(int(r.s) == keys.seed_of(7, r.id) for r in rows)


@pytest.mark.parametrize(("reply", "accepted"), [("**Yes**, it is", True), ("Yes.", True), ("  > ok", True), ("“Passed”", True), ("Yesterday", False), ("Acceptable", False), ("Verdict: yes", False), ("", False), (None, False)])
def test_verdict(spark, reply, accepted):
    assert one(spark, reply, text.is_accepted) is accepted


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("**bold** and *it* and `code`", "bold and it and code"),
        ("2**3 and **kwargs", "2**3 and **kwargs"),
        ("a <|im_end|> b", "a \n b"),
        ("```python\nx = 1\n```", "x = 1"),
        ("a\n\n\n\nb", "a\n\nb"),
        ("  x \r\n", "x"),
    ],
)
def test_clean_sample(spark, raw, clean):
    assert one(spark, raw, text.clean_sample) == clean


def test_render_keeps_braces(spark):
    assert one(spark, "v", lambda c: text.render(F.lit("{{a}} {a} {{{a}}} {b}"), a=F.lit("{b}"))) == "{a} {b} {{b}} {b}"


def test_messages(spark):
    users = F.array(F.struct(F.lit("user").alias("role"), F.lit("hi").alias("content")))
    assert one(spark, "x", lambda c: text.append_to_user(users, F.lit("!")))[0].content == "hi!"
    none = F.expr(f"CAST(array() AS array<{text.MESSAGE}>)")
    assert [m.role for m in one(spark, "x", lambda c: text.append_to_user(none, F.lit("!")))] == ["user"]


@pytest.mark.parametrize(
    ("reply", "strict", "items"),
    [
        ("1. a\n2. b", True, ["a", "b"]),
        ("intro\n1) a\nmore\n2) b", False, ["a\nmore", "b"]),
        ("1. a\n3. b", False, ["a\n3. b"]),
        ("1. a\n3. b", True, []),
        ("1. a\n2) b", True, []),
        ("1. a\n  1. nested\n2. b", True, ["a\n  1. nested", "b"]),
        ("**1. T** x\n**2. U** y", True, ["**T** x", "**U** y"]),
        ("1. a\n2. <|im_end|>", True, []),
        ("none", False, []),
        (None, False, []),
        ("2 - 5 degrees", False, []),
    ],
)
def test_numbered_items(reply, strict, items):
    assert parsing.numbered_items(reply, strict) == items


def test_question_answers():
    block = "**Prompt 1:**\n**Question:** q1\n**Answer:** a1\n**Prompt 2:**\n**Question:** q2\n**Answer:** a2"
    assert parsing.question_answers(block) == [("q1", "a1"), ("q2", "a2")]
    assert parsing.question_answers(block, 2) == [("q1", "a1"), ("q2", "a2")]
    assert parsing.question_answers(block, 3) == []
    assert parsing.question_answers(block + "\n---", 2) == []
    assert parsing.question_answers("**Question:** q\n**Question:** r\n**Answer:** a") == [("r", "a")]
    assert parsing.question_answers("") == []


def test_table_functions(spark):
    parsing.register(spark)
    rows = spark.sql("SELECT item FROM VALUES ('1. a\n2. b') t(r), LATERAL parse_numbered(r, true)").collect()
    assert [r.item for r in rows] == ["a", "b"]


def test_outline(spark):
    reply = "## 1. **Main**\n### 1.1 Sub:\n- (one (nested) item)\n- two\n## broken\n- (lost)\n## 2. Next\n- (kept)"
    assert [tuple(r) for r in one(spark, reply, lambda c: parsing.outline_entries("t"))] == [("Main", "Sub", "one (nested) item"), ("Next", "", "kept")]


TEXTS = ["Hello, World! 123", "", "ß é Ünï 🙂", "a.b? c!! You are okay. It's 3.5", "you with\tYour PEOPLE"]
PLAIN = {
    "to_base64": lambda t: codecs.encode(t.encode(), "base64").decode(),
    "to_rot13": lambda t: codecs.encode(t, "rot_13"),
    "to_unicode_escape": lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
    "to_ascii_ordinal": lambda t: " ".join(str(ord(c)) for c in t),
    "to_lowercase": str.lower,
    "to_uppercase": str.upper,
}


@pytest.mark.parametrize("name", PLAIN)
def test_expressions_against_python(spark, name):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", transforms.EXPRESSIONS[name](F.col("t")).alias("r")).collect()
    assert all(r.r == PLAIN[name](r.t) for r in rows)


@pytest.mark.parametrize(
    ("name", "given", "result"),
    [
        ("to_rot18", "Ab1", "No6"),
        ("to_rot47", "Az~", "pKO"),
        ("to_leetspeak_advanced", "Wh", "\\/\\/|-|"),
        ("to_morse", "So s", "... --- / ..."),
        ("to_braille", "Ab", "⠁⠃"),
        ("to_no_sentence_capitals", "Ab. Cd! Ef", "ab. cd! ef"),
        ("to_dropped_punctuation", "Hi, it's 3.5!", "Hi its 3.5"),
        ("to_doubled_punctuation", "Hi. No... Ok?", "Hi.. No... Ok??"),
        ("to_abbreviations", "You and your PEOPLE, without", "u and ur ppl, w/o"),
    ],
)
def test_expressions(spark, name, given, result):
    assert one(spark, given, transforms.EXPRESSIONS[name]) == result


@pytest.mark.parametrize("name", [n for n in transforms.SEEDED if n != "to_ascii_art"])
def test_seeded_transforms_repeat(spark, name):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", transforms.seeded_transform(F.lit(name), "t", F.lit("5")).alias("r")).collect()
    for r in rows:
        assert (r.r.text, r.r.info) == transforms.SEEDED[name](r.t, random.Random(5))


def test_spaces_and_accents():
    assert transforms.strip_accents("é ñ Å") == "e n A"
    changed = transforms._changed_spaces("a b c d e f g h i j k", random.Random(1), "")
    assert changed.count(" ") == 8
    assert transforms._changed_spaces("abc", random.Random(1), "") == "abc"


@pytest.mark.parametrize("name", transforms.EXPRESSIONS)
def test_expressions_in_python(spark, name):
    docs = spark.read.parquet(f"{SF}/conversations.parquet").select("text").limit(40)
    rows = [*docs.select(F.col("text").alias("t"), transforms.EXPRESSIONS[name](F.col("text")).alias("r")).collect()]
    rows += spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", transforms.EXPRESSIONS[name](F.col("t")).alias("r")).collect()
    assert [transforms.IN_PYTHON[name](r.t) for r in rows] == [r.r for r in rows]


def test_selective_edits(spark):
    words = F.array(F.lit("a.b"), F.lit("$x\\"))
    assert one(spark, "A.B aXb $x\\", lambda c: transforms.edit_words(c, words, lambda w: F.concat(F.lit("<"), w, F.lit(">")))) == "<a.b> aXb <$x\\>"
    assert one(spark, "red Red blue", lambda c: transforms.named_words(c, F.array(F.lit("red")))) == "VAR_1 VAR_1 blue\nVAR_1 = red"
    assert one(spark, "one, two", lambda c: transforms.listed_words(c)) == ["one", "two"]
    assert one(spark, "none", lambda c: transforms.listed_words(c)) == []


def test_base64_lines(spark):
    long = "x" * 200
    assert one(spark, long, transforms.EXPRESSIONS["to_base64"]) == base64.encodebytes(long.encode()).decode()


def test_chain(spark):
    rows = spark.createDataFrame([("1", "Ab c", ["to_uppercase", "to_rot13"]), ("2", "AB", ["to_uppercase"]), ("3", "ab", ["to_uppercase", "to_summarize"])], "sample_id string, text string, combination array<string>")
    found = {r.sample_id: (r.result, r.info) for r in transforms.run_chains(rows.withColumn("seed", F.lit(1)).withColumn("iteration", F.lit(0))).collect()}
    assert found == {"1": ("NO P", ""), "2": ("AB", "noop=to_uppercase"), "3": ("AB", "DISCARDED; technique=to_summarize")}


def test_templates(spark):
    table = transforms.template_table(spark, {"d": ["1 {prompt}", "2 {prompt}"]})
    rows = spark.createDataFrame([("d", "x", "1"), ("other", "y", "2"), ("d", "z", "3")], "directive string, text string, seed string")
    found = {r.text: (r.new_text, r.info) for r in transforms.apply_templates(rows, table).collect()}
    assert found["y"] == ("y", "")
    assert found["x"][0] == f"{random.Random(1).choice(range(2)) + 1} x"
    with pytest.raises(ValueError, match="prompt"):
        transforms.template_table(spark, {"d": ["no place"]})


def test_registry():
    known = {t.name: t for t in techniques.all_techniques()}
    assert len(known) == 152
    assert len({t.families[0] for t in known.values()}) == 23
    a, b = known["to_structural" if "to_structural" in known else "to_json"], known["to_ascii_art"]
    assert not techniques.compatible(a, b) and not techniques.compatible(b, a)
    fsh = known["to_fsh_random_short"]
    assert not techniques.compatible(fsh, known["to_base64"]) and techniques.compatible(fsh, known["to_rot13"])
    assert techniques.compatible(fsh, known["to_sensitive_words_encode_base64"])
    assert not techniques.compatible(known["to_dap_random_short"], known["to_french"]) and not techniques.compatible(known["to_summarize"], fsh)
    with pytest.raises(ValueError, match="unknown"):
        techniques.technique_pool(names=("nope",))


def test_samples_with_counts():
    assert parsing.samples_of("1. **a**\n2. b") == ["a", "b"]
    assert parsing.samples_of("1. a\n2. b", "2") == ["a", "b"]
    assert parsing.samples_of("1. a\n2. b", 3) == []
    assert parsing.samples_of("1. a\n2. ```\n```", 2) == []
    assert parsing.samples_of("3. a") == ["a"] and parsing.samples_of("3. a", 1) == []
    assert parsing.samples_of(None, 1) == [] and parsing.samples_of("") == []
    for wrong in (0, -1, True, 1.0, None, "x", ""):
        with pytest.raises(ValueError):
            parsing.sample_count(wrong)


def test_prompts(spark):
    rows = spark.createDataFrame([("v {x}",), (None,)], "v string")
    prompt = prompts.Prompt.load('{"template": "{a}{b}"}', values={"a": "shared", "b": ""})
    got = rows.select(prompt.messages(a=F.col("v")).alias("m")).collect()
    assert [[tuple(m) for m in r.m] for r in got] == [[("user", "v {x}")], []]
    with pytest.raises(ValueError, match="template lacks b"):
        prompts.Prompt({"template": "{b}"}).messages()
    with pytest.raises(ValueError, match="system_prompt lacks c"):
        prompts.Prompt({"system_prompt": "{{a}} {c}"})
    with pytest.raises(ValueError):
        prompts.Prompt({}, {}, "numbered", {"numbered": "{num_samples}"})
    with pytest.raises(ValueError):
        prompts.Prompt.load("[]")
    assert prompts.Prompt({}, {"num_samples": 3}, "numbered", {"numbered": "{num_samples}"}).system == "3"
    for style in ("other", "structured_qa"):
        with pytest.raises(ValueError):
            prompts.format_instruction({"numbered": ""}, style, 1)


def test_registry_problems():
    assert techniques.registry_problems({"a", "b"}, {"b", "_note"}) == ["not specified: a"]
    assert techniques.registry_problems({"a"}, {"a", "c"}) == ["not registered: c"]
    assert techniques.uses_translation(techniques.technique_pool(families=("translation",)))
    assert not techniques.uses_translation(techniques.technique_pool(families=("encode",)))
