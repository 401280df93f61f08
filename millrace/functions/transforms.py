"""Text transforms: built-in expressions where the semantics allow, seeded ones as Arrow-batched pandas functions.

A transform gives (text, info). Expressions stay in the JVM; seeded transforms need Python's random.Random so that a
seed gives the same text everywhere. Template transforms join a table of wordings that the user supplies.
"""

from __future__ import annotations

import base64
import random
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.keys import seed_of

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_TEXT_INFO = T.StructType([T.StructField("text", T.StringType()), T.StructField("info", T.StringType())])
_PRINTABLE = "".join(map(chr, range(33, 127)))

#: Letters and what stands for them, small and capital alike.
LEET_BASIC = {"a": "4", "e": "3", "i": "1", "o": "0", "s": "5", "t": "7"}
LEET_INTERMEDIATE = LEET_BASIC | {"b": "8", "g": "9", "l": "|", "z": "2", "c": "(", "r": "|2"}
LEET_ADVANCED = LEET_INTERMEDIATE | {"h": "|-|", "n": "|\\|", "u": "|_|", "w": "\\/\\/", "x": "><", "f": "|=", "k": "|<", "m": "|\\/|", "v": "\\/"}
#: International Morse code of A to Z, then 0 to 9.
MORSE = dict(zip(_UPPER + _DIGITS, (".- -... -.-. -.. . ..-. --. .... .. .--- -.- .-.. -- -. --- .--. --.- .-. ... - ..- ...- .-- -..- -.-- --.. ----- .---- ..--- ...-- ....- ..... -.... --... ---.. ----.").split())) | {" ": "/"}
#: Braille cells of a to z.
BRAILLE = "⠁⠃⠉⠙⠑⠋⠛⠓⠊⠚⠅⠇⠍⠝⠕⠏⠟⠗⠎⠞⠥⠧⠺⠭⠽⠵"
#: Words and their chat abbreviations.
ABBREVIATIONS = {
    "you": "u", "your": "ur", "are": "r", "please": "pls", "because": "bc", "thanks": "thx", "with": "w/", "without": "w/o", "people": "ppl", "something": "sth",
    "really": "rly", "about": "abt", "before": "b4", "tomorrow": "tmrw", "message": "msg", "information": "info", "though": "tho", "through": "thru", "okay": "ok", "probably": "prob",
}
#: Separators between characters.
SEPARATORS = ("-", "_", ".", "|", "/", "*", "~")
#: Share of the spaces that are dropped or doubled.
SPACE_SHARE = 0.2


def _rotated(alphabet: str, by: int) -> str:
    return alphabet[by:] + alphabet[:by]


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _mapped(text: Column, table: dict[str, str], sep: str = "", key: Callable[[Column], Column] = lambda c: c) -> Column:
    held = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.array_join(F.transform(_chars(text), lambda c: F.coalesce(F.element_at(held, key(c)), c)), sep)


def _leet(table: dict[str, str]) -> dict[str, str]:
    return table | {k.upper(): v for k, v in table.items()}


def _no_capitals(text: Column) -> Column:
    for letter in _UPPER:
        text = F.regexp_replace(text, f"(?U)(^|[.!?]\\s+){letter}", f"$1{letter.lower()}")
    return text


def _abbreviated(text: Column) -> Column:
    for word, short in ABBREVIATIONS.items():
        text = F.regexp_replace(text, f"(?iU)\\b{word}\\b", short)
    return text


#: Transforms that are one expression, by technique.
EXPRESSIONS: dict[str, Callable[[Column], Column]] = {
    "to_base64": lambda t: F.when(t == "", t).otherwise(F.concat(F.regexp_replace(F.base64(F.encode(t, "UTF-8")), "\r\n", "\n"), F.lit("\n"))),
    "to_rot13": lambda t: F.translate(t, _UPPER + _LOWER, _rotated(_UPPER, 13) + _rotated(_LOWER, 13)),
    "to_rot18": lambda t: F.translate(t, _UPPER + _LOWER + _DIGITS, _rotated(_UPPER, 13) + _rotated(_LOWER, 13) + _rotated(_DIGITS, 5)),
    "to_rot47": lambda t: F.translate(t, _PRINTABLE, _rotated(_PRINTABLE, 47)),
    "to_unicode_escape": lambda t: F.array_join(F.transform(_chars(t), lambda c: F.format_string("\\u%04x", F.ascii(c))), ""),
    "to_ascii_ordinal": lambda t: F.array_join(F.transform(_chars(t), lambda c: F.ascii(c).cast("string")), " "),
    "to_leetspeak_basic": lambda t: F.translate(t, "".join(_leet(LEET_BASIC)), "".join(_leet(LEET_BASIC).values())),
    "to_leetspeak_intermediate": lambda t: _mapped(t, _leet(LEET_INTERMEDIATE)),
    "to_leetspeak_advanced": lambda t: _mapped(t, _leet(LEET_ADVANCED)),
    "to_morse": lambda t: _mapped(t, MORSE, " ", F.upper),
    "to_braille": lambda t: F.translate(t, _LOWER + _UPPER, BRAILLE * 2),
    "to_lowercase": F.lower,
    "to_uppercase": F.upper,
    "to_no_sentence_capitals": _no_capitals,
    "to_dropped_punctuation": lambda t: F.regexp_replace(t, "(?U)[.,;:!?']+(?!\\d)", ""),
    "to_doubled_punctuation": lambda t: F.regexp_replace(t, "(?U)(?<![.!?])([.!?])(?=\\s|\\z)", "$1$1"),
    "to_abbreviations": _abbreviated,
}


def _changed_spaces(text: str, rng: random.Random, replacement: str) -> str:
    """One draw: a sample of the gaps between the parts that single spaces separate, a share of them and one at least."""
    first, *rest = text.split(" ")
    gaps = [" "] * len(rest)
    for k in rng.sample(range(len(gaps)), max(1, round(len(gaps) * SPACE_SHARE))) if gaps else ():
        gaps[k] = replacement
    return first + "".join(gap + part for gap, part in zip(gaps, rest))


#: What suffixes are made of.
SUFFIX_MARKS = ("!", "_", "=", "*", "/", '"', "~", "|", "bracket")
SUFFIX_BRACKETS = {"{": "}", "[": "]", "(": ")"}
SUFFIX_WORDS = ("inst", "direct", "inverse", "desc", "steps", "style", "output", "format", "theorem", "logic")
SUFFIX_SYMBOLS = "∀∃∑⇒∫λΩδ"
SUFFIX_EMOJI = ("🔓", "⚠️", "✅", "🚀", "🔥", "🤖", "💬", "💯")


def _one_run(rng: random.Random, items: tuple[str, ...], room: int) -> tuple[str, int]:
    """A run and how much room it takes. Draws: the item, then how often (1 to 5, within the room), then for brackets
    which; brackets open and close, so they take twice the room, as far as it goes, and one at least."""
    item, times = rng.choice(items), rng.randint(1, min(5, room))
    if item == "bracket":
        opening, times = rng.choice(list(SUFFIX_BRACKETS)), min(times, room // 2)
        return opening * times + SUFFIX_BRACKETS[opening] * times, max(1, 2 * times)
    return item * times, times


def _runs(rng: random.Random, low: int, high: int, items: tuple[str, ...]) -> str:
    """Runs that fill a room drawn first."""
    room, out = rng.randint(low, high), []
    while room > 0:
        run, taken = _one_run(rng, items, room)
        out.append(run)
        room -= taken
    return "".join(out)


def _listed(rng: random.Random, low: int, high: int, items: tuple[str, ...] | str) -> str:
    return " ".join(rng.choice(items) for _ in range(rng.randint(low, high)))


def _with_suffix(text: str, suffix: str) -> tuple[str, str]:
    return f"{text} {suffix}", suffix


def _separated(text: str, rng: random.Random) -> tuple[str, str]:
    mark = rng.choice(SEPARATORS)
    return mark.join(text), f"sep={mark}"


def strip_accents(text: str) -> str:
    return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)))


def _ascii_art(text: str, rng: random.Random) -> tuple[str, str]:
    try:
        import pyfiglet
    except ImportError as missing:
        raise NotImplementedError("to_ascii_art needs the package pyfiglet") from missing
    font = rng.choice(sorted(pyfiglet.FigletFont.getFonts()))
    return pyfiglet.figlet_format(text, font=font), f"font={font}"


#: Seeded transforms, by technique: (text, random) to (text, info).
SEEDED: dict[str, Callable[[str, random.Random], tuple[str, str]]] = {
    "to_separator": _separated,
    "to_dropped_spaces": lambda t, r: (_changed_spaces(t, r, ""), ""),
    "to_doubled_spaces": lambda t, r: (_changed_spaces(t, r, "  "), ""),
    "to_stripped_accents": lambda t, r: (strip_accents(t), ""),
    "to_adversarial_suffix_punctuation": lambda t, r: _with_suffix(t, _runs(r, 8, 40, SUFFIX_MARKS)),
    "to_adversarial_suffix_fragments": lambda t, r: _with_suffix(t, _listed(r, 2, 10, SUFFIX_WORDS)),
    "to_adversarial_suffix_unicode": lambda t, r: _with_suffix(t, _listed(r, 3, 10, SUFFIX_SYMBOLS)),
    "to_adversarial_suffix_emoji": lambda t, r: _with_suffix(t, _runs(r, 5, 20, SUFFIX_EMOJI)),
    "to_ascii_art": _ascii_art,
}


@F.pandas_udf(_TEXT_INFO)
def seeded_transform(technique: pd.Series, text: pd.Series, seed: pd.Series) -> pd.DataFrame:
    """Runs the seeded technique of each row with random.Random(seed); other techniques leave text as it is, info null."""
    rows = [SEEDED[n](t, random.Random(int(s))) if n in SEEDED and t is not None else (t, None) for n, t, s in zip(technique, text, seed)]
    return pd.DataFrame(rows, columns=["text", "info"])


@F.pandas_udf(T.IntegerType())
def seeded_choice(n: pd.Series, seed: pd.Series) -> pd.Series:
    """The index that random.Random(seed).choice takes of n."""
    return pd.Series([random.Random(int(s)).choice(range(int(k))) if k else None for k, s in zip(n, seed)], dtype="Int32")


# -- selective edits of given words ------------------------------------------------------------------------------------


def edit_words(text: Column, words: Column, edit: Callable[[Column], Column]) -> Column:
    """text with every occurrence of each word, in any case, replaced by the edit of the word; a fold over the words."""
    quoted = lambda w: F.concat(F.lit("(?i)\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    plain = lambda w: F.regexp_replace(edit(w), "([\\\\$])", "\\\\$1")
    return F.aggregate(words, text, lambda held, w: F.regexp_replace(held, quoted(w), plain(w)))


def separated_words(text: Column, words: Column, mark: str) -> Column:
    return edit_words(text, words, lambda w: F.array_join(_chars(w), mark))


def named_words(text: Column, words: Column) -> Column:
    """Words become VAR_1, VAR_2 ...; what they stand for is added as a last line."""
    numbered = F.transform(words, lambda w, k: F.struct(w.alias("w"), F.concat(F.lit("VAR_"), (k + 1).cast("string")).alias("v")))
    swapped = F.aggregate(numbered, text, lambda held, x: F.regexp_replace(held, F.concat(F.lit("(?i)\\Q"), x["w"], F.lit("\\E")), x["v"]))
    return F.when(F.size(words) <= 0, text).otherwise(F.concat(swapped, F.lit("\n"), F.array_join(F.transform(numbered, lambda x: F.concat(x["v"], F.lit(" = "), x["w"])), "; ")))


def listed_words(reply: Column, most: int = 10) -> Column:
    """The words of a reply that lists words; none if it says none or lists more than `most`."""
    words = F.filter(F.split(F.trim(reply), "[\\s,]+"), lambda w: w != "")
    return F.when((F.size(words) > most) | F.lower(F.trim(reply)).isin("none", ""), F.array().cast("array<string>")).otherwise(F.filter(words, lambda w: F.lower(w) != "none"))


def prepend_mark(word: str, rng: random.Random, marks: str = "qzxvQZXV0123456789!@#_~") -> str:
    return rng.choice(marks) + word


def split_word(word: str, rng: random.Random, marks: tuple[str, ...] = ("​", "‌", "‍", "⁠")) -> str:
    """The word with a mark inside, at a random place; after it if it is one character."""
    mark = rng.choice(marks)
    at = rng.randint(1, len(word) - 1) if len(word) > 1 else len(word)
    return word[:at] + mark + word[at:]


def delimit_word(word: str, rng: random.Random, marks: tuple[str, ...] = ('"', "'", "()", "[]", ".", "-")) -> str:
    """The word in quotes or brackets, or its characters apart."""
    mark = rng.choice(marks)
    return mark.join(word) if mark in ".-" else mark[0] + word + mark[-1]


# -- templates ---------------------------------------------------------------------------------------------------------

#: Wordings for tests and as a shape to fill in: {prompt} stands for the text.
PLACEHOLDER = {"default": ["[{directive}] {prompt}"]}


def template_table(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    """(directive, n, variant, template) from a user's wordings; every wording must hold {prompt}."""
    for directive, variants in templates.items():
        if not variants or any("{prompt}" not in v for v in variants):
            raise ValueError(f"{directive}: each wording must hold {{prompt}}")
    rows = [(d, len(vs), k, v) for d, vs in templates.items() for k, v in enumerate(vs)]
    return spark.createDataFrame(rows, "directive string, n int, variant int, template string")


def apply_templates(rows: DataFrame, templates: DataFrame, *, directive: str = "directive", text: str = "text", seed: str = "seed") -> DataFrame:
    """Adds (new_text, info): the directive's wording that the seed chooses, with the text in. The table of wordings is
    a small dimension that AQE broadcasts by its size; a directive without wordings keeps the text."""
    sizes = templates.select(F.col("directive").alias("_d"), F.col("n").alias("_n")).distinct()
    picked = rows.join(sizes, F.col(directive) == F.col("_d"), "left").withColumn("_v", seeded_choice(F.coalesce("_n", F.lit(0)), F.col(seed)))
    joined = picked.join(templates.select(F.col("directive").alias("_d2"), F.col("variant").alias("_v2"), "template"), (F.col("_d") == F.col("_d2")) & (F.col("_v") == F.col("_v2")), "left")
    filled = F.replace(F.replace("template", F.lit("{directive}"), F.col(directive)), F.lit("{prompt}"), F.col(text))
    return joined.withColumn("new_text", F.coalesce(filled, F.col(text))).withColumn("info", F.when(F.col("template").isNotNull(), F.concat(F.lit("directive="), F.col(directive), F.lit(";variant="), F.col("_v").cast("string"))).otherwise("")).drop("_d", "_n", "_v", "_d2", "_v2", "template")


def wrapped(text: Column, form: str) -> Column:
    """The text in a plain JSON, XML or Markdown document."""
    if form == "json":
        return F.to_json(F.struct(F.struct(text.alias("text")).alias("request")))
    if form == "xml":
        return F.concat(F.lit("<request><text>"), F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</text></request>"))
    return F.concat(F.lit("## Request\n\n"), text)


# -- shots -------------------------------------------------------------------------------------------------------------


@F.pandas_udf(_TEXT_INFO)
def with_shots(text: pd.Series, shots: pd.Series, seed: pd.Series, where: pd.Series) -> pd.DataFrame:
    """Three to seven of the row's question/answer shots, drawn by the seed, before the text or (`where` = middle)
    around it. Shots are arrays of struct(prompt, answer)."""
    out = []
    for t, pairs, s, place in zip(text, shots, seed, where):
        rng = random.Random(int(s))
        picked = rng.sample(list(pairs), min(len(pairs), rng.randint(3, 7)))
        blocks = [f"Q: {p['prompt']}\nA: {p['answer']}" for p in picked]
        at = rng.randint(1, len(blocks) - 1) if place == "middle" and len(blocks) > 1 else len(blocks)
        out.append(("\n\n".join([*blocks[:at], f"Q: {t}", *blocks[at:]]), f"num_shots={len(blocks)}"))
    return pd.DataFrame(out, columns=["text", "info"])


# -- chains ------------------------------------------------------------------------------------------------------------

DISCARDED = "DISCARDED"


def _each(text: str, table: dict[str, str], sep: str = "") -> str:
    return sep.join(table.get(c, c) for c in text)


def _small_openings(text: str) -> str:
    out, opening, ended = [], True, False
    for c in text:
        out.append(c.lower() if opening and c in _UPPER else c)
        opening, ended = (ended or opening and bool(out[:-1])) and c.isspace(), c in ".!?" or (ended and c.isspace())
    return "".join(out)


def _by_neighbours(text: str, rule: Callable[[str, str, str], str]) -> str:
    return "".join(rule(before, c, after) for before, c, after in zip(" " + text, text, text[1:] + " "))


#: The expressions once more, for chains that run in a worker; tests hold the two against each other.
IN_PYTHON: dict[str, Callable[[str], str]] = {
    "to_base64": lambda t: base64.encodebytes(t.encode()).decode(),
    "to_rot13": lambda t: t.translate(str.maketrans(_UPPER + _LOWER, _rotated(_UPPER, 13) + _rotated(_LOWER, 13))),
    "to_rot18": lambda t: t.translate(str.maketrans(_UPPER + _LOWER + _DIGITS, _rotated(_UPPER, 13) + _rotated(_LOWER, 13) + _rotated(_DIGITS, 5))),
    "to_rot47": lambda t: t.translate(str.maketrans(_PRINTABLE, _rotated(_PRINTABLE, 47))),
    "to_unicode_escape": lambda t: "".join("\\u%04x" % ord(c) for c in t),
    "to_ascii_ordinal": lambda t: " ".join(map(str, map(ord, t))),
    "to_leetspeak_basic": lambda t: _each(t, _leet(LEET_BASIC)),
    "to_leetspeak_intermediate": lambda t: _each(t, _leet(LEET_INTERMEDIATE)),
    "to_leetspeak_advanced": lambda t: _each(t, _leet(LEET_ADVANCED)),
    "to_morse": lambda t: _each(t, MORSE | {k.lower(): v for k, v in MORSE.items()}, " "),
    "to_braille": lambda t: t.translate(str.maketrans(_LOWER + _UPPER, BRAILLE * 2)),
    "to_lowercase": str.lower,
    "to_uppercase": str.upper,
    "to_no_sentence_capitals": _small_openings,
    "to_dropped_punctuation": lambda t: _by_neighbours(t, lambda _, c, after: "" if c in ".,;:!?'" and not after.isdigit() else c),
    "to_doubled_punctuation": lambda t: _by_neighbours(t, lambda before, c, after: c * 2 if c in ".!?" and before not in ".!?" and after.isspace() else c),
    "to_abbreviations": lambda t: re.sub(r"\w+", lambda w: ABBREVIATIONS.get(w[0].lower(), w[0]), t),
}


def run_chain(text: str, combination: list[str], seed_parts: tuple) -> tuple[str, str]:
    """(text, info) after the techniques in order, each with random numbers of its own. A technique that isn't known
    here ends the chain with the text before it."""
    infos = []
    for name in combination:
        if name in IN_PYTHON:
            new, info = IN_PYTHON[name](text), ""
        elif name in SEEDED:
            new, info = SEEDED[name](text, random.Random(seed_of(*seed_parts, name)))
        else:
            return text, f"{DISCARDED}; technique={name}"
        infos.append(f"noop={name}" if new == text else info)
        text = new
    return text, ";".join(i for i in infos if i)


def run_chains(plan: DataFrame, *, text: str = "text", combination: str = "combination", seed_parts: tuple[str, ...] = ("seed", "sample_id", "iteration")) -> DataFrame:
    """Runs each row's combination (array of technique names) over its text; adds result and info.

    A plan has another chain in every row, so chains run as one Arrow-batched function; a single technique over a
    column is better served by EXPRESSIONS. Template and model techniques are steps of their own and reject the row
    here: the result is the text before and info begins with DISCARDED. A step that changes nothing notes noop=<name>.
    A null text gives nulls.
    """

    @F.pandas_udf(_TEXT_INFO)
    def chains(texts: pd.Series, names: pd.Series, *parts: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if t is None else run_chain(t, list(n if n is not None else ()), p) for t, n, *p in zip(texts, names, *parts)]
        return pd.DataFrame(rows, columns=["text", "info"])

    done = plan.withColumn("_r", chains(F.col(text), F.col(combination), *[F.col(p).cast("string") for p in seed_parts]))
    return done.withColumn("result", F.col("_r.text")).withColumn("info", F.col("_r.info")).drop("_r")


__all__ = ["EXPRESSIONS", "SEEDED", "apply_templates", "edit_words", "run_chains", "seed_of", "seeded_choice", "seeded_transform", "template_table", "with_shots", "wrapped"]
