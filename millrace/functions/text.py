"""Verdicts, cleaning and rendering of texts as column expressions; cleaning is a scan in Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: First words of a reply that accept.
ACCEPT_WORDS = ("yes", "ok", "okay", "accept", "accepted", "pass", "passed")
#: Cells of a CSV that mean accepted.
ACCEPTED_CELLS = ("True", "TRUE", "true")
#: Cells that readers of the CSV artifacts take as missing.
MISSING_CELLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Four kinds of entries.
ENTRY_TYPES = ("harmful", "dual_use_harmful", "dual_use_benign", "benign")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_word(reply: Column | str) -> Column:
    """The reply's first word in lower case, after white space, Markdown and quote marks; empty if it has none."""
    return F.lower(F.regexp_extract(_c(reply), "(?U)^[\\s*_#>\"'`“”‘’]*([^\\W_]+)", 1))


def is_accepted(reply: Column | str) -> Column:
    return F.coalesce(first_word(reply).isin(*ACCEPT_WORDS), F.lit(False))


def verdict(reply: Column | str) -> Column:
    """struct(accepted, reasoning): the reasoning of a rejection is the whole reply."""
    return F.struct(is_accepted(reply).alias("accepted"), F.when(is_accepted(reply), "").otherwise(_c(reply)).alias("reasoning"))


def accepted_cell(cell: Column | str) -> Column:
    """A CSV cell as a verdict; only the spellings of ACCEPTED_CELLS accept."""
    return F.coalesce(_c(cell).cast("string").isin(*ACCEPTED_CELLS), F.lit(False))


def missing_to_null(cell: Column | str) -> Column:
    return F.when(~_c(cell).isin(*MISSING_CELLS), _c(cell))


def text_cell(text: Column | str) -> Column:
    """A text as a cell that is not missing: backslashes and one of MISSING_CELLS get one more backslash before them."""
    return F.when(F.ltrim(_c(text), F.lit("\\")).isin(*MISSING_CELLS), F.concat(F.lit("\\"), _c(text))).otherwise(_c(text))


def cell_text(cell: Column | str) -> Column:
    """The text of a cell that text_cell made."""
    marked = _c(cell).startswith("\\") & F.ltrim(_c(cell), F.lit("\\")).isin(*MISSING_CELLS)
    return F.when(marked, F.substr(_c(cell), F.lit(2))).otherwise(_c(cell))


#: How chat turns begin and end, and the roles that may follow a beginning.
CHAT_MARKS = ("|im_start", "|im_end")
CHAT_ROLES = ("system", "user", "assistant")
FENCE, CODE, BOLD, ITALIC = "```", "`", "**", "*"


def _is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def without_chat_marks(text: str) -> str:
    """Chat marks, whole or cut at either end, become line breaks."""
    out, at = [], 0
    while at < len(text):
        mark = next((m for m in CHAT_MARKS if text.startswith(m, at)), None)
        if mark is None:
            out.append(text[at])
            at += 1
            continue
        if out and out[-1] == "<":
            out.pop()
        at += len(mark)
        for tail in "|>":
            at += text.startswith(tail, at)
        role = next((r for r in CHAT_ROLES if mark == CHAT_MARKS[0] and text.startswith(r, at) and not _is_word(text[at + len(r) : at + len(r) + 1] or " ")), "")
        at += len(role)
        out.append("\n")
    return "".join(out)


def without_fences(text: str) -> str:
    """Code fences go, and with each opening one the name of a language that has the rest of the line."""
    outside, *rest = text.split(FENCE)
    out = [outside]
    for k, piece in enumerate(rest):
        opens = k % 2 == 0
        line, end, body = piece.partition("\n")
        named = all(_is_word(c) or c in "+#.-" for c in line.rstrip(" \t")) and bool(end or k == len(rest) - 1)
        out.append(body if opens and named else piece)
    return "".join(out)


def without_pairs(line: str, mark: str) -> str:
    """Marks around a part of a line go. A mark opens where neither a star nor a word is before it and no space after, and
    closes where no space is before it and no word (for a single star, no star) after; code marks need nothing but a text
    between them."""
    out, at = [], 0
    while at < len(line):
        close = _closing(line, mark, at) if line.startswith(mark, at) else -1
        if close < 0:
            out.append(line[at])
            at += 1
            continue
        out.append(line[at + len(mark) : close])
        at = close + len(mark)
    return "".join(out)


def _closing(line: str, mark: str, at: int) -> int:
    """Where the pair that opens at this place closes, or -1."""
    start = at + len(mark)
    if mark == CODE:
        return line.find(mark, start + 1)
    before = line[at - 1] if at else " "
    if before == "*" or _is_word(before) or line[start : start + 1].isspace():
        return -1
    close = line.find(mark, start + 1)
    while close >= 0:
        after = line[close + len(mark) : close + len(mark) + 1] or " "
        if mark == ITALIC and "*" in line[start:close]:
            return -1
        if not line[close - 1].isspace() and not _is_word(after) and not (mark == ITALIC and after == "*"):
            return close
        if mark == BOLD:
            return -1
        close = line.find(mark, close + 1)
    return -1


def cleaned(text: str, strip_markdown: bool = True) -> str:
    """A sample without chat marks, Markdown wrapping and runs of blank lines, trimmed."""
    text = without_chat_marks(text.replace("\r\n", "\n"))
    if strip_markdown:
        lines = without_fences(text).split("\n")
        for mark in (BOLD, ITALIC, CODE):
            lines = [without_pairs(line, mark) if mark in line else line for line in lines]
        text = "\n".join(lines)
    kept: list[str] = []
    lines = text.split("\n")
    k = 0
    while k < len(lines):
        blank = k
        while blank < len(lines) and not lines[blank].strip(" \t\r"):
            blank += 1
        # of two blank lines and more that other lines enclose, one stays
        if blank - k >= 2 and 0 < k and blank < len(lines):
            kept.append("")
            k = blank
        kept.append(lines[k])
        k += 1
    return "\n".join(kept).strip()


def clean_sample(text: Column | str, strip_markdown: bool = True) -> Column:
    """cleaned() over a column. Replies of models are few beside the texts that are read, so the scan is one of Python in
    Arrow batches."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else cleaned(t, strip_markdown))

    return clean(_c(text))


def strip_end_marker(text: Column | str) -> Column:
    """struct(text, complete): a reply is complete if it ends with [END], which is taken off."""
    pattern = "(?U)\\n?\\[END\\]\\s*\\z"
    return F.struct(F.regexp_replace(_c(text), pattern, "").alias("text"), _c(text).rlike(pattern).alias("complete"))


def ordinal_list(items: Column | str) -> Column:
    """`1. a`, `2. b`, ... as lines."""
    return F.array_join(F.transform(_c(items), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def render(template: Column | str, **values: Column) -> Column:
    """A template with {name} replaced by the columns given and doubled braces made single. A brace after an even
    number of braces opens a name; values are put in last, so that braces in them stay."""
    out = _c(template)
    for k, name in enumerate(values):
        out = F.regexp_replace(out, "(?<!\\{)((?:\\{\\{)*)\\{" + name + "\\}", f"$1\x01{k}\x02")
    out = F.replace(F.replace(out, F.lit("{{"), F.lit("{")), F.lit("}}"), F.lit("}"))
    for k, value in enumerate(values.values()):
        out = F.replace(out, F.lit(f"\x01{k}\x02"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def field_names(template: Column | str) -> Column:
    """The distinct placeholder names of a template."""
    return F.array_distinct(F.regexp_extract_all(F.replace(F.replace(_c(template), F.lit("{{"), F.lit("")), F.lit("}}"), F.lit("")), F.lit("\\{(\\w+)"), 1))


def match_case(original: Column, replacement: Column) -> Column:
    """The replacement in the original's case: all capitals, all small, or capitalised; else as it is."""
    letters = F.upper(original) != F.lower(original)
    return (
        F.when(letters & (original == F.upper(original)), F.upper(replacement))
        .when(letters & (original == F.lower(original)), F.lower(replacement))
        .when(F.substring(original, 1, 1) != F.lower(F.substring(original, 1, 1)), F.concat(F.upper(F.substring(replacement, 1, 1)), F.lower(F.substr(replacement, F.lit(2)))))
        .otherwise(replacement)
    )


def prohibited_note(texts: Column, shown: int = 20) -> Column:
    """The first texts as a list, and how many more there are; empty for none."""
    more = F.size(texts) - shown
    lines = F.concat_ws("\n", F.transform(F.slice(texts, 1, shown), lambda t: F.concat(F.lit("- "), t)))
    return F.when(F.size(texts) <= 0, "").otherwise(F.concat(lines, F.when(more > 0, F.concat(F.lit("\n… and "), more.cast("string"), F.lit(" more"))).otherwise("")))


def rejection_feedback(results: Column, most: int = 3, chars: int = 200) -> Column:
    """results: array of struct(accepted, reasoning). The first rejections as a list, each cut to so many characters."""
    rejected = F.filter(results, lambda r: ~r["accepted"] & (r["reasoning"] != ""))
    return F.array_join(F.transform(F.slice(rejected, 1, most), lambda r: F.concat(F.lit("- "), F.substring(r["reasoning"], 1, chars))), "\n")


MESSAGE = "struct<role:string,content:string>"


def append_to_user(messages: Column, text: Column) -> Column:
    """messages with text added to the last one if it is the user's, else as a message of the user."""
    last = F.element_at(messages, -1)
    mine = F.struct(F.lit("user").alias("role"), F.concat(last["content"], text).alias("content"))
    new = F.struct(F.lit("user").alias("role"), text.alias("content"))
    merged = F.concat(F.slice(messages, 1, F.size(messages) - 1), F.array(mine))
    return F.when(F.size(messages) <= 0, F.array(new)).when(last["role"] == "user", merged).otherwise(F.concat(messages, F.array(new)))


def few_shot_messages(system: Column, shots: Column, user: Column) -> Column:
    """The system message where there is one, an exchange per shot struct(input, output), then the user's message."""
    one = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    head = F.when(F.coalesce(system, F.lit("")) != "", F.array(one("system", system))).otherwise(F.expr(f"CAST(array() AS array<{MESSAGE}>)"))
    return F.concat(head, F.flatten(F.transform(shots, lambda s: F.array(one("user", s["input"]), one("assistant", s["output"])))), F.array(one("user", user)))
