"""License scans with ordered signature rules, in DataFrame operations only.

A text becomes its words, each after one space, so that regular expressions see words at any punctuation. Rules stand
in groups that share a keyword; a group's expressions are only tried on texts that hold its keyword. Every match is an
interval of words. A match is suppressed if a match of the same or a better priority covers its interval; of equal
intervals the rule that comes first stays. All of it is a map over the rows: no shuffle and no group to be skewed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import ascii_lower, table

NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: The phrases that always count, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Label, keyword, name in words (a regular expression), SPDX identifier in words.
NAMES = (
    ("mit", "mit", "mit", "mit"),
    ("mit-0", "mit", "mit no attribution", "mit 0"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? 1 1", "apache 1 1"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version)? 2(?: 0)?", "apache 2 0"),
    ("bsd-2-clause", "bsd", "(?:simplified|2 clause|two clause) bsd", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:new|modified|revised|3 clause|three clause) bsd", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:original|4 clause|four clause) bsd", "bsd 4 clause"),
    ("0bsd", "bsd", "(?:zero clause|0 clause) bsd", "0bsd"),
    ("gpl-1.0", "gpl", "(?:gnu )?gpl(?: version)? (?:v )?v?1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", "gpl", "(?:gnu )?gpl(?: version)? (?:v )?v?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "gpl", "(?:gnu )?gpl(?: version)? (?:v )?v?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl", "gnu general", "gnu general public", "gpl"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl(?: version)? (?:v )?v?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "lgpl", "(?:gnu )?lgpl(?: version)? (?:v )?v?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl", "gnu lesser", "gnu lesser general public", "lgpl"),
    ("agpl-3.0", "agpl", "(?:gnu )?agpl(?: version)? (?:v )?v?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("agpl", "gnu affero", "gnu affero general public", "agpl"),
    ("gfdl", "documentation", "gnu free documentation", "gfdl 1 3"),
    ("mpl-1.1", "mozilla", "mozilla public(?: license)?(?: version)? 1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", "mozilla public(?: license)?(?: version)? 2 0", "mpl 2 0"),
    ("epl-1.0", "eclipse", "eclipse public(?: license)?(?: version)? 1 0", "epl 1 0"),
    ("epl-2.0", "eclipse", "eclipse public(?: license)?(?: version)? 2 0", "epl 2 0"),
    ("cddl-1.0", "common development", "common development and distribution", "cddl 1 0"),
    ("eupl-1.2", "european", "european union public", "eupl 1 2"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("boost-1.0", "boost", "boost software", "bsl 1 0"),
    ("artistic-2.0", "artistic", "artistic(?: license)? 2 0", "artistic 2 0"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("python-2.0", "python", "python software foundation", "python 2 0"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("ms-pl", "microsoft", "microsoft public", "ms pl"),
    ("ofl-1.1", "open font", "(?:sil )?open font", "ofl 1 1"),
    ("odbl-1.0", "open database", "open database", "odbl 1 0"),
    ("odc-by-1.0", "open data", "open data commons attribution", "odc by 1 0"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?", "cc0 1 0"),
    ("cc-by-2.0", "cc by", "cc by 2 0", "cc by 2 0"),
    ("cc-by-3.0", "cc by", "cc by 3 0", "cc by 3 0"),
    ("cc-by-4.0", "cc by", "cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-3.0", "cc by sa", "cc by sa 3 0", "cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by sa", "cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nd-4.0", "cc by nd", "cc by nd 4 0", "cc by nd 4 0"),
    ("cc-by-nc-3.0", "cc by nc", "cc by nc 3 0", "cc by nc 3 0"),
    ("cc-by-nc-4.0", "cc by nc", "cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa", "cc by nc sa 4 0", "cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd", "cc by nc nd 4 0", "cc by nc nd 4 0"),
    ("llama", "llama", "llama [0-9](?: [0-9])?(?: community)?", "llama [0-9]"),
    ("openrail", "openrail", "(?:bigscience |creativeml )?openrail(?: m)?", "openrail"),
)

#: The keyword of forms around {spdx}, which needs none of a name's words.
SPDX = "spdx license identifier"

#: How a name becomes rules: expression around {name} or {spdx}, priority (0 is best), confidence.
FORMS = (
    (SPDX + " {spdx}", 1, 0.99),
    ("(?:licensed|released|distributed|available|provided|published|offered) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}(?: licen[cs]e)?", 1, 0.95),
    ("{name} licen[cs]e", 2, 0.8),
    ("see (?:the )?{name}(?: licen[cs]e)? for (?:more )?details", 3, 0.6),
    ("{name} licensed", 3, 0.6),
)

#: Rules of their own: keyword, expression, label, priority, confidence.
SINGLE = (
    ("hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", "mit", 1, 0.98),
    ("permission to use", "permission to use copy modify and or distribute this software for any purpose", "isc", 1, 0.97),
    ("redistribution and use", "redistribution and use in source and binary forms", "bsd-3-clause", 1, 0.9),
    ("free software", "this program is free software you can redistribute it and or modify it", "gpl", 1, 0.95),
    ("public domain", "(?:released|dedicated|placed)(?: in)?(?: to)? ?the public domain", "public-domain", 1, 0.9),
    ("public domain", "(?:in )?the public domain", "public-domain", 3, 0.5),
    ("rights reserved", "all rights reserved", "all-rights-reserved", 2, 0.7),
    ("rights reserved", "(?:some|no) rights reserved", "rights-reserved", 2, 0.5),
    ("copyright", "copyright (?:c )?[0-9]{4}", "copyright-notice", 3, 0.4),
    ("confidential", "(?:strictly |proprietary and )confidential", "proprietary", 2, 0.6),
    ("without permission", "(?:may not be )?reproduced without permission", "proprietary", 2, 0.6),
    ("attribution noncommercial", "creative commons attribution noncommercial", "cc-by-nc", 1, 0.95),
    ("attribution sharealike", "creative commons attribution sharealike", "cc-by-sa", 1, 0.95),
    ("creative commons", "creative commons attribution", "cc-by", 2, 0.8),
)


@dataclass(frozen=True)
class Rule:
    keyword: str
    expression: str
    label: str
    priority: int
    confidence: float
    base: bool = False


def default_rules() -> tuple[Rule, ...]:
    base = [Rule(phrase, phrase, label, 0, 1.0, True) for phrase, label in BASE]
    named = [Rule(SPDX if "{spdx}" in form else keyword, form.format(name=name, spdx=spdx), label, priority, confidence) for form, priority, confidence in FORMS for label, keyword, name, spdx in NAMES]
    return (*base, *(Rule(*single) for single in SINGLE), *named)


_HIT = "struct<first:int,far:int,priority:int,rule:int,label:string,confidence:double,base:boolean>"


def _rule_groups(rules: tuple[Rule, ...]) -> Column:
    groups: dict[str, list[Column]] = {}
    for k, r in enumerate(rules):
        one = F.struct(F.lit(k).alias("rule"), F.lit(f" (?:{r.expression})(?= |\\z)").alias("expression"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(float(r.confidence)).alias("confidence"), F.lit(r.base).alias("base"))
        groups.setdefault(r.keyword, []).append(one)
    return F.array(*[F.struct(F.lit(f" {keyword} ").alias("keyword"), F.array(*members).alias("rules")) for keyword, members in groups.items()])


def _spaces(x: str) -> str:
    return f"(length({x}) - length(replace({x}, ' ', '')))"


# Matches of one rule: the pieces between matches and the matches, walked in order, counting words.
_MATCHES = f"""
transform(array(named_struct('p', split(_norm, r.expression, -1), 'm', regexp_extract_all(_norm, r.expression, 0))), z ->
  IF(size(z.m) = 0, CAST(array() AS array<{_HIT}>),
    aggregate(sequence(0, size(z.m) - 1), named_struct('at', 0, 'out', CAST(array() AS array<{_HIT}>)), (a, i) -> named_struct(
      'at', a.at + {_spaces("z.p[i]")} + {_spaces("z.m[i]")},
      'out', concat(a.out, array(named_struct('first', a.at + {_spaces("z.p[i]")}, 'far', -(a.at + {_spaces("z.p[i]")} + {_spaces("z.m[i]")}),
        'priority', r.priority, 'rule', r.rule, 'label', r.label, 'confidence', r.confidence, 'base', r.base)))), a -> a.out)))[0]"""

# Hits sorted by first word, then longest; `far` is minus the word after the last. ends[p]: how far priority p reached.
_KEPT = f"""
aggregate(_hits, named_struct('ends', array_repeat(-1, {{worst}} + 1), 'out', CAST(array() AS array<{_HIT}>)), (a, h) -> named_struct(
  'ends', transform(a.ends, (e, p) -> IF(p = h.priority, greatest(e, -h.far), e)),
  'out', IF(NOT h.base AND array_max(slice(a.ends, 1, h.priority + 1)) >= -h.far, a.out, concat(a.out, array(h)))), a -> a.out)"""


def scan(docs: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """Returns doc_id, n_words and detections, an array of the unsuppressed matches: first and last word, label, rule
    (its number), priority, confidence, base.

    Words are counted from 0 over the whole text, A-Z in lower case; a null text is an empty one without detections.
    Base rules are never suppressed. Only doc_id and text are read; repeated rows stay rows and a null doc_id stays
    null; an empty table stays empty.
    """
    rules = default_rules() if rules is None else rules
    norm = F.trim(F.regexp_replace(ascii_lower(F.coalesce("text", F.lit(""))), NO_WORD, " "))
    rows = docs.select("doc_id", F.when(norm == "", "").otherwise(F.concat(F.lit(" "), norm)).alias("_norm"))
    rows = rows.withColumn("n_words", (F.length("_norm") - F.length(F.replace("_norm", F.lit(" ")))).cast("bigint"))
    groups = F.filter(_rule_groups(rules), lambda g: F.contains(F.concat("_norm", F.lit(" ")), g["keyword"]))
    rows = rows.withColumn("_rules", F.flatten(F.transform(groups, lambda g: g["rules"])))
    rows = rows.withColumn("_hits", F.sort_array(F.flatten(F.expr(f"transform(_rules, r -> {_MATCHES})"))))
    kept = F.when(F.size("_hits") > 0, F.expr(_KEPT.format(worst=max((r.priority for r in rules), default=0)))).otherwise(F.expr(f"CAST(array() AS array<{_HIT}>)"))
    shown = lambda h: F.struct(h["first"].alias("first"), (-h["far"] - 1).alias("last"), h["label"].alias("label"), h["rule"].alias("rule"), h["priority"].alias("priority"), h["confidence"].alias("confidence"), h["base"].alias("base"))
    return rows.select("doc_id", "n_words", F.transform(kept, shown).alias("detections"))


def op2_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents")).withColumn("_base", F.filter("detections", lambda d: d["base"]))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda d: d["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("_base", lambda d: d["first"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("_base", lambda d: d["first"])).cast("bigint").alias("last_word"),
        labels("_base").alias("base_labels"),
        labels("detections").alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
    )
