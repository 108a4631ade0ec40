r"""Licence scan by sentence rules.

A text is cut into sentences, sentences are normalised, and known ones are mapped to identifiers of
licence sentences. Wordings that mean the same, and the names of holders and organisations, are first
brought to one form. A document becomes the sequence of its known sentences, unknown ones counting as
gaps. A rule is an ordered list of sentences; it holds where they follow each other with at most ``GAP``
unknown sentences between two. A sentence that begins like BSD's third clause is never a gap.

A sentence that is not known may hold notices ("Foo is released under the terms of ...", SPDX lines): after
the verb, the longest known name decides, whatever follows. Names joined by "or", "and" and "with" are
notices each; GNU licences may be narrowed by "only" or widened by "or later". A verb that is denied
("not licensed under") is none, and a name of one word must end the sentence or stand before a joining word.

Licence texts wrap their lines and notices often stand on a line of their own, so sentences are cut
twice: at line ends too, and at sentence ends and blank lines only. A rule holds if it does in either sequence.

Only DataFrame functions are used, within the row: nothing is shuffled. Sentences are looked up only
if they hold a cue that every known sentence has; the tables are constants.

Defined results: null and empty texts have no licences, and an empty table gives an empty one; texts of any
length are scanned whole. Every row comes back once, with its columns, rows that repeat too; ``licences``
(sorted, distinct), ``rules`` (in the order of the table) and ``known`` (sentences recognised and names in
notices, at line ends too) replace columns of those names. The texts of CC 3.0 and of licences outside the
tables are met through notices or not at all.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.licence_rules import NAMES, RULES, SENTENCES, VARIANTS, VERSIONED, WORDINGS

GAP = 3

# Where sentences are cut; the colon after a label such as SPDX-License-Identifier is no end,
# nor is the stop of "v. 2.0" or of an organisation's name before "nor the names of".
_STOP = r"(?<=[.!?;:])(?<!(?i:identifier):)(?<!(?i:licen[cs]e):)(?<! v\.)\s+(?!\s|(?i:nor the ))"
AT_ENDS = _STOP + r"|\s*\n[ \t\r]*\n\s*"
AT_LINES = _STOP + r"|\s*\n\s*"

CUE = (r"(?i)licen[cs]|warrant|copyright|liab|redistribut|permi(?:t|ss)|free software|public domain|rights reserved"
       r"|(?:released|distributed|available|published|provided|covered|governed) (?:under|by)|anyone is free|mpl|unencumbered"
       r"|advertising materials|neighboring rights|neither the name")

# An unknown sentence that begins like this is no gap.
BARRIER = "neither the name"

# A plus after a version means later ones.
_PLUS = r"(?<=[0-9])\+(?![^\s).,;/])"
LATER = r" or (?:at your option )?(?:any )?(?:later|newer)(?: versions?)?"


def plain_text(text: str) -> str:
    """The normal form of a sentence, as `_normalised` makes it of columns."""
    text = re.sub(r"[^a-z0-9]+", " ", re.sub(_PLUS, " or later ", text.lower())).strip()
    for pattern, other in VARIANTS:
        text = re.sub(pattern, other, text)
    return text


def _known() -> dict[str, str]:
    """Normalised sentences with their identifiers."""
    table = {}
    for name, sentence in SENTENCES.items():
        for wording in [sentence, *WORDINGS.get(name, [])]:
            table.setdefault(plain_text(wording), name)
    return table


def _notices() -> dict[str, str]:
    """Normalised names of licences with the identifiers of notices."""
    table = {}
    for licence, names in NAMES.items():
        for name in map(plain_text, names):
            for said in (name, f"{name.removesuffix(' license')} license"):
                table.setdefault(said, f"notice-{licence.lower()}")
    return table


KNOWN, NOTICES = _known(), _notices()
_WIDE = {f"notice-{x.lower()}" for x in VERSIONED}
VERSIONS = {f"{name} {kind}": f"{notice}-{kind.replace(' ', '-')}" for name, notice in NOTICES.items()
            if notice in _WIDE for kind in ("only", "or later")}
SAID = {**NOTICES, **VERSIONS}


def _any(names: list[str]) -> str:
    return "|".join(sorted(names, key=lambda x: (-len(x), x)))


_JOINED = r"(?:or|and|with)"
# One name, the longest; a single word must end the sentence or stand before one of a few words.
NAME = (rf"(?:(?:{_any([n for n, x in NOTICES.items() if x in _WIDE])})(?: only|{LATER})?"
        rf"|(?:{_any([n for n, x in NOTICES.items() if x not in _WIDE and ' ' in n])})"
        rf"|(?:{_any([n for n in NOTICES if ' ' not in n])})(?= (?:{_JOINED}|see|as|in|at|for|which|copyright|c|please|by|unless|except|if"
        r"|to|you|apache|bsd|gpl|lgpl|mpl)(?![^ ])|$))(?![^ ])(?! [0-9]{1,2}(?![^ ]))")
NOTICE = (r"(?:(?<![^ ])(?<!not )(?<!not be )(?<!never )(?<!formerly )(?<!previously )"
          r"(?:licensed|released|distributed|redistributed|available|published|provided|covered|governed|shared) (?:under|by) "
          r"(?:either (?:of )?)?(?:the |an? )?(?:terms (?:and conditions )?of )?(?:either (?:of )?)?(?:the |an? )?"
          r"|(?<![^ ])spdx license identifier |^license (?:is )?(?:the )?)"
          rf"({NAME}(?: (?:{_JOINED} )?(?:the )?{NAME})*)")

# Short codes of identifiers, so that rules are patterns over codes.
CODES = {name: f"s{i}" for i, name in enumerate(sorted({*KNOWN.values(), *SAID.values()}))}


def _pattern(sentences: list[str]) -> str:
    """A rule over a sequence like `` . s3 . s4 ``; equal sentences share the identifier met first."""
    own = [CODES[KNOWN.get(plain_text(SENTENCES[x]), x) if x in SENTENCES else x] for x in sentences]
    return f"(?: \\.){{0,{GAP}}}".join(f" {code}" for code in own) + "(?![^ ])"


PATTERNS = [(licence, "+".join(sentences), _pattern(sentences)) for licence, sentences in RULES]


def _normalised(sentence: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(sentence), _PLUS, " or later "), "[^a-z0-9]+", " ")
    plain = F.trim(plain)
    for pattern, other in VARIANTS:
        plain = F.regexp_replace(plain, pattern, other)
    return plain


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for key, name in table.items() for x in (key, CODES[name])))


def _sequence(text: Column, cut: str) -> Column:
    known, said = _map(KNOWN), _map(SAID)

    def notices(plain: Column) -> Column:
        names = F.flatten(F.transform(F.regexp_extract_all(plain, F.lit(NOTICE), F.lit(1)),
                                      lambda chain: F.regexp_extract_all(chain, F.lit(f"({NAME})"), F.lit(1))))
        return F.array_join(F.transform(names, lambda x: F.try_element_at(said, F.regexp_replace(x, f"{LATER}$", " or later"))), " ")

    # One step after the other, so that no sentence is normalised twice.
    plain = F.transform(F.split(text, cut), lambda x: F.when(x.rlike(CUE), _normalised(x)))
    codes = F.transform(plain, lambda x: F.coalesce(
        F.try_element_at(known, x), F.when(x.startswith(BARRIER), F.lit("!")).otherwise(notices(x))))
    codes = F.transform(codes, lambda x: F.when(F.length(x) > 0, x).otherwise("."))
    return F.concat(F.lit(" "), F.array_join(codes, " "))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add licences, rules and known to every document."""
    names = [c for c in docs.columns if c not in ("licences", "rules", "known")]
    cued = F.when(F.col(f"`{text}`").rlike(CUE), F.col(f"`{text}`"))
    lines, whole = _sequence(cued, AT_LINES), _sequence(cued, AT_ENDS)
    none = F.lit(" .")
    held = docs.select(*(F.col(f"`{c}`") for c in names), F.coalesce(lines, none).alias("_lines"), F.coalesce(whole, none).alias("_whole"))
    # Most sequences hold no known sentence, and no rule is tried on them.
    some = F.col("_lines").contains("s") | F.col("_whole").contains("s")
    tried = F.array(*(F.when(F.col("_lines").rlike(p) | F.col("_whole").rlike(p), F.struct(
        F.lit(licence).alias("licence"), F.lit(rule).alias("rule"))) for licence, rule, p in PATTERNS))
    found = F.when(some, F.array_compact(tried))
    none_found = F.array().cast("array<string>")
    held = held.withColumn("_found", found)
    return held.select(
        *(F.col(f"`{c}`") for c in names),
        F.coalesce(F.array_sort(F.array_distinct(F.transform("_found", lambda x: x.licence))), none_found).alias("licences"),
        F.coalesce(F.transform("_found", lambda x: x.rule), none_found).alias("rules"),
        F.size(F.filter(F.split("_lines", " "), lambda x: x.startswith("s"))).cast("long").alias("known"))
