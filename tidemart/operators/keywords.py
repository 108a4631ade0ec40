"""Search keywords: words of a text, dictionary words in a text, counts per window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import scalars
from tidemart.operators import joins

# Fixed value: what separates words, everything that is neither letter nor digit.
SEPARATORS = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda w: w != "")


def keyword_split(rows: DataFrame, text: str, word: str = "word") -> DataFrame:
    """One row per word of ``text``."""
    others = [c for c in rows.columns if c != text]
    return rows.select(*others, F.explode(words_of(F.col(text))).alias(word))


def longest_word(dictionary: DataFrame) -> int:
    """Characters of the longest dictionary word; 0 without a word."""
    return dictionary.agg(F.max(F.length("word"))).first()[0] or 0


def _windows(text: Column, longest: int) -> Column:
    """For each character position the text from there on, ``longest`` characters at most.

    The characters are taken apart once per text, so the work grows with its length only.
    """
    def cut(chars: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(chars)),
            lambda p: F.array_join(F.slice(chars, p, F.lit(max(longest, 1))), ""))

    return F.when(F.length(text) > 0, F.transform(F.array(F.split(text, "")), cut)[0])


def dictionary_heads(vocabulary: DataFrame) -> DataFrame:
    """First two characters of the words of ``_word`` (or the only one), with the lengths that such words have."""
    return vocabulary.groupBy(F.substring("_word", 1, 2).alias("_head")).agg(
        F.array_sort(F.collect_set(F.length("_word"))).alias("_sizes"))


def starts_of(rows: DataFrame, text: str, longest: int) -> DataFrame:
    """At most two rows per character of ``text``: its ``position``, the text from there on, and what a
    word that starts there begins with."""
    others = [c for c in rows.columns if c != text]
    windows = rows.select(*others, F.posexplode(_windows(F.lower(text), longest)).alias("_at", "_window"))
    heads = F.array_distinct(F.array(F.substring("_window", 1, 1), F.substring("_window", 1, 2)))
    return windows.select(*others, (F.col("_at") + 1).alias("position"), "_window", F.explode(heads).alias("_start"))


def keyword_dictionary_match(rows: DataFrame, text: str, dictionary: DataFrame,
                             word: str = "word") -> DataFrame:
    """One row per occurrence of a dictionary word in ``text``, with its position from 1.

    All words are found, also those inside or across others. A two-level index of the dictionary
    says which lengths words have that begin with two given characters, so that each position
    probes words of those lengths only. Probes go row by row; only a dictionary of checked size is
    broadcast. It is read four times: pass a stored one.
    """
    longest = longest_word(dictionary)
    others = [c for c in rows.columns if c != text]
    # The word leaves as an expression: if the dictionary is too large for a broadcast, both
    # sides are shuffled for the join, and adaptive execution splits a hot word.
    vocabulary = dictionary.select(F.lower("word").alias("_key")).where("_key <> ''").distinct().select(
        F.concat("_key", F.lit("")).alias("_word"))
    heads = joins.checked_broadcast(dictionary_heads(vocabulary).select(F.concat("_head", F.lit("")).alias("_head"), "_sizes"))
    starts = starts_of(rows, text, longest).join(heads, F.col("_start") == F.col("_head"), "inner")
    # A word of one character has a head of its own; a longer one is found by its first two.
    sizes = F.filter("_sizes", lambda n: (n <= F.length("_window")) & ((n > 1) | (F.length("_start") == 1)))
    candidates = starts.select(*others, "position", "_window", F.explode(sizes).alias("_size")).select(
        *others, "position", F.col("_window").substr(F.lit(1), F.col("_size")).alias(word))
    side = joins.checked_broadcast(vocabulary)
    return candidates.join(side, F.col(word) == F.col("_word"), "inner").drop("_word")


# Runs of Han characters, and runs of other letters and digits.
HAN_RUN = r"\p{IsHan}+"
SEGMENT = r"\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+"


def cover(text: Column, hits: Column) -> Column:
    """The words of a run: the hits (``position``, ``word``), and each character that no hit covers."""
    def alone(at: Column) -> Column:
        return ~F.exists(hits, lambda h: (h.position <= at) & (at < h.position + F.length(h.word)))

    places = F.filter(F.sequence(F.lit(1), F.length(text)), alone)
    return F.concat(F.transform(hits, lambda h: h.word), F.transform(places, lambda p: text.substr(p, F.lit(1))))


def keyword_finest(rows: DataFrame, text: str, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """Finest-grained words of ``text``.

    A run of other letters and digits is one word. A run of Han characters gives every
    dictionary word in it, and each character that no dictionary word covers. Every different run is
    looked up once; what it is made of then follows from its hits by array functions.
    """
    others = [c for c in rows.columns if c != text]
    runs = rows.select(*others, F.explode(F.regexp_extract_all(F.lower(text), F.lit(SEGMENT), F.lit(0))).alias("_text"))
    is_han = F.col("_text").rlike(HAN_RUN)
    han = runs.where(is_han)
    each = han.select("_text").distinct()
    found = keyword_dictionary_match(each.withColumn("_run", F.col("_text")), "_text", dictionary, word)
    hits = found.groupBy("_run").agg(F.array_sort(F.collect_list(F.struct("position", F.col(word).alias("word")))).alias("_hits"))
    none = F.array().cast("array<struct<position:int,word:string>>")
    known = each.join(hits, F.col("_text") == F.col("_run"), "left").select(
        F.concat("_text", F.lit("")).alias("_known"), cover(F.col("_text"), F.coalesce("_hits", none)).alias("_words"))
    fine = han.join(known, F.col("_text") == F.col("_known")).select(*others, F.explode("_words").alias(word))
    return runs.where(~is_han).select(*others, F.col("_text").alias(word)).unionByName(fine)


def keyword_tumbling_count(words: DataFrame, time: str = "rt", word: str = "word",
                           width: str = "10 seconds") -> DataFrame:
    """Occurrences per word and window; partial counts are made before the shuffle."""
    return words.groupBy(F.window(time, width).alias("window"), word).agg(
        F.count("*").alias("keyword_count")
    ).select(*scalars.window_bounds(F.col("window")), F.col(word).alias("keyword"), "keyword_count")
