r"""Benchmark decontamination by templates.

Numbers, units after numbers, and names within a sentence become typed placeholders; words are
lower-cased, punctuation goes. Every run of ``WINDOW`` template tokens of a benchmark item is a
window. Windows of documents are joined to them by hash, so a question whose numbers or names were
changed is met as well as a copy. Where matched windows hold placeholders, the values that fill them
must be consistent: along one alignment of an item and a document, an item's value must always
stand against the same value. Alignments that fail lose the windows with placeholders.

A document holds an item when it matches at least ``LEAST_COVERAGE`` of the item's windows, or ``RUN`` of its
tokens in a row, word for word, whatever the item's length: a question out of an item with a long passage. Template windows
with fewer than ``LEAST_WORDS`` real words are not used, nor are they part of such a row; an item shorter than a window is
one window.

With ``copies``, windows are joined in two more forms, whichever is met counting: the plain tokens with their
values, of any number of words, so that a copy is found whatever its numbers, names, case and white space; and
templates without names, for changed numbers in a copy whose case differs. Names are then met after white space
of any kind and length. Coverage is then the greatest of
the three: of template windows, of those without names, and, by plain tokens alone, of all windows. An item of
fewer than ``LEAST_WORDS`` tokens is held where it stands as a whole line or sentence, and nowhere else.

Only DataFrame functions are used. Documents are read once, for windows of all lengths; these meet the benchmark's in a
broadcast join while that table's counted size allows it, else in a shuffle by hash. Only documents
with matched placeholders are read again. Matches are grouped by document and item, never by item.

Defined results: null and empty texts hold nothing; texts of any length are read whole. Rows that repeat an id are one
document; rows without an id share the null id. Benchmark rows that repeat an item are one, of the least text; items of
fewer than ``LEAST_WORDS`` real words in a row are found as copies only. Of several places that a document holds an item
at, all count. Other columns are not read. Empty tables give an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import Workspace, small_side

WINDOW = 8
LEAST_WORDS = 5
LEAST_COVERAGE = 0.5
RUN = 13

# The length of a window that is a whole line or sentence, and where those are cut.
WHOLE = 0
_LINE, _SENTENCE = r"\s*\n\s*", r"(?<=[.!?;:])\s+"

# Marks before the value of a placeholder, and the sign that joins the parts of a number.
_NAME, _NUMBER, _UNIT, _JOIN = "\x01", "\x02", "\x03", "\x04"
_UNITS = ("mm cm dm m km in inch inches ft foot feet yd yard yards mile miles g kg mg t lb lbs oz ounce ounces pound "
          "pounds l ml cl litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours "
          "day days week weeks month months year years percent dollar dollars euro euros cent cents usd eur gbp "
          "kmh mph degree degrees w kw kwh v a j n pa hz khz mhz ghz b kb mb gb tb").split()


def marked(text: Column, any_space: bool = False) -> Column:
    """Tokens apart by single spaces, placeholders with their values: ``\\x02` 12 as `\\x0212``.

    With ``any_space``, names are met after white space of any kind and length, else after one space.
    """
    text = F.translate(F.coalesce(text, F.lit("")), _NAME + _NUMBER + _UNIT + _JOIN, "    ")
    text = F.regexp_replace(text, rf"(?<=[\p{{Ll}}\p{{N}},;]){r'[\s\p{Z}]+' if any_space else ' '}(?=\p{{Lu}}\p{{Ll}})", f" {_NAME}")
    numbers = F.regexp_replace(text, r"(?<=\p{N})[.,:/](?=\p{N})", _JOIN)
    numbers = F.regexp_replace(numbers, rf"(?<![\p{{L}}\p{{N}}{_JOIN}])\p{{N}}[\p{{N}}{_JOIN}]*", f"{_NUMBER}$0 ")
    text = F.when(text.rlike(r"\p{N}"), numbers).otherwise(text)
    text = F.trim(F.lower(F.regexp_replace(text, rf"[^\p{{L}}\p{{M}}\p{{N}}{_NAME}-{_JOIN}]+", " ")))
    units = F.regexp_replace(text, rf"(?<={_NUMBER}[\p{{N}}{_JOIN}]{{1,30}} )(?=(?:{'|'.join(_UNITS)})(?: |$))", _UNIT)
    return F.when(F.contains(text, F.lit(_NUMBER)), units).otherwise(text)


def template(marked_text: Column) -> Column:
    """Marked tokens without the values of placeholders."""
    return F.when(marked_text.rlike(f"[{_NAME}-{_UNIT}]"),
                  F.regexp_replace(marked_text, rf"([{_NAME}-{_UNIT}])\S+", "$1")).otherwise(marked_text)


def plain(marked_text: Column) -> Column:
    """Marked tokens as they stand in the text, in lower case."""
    return F.translate(marked_text, _NAME + _NUMBER + _UNIT, "")


def nameless(marked_text: Column) -> Column:
    """Templates in which names are words."""
    return template(F.translate(marked_text, _NAME, ""))


def simple(text: Column) -> Column:
    """Letters and digits in lower case, apart by single spaces."""
    return F.trim(F.lower(F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}]+", " ")))


def _short_parts(text: Column) -> Column:
    """Hashes of the lines and sentences of fewer than ``LEAST_WORDS`` tokens."""
    parts = F.transform(F.concat(*(F.split(text, cut) for cut in (_LINE, _SENTENCE, f"{_SENTENCE}|{_LINE}"))), simple)
    parts = F.array_distinct(F.filter(parts, lambda x: (x != "") & (F.size(F.split(x, " ")) < LEAST_WORDS)))
    return F.transform(parts, lambda x: F.xxhash64(x))


def _tokens(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def _windows(tokens: Column, length: Column | int) -> Column:
    """Hashes of all runs of ``length`` tokens, in order."""
    length = F.lit(length) if isinstance(length, int) else length
    return F.when(F.size(tokens) < length, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(tokens) - length + 1), lambda i: F.xxhash64(F.slice(tokens, i, length))))


def benchmark_windows(benchmark: DataFrame, work: Workspace, item_id: str = "item_id", text: str = "text",
                      window: int = WINDOW, copies: bool = False) -> tuple[DataFrame, DataFrame]:
    """The items (item_id, values, numbers of windows) and their windows (hash, length, item_id, at, slots, flags).

    ``templated`` and ``unnamed`` say whether the item's window at that place is usable as a template, with and
    without names. Plain windows have no slots.
    """
    shown = benchmark.groupBy(F.col(f"`{item_id}`").alias("item_id")).agg(F.min(f"`{text}`").alias("text"))
    items = shown.select("item_id", marked(F.col("text"), copies).alias("m"), simple(F.col("text")).alias("simple"))
    items = items.select("item_id", "simple", _tokens(F.col("m")).alias("values"), _tokens(template(F.col("m"))).alias("tokens"),
                         _tokens(nameless(F.col("m"))).alias("words"), _tokens(plain(F.col("m"))).alias("plain"))
    items = work.save(items.where(F.size("tokens") > 0).withColumn(
        "length", F.least(F.size("tokens"), F.lit(window))).withColumn(
        "short", F.lit(copies) & (F.size(F.split("simple", " ")) < LEAST_WORDS)), "items")

    def slots(tokens: str) -> Column:
        return F.size(F.filter(F.slice(tokens, F.col("at") + 1, F.col("length")), lambda x: x.rlike(f"^[{_NAME}-{_UNIT}]$")))

    hashes = F.arrays_zip(*(_windows(F.col(x), F.col("length")).alias(x) for x in ("tokens", "words", "plain")))
    held = items.where("NOT short").select("item_id", "length", "tokens", "words", F.posexplode(hashes).alias("at", "hashes"))
    held = held.select("item_id", "length", "at", "hashes", slots("tokens").alias("named"), slots("words").alias("numbered"))
    held = held.withColumns({"templated": F.col("length") - F.col("named") >= LEAST_WORDS,
                             "unnamed": F.lit(copies) & (F.col("length") - F.col("numbered") >= LEAST_WORDS)})
    forms = [F.when(F.col("templated"), F.struct(F.col("hashes.tokens").alias("hash"), F.col("named").alias("slots")))]
    if copies:
        forms += [F.when(F.col("unnamed"), F.struct(F.col("hashes.words").alias("hash"), F.col("numbered").alias("slots"))),
                  F.struct(F.col("hashes.plain").alias("hash"), F.lit(0).alias("slots"))]
    # Forms that are equal are one.
    whole = items.where("short").select(F.xxhash64("simple").alias("hash"), F.lit(WHOLE).alias("length"), "item_id", F.lit(0).alias("at"),
                                        F.lit(0).alias("slots"), F.lit(False).alias("templated"), F.lit(False).alias("unnamed"))
    windows = work.save(held.select("length", "item_id", "at", "templated", "unnamed", F.explode(
        F.array_distinct(F.array_compact(F.array(*forms)))).alias("form")).select(
        "form.hash", "length", "item_id", "at", "form.slots", "templated", "unnamed").unionByName(whole), "windows")
    counts = windows.groupBy("item_id").agg(
        F.count_distinct("at").alias("windows"), F.count_distinct(F.when(F.col("templated"), F.col("at"))).alias("templates"),
        F.count_distinct(F.when(F.col("unnamed"), F.col("at"))).alias("nameless"))
    return work.save(items.select("item_id", "values").join(counts, "item_id"), "item_values"), windows


def contaminated(docs: DataFrame, benchmark: DataFrame, work: Workspace, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", window: int = WINDOW, least: float = LEAST_COVERAGE,
                 copies: bool = False) -> DataFrame:
    """Pairs of documents and items they hold: doc_id, item_id, n_windows, coverage, changed, run.

    ``run`` is the greatest number of tokens in a row that stand as in the item, 0 if less than a window.
    ``changed`` says that some number, unit or name differs from the item's. ``copies`` finds exact copies of
    any item too, in any case and white space.
    """
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    items, windows = benchmark_windows(benchmark, work, item_id, "text", window, copies)
    # At most ``window`` rows and one more.
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())
    texts = docs.where("text IS NOT NULL").select("doc_id", marked(F.col("text"), copies).alias("m"), *(
        [_short_parts(F.col("text")).alias("parts")] if WHOLE in lengths else []))
    parts = [F.col("parts").alias("parts")] if WHOLE in lengths else []
    no_parts = [F.array().cast("array<long>").alias("parts")] if WHOLE in lengths else []
    forms = [F.struct(template(F.col("m")).alias("form"), *parts)]
    if copies:
        # Other forms only where they differ; a template without placeholders is plain, so that forms need no kind.
        named, numbered = F.contains("m", F.lit(_NAME)), F.contains("m", F.lit(_NUMBER))
        forms.append(F.when(named | numbered, F.struct(plain(F.col("m")).alias("form"), *no_parts)))
        if not windows.where("slots > 0 AND unnamed").isEmpty():
            forms.append(F.when(named & numbered, F.struct(nameless(F.col("m")).alias("form"), *no_parts)))
    tokens = texts.select("doc_id", F.inline(F.array_compact(F.array(*forms)))).withColumn("tokens", _tokens(F.col("form")))

    def hashed(length: int) -> Column:
        hashes = F.col("parts") if length == WHOLE else _windows(F.col("tokens"), length)
        return F.transform(hashes, lambda x, i: F.struct(F.lit(length).alias("length"), i.alias("place"), x.alias("hash")))

    none = F.array().cast("array<struct<length:int,place:int,hash:bigint>>")
    rows = tokens.select("doc_id", F.inline(F.concat(*(hashed(n) for n in lengths)) if lengths else none))
    matches = work.save(rows.join(small_side(windows), ["hash", "length"]).select(
        "doc_id", "item_id", "place", "at", "length", "slots", "templated", "unnamed"), "matches")

    key = ["doc_id", "item_id", "shift"]
    shifted = matches.withColumn("shift", F.col("place") - F.col("at"))
    holding = shifted.where("slots > 0")
    again = small_side(work.save(holding.select("doc_id").distinct(), "again"))
    values = (docs.join(again, docs.doc_id.eqNullSafe(again.doc_id), "left_semi")
              .select("doc_id", _tokens(marked(F.col("text"), copies)).alias("found")))
    # Each slot of an alignment once: neighbouring windows overlap.
    places = (holding.select(*key, F.explode(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)).alias("slot")).distinct())
    filled = (places.join(values, places.doc_id.eqNullSafe(values.doc_id)).drop(values.doc_id)
              .join(items.select("item_id", "values"), "item_id")
              .select(*key, F.get("values", F.col("slot")).alias("asked"),
                      F.get("found", F.col("slot") + F.col("shift")).alias("given")))
    mark = F.substring("asked", 1, 1)
    filled = work.save(filled.where(mark.between(_NAME, _UNIT) & (F.substring("given", 1, 1) == mark)).distinct(), "filled")
    wrong = filled.groupBy(*key, "asked").count().where("count > 1").select(*key).distinct()
    other = filled.where("asked <> given").select("doc_id", "item_id").distinct()

    def same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
        out = a.doc_id.eqNullSafe(b.doc_id)
        for name in names:
            out = out & (a[name] == b[name])
        return out

    columns = ["doc_id", "item_id", "at", "templated", "unnamed"]
    sound = shifted.where("slots = 0").select(*columns, F.lit(True).alias("literal")).unionByName(
        holding.join(wrong, same(holding, wrong, ["item_id", "shift"]), "left_anti").select(*columns, F.lit(False).alias("literal")))
    held = (sound.groupBy(*columns).agg(F.max("literal").alias("literal"))
            .groupBy("doc_id", "item_id").agg(F.count("*").alias("n_windows"), F.count_if("templated").alias("t"),
                                              F.count_if("unnamed").alias("u"), F.count_if("literal").alias("l"))
            .join(items.select("item_id", "windows", "templates", "nameless"), "item_id"))
    # Windows word for word that follow each other; an alignment has no more of them than the item.
    after = F.aggregate(
        F.array_sort(F.col("ats")), F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n"), F.lit(0).alias("most")),
        lambda a, x: F.struct(x.alias("last"), F.when(x == a["last"] + 1, a["n"] + 1).otherwise(1).alias("n"),
                              F.greatest(a["most"], F.when(x == a["last"] + 1, a["n"] + 1).otherwise(1)).alias("most")),
        lambda a: a["most"])
    runs = (shifted.where("slots = 0 AND (templated OR unnamed)").groupBy(*key, "length")
            .agg(F.collect_set("at").alias("ats")).groupBy("doc_id", "item_id")
            .agg(F.max(after + F.col("length") - 1).alias("run")))
    held = held.join(runs, same(held, runs, ["item_id"]), "left").select(
        *(held[c] for c in held.columns), F.coalesce("run", F.lit(0)).alias("run"))
    shares = F.greatest(F.try_divide("t", "templates"), F.try_divide("u", "nameless"), F.col("l") / F.col("windows"))
    held = held.withColumn("coverage", shares).where((F.col("coverage") >= least) | (F.col("run") >= RUN))
    marked_other = other.withColumn("changed", F.lit(True))
    return (held.join(marked_other, same(held, marked_other, ["item_id"]), "left")
            .select(held.doc_id, held.item_id, "n_windows", "coverage", F.coalesce("changed", F.lit(False)).alias("changed"), "run"))
