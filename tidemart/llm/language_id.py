"""Language identification by Bayesian fusion of evidence.

For each row the log chances of every language are added up from

* its text: byte trigrams under a model per language, as much as ``TEXT_WEIGHT`` trigrams at most,
  since neighbouring trigrams are far from independent;
* the language that its markup declares, by how often rows of each language declare it;
* the suffix of its address, likewise;
* its host: the languages met there before the row's own text is heard. Hosts are smoothed towards
  their domain, domains towards all rows, so a host of few rows says little by itself.

The last three are learned from all rows at once: the texts' own posteriors are summed by declared
language, suffix, domain and host in grouped aggregations, which sum up in each task first. Rows
travel without their texts. The trigram models are counted over all rows given to ``train``, in tables
of a fixed size for each language. Languages are all labels met that are language tags: two or three
letters, whatever their case, with or without a region (``pt-BR`` is ``pt``), so there are 18,252 at most. A
language of few rows is smoothed: each model counts ``BACKGROUND`` trigrams of all languages' mixture as its
own. Where no label is met, all of ``LANGUAGES`` have even models. Who wants to know how well labels are met
trains on a share of the rows (``training_share``) and looks at the others.

A text must also fit some language: its mean log likelihood a trigram must reach that language's floor,
which is taken from the labelled rows (their median less ``SPREADS`` times its distance to the twentieth
part, less an allowance for short texts). A text that fits none is in a language not learned, or in none:
it says nothing of its host, address or markup, and is not kept. Short texts of a foreign language, and
those of one much like a learned one, may still fit.

Defined results: evidence that is null or blank is left out. A null or empty text, or one without
letters, has no language and is not kept; nor is a row whose best language has less than
``LEAST_POSTERIOR``, or whose text fits no language (the nearest is named). Ties go to the language named first. Repeated rows get equal results. Columns
named in ``key`` come back; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import Workspace, small_side

LANGUAGES = ("en", "de", "fr", "es")
TEXT_WEIGHT = 60.0
LEAST_POSTERIOR = 0.5
# Trigrams of all languages together that each language's model counts as its own.
BACKGROUND = 2_000.0
# One row in so many, by the hash of its key, is left out of a training share.
HELD_OUT = 5
SPREADS = 3.0
LEAST_SPREAD = 0.2
# Allowance in a text of n trigrams: SHORT / sqrt(n).
SHORT = 8.0
# Rows that a domain's (host's) parent counts for.
SMOOTHING = 20.0
_BUCKETS = 1 << 15
_CHUNK = 4_000_000

# ASCII letters in lower case; bytes of other letters as they are; all else is a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _trigrams(data: np.ndarray) -> np.ndarray:
    """A bucket for each byte trigram."""
    x = _FOLD[data].astype(np.uint32)
    codes = x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16)
    return ((codes * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int32)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after another, and their offsets."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), offsets


class TrigramModels:
    def __init__(self, counts: np.ndarray, languages: Sequence[str] = LANGUAGES, floors: Sequence[float] | None = None):
        together = counts.sum(axis=0)
        smooth = counts + 0.5 + BACKGROUND * together / max(together.sum(), 1.0)
        self.logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
        self.languages = tuple(languages)
        self.floors = np.full(len(self.logs), -np.inf) if floors is None else np.array(floors)

    def _sums(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, int, bool]]:
        """For each text the log likelihoods by language, its trigrams, and whether it has letters."""
        data, offsets = _bytes(texts)
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            sums, n, letters = np.zeros(len(self.logs)), 0, False
            # Pieces overlap by two bytes, so that no trigram is lost between them.
            for at in range(start, end, _CHUNK):
                piece = data[at:min(at + _CHUNK + 2, end)]
                letters = letters or bool((_FOLD[piece] != 32).any())
                if piece.size >= 3:
                    codes = _trigrams(piece)
                    n += codes.size
                    sums += [log[codes].sum(dtype=np.float64) for log in self.logs]
            yield sums, n, letters

    def evidence(self, texts: pa.Array) -> tuple[list[list[float] | None], list[bool]]:
        """Weighted log likelihoods by language, the best being 0, None without letters; and whether any fits."""
        out: list[list[float] | None] = []
        fits: list[bool] = []
        for sums, n, letters in self._sums(texts):
            fits.append(n == 0 or bool((sums / n >= self.floors - SHORT / np.sqrt(n)).any()))
            weighted = sums / max(n, 1) * min(n, TEXT_WEIGHT)
            out.append((weighted - weighted.max()).tolist() if letters else None)
        return out, fits

    def likelihoods(self, texts: pa.Array) -> list[list[float] | None]:
        return self.evidence(texts)[0]

    def means(self, texts: pa.Array) -> list[np.ndarray | None]:
        """Mean log likelihoods a trigram by language, of texts long enough to tell."""
        return [sums / n if letters and n >= TEXT_WEIGHT else None for sums, n, letters in self._sums(texts)]


def language_tag(label: Column) -> Column:
    """The language of a label, in lower case; null where it names none."""
    return F.nullif(F.lower(F.regexp_extract(label, r"^\s*([A-Za-z]{2,3})(?:[-_][A-Za-z0-9_-]*)?\s*$", 1)), F.lit(""))


def training_share(*key: str) -> Column:
    """Whether a row is one to train on: four of five, by the hash of its key."""
    return F.pmod(F.xxhash64(*key), F.lit(HELD_OUT)) != 0


def _languages(samples: DataFrame, language: str) -> tuple[str, ...]:
    """Languages met, those of ``LANGUAGES`` first."""
    met = samples.select(language_tag(F.col(language)).alias("label")).where("label IS NOT NULL").distinct()
    # At most a row per tag of two or three letters.
    labels = {r.label for r in met.collect()}
    return (*(x for x in LANGUAGES if x in labels), *sorted(labels - set(LANGUAGES))) or LANGUAGES


def _floors(samples: DataFrame, models: TrigramModels, text: str, language: str) -> list[float]:
    """The least mean log likelihood of each language's texts; none where no labelled text is long enough."""
    places = {name: i for i, name in enumerate(models.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = [places.get(x) for x in batch.column(1).to_pylist()]
            found = [(i, float(m[i])) for i, m in zip(labels, models.means(batch.column(0)), strict=True)
                     if i is not None and m is not None]
            yield pa.record_batch([pa.array([i for i, _ in found], pa.int32()), pa.array([m for _, m in found], pa.float64())],
                                  names=["language", "mean"])

    floors = [-np.inf] * len(places)
    means = samples.select(text, language_tag(F.col(language))).mapInArrow(run, "language int, mean double")
    for row in means.groupBy("language").agg(F.percentile_approx("mean", [0.05, 0.5], 1000).alias("p")).collect():
        low, middle = row.p
        floors[row.language] = middle - SPREADS * max(middle - low, LEAST_SPREAD)
    # A language without texts long enough is held to the loosest floor of the others.
    known = [x for x in floors if np.isfinite(x)]
    return [x if np.isfinite(x) or not known else min(known) for x in floors]


def train(samples: DataFrame, languages: Sequence[str] | None = None, text: str = "text",
          language: str = "lang") -> TrigramModels:
    """Count trigrams of all samples by their labels; rows of other ``languages``, if given, are not used."""
    languages = _languages(samples, language) if languages is None else tuple(languages)
    places = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tables of the languages that this task meets.
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(1).to_pylist()
            data, offsets = _bytes(batch.column(0))
            for label, start, end in zip(labels, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                if label in places:
                    if label not in totals:
                        totals[label] = np.zeros(_BUCKETS, np.int64)
                    total = totals[label]
                    for at in range(start, end, _CHUNK):
                        piece = data[at:min(at + _CHUNK + 2, end)]
                        if piece.size >= 3:
                            codes = _trigrams(piece)
                            if codes.size > _BUCKETS // 4:
                                total += np.bincount(codes, minlength=_BUCKETS)
                            else:
                                np.add.at(total, codes, 1)
        for label, total in totals.items():
            bucket = np.flatnonzero(total)
            yield pa.record_batch([np.full(bucket.size, places[label], np.int32), bucket.astype(np.int32), total[bucket]],
                                  names=["language", "bucket", "n"])

    counted = samples.select(text, language_tag(F.col(language))).mapInArrow(run, "language int, bucket int, n long")
    totals = np.zeros((len(places), _BUCKETS))
    # At most a row per language and bucket.
    for row in counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).collect():
        totals[row.language, row.bucket] = row.n
    models = TrigramModels(totals, languages)
    return TrigramModels(totals, languages, _floors(samples, models, text, language))


def markup_language(html: Column) -> Column:
    """The language that a page's root element declares, two or three letters in lower case."""
    found = F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})\b""", 1))
    return F.nullif(found, F.lit(""))


def markup_text(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


def address_parts(url: Column) -> dict[str, Column]:
    """The host of an address, its domain (last two names) and suffix (the last name)."""
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))
    return {"host": host, "domain": F.substring_index(host, ".", -2), "suffix": F.substring_index(host, ".", -1)}


def _sums(size: int) -> list[Column]:
    return [F.sum(F.col("chance")[i]).alias(f"s{i}") for i in range(size)]


def _array(size: int) -> Column:
    return F.array(*(F.col(f"s{i}") for i in range(size)))


def _smoothed(table: DataFrame, parent: Column, size: int) -> Column:
    total = sum((F.col(f"s{i}") for i in range(1, size)), F.col("s0"))
    return F.zip_with(_array(size), parent, lambda s, p: (s + SMOOTHING * p) / (total + SMOOTHING))


def identify(rows: DataFrame, models: TrigramModels, work: Workspace, key: Sequence[str] = ("doc_id",),
             languages: Sequence[str] | None = None) -> DataFrame:
    """``key`` columns with language, posterior, text_language and kept, for every row.

    ``rows`` hold text, declared, suffix, domain and host (null where there is none).
    """
    languages = models.languages if languages is None else languages
    size = len(languages)
    evidence = ["declared", "suffix", "domain", "host"]
    own = [f"key{i}" for i in range(len(key))]

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                likely, fits = models.evidence(part.column("text"))
                yield (part.drop_columns(["text"]).append_column("likely", pa.array(likely, pa.list_(pa.float64())))
                       .append_column("fits", pa.array(fits, pa.bool_())))

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    plain = rows.select("text", *(F.col(f"`{k}`").alias(o) for k, o in zip(key, own, strict=True)),
                        *(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias(c) for c in evidence))
    schema = ", ".join([*(f"{o} {kinds[k]}" for k, o in zip(key, own, strict=True)),
                        *(f"{c} string" for c in evidence), "likely array<double>", "fits boolean"])
    weights = F.transform("likely", lambda x: F.exp(x))
    scored = work.save(plain.mapInArrow(run, schema).withColumn("chance", F.when(F.col("fits"), F.transform(
        weights, lambda x: x / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)))), "scored")

    # All rows: one row of numbers, smoothed so that no language is ruled out.
    total = scored.where("chance IS NOT NULL").groupBy().agg(*_sums(size)).first()
    counts = np.array([x or 0.0 for x in total]) + 1.0
    overall = F.array(*(F.lit(float(x)) for x in counts / counts.sum()))

    def given_language(column: str) -> DataFrame:
        """Log chances of each value of a column, given each language."""
        met = work.save(scored.where(f"{column} IS NOT NULL AND chance IS NOT NULL").groupBy(column)
                        .agg(*_sums(size)), f"by_{column}")
        sums = met.groupBy().agg(F.count("*").alias("values"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(size))).first()
        logs = [F.log((F.col(f"s{i}") + 0.5) / F.lit((sums[f"s{i}"] or 0.0) + 0.5 * sums["values"])) for i in range(size)]
        return work.save(met.select(column, F.array(*logs).alias(f"{column}_log")), f"given_{column}")

    domains = work.save(scored.where("domain IS NOT NULL AND chance IS NOT NULL").groupBy("domain").agg(*_sums(size)),
                        "by_domain")
    domains = work.save(domains.select("domain", _smoothed(domains, overall, size).alias("domain_prior")), "domains")
    hosts = work.save(scored.where("host IS NOT NULL AND chance IS NOT NULL").groupBy("host", "domain")
                      .agg(*_sums(size)), "by_host")
    hosts = hosts.join(small_side(domains), "domain", "left")
    hosts = work.save(hosts.groupBy("host").agg(
        *(F.sum(f"s{i}").alias(f"s{i}") for i in range(size)), F.first("domain_prior", True).alias("parent"))
        .select("host", _smoothed(hosts, F.coalesce("parent", overall), size).alias("host_prior")), "hosts")

    nothing = F.array_repeat(F.lit(0.0), size)
    joined = scored
    for column in ("declared", "suffix"):
        joined = joined.join(small_side(given_language(column)), column, "left")
    joined = joined.join(small_side(hosts), "host", "left").join(small_side(domains), "domain", "left")
    prior = F.transform(F.coalesce("host_prior", "domain_prior", overall), lambda x: F.log(x))
    logs = F.col("likely")
    for more in (prior, F.coalesce("declared_log", nothing), F.coalesce("suffix_log", nothing)):
        logs = F.zip_with(logs, more, lambda x, y: x + y)
    names = F.array(*(F.lit(x) for x in languages))

    def best(values: Column) -> Column:
        return F.when(F.col("likely").isNotNull(), F.element_at(names, F.array_position(values, F.array_max(values)).cast("int")))

    joined = joined.withColumn("logs", logs)
    posterior = 1 / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("logs")))
    return (joined.withColumn("posterior", posterior)
            .select(*(F.col(o).alias(k) for k, o in zip(key, own, strict=True)),
                    best(F.col("logs")).alias("language"), "posterior",
                    best(F.col("likely")).alias("text_language"),
                    F.coalesce((F.col("posterior") >= LEAST_POSTERIOR) & F.col("fits"), F.lit(False)).alias("kept")))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Rows of the documents table: its ``lang`` is what a document declares, its source the host."""
    nothing = F.lit(None).cast("string")
    return docs.select("doc_id", "text", F.lower("lang").alias("declared"), nothing.alias("suffix"),
                       nothing.alias("domain"), F.col("source").alias("host"))


def page_evidence(pages: DataFrame) -> DataFrame:
    parts = address_parts(F.col("url"))
    return pages.select("page_id", markup_text(F.col("html")).alias("text"),
                        markup_language(F.col("html")).alias("declared"), *(c.alias(n) for n, c in parts.items()))
