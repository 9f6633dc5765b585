"""Language identification by Bayesian fusion of evidence.

The text speaks by letter trigrams of whole words, the markup by the language
that it declares, the address by its host.  The prior of a host is its share of
each language, smoothed towards that of its domain, that towards its address
suffix, that towards all rows; these counts are grouped sums.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import spill, unused
from .words import ALNUM, U64, slices, text_buffer

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
#: Labelled rows of each language that the trigram model is fitted on, about: rows are picked by the hash of their id.
SAMPLE = 2000
#: Trigrams are counted in so many hash classes.
CLASS_BITS = 15
#: Bytes of text whose trigrams are held at once.
SLICE = 1 << 20
#: Overlapping trigrams tell the same more than once.
TEMPER = 1 / 3
#: Rows that the next wider level of the address counts for.
WEIGHT = 10.0
#: Least posterior of an accepted language.
CONFIDENCE = 0.5

_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
_PLAIN = np.where(ALNUM.member, ALNUM.lower, 32).astype(np.uint64)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigram classes around every letter, and the text of each; marks and blanks are alike, A-Z count as a-z."""
    data, offsets = text_buffer(texts)
    plain = np.full(len(data) + 2 * len(texts) + 1, U64(32))
    at = np.arange(len(texts)) * 2 + 1
    place = np.arange(len(data)) + np.repeat(at, np.diff(offsets))
    plain[place] = _PLAIN[data]
    middle = place[_LETTER[ALNUM.lower[data]]]
    code = plain[middle - 1] << U64(16) | plain[middle] << U64(8) | plain[middle + 1]
    text = np.searchsorted(offsets + np.arange(len(texts) + 1) * 2 + 1, middle, "right") - 1
    return (code * U64(0x9E3779B97F4A7C15) >> U64(64 - CLASS_BITS)).astype(np.int64), text


@dataclass
class Model:
    """Log-probabilities of trigram classes by language; the last row is text of no known language."""

    languages: tuple[str, ...]
    table: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        """Log-likelihood of each whole text under each row; all zero for a text without letters."""
        out = np.zeros((len(texts), len(self.table)))
        for at, part in slices(texts, SLICE):
            code, text = trigrams(part)
            if len(code):
                first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                for k, row in enumerate(self.table):
                    out[at + text[first], k] = np.add.reduceat(row[code], first)
        return out


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        languages: tuple[str, ...] = LANGUAGES, sample: int = SAMPLE) -> Model:
    """Trigram model from some ``sample`` labelled rows of each language, whole texts.

    Rows with another label, without id or text are not used.  Counts are sums of
    fixed size; a language without rows gets even probabilities.
    """
    rows = labelled.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).filter(
        F.col("lang").isin(*languages) & F.col("id").isNotNull())
    many = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    grid = 1 << 30
    pick = F.pmod(F.xxhash64("id"), F.lit(grid))
    chosen = F.lit(False)
    for name in languages:
        chosen |= (F.col("lang") == name) & (pick < int(grid * min(1.0, sample / max(1, many.get(name, 0)))))
    size = 1 << CLASS_BITS

    def count(batches):
        total = np.zeros((len(languages), size), np.int64)
        for batch in batches:
            lang = np.array([languages.index(x) for x in batch.column(0).to_pylist()], np.int64)
            for at, part in slices(batch.column(1), SLICE):
                code, of = trigrams(part)
                total += np.bincount(lang[at + of] * size + code, minlength=total.size).reshape(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(languages), dtype=np.int32)), pa.array([t.tobytes() for t in total], pa.binary())],
                                         ["lang", "counts"])

    def add(batches):
        total = None
        for batch in batches:
            for lang, counts in zip(batch.column(0), batch.column(1)):
                counts = np.frombuffer(counts.as_py(), np.int64)
                total = counts if total is None else total + counts
        yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["lang", "counts"])

    from collections.abc import Iterator

    add.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    sums = rows.filter(chosen).dropna(subset=["text"]).select("lang", "text").mapInArrow(count, "lang int, counts binary").groupBy("lang").applyInArrow(
        add, "lang int, counts binary").collect()
    counts = np.zeros((len(languages) + 1, size))
    for row in sums:
        counts[row.lang] = np.frombuffer(row.counts, np.int64)
    return Model(tuple(languages), np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * size)))


def page_text(html: Column) -> Column:
    """What a reader sees of a page: no scripts, styles, comments, navigation, tags and entities."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|nav|header|footer|aside)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[A-Za-z0-9#]{1,10};", " ")


def markup_language(html: Column) -> Column:
    """The main part of the language that the html tag declares, or empty."""
    return F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def identify(rows: DataFrame, model: Model, confidence: float = CONFIDENCE) -> DataFrame:
    """One row for each row of (id, text, declared, host): id, lang, confidence, text_lang, declared, accepted.

    ``host`` is split at dots: its last label is the address suffix, its last two
    are the domain.  ``declared`` counts by how often rows whose text speaks for a
    language declare it.  A row's own vote is taken out of its host's counts.
    ``lang`` is ``und`` if text of no known language is more probable, or if there
    is no letter; ``accepted`` tells whether a known language has a posterior of
    ``confidence`` or more.  Null text, host or declaration count as empty, which
    is no evidence of the text, and a value like others of host and declaration.
    Repeated rows count as often as they come; no input gives no row.
    """
    names = [*model.languages, UNKNOWN]
    k = len(names)

    @F.arrow_udf("array<double>")
    def likelihood(texts: pa.Array) -> pa.Array:
        scores = model.score(texts)
        return pa.FixedSizeListArray.from_arrays(pa.array(scores.reshape(-1)), k).cast(pa.list_(pa.float64()))

    spoken = F.coalesce("declared", F.lit(""))
    labels = F.split(F.coalesce("host", F.lit("")), r"\.")
    told = rows.select(
        "id", likelihood("text").alias("text_scores"), F.when(spoken.isin(*model.languages), spoken).when(spoken == "", "").otherwise("other").alias("declared"),
        F.coalesce("host", F.lit("")).alias("host"), F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)).alias("domain"),
        F.element_at(labels, -1).alias("suffix"))
    letters = F.exists("text_scores", lambda x: x != 0)
    vote = F.when(letters, F.array_position("text_scores", F.array_max("text_scores")).cast("int") - 1)
    told = spill(told.withColumn("vote", vote), "text-evidence")

    votes = [F.sum((F.col("vote") == i).cast("long")).alias(f"v{i}") for i in range(k)]
    add = [F.sum(f"v{i}").alias(f"v{i}") for i in range(k)]
    voted = told.filter("vote IS NOT NULL")
    hosts = spill(voted.groupBy("host", "domain", "suffix").agg(*votes), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(*add)
    suffixes = spill(domains.groupBy("suffix").agg(*add), "suffixes")
    total = suffixes.agg(*add).first()
    total = [total[i] or 0 for i in range(k)]
    choices = [*model.languages, "other", ""]
    said = {(r.declared, r.vote): r.n for r in voted.groupBy("declared", "vote").agg(F.count("*").alias("n")).collect()}
    declares = {c: [math.log((said.get((c, i), 0) + 0.5) / (total[i] + 0.5 * len(choices))) for i in range(k)] for c in choices}

    packed = lambda name: F.array(*[F.col(f"v{i}") for i in range(k)]).alias(name)
    levels = hosts.select("host", "domain", "suffix", packed("of_host")).join(
        spill(domains.select("domain", "suffix", packed("of_domain")), "domains"), ["domain", "suffix"]).join(
        suffixes.select("suffix", packed("of_suffix")), "suffix")
    levels = spill(levels.select("host", "of_host", "of_domain", "of_suffix"), "levels")
    joined = told.join(levels, "host", "left")

    even = F.array(*[F.lit((t + 1.0) / (sum(total) + k)) for t in total])
    own = F.array(*[F.coalesce((F.col("vote") == i).cast("long"), F.lit(0)) for i in range(k)])
    prior = even
    for level in ("of_suffix", "of_domain", "of_host"):
        counts = F.zip_with(F.coalesce(level, own), own, lambda n, o: (n - o).cast("double"))
        all_ = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        joined = joined.withColumn("_counts", counts).withColumn("_all", all_).withColumn(
            "_prior", F.zip_with("_counts", prior, lambda n, p: (n + WEIGHT * p) / (F.col("_all") + WEIGHT)))
        prior = F.col("_prior")
    evidence = F.create_map(*[x for c in choices for x in (F.lit(c), F.array(*map(F.lit, declares[c])))])
    logs = F.zip_with(F.zip_with("text_scores", evidence[F.col("declared")], lambda t, d: TEMPER * t + d), "_prior", lambda a, p: a + F.log(p))
    out = joined.withColumn("_logs", logs).withColumn("_top", F.array_max("_logs"))
    out = out.withColumn("_share", F.lit(1.0) / F.aggregate("_logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_top"))))
    best = F.element_at(F.array(*map(F.lit, names)), F.array_position("_logs", F.col("_top")).cast("int"))
    named = F.when(F.col("vote").isNull(), F.lit(UNKNOWN)).otherwise(best)
    return out.withColumn("lang", named).select(
        "id", "lang", F.when(F.col("vote").isNull(), F.lit(0.0)).otherwise(F.col("_share")).alias("confidence"),
        F.when(F.col("vote").isNotNull(), F.element_at(F.array(*map(F.lit, names)), F.col("vote") + 1)).alias("text_lang"), "declared",
        ((F.col("lang") != UNKNOWN) & (F.col("vote").isNotNull()) & (F.col("_share") >= confidence)).alias("accepted"))


def identify_pages(pages: DataFrame, model: Model) -> DataFrame:
    """``identify`` for web pages (page_id, url, html)."""
    return identify(pages.select(F.col("page_id").cast("long").alias("id"), page_text(F.col("html")).alias("text"),
                                 markup_language(F.col("html")).alias("declared"), url_host(F.col("url")).alias("host")), model)


def identify_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``identify`` for documents (doc_id, text, lang, source): the label is what is declared, the source is the host."""
    return identify(docs.select(F.col("doc_id").cast("long").alias("id"), "text", F.lower("lang").alias("declared"),
                                F.col("source").alias("host")), model)


def in_known_language(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with the columns they had; rows without id stay."""
    name = unused(docs, "gone")
    gone = identify_documents(docs, model).filter("NOT accepted AND id IS NOT NULL").select(F.col("id").alias(name)).distinct()
    gone = spill(gone, "rejected")  # its size is known then, so that few ids are not joined by moving all texts
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
