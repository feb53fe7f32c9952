"""Language of web pages by Bayesian fusion of several kinds of evidence.

1. Text: log-likelihoods of the page's words under character n-gram models that
   are trained on a bounded, documented sample of documents with a known language
   (``TRAINING_ROWS``, those with the smallest hash of their id). Words are not
   independent, so a page counts as ``TEXT_WORDS`` words at most.
2. Markup: the language that the page declares. How far a declaration can be
   trusted is counted over all pages: P(declared | language), with each page's
   text posterior as soft counts.
3. Address: P(suffix of the host | language), counted likewise.
4. Host: a prior smoothed down a hierarchy - all pages, suffix, domain, host -
   where each level's counts are grouped sums and the level above is its prior of
   weight ``SMOOTHING``. A page's own text is taken out of its host's counts.

The posterior is their normalised product.

Defined cases: a null or empty page has no text evidence; a missing declaration is
a value of its own, as is a null or hostless address; documents with a null text
or language train nothing; rows that repeat a page_id each get a row; without any
training row the result is empty; an empty table gives an empty result; of the
other columns none is carried.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import sampled, table, written

TRAINING_ROWS = 4_000
MAX_LANGUAGES = 200
MAX_GRAMS = 20_000  # of each language
TEXT_WORDS = 40
SMOOTHING = 5.0
CACHED_WORDS = 200_000
_HIDDEN = re.compile(r"(?is)<(script|style|template)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"(?s)<[^>]*>")
_WORD = re.compile(r"[^\W\d_]+")


def visible_text(page: str | None) -> str:
    """Text between the tags, scripts and comments left out."""
    return markup.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page or "")))


def grams(word: str) -> list[str]:
    """Character 1- to 3-grams of a word with its edges marked."""
    edged = f" {word} "
    return [edged[i : i + n] for n in (1, 2, 3) for i in range(len(edged) - n + 1)]


class TextModel:
    """Log-likelihood of words per language."""

    def __init__(self, counts: dict[str, dict[str, int]]):
        self.languages = sorted(counts)
        every = sorted({g for c in counts.values() for g in c})
        self.rows = {g: i for i, g in enumerate(every)}
        table_ = np.full((len(every) + 1, len(self.languages)), 0.5)  # last row: unseen
        for k, language in enumerate(self.languages):
            for gram, n in counts[language].items():
                table_[self.rows[gram], k] += n
        self.logs = np.log(table_ / table_.sum(axis=0)) if len(every) else np.zeros_like(table_)

    def word(self, word: str) -> np.ndarray:
        """Per language, the mean over the word's grams times the share of a word."""
        unseen = len(self.rows)
        return self.logs[[self.rows.get(g, unseen) for g in grams(word)]].sum(axis=0) / 3

    def text(self, text: str, known: dict[str, np.ndarray]) -> list[float]:
        words = _WORD.findall(text.lower())
        if not words:
            return [0.0] * len(self.languages)
        if len(known) > CACHED_WORDS:
            known.clear()
        total = np.zeros(len(self.languages))
        for word, n in Counter(words).items():
            if word not in known:
                known[word] = self.word(word)
            total += n * known[word]
        total *= min(len(words), TEXT_WORDS) / len(words)
        return (total - total.max()).tolist()


def train(docs: DataFrame, rows: int = TRAINING_ROWS) -> TextModel:
    """n-gram counts of the sampled documents, by language."""
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang", "text")
    chosen = sampled(known.select("doc_id"), rows, "doc_id")
    sample = known.join(F.broadcast(chosen), "doc_id", "left_semi").where("text IS NOT NULL").select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(_WORD.findall(text.as_py().lower()))
        for lang, seen in words.items():
            found: Counter = Counter()
            for word, n in seen.items():
                for gram in grams(word):
                    found[gram] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.string()),
                 pa.array(list(found.values()), pa.int64())],
                names=["lang", "gram", "n"],
            )

    counted = written(
        sample.mapInArrow(count, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "grams",
    )
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    found: dict[str, dict[str, int]] = {}
    for lang in [r["lang"] for r in sizes.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()]:
        top = counted.where(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(MAX_GRAMS)
        found[lang] = {r["gram"]: r["n"] for r in top.collect()}
    return TextModel(found)


def text_evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    """Page id, address parts, declared language and text log-likelihoods."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_GRAMS
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    labels = F.split(host, r"\.")
    prepared = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        host.alias("host"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("domain"),
        F.element_at(labels, -1).alias("suffix"),
        F.coalesce(
            F.lower(F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)), F.lit("")
        ).alias("declared"),
        F.col("html"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for batch in batches:
            logs = [own.text(visible_text(page.as_py()), known) for page in batch.column(5)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(logs, pa.list_(pa.float64()))],
                names=[*batch.schema.names[:5], "text_log"],
            )

    return prepared.mapInArrow(
        run, "page_id long, host string, domain string, suffix string, declared string, text_log array<double>"
    )


def _normal(logs: Column) -> Column:
    """Probabilities of unnormalised logarithms."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _summed(df: DataFrame, by: list[str], column: str, size: int) -> DataFrame:
    """Element-wise sums of an array column by group."""
    sums = [F.sum(F.col(column)[k]).alias(f"s{k}") for k in range(size)]
    return df.groupBy(*by).agg(*sums).select(*by, F.array(*[f"s{k}" for k in range(size)]).alias("n"))


def _smoothed(counts: Column, prior: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, prior, lambda n, p: (n + SMOOTHING * p) / (total + SMOOTHING))


def _likelihood(evidence: DataFrame, value: str, size: int) -> DataFrame:
    """log P(value | language) for every value that occurs, from soft counts."""
    counts = _summed(evidence, [value], "posterior", size)
    totals = counts.agg(F.count(F.lit(1)), *[F.sum(F.col("n")[k]) for k in range(size)]).first()
    values, total = totals[0], F.array(*[F.lit(float(t or 0)) for t in totals[1:]])
    return counts.select(
        value,
        F.zip_with("n", total, lambda n, t: F.log((n + 0.5) / (t + 0.5 * values))).alias(f"{value}_log"),
    )


def host_priors(evidence: DataFrame, size: int) -> DataFrame:
    """Soft counts of every host and the smoothed prior of its domain."""
    hosts = _summed(evidence, ["suffix", "domain", "host"], "posterior", size)
    domains = _summed(hosts.withColumnRenamed("n", "each"), ["suffix", "domain"], "each", size)
    suffixes = _summed(domains.withColumnRenamed("n", "each"), ["suffix"], "each", size)
    everything = suffixes.agg(*[F.sum(F.col("n")[k]) for k in range(size)]).first()
    total = sum(n or 0 for n in everything)
    top = F.array(*[F.lit(((n or 0) + SMOOTHING / size) / (total + SMOOTHING)) for n in everything])
    of_suffix = suffixes.select("suffix", _smoothed(F.col("n"), top).alias("prior"))
    of_domain = domains.join(of_suffix, "suffix").select("domain", _smoothed(F.col("n"), F.col("prior")).alias("prior"))
    return hosts.join(of_domain, "domain").select("host", "n", "prior")


def identify(pages: DataFrame, docs: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """page_id, lang, probability, and what text and markup say on their own."""
    model = train(docs, rows)
    size = len(model.languages)
    if not size:
        return pages.select(
            F.col("page_id").cast("long").alias("page_id"), F.lit("").alias("lang"), F.lit(0.0).alias("probability"),
            F.lit("").alias("text_lang"), F.lit("").alias("declared"),
        ).limit(0)
    evidence = written(
        text_evidence(pages, model).withColumn("posterior", _normal(F.col("text_log"))), "evidence"
    )
    # tables of their own, so that a host with a third of the pages is dealt to many tasks
    priors = written(host_priors(evidence, size), "host-priors")
    declared = written(_likelihood(evidence, "declared", size), "declared")
    suffix = written(_likelihood(evidence, "suffix", size), "suffix")
    joined = evidence.join(priors, "host").join(declared, "declared").join(suffix, "suffix")
    others = F.zip_with("n", "posterior", lambda n, p: F.greatest(n - p, F.lit(0.0)))
    logs = F.zip_with(
        F.zip_with("text_log", F.transform(_smoothed(others, F.col("prior")), lambda p: F.log(p)), lambda a, b: a + b),
        F.zip_with("declared_log", "suffix_log", lambda a, b: a + b),
        lambda a, b: a + b,
    )
    names = F.array(*[F.lit(x) for x in model.languages])

    def best(column: str) -> Column:
        return F.get(names, (F.array_position(column, F.array_max(column)) - 1).cast("int"))

    return joined.withColumn("fused", _normal(logs)).select(
        "page_id", best("fused").alias("lang"), F.array_max("fused").alias("probability"),
        best("posterior").alias("text_lang"), "declared",
    )


def op3_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page."""
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
