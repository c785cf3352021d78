"""Language identification by fusing evidence under Bayes' rule.

For each row, four pieces of evidence are added up as logarithms per language:

* the text, by a multinomial model over hashed letter triples of the whole text;
* the language the markup declares, by how often it is declared for texts of a language;
* the suffix of the address, in the same way;
* the host, by a prior smoothed towards its domain's and that towards the corpus's.

Only the text model is fitted, on a sample of each label's rows of documented size, so no
language with ``SUPPORT`` labelled rows is missed. The tables
for declarations, suffixes, domains and hosts are grouped sums of the text posteriors over
all rows; the host's sum is taken without the row itself, so that a text does not vote
twice. ``UNKNOWN`` stands beside the languages with a flat distribution over triples, so
text unlike every language goes there.

The tables have a row per declaration, suffix or host. Spark broadcasts them if their size
allows and shuffles otherwise; a hot host is pre-aggregated in every task.

Defined cases: a row whose text is null, or too short for a triple, has no language and is
not accepted. A missing declaration, suffix or host is a value of its own. Rows that repeat
count each. Without labelled rows, ``fit`` raises ValueError if there are rows at all; for
an empty table it returns a model without languages, and nothing is accepted.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom.llm.common import stored

UNKNOWN = "unknown"
#: Rows of each label the text model is fitted on, and how many labelled rows a language needs.
SAMPLE = 4000
SUPPORT = 5
BUCKET_BITS = 14
#: Triples overlap and repeat, so each counts for less than an independent draw.
TEMPER = 0.25
#: Rows that a coarser level's prior, or the flat distribution of an evidence, is worth.
PSEUDO_ROWS = 5.0
#: A row is accepted from this posterior on.
CONFIDENT = 0.5


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    #: Logarithms of probabilities, a row per language and a last one for UNKNOWN.
    table: np.ndarray

    @property
    def classes(self) -> tuple[str, ...]:
        return (*self.languages, UNKNOWN)


def bucket(windows: np.ndarray) -> np.ndarray:
    """Buckets of windows of three bytes, given as numbers."""
    return (windows * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)


def triples(text: str) -> np.ndarray:
    """Buckets of the three-byte windows of the lower-cased text."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.uint32)
    return bucket((data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:])


def primary(tag: Column) -> Column:
    """The primary part of a language tag in lower case; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.trim(tag), "^([A-Za-z]{2,3})(?:[-_].*)?$", 1)), F.lit(""))


def has_label(label_col: str, text_col: str) -> Column:
    return (primary(F.col(label_col)) != "") & F.col(text_col).isNotNull()


def fit(rows: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> TextModel:
    """The text model from a sample of each label's rows: all of them up to ``sample``, else
    those with the smallest digests of their ids, by a bound below which about ``sample`` are
    expected where ids do not repeat. Rows of the smallest digest are always in it. They are
    counted where they lie; only the counts per language and bucket reach the driver."""
    labelled = rows.select(
        F.xxhash64(F.col(id_col)).alias("draw"), primary(F.col(label_col)).alias("label"), F.col(text_col).alias("text")
    ).filter("label <> '' AND text IS NOT NULL")
    of_label = labelled.groupBy("label").agg(F.count("*").alias("n"), F.min("draw").alias("least"))
    bound = F.when(F.col("n") > sample, (-(2.0**63) + 2.0**64 * sample / F.col("n")).cast("long")).otherwise(F.lit((1 << 63) - 1))
    limits = stored(of_label.select(F.col("label").alias("of"), "n", F.greatest("least", bound).alias("cut")), "language-labels")
    support = {r["of"]: r["n"] for r in limits.select("of", "n").collect()}  # tags of two or three letters
    if not support:
        if not rows.isEmpty():
            raise ValueError("no row has both a text and a label")
        return TextModel((), np.zeros((1, 1 << BUCKET_BITS)))

    def count(batches):
        for batch in batches:
            for label, texts in batch.groupby("label")["text"]:
                total = np.zeros(1 << BUCKET_BITS, np.int64)
                for text in texts:
                    total += np.bincount(triples(text), minlength=1 << BUCKET_BITS)
                there = np.flatnonzero(total)
                yield pd.DataFrame({"label": label, "bucket": there, "n": total[there]})

    inside = (F.col("label") == F.col("of")) & (F.col("draw") <= F.col("cut"))
    chosen = labelled.join(F.broadcast(limits), inside).select("label", "text")
    counts = chosen.mapInPandas(count, "label string, bucket long, n long")
    sums = counts.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(k for k, n in support.items() if n >= SUPPORT)) or tuple(sorted(support))
    table = np.full((len(languages) + 1, 1 << BUCKET_BITS), 0.5)
    for k, language in enumerate(languages):
        own = sums[sums["label"] == language]
        table[k, own["bucket"].to_numpy(int)] += own["n"].to_numpy()
    table[-1] = 1.0
    return TextModel(languages, np.log(table / table.sum(1, keepdims=True)))


def text_evidence(model: TextModel):
    """A column function: the text's log likelihood per class and its posterior under
    equal priors, null for a text without triples."""
    table = np.ascontiguousarray(model.table.T.astype(np.float32))

    @F.pandas_udf("likelihood array<double>, posterior array<double>")
    def evidence(texts: pd.Series) -> pd.DataFrame:
        found = []
        for text in texts:
            windows = triples(text) if isinstance(text, str) else ()
            if not len(windows):
                found.append((None, None))
                continue
            score = np.zeros(table.shape[1])
            for start in range(0, len(windows), 1 << 16):
                score += table[windows[start : start + (1 << 16)]].sum(0, dtype=np.float64)
            score = TEMPER * (score - score.max())
            chance = np.exp(score)
            found.append((score, chance / chance.sum()))
        return pd.DataFrame(found, columns=["likelihood", "posterior"])

    return evidence


def address_parts(url: Column) -> dict[str, Column]:
    """Host, domain (its last two labels) and suffix (its last label) of an address."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return {
        "host": host,
        "domain": F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1),
        "suffix": F.regexp_extract(host, r"\.([^.]+)$", 1),
    }


def declared_in(page: Column) -> Column:
    """The lang attribute of the html element, empty if there is none."""
    return F.regexp_extract(F.coalesce(page, F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)


_HIDDEN = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"(?s)<[^>]*>")


@F.pandas_udf(T.StringType())
def visible_text(pages: pd.Series) -> pd.Series:
    """The text of pages without scripts, styles, comments and tags."""
    return pages.map(lambda page: html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page))) if isinstance(page, str) else None)


def with_evidence(
    rows: DataFrame, model: TextModel, text: Column, declared: Column, host: Column, domain: Column, suffix: Column
) -> DataFrame:
    """The rows with a struct ``evidence`` of the text's scores and the keys of the other evidence."""
    keys = {"declared": primary(declared), "host": host, "domain": domain, "suffix": suffix}
    named = (F.coalesce(value, F.lit("")).alias(name) for name, value in keys.items())
    return rows.withColumn("text_evidence", text_evidence(model)(text)).withColumn(
        "evidence", F.struct(F.col("text_evidence.likelihood"), F.col("text_evidence.posterior"), *named)
    ).drop("text_evidence")


def _sums(evidence: DataFrame, classes: int, *keys: str) -> DataFrame:
    """Per key, the array of the summed posteriors and their total."""
    sums = [F.sum(F.get("evidence.posterior", F.lit(k))) for k in range(classes)]
    known = evidence.filter("evidence.posterior IS NOT NULL")
    return known.groupBy(*(F.col(f"evidence.{k}").alias(k) for k in keys)).agg(F.array(*sums).alias("sums"))


@dataclass(frozen=True)
class Tables:
    """Grouped evidence: log P(key | class) for declarations and suffixes, and for hosts
    the sums of posteriors with the prior of the domain."""

    declared: DataFrame
    suffix: DataFrame
    host: DataFrame


def tables_of(evidence: DataFrame, classes: int) -> Tables:
    """The tables from rows with ``evidence``, over all of them."""
    per_host = stored(_sums(evidence, classes, "host", "domain"), "language-hosts")

    def added(frame: DataFrame) -> Column:
        return F.array(*(F.sum(F.get("sums", F.lit(k))) for k in range(classes)))

    def smoothed(sums: Column, prior: Column) -> Column:
        total = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(sums, prior, lambda x, p: (x + PSEUDO_ROWS * p) / (total + PSEUDO_ROWS))

    whole = per_host.agg(added(per_host).alias("corpus"))  # one row
    flat = F.array(*([F.lit(1.0 / classes)] * classes))
    corpus = whole.select(smoothed(F.col("corpus"), flat).alias("corpus_prior"), F.col("corpus"))
    prior, totals = (list(x) for x in corpus.first())
    if totals[0] is None:
        prior, totals = [1.0 / classes] * classes, [0.0] * classes
    corpus_prior = F.array(*(F.lit(float(x)) for x in prior))
    per_domain = per_host.groupBy("domain").agg(added(per_host).alias("domain_sums"))
    domain_prior = per_domain.select(F.col("domain").alias("of"), smoothed(F.col("domain_sums"), corpus_prior).alias("prior"))
    host = per_host.join(domain_prior, F.col("domain") == F.col("of")).select(
        F.struct("host", "domain", "sums", "prior").alias("by_host")
    )

    def chances(key: str) -> DataFrame:
        """log P(key | class), with a flat share for each key value and one more."""
        sums = stored(_sums(evidence, classes, key), f"language-{key}")
        values = sums.count() + 1
        logs = F.array(
            *(
                F.log((F.get("sums", F.lit(k)) + PSEUDO_ROWS / values) / F.lit(float(totals[k] + PSEUDO_ROWS)))
                for k in range(classes)
            )
        )
        return stored(sums.select(F.struct(F.col(key), logs.alias("logs")).alias(f"by_{key}")), f"language-{key}")

    return Tables(chances("declared"), chances("suffix"), stored(host, "language-host-priors"))


def judged(rows: DataFrame, model: TextModel, tables: Tables) -> DataFrame:
    """The rows with a struct ``language_of`` (language, posterior, accepted) in place of ``evidence``."""
    joined = (
        rows.join(tables.declared, F.col("evidence.declared") == F.col("by_declared.declared"), "left")
        .join(tables.suffix, F.col("evidence.suffix") == F.col("by_suffix.suffix"), "left")
        .join(
            tables.host,
            (F.col("evidence.host") == F.col("by_host.host")) & (F.col("evidence.domain") == F.col("by_host.domain")),
            "left",
        )
    )
    classes = model.classes

    def score(k: int) -> Column:
        at = lambda name: F.get(name, F.lit(k))
        others = F.greatest(at("by_host.sums") - at("evidence.posterior"), F.lit(0.0))
        host = F.log(others + PSEUDO_ROWS * at("by_host.prior"))
        return at("evidence.likelihood") + at("by_declared.logs") + at("by_suffix.logs") + host

    scores = F.array(*(F.struct(score(k).alias("score"), F.lit(k).alias("k")) for k in range(len(classes))))
    total = F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x["score"] - F.col("best.score")))
    names = F.array(*(F.lit(c) for c in classes))
    known = F.col("evidence.likelihood").isNotNull()
    language = F.when(known, F.get(names, F.col("best.k")))
    posterior = F.when(known, 1.0 / F.col("total"))
    accepted = F.coalesce((language != UNKNOWN) & (posterior >= CONFIDENT), F.lit(False))
    return (
        joined.withColumn("fused", scores)
        .withColumn("best", F.array_max("fused"))
        .withColumn("total", total)
        .withColumn("language_of", F.struct(language.alias("language"), posterior.alias("posterior"), accepted.alias("accepted")))
        .drop("fused", "best", "total", "by_declared", "by_suffix", "by_host", "evidence")
    )


def document_evidence(docs: DataFrame, model: TextModel) -> DataFrame:
    """Documents declare a language in ``lang``; their source stands for the host."""
    nothing = F.lit("")
    return with_evidence(docs, model, F.col("text"), F.col("lang"), F.col("source"), nothing, nothing)


def accepted(docs: DataFrame, sample: int = SAMPLE, languages: Sequence[str] | None = None) -> DataFrame:
    """The documents of an accepted language, columns as given.

    The texts are scored twice, once for the tables and once to filter; this costs less
    than moving them through a join with their verdicts.
    """
    model = fit(docs, "doc_id", "text", "lang", sample)
    evidence = stored(document_evidence(docs.select("text", "lang", "source"), model).select("evidence"), "language-evidence")
    # The document travels as one struct, so no column of it can clash with the evidence's.
    whole = docs.select("text", "lang", "source", F.struct("*").alias("document"))
    rows = judged(document_evidence(whole, model), model, tables_of(evidence, len(model.classes)))
    rows = rows.filter("language_of.accepted")
    if languages is not None:
        rows = rows.filter(F.col("language_of.language").isin(*languages))
    return rows.select("document.*")
