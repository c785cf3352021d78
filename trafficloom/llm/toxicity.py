"""Toxicity scores by a classifier that learns to pass over whom a sentence is about.

1. The labelled rows that may be learned from are sampled per label: all of them up to
   ``SAMPLE``, else those with the smallest digests of their ids. Only ids are joined for
   that; the texts are fetched by the sampled ids.
2. A text's features are its words and their beginnings of ``SHORTEST`` to ``LONGEST``
   letters, valued log(1 + occurrences), and its length. Tasks count in how many sampled
   texts of each label a feature occurs; the ``FEATURES`` that differ most between the
   labels by chi-square make the model, so what reaches the driver is bounded by
   ``SAMPLE`` and ``FEATURES``.
3. Sentences of the sample that hold an identity term get counterfactual copies, in which
   every such term is swapped for the others of its set in turn. Tasks add up the products
   of the features' changes, at most ``FEATURES`` squared.
4. A logistic regression is fitted with each label weighing the same, a small square
   penalty, and ``FAIRNESS`` times the mean square of the score changes under the swaps,
   before the logistic function. It takes weight off identity terms and puts it on what
   else tells toxic sentences, so neutral mentions of a group are not held against them.
5. Every whole text is scored in one pass with the weights, a few kilobytes.

Inputs of a score are the text and the fitted weights alone.

Defined cases: a null text is an empty one, and both have the score of a text without
features. Repeated rows are scored alike; a row that repeats in documents or labels counts
as often in the fit. Labels other than 0 and 1 are left out. Without sampled rows of both
labels every score is the share of toxic ones among them, or 0. An id without a value is
neither held out nor labelled. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.llm.common import stored

#: Rows of each label the classifier is fitted on.
SAMPLE = 4000
FEATURES = 1000
#: Sampled texts a feature has to occur in.
SUPPORT = 3
SHORTEST, LONGEST = 3, 7
FAIRNESS = 10.0
RIDGE = 1e-3
ROUNDS, RATE = 400, 0.05
#: About the logarithm of a usual text's number of words.
USUAL = 6.0
#: Words whose features a worker remembers, and features a task counts before it hands them on.
REMEMBERED = 500_000
ENTRIES = 500_000

# Sets of terms for groups of people that may stand for each other.
IDENTITIES = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("black", "white", "asian", "latino", "arab", "indigenous"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "citizens", "locals"),
    ("africans", "americans", "europeans", "asians", "mexicans"),
    ("elderly", "young"),
    ("disabled", "blind", "deaf"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("schwarze", "weiße"),
    ("ausländer", "einwanderer", "flüchtlinge", "deutsche"),
    ("schwule", "lesben", "heteros"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noirs", "blancs", "arabes", "asiatiques"),
    ("immigrés", "réfugiés", "étrangers", "français"),
    ("homosexuels", "lesbiennes", "hétérosexuels"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("negros", "blancos", "árabes", "asiáticos"),
    ("inmigrantes", "refugiados", "extranjeros", "españoles"),
    ("homosexuales", "lesbianas", "heterosexuales"),
)

_SENTENCE = re.compile(r"[^.!?\n]+")
#: Letters, and everything beyond ASCII.
_WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features_of(word: str) -> list[str]:
    """The word, marked by a blank, and its beginnings."""
    return [word + " ", *(word[:k] for k in range(SHORTEST, min(LONGEST, len(word) - 1) + 1))]


@dataclass(frozen=True)
class Classifier:
    """Weights of the features, of the text's length, and the intercept."""

    features: tuple[str, ...]
    weights: np.ndarray
    length: float
    intercept: float

    @functools.cached_property
    def place(self) -> dict[str, int]:
        return {f: k for k, f in enumerate(self.features)}

    def score(self, text: str, known: "Places") -> float:
        """A number from 0 to 1."""
        places, values, words = valued(text, known)
        z = self.intercept + self.length * (np.log1p(words) - USUAL) + float(values @ self.weights[places])
        return float(np.exp(-np.logaddexp(0.0, -z)))


class Places(dict):
    """The places of a word's features among those of the model."""

    def __init__(self, features: Sequence[str]):
        self.place = {f: k for k, f in enumerate(features)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.place[f] for f in features_of(word) if f in self.place)
        self[word] = found
        return found


def occurrences(words: Counter[str], known: Places) -> Counter[int]:
    found: Counter[int] = Counter()
    for word, n in words.items():
        for place in known[word]:
            found[place] += n
    return found


def valued(text: str, known: Places) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and values of the text's features, and its number of words."""
    words = Counter(words_of(text))
    found = occurrences(words, known)
    places = np.fromiter(found, np.int64, len(found))
    return places, np.log1p(np.fromiter(found.values(), np.float64, len(found))), words.total()


def swaps(sentence: list[str], identities: Sequence[Sequence[str]] = IDENTITIES) -> Iterator[list[str]]:
    """The sentence with all its identity terms swapped, once for each of the others that the
    largest of their sets has."""
    sets = _sets(tuple(map(tuple, identities)))
    largest = max((len(sets[w][0]) for w in sentence if w in sets), default=0)
    for turn in range(1, largest):
        copy = [sets[w][0][(sets[w][1] + turn) % len(sets[w][0])] if w in sets else w for w in sentence]
        if copy != sentence:
            yield copy


@functools.cache
def _sets(identities: tuple[tuple[str, ...], ...]) -> dict[str, tuple[tuple[str, ...], int]]:
    return {term: (group, k) for group in identities for k, term in enumerate(group)}


def _number(name: str) -> Column:
    return F.crc32(F.col(name).cast("string").cast("binary"))


def held_out(id_col: str) -> Column:
    """Whether a row's label may not be learned from."""
    return F.coalesce(_number(id_col) % 5 == 0, F.lit(False))


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """Texts and labels (text, toxic) of the rows to learn from, at most about ``sample`` of
    each label, stored. ``labels`` are joined by their column ``id_col``."""
    there = docs.select(F.col(id_col).alias("id")).filter("id IS NOT NULL")
    given = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    usable = given.filter(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id"))
    known = stored(usable.join(there, "id", "left_semi").withColumn("draw", F.xxhash64("id")), "toxicity-labels")
    chosen = None
    for toxic in (0, 1):
        first = known.filter(F.col("toxic") == toxic).orderBy("draw", "id").limit(sample).select("id", "toxic")
        chosen = first if chosen is None else chosen.union(first)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # at most twice the sample
    return stored(texts.join(F.broadcast(chosen), "id").select("text", "toxic"), "toxicity-sample")


def chosen_features(sample: DataFrame, number: int = FEATURES, support: int = SUPPORT) -> list[str]:
    """The features that differ most between the labels, by chi-square."""

    def rows(counts: Counter) -> pd.DataFrame:
        return pd.DataFrame([(f, t, n) for (f, t), n in counts.items()], columns=["feature", "toxic", "n"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"].tolist()):
                counts.update((f, toxic) for f in {f for w in set(words_of(text)) for f in features_of(w)})
                if len(counts) > ENTRIES:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)

    counted = sample.mapInPandas(count, "feature string, toxic int, n long")
    of_label = lambda toxic: F.sum(F.when(F.col("toxic") == toxic, F.col("n")).otherwise(0)).cast("double")
    table = counted.groupBy("feature").agg(of_label(0).alias("b"), of_label(1).alias("a"))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}  # two
    toxic, every = F.lit(float(sizes[1])), F.lit(float(sum(sizes.values())))
    both = F.col("a") + F.col("b")
    expected = both * toxic / every
    chi = (F.col("a") - expected) ** 2 / (expected * (1 - toxic / every) * (F.lit(1.0) + F.lit(1e-9) - both / every))
    best = table.filter(both >= support).orderBy(chi.desc(), "feature").limit(number)
    return [r["feature"] for r in best.select("feature").collect()]


def counterfactual_changes(
    sample: DataFrame, features: Sequence[str], identities: Sequence[Sequence[str]] = IDENTITIES
) -> tuple[np.ndarray, int]:
    """Mean product of the changes of two features under a swap, and the number of swaps."""
    names, sets = tuple(features), tuple(map(tuple, identities))

    def change(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, terms = Places(names), _sets(sets)
        products: Counter[tuple[int, int]] = Counter()
        swapped = 0
        for batch in batches:
            for text in batch["text"]:
                for sentence in _SENTENCE.findall(text):
                    words = words_of(sentence)
                    if terms.keys().isdisjoint(words):
                        continue
                    before = occurrences(Counter(words), known)
                    for copy in swaps(words, sets):
                        swapped += 1
                        after = occurrences(Counter(copy), known)
                        moved = {k: np.log1p(after[k]) - np.log1p(before[k]) for k in before.keys() | after.keys()}
                        moved = {k: d for k, d in moved.items() if d}
                        for i, x in moved.items():
                            for j, y in moved.items():
                                products[i, j] += x * y
        rows = [(i, j, float(x)) for (i, j), x in products.items()]
        yield pd.DataFrame([*rows, (-1, -1, float(swapped))], columns=["i", "j", "x"])

    table = np.zeros((len(names), len(names)))
    swapped = 0
    summed = sample.mapInPandas(change, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    for i, j, x in summed.collect():  # at most one per two features
        if i < 0:
            swapped = int(x)
        else:
            table[i, j] = x
    return table / max(1, swapped), swapped


def fitted(
    rows: np.ndarray, places: np.ndarray, values: np.ndarray, words: np.ndarray, toxic: np.ndarray, changes: np.ndarray, fairness: float
) -> tuple[np.ndarray, float, float]:
    """Weights, the length's weight and the intercept of the penalised regression, by
    full-batch steps of adapted size. ``rows``, ``places`` and ``values`` are the entries
    of the feature matrix."""
    n, size = len(toxic), len(changes) + 1
    rows = np.concatenate([rows, np.arange(n)])
    places = np.concatenate([places, np.full(n, size - 1)])
    values = np.concatenate([values, np.log1p(words) - USUAL])
    share = np.where(toxic == 1, 0.5 / (toxic == 1).sum(), 0.5 / (toxic == 0).sum())
    touched = np.flatnonzero(changes.any(1))
    part = fairness * changes[np.ix_(touched, touched)]
    # a step in touched features must not overshoot the square penalty
    damped = np.ones(size + 1)
    if len(touched):
        damped[touched] = 1 / (1 + np.abs(part).sum(1))
    w, mean, square = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, ROUNDS + 1):
        z = np.bincount(rows, values * w[places], n) + w[-1]
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic) * share
        slope = np.append(np.bincount(places, values * off[rows], size) + RIDGE * w[:-1], off.sum())
        slope[touched] += part @ w[touched]
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        rate = RATE * min(1.0, 2 * (1 - step / (ROUNDS + 1)))
        w -= rate * damped * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w[: size - 1], float(w[size - 1]), float(w[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    identities: Sequence[Sequence[str]] = IDENTITIES,
    fairness: float = FAIRNESS,
) -> Classifier:
    """The classifier of the documents' labels, from the rows that are not held out."""
    learned = sampled(docs, labels, id_col, text_col, label_col, sample)
    sizes = {r["toxic"]: r["count"] for r in learned.groupBy("toxic").count().collect()}  # two at most
    if len(sizes) < 2:
        return Classifier((), np.zeros(0), 0.0, np.inf if 1 in sizes else -np.inf)
    features = chosen_features(learned)
    changes, _ = counterfactual_changes(learned, features, identities)
    names = tuple(features)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Places(names)
        for batch in batches:
            found = [valued(text, known) for text in batch["text"]]
            yield pd.DataFrame(
                {"toxic": batch["toxic"], "places": [p for p, _, _ in found], "x": [x for _, x, _ in found], "words": [n for _, _, n in found]}
            )

    # at most twice the sample, of FEATURES entries each
    measured = learned.mapInPandas(measure, "toxic int, places array<long>, x array<double>, words long").toPandas()
    rows = np.repeat(np.arange(len(measured)), [len(p) for p in measured["places"]])
    places = np.concatenate([np.zeros(0, np.int64), *measured["places"]]).astype(np.int64)
    values = np.concatenate([np.zeros(0), *measured["x"]])
    words, toxic = measured["words"].to_numpy(), measured["toxic"].to_numpy()
    return Classifier(names, *fitted(rows, places, values, words, toxic, changes, fairness))


def scored(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, ``held_out``, ``score`` and ``predicted``, 1 from a score of 0.5 on."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        classifier = shared.value
        known = Places(classifier.features)
        for texts in batches:
            if len(known) > REMEMBERED:
                known.clear()
            yield pd.Series([classifier.score(text, known) for text in texts], dtype="float64")

    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score(F.coalesce(F.col(text_col), F.lit(""))).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
