"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other.  Each has a logistic model over
the words (and beginnings of words) that a text contains and the probabilities
of all categories before it.  In training those probabilities are out of fold: the sample is dealt into
folds, and a row's probability comes from the model fitted without its fold,
so that a later model sees earlier ones as wrong as they will be on new text.
The models that score are fitted to the whole sample.

The last category is the labelled one.  The labels say only whether a text is
toxic; the categories before it are kinds of toxicity told by seed words: a
labelled row belongs to a kind if it is toxic and contains one of its words.

The sample is bounded (``TRAIN_ROWS``), and so is the vocabulary, the words
that tell toxic from other texts best.  Scoring is one narrow pass over whole
texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log1p

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import cut
from tabula.llm.training import labelled_sample

TRAIN_ROWS = 20_000
#: Words of the models, those that tell toxic from other texts best, and the
#: least number of documents a word is in.
VOCABULARY, LEAST_DOCS = 1 << 14, 5
FOLDS = 3
#: Ridge penalty of the models and the optimiser's steps.
PENALTY, STEPS = 0.0001, 40
#: Lowest probability of a text called toxic.
CUT_OFF = 0.5
#: Seed words of the kinds of toxicity, in the order of the chain.
KINDS = {
    "insult": ("clown", "idiot", "loser", "moron", "stupid"),
    "contempt": ("disgusting", "pathetic", "scum", "trash", "worthless"),
}
#: Name of the last category.
LAST = "toxic"
WORD = re.compile(r"\w+")
#: Lengths of words' beginnings that are terms beside the words.
BEGINNINGS = (5, 7)
#: Characters of a text looked at at a time.
PART = 1 << 20


def terms(text: str) -> Counter:
    """How often each term occurs in a whole text; long texts are read part by part.

    Terms are the lower-cased words and, marked by a hyphen, the beginnings of
    longer words: inflected and joined forms share them.
    """
    words: Counter = Counter()
    start = 0
    while start < len(text):
        stop = start + PART
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        words.update(WORD.findall(text[start:stop].lower()))
        start = stop
    out = Counter(words)
    for size in BEGINNINGS:
        for word, n in words.items():
            if len(word) > size:
                out[word[:size] + "-"] += n
    return out


def with_words(rows: DataFrame) -> DataFrame:
    """(doc_id, label, words, counts) of rows (doc_id, label, text): terms, and how often each occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(terms(v.as_py() or "").items()) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([[t for t, _ in x] for x in found], pa.list_(pa.string())),
                 pa.array([[n for _, n in x] for x in found], pa.list_(pa.int32()))],
                ["doc_id", "label", "words", "counts"])

    return rows.select("doc_id", "label", "text").mapInArrow(
        run, "doc_id bigint, label double, words array<string>, counts array<int>")


@dataclass(frozen=True)
class Chain:
    """Categories in order, and of each the intercept, the weights of the
    probabilities before it, and the weights of words by word."""

    names: tuple[str, ...]
    intercepts: tuple[float, ...]
    links: tuple[tuple[float, ...], ...]
    words: dict[str, tuple[float, ...]]

    def probabilities(self, found: Counter) -> list[float]:
        """The categories' probabilities of a text with these terms."""
        sums = list(self.intercepts)
        for word in sorted(found.keys() & self.words.keys()):
            for k, weight in enumerate(self.words[word]):
                sums[k] += weight * log1p(found[word])
        out: list[float] = []
        for total, link in zip(sums, self.links):
            total += sum(a * p for a, p in zip(link, out))
            out.append(1 / (1 + exp(-max(-500.0, min(500.0, total)))))
        return out


def vocabulary(rows: DataFrame, size: int = VOCABULARY, least: int = LEAST_DOCS) -> list[str]:
    """The ``size`` words whose share of texts differs most, in standard errors, by label."""
    n, n1 = rows.agg(F.count("label"), F.sum("label")).first()
    if not n or not 0 < n1 < n:
        return []
    counts = (rows.select("label", F.explode("words").alias("word")).groupBy("word")
              .agg(F.count("*").alias("df"), F.sum("label").alias("hits")).where(F.col("df") >= least))
    share = F.col("df") / F.lit(float(n))
    gap = F.col("hits") / F.lit(float(n1)) - (F.col("df") - F.col("hits")) / F.lit(float(n - n1))
    z = F.try_divide(F.abs(gap), F.sqrt(share * (1 - share) * (1 / n1 + 1 / (n - n1))))
    best = counts.withColumn("z", z).orderBy(F.col("z").desc_nulls_last(), "word").limit(size)
    return [r.word for r in best.collect()]


def with_bags(rows: DataFrame, words: list[str]) -> DataFrame:
    """``rows`` with ``bag``, a sparse vector of log(1 + n) for each of ``words`` that occurs n times."""
    place = {w: k for k, w in enumerate(words)}

    @F.udf(VectorUDT())
    def bag(own: list[str], counts: list[int]) -> SparseVector:
        return Vectors.sparse(len(place), {place[w]: log1p(n) for w, n in zip(own, counts) if w in place})

    return rows.withColumn("bag", bag("words", "counts"))


def _model(rows: DataFrame, before: list[str], label: str) -> LogisticRegressionModel:
    data = VectorAssembler(inputCols=["bag", *before], outputCol="features").transform(rows)
    return LogisticRegression(labelCol=label, regParam=PENALTY, standardization=False,
                              maxIter=STEPS).fit(data.select("features", label))


def _with_probability(rows: DataFrame, model: LogisticRegressionModel, before: list[str], name: str) -> DataFrame:
    data = VectorAssembler(inputCols=["bag", *before], outputCol="features").transform(rows)
    kept = [c for c in rows.columns if c != name]
    scored = model.setProbabilityCol("probability").transform(data)
    return scored.select(*kept, vector_to_array("probability")[1].alias(name))


def fit(rows: DataFrame, kinds: dict[str, tuple[str, ...]] = KINDS, last: str = LAST,
        folds: int = FOLDS) -> Chain:
    """The chain of a bounded frame (doc_id, label, words, counts).

    A category that no row, or every row, belongs to has that constant as
    probability.
    """
    names = (*kinds, last)
    data = rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(folds)), F.lit(folds)))
    for name, seeds in kinds.items():
        data = data.withColumn(f"is_{name}", F.when(
            (F.col("label") > 0) & F.arrays_overlap("words", F.array(*[F.lit(s) for s in seeds])),
            1.0).otherwise(0.0))
    data = data.withColumn(f"is_{last}", F.col("label"))
    words = vocabulary(data)
    if not words:
        share = data.agg(F.avg("label")).first()[0]
        return Chain(names, tuple(_constant(0.0 if share is None else round(share)) for _ in names),
                     tuple((0.0,) * k for k in range(len(names))), {})
    # a bounded frame: one partition saves the optimiser's many small shuffles
    data = cut(with_bags(data, words).drop("words", "counts", "label").coalesce(1))
    intercepts, links, columns = [], [], []
    before: list[str] = []
    for name in names:
        label = f"is_{name}"
        share = data.agg(F.avg(label)).first()[0]
        if share in (0.0, 1.0):
            intercepts.append(_constant(share))
            links.append((0.0,) * len(before))
            columns.append([0.0] * len(words))
            data = data.withColumn(f"p_{name}", F.lit(share))
        else:
            model = _model(data, before, label)
            weights = model.coefficients.toArray()
            intercepts.append(float(model.intercept))
            columns.append([float(w) for w in weights[:len(words)]])
            links.append(tuple(float(w) for w in weights[len(words):]))
            if name != last:
                data = cut(_out_of_fold(data, before, name, folds, model))
        before.append(f"p_{name}")
    table = {word: row for word, row in zip(words, zip(*columns)) if any(row)}
    return Chain(names, tuple(intercepts), tuple(links), table)


def _out_of_fold(data: DataFrame, before: list[str], name: str, folds: int,
                 whole: LogisticRegressionModel) -> DataFrame:
    """``data`` with p_name, of each fold by the model fitted without it."""
    parts = []
    for fold in range(folds):
        rest = data.where(F.col("fold") != fold)
        kinds = rest.select(f"is_{name}").distinct().count()
        model = _model(rest, before, f"is_{name}") if kinds == 2 else whole
        parts.append(_with_probability(data.where(F.col("fold") == fold), model, before, f"p_{name}"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.coalesce(1)


def _constant(share: float) -> float:
    return 50.0 if share >= 1 else -50.0


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
           label: str = "toxic", train_rows: int = TRAIN_ROWS, cut_off: float = CUT_OFF) -> DataFrame:
    """(doc_id, p_insult, p_contempt, score, predicted) of every row of ``docs``.

    ``score`` is the probability of the labelled category, ``predicted`` 1 if
    it reaches ``cut_off``.  NULL texts are empty; rows without doc_id are
    scored and never learned from; repeated rows score alike; an empty table
    gives an empty table.  Without labels nothing is called toxic.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                       F.col(f"`{text}`").alias("text"))
    chain = fitted(rows, labels, label, train_rows)
    return probabilities(rows, chain).withColumnRenamed(f"p_{LAST}", "score").withColumn(
        "predicted", (F.col("score") >= F.lit(cut_off)).cast("int"))


def fitted(rows: DataFrame, labels: DataFrame, label: str = "toxic", train_rows: int = TRAIN_ROWS) -> Chain:
    """The chain learned from the labelled ones of rows (doc_id, text)."""
    sample = F.broadcast(labelled_sample(labels, label, train_rows))     # at most ``train_rows`` ids
    known = rows.join(sample, F.col("doc_id") == F.col("labelled_id")).select("doc_id", "label", "text")
    return fit(cut(with_words(known)))


def probabilities(rows: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_<category>...) of rows (doc_id, text)."""
    names = [f"p_{n}" for n in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [chain.probabilities(terms(v.as_py() or "")) for v in batch.column(1)]
            columns = zip(*found) if found else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.float64()) for c in columns], ["doc_id", *names])

    return rows.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, " + ", ".join(f"{n} double" for n in names))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               label: str = "toxic", train_rows: int = TRAIN_ROWS, cut_off: float = CUT_OFF) -> DataFrame:
    """``docs`` without the rows called toxic, all columns kept (see ``scored``)."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                       F.col(f"`{text}`").alias("text"))
    chain = fitted(rows, labels, label, train_rows)

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        return pd.Series([chain.probabilities(terms(t or ""))[-1] for t in texts], dtype="float64")

    return docs.where(toxic(F.col(f"`{text}`")) < F.lit(cut_off))
