"""Quality classifier: a sparse ensemble of rules from trees.

1. *Statistics.*  One narrow pass turns every whole text into a few numbers:
   sizes, shares of kinds of characters and words, repetition.
2. *Rules.*  A random forest is fitted to a bounded sample of labelled rows.
   Every path from a root to a node is a rule, a conjunction of bounds on
   statistics; bounds of one statistic are merged and equal rules dropped.
3. *Weights.*  A logistic regression with a lasso penalty on the rules (0 or 1
   each) leaves most of them out.
4. *Scoring.*  The rules left, with their weights, are compiled into one Spark
   column expression over the statistics.

Labels, language, source and id are never statistics.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import cut
from tabula.llm.training import held_out, labelled_sample

#: Labelled rows that the classifier is fitted to, at most.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 24, 3, 17
#: Weight of the lasso penalty.
LASSO = 0.002
#: Lowest score of a predicted label 1.
CUT_OFF = 0.7

SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
DIGITS = b"0123456789"
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
SPACES = b" \t\n\r\x0b\x0c"
#: Names of the statistics, in order.
STATISTICS = ("n_chars", "n_words", "word_length", "longest_word", "upper", "digits", "marks", "symbols",
              "spaces", "upper_words", "marked_words", "distinct_words", "same_neighbours",
              "repeated_windows", "n_lines", "line_words", "distinct_lines", "exclaimed", "closed_lines")
MARKED = re.compile(r"(?:\*{2,}|#{2,}|\${2,}|%{2,}|&{2,}|!{2,}|\|+)(?=\s|$)")


def statistics(text: str) -> tuple[float, ...]:
    """The numbers named in STATISTICS; shares are 0 where there is nothing to share."""
    raw, words = text.encode("utf-8", "surrogatepass"), text.split()
    n, w = max(1, len(raw)), max(1, len(words))
    count = lambda kind: len(raw) - len(raw.translate(None, kind))
    upper, lower = count(UPPER), count(LOWER)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    windows = max(1, len(words) - 2)
    return (len(text), len(words), sum(map(len, words)) / w, max(map(len, words), default=0),
            upper / max(1, upper + lower), count(DIGITS) / n, count(MARKS) / n, count(SYMBOLS) / n,
            count(SPACES) / n, sum(map(str.isupper, words)) / w, len(MARKED.findall(text)) / w,
            len(set(words)) / w, sum(map(eq, words, words[1:])) / w,
            1 - len(set(zip(words, words[1:], words[2:]))) / windows if len(words) > 2 else 0.0,
            len(lines), w / max(1, len(lines)), len(set(lines)) / max(1, len(lines)),
            raw.count(b"!") / w, sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / max(1, len(lines)))


def with_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, one double a statistic) of every row; NULL texts are empty."""
    fields = ["doc_id", *STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(value.as_py() or "") for value in batch.column(1)]
            columns = zip(*rows) if rows else [[] for _ in STATISTICS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.float64()) for c in columns], fields)

    return docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                       F.col(f"`{text}`").alias("text")).mapInArrow(
        run, "doc_id bigint, " + ", ".join(f"{s} double" for s in STATISTICS))


# ------------------------------------------------------------------- rules

@dataclass(frozen=True)
class Rule:
    """Bounds (statistic, lower excluded, upper included) that all must hold."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, low, high in self.bounds:
            if low > float("-inf"):
                out = out & (F.col(name) > F.lit(low))
            if high < float("inf"):
                out = out & (F.col(name) <= F.lit(high))
        return out

    def narrowed(self, name: str, low: float, high: float) -> Rule:
        bounds = {n: (a, b) for n, a, b in self.bounds}
        a, b = bounds.get(name, (float("-inf"), float("inf")))
        bounds[name] = (max(a, low), min(b, high))
        return Rule(tuple((n, *bounds[n]) for n in sorted(bounds)))


CONDITION = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.eEinfInfity]+)\)")


def rules_of(forest: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """Every path of a fitted forest's printed trees, inner nodes included, each once."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, Rule]] = []
    for line in forest.splitlines():
        m = CONDITION.match(line)
        if m is None:
            if "Tree" in line:
                path = []
            continue
        depth, name, value = len(m[1]), names[int(m[2])], float(m[4])
        while path and path[-1][0] >= depth:
            path.pop()
        above = path[-1][1] if path else Rule(())
        low, high = (float("-inf"), value) if m[3] == "<=" else (value, float("inf"))
        rule = above.narrowed(name, low, high)
        path.append((depth, rule))
        found[rule] = None
    return list(found)


@dataclass(frozen=True)
class Ensemble:
    """Rules with weights, and the intercept."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        """The probability of label 1 as a column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO,
        seed: int = SEED) -> Ensemble:
    """The ensemble of a bounded frame (statistics, label).

    Without both labels the score is the same for all texts: 1, 0, or 0.5
    without any label.
    """
    share = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        only = next(iter(share), None)
        return Ensemble((), 0.0 if only is None else (50.0 if only else -50.0))
    data = rows.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxBins=64,
                                    featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(data)
    rules = rules_of(forest.toDebugString)
    fired = rows.select("label", array_to_vector(F.array(
        *[r.column().cast("double") for r in rules])).alias("features"))
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False,
                               maxIter=40).fit(cut(fired))
    weights = model.coefficients.toArray()
    kept = tuple((r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-9)
    return Ensemble(kept, float(model.intercept))


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
           label: str = "quality", train_rows: int = TRAIN_ROWS, cut_off: float = CUT_OFF) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Learned from labelled rows that are not held out, at most ``train_rows``.
    NULL and empty texts are scored by their statistics like any other; rows
    without doc_id are scored, not held out and never learned from; repeated
    rows score alike; an empty table gives an empty table.
    """
    found = cut(with_statistics(docs, doc_id, text))
    sample = F.broadcast(labelled_sample(labels, label, train_rows, without_held_out=True))
    known = cut(found.join(sample, F.col("doc_id") == F.col("labelled_id"))
                .select("label", *STATISTICS).orderBy("label", *STATISTICS).coalesce(1))
    ensemble = fit(known)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        ensemble.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= F.lit(cut_off)).cast("int"))
