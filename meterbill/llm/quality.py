"""Quality classifier: a sparse ensemble of rules.

1. Statistics of each text (counts over its bytes, words and lines; no
   vocabulary, no corpus state).
2. Trees are grown on the labelled rows; every path from a root is a rule: a
   conjunction of thresholds on statistics.
3. A logistic model with an L1 penalty weighs the rules; most get weight 0.
4. The rules left are Spark column expressions, so scoring is a projection.

Learning reads all labelled rows that are not held out (one row of numbers a
document), in Spark; the driver gets the trees and the weights, whose sizes
are set by ``TREES`` and ``DEPTH``.

Defined cases: null text has the statistics of the empty text. A null label is
not learned; repeated labels of a document are all learned. Where no label or
only one value can be learned, or no split, every score is the share of label 1 (0.5
without any). Equal texts get equal scores. An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, held_out, text_key, texts_of

TREES = 12
DEPTH = 4
PENALTY = 0.002
SEED = 17

STATISTICS = ["log_bytes", "log_words", "upper", "digit", "space", "mark", "odd_mark", "exclaim", "pipe", "non_ascii",
              "word_length", "line_words", "short_lines", "repeated_lines", "distinct_words", "top_word",
              "repeated_runs", "ended_words", "shouted_words", "long_words"]


def _share(of: float, total: float) -> float:
    return float(of) / total if total else 0.0


def statistics(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    upper, digit = counts[65:91].sum(), counts[48:58].sum()
    space = counts[[32, 9, 10, 11, 12, 13]].sum()
    mark = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    plain = counts[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum()
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    seen = Counter(words)
    w = len(words)
    top = max(seen.values(), default=0)
    runs = sum(map(str.__eq__, words, words[1:]))
    joined = len(raw) - int(space)
    ended = sum(c for x, c in seen.items() if not x[-1].isalnum())
    shouted = sum(c for x, c in seen.items() if x.isupper() and len(x) > 1)
    long_words = sum(c for x, c in seen.items() if len(x) > 20)
    return [float(np.log1p(n)), float(np.log1p(w)), _share(upper, n), _share(digit, n), _share(space, n), _share(mark, n),
            _share(mark - plain, n), _share(counts[33], n), _share(counts[124], n), _share(counts[128:].sum(), n),
            _share(joined, w), _share(w, len(lines)), _share(sum(len(x) < 20 for x in lines), len(lines)),
            1 - _share(len(set(lines)), len(lines)) if lines else 0.0, _share(len(seen), w), _share(top, w),
            _share(runs, w), _share(ended, w), _share(shouted, w), _share(long_words, w)]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([statistics(t) for t in texts_of(batch)]).reshape(-1, len(STATISTICS))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), *(pa.array(np.ascontiguousarray(rows[:, i])) for i in range(rows.shape[1]))],
            ["doc_id", "key", *STATISTICS])


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, key`` and the statistics of each row."""
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    return rows.mapInArrow(_statistics, "doc_id long, key long, " + ", ".join(f"{s} double" for s in STATISTICS))


Rule = tuple[tuple[str, bool, float], ...]      # (statistic, at most?, threshold), ...


def tree_rules(node, names: list[str], path: Rule = ()) -> list[Rule]:
    """Rules of all nodes below the root, from the JVM node of a tree."""
    if node.subtreeDepth() == 0:
        return []
    split = node.split()
    name, threshold = names[split.featureIndex()], split.threshold()
    found = []
    for child, below in ((node.leftChild(), True), (node.rightChild(), False)):
        rule = (*path, (name, below, threshold))
        found += [rule, *tree_rules(child, names, rule)]
    return found


def simplified(rule: Rule) -> Rule:
    """One upper and one lower bound for each statistic, in a fixed order."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, below, threshold in rule:
        at = (name, below)
        bounds[at] = threshold if at not in bounds else (min if below else max)(bounds[at], threshold)
    return tuple((n, b, t) for (n, b), t in sorted(bounds.items()))


def rule_column(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n) <= t if below else F.col(n) > t for n, below, t in rule])


def learn(rows: DataFrame) -> tuple[list[tuple[Rule, float]], float]:
    """Weighted rules and intercept from ``rows`` (statistics, label 0/1)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    by_label = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}      # two rows
    share = (by_label.get(1.0, 0) + 0.5) / (sum(by_label.values()) + 1)
    prior = float(np.log(share / (1 - share)))
    if len(by_label) < 2:
        return [], prior
    features = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(rows).select("features", "label")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird",
                                    subsamplingRate=0.7, minInstancesPerNode=5).fit(features)
    found = [r for t in forest.trees for r in tree_rules(t._call_java("rootNode"), STATISTICS)]
    rules = sorted({simplified(r) for r in found})
    if not rules:                                  # too few rows for a split
        return [], prior
    named = {f"r{i}": rule_column(r).cast("double") for i, r in enumerate(rules)}
    fired = rows.select("label", *[c.alias(n) for n, c in named.items()])
    fired = VectorAssembler(inputCols=list(named), outputCol="features").transform(fired).select("features", "label")
    model = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, standardization=False, maxIter=60).fit(fired)
    weights = model.coefficients.toArray()
    return [(r, float(w)) for r, w in zip(rules, weights) if w], float(model.intercept)


def score_column(model: tuple[list[tuple[Rule, float]], float]) -> Column:
    """The rules as one column expression: a probability."""
    rules, intercept = model
    total = F.lit(intercept)
    for rule, weight in rules:
        total = total + F.when(rule_column(rule), weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``doc_id, key, score`` and the statistics of each row of ``docs``.
    ``labels``: doc_id and the label column."""
    stats = Scratch(spark, "quality").write(with_statistics(docs), "statistics")
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("label_id"), F.col(label).cast("double").alias("label"))
    model = learn(stats.join(known, stats["doc_id"] == known["label_id"]).select("label", *STATISTICS))
    return stats.withColumn("score", score_column(model))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = classify(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))
