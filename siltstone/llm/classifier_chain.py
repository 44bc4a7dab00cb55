"""Toxicity by a classifier chain (operator 1).

The categories are predicted one after another, each by a logistic regression over word features and the
probabilities of the categories before it. For training, those probabilities are predicted out of fold: by
models that haven't seen the document. The models for prediction are then fitted on all training rows.

Features are the distinct words of a text and their first letters, which insults with endings have in common.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import ascii_lower, materialize, prepared

_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_EVERY = "\n"  # a feature that every text has, so that the vocabulary is never empty


@dataclass(frozen=True)
class Training:
    """sample_rows labelled rows are learned from, at about; they are chosen by a hash of the id, so that a row's place
    doesn't matter. vocabulary features that occur in min_documents of them at least are used, stems of `stem` letters."""

    sample_rows: int = 20_000
    folds: int = 3
    vocabulary: int = 20_000
    min_documents: int = 5
    stem: int = 4
    regularisation: float = 1e-3
    iterations: int = 25
    threshold: float = 0.5


@dataclass
class Chain:
    categories: list[str]
    terms: CountVectorizerModel | None = None
    models: list[LogisticRegressionModel] = field(default_factory=list)


def _terms(text: Column, stem: int) -> Column:
    words = F.array_distinct(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _GAPS))
    stems = F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) > stem), lambda w: F.concat(F.substring(w, 1, stem), F.lit("*"))))
    return F.concat(F.array(F.lit(_EVERY)), words, stems)


def _vocabulary(rows: DataFrame, training: Training, count: int) -> list[str]:
    """The terms of most documents, of equally frequent ones the smaller, so that the model doesn't depend on how rows are dealt."""
    found = rows.select(F.explode("_t").alias("term")).groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= min(training.min_documents, count))
    return [r.term for r in found.orderBy(F.desc("n"), "term").limit(training.vocabulary).collect()]  # so many terms of the sample


def _with_inputs(rows: DataFrame, place: int) -> DataFrame:
    """The column `x`: word features and the probabilities p0 ... of the categories before `place`."""
    return VectorAssembler(inputCols=["_f", *[f"p{i}" for i in range(place)]], outputCol="_x").transform(rows)


def _predict(model: LogisticRegressionModel, rows: DataFrame, place: int) -> DataFrame:
    out = model.transform(_with_inputs(rows, place))
    return out.withColumn(f"p{place}", vector_to_array("_probability")[1]).drop("_x", "_raw", "_probability", "_prediction")


def fit(texts: DataFrame, categories: list[str], training: Training = Training()) -> Chain:
    """A chain over the 0/1 columns `categories` of `texts` (doc_id, text and those; null labels count as 0).

    Null and empty texts are rows without words. Which rows are sampled and in which fold they are is decided by their id, so repeated
    rows stay together; ties at the end of the vocabulary go to the smaller term. Without rows the chain has no models."""
    prepared(texts.sparkSession)
    chain, count = Chain(categories), texts.count()
    if not count:
        return chain
    turn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = texts.where(turn < min(1.0, training.sample_rows / count)).select(
        F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(training.folds)).alias("_fold"), _terms(F.col("text"), training.stem).alias("_t"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"y{i}") for i, c in enumerate(categories)])
    rows = materialize(rows, "op1-sample")
    rows_there = rows.count()
    if not rows_there:
        return chain
    chain.terms = CountVectorizerModel.from_vocabulary(_vocabulary(rows, training, rows_there), "_t", "_f", binary=True)
    rows = materialize(chain.terms.transform(rows).drop("_t"), "op1-features")
    for place in range(len(categories)):
        learner = LogisticRegression(featuresCol="_x", labelCol=f"y{place}", predictionCol="_prediction", probabilityCol="_probability",
                                     rawPredictionCol="_raw", regParam=training.regularisation, maxIter=training.iterations, family="binomial")
        inputs = _with_inputs(rows, place)
        chain.models.append(learner.fit(inputs))
        if place + 1 < len(categories):
            parts = None
            for fold in range(training.folds):
                inside, rest = rows.where(F.col("_fold") == fold), inputs.where(F.col("_fold") != fold)
                model = learner.fit(rest) if not rest.isEmpty() else chain.models[-1]
                part = _predict(model, inside, place)
                parts = part if parts is None else parts.unionByName(part)
            rows = materialize(parts, "op1-out-of-fold")
    return chain


def score(docs: DataFrame, chain: Chain, training: Training = Training()) -> DataFrame:
    """doc_id, then p_<category> and is_<category> for each category, of every row of `docs`.

    Null and empty texts are judged by the intercept. Without a labelled row the probabilities are
    null and nothing is flagged. Texts are read whole; repeated rows are alike; an empty table gives no rows; other columns don't matter.
    """
    if chain.terms is None:
        return docs.select("doc_id", *[x for c in chain.categories for x in (F.lit(None).cast("double").alias(f"p_{c}"), F.lit(False).alias(f"is_{c}"))])
    rows = chain.terms.transform(docs.select("doc_id", _terms(F.col("text"), training.stem).alias("_t"))).drop("_t")
    for place, model in enumerate(chain.models):
        rows = _predict(model, rows, place)
    return rows.select("doc_id", *[x for i, c in enumerate(chain.categories) for x in (
        F.col(f"p{i}").alias(f"p_{c}"), (F.col(f"p{i}") >= training.threshold).alias(f"is_{c}"))])
