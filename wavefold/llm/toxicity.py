"""Toxicity by a chain of linear classifiers (operator 6).

Categories are predicted one after the other; the model of each category sees
the words of the document and the probabilities of the categories before it. In
training those probabilities are out-of-fold, so a later model learns from
predictions as good as it will get, not from ones made on their own labels.

Method: a bounded sample of the labelled documents (the FIT_DOCUMENTS with the
smallest hash of their id, equal texts once) is joined to its texts in Spark.
Features are the presence of words and word beginnings, once and more than
once; Spark counts in how many
labelled documents of either kind each one occurs, and those with the largest
G-statistic for any category are used. The sample then is a small sparse 0/1
matrix, on which logistic models with an L2 penalty are fitted by accelerated
gradient steps. All documents are scored in one pass without a shuffle.

Defined cases: a null or empty text has no features and gets the chain's
base rates; label rows with a null id or a null label are left out; of repeated
labels the largest counts; a category with fewer than MIN_CASES cases on either
side, and every category without labelled texts, has its base rate as a constant
(zero without cases); repeated rows are scored one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavefold.llm.common import Memo, drop_worker_state, id_text, rows_of, slices, stored

#: Bound of the sample that models are fitted on.
FIT_DOCUMENTS = 12_000
#: Features kept for each category, the labelled documents a feature must be in, and the share it may be in:
#: what a fifth of all documents have, and more than are of any category, tells their language or length.
FEATURES, MIN_DOCUMENTS, MAX_SHARE = 512, 5, 0.2
MIN_CASES = 10
FOLDS = 4
BEGINNINGS = (4, 5, 6)
PENALTY, STEPS = 0.1, 400
THRESHOLD = 0.3
TWICE = " 2"
MEMO_WORDS = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """Of a lower-case word: itself (=), and its beginnings (^)."""
    return ["=" + word, *("^" + word[:k] for k in BEGINNINGS if len(word) >= k)]


def features(text: str | None) -> set[str]:
    """Features of the words of a text; those that two or more words have, also doubled."""
    counts: Counter[str] = Counter()
    for word, n in Counter(_WORD.findall((text or "").lower())).items():
        for f in word_features(word):
            counts[f] += n
    return {*counts, *(f + TWICE for f, n in counts.items() if n > 1)}


@dataclass(frozen=True)
class Chain:
    """Fitted models: for each category (name, bias, weights of the features, weights of earlier probabilities)."""

    names: tuple[str, ...]
    feature_no: Mapping[str, int]
    models: tuple[tuple[float, np.ndarray, np.ndarray], ...]

    def probabilities(self, rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
        """(n, categories) for a sparse 0/1 matrix."""
        out = np.zeros((n, len(self.names)))
        for j, (bias, w, chained) in enumerate(self.models):
            out[:, j] = _sigmoid(bias + np.bincount(rows, w[columns], n) + out[:, :j] @ chained)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _fit(rows: np.ndarray, columns: np.ndarray, earlier: np.ndarray, y: np.ndarray, width: int
         ) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic model on a sparse 0/1 matrix and dense earlier probabilities; the bias is not penalised."""
    n, more = earlier.shape
    if min(y.sum(), n - y.sum()) < MIN_CASES:
        rate = y.mean() if n else 0.0
        bias = np.log(rate / (1 - rate)) if 0 < rate < 1 else 35.0 * (2 * rate - 1)
        return float(bias), np.zeros(width), np.zeros(more)
    # largest curvature, by power iteration on a quarter of the Gram matrix
    v = np.ones(1 + width + more)
    for _ in range(30):
        v /= np.linalg.norm(v)
        xv = v[0] + np.bincount(rows, v[1:1 + width][columns], n) + earlier @ v[1 + width:]
        v = np.concatenate(([xv.sum()], np.bincount(columns, xv[rows], width), earlier.T @ xv))
    curvature = 0.26 * float(np.linalg.norm(v)) + PENALTY
    w = np.zeros(1 + width + more)
    w[0] = np.log(y.mean() / (1 - y.mean()))
    ahead, t = w.copy(), 1.0
    for _ in range(STEPS):
        p = _sigmoid(ahead[0] + np.bincount(rows, ahead[1:1 + width][columns], n) + earlier @ ahead[1 + width:])
        r = p - y
        g = np.concatenate(([r.sum()], np.bincount(columns, r[rows], width), earlier.T @ r))
        g[1:] += PENALTY * ahead[1:]
        new = ahead - g / curvature
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:1 + width], w[1 + width:]


def _fit_chain(names: list[str], feature_no: dict[str, int], rows: np.ndarray, columns: np.ndarray, labels: np.ndarray) -> Chain:
    n, width = len(labels), len(feature_no)
    fold = np.arange(n) % FOLDS  # rows come in the order of a hash
    earlier, models = np.zeros((n, 0)), []
    for j in range(len(names)):
        y = labels[:, j].astype(float)
        models.append(_fit(rows, columns, earlier, y, width))
        out_of_fold = np.zeros(n)
        for k in range(FOLDS):
            held, kept = fold == k, fold != k
            place = np.cumsum(kept) - 1
            here = kept[rows]
            bias, w, chained = _fit(place[rows[here]], columns[here], earlier[kept], y[kept], width)
            scores = _sigmoid(bias + np.bincount(rows, w[columns], n) + earlier @ chained)
            out_of_fold[held] = scores[held]
        earlier = np.column_stack((earlier, out_of_fold))
    return Chain(tuple(names), feature_no, tuple(models))


def fit(docs: DataFrame, labels: DataFrame, categories: Mapping[str, Column], *, id_col: str = "doc_id",
        text_col: str = "text", fit_documents: int = FIT_DOCUMENTS) -> Chain:
    """A chain for ``categories``: name -> boolean column over ``labels`` (which has ``id_col``)."""
    names = list(categories)
    key = F.col("__id")
    ys = [f"__y{j}" for j in range(len(names))]
    given = labels.select(labels[id_col].cast("long").alias("__id"), *(c.cast("int").alias(y) for c, y in zip(categories.values(), ys)))
    given = given.dropna().groupBy(key).agg(*(F.max(y).alias(y) for y in ys))
    sample = given.orderBy(F.xxhash64(key), key).limit(fit_documents)  # bounded, so it may be broadcast
    texts = id_text(docs, id_col, text_col).join(F.broadcast(sample), F.col("doc_id") == key).groupBy(
        F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"), F.min("doc_id").alias("doc_id"),
                                           *(F.max(y).alias(y) for y in ys)).persist()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for columns in rows_of(batches, "text", *ys):
            for text, *y in zip(*columns):
                found = sorted(features(text))
                yield pa.RecordBatch.from_pydict({"feature": pa.array(found, pa.string())} | {
                    n: pa.array([v] * len(found), pa.int32()) for n, v in zip(ys, y)})

    schema = "feature string, " + ", ".join(f"{y} int" for y in ys)
    totals = texts.agg(F.count("*").alias("n"), *(F.coalesce(F.sum(y), F.lit(0)).alias(y) for y in ys)).first()
    counted = stored(texts.mapInArrow(listed, schema).groupBy("feature").agg(
        F.count("*").alias("n"), *(F.sum(y).alias(y) for y in ys)).filter(
        F.col("n").between(MIN_DOCUMENTS, max(MIN_DOCUMENTS, MAX_SHARE * totals["n"], 1.2 * max(totals[y] for y in ys)))),
        "toxicity-features")

    def cell(observed: Column, expected: Column) -> Column:
        return F.when((observed > 0) & (expected > 0), observed * F.log(observed / expected)).otherwise(0.0)

    chosen: set[str] = set()
    for y in ys:
        if not min(totals[y], totals["n"] - totals[y]):
            continue
        share = totals[y] / totals["n"]
        a, n = F.col(y).cast("double"), F.col("n").cast("double")
        absent, cases = F.lit(float(totals["n"])) - n, F.lit(float(totals[y]))
        g = (cell(a, n * share) + cell(n - a, n * (1 - share)) + cell(cases - a, absent * share)
             + cell(absent - cases + a, absent * (1 - share)))
        chosen |= {r.feature for r in counted.orderBy(F.round(g, 6).desc(), "feature").limit(FEATURES).collect()}
    feature_no = {f: k for k, f in enumerate(sorted(chosen))}

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch_h, batch_texts, *y in rows_of(batches, "h", "text", *ys):
            found = [sorted(feature_no[f] for f in features(t) if f in feature_no) for t in batch_texts]
            yield pa.RecordBatch.from_pydict({"h": pa.array(batch_h, pa.int64()), "f": pa.array(found, pa.list_(pa.int32()))}
                                             | {n: pa.array(v, pa.int32()) for n, v in zip(ys, y)})

    matrix = texts.mapInArrow(indexed, "h long, f array<int>, " + ", ".join(f"{y} int" for y in ys)).collect()
    texts.unpersist()
    matrix.sort(key=lambda r: r.h)
    rows = np.repeat(np.arange(len(matrix)), [len(r.f) for r in matrix]) if matrix else np.zeros(0, np.int64)
    columns = np.array([k for r in matrix for k in r.f], np.int64)
    y = np.array([[r[c] for c in ys] for r in matrix], np.int64).reshape(len(matrix), len(names))
    return _fit_chain(names, feature_no, rows.astype(np.int64), columns, y)


class Scorer:
    """Texts to probabilities; remembers the features of words."""

    def __init__(self, chain: Chain):
        self.chain = chain
        self.memo = Memo(MEMO_WORDS)

    def _of_word(self, word: str) -> tuple[str, ...]:
        """Those features of a word that the chain uses, once or doubled."""
        found = self.memo.older.get(word)
        if found is None:
            number = self.chain.feature_no
            found = tuple(f for f in word_features(word) if f in number or f + TWICE in number)
        self.memo.put(word, found)
        return found

    def scores(self, texts: list[str]) -> np.ndarray:
        rows: list[int] = []
        columns: list[int] = []
        known, number = self.memo.known.get, self.chain.feature_no.get
        for k, text in enumerate(texts):
            counts: dict[str, int] = {}
            for w in _WORD.findall(text.lower()):
                found = known(w)
                if found is None:
                    found = self._of_word(w)
                for f in found:
                    counts[f] = counts.get(f, 0) + 1
            here = [number(f) for f in counts] + [number(f + TWICE) for f, n in counts.items() if n > 1]
            here = sorted(c for c in here if c is not None)
            rows += [k] * len(here)
            columns += here
        return self.chain.probabilities(np.array(rows, np.int64), np.array(columns, np.int64), len(texts))


def score(docs: DataFrame, chain: Chain, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: doc_id and ``p_<category>`` for every category."""
    columns = [f"p_{n}" for n in chain.names]
    held = docs.sparkSession.sparkContext.broadcast(chain)  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        scorer = Scorer(held.value)
        for ids, texts in rows_of(batches, "doc_id", "text"):
            p = scorer.scores(texts)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64())} | {
                c: pa.array(p[:, j]) for j, c in enumerate(columns)})

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} double" for c in columns))


def keep_civil(docs: DataFrame, chain: Chain, category: str, threshold: float = THRESHOLD, *, text_col: str = "text") -> DataFrame:
    """``docs``, same columns, without rows whose probability of the category reaches the threshold."""
    held, j = docs.sparkSession.sparkContext.broadcast(chain), chain.names.index(category)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        scorer = Scorer(held.value)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield batch.filter(pa.array(scorer.scores(texts)[:, j] < threshold))

    return docs.mapInArrow(run, docs.schema)
