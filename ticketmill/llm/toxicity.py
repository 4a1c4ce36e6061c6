"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other. A later category's model sees the
words of a text and the probabilities of the categories before it. In training
these are out-of-fold predictions: a row's probability comes from a model that
was fitted without the row's fold, so that the later model learns from the kind
of errors that it meets in use. The table of labels has two columns, and the
chain has two links: ``low_quality``, then ``toxic``.

Models are logistic regressions over the words and word beginnings that a text
has. They are fitted
on at most about ``sample`` labelled rows (chosen by a hash of the id), one Spark
task for each fold. A model is the sorted hashes of the words that occur in
enough rows of the sample, and their weights; that bounds what is sent to the
tasks. All documents are scored, whole.

Defined results: a null or empty text has no words and gets the models'
constants; a null label leaves a row out for that category; of rows with one id
one is trained on; documents and labels without id are scored and not trained
on; without any labels every probability is 0.5 and nothing is flagged; an empty
table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm.common import small_batches, staged

#: The chain: name, column of the table of labels, value that counts as positive.
CHAIN = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
SAMPLE = 8_000
FOLDS = 3
#: A word has a weight when it is in so many rows of the sample.
MIN_ROWS = 6
#: Letters of the word beginnings that count as well.
BEGINNINGS = (4, 5)
STEPS, RATE, DECAY = 120, 0.15, 1e-3

_LETTERS = re.compile(r"[^\W\d_]+")


def _word_hashes(texts: list[str | None], known: dict[str, list[int]]) -> list[np.ndarray]:
    """The distinct words and word beginnings of each text, as signed 64-bit hashes in order."""
    out = []
    if len(known) > 500_000:
        known.clear()
    for text in texts:
        flat: list[int] = []
        for word in set(_LETTERS.findall((text or "").lower())):
            hashes = known.get(word)
            if hashes is None:
                # Beginnings stand for the forms of a word.
                parts = [word, *(f"^{word[:n]}" for n in BEGINNINGS if len(word) >= n)]
                hashes = known[word] = [xxhash.xxh64_intdigest(part) - 2**63 for part in parts]
            flat += hashes
        out.append(np.unique(np.array(flat, np.int64)))
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list[int]] = {}
    for batch in batches:
        hashes = _word_hashes(batch.column(batch.num_columns - 1).to_pylist(), known)
        ends = np.concatenate([[0], np.cumsum([len(h) for h in hashes])]).astype(np.int32)
        words = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *hashes])))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], words], names=[*batch.schema.names[:-1], "words"])


class Linear:
    """Weights of words and of earlier categories' probabilities, and a constant."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, chain: np.ndarray, constant: float):
        self.words, self.weights, self.chain, self.constant = words, weights, chain, constant

    @classmethod
    def fit(cls, rows: list[np.ndarray], earlier: np.ndarray, labels: np.ndarray) -> Linear:
        """Logistic regression with balanced classes, by Adam over all rows at once."""
        sizes = np.array([len(r) for r in rows], np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *rows])
        vocabulary, at, count = np.unique(flat, return_inverse=True, return_counts=True)
        often = count >= MIN_ROWS
        place = np.cumsum(often) - 1
        use = often[at]
        words, column = vocabulary[often], place[at][use]
        row = np.repeat(np.arange(len(rows)), sizes)[use]
        n, wide = len(rows), len(words)
        if not n:
            return cls(words, np.zeros(0), np.zeros(earlier.shape[1]), 0.0)
        positive = labels == 1
        share = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1))
        extra = np.column_stack([earlier - 0.5, np.ones(n)])
        theta = np.zeros(wide + extra.shape[1])
        first, second = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, STEPS + 1):
            z = np.bincount(row, theta[column], minlength=n) + extra @ theta[wide:]
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - positive) * share
            gradient = np.concatenate([np.bincount(column, error[row], minlength=wide), extra.T @ error])
            gradient += DECAY * theta
            first = 0.9 * first + 0.1 * gradient
            second = 0.99 * second + 0.01 * gradient**2
            rate = RATE * min(1.0, 2 - 2 * step / STEPS)
            theta -= rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-7)
        return cls(words, theta[:wide], theta[wide:-1], float(theta[-1]))

    def predict(self, rows: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
        z = np.full(len(rows), self.constant) + (earlier - 0.5) @ self.chain
        if len(self.words):
            flat = np.concatenate([np.zeros(0, np.int64), *rows])
            at = np.minimum(np.searchsorted(self.words, flat), len(self.words) - 1)
            weight = np.where(self.words[at] == flat, self.weights[at], 0.0)
            z += np.bincount(np.repeat(np.arange(len(rows)), [len(r) for r in rows]), weight, minlength=len(rows))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def dump(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, words=self.words, weights=self.weights, chain=self.chain, constant=self.constant)
        return file.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Linear:
        arrays = np.load(io.BytesIO(data))
        return cls(arrays["words"], arrays["weights"], arrays["chain"], float(arrays["constant"]))


def best_threshold(p: np.ndarray, labels: np.ndarray) -> float:
    """The probability above which flags have the best F1 score; 0.5 without positive labels.

    It lies halfway to the next lower probability, so that it is never at an end of the scale.
    """
    if not (labels == 1).any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(labels[order] == 1)
    last = np.append(p[1:] != p[:-1], True)
    f1 = np.where(last, 2 * hits / (np.arange(1, len(p) + 1) + hits[-1]), 0)
    best = int(np.argmax(f1))
    return float((p[best] + (p[best + 1] if best + 1 < len(p) else 0.0)) / 2)


def _lists(column: pa.Array) -> list[np.ndarray]:
    offsets, values = np.asarray(column.offsets), np.asarray(column.values)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _matrix(column: pa.Array, wide: int) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), wide)


def _fit(wide: int):
    """Fits one fold's model on the other folds' rows and predicts the fold's own; the fold -1 is fitted on all rows."""

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id").combine_chunks()
        job = table["job"][0].as_py()
        fold, label = np.asarray(table["fold"]), table["label"].to_numpy(zero_copy_only=False).astype(float)
        rows, earlier = _lists(table["words"].chunk(0)), _matrix(table["earlier"], wide)
        train = (fold != job) & ~np.isnan(label)
        pick = np.flatnonzero(train)
        model = Linear.fit([rows[i] for i in pick], earlier[pick], label[pick])
        own = np.flatnonzero(fold == job)
        p = model.predict([rows[i] for i in own], earlier[own])
        out = {"doc_id": table["doc_id"].take(pa.array(own)).combine_chunks(), "p": pa.array(p), "model": pa.nulls(len(own), pa.binary())}
        if job < 0:
            out = {"doc_id": pa.array([None], pa.int64()), "p": pa.array([None], pa.float64()), "model": pa.array([model.dump()], pa.binary())}
        return pa.table(out)

    return fit


def fit_chain(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    chain: tuple[tuple[str, str, int], ...] = CHAIN, sample: int = SAMPLE, folds: int = FOLDS,
) -> list[tuple[bytes, float]]:
    """The serialised models of the chain's categories, in order, each with the threshold that does best out of fold."""
    small_batches(spark)
    label = [F.max(F.when(F.col(c).isNotNull(), (F.col(c) == v).cast("double"))).alias(f"label_{i}") for i, (_, c, v) in enumerate(chain)]
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(*label)
    marked = staged(spark, marked, "labels")
    total = marked.count()
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000))
    # At most about ``sample`` rows, whatever the table has.
    marked = staged(spark, marked.where(draw < min(1.0, sample / max(total, 1)) * 1_000_000), "sample")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = [f"label_{i}" for i in range(len(chain))]
    rows = texts.join(marked, "doc_id").select("doc_id", *names, "text")
    kinds = ", ".join(f"{n} double" for n in names)
    rows = rows.mapInArrow(_features, f"doc_id bigint, {kinds}, words array<bigint>")
    # One row for an id, also where the id is there many times.
    rows = rows.groupBy("doc_id").agg(*[F.first(c).alias(c) for c in (*names, "words")])
    rows = rows.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(folds)).cast("int"))
    rows = staged(spark, rows.withColumn("earlier", F.array().cast("array<double>")), "training")
    models, wordless = [], np.zeros((1, 0))
    for i, name in enumerate(names):
        jobs = F.explode(F.array(*map(F.lit, [-1, *range(folds)])))
        work = rows.withColumn("job", jobs).select("job", "doc_id", "fold", "words", "earlier", F.col(name).alias("label"))
        # A group is the sample, which is bounded.
        fitted = work.groupBy("job").applyInArrow(_fit(i), "doc_id bigint, p double, model binary")
        fitted = staged(spark, fitted, "fitted")
        found = fitted.where("model is not null").select("model").first()
        model = bytes(found.model) if found else Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(i), 0.0).dump()
        p = fitted.where("model is null").select("doc_id", "p")
        judged = p.join(rows.select("doc_id", F.col(name).alias("label")), "doc_id").where("label is not null").select("p", "label").collect()
        best = best_threshold(np.array([r.p for r in judged]), np.array([r.label for r in judged]))
        # A text without any words is never flagged.
        wordless = np.column_stack([wordless, Linear.load(model).predict([np.zeros(0, np.int64)], wordless)])
        models.append((model, max(best, float(wordless[0, -1]))))
        if i + 1 < len(names):
            grown = rows.join(p, "doc_id").withColumn("earlier", F.concat("earlier", F.array("p"))).drop("p")
            rows = staged(spark, grown, "training")
    return models


def _score(sent, wide: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [Linear.load(m) for m in sent.value]
        known: dict[str, list[int]] = {}
        for batch in batches:
            rows = _word_hashes(batch.column(1).to_pylist(), known)
            earlier = np.zeros((len(rows), 0))
            for model in models:
                earlier = np.column_stack([earlier, model.predict(rows, earlier)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(earlier[:, i]) for i in range(wide))], names=["doc_id", *(f"p{i}" for i in range(wide))]
            )

    return score


def scored(
    spark: SparkSession, docs: DataFrame, models: list[tuple[bytes, float]], id_col: str = "doc_id", text_col: str = "text",
    chain: tuple[tuple[str, str, int], ...] = CHAIN,
) -> DataFrame:
    """``doc_id``, ``p_<category>`` of each category, and the last category's flag under its own name."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast([model for model, _ in models])
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kinds = ", ".join(f"p{i} double" for i in range(len(chain)))
    found = rows.mapInArrow(_score(sent, len(chain)), f"doc_id bigint, {kinds}")
    named = [F.col(f"p{i}").alias(f"p_{name}") for i, (name, _, _) in enumerate(chain)]
    return found.select("doc_id", *named, (F.col(f"p{len(chain) - 1}") > models[-1][1]).alias(chain[-1][0]))
