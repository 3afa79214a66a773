"""Toxicity categories by a classifier chain."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import SAMPLE_FILES, even_sample, map_batches, stored

#: Categories in chain order, as conditions on the labels table.
CATEGORIES = {
    "toxic": "toxic = 1",
    "toxic_prose": "toxic = 1 AND quality = 1",
    "toxic_junk": "toxic = 1 AND quality = 0",
}
TRAIN_ROWS = 8_000  # labelled rows the models are fitted on, half of them toxic if there are so many
WORDS = 4_096
LEAST_DOCS = 5
FOLDS = 4
RIDGE = 1.0
STEPS = 120
THRESHOLD = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    """Distinct lower-cased runs of letters of the whole text."""
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class Sparse:
    """Rows of word places and the word weights they count with."""

    places: np.ndarray
    opens: np.ndarray
    scale: np.ndarray

    def __post_init__(self) -> None:
        self.row = np.repeat(np.arange(len(self.opens) - 1), np.diff(self.opens))

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, (weights * self.scale)[self.places], len(self.opens) - 1)

    def turned(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.places, values[self.row], len(self.scale)) * self.scale


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def logistic(
    data: Sparse, extra: np.ndarray, labels: np.ndarray, chosen: np.ndarray, even: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Ridge logistic regression on the chosen rows: word weights; weights of ``extra`` and a constant.

    Accelerated gradient steps. With ``even`` both classes weigh alike.
    """
    dense = np.column_stack([extra, np.ones(len(labels))])
    share = np.bincount(labels[chosen], minlength=2)
    if share.min() == 0:  # one class only: nothing to tell apart
        constant = np.zeros(dense.shape[1])
        constant[-1] = 35.0 if share[1] else -35.0
        return np.zeros(len(data.scale)), constant
    weight = np.where(chosen, 0.5 / share[labels] if even else 1 / share.sum(), 0.0)
    ridge = RIDGE / len(labels)
    size = len(data.scale)
    most = np.bincount(data.row, data.scale[data.places] ** 2, len(labels)) + (dense**2).sum(axis=1)
    rate = 1 / (0.25 * float((weight * most).sum()) + ridge)
    now, before = np.zeros(size + dense.shape[1]), np.zeros(size + dense.shape[1])
    for step in range(STEPS):
        ahead = now + step / (step + 3) * (now - before)
        slope = weight * (_sigmoid(data.times(ahead[:size]) + dense @ ahead[size:]) - labels)
        gradient = np.concatenate([data.turned(slope) + ridge * ahead[:size], dense.T @ slope])
        before, now = now, ahead - rate * gradient
    return now[:size], now[size:]


@dataclass
class Chain:
    """Words with their scale, and per category the weights of words, earlier probabilities and a constant."""

    categories: list[str]
    vocabulary: list[str]
    scale: np.ndarray
    models: list[tuple[np.ndarray, np.ndarray]]

    def probabilities(self, data: Sparse) -> np.ndarray:
        found = np.zeros((len(data.opens) - 1, 0))
        for word_weights, rest in self.models:
            one = _sigmoid(data.times(word_weights) + np.column_stack([found, np.ones(len(found))]) @ rest)
            found = np.column_stack([found, one])
        return found


def fit_chain(data: Sparse, labels: np.ndarray, folds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Models in order; each sees earlier categories' probabilities for rows held out from their fit.

    The first category decides how the sample is drawn, half and half, and its classes weigh
    alike; later ones keep their frequency. With in-sample probabilities a later model would trust the earlier ones more than it
    may when it meets new texts.
    """
    models, earlier = [], np.zeros((len(labels), 0))
    for category in range(labels.shape[1]):
        target = labels[:, category]
        outside = np.zeros(len(target))
        for fold in np.unique(folds):
            held = folds == fold
            if held.all():
                held = np.zeros(len(held), dtype=bool)
            word_weights, rest = logistic(data, earlier, target, ~held, category == 0)
            score = data.times(word_weights) + np.column_stack([earlier, np.ones(len(target))]) @ rest
            outside[folds == fold] = _sigmoid(score)[folds == fold]
        models.append(logistic(data, earlier, target, np.ones(len(target), dtype=bool), category == 0))
        earlier = np.column_stack([earlier, outside])
    return models


def _sparse(rows: list[list[int]], scale: np.ndarray) -> Sparse:
    opens = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    places = np.fromiter((p for r in rows for p in r), np.int64, int(opens[-1]))
    return Sparse(places, opens, scale)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    categories: dict[str, str] | None = None,
    train_rows: int = TRAIN_ROWS,
) -> Chain | None:
    """Chain fitted on at most ``train_rows`` labelled documents; None without any.

    The first category's condition decides which labels are positive; rows where it is
    null do not train. A text that occurs several times trains once.
    """
    categories = categories or CATEGORIES
    first = next(iter(categories.values()))
    marked = labels.select(
        F.col(f"`{id_col}`").cast("bigint").alias("_id"),
        F.expr(first).alias("_first"),
        F.array(*[F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in categories.values()]).alias("_marks"),
    ).filter("_id IS NOT NULL AND _first IS NOT NULL")
    marked = marked.dropDuplicates(["_id", "_first", "_marks"]).withColumn("_deal", F.xxhash64("_id", "_marks"))
    chosen = even_sample(marked, "_first", "_deal", train_rows // 2, 2)
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # the chosen labels number train_rows at most
    joined = texts.filter("text <> ''").join(F.broadcast(chosen), "_id").select("text", "_marks", "_deal")
    texts_once = joined.groupBy("text").agg(F.max(F.struct("_deal", "_marks")).alias("_one"))
    texts_once = texts_once.select("text", "_one._marks", "_one._deal").orderBy("_deal", "text").limit(train_rows)
    sample = stored(texts_once.repartition(SAMPLE_FILES), "toxicity-sample")

    def distinct_words():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [sorted(words(t)) for t in batch.column("text").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]).astype(np.int64))
            listed = pa.array([w for f in found for w in f], pa.string())
            mark = _first_mark(batch.column("_marks")).take(at)
            return pa.RecordBatch.from_arrays([listed, mark], ["word", "mark"])

        return step

    counted = (
        map_batches(sample, "word string, mark int", distinct_words)
        .groupBy("word").agg(F.count("*").alias("n"), F.sum("mark").alias("t")).filter(F.col("n") >= LEAST_DOCS)
    )
    totals = sample.agg(F.count("*").alias("n"), F.sum(F.get("_marks", F.lit(0))).alias("t")).first()
    if not totals.n:
        return None
    odds = F.log((F.col("t") + 0.5) / (totals.t + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (totals.n - totals.t + 1))
    telling = F.abs(odds) * F.sqrt("n")
    vocabulary = sorted(
        (r.word, r.odds) for r in counted.select("word", odds.alias("odds"), telling.alias("telling"))
        .orderBy(F.desc("telling"), "word").limit(WORDS).collect()
    )
    number = {w: i for i, (w, _) in enumerate(vocabulary)}

    def places():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [sorted(number[w] for w in words(t) if w in number) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column("_marks"), batch.column("_deal")], ["places", "marks", "deal"]
            )

        return step

    rows = map_batches(sample, "places array<int>, marks array<int>, deal bigint", places).collect()
    rows.sort(key=lambda r: (r.deal, r.places))
    scale = np.array([abs(o) for _, o in vocabulary]) if vocabulary else np.zeros(0)
    data = _sparse([r.places for r in rows], scale)
    marks = np.array([r.marks for r in rows], dtype=np.int64)
    folds = np.array([r.deal % FOLDS for r in rows])
    return Chain(list(categories), [w for w, _ in vocabulary], scale, fit_chain(data, marks, folds))


def _first_mark(lists: pa.Array) -> pa.Array:
    """First element of each list."""
    return pa.array([m[0] for m in lists.to_pylist()], pa.int32())


def predict(
    docs: DataFrame, chain: Chain | None, id_col: str = "doc_id", text_col: str = "text",
    categories: dict[str, str] | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row ``doc_id``, ``p_<category>`` and ``<category>`` (probability at least ``threshold``).

    Categories are predicted in order from the whole text's words and the probabilities
    before. A null text, one without a word, and any text without a chain has
    probability 0. Null and repeated ids keep their rows, an empty table gives an empty
    result, and other columns are not read.
    """
    names = list(categories or CATEGORIES)

    def make():
        number = {w: i for i, w in enumerate(chain.vocabulary)} if chain else {}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, silent = [], []
            for text in batch.column(1):  # one at a time: a batch's words would fill the memory
                found = words(text.as_py())
                rows.append([number[w] for w in found if w in number])
                silent.append(not found)
            values = np.zeros((len(rows), len(names)))
            if chain and rows:
                values = chain.probabilities(_sparse(rows, chain.scale))
                values[silent] = 0
            columns = [pa.array(values[:, i]) for i in range(len(names))]
            flags = [pa.array(values[:, i] >= threshold) for i in range(len(names))]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, *flags], ["doc_id", *[f"p_{n}" for n in names], *names]
            )

        return step

    schema = ", ".join(["doc_id bigint", *[f"p_{n} double" for n in names], *[f"{n} boolean" for n in names]])
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_batches(rows, schema, make)
