"""Language identification by a blended-spectrum string kernel."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import SAMPLE_FILES, map_batches, stored

UNDETERMINED = "und"
LONGEST = 4  # n-grams of 1 to so many characters
BUCKETS = 1 << 18
LANDMARKS = 96
TRAIN_ROWS = 6_000
LEAST_LANDMARKS = 2  # of each language, until there are MOST_LANDMARKS
MOST_LANDMARKS = 1024  # in all; with more languages than that, not each has one
COUNTED_LANGUAGES = 10_000  # up to which their counts are broadcast, half a megabyte
LEAST_ROWS = 16  # to train each language on, however many there are
_DENSE = 256  # landmarks up to which a table of all n-grams by all landmarks is held
RIDGE = 1e-3
FAMILIAR_ROWS = 200  # texts of a language that tell how its words are spelt
_PRIOR = 3.0  # evidence, in nats, that every text is given, so that a few odd letters prove nothing
_SURPRISE = 2.0  # nats that one letter may cost at most, as one never met before does
_SMOOTH = 2.0  # occurrences by which a longer context trusts the next shorter one
_PAIRS, _TRIPLES = 1 << 16, 1 << 18  # buckets of two and three letters
_MODELS = 64  # spelling tables a task holds at a time
_STRETCH = 1 << 20
_ROWS = 32
_BLOCK = 8_192
_WORD = re.compile(r"[^\W\d_]+")


def grams(text: str, seen: np.ndarray) -> np.ndarray:
    """Buckets of all n-grams of the whole lower-cased text, each once, rising.

    ``seen`` is a cleared array of ``BUCKETS`` flags to work in, and is cleared again. Texts go
    through in stretches that overlap by an n-gram, so memory does not grow with them.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    shift = np.uint32(33 - BUCKETS.bit_length())
    for at in range(0, len(points), _STRETCH):
        part = points[at : at + _STRETCH + LONGEST - 1]
        rolled = np.zeros(len(part), dtype=np.uint32)
        for n in range(LONGEST):
            if len(part) <= n:
                break
            rolled = rolled[: len(part) - n] * np.uint32(0x01000193) + part[n:] + np.uint32(n + 1)
            seen[(rolled * np.uint32(0x9E3779B1)) >> shift] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased words with one space around each, all other characters being left out."""
    return np.frombuffer(f" {' '.join(_WORD.findall(text.lower()))} ".encode("utf-32-le"), dtype="<u4")


def _letter_grams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of every letter, of every two and of every three in a row."""
    two = points[:-1] * np.uint32(0x01000193) + points[1:]
    three = two[:-1] * np.uint32(0x01000193) + points[2:]
    mixed = np.uint32(0x9E3779B1)
    return points & np.uint32(_PAIRS - 1), (two * mixed) >> np.uint32(16), (three * mixed) >> np.uint32(14)


_SIZES = (_PAIRS, _PAIRS, _TRIPLES)


class Spelling:
    """How often letters follow each other in a language, from counts per bucket of one, two and three."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        tables = []
        for size, (at, times) in zip(_SIZES, counts, strict=True):
            table = np.zeros(size, dtype=np.float32)
            table[at] = times
            tables.append(table)
        one, self.two, self.three = tables
        self.after = one  # how often a letter is followed
        self.alone = (one + 0.5) / (one.sum() + 0.5 * (np.count_nonzero(one) + 1))

    def evidence(self, text: str) -> tuple[float, int]:
        """Nats by which the language explains the text's letters better than their mere frequency does, and letters.

        Each letter's chance is that after the two before it, smoothed by that after one and
        that of the letter alone; unlike shuffled letters, words in the language gain by it.
        How rich the training texts are does not matter: what is rare there stays unlikely.
        """
        points, total = _letters(text), 0.0
        for at in range(0, max(len(points) - 2, 0), _STRETCH):
            one, two, three = _letter_grams(points[at : at + _STRETCH + 2])
            alone = self.alone[one[2:]]
            after_one = (self.two[two[1:]] + _SMOOTH * alone) / (self.after[one[1:-1]] + _SMOOTH)
            after_two = (self.three[three] + _SMOOTH * after_one) / (self.two[two[:-1]] + _SMOOTH)
            gain = np.where(self.after[one[2:]] > 0, np.log(after_two / alone), -_SURPRISE)
            total += float(np.maximum(gain, -_SURPRISE).sum(dtype=np.float64))
        return total, max(len(points) - 2, 0)

    def familiarity(self, text: str) -> float:
        """Evidence a letter; high for very short texts."""
        total, letters = self.evidence(text)
        return (total + _PRIOR) / max(letters, 1)


class Kernel:
    """Normalized presence kernel against the landmarks: shared n-grams over the root of both counts."""

    def __init__(self, landmarks: list[np.ndarray]) -> None:
        self.sizes = np.array([len(g) for g in landmarks], dtype=np.float64)
        self.dense = len(landmarks) <= _DENSE
        if not self.dense:  # landmarks of each n-gram, one after another
            every = np.concatenate(landmarks)
            self.marks = np.repeat(np.arange(len(landmarks)), [len(g) for g in landmarks])[np.argsort(every, kind="stable")]
            self.opens = np.concatenate([[0], np.cumsum(np.bincount(every, minlength=BUCKETS))])
            return
        present = np.zeros((BUCKETS, len(landmarks)), dtype=bool)
        for i, own in enumerate(landmarks):
            present[own, i] = True
        known = present.any(axis=1)
        self.row = np.where(known, np.cumsum(known) - 1, -1).astype(np.int32)
        self.table = present[known].astype(np.float32)

    def rows(self, texts: list[str]) -> np.ndarray:
        """One row of kernel values per text."""
        seen = np.zeros(BUCKETS, dtype=bool)
        return self.of_grams([grams(t, seen) for t in texts])

    def of_grams(self, found: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(found), len(self.sizes)))
        for at in range(0, len(found), _ROWS):
            some = found[at : at + _ROWS]
            if not self.dense:
                for i, g in enumerate(some):
                    out[at + i] = self._shared(g)
                continue
            known = [self.row[g] for g in some]
            known = [k[k >= 0] for k in known]
            for i, k in enumerate(known):  # presence row times table: the sum of its rows
                out[at + i] = self.table[k].sum(axis=0, dtype=np.float64)
        sizes = np.array([len(g) for g in found], dtype=np.float64)
        return out / np.sqrt(np.maximum(np.outer(sizes, self.sizes), 1))

    def _shared(self, found: np.ndarray) -> np.ndarray:
        """N-grams of a text that each landmark holds."""
        count = self.opens[found + 1] - self.opens[found]
        begins = np.cumsum(count) - count
        at = np.arange(count.sum()) - np.repeat(begins - self.opens[found], count)
        return np.bincount(self.marks[at], minlength=len(self.sizes))


@dataclass
class Model:
    languages: list[str]
    landmarks: list[np.ndarray]
    weights: np.ndarray  # landmarks and a constant by languages
    letters: list[list[tuple[np.ndarray, np.ndarray]]]  # per language, counts of its letters, twos and threes
    usual: np.ndarray  # per language, the median evidence a letter of one half of its texts under the other

    def floors(self, least: float) -> np.ndarray:
        """Least familiarity a text of each language must have.

        Half the usual one if that is less than ``least``, as where a language has few
        texts; a language of a single text rejects nothing. No other language counts.
        """
        return np.where(self.usual > 0, np.minimum(least, self.usual / 2), -np.inf)

    def spellings(self) -> Callable[[int], Spelling]:
        """The spelling of a language by its number; the latest few are held."""
        held: dict[int, Spelling] = {}

        def find(language: int) -> Spelling:
            found = held.pop(language, None) or Spelling(self.letters[language])
            held[language] = found
            if len(held) > _MODELS:
                del held[next(iter(held))]
            return found

        return find

    def scores(self, values: np.ndarray) -> np.ndarray:
        return np.column_stack([values, np.ones(len(values))]) @ self.weights


def solve(
    within: np.ndarray, blocks: Iterable[tuple[np.ndarray, np.ndarray]], counts: np.ndarray, ridge: float
) -> np.ndarray:
    """One-versus-rest kernel ridge regression in the Nyström space of the landmarks.

    ``within`` is the kernel among landmarks; ``blocks`` give that of training texts against
    them, with the numbers of their languages, of which ``counts`` says how many there are. Targets
    are 1 and -1, weighted so that every language counts alike. What is held is
    landmarks times landmarks and landmarks times languages.
    """
    spectrum, vectors = np.linalg.eigh(within)
    kept = spectrum > 1e-8 * max(spectrum.max(initial=0), 1e-300)
    onto = vectors[:, kept] / np.sqrt(spectrum[kept])
    size = onto.shape[1] + 1
    gram, own, every = np.zeros((size, size)), np.zeros((size, len(counts))), np.zeros(size)
    for values, labels in blocks:
        features = np.column_stack([values @ onto, np.ones(len(values))])
        weighted = features / counts[labels][:, None]
        gram += features.T @ weighted
        every += weighted.sum(axis=0)
        order = np.argsort(labels, kind="stable")
        opens = np.flatnonzero(np.diff(labels[order], prepend=-1))
        own[:, labels[order][opens]] += np.add.reduceat(weighted[order], opens, axis=0).T
    penalty = ridge * np.eye(size)
    penalty[-1, -1] = 1e-9
    inner = np.linalg.solve(gram + penalty, 2 * own - every[:, None])
    return np.vstack([onto @ inner[:-1], inner[-1:]])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def _dealt(rows: DataFrame, each: int, languages: int) -> DataFrame:
    """Up to ``each`` rows of every language, as ``even_sample`` takes them.

    Counts are joined to the rows instead of standing in the plan, so there may be many
    languages; up to ``COUNTED_LANGUAGES`` of them are broadcast, which spares the texts a shuffle.
    """
    counts = rows.groupBy("lang").agg(F.count("*").alias("count"))
    thinned = counts.select("lang", F.greatest(F.lit(1), F.floor(F.col("count") / (2 * each))).alias("one_in"))
    thinned = F.broadcast(thinned) if languages <= COUNTED_LANGUAGES else thinned
    chosen = rows.join(thinned, "lang").filter(F.pmod("deal", "one_in") == 0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("deal")).alias("place")
    return chosen.select("text", "lang", "deal", place).filter(F.col("place") <= each).drop("place")


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    landmarks: int = LANDMARKS,
    train_rows: int = TRAIN_ROWS,
    ridge: float = RIDGE,
) -> Model | None:
    """Model from about ``train_rows`` labelled rows that are not held out, evenly by language.

    None if there are none. Every language is learned: of each, at least ``LEAST_ROWS`` rows
    are taken if it has them, and ``LEAST_LANDMARKS`` landmarks as long as these are not
    more than ``MOST_LANDMARKS``. Landmarks are whole texts; only their n-gram sets, the training
    rows' kernel values, block by block, and the counts of a language's letters reach the
    driver, whatever the number of rows.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    ).filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    rows = rows.select("text", "lang", F.xxhash64("id").alias("deal"))
    languages = [r.lang for r in rows.select("lang").distinct().collect()]
    if not languages:
        return None
    chosen = _dealt(rows, max(LEAST_ROWS, train_rows // len(languages)), len(languages))
    sample = stored(chosen.filter("text <> ''").coalesce(SAMPLE_FILES), "language-sample")
    order = Window.partitionBy("lang").orderBy("deal", "text")

    def presence():
        seen = np.zeros(BUCKETS, dtype=bool)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [grams(t, seen).astype(np.int32) for t in batch.column(0).to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["grams"])

        return step

    each = max(LEAST_LANDMARKS, landmarks // len(languages))
    first = sample.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= each)
    first = first.orderBy("place", "deal", "text").limit(max(landmarks, MOST_LANDMARKS)).select("text")
    marks = map_batches(first, "grams array<int>", presence).collect()
    if not marks:
        return None
    kernel_marks = sorted((np.array(r.grams, dtype=np.int32) for r in marks), key=lambda g: (len(g), g.tobytes()))

    def values():
        kernel = Kernel(kernel_marks)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [r.tobytes() for r in kernel.rows(batch.column("text").to_pylist())]
            return pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("deal"), pa.array(found, pa.binary())], ["lang", "deal", "k"]
            )

        return step

    counts = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    languages = sorted(counts)
    number = {lang: i for i, lang in enumerate(languages)}
    found = map_batches(sample.select("text", "lang", "deal"), "lang string, deal bigint, k binary", values)
    found = stored(found, "kernel-values").orderBy("deal", "lang", "k")

    def blocks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        rows = found.toLocalIterator()
        while block := list(islice(rows, _BLOCK)):
            yield np.array([np.frombuffer(r.k) for r in block]), np.array([number[r.lang] for r in block])

    within = Kernel(kernel_marks).of_grams(kernel_marks)
    weights = solve(within, blocks(), np.array([counts[lang] for lang in languages]), ridge)
    some = sample.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= FAMILIAR_ROWS)
    return Model(languages, kernel_marks, weights, *_familiar(some.select("lang", "place", "text"), languages))


def _familiar(sample: DataFrame, languages: list[str]) -> tuple[list[list[tuple[np.ndarray, np.ndarray]]], np.ndarray]:
    """``letters`` and ``usual`` of a model; texts are halved by the parity of their place."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int, int], np.ndarray] = {}
        for batch in batches:
            for lang, place, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                points = _letters(text)
                for at in range(0, max(len(points) - 2, 0), _STRETCH):
                    for kind, found in enumerate(_letter_grams(points[at : at + _STRETCH + 2])):
                        key = (lang, place % 2, kind)
                        table = sums.setdefault(key, np.zeros(_SIZES[kind], dtype=np.int32))
                        table += np.bincount(found[: _STRETCH], minlength=_SIZES[kind]).astype(np.int32)
            if len(sums) > 3 * _MODELS:
                yield from packed(sums)
        yield from packed(sums)

    def packed(sums: dict[tuple[str, int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
        for (lang, half, kind), table in sums.items():
            at = np.flatnonzero(table).astype(np.int32)
            row = [[lang], [half], [kind], [at.tobytes()], [table[at].tobytes()]]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["lang", "half", "kind", "at", "times"])
        sums.clear()

    number = {lang: i for i, lang in enumerate(languages)}
    halves: list = [[[(np.zeros(0, np.int32), np.zeros(0, np.int32))] * 3 for _ in range(2)] for _ in languages]
    for row in sample.mapInArrow(count, "lang string, half int, kind int, at binary, times binary").toLocalIterator():
        own = halves[number[row.lang]][row.half]
        own[row.kind] = _added(own[row.kind], (np.frombuffer(row.at, np.int32), np.frombuffer(row.times, np.int32)))

    def compare():
        held: dict[tuple[str, int], Spelling] = {}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            shares = []
            for lang, place, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                other = (lang, 1 - place % 2)
                if other not in held:
                    if len(held) >= _MODELS:
                        held.clear()
                    held[other] = Spelling(halves[number[lang]][other[1]])
                total, letters = held[other].evidence(text)
                shares.append(total / max(letters, 1))
            return pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(shares, pa.float64())], ["lang", "share"])

        return step

    usual = np.zeros(len(languages))
    shares: dict[str, list[float]] = {}
    for row in map_batches(sample, "lang string, share double", compare).collect():
        shares.setdefault(row.lang, []).append(row.share)
    for lang, found in shares.items():
        if all(len(half[0][0]) for half in halves[number[lang]]):
            usual[number[lang]] = np.median(found)
    return [[_added(a, b) for a, b in zip(*both, strict=True)] for both in halves], usual


def _added(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (buckets and times) of two samples together."""
    at, place = np.unique(np.concatenate([one[0], two[0]]), return_inverse=True)
    times = np.bincount(place, weights=np.concatenate([one[1], two[1]]), minlength=len(at))
    return at.astype(np.int32), times.astype(np.int32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``lang_pred`` and ``score`` from the whole text alone.

    ``score`` is the winner's regression value moved from [-1, 1] to [0, 1] and kept
    there; ties go to the language first in order. A null text, one without a letter, and
    any text without a model is ``und`` with score 0. Null and repeated ids keep their
    rows (a null id is not held out), an empty table gives an empty result.
    """

    def make():
        kernel = Kernel(model.landmarks) if model else None

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if model and has_letter(t)]
            if at:
                values = model.scores(kernel.rows([texts[i] for i in at]))
                best = values.argmax(axis=1)
                scores[at] = np.clip((values.max(axis=1) + 1) / 2, 0, 1)
                for i, b in zip(at, best.tolist(), strict=True):
                    names[i] = model.languages[b]
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

        return step

    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        held_out(F.col(f"`{id_col}`")).alias("held_out"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    return map_batches(rows, "doc_id bigint, held_out boolean, lang_pred string, score double", make)


def keep_identified(
    docs: DataFrame, model: Model | None, text_col: str = "text", min_familiar: float | None = None
) -> DataFrame:
    """Rows in a language the model knows, all columns; ``und`` and unfamiliar texts go.

    A text is unfamiliar if its ``Spelling.familiarity`` in the language predicted for it is
    below ``min_familiar``, if that is given (``Model.floors`` says when less will do). The score would not tell:
    scores of all languages sum to 1 whatever the text, so the best is never below one over
    their number.

    Null and empty texts and those without a letter go; without a model all others stay. Ids
    are not looked at, rows repeated in full share their fate, and an empty table stays empty.
    """
    place = docs.columns.index(text_col)

    def make():
        kernel = Kernel(model.landmarks) if model else None
        spelt = model.spellings() if model else None

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(place).to_pylist()
            keep = np.array([has_letter(t) for t in texts], dtype=bool)
            at = np.flatnonzero(keep)
            if model and min_familiar is not None and len(at):
                floors = model.floors(min_familiar)
                best = model.scores(kernel.rows([texts[i] for i in at])).argmax(axis=1)
                keep[at] = [spelt(int(b)).familiarity(texts[i]) >= floors[b] for i, b in zip(at, best, strict=True)]
            return batch.filter(pa.array(keep))

        return step

    return map_batches(docs, docs.schema, make)
