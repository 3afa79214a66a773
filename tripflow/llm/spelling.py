"""Spelling variants: words one edit apart, and the frequent form each one stands for.

Two words are one edit apart if their common prefix and suffix together reach the longer
one's length less one. Words of one length and of the next are dealt by their first and by
their last half, one of which such a pair shares; a group that is large is dealt again by
halves of what is left. Within a group, padded matrices of code points are compared block
by block.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import dropped, key_runs, map_batches, run_starts, spans_of, stored

MIN_LENGTH = 7
MIN_TIMES = 2
#: A form occurs so many times as often as the word it stands for.
TIMES_MORE = 10

# What a word is, and where one is misspelt on purpose.
RUN = r"[A-Za-zÀ-ÿ]"
MISSPELL_DIVISOR = 31

#: A group of more words or code points is dealt again.
GROUP_WORDS = 4096
GROUP_POINTS = 1 << 22
_TILE_ROWS = 128
_TILE_CELLS = 1 << 22


def misspelt(word: str, doc_id: int | None) -> str:
    """The word, or for one in 31 of a document's words without one of its letters."""
    mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if mark % MISSPELL_DIVISOR:
        return word
    cut = mark % len(word)
    return word[:cut] + word[cut + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` for the words of ``MIN_LENGTH`` code points or more that occur ``MIN_TIMES``.

    Words are the maximal runs of Latin letters, A-Z lower-cased, some misspelt. Each task
    adds up its words before the shuffle.
    """

    def make():
        run = re.compile(RUN + f"{{{MIN_LENGTH},}}")  # shorter runs give no word

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            total: Counter[str] = Counter()
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    lower = text.lower().decode()  # of bytes: A-Z only
                    for word, times in Counter(run.findall(lower)).items():
                        total[misspelt(word, key)] += times
            words = [w for w in total if len(w) >= MIN_LENGTH]
            counts = pa.array([total[w] for w in words], pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), counts], ["word", "n"])

        return step

    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
    )
    found = map_batches(rows, "word string, n bigint", make)
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_TIMES)


def _keyed(words: DataFrame) -> DataFrame:
    """Every word in its first four groups.

    ``kind`` is the shorter length of a group's pairs. ``fixed`` and ``after`` count the code
    points at both ends that the group's words share, ``low`` and ``high`` bound the common
    prefix of the pairs it answers for: the group by first halves those that share it, the
    one by last halves all others. So each pair is found in one group alone. ``key`` is a
    hash of the shared ends; should two meet, the group is merely larger.
    """
    length = F.col("length")
    kinds = F.explode(F.array(length, length - 1)).alias("kind")
    return _halved(words.select("word", "n", "length", kinds, F.lit(0).alias("fixed"), F.lit(0).alias("after"), F.lit(0).alias("low"), (F.col("kind") + 1).alias("high")))


def _halved(rows: DataFrame) -> DataFrame:
    """Rows dealt by the first and by the last half of what their group does not share yet."""
    half = F.floor((F.col("kind") - F.col("fixed") - F.col("after")) / 2).cast("int")
    sides = F.explode(F.array(
        F.struct((F.col("fixed") + half).alias("fixed"), F.col("after").alias("after"), (F.col("fixed") + half).alias("low"), F.col("high").alias("high")),
        F.struct(F.col("fixed").alias("fixed"), (F.col("after") + half).alias("after"), F.col("low").alias("low"), (F.col("fixed") + half).alias("high")),
    )).alias("side")
    dealt = rows.select("word", "n", "length", "kind", sides).select("word", "n", "length", "kind", "side.*")
    start = F.substring("word", F.lit(1), F.col("fixed"))
    end = F.substring("word", F.col("length") - F.col("after") + 1, F.col("after"))
    return dealt.withColumn("key", F.xxhash64("kind", "fixed", "after", "low", "high", start, end))


_GROUP = ["kind", "key"]


def _dealt(words: DataFrame) -> DataFrame:
    """Every word in its final groups, none of which is large unless nothing is left to halve.

    Then the words differ in two code points at most beyond those they share, which bounds
    the group by the alphabet. The rounds are logarithmic in the words' length.
    """
    rows = _keyed(words)
    done = []
    while True:
        rows = stored(rows, "spelling-groups")
        sizes = rows.groupBy(*_GROUP).agg(F.count("*").alias("_words"), F.sum("length").alias("_points"), F.max(F.col("kind") - F.col("fixed") - F.col("after")).alias("_left"))
        large = sizes.filter((F.col("_left") > 1) & ((F.col("_words") > GROUP_WORDS) | (F.col("_points") > GROUP_POINTS)))
        large = stored(large.select(*_GROUP), "large-groups")
        paired = sizes.filter("_words > 1").select(*_GROUP)  # a word alone in its group has no pair there
        if large.isEmpty():
            done.append(rows.join(paired, _GROUP, "left_semi"))
            break
        done.append(rows.join(large, _GROUP, "left_anti"))
        rows = _halved(rows.join(large, _GROUP, "left_semi"))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def matrix(words: list[str], width: int, right: bool = False) -> np.ndarray:
    """Code points of the words, a row each, padded with zeros behind them, or with ``right`` before them."""
    out = np.zeros((len(words), width), dtype=np.uint32)
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    lengths = np.array([len(w) for w in words])
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, column + np.repeat(width - lengths, lengths) if right else column] = points
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of every row of ``a`` with every row of ``b``."""
    differ = a[:, None, :] != b[None, :, :]
    first = differ.argmax(axis=2)
    return np.where(np.take_along_axis(differ, first[..., None], 2)[..., 0], first, a.shape[1])


def near_pairs(words: list[str], group: np.ndarray, kind: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of every two words of a group one edit apart, and their common prefix.

    Words have ``kind`` code points or one more, and lie group by group; a pair of two
    longer words is left out. Blocks of rows are compared with each other as long as a
    group reaches over both.
    """
    width = kind + 1
    ahead = matrix(words, width)
    back = matrix(words, width, right=True)[:, ::-1]
    longer = np.array([len(w) for w in words]) - kind
    rows = int(min(max((_TILE_CELLS // width) ** 0.5, 1), _TILE_ROWS))
    blocks = range(0, len(words), rows)
    for a in blocks:
        one = slice(a, a + rows)
        for b in blocks[a // rows :]:
            if group[min(a + rows, len(words)) - 1] != group[b] and b > a:
                break
            two = slice(b, b + rows)
            prefix = np.minimum(_common(ahead[one], ahead[two]), kind)
            suffix = np.minimum(_common(back[one], back[two]), kind)
            longest = kind + np.maximum.outer(longer[one], longer[two])
            near = (prefix + suffix >= longest - 1) & (group[one][:, None] == group[two][None, :])
            near &= ~(longer[one][:, None] & longer[two][None, :]).astype(bool)
            if a == b:
                near = np.triu(near, 1)
            i, j = np.nonzero(near)
            yield i + a, j + b, prefix[i, j]


def links(words: DataFrame) -> DataFrame:
    """``word``, ``near`` and ``near_n``: every two words one edit apart, both ways; ``words`` has ``word`` and ``n``."""
    lengths = words.select("word", "n", F.length("word").alias("length"))
    dealt = _dealt(lengths).select("kind", "key", "low", "high", "word", "n")
    dealt = dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, _GROUP):
            for a, z in spans_of(run_starts([rows.column("kind")]), rows.num_rows):
                part = rows.slice(a, z - a)
                names = part.column("word").to_pylist()
                n, low, high = (part.column(c).to_numpy() for c in ("n", "low", "high"))
                for i, j, prefix in near_pairs(names, part.column("key").to_numpy(), part.column("kind")[0].as_py()):
                    own = (low[i] <= prefix) & (prefix < high[i])
                    i, j = i[own], j[own]
                    if not len(i):
                        continue
                    both, other = np.concatenate([i, j]), np.concatenate([j, i])
                    found = [pa.array([names[k] for k in both]), pa.array([names[k] for k in other]), pa.array(n[other])]
                    yield pa.RecordBatch.from_arrays(found, ["word", "near", "near_n"])

    return dealt.mapInArrow(compare, "word string, near string, near_n bigint")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the last form reached from each word of ``forms`` (``word``, ``form``).

    Each round doubles the distance. A form occurs ten times as often as its word, so a
    chain is as long as the largest count has digits, and the rounds are the logarithm of that.
    """
    ways = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "forms")
    while not ways.filter("open").isEmpty():
        on = ways.select(F.col("word").alias("_word"), F.col("root").alias("_root"), F.col("open").alias("_open"))
        met = ways.join(on, F.col("root") == F.col("_word"), "left")
        further = met.select("word", F.coalesce("_root", "root").alias("root"), F.coalesce("_open", F.lit(False)).alias("open"))
        after = stored(further, "forms")
        dropped(ways)
        ways = after
    return ways.select("word", "root")


def variants(words: DataFrame, times_more: int = TIMES_MORE) -> DataFrame:
    """Per word ``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    ``words`` has distinct words and their counts ``n``. Near words differ by exactly one
    inserted, deleted or replaced code point. The form is the near word of the largest
    count, the first in code-point order on a tie, if it occurs ``times_more`` times as often;
    the root is the end of the chain of forms. A word without near words has
    ``n_near`` 0, and without a form is its own root. No group is cut; an empty table gives an
    empty result.
    """
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("_best")
    near = links(words).groupBy(F.col("word").alias("_word")).agg(F.count("*").alias("_near"), best)
    form = F.when(-F.col("_best.less") >= F.col("n") * times_more, F.col("_best.near"))
    form_n = F.when(form.isNotNull(), -F.col("_best.less"))
    found = stored(words.join(near, F.col("word") == F.col("_word"), "left").select(
        "word", form.alias("form"), "n", F.coalesce("_near", F.lit(0)).cast("bigint").alias("n_near"), form_n.alias("form_n")
    ), "spellings")
    roots = _roots(found.filter("form IS NOT NULL")).withColumnRenamed("word", "_word")
    return found.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def find_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the words of all texts.

    Null and empty texts hold no words, repeated rows count each, a null id misspells like
    an empty one, words of any length take part, an empty table gives an empty result, and
    other columns are not read.
    """
    return variants(stored(word_counts(docs, id_col, text_col), "words"))
