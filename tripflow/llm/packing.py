"""Best-fit packing by minimum bin slack over the lengths of all pieces."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import map_batches, stored
from tripflow.llm.encoders import Encoder

CAPACITY = 1024
END_ID = 2
#: Each length's pieces are numbered in so many parts at least, so that a common length is no single group.
PARTS = 256
#: Pieces of a part; lengths with more for each of their parts are numbered in more parts.
PART_PIECES = 65_536
#: Pieces alike in every column are numbered in blocks of so many, which may lie in different parts.
BLOCK = 1024

Pattern = tuple[int, list[tuple[int, int]]]  # how often it is used; lengths with copies of each


def fullest(counts: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """Lengths and copies of the fullest bin that holds a piece of the largest length.

    ``counts[l]`` pieces of length l are at hand. Sums that can be reached are bits of an
    integer; the set before each length is kept and followed back from the fullest sum.
    """
    largest = int(np.flatnonzero(counts)[-1])
    mask = (1 << capacity + 1) - 1
    reached, before, goal = 1 << largest, [], capacity
    for length in range(min(largest, capacity - largest), 0, -1):
        spare = int(counts[length]) - (length == largest)
        if spare <= 0:
            continue
        before.append((length, spare, reached))
        copies = min(spare, (capacity - largest) // length)
        step = 1
        while copies > 0:  # any number up to ``copies`` is a sum of such steps
            take = min(step, copies)
            reached |= reached << take * length & mask
            copies -= take
            step *= 2
        if reached >> capacity & 1:
            break
    goal = reached.bit_length() - 1
    chosen = {largest: 1}
    for length, _, sums in reversed(before):
        while not sums >> goal & 1:
            goal -= length
            chosen[length] = chosen.get(length, 0) + 1
    return sorted(chosen.items(), reverse=True)


def minimum_bin_slack(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Bins for all pieces, equal ones together.

    Bin after bin takes the fullest combination of what is left. The same combination stays
    the fullest until one of its lengths runs short, so it is taken as often as it lasts and
    the number of steps depends on the lengths alone, not on the number of pieces.
    """
    left = counts.astype(np.int64).copy()
    patterns: list[Pattern] = []
    while left.any():
        chosen = fullest(left, capacity)
        times = min(int(left[length]) // copies for length, copies in chosen)
        for length, copies in chosen:
            left[length] -= copies * times
        patterns.append((times, chosen))
    return patterns


class Places:
    """Where the n-th piece of each length goes."""

    def __init__(self, patterns: list[Pattern], capacity: int) -> None:
        rows = []  # length, first piece number, bins, first bin, offset
        used = np.zeros(capacity + 1, dtype=np.int64)
        bins = 0
        for times, chosen in patterns:
            offset = 0
            for length, copies in chosen:
                for _ in range(copies):
                    rows.append((length, int(used[length]), bins, offset))
                    used[length] += times
                    offset += length
            bins += times
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(-1, 4)
        self.bins = bins
        self.used = used
        self.table = table
        self.opens = np.searchsorted(table[:, 0], np.arange(capacity + 2))

    def find(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
        for length in np.unique(lengths):
            own = lengths == length
            part = self.table[self.opens[length] : self.opens[length + 1]]
            row = np.searchsorted(part[:, 1], numbers[own], side="right") - 1
            sequence[own] = part[row, 2] + numbers[own] - part[row, 1]
            offset[own] = part[row, 3]
        return sequence, offset


def _pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int, capacity: int) -> DataFrame:
    """Documents cut from their end into full pieces; the first takes the rest."""

    def make():
        encoder = Encoder(tokenizer)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, piece, start, length, sums = [], [], [], [], []
            for at, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                data = memoryview(np.append(ids, np.uint32(end_id)).astype("<u4").tobytes())
                total = len(ids) + 1
                edges = [0, *range((total - 1) % capacity + 1, total + 1, capacity)]
                for number, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    rows.append(at)
                    piece.append(number)
                    start.append(a)
                    length.append(b - a)
                    sums.append(zlib.crc32(data[4 * a : 4 * b]))
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(piece, pa.int32())] + [pa.array(c, pa.int64()) for c in (start, length, sums)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

        return step

    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    return map_batches(rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint", make)


def _blocks(pieces: DataFrame, counts: np.ndarray, parts: int, part_pieces: int, block: int) -> DataFrame:
    """Blocks of at most ``block`` pieces alike in every column, and the part of their length each lies in.

    Copies are counted before the shuffle. Parts follow a hash of the row, so every run deals alike.
    """
    dealt_to = F.array(*[F.lit(max(parts, -(-int(n) // part_pieces))) for n in counts])
    alike = pieces.groupBy(*pieces.columns).agg(F.count("*").alias("_all"))
    first = F.sequence(F.lit(0).cast("bigint"), F.col("_all") - 1, F.lit(block).cast("bigint"))
    spread = F.xxhash64("doc_id", "piece", "ids_crc32", "_first")
    return alike.select("*", F.explode(first).alias("_first")).select(
        *pieces.columns,
        "_first",
        F.least(F.lit(block), F.col("_all") - F.col("_first")).alias("_copies"),
        F.pmod(spread, F.get(dealt_to, "length")).alias("part"),
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    parts: int = PARTS,
    part_pieces: int = PART_PIECES,
    block: int = BLOCK,
) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A text's ids and ``end_id`` form a document; only one longer than ``capacity`` is cut.
    The pieces are counted by length on Spark, bins are chosen for those at most
    ``capacity`` counts, and the pieces of a length are numbered and look up their places.
    Pieces alike in every column are counted before they are shuffled and numbered in blocks
    of at most ``block``; blocks are dealt by hash to at least ``parts`` parts of some
    ``part_pieces``, so neither a common length nor a row repeated without end crowds a part.
    A null or empty text is one piece of ``end_id`` alone. Null ids and rows
    repeated in full are packed like others, an empty table gives an empty result, and
    other columns are not read.
    """
    pieces = stored(_pieces(docs, tokenizer, id_col, text_col, end_id, capacity), "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    dealt = _blocks(pieces, counts, parts, part_pieces, block)
    counted = dealt.groupBy("length", "part").agg(F.sum("_copies").alias("_in_part"))
    places = Places(minimum_bin_slack(counts, capacity), capacity)
    lower = Window.unboundedPreceding, -1
    before = Window.partitionBy("length").orderBy("part").rowsBetween(*lower)
    opens = counted.select("length", "part", F.coalesce(F.sum("_in_part").over(before), F.lit(0)).alias("_opens"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32", "_first")
    ahead = F.coalesce(F.sum("_copies").over(within.rowsBetween(*lower)), F.lit(0))
    numbered = dealt.withColumn("_n", ahead).join(opens, ["length", "part"])
    number = F.col("_opens") + F.col("_n")
    numbered = numbered.select(
        *pieces.columns, F.explode(F.sequence(number, number + F.col("_copies") - 1)).alias("number")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.find(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            columns = [*batch.columns[:-1], *map(pa.array, found)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return numbered.mapInArrow(place, schema)
