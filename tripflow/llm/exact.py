"""Exact duplicates through an exchange of Golomb-coded fingerprints.

Texts stay where they were read. Every block of rows sends the sorted hashes of its texts,
Golomb-coded, to the owners of their hash ranges; an owner sees which hashes came more than
once and answers each block with a bitmap. Only texts whose bit is set are shuffled, and
they are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import hold_batches, key_runs, run_starts, spans_of, stored, stored_in_place

#: A block of rows ends at so many rows or bytes of text.
BLOCK_ROWS = 1 << 16
BLOCK_BYTES = 32 << 20
#: Hashes that one owner compares, and bits of a hash beyond those that number the rows:
#: one text in 2^8 is shuffled although its hash merely meets another's.
OWNER_HASHES = 1 << 21
SPARE_BITS = 8
_PRINT_BITS = 63

Digest = Callable[[bytes], bytes]


def sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def golomb(values: np.ndarray, base: int) -> tuple[int, bytes]:
    """Ascending numbers from ``base`` on, coded by their gaps: the divisor's exponent, and the code.

    The divisor is the power of two closest to 0.69 times the mean gap. All quotients come
    first, in unary, then all remainders, so that both are read back without a loop.
    """
    gaps = np.diff(values, prepend=np.uint64(base))
    shift = round(np.log2(max(0.69 * float(gaps.mean()), 1.0)))
    quotient = (gaps >> np.uint64(shift)).astype(np.int64)
    ends = np.cumsum(quotient + 1)
    unary = np.zeros(int(ends[-1]), dtype=np.uint8)
    unary[ends - 1] = 1
    places = np.arange(shift - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    return shift, np.packbits(np.concatenate([unary, rest.ravel()])).tobytes()


def ungolomb(code: bytes, count: int, shift: int, base: int) -> np.ndarray:
    """The numbers that ``golomb`` coded."""
    bits = np.unpackbits(np.frombuffer(code, dtype=np.uint8))
    ends = np.flatnonzero(bits)[:count]
    quotient = np.diff(ends, prepend=-1) - 1
    first = int(ends[-1]) + 1
    rest = bits[first : first + count * shift].reshape(count, shift).astype(np.uint64)
    remainder = (rest << np.arange(shift - 1, -1, -1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum((quotient.astype(np.uint64) << np.uint64(shift)) | remainder, dtype=np.uint64) + np.uint64(base)


def _blocks(rows: DataFrame, digest: Digest) -> DataFrame:
    """Adds to each row its block, its text's ``place`` among the block's hashes, and whether the hash is ``again`` there."""

    def block(held: list[pa.RecordBatch], digests: list[bytes], texts: list[bytes], partition: int, number: int, done: int):
        rows = pa.Table.from_batches(held).combine_chunks()
        prints = np.frombuffer(b"".join(d[:8] for d in digests), dtype=">u8").astype(np.uint64) >> np.uint64(1)
        order = np.argsort(prints, kind="stable")
        _, place, times = np.unique(prints, return_inverse=True, return_counts=True)
        size = len(prints)
        columns = [
            pa.array(np.full(size, partition << 24 | number)),
            pa.array(place.astype(np.int32)),
            pa.array(times[place] > 1),
            pa.array(prints.astype(np.int64)),
            pa.array(np.arange(done, done + size) + (partition << 33)),
            pa.array(digests, pa.binary()),
            pa.array(texts, pa.binary()),
            *[c for n, c in zip(rows.column_names, rows.columns, strict=True) if n != "text"],
        ]
        names = ["block", "place", "again", "print", "number", "digest", "text"]
        names += [n for n in rows.column_names if n != "text"]
        return pa.table(columns, names).take(pa.array(order)).to_batches(max_chunksize=1024)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number, done = TaskContext.get().partitionId(), 0, 0
        held: list[pa.RecordBatch] = []
        digests: list[bytes] = []
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                texts.append((text or b"").lower())  # of bytes: A-Z only
                digests.append(digest(texts[-1]))
                size += len(texts[-1])
            held.append(batch)
            if len(texts) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                yield from block(held, digests, texts, partition, number, done)
                number, done = number + 1, done + len(texts)
                held, digests, texts, size = [], [], [], 0
        if texts:
            yield from block(held, digests, texts, partition, number, done)

    hold_batches(rows.sparkSession)
    others = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    schema = "block bigint, place int, again boolean, print bigint, number bigint, digest binary, text binary"
    return rows.mapInArrow(run, f"{schema}, {others}")


def _messages(rows: DataFrame, bits: int, width: int) -> DataFrame:
    """What blocks send: ``owner``, ``block``, the ``first`` place and number ``n`` of hashes, and their code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy()
            place = batch.column("place").to_numpy()
            value = batch.column("print").to_numpy().view(np.uint64) >> np.uint64(_PRINT_BITS - bits)
            order = np.lexsort((place, block))
            block, place, value = block[order], place[order], value[order]
            fresh = np.ones(len(block), dtype=bool)  # copies within the block send their hash once
            fresh[1:] = (block[1:] != block[:-1]) | (place[1:] != place[:-1])
            block, place, value = block[fresh], place[fresh], value[fresh]
            owner = value // np.uint64(width)
            opens = run_starts([pa.array(block), pa.array(owner), pa.array(place - np.arange(len(place)))])
            sent = []
            for first, last in spans_of(opens, len(block)):
                shift, code = golomb(value[first:last], int(owner[first]) * width)
                sent.append((int(owner[first]), int(block[first]), int(place[first]), last - first, shift, code))
            names = ["owner", "block", "first", "n", "shift", "code"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*sent, strict=True) if sent else [()] * 6, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "owner bigint, block bigint, first int, n int, shift int, code binary"
    return rows.select("block", "place", "print").mapInArrow(run, schema)


def _answers(messages: DataFrame, width: int) -> DataFrame:
    """What owners answer: the words of each block's bitmap that are not zero (``block``, ``word``, ``bits``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, ["owner"]):
            first, n = rows.column("first").to_numpy(), rows.column("n").to_numpy()
            owner = rows.column("owner").to_numpy()
            shift = rows.column("shift").to_numpy()
            codes = rows.column("code").to_pylist()
            value = np.concatenate([
                ungolomb(code, int(n[i]), int(shift[i]), int(owner[i]) * width) for i, code in enumerate(codes)
            ])
            block = np.repeat(rows.column("block").to_numpy(), n)
            place = np.arange(len(value)) - np.repeat(np.cumsum(n) - n - first, n)
            _, kind, times = np.unique(value, return_inverse=True, return_counts=True)
            often = times[kind] > 1  # owners' ranges do not meet, so several in one run do no harm
            block, place = block[often], place[often]
            order = np.lexsort((place, block))
            block, place = block[order], place[order]
            word = place >> 6
            opens = run_starts([pa.array(block), pa.array(word)])
            bit = np.left_shift(np.uint64(1), (place & 63).astype(np.uint64))
            bits = np.bitwise_or.reduceat(bit, opens) if len(opens) else bit
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[opens]), pa.array(word[opens].astype(np.int32)), pa.array(bits.view(np.int64))],
                ["block", "word", "bits"],
            )

    return messages.repartition("owner").sortWithinPartitions("owner").mapInArrow(run, "block bigint, word int, bits bigint")


def _bitmaps(answers: DataFrame, buckets: int) -> DataFrame:
    """One bitmap a block, as an array of words; blocks whose bits are all zero have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, ["block"]):
            blocks = rows.column("block").to_numpy()
            opens = run_starts([rows.column("block")])
            maps = []
            for first, last in spans_of(opens, rows.num_rows):
                word = rows.column("word").to_numpy()[first:last]
                bitmap = np.zeros(int(word.max()) + 1, dtype=np.int64)
                np.bitwise_or.at(bitmap, word, rows.column("bits").to_numpy()[first:last])
                maps.append(bitmap)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks[opens]), pa.array(maps, pa.list_(pa.int64()))], ["block", "bitmap"]
            )

    dealt = answers.repartition(buckets, "block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, "block bigint, bitmap array<bigint>")


def _suspects(rows: DataFrame, bitmaps: DataFrame, buckets: int) -> DataFrame:
    """Adds ``suspect``. Rows lie in buckets by block; only the bitmaps are shuffled."""
    come = bitmaps.repartition(buckets, "block").hint("shuffle_hash")
    word = F.get("bitmap", F.shiftright("place", 6))
    bit = F.call_function("shiftright", word, F.col("place").bitwiseAND(63)).bitwiseAND(1)
    suspect = F.col("again") | F.coalesce(bit == 1, F.lit(False))
    return rows.join(come, "block", "left").withColumn("suspect", suspect).drop("bitmap")


def find_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    digest: Digest = sha256,
) -> DataFrame:
    """Per row ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``digest``, then the columns of ``carry``.

    Texts are equal if they are the same bytes after A-Z are lower-cased; a null text
    counts as empty, and all empty texts are one group. Of equal texts the row of the
    largest id is kept, a null id being smaller than any; among rows of one id, rows
    repeated in full included, the first read is kept, so that exactly one row of each
    group has ``kept``. ``keep_id`` is null if all ids of a group are. An empty table gives
    an empty result; other columns are not read.

    ``digest`` names a text by 8 bytes or more; texts that share one are told apart by
    their bytes, so the answer does not depend on it.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
        *[F.col(f"`{c}`").alias(f"_carried_{i}") for i, c in enumerate(carry)],
    )
    rows = stored_in_place(_blocks(read, digest), buckets, "block", "place")
    count = rows.count()
    bits = min(count.bit_length() + SPARE_BITS, _PRINT_BITS)
    owners = max(buckets, count // OWNER_HASHES)
    width = max(-(-(1 << bits) // owners), 1)
    answers = _answers(_messages(rows, bits, width), width)
    bitmaps = stored(_bitmaps(answers, buckets), "bitmaps")
    marked = _suspects(rows, bitmaps, buckets)
    suspects = marked.filter("suspect")
    texts = suspects.select("digest", "text").distinct().groupBy("digest").count()
    shared = stored(texts.filter("count > 1").select("digest"), "shared-digests")

    best = F.max(F.struct("doc_id", (-F.col("number")).alias("_first"))).alias("_best")
    size = F.count("*").alias("group_size")
    key = ["digest"]
    if not shared.isEmpty():  # texts of one digest: the text becomes part of the key
        told = suspects.join(shared.withColumn("_told", F.lit(True)), "digest", "left")
        suspects = told.withColumn("_text", F.when(F.col("_told"), F.col("text"))).drop("_told")
        key = ["digest", "_text"]
    groups = stored(suspects.groupBy(*key).agg(size, best), "groups").withColumnRenamed("digest", "_digest")
    same = F.col("digest") == F.col("_digest")
    if "_text" in key:
        groups = groups.withColumnRenamed("_text", "_other")
        same &= F.col("_text").eqNullSafe(F.col("_other"))
    carried = [F.col(f"_carried_{i}").alias(c) for i, c in enumerate(carry)]
    several = suspects.join(groups, same).select(
        "doc_id",
        F.col("_best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_best._first") == -F.col("number")).alias("kept"),
        "digest",
        *carried,
    )
    single = marked.filter("NOT suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "digest", *carried,
    )
    return single.unionByName(several)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, all columns, chosen as by ``find_copies``.

    Null and empty texts are one group, so one of their rows stays; an empty table stays
    empty. Rows are stored with a number, and the numbers that go are joined away.
    """
    number = "_number"
    while number in docs.columns:
        number += "_"
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    gone = find_copies(numbered, id_col, text_col, carry=[number]).filter("NOT kept").select(number)
    return numbered.join(gone, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def digest_columns(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find_copies``."""
    text_sha256 = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", text_sha256)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256({_LOWER}) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY {_LOWER})
"""
