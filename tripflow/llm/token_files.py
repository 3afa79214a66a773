"""Token ids in binary shard files, each document compressed with a shared dictionary.

A shard file holds, after its head, one zstandard frame per document, then the index and
a tail. All numbers are little-endian:

    head    b"TOKSHRD1", item width (u8: 2 or 4), first 16 bytes of the dictionary's SHA-256
    frames  a document's ids, compressed on their own
    index   per document: id (i64), whether it has one (u8), offset (u64), ids in it (u64)
    tail    offset of the index (u64), documents (u64), b"TOKSHRD1"

The dictionary lies beside the shards as ``dictionary``. A reader refuses a shard whose
hash names another one, and fetches one document through the index without reading others.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import dropped, map_batches, stored
from tripflow.llm.encoders import Encoder

MAGIC = b"TOKSHRD1"
END_ID = 1
SHARD_DOCS = 16_384
SAMPLE_DOCS = 1_000
SAMPLE_CHARS = 16_384  # longer documents need no dictionary
DICTIONARY_BYTES = 65_536
LEVEL = 3

_INDEX = np.dtype([("id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("n", "<u8")])
_HEAD = "<8sB16s"
_TAIL = "<QQ8s"


def train(samples: list[bytes]) -> bytes:
    """Dictionary for serialized id arrays; with too few of them, their plain contents."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


class Codec:
    def __init__(self, dictionary: bytes, width: int) -> None:
        self.item = np.dtype("<u2" if width == 2 else "<u4")
        self.hash = hashlib.sha256(dictionary).digest()[:16]
        shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if len(dictionary) >= 8 else {}
        self.packer = zstandard.ZstdCompressor(level=LEVEL, **shared)
        self.opener = zstandard.ZstdDecompressor(**shared)

    def pack(self, ids: np.ndarray) -> bytes:
        return self.packer.compress(ids.astype(self.item).tobytes())

    def open(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self.opener.decompress(frame), self.item).astype("<u4")


def _open_fs(path: str):
    return pyarrow.fs.FileSystem.from_uri(path)


def _dictionary(folder: str) -> bytes:
    fs, path = _open_fs(folder)
    with fs.open_input_file(f"{path}/dictionary") as file:
        return file.read()


@dataclass(frozen=True)
class Shard:
    path: str
    start: int  # ids in the shards before it
    tokens: int
    documents: int


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def _sample(rows: DataFrame, count: int, tokenizer: str, item: str, end_id: int) -> list[bytes]:
    """Serialized ids of a bounded sample of short documents, the same on every run."""

    def make():
        encoder = Encoder(tokenizer)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.append(ids, end_id).astype(item).tobytes() for ids in encoder.encode(batch.column(0).to_pylist())]
            return pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["ids"])

        return step

    short = rows.filter(F.length("text") <= SAMPLE_CHARS)
    one_in = max(1, count // (2 * SAMPLE_DOCS))
    place = F.xxhash64("doc_id", "text")
    chosen = short.filter(F.pmod(place, F.lit(one_in)) == 0).orderBy(place).limit(SAMPLE_DOCS)
    return [r.ids for r in map_batches(chosen.select("text"), "ids binary", make).collect()]


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    width: int = 2,
    shard_docs: int = SHARD_DOCS,
) -> list[Shard]:
    """Encode every text, end it with ``end_id``, and write the shards in rising id order.

    ``folder`` must be one all executors share. A null text counts as empty; null ids come
    first; rows repeated in full are each written; an empty table gives no shard. Only the
    dictionary is fitted on a sample, of at most ``SAMPLE_DOCS`` short documents. Documents are
    encoded and compressed where they are read, and only frames are shuffled, by ranges of
    the id and the place where they were stored. So a frequent id, or null, takes several
    shards in a row. A task writes its shard under a name of its own and then renames it, so a task run again does
    no harm.
    """
    item = "<u2" if width == 2 else "<u4"
    rows = _prepared(docs, id_col, text_col)
    count = rows.count()
    if not count:
        return []
    dictionary = train(_sample(rows, count, tokenizer, item, end_id))
    fs, root = _open_fs(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/dictionary") as file:
        file.write(dictionary)

    shards = -(-count // shard_docs)

    def make():
        encoder, codec = Encoder(tokenizer), Codec(dictionary, width)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            encoded = [np.append(ids, np.uint32(end_id)) for ids in encoder.encode(batch.column(1).to_pylist())]
            if width == 2 and any(len(e) and e.max() > 0xFFFF for e in encoded):
                raise ValueError("these ids need a width of 4")
            columns = [
                batch.column(0),
                pa.array([len(e) for e in encoded], pa.int64()),
                pa.array([codec.pack(e) for e in encoded], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "frame"])

        return step

    frames = stored(map_batches(rows, "doc_id bigint, n bigint, frame binary", make), "frames")
    placed = frames.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("place"))
    ranges = placed.repartitionByRange(shards, "doc_id", "place").sortWithinPartitions("doc_id", "place")
    ordered = ranges.select(F.spark_partition_id().alias("shard"), "doc_id", "n", "frame")
    mark = hashlib.sha256(dictionary).digest()[:16]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_fs(folder)
        stream, shard, index = None, 0, []
        offset = struct.calcsize(_HEAD)
        attempt = f"{root}/unfinished-{uuid.uuid4().hex}"
        for batch in batches:
            if not batch.num_rows:
                continue
            if stream is None:
                shard = batch.column("shard")[0].as_py()
                stream = fs.open_output_stream(attempt)
                stream.write(struct.pack(_HEAD, MAGIC, width, mark))
            lengths = np.array([len(f) for f in batch.column("frame").to_pylist()], dtype=np.int64)
            part = np.zeros(batch.num_rows, dtype=_INDEX)
            part["id"] = batch.column("doc_id").fill_null(0).to_numpy()
            part["has_id"] = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            part["offset"] = offset + np.cumsum(lengths) - lengths
            part["n"] = batch.column("n").to_numpy()
            index.append(part)
            stream.write(b"".join(batch.column("frame").to_pylist()))
            offset += int(lengths.sum())
        if stream is None:
            return
        whole = np.concatenate(index)
        stream.write(whole.tobytes())
        stream.write(struct.pack(_TAIL, offset, len(whole), MAGIC))
        stream.close()
        name = f"shard-{shard:07d}"
        fs.move(attempt, f"{root}/{name}")
        yield pa.RecordBatch.from_pylist([{"shard": shard, "name": name, "tokens": int(whole["n"].sum()), "documents": len(whole)}])

    written = sorted(ordered.mapInArrow(write, "shard bigint, name string, tokens bigint, documents bigint").collect())
    found, start = [], 0
    for row in written:  # one row per file
        found.append(Shard(f"{folder}/{row['name']}", start, row["tokens"], row["documents"]))
        start += row["tokens"]
    dropped(frames)
    return found


class Reader:
    """One shard file."""

    def __init__(self, path: str) -> None:
        folder = path.rsplit("/", 1)[0]
        dictionary = _dictionary(folder)
        fs, name = _open_fs(path)
        self.file = fs.open_input_file(name)
        magic, width, mark = struct.unpack(_HEAD, self.file.read_at(struct.calcsize(_HEAD), 0))
        self.codec = Codec(dictionary, width)
        if magic != MAGIC or mark != self.codec.hash:
            raise ValueError(f"{path} is no shard of this dictionary")
        size = self.file.size()
        self.end, documents, magic = struct.unpack(_TAIL, self.file.read_at(struct.calcsize(_TAIL), size - struct.calcsize(_TAIL)))
        if magic != MAGIC:
            raise ValueError(f"{path} is cut short")
        self.index = np.frombuffer(self.file.read_at(documents * _INDEX.itemsize, self.end), _INDEX)

    def ids_at(self, place: int) -> np.ndarray:
        first = int(self.index["offset"][place])
        last = int(self.index["offset"][place + 1]) if place + 1 < len(self.index) else self.end
        return self.codec.open(self.file.read_at(last - first, first))

    def fetch(self, doc_id: int) -> list[np.ndarray]:
        """Ids of all documents of that id in this shard, reading their frames alone."""
        known = int((self.index["has_id"] == 0).sum())
        first, last = np.searchsorted(self.index["id"][known:], [doc_id, doc_id + 1]) + known
        return [self.ids_at(p) for p in range(first, last)]

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for place, row in enumerate(self.index):
            yield (int(row["id"]) if row["has_id"] else None), self.ids_at(place)


def read_tokens(spark: SparkSession, shards: list[Shard]) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                reader = Reader(shard["path"])
                lengths = reader.index["n"].astype(np.int64)
                starts = shard["start"] + np.cumsum(lengths) - lengths
                ids, sizes, sums = [], [], []
                for doc_id, found in reader:
                    ids.append(doc_id)
                    sizes.append(len(found))
                    sums.append(zlib.crc32(found.tobytes()))
                columns = [pa.array(ids, pa.int64()), pa.array(starts), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    listed = spark.createDataFrame([(s.path, s.start) for s in shards], "path string, start bigint")
    spread = listed.repartition(max(1, len(shards)))
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
