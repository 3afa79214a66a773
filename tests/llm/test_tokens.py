from __future__ import annotations

import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripflow.llm.bpe import Bpe, decode, encode, round_trip
from tripflow.llm.common import read
from tripflow.llm.encoders import Encoder
from tripflow.llm.packing import _blocks, fullest, minimum_bin_slack, pack
from tripflow.llm.token_files import Codec, Reader, read_tokens, train, write_tokens

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}
OWN = Bpe(BYTE)
ODD = [
    "", " ", "a" * 5000, "ab" * 3000, "x<|endoftext|>y <|endoftext|>", "<|startoftext|> Zoë", "\u0085\x1c  \t\n a",
    "日本語テキスト 한국어 العربية", "🙂👩‍👩‍👧 é İstanbul ǅ ﬁ", "it's I'LL 'tis   3 ½ x²\r\n\r\n  end  ", "é" * 700, "0123456789" * 60,
]
ROWS = [(n, t) for n, t in enumerate(ODD)] + [(None, "null id"), (50, None), (51, "same"), (51, "same")]


def ids_of(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.fixture
def odd(spark):
    rows = [(i, t, 0) for i, t in ROWS] + [(99, "word " * 60_000, 0)]
    return spark.createDataFrame(rows, "doc_id int, text string, length int")


@given(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_own_ids_are_the_librarys(text):
    ids = next(OWN.encode([text])).tolist()
    assert ids == ids_of(BYTE, text)
    assert OWN.decode(ids) == LIBRARY[BYTE].decode(ids, skip_special_tokens=False) == text


@given(st.lists(st.integers(0, 50256), max_size=60))
@settings(max_examples=200, deadline=None)
def test_decoding_any_ids(ids):
    assert OWN.decode(ids) == LIBRARY[BYTE].decode(ids, skip_special_tokens=False)


def test_no_merge_crosses_a_forced_boundary():
    vocabulary = OWN.vocabulary
    words = [b"a\xffb", b"one", "größe".encode(), b"x\xff"]
    found = vocabulary.fragments(words)
    assert found[0] == [b"a", b"\xff", b"b"] and found[1] == [b"one"] and found[3] == [b"x", b"\xff"]
    assert [b"".join(f) for f in found] == words
    assert 0 < vocabulary.inside.sum() < 1 << 15


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert next(OWN.encode([text])).tolist() == ids_of(BYTE, text)
    for path in (BYTE, WORD):
        assert list(Encoder(path).encode([text, text]))[1].tolist() == ids_of(path, text)


@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x2FF), max_size=60), max_size=5))
@settings(max_examples=100, deadline=None)
def test_words_encoded_once_are_the_librarys(texts):
    for path, encoder in ENCODERS.items():
        assert [e.tolist() for e in encoder.encode(texts)] == [ids_of(path, t) for t in texts]


ENCODERS = {p: Encoder(p) for p in (BYTE, WORD)}


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_every_token_is_what_its_letters_merge_to(path):
    """The condition under which ranks of tokens and of pairs give the same ids."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    ending = model.get("end_of_word_suffix") or ""
    pairs = [tuple(p.split(" ") if isinstance(p, str) else p) for p in model["merges"]]
    rank = {p: i for i, p in enumerate(pairs)}
    assert len({a + b for a, b in pairs}) == len(pairs)
    assert not any(ending and a.endswith(ending) for a, _ in pairs)
    for left, right in pairs:
        token = left + right
        ends = bool(ending) and token.endswith(ending)
        parts = list(token[: -len(ending)] if ends else token)
        parts[-1] += ending if ends else ""
        while len(parts) > 1:
            i = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), len(rank)))
            assert (parts[i], parts[i + 1]) in rank
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert parts == [token]


def test_long_fragments_merge_alike():
    rng = random.Random(1)
    for _ in range(20):
        data = "".join(rng.choice(["th", "e", "ing", "xq", "a", "ZZ"]) for _ in range(200)).encode()
        assert OWN.vocabulary._merge_long([OWN.vocabulary.byte_ids[b] for b in data]) == OWN.vocabulary._merge_short(
            [OWN.vocabulary.byte_ids[b] for b in data]
        )


def test_round_trip_query(spark, odd):
    docs = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    docs = docs.unionByName(odd.selectExpr("doc_id + 100000 AS doc_id", "text"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = round_trip(docs, BYTE).collect()
    assert len(found) == docs.count()
    for r in found:
        ids = ids_of(BYTE, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert round_trip(docs.limit(0), BYTE).count() == 0


def test_encode_then_decode(spark, odd):
    got = {r.doc_id: r.text for r in decode(encode(odd, BYTE), BYTE).collect()}
    assert got == {r.doc_id: r.text or "" for r in odd.collect()}


def check_files(spark, docs, folder, **options):
    shards = write_tokens(docs, str(folder), WORD, **options)
    got = read_tokens(spark, shards).collect()
    rows = [(r.doc_id, ids_of(WORD, r.text) + [1]) for r in docs.collect()]
    sums = sorted((str(i), len(d), zlib.crc32(np.array(d, "<u4").tobytes())) for i, d in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sums
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]
    ids = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids)
    return shards, dict(rows)


def test_files_round_trip(spark, tmp_path):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    shards, rows = check_files(spark, docs, tmp_path / "a", shard_docs=300)
    assert len(shards) == 4
    reader = Reader(shards[2].path)
    some = [int(i) for i in reader.index["id"][::40]]
    assert some and all(reader.fetch(i)[0].tolist() == rows[i] for i in some)
    assert reader.fetch(-5) == []
    stored = sum(p.stat().st_size for p in (tmp_path / "a").iterdir())
    assert stored < sum(2 * len(d) for d in rows.values())


def test_files_of_odd_rows(spark, odd, tmp_path):
    check_files(spark, odd, tmp_path / "a", shard_docs=5)
    check_files(spark, odd, tmp_path / "b", width=4)
    assert write_tokens(odd.limit(0), str(tmp_path / "c"), WORD) == []
    assert read_tokens(spark, []).count() == 0


def test_another_dictionary_is_refused(spark, odd, tmp_path):
    shards = write_tokens(odd, str(tmp_path / "a"), WORD)
    (tmp_path / "a" / "dictionary").write_bytes(b"other dictionary")
    (tmp_path / "b").mkdir()
    for p in (tmp_path / "a").iterdir():
        (tmp_path / "b" / p.name).write_bytes(p.read_bytes())
    with pytest.raises(ValueError, match="no shard of this dictionary"):
        Reader(shards[0].path.replace("/a/", "/b/"))


def test_dictionary_helps_short_documents():
    rng = np.random.default_rng(0)
    docs = [rng.choice(500, size=60, p=np.arange(1, 501) / 125250).astype("<u2") for _ in range(900)]
    dictionary = train([d.tobytes() for d in docs[:600]])
    plain, shared = Codec(b"", 2), Codec(dictionary, 2)
    assert sum(len(shared.pack(d)) for d in docs[600:]) < sum(len(plain.pack(d)) for d in docs[600:])
    assert all((shared.open(shared.pack(d)) == d).all() for d in docs)


def plain_fullest(counts, capacity):
    """Fullest sum with the largest length, by dynamic programming over plain sets."""
    largest = max(i for i, c in enumerate(counts) if c)
    sums = {largest}
    for length, count in enumerate(counts):
        for _ in range(count - (length == largest)):
            sums |= {s + length for s in sums if s + length <= capacity}
    return max(sums)


@given(st.lists(st.integers(0, 4), min_size=1, max_size=40))
@settings(max_examples=300, deadline=None)
def test_each_bin_is_the_fullest(counts):
    counts = np.array([0, *counts, 1])
    capacity = len(counts) + 5
    left = counts.copy()
    for times, chosen in minimum_bin_slack(counts, capacity):
        assert sum(length * n for length, n in chosen) == plain_fullest(left.tolist(), capacity)
        for _ in range(times):
            for length, n in chosen:
                left[length] -= n
        assert (left >= 0).all()
    assert not left.any()


def test_fullest_uses_copies():
    counts = np.zeros(1025, dtype=np.int64)
    counts[[500, 262]] = 1, 5
    assert fullest(counts, 1024) == [(500, 1), (262, 2)]


def check_packed(docs, parts=4):
    got = pack(docs, BYTE, parts=parts).collect()
    rows = docs.select("doc_id", "text").collect()
    wanted = []
    for r in rows:
        ids = ids_of(BYTE, r.text) + [2]
        first = (len(ids) - 1) % 1024 + 1
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            wanted.append((str(r.doc_id), n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(wanted)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024
    return len(bins), sum(w[3] for w in wanted)


def test_packs_whole_table_tightly(spark):
    bins, tokens = check_packed(read(spark, "/root/testdata/sf0.01", "documents"))
    assert bins <= 1.01 * tokens / 1024 + 1


def test_packs_odd_rows(spark, odd):
    check_packed(odd)
    assert pack(odd.limit(0), BYTE).count() == 0
    same = spark.createDataFrame([(i % 3, "same text") for i in range(50)], "doc_id int, text string")
    check_packed(same)


def test_hot_ids_are_spread(spark, tmp_path):
    """Null and one id hold a third of the rows each, all alike, and no shard is above twice the median."""
    same = [(None, "same text"), (7, "same text")] * 400
    docs = spark.createDataFrame([*same, *[(i, f"text {i}") for i in range(400)]], "doc_id int, text string")
    shards = write_tokens(docs, str(tmp_path / "a"), WORD, shard_docs=60)
    sizes = [s.documents for s in shards]
    assert sum(sizes) == 1200 and max(sizes) <= 2 * np.median(sizes)
    hot = sum(len(Reader(s.path).fetch(7)) for s in shards)
    assert hot == 401
    rows = read_tokens(spark, shards).orderBy("start").collect()
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids) and ids.count(-1) == 400
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:], strict=False))


def test_parts_grow_with_pieces_of_one_length(spark):
    rows = [(None, "same text")] * 900 + [(i, "same text") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = pack(docs, BYTE, parts=1, part_pieces=50)
    assert got.count() == 1200
    check_packed(docs, parts=2)
    places = {(r.sequence_id, r.offset) for r in got.collect()}
    assert len(places) == 1200  # numbers of all parts fit together


def test_a_row_repeated_without_end_is_numbered_in_blocks(spark):
    rows = [(None, "same text")] * 900 + [(i, "same text") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    once = pack(docs, BYTE, parts=1, part_pieces=100, block=5).collect()
    again = pack(docs.repartition(5), BYTE, parts=1, part_pieces=100, block=5).collect()
    assert len({(r.sequence_id, r.offset) for r in once}) == 1200
    assert sorted(map(str, once)) == sorted(map(str, again))
    pieces = docs.selectExpr("cast(doc_id as bigint) doc_id", "0 piece", "0L start", "3L length", "5L ids_crc32")
    blocks = _blocks(pieces, np.array([0, 0, 0, 1200]), 1, 100, 5)
    crowd = [r["sum(_copies)"] for r in blocks.groupBy("part").sum("_copies").collect()]
    assert sum(crowd) == 1200 and len(crowd) == 12 and max(crowd) <= 2 * np.median(crowd)
