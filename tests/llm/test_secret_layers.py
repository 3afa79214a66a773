from __future__ import annotations

import base64
import bz2
import gzip
import json
import lzma
import random
import time
import tracemalloc
import zlib
from urllib.parse import quote, quote_plus

import pytest
import zstandard
from test_secrets import SECRET, b64, spans

from tripflow.llm.secrets import Scanner

INNER = 'user "name": 1, password=hunter2hunter2, more'


@pytest.mark.parametrize("prefix", ["/files/attach/", "backup_key_", "a/", "ab-", "abc+", "/x/y/z/", ""])
@pytest.mark.parametrize("data", [SECRET.encode(), gzip.compress(SECRET.encode()), SECRET.encode("utf-16"), SECRET.encode("utf-16-be"), b"\0user\0" + SECRET.encode() + b"\0\xff\xfe"])
def test_base64_behind_foreign_symbols(prefix, data):
    run = b64(data).rstrip("=")
    for text in (f"see {prefix}{run} there", f"see {prefix}{run}/next there"):
        found = [s for s in spans(text) if s[1] == 0]
        assert found
        for start, _, end in found:
            assert 4 + len(prefix) <= start < end <= len(text) - 6


def test_places_in_a_path_are_exact():
    text = f"see /files/attach/{b64('xyz ' + SECRET + ' xyz')}/next there"
    first = 4 + len("/files/attach/")
    assert spans(text) == [(first + 5, 0, first + 36)]


@pytest.mark.parametrize("width", [5, 8, 15, 16, 33, 59, 77, 100, 120])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
def test_wrapped_at_any_width(width, end):
    run = b64("some words before it " * 5 + SECRET + " and some words after it" * 5)
    text = "intro:\n" + end.join(run[i : i + width] for i in range(0, len(run), width)) + "\noutro."
    assert [s for s in spans(text) if s[1] == 0]
    packed = base64.urlsafe_b64encode(gzip.compress(INNER.encode())).decode()
    text = "intro:\n" + end.join(packed[i : i + width] for i in range(0, len(packed), width)) + "\noutro."
    assert [s for s in spans(text) if s[1] == 0]


def test_utf16_in_percent_and_compressed_layers():
    for wide in (SECRET.encode("utf-16-le"), SECRET.encode("utf-16-be")):
        text = "a " + "".join(f"%{b:02X}" for b in wide) + " z"
        assert [s for s in spans(text) if s[1] == 0]
        assert [s for s in spans(f"a {b64(gzip.compress(wide))} z") if s[1] == 0]


def test_plain_words_have_no_layers():
    assert Scanner().scan("word\nword\nanother/one_more-long_word_here\nthe end")[1:3] == ([], 0)


COMPRESSORS = {
    "gzip": gzip.compress,
    "zlib": zlib.compress,
    "bzip2": bz2.compress,
    "xz": lzma.compress,
    "zstd": zstandard.ZstdCompressor().compress,
}


def kinds(found):
    return {k for _, k, _ in found}


@pytest.mark.parametrize("name", COMPRESSORS)
def test_a_layer_beyond_the_limit_is_searched_to_its_end(name):
    rng = random.Random(3)
    filler = "".join(f"{rng.randrange(10**9)} filler\n" for _ in range(12_000)).encode()
    data = filler + b" " + b64(SECRET).encode() + b" " + filler + b"AKIA" + b"Z" * 16 + b" " + filler
    for inner in (data, COMPRESSORS["gzip"](data)):
        for limit in (20_000, 100_000):
            scanner = Scanner(limit=limit)
            found = scanner.scan(b64(COMPRESSORS[name](inner)))
            assert kinds(found[1]) >= {0, 1} and found[3] >= 1
    scanner = Scanner(limit=4_000)  # a secret across every place where a window may end
    for before in range(3_970, 4_010):
        assert kinds(scanner.scan(b64(COMPRESSORS[name](b" " * before + SECRET.encode() + b" " * 9_000)))[1]) >= {0}


@pytest.mark.parametrize("name", COMPRESSORS)
def test_all_members_of_joined_streams(name):
    pack = COMPRESSORS[name]
    joined = pack(b"nothing here at all, but enough of it") + pack(SECRET.encode()) + gzip.compress(b"AKIA" + b"Z" * 16)
    assert kinds(spans(f"a {b64(joined)} z")) >= {0, 1}


@pytest.mark.parametrize("name", COMPRESSORS)
def test_compressed_bytes_behind_escapes(name):
    data = COMPRESSORS[name]((SECRET + " and some more text, and more of it").encode())
    every = {
        "x": "".join(f"\\x{b:02x}" for b in data),
        "u": "".join(f"\\u{b:04x}" for b in data),
        "repr": repr(data),
        "json": json.dumps(data.decode("latin-1")),
        "quote": quote(data),
        "quote_plus": quote_plus(data),
    }
    for how, text in every.items():
        found = [s for s in spans(f"before {text} after") if s[1] == 0]
        assert found, how
        assert all(7 <= start < end <= 13 + len(text) for start, _, end in found)
        assert [s for s in spans(b64(f"before {text} after")) if s[1] == 0], how


def test_a_large_bomb_is_searched_in_little_memory():
    pack = zlib.compressobj(9, zlib.DEFLATED, 31)
    bomb = b"".join([pack.compress(b" " * (1 << 20)) for _ in range(200)] + [pack.compress(SECRET.encode()), pack.flush()])
    tracemalloc.start()
    found = Scanner(limit=4 << 20).scan(b64(bomb))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert kinds(found[1]) == {0} and found[3] == 1 and peak < 60 << 20


def noise(rng, size):
    return rng.randbytes(size)


ENCODINGS = {
    "base64": lambda data: base64.b64encode(data),
    "wrapped": lambda data: base64.encodebytes(data),
    "urlsafe": lambda data: base64.urlsafe_b64encode(data),
    "percent": lambda data: "".join(f"%{b:02x}" for b in data).encode(),
    "quote_plus": lambda data: quote_plus(data).encode(),
    "repr": lambda data: repr(data).encode(),
    "escapes": lambda data: "".join(f"\\u00{b:02x}" for b in data).encode(),
    "plain": lambda data: data,
}


@pytest.mark.parametrize("how", ENCODINGS)
@pytest.mark.parametrize("name", ["gzip", "xz"])
def test_a_run_longer_than_a_window_keeps_its_secret(how, name):
    rng = random.Random(11)
    data = COMPRESSORS[name](noise(rng, 60_000) + b" " + SECRET.encode() + b" " + noise(rng, 30_000))
    inner = b"some words. " * 40 + ENCODINGS[how](data) + b" and more words."
    text = f"see {b64(COMPRESSORS['gzip'](inner))} there"
    found = Scanner(limit=20_000).scan(text)
    assert kinds(found[1]) >= {0} and all(4 <= s < e <= len(text) - 6 for s, _, e in found[1])


def test_layers_beyond_the_limit_may_nest():
    rng = random.Random(12)
    data = SECRET.encode() + noise(rng, 40_000)
    for _ in range(3):
        data = noise(rng, 15_000) + b" " + base64.b64encode(gzip.compress(data)) + b" " + noise(rng, 15_000)
    assert kinds(Scanner(limit=10_000).scan(b64(zlib.compress(data)))[1]) >= {0}


def test_a_self_reproducing_stream_ends():
    empty = gzip.compress(b"")
    assert Scanner().scan(b64(empty * 50))[1] == []
    data = SECRET.encode()
    for _ in range(150):
        data = zlib.compress(data)
    assert kinds(spans(b64(data))) == {0}


def test_long_runs_take_time_in_proportion():
    rng = random.Random(13)
    times = []
    for size in (750_000, 3_000_000):
        run = b64(noise(rng, size))
        began = time.process_time()
        Scanner().scan(run)
        times.append(time.process_time() - began)
    assert times[1] < 8 * times[0]


@pytest.mark.parametrize("escape", ["\\x41", "\\u0041", "%41"])
def test_a_long_line_with_one_escape_takes_little_memory(escape):
    text = "a b" * 400_000 + escape + " " + SECRET
    tracemalloc.start()
    found = Scanner().scan(text)[1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert kinds(found) == {0} and peak < 20 * len(text)
