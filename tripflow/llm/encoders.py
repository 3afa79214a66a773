"""Encoding whole texts with a public tokenizer, many times as fast where that is safe."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np

# Characters on whose class all regular-expression engines agree; a text with any other
# goes through the tokenizers library.
_UNSURE = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]")
_WORD_END = "\x01"  # not among the characters above

# How the two kinds of tokenizer cut a text into words.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANKLESS_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The latter for lower-cased text of the characters above, letters first.
_BLANKLESS = re.compile(r"[a-zß-öø-ʯⱥⱦªµº]+|'(?:s|t|re|ve|m|ll|d)|[\d²³¹¼½¾]|(?:[^\w\s]|_)+")


def byte_letters() -> dict[str, int]:
    """Letters byte-level vocabularies write for bytes: printable ones for themselves, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """The ids ``Tokenizer.encode(text, add_special_tokens=False)`` gives, as 32-bit words.

    tiktoken merges by the rank of what a merge yields, the tokenizers library by the rank
    of the pair. Both agree where every token of a vocabulary is what its own letters merge
    to, and tests check that of the files used. Texts with special tokens or uncommon
    characters, and tokenizers of other kinds, go through the library.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t["content"] for t in definition["added_tokens"]]
        self.fast = _fast(definition)

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        for text in texts:
            if self.fast and not _UNSURE.search(text) and not any(s in text for s in self.special):
                yield self.fast(text)
            else:
                found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
                yield np.array(found[0].ids, dtype="<u4")


def _fast(definition: dict) -> Callable[[str], np.ndarray] | None:
    """Encoder of texts without special tokens, for the two kinds of tokenizer known here."""
    model, pre = definition["model"], definition["pre_tokenizer"] or {"type": None}
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback"))
    if not plain or model["type"] != "BPE":
        return None
    ending = model.get("end_of_word_suffix") or ""
    if pre["type"] == "ByteLevel" and not definition["normalizer"] and not ending:
        if not pre["use_regex"] or pre["add_prefix_space"]:
            return None
        encoding, ids = _ranked(model, "", BYTE_LEVEL_WORDS)
        return lambda text: ids[_ranks(encoding, text)]
    steps = pre.get("pretokenizers", [])
    if not ending or pre["type"] != "Sequence" or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
        return None
    split, level = steps
    kinds = [n["type"] for n in (definition["normalizer"] or {}).get("normalizers", [])]
    if (
        kinds != ["NFC", "Replace", "Lowercase"]
        or split["pattern"].get("Regex") != BLANKLESS_WORDS
        or not split["invert"]
        or split["behavior"] != "Removed"
        or level["add_prefix_space"]
        or level["use_regex"]
    ):
        return None
    encoding, ids = _ranked(model, ending, f"[^{_WORD_END}]+{_WORD_END}")

    def encode(text: str) -> np.ndarray:
        words = _BLANKLESS.findall(text.lower())
        if not words:
            return np.zeros(0, dtype="<u4")
        return ids[_ranks(encoding, _WORD_END.join(words) + _WORD_END)]

    return encode


def _ranks(encoding, text: str) -> np.ndarray:
    return np.frombuffer(array("I", encoding.encode_ordinary(text)), "<u4")


def _ranked(model: dict, ending: str, words: str):
    """tiktoken encoding of the vocabulary, and its ids by rank.

    A word's end is a byte of its own here. It joins the letter before it ahead of all
    merges, which is the state such a word starts from.
    """
    import tiktoken

    letters = byte_letters()
    names = {b: c for c, b in letters.items()}
    end = _WORD_END.encode() if ending else b""

    def octets(token: str) -> bytes:
        ends = bool(ending) and token.endswith(ending)
        return bytes(letters[c] for c in (token[: -len(ending)] if ends else token)) + (end if ends else b"")

    tokens = [names[b] for b in range(256)]
    tokens += [names[b] + ending for b in range(256)] if ending else []
    for pair in model["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        # only the right part can end a word
        tokens.append(left + right)
    ranks = {octets(t): i for i, t in enumerate(tokens)}
    if len(ranks) < len(tokens):
        raise ValueError("two merges yield one token")
    ids = np.array([model["vocab"][t] for t in tokens], dtype="<u4")
    return tiktoken.Encoding("own", pat_str=words, mergeable_ranks=ranks, special_tokens={}), ids
