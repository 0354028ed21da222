"""Token ids of whole texts, by a public vocabulary file.

A text is cut at ASCII white space, which this vocabulary drops, so its ids are
the ids of its chunks in order. A chunk of plain Latin-1 characters is split by
the vocabulary's own pattern and merged by byte pairs; any other chunk goes
through the full tokenizer. Both give what the full tokenizer gives for the
whole text, and chunks seen before are looked up."""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Printable ASCII and Latin-1: NFC and lower-casing treat each alone, and its
# class is the same in every Unicode version.
SIMPLE = re.compile(r"[!-~\xa1-\xff]+")
WORD_END = b"\xff"  # no UTF-8 text holds this byte
CHUNKS_KEPT = 400_000
LONGEST_KEPT = 64


def _byte_characters() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    ones stand for themselves, the others for those from 256 up, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class _Kept(dict):
    """Values by key, worked out when first asked for; emptied when it is full."""

    def __init__(self, work, most: int):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, key):
        value = self.work(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Ids of a UTF-8 text as packed little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str = VOCABULARY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            description = json.load(file)
        self.special = [token["content"] for token in description["added_tokens"]]
        self.special_in = re.compile("|".join(map(re.escape, self.special)) or "(?!)").search
        characters, ranks = _byte_characters(), {}
        for token, rank in description["model"]["vocab"].items():
            if token not in self.special:
                end = token.endswith("</w>")
                raw = bytes(characters[c] for c in (token[:-4] if end else token))
                ranks[raw + WORD_END * end] = rank
        self.merge = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})._core_bpe.encode_single_piece
        self.words = regex.compile(PATTERN).findall
        self.of_word = _Kept(lambda word: _packed(self.merge(word.encode() + WORD_END)), CHUNKS_KEPT)
        self.of_chunk = _Kept(self._chunk, CHUNKS_KEPT)

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if SIMPLE.fullmatch(text) and not self.special_in(text):
            return b"".join(map(self.of_word.__getitem__, self.words(text.lower())))
        return _packed(self.full.encode(text, add_special_tokens=False).ids)

    def packed(self, text: bytes) -> bytes:
        return b"".join(map(self.of_chunk.__getitem__, text.split()))


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()
