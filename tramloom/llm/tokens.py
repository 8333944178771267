"""Byte-pair ids of whole texts, with a bounded cache of the chunks between blanks."""

from __future__ import annotations

import base64
import re

import numpy as np
import tiktoken
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

#: Two white-space characters in a row: a blank beside them does not end a chunk.
DOUBLE_SPACE = re.compile(r"\s\s")
#: A single blank between two characters that are not white space.
LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
CACHE_ENTRIES = 300_000


class ChunkedTokenizer(dict):
    """Ids as little-endian unsigned 32-bit integers, equal to those of the ``tokenizers`` file.

    The vocabulary's pattern starts a new piece at a lone blank, so what lies between two of
    them has the same ids wherever it stands.  Chunks are looked up; new ones are encoded by
    the rank file of the same vocabulary.  Texts with a special token's string go through the
    ``tokenizers`` file as a whole.  The cache empties itself when it is full.
    """

    _loaded: dict[tuple[str, str], "ChunkedTokenizer"] = {}

    def __init__(self, tokenizer_file: str, ranks_file: str):
        super().__init__()
        self.whole = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, tokenizer_file: str, ranks_file: str) -> "ChunkedTokenizer":
        """One instance per Python worker."""
        key = (tokenizer_file, ranks_file)
        if key not in cls._loaded:
            cls._loaded[key] = cls(*key)
        return cls._loaded[key]

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        found = np.array(self.ranks.encode_ordinary(chunk), "<u4").tobytes()
        if len(chunk) <= 64:
            self[chunk] = found
        return found

    def id_bytes(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        cut = LONE_BLANK.split(text) if DOUBLE_SPACE.search(text) else text.split(" ")
        if text[:1] == " " and len(cut) > 1 and not cut[0]:  # the text starts with a lone blank
            cut = cut[1:]
            return b"".join([self[" " + c] for c in cut])
        return self[cut[0]] + b"".join([self[" " + c] for c in cut[1:]])
