"""Packing by first-fit decreasing with a tournament tree, in randomised groups of documents.

Documents are dealt out over groups of bounded size by a hash; each group packs by itself.
Longer documents give whole sequences first; the rests and the other documents are placed in
falling order of length, each into the first bin with room.  A tournament tree over the bins'
free capacities finds it in the logarithm of their number.

What first-fit leaves open is closed by cutting: as many of the fullest bins as the tokens in
open bins can fill stay, and the pieces of the other bins, cut where needed, fill their gaps.
The few tokens left become sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tramloom.llm.common import read_table

CAPACITY = 2048
END_ID = 1
#: Bytes of text that share a group: some thousand sequences.
GROUP_BYTES = 8 << 20
SEED = 13
#: Chunks of each of the two caches of a worker.
_CACHED_CHUNKS = 400_000
_WORDS_AT_ONCE = 300
#: Characters that lower case, composition or Python's idea of white space may treat in another
#: way than the tokenizer, and scripts that may still grow.
_ODD = re.compile(r"[^\x00-\x1b\x20-\u012f\u0131-\u024f]")
#: Marks between a letter and white space are one piece of their own.  The look behind comes after
#: the first mark, so that the search runs from mark to mark.
_END_MARKS = re.compile(r"[!-/:-@\[-`{-~](?<=[a-z\u00df-\u00f6\u00f8-\u00ff].)[!-/:-@\[-`{-~]*(?!\S)")


def id_type(tokenizer: Tokenizer) -> str:
    return "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


class SpacedTokenizer(dict):
    """Ids of whole texts for a tokenizer that drops white space and never joins across it.

    What stands between blanks has the same ids wherever it stands, so chunks are looked up and
    only new ones are encoded.  When the cache is full, it becomes the older one, from which
    chunks that are used again return; the oldest go.
    """

    _loaded: dict[str, "SpacedTokenizer"] = {}

    def __init__(self, path: str):
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.kind = np.dtype(id_type(self.whole))
        self.older: dict[str, bytes] = {}
        # For plain words, which the normalizer and the splitting pattern leave as they are.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.whole.model.end_of_word_suffix
        self.ends_word = np.zeros(self.whole.get_vocab_size(), bool)
        if suffix:
            self.ends_word[[i for token, i in self.whole.get_vocab().items() if token.endswith(suffix)]] = True

    @classmethod
    def of(cls, path: str) -> "SpacedTokenizer":
        """One instance per Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    @staticmethod
    def is_plain(word: str) -> bool:
        """Letters only, in lower case and composed; of scripts whose letters are long settled."""
        if word.isascii():
            return word.isalpha() and word.islower()
        return (word.isalpha() and not _ODD.search(word) and word == word.lower()
                and unicodedata.is_normalized("NFC", word))

    def keep(self, chunk: str, ids: bytes) -> None:
        if len(chunk) <= 64:
            if len(self) >= _CACHED_CHUNKS:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            found = np.array(self.whole.encode(chunk, add_special_tokens=False).ids, self.kind).tobytes()
        self.keep(chunk, found)
        return found

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode the plain words among new chunks many at a time: each ends in one word-end token."""
        words = [c for c in chunks if c not in self.older and len(c) <= 64 and self.is_plain(c)]
        for at in range(0, len(words), _WORDS_AT_ONCE):
            own = words[at:at + _WORDS_AT_ONCE]
            ids = np.array(self.plain.encode_batch_fast([" ".join(own)], add_special_tokens=False)[0].ids, self.kind)
            ends = (np.nonzero(self.ends_word[ids])[0] + 1) * self.kind.itemsize
            if len(ends) == len(own):  # otherwise the tokenizer has no such tokens: one by one
                whole = ids.tobytes()
                for word, start, end in zip(own, [0, *ends.tolist()], ends.tolist(), strict=False):
                    self.keep(word, whole[start:end])

    @staticmethod
    def chunks(text: str) -> list[str]:
        """What stands between blanks; where that is safe, in lower case and without a word's end marks."""
        if "<|" in text or _ODD.search(text):
            return text.replace("\n", " ").split(" ")
        return _END_MARKS.sub(r" \g<0>", text.lower()).split()

    def id_bytes(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text, as little-endian integers of ``kind``."""
        cut = [self.chunks(text) for text in texts]
        found = [list(map(self.get, own)) for own in cut]
        new: set[str] = set()
        for own, ids in zip(cut, found, strict=True):
            if None in ids:
                new.update([chunk for chunk, known in zip(own, ids, strict=True) if known is None])
        self.learn(new)
        for own, ids in zip(cut, found, strict=True):
            if None in ids:
                ids[:] = [self[chunk] if known is None else known for chunk, known in zip(own, ids, strict=True)]
        return [b"".join(ids) for ids in found]


# ------------------------------------------------------------------ placing

def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length (at most ``capacity``): its bin and its offset there."""
    order = np.argsort(-lengths, kind="stable").tolist()
    size = 1
    while size < len(order):
        size *= 2
    # The node above two bins holds the larger of their free capacities; leaves start at ``size``.
    free = [capacity] * (2 * size)
    bins, offsets = [0] * len(order), [0] * len(order)
    lengths = lengths.tolist()
    for i in order:
        need, node = lengths[i], 1
        while node < size:
            node *= 2
            if free[node] < need:
                node += 1
        bins[i], offsets[i] = node - size, capacity - free[node]
        free[node] -= need
        while node > 1:
            node //= 2
            larger = max(free[2 * node], free[2 * node + 1])
            if free[node] == larger:
                break
            free[node] = larger
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def packed(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths.

    Every sequence is full or has a power of two of tokens.
    """
    rows: list[np.ndarray] = []
    whole = lengths // capacity
    n_whole = int(whole.sum())
    if n_whole:
        document = np.repeat(np.arange(len(lengths)), whole)
        nth = np.arange(n_whole) - np.repeat(np.cumsum(whole) - whole, whole)
        rows.append(np.stack([document, nth * capacity, np.full(n_whole, capacity), np.arange(n_whole),
                              np.zeros(n_whole, np.int64)], 1))
    rest = lengths - whole * capacity
    document = np.nonzero(rest)[0]
    bins, offsets = first_fit_decreasing(rest[document], capacity)
    pieces = np.stack([document, whole[document] * capacity, rest[document], bins, offsets], 1)
    fill = np.bincount(bins, rest[document]).astype(np.int64)
    closed = fill == capacity
    sequence = np.cumsum(closed) - 1 + n_whole
    done = closed[bins]
    kept = pieces[done]
    kept[:, 3] = sequence[kept[:, 3]]
    rows.append(kept)
    closing = _closed_by_cutting(pieces[~done], fill, capacity, n_whole + int(closed.sum()))
    rows.append(np.array(closing, np.int64).reshape(-1, 5))
    return np.concatenate(rows)


def _closed_by_cutting(pieces: np.ndarray, fill: np.ndarray, capacity: int, sequence: int) -> list[tuple]:
    """The pieces of open bins, some of them cut, in sequences without padding."""
    total = int(pieces[:, 2].sum())
    open_bins = np.unique(pieces[:, 3])
    by_fill = open_bins[np.argsort(-fill[open_bins], kind="stable")]
    stay = {int(b): sequence + i for i, b in enumerate(by_fill[:total // capacity])}
    out, spare = [], []
    for document, start, length, own, offset in pieces.tolist():
        if own in stay:
            out.append((document, start, length, stay[own], offset))
        else:
            spare.append((document, start, length))
    gaps = [(s, int(fill[b]), capacity - int(fill[b])) for b, s in stay.items()]
    sequence += len(stay)
    left = total - len(stay) * capacity
    for bit in reversed(range(left.bit_length())):
        if left >> bit & 1:
            gaps.append((sequence, 0, 1 << bit))
            sequence += 1
    spare.sort(key=lambda piece: piece[2])  # the longest is taken first, so few are cut
    for own, offset, room in gaps:
        while room:
            document, start, length = spare.pop()
            taken = min(length, room)
            out.append((document, start, taken, own, offset))
            offset, room = offset + taken, room - taken
            if taken < length:
                spare.append((document, start + taken, length - taken))
    return out


# ------------------------------------------------------------------ documents

def _encoded(tokenizer_file: str, end_id: int, groups: int):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("group", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = SpacedTokenizer.of(tokenizer_file)
        end = np.array([end_id], tokenizer.kind).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = tokenizer.id_bytes([text or "" for text in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([i + end for i in ids], pa.binary()),
                     pa.array(part.column(2).to_numpy() % groups)], schema=schema)

    return run


def _packed_groups(stored: str, capacity: int, with_ids: bool):
    kind = np.dtype(stored)

    def run(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        doc_ids = table.column("doc_id")
        ids = table.column("ids").to_pylist()
        lengths = np.array([len(i) // kind.itemsize for i in ids], np.int64)
        pieces = packed(lengths, capacity)
        own = [np.frombuffer(ids[d], kind)[s:s + n].astype("<u4").tobytes() for d, s, n in pieces[:, :3].tolist()]
        found = {
            "doc_id": doc_ids.take(pa.array(pieces[:, 0])), "start": pieces[:, 1], "length": pieces[:, 2],
            "ids_crc32": np.array([zlib.crc32(i) for i in own], np.int64), "doc_tokens": lengths[pieces[:, 0]],
            "sequence_id": group << 32 | pieces[:, 3], "offset": pieces[:, 4]}
        if with_ids:
            found["ids"] = pa.array(own, pa.binary())
        return pa.table(found)

    return run


def pack_groups(docs: DataFrame, tokenizer_file: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY,
                group_bytes: int = GROUP_BYTES, with_ids: bool = False) -> DataFrame:
    """Token pieces of ``docs`` (columns doc_id, text) with their place in packed sequences.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and the piece's ids as
    little-endian unsigned 32-bit integers, if asked for).  Every row is packed: null and empty
    texts are one end id, repeated rows are packed as often as they occur, null ids are carried
    along.  An empty table gives no sequence.

    A document's group is a hash of its content and of the input partition it is read in.  So a
    repeated task deals its rows out alike, and rows repeated all over the table do not meet in
    one group: no more than one partition's do.
    """
    path = tokenizer_file or public_tokenizers.path("word_bpe_49k.json")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    groups = max(1, -(-(size[0] + size[1]) // group_bytes))
    dealt = F.xxhash64(F.lit(SEED), "doc_id", "text", F.spark_partition_id())
    encoded = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(dealt, F.lit(1 << 62)).alias("_h"),
    ).mapInArrow(_encoded(path, end_id, groups), "doc_id long, ids binary, group long")
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + (", ids binary" if with_ids else ""))
    return encoded.groupBy("group").applyInArrow(
        _packed_groups(id_type(Tokenizer.from_file(path)), capacity, with_ids), schema)


def op13_ffd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in packed sequences."""
    return pack_groups(read_table(spark, sf_dir, "documents"))
