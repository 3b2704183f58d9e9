"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

A rank file names byte strings in the order they may be formed. The tokenizers library works on
characters, so every byte is given a printable character; decoding goes back from ids to bytes,
and only a whole text is read as UTF-8 again, because a token may hold part of a character.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Characters that go through the tokenizer at a time; bounds the memory of a task.
SLICE_CHARS = 1 << 18
#: No match of the split pattern runs from other characters into one of these blanks, so a text
#: may be cut in front of them.
CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85\xa0])(?=[ \t\n\r])")


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class ByteBpe:
    """One rank file as a tokenizer, and its ids as bytes."""

    def __init__(self, path: str):
        # A task is one thread of Spark's; more threads would only hold more memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            ranks = {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}
        characters = byte_characters()
        name = {t: "".join(characters[b] for b in t) for t in ranks}
        # A token may be formed from any two others it consists of, as soon as its rank is the
        # lowest in sight; so all its splits are merges, in the order of the ranks.
        merges = []
        for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
            splits = [(token[:i], token[i:]) for i in range(1, len(token))]
            known = [(a, b) for a, b in splits if a in ranks and b in ranks]
            known.sort(key=lambda x: (ranks[x[0]], ranks[x[1]]))
            merges += [(name[a], name[b]) for a, b in known]
        vocabulary = {name[t]: rank for t, rank in ranks.items()}
        self.tokenizer = Tokenizer(
            models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True)
        )
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(
            add_prefix_space=False, use_regex=True
        )
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order; memory is bounded by ``SLICE_CHARS``.

        Only a run of letters, digits or signs that is longer than that stays in one piece.
        """
        waiting: list[tuple[str, bool]] = []  # piece, and whether its text ends with it
        size = 0
        parts: list[np.ndarray] = []
        for text in texts:
            pieces = list(cut(text)) or [""]
            for i, piece in enumerate(pieces):
                waiting.append((piece, i == len(pieces) - 1))
                size += len(piece)
                if size >= SLICE_CHARS:
                    yield from self._flush(waiting, parts)
                    waiting, size = [], 0
        yield from self._flush(waiting, parts)

    def _flush(self, waiting, parts) -> Iterator[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(
            [piece for piece, _ in waiting], add_special_tokens=False
        )
        for encoding, (_, last) in zip(found, waiting, strict=True):
            parts.append(np.array(encoding.ids, dtype=np.int32))
            if last:
                yield parts[0] if len(parts) == 1 else np.concatenate(parts)
                parts.clear()

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, which need not be whole characters."""
        return self._bytes(np.asarray(ids, dtype=np.int64)).tobytes()

    def _bytes(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.blob[shift + np.arange(len(shift))]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """For each id the number of the character in which it starts.

        A character that is split over several ids counts for each of them.
        """
        ids = np.asarray(ids, dtype=np.int64)
        data = self._bytes(ids)
        first = (data & 0xC0) != 0x80  # bytes that begin a character
        number = np.cumsum(first) - 1
        at = np.cumsum(self.lengths[ids]) - self.lengths[ids]
        return number[at].astype(np.int32) if len(ids) else np.empty(0, np.int32)


def cut(text: str) -> Iterator[str]:
    """The text in pieces of about ``SLICE_CHARS``, cut where no match of the pattern can be."""
    start = 0
    while len(text) - start > SLICE_CHARS:
        found = CUT.search(text, start + SLICE_CHARS)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    if start < len(text) or not start:
        yield text[start:]


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """One per worker and file."""
    return ByteBpe(path)


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=kind))


#: Columns that encoding and decoding add.
ADDED = ("ids", "starts", "packed", "decoded")


def encode(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    offsets: bool = False,
    packed: bool = False,
    decoded: bool = False,
    batch_rows: int = 256,
) -> DataFrame:
    """``docs`` with ``ids`` (array of int) from the rank file at ``path``.

    Every match of the usual split pattern is encoded by itself; there are no special tokens,
    their strings are ordinary text. ``offsets`` adds ``starts``, the number of the character
    each id starts in; ``packed`` adds the ids as little-endian 32-bit integers, as files hold
    them; ``decoded`` adds the bytes that :func:`decode` makes of the ids, in the same pass. A
    null or empty text has no ids. Own columns of these names are replaced. The file has to be
    installed on every executor.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])
    at = docs.columns.index(text_col)
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
    if offsets:
        fields.append(T.StructField("starts", T.ArrayType(T.IntegerType(), False), False))
    if packed:
        fields.append(T.StructField("packed", T.BinaryType(), False))
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in batches:
            for start in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(start, batch_rows)
                texts = [x or "" for x in batch.column(at).to_pylist()]
                ids = list(bpe.encode(texts))
                added = [_lists(ids, pa.int32())]
                if offsets:
                    added.append(_lists([bpe.offsets(x) for x in ids], pa.int32()))
                if packed:
                    added.append(pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()))
                if decoded:
                    added.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
                names = [*batch.schema.names, *(f.name for f in fields)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def decode(
    encoded: DataFrame, path: str, ids_col: str = "ids", batch_rows: int = 256
) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the ids, none for null.

    ``CAST(decoded AS STRING)`` is the text wherever the ids are those of a whole text. An id
    that the file does not have is an error.
    """
    encoded = encoded.drop(*[c for c in encoded.columns if c.lower() == "decoded"])
    at = encoded.columns.index(ids_col)
    schema = T.StructType(
        [*encoded.schema.fields, T.StructField("decoded", T.BinaryType(), False)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in batches:
            for start in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(start, batch_rows)
                lists = batch.column(at)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                texts = [bpe.decode(flat[e - n : e]) for n, e in zip(sizes, ends, strict=True)]
                added = pa.array(texts, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, added], names=[*batch.schema.names, "decoded"]
                )

    return encoded.mapInArrow(run, schema)
