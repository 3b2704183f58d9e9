"""Phrases that stick together, by sorted count streams.

Counts of phrases of one to five words are one stream, stored twice: in suffix order (phrases by
their words from the last to the first) and in prefix order. In either order the shorter phrases
that begin a phrase stand right before it, so one pass that carries the latest count of each
length gives every row the counts of its beginnings: in prefix order those of its left parts, in
suffix order those of its right parts. The row after a phrase tells likewise whether a longer one
is just as frequent. Nothing is looked up by hash; the two orders are merged by sorting one into
the other.

Only frequent phrases are counted as text. A phrase is not more frequent than its parts, so words
come first, then pairs of frequent words, triples of frequent pairs, and then the longest phrases
all of whose pairs and triples are frequent. Most pairs and triples are rare, so they are first
counted by hash, in buckets that are handed on packed; a bucket holds at least what each phrase in
it counts, so only phrases of frequent buckets go on. The filters between the passes are bitmaps of
a fixed size: what they let through in vain costs time, and exact counts decide in the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import quoted, stored
from footfall.llm.minhash import mixed

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
#: Bits of a filter; it is broadcast, so its size does not depend on the input.
FILTER_BITS = 1 << 26
#: Bits in one value of Spark's bitmap functions.
CHUNK_BITS = 1 << 15
#: Bits that name a bucket within its part; a bucket's number is the first 31 bits of a hash.
BUCKET_BITS = 21
#: The largest count of an entry, which has a byte for it; enough to tell ``min_count`` or more.
MOST = 255
#: Two words by fingerprint and their count.
PAIR = np.dtype([("a", np.int64), ("b", np.int64), ("n", np.int64)])
#: Bytes of text that are cut into words at a time; a longer text is cut at the end of a piece.
SLICE_BYTES = 1 << 22
#: Rows a task gathers before it adds them up and hands them on.
GATHERED = 500_000
#: Rows handed on at a time; the JVM holds a batch outside of its heap.
HANDED_ROWS = 1 << 16
#: Parts of a count stream; None takes the session's shuffle partitions.
STREAM_PARTS = None

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints(langs: list[str], words: list[bytes], seed: int) -> np.ndarray:
    """A 64-bit fingerprint per word of a language."""
    salts = {lang: xxhash.xxh64_intdigest(lang.encode(), seed=seed) for lang in set(langs)}
    found = [xxhash.xxh64_intdigest(w, seed=salts[lang]) for lang, w in zip(langs, words)]
    return np.array(found, dtype=np.uint64)


class Words:
    """The words of several texts: distinct words, the word at each place, and its piece."""

    def __init__(self, data: np.ndarray):
        gap = _GAP[data]
        edge = np.empty(len(data), dtype=bool)
        edge[:1] = True
        edge[1:] = gap[:-1]
        starts = np.flatnonzero(edge & ~gap)
        edge[-1:] = True
        edge[:-1] = gap[1:]
        sizes = np.flatnonzero(edge & ~gap) + 1 - starts
        offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
        # Words side by side, as Arrow lays out strings; its dictionary compares whole words.
        column = pa.Array.from_buffers(
            pa.binary(),
            len(starts),
            [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[~gap]])],
        ).dictionary_encode()
        self.names: pa.Array = column.dictionary
        self.ids = column.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.piece = np.searchsorted(np.flatnonzero(_BREAK[data]), starts)

    def hashes(self, lang: str, seed: int) -> np.ndarray:
        return fingerprints([lang] * len(self.names), self.names.to_pylist(), seed)

    def joined(self, size: int) -> np.ndarray:
        """Whether the words from each place on, ``size`` of them, lie in one piece."""
        return self.piece[size - 1 :] == self.piece[: len(self.piece) - size + 1]


def chained(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A fingerprint of a phrase from that of its beginning and that of its last word."""
    return mixed(mixed(a) + b * np.uint64(0x9E3779B97F4A7C15))


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(33)


def bit_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return bucket_of(hashes).astype(np.int64) % bits


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = bit_of(hashes, len(bitmap) * 8)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _cut(text: bytes) -> Iterator[bytes]:
    """The text in slices that end at the end of a piece, so that no phrase is cut."""
    start = 0
    while len(text) - start > SLICE_BYTES:
        part = np.frombuffer(text, np.uint8, SLICE_BYTES, start)
        breaks = np.flatnonzero(_BREAK[part])
        end = start + SLICE_BYTES
        if len(breaks):
            end = start + int(breaks[-1]) + 1
        else:
            # A piece longer than a slice is taken whole.
            while end < len(text) and not _BREAK[text[end]]:
                end += 1
        yield text[start:end]
        start = end
    if start < len(text):
        yield text[start:]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, texts) of one language at a time, about ``SLICE_BYTES`` of them.

    What is made of them should be made in a function that returns, so that one slice's arrays
    are gone before the next one's are there.
    """
    waiting: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = batch.column(1).cast(pa.large_binary())
        for i, lang in enumerate(langs):
            for part in _cut(texts[i].as_py() or b""):
                waiting.setdefault(lang, []).append(part)
                size[lang] = size.get(lang, 0) + len(part)
                if size[lang] >= SLICE_BYTES:
                    yield lang, waiting.pop(lang)
                    size[lang] = 0
        # What waits is bounded over all languages together, however many there are.
        while sum(size.values()) >= 2 * SLICE_BYTES:
            lang = max(size, key=size.get)
            yield lang, waiting.pop(lang)
            size[lang] = 0
    yield from waiting.items()


def _words(texts: list[bytes]) -> Words:
    # A new line between texts ends the piece.
    return Words(np.frombuffer(b"\n".join(texts), dtype=np.uint8))


def in_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, ``HANDED_ROWS`` at a time."""
    for start in range(0, batch.num_rows, HANDED_ROWS):
        yield batch.slice(start, HANDED_ROWS)


def merged(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.RecordBatch]:
    """The same counts ``n`` by ``keys``, added up over about ``GATHERED`` rows at a time."""

    def added() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).group_by(list(keys), use_threads=False)
        held.clear()
        table = table.aggregate([("n", "sum")]).rename_columns([*keys, "n"])
        yield from table.to_batches(max_chunksize=HANDED_ROWS)

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GATHERED:
            yield from added()
            rows = 0
    if held:
        yield from added()


def by_part(parts: np.ndarray, entries: np.ndarray) -> pa.RecordBatch:
    """``part entries``: the bytes of the entries of each part, which stand side by side."""
    parts, starts = np.unique(parts, return_index=True)
    offsets = (entries.itemsize * np.append(starts, len(entries))).astype(np.int32)
    column = pa.Array.from_buffers(
        pa.binary(), len(parts), [None, pa.py_buffer(offsets), pa.py_buffer(entries)]
    )
    columns = [pa.array(parts.astype(np.int32)), column]
    return pa.RecordBatch.from_arrays(columns, names=["part", "entries"])


def entries_of(part: pa.Table, kind: np.dtype) -> np.ndarray:
    column = part.column("entries").to_pylist()
    return np.concatenate([np.frombuffer(x, kind) for x in column])


def packed(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """``part entries``: how many of the hashes ``found`` are in each bucket, packed by part.

    An entry is four bytes, the bucket's place in its part and a count of ``MOST`` at the most.
    Entries of about ``GATHERED`` buckets are handed on at a time; a bucket may be in them twice.
    """

    def rows() -> Iterator[pa.RecordBatch]:
        entries = np.concatenate(held)
        held.clear()
        entries.sort()
        places = (entries & np.uint64((1 << BUCKET_BITS + 8) - 1)).astype(np.uint32)
        yield by_part(entries >> np.uint64(BUCKET_BITS + 8), places)

    held, size = [], 0
    for hashes in found:
        buckets, n = np.unique(bucket_of(hashes), return_counts=True)
        held.append(buckets << np.uint64(8) | np.minimum(n, MOST).astype(np.uint64))
        size += len(buckets)
        if size >= GATHERED:
            yield from rows()
            size = 0
    if size:
        yield from rows()


def frequent_buckets(counts: DataFrame, min_count: int, bits: int) -> DataFrame:
    """``bit`` of the buckets that ``counts`` (part, entries) give ``min_count`` or more.

    Entries that stop at ``MOST`` hide no bucket, as the sum is not asked for more than that.
    """

    def run(part: pa.Table) -> pa.Table:
        entries = np.sort(entries_of(part, np.uint32))
        places = (entries >> 8).astype(np.int64)
        starts = np.flatnonzero(np.diff(places, prepend=-1))
        n = np.add.reduceat(entries & 255, starts, dtype=np.int64)
        found = places[starts[n >= min(min_count, MOST)]]
        first = part.column("part")[0].as_py() << BUCKET_BITS
        return pa.table({"bit": (first + found) % bits})

    return counts.groupBy("part").applyInArrow(run, "bit long")


def count_words(texts: DataFrame) -> DataFrame:
    """``lang word n`` of parts of a task, for ``texts`` (lang, text)."""

    def counted(lang: str, words: Words) -> pa.RecordBatch:
        n = np.bincount(words.ids, minlength=len(words.names))
        langs = pa.array([lang] * len(words.names), pa.string())
        return pa.RecordBatch.from_arrays(
            [langs, words.names.cast(pa.string()), pa.array(n, pa.int64())],
            names=["lang", "word", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (counted(lang, _words(texts)) for lang, texts in _slices(batches))
        yield from merged(found, "lang", "word")

    return texts.mapInArrow(run, "lang string, word string, n long")


def named_words(words: DataFrame) -> tuple[DataFrame, int]:
    """``words`` (lang, word, n) with ``hash``, and its seed: one that gives no two words one.

    So a pair of fingerprints stands for a pair of words exactly.
    """

    def hashed(seed: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = batch.column(1).cast(pa.binary()).to_pylist()
                found = fingerprints(batch.column(0).to_pylist(), names, seed)
                columns = [*batch.columns, pa.array(found.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n", "hash"])

        schema = "lang string, word string, n long, hash long"
        return stored(words.select("lang", "word", "n").mapInArrow(run, schema), "named-words")

    for seed in count():
        found = hashed(seed)
        if found.groupBy("hash").count().filter("count > 1").isEmpty():
            return found, seed


def bitmap(rows: DataFrame, bits: int) -> bytes:
    """A filter with each ``bit`` of ``rows`` set; the driver gets its ``bits / 8`` bytes."""
    chunks = (
        rows.groupBy(F.expr(f"bit DIV {CHUNK_BITS}").alias("chunk"))
        .agg(F.bitmap_construct_agg(F.col("bit") % CHUNK_BITS).alias("bits"))
        .collect()
    )
    found = bytearray(bits // 8)
    size = CHUNK_BITS // 8
    for row in chunks:
        found[row.chunk * size : (row.chunk + 1) * size] = row.bits
    return bytes(found)


def bits_of_words(named: DataFrame, bits: int) -> DataFrame:
    return named.select(F.expr(f"shiftrightunsigned(hash, 33) % {bits}").alias("bit"))


def _starts(words: Words, size: int, good: np.ndarray) -> np.ndarray:
    """Where phrases of ``size`` good words begin."""
    if len(good) < size:
        return np.empty(0, np.int64)
    fine = words.joined(size)
    for i in range(size):
        fine &= good[i : len(good) - size + 1 + i]
    return np.flatnonzero(fine)


def bucket_pairs(texts: DataFrame, frequent_words, seed: int) -> DataFrame:
    """``part entries`` of parts of a task: pairs of frequent words, by bucket."""

    def pairs(lang: str, words: Words, known: np.ndarray) -> np.ndarray:
        names = words.hashes(lang, seed)
        at = _starts(words, 2, _has(known, names)[words.ids])
        return chained(names[words.ids[at]], names[words.ids[at + 1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(frequent_words.value, np.uint8)
        yield from packed(pairs(lang, _words(texts), known) for lang, texts in _slices(batches))

    return texts.mapInArrow(run, "part int, entries binary")


def _pairs(
    lang: str, words: Words, known: np.ndarray, seed: int, likely: np.ndarray | None = None
) -> pa.RecordBatch:
    """``a b n``: pairs of known words as two fingerprints, of those the filter lets through."""
    names = words.hashes(lang, seed)
    at = _starts(words, 2, _has(known, names)[words.ids])
    if likely is not None:
        at = at[_has(likely, chained(names[words.ids[at]], names[words.ids[at + 1]]))]
    key = words.ids[at] * len(words.names) + words.ids[at + 1]
    key, n = np.unique(key, return_counts=True)
    both = np.divmod(key, max(1, len(words.names)))
    columns = [pa.array(names[x].view(np.int64)) for x in both]
    return pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], names=list("abn"))


def count_pairs(texts: DataFrame, frequent_words, seed: int) -> DataFrame:
    """``a b n`` of parts of a task: pairs of frequent words as two fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(frequent_words.value, np.uint8)
        # Pairs are added up over their slice; gathering more saves few rows and holds many.
        for lang, texts in _slices(batches):
            yield from in_parts(_pairs(lang, _words(texts), known, seed))

    return texts.mapInArrow(run, "a long, b long, n long")


def count_likely_pairs(texts: DataFrame, frequent_words, likely_pairs, seed: int) -> DataFrame:
    """``part entries`` of parts of a task: the same of pairs that pass the filter, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(frequent_words.value, np.uint8)
        likely = np.frombuffer(likely_pairs.value, np.uint8)
        found = (
            _pairs(lang, _words(texts), known, seed, likely) for lang, texts in _slices(batches)
        )
        for batch in merged(found, "a", "b"):
            entries = np.empty(batch.num_rows, PAIR)
            for name in PAIR.names:
                entries[name] = batch.column(name).to_numpy()
            hashes = chained(entries["a"].view(np.uint64), entries["b"].view(np.uint64))
            parts = bucket_of(hashes) >> np.uint64(BUCKET_BITS)
            order = np.argsort(parts)
            yield by_part(parts[order], entries[order])

    return texts.mapInArrow(run, "part int, entries binary")


def frequent_pairs(counts: DataFrame, min_count: int) -> DataFrame:
    """``a b n`` of the pairs that ``counts`` (part, entries) give ``min_count`` or more."""

    def run(part: pa.Table) -> pa.Table:
        entries = entries_of(part, PAIR)
        table = pa.table({name: np.ascontiguousarray(entries[name]) for name in PAIR.names})
        table = table.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
        table = table.rename_columns(["a", "b", "n"])
        return table.filter(pc.greater_equal(table["n"], min_count))

    return counts.groupBy("part").applyInArrow(run, "a long, b long, n long")


def _triples(
    lang: str, words: Words, known: np.ndarray, pairs: np.ndarray, seed: int
) -> np.ndarray:
    """A fingerprint for each place where a triple begins whose two pairs pass."""
    names = words.hashes(lang, seed)
    at = _starts(words, 3, _has(known, names)[words.ids])
    first, second, third = (names[words.ids[at + i]] for i in range(3))
    fine = _has(pairs, chained(second, third))
    begin = chained(first[fine], second[fine])
    fine, third = _has(pairs, begin), third[fine]
    return chained(begin[fine], third[fine])


def bucket_triples(texts: DataFrame, frequent_words, frequent_pairs, seed: int) -> DataFrame:
    """``part entries`` of parts of a task: triples whose two pairs pass, by bucket.

    A triple is only looked for in a filter, so its words are not needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(frequent_words.value, np.uint8)
        pairs = np.frombuffer(frequent_pairs.value, np.uint8)
        yield from packed(
            _triples(lang, _words(texts), known, pairs, seed) for lang, texts in _slices(batches)
        )

    return texts.mapInArrow(run, "part int, entries binary")


def count_triples(texts: DataFrame, frequent_words, frequent_pairs, seed: int) -> DataFrame:
    """``bit n`` of parts of a task: the same as rows, by their bit in the filter."""

    def triples(
        lang: str, words: Words, known: np.ndarray, pairs: np.ndarray
    ) -> pa.RecordBatch:
        hashes = _triples(lang, words, known, pairs, seed)
        bits, n = np.unique(bit_of(hashes, len(pairs) * 8), return_counts=True)
        columns = [pa.array(bits, pa.int64()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["bit", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(frequent_words.value, np.uint8)
        pairs = np.frombuffer(frequent_pairs.value, np.uint8)
        found = (triples(lang, _words(texts), known, pairs) for lang, texts in _slices(batches))
        yield from merged(found, "bit")

    return texts.mapInArrow(run, "bit long, n long")


def bits_of_pairs(pairs: DataFrame, bits: int) -> DataFrame:
    """``bit`` of pairs (a, b), where the passes behind look for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1)
            )
            found = bit_of(chained(a, b), bits)
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["bit"])

    return pairs.select("a", "b").mapInArrow(run, "bit long")


def count_long(
    texts: DataFrame, frequent_words, frequent_short, seed: int, max_words: int
) -> DataFrame:
    """``lang phrase n`` of parts of a task: the longest phrase from each place on, of three to
    ``max_words`` words, whose parts of two and three words pass."""

    def longest(
        lang: str, words: Words, known: np.ndarray, short: np.ndarray
    ) -> Iterator[pa.RecordBatch]:
        names = words.hashes(lang, seed)
        starts = _starts(words, 3, _has(known, names)[words.ids])
        hashes = names[words.ids[starts]]
        for i in (1, 2):
            hashes = chained(hashes, names[words.ids[starts + i]])
            fine = _has(short, hashes)
            starts, hashes = starts[fine], hashes[fine]
        triple = np.zeros(len(words.ids) + max_words, dtype=bool)
        triple[starts] = True
        # The exact number of the phrase of the current length at each start.
        own = words.ids[starts] * len(words.names) + words.ids[starts + 1]
        own = np.unique(own, return_inverse=True)[1]
        for size in range(3, max_words + 1):
            if not len(starts):
                return
            key = own * len(words.names) + words.ids[starts + size - 1]
            _, where, own = np.unique(key, return_index=True, return_inverse=True)
            # It goes on where the next three words are a frequent triple too.
            going = triple[starts + size - 2] & (size < max_words)
            n = np.bincount(own[~going], minlength=len(where))
            begin, n = starts[where[n > 0]], n[n > 0]
            parts = [words.names.take(pa.array(words.ids[begin + i])) for i in range(size)]
            text = pc.binary_join_element_wise(*parts, b" ")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(n), pa.string()),
                    text.cast(pa.string()),
                    pa.array(n, pa.int64()),
                ],
                names=["lang", "phrase", "n"],
            )
            starts, own = starts[going], own[going]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(frequent_words.value, np.uint8)
        short = np.frombuffer(frequent_short.value, np.uint8)
        parts = (
            part
            for lang, texts in _slices(batches)
            for part in list(longest(lang, _words(texts), known, short))
        )
        yield from merged(parts, "lang", "phrase")

    return texts.mapInArrow(run, "lang string, phrase string, n long")


def count_stream(
    texts: DataFrame, max_words: int, min_count: int, filter_bits: int
) -> tuple[DataFrame, DataFrame]:
    """``lang words n`` of all phrases counted ``min_count`` times or more, and ``lang total``."""
    context = texts.sparkSession.sparkContext
    often = F.col("n") >= min_count
    vocabulary = stored(
        count_words(texts).groupBy("lang", "word").agg(F.sum("n").alias("n")), "words"
    )
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent, seed = named_words(vocabulary.filter(often))
    words = context.broadcast(bitmap(bits_of_words(frequent, filter_bits), filter_bits))
    crowded = frequent_buckets(bucket_pairs(texts, words, seed), min_count, filter_bits)
    likely = context.broadcast(bitmap(crowded, filter_bits))
    counted = count_likely_pairs(texts, words, likely, seed)
    pairs = stored(frequent_pairs(counted, min_count), "pairs")
    first = frequent.select(F.col("hash").alias("a"), "lang", F.col("word").alias("w1"))
    second = frequent.select(F.col("hash").alias("b"), F.col("word").alias("w2"))
    named = pairs.join(first, "a").join(second, "b")
    stream = frequent.select("lang", F.array("word").alias("words"), "n").union(
        named.select("lang", F.array("w1", "w2").alias("words"), "n")
    )
    if max_words > 2:
        of_pairs = bits_of_pairs(pairs, filter_bits)
        both = context.broadcast(bitmap(of_pairs, filter_bits))
        triples = bucket_triples(texts, words, both, seed)
        found = of_pairs.union(frequent_buckets(triples, min_count, filter_bits))
        known = context.broadcast(bitmap(found, filter_bits))
        longest = (
            count_long(texts, words, known, seed, max_words)
            .groupBy("lang", "phrase")
            .agg(F.sum("n").alias("n"))
            .select("lang", F.split("phrase", " ").alias("words"), "n")
        )
        # What begins there is counted from the longest phrases.
        sizes = F.sequence(F.lit(3), F.size("words"))
        begins = F.explode(F.transform(sizes, lambda k: F.slice("words", 1, k))).alias("words")
        phrases = longest.select("lang", begins, "n").groupBy("lang", "words")
        stream = stream.union(phrases.agg(F.sum("n").alias("n")).filter(often))
    return stream, totals


def carried(stream: DataFrame, key: Column, max_words: int, into: str) -> DataFrame:
    """``stream`` (lang, words, n, ...) with ``into``: the counts of the beginnings in ``key``.

    ``into[k - 1]`` is the count of the phrase of the first k words of ``key``, for each k below
    the row's own length. The rows are sorted by language and key over all parts, wherever the
    parts' borders fall; a part's first rows get what they need from the last rows of each length
    in the parts before, one row per part. So a word that begins a third of all phrases is
    spread like the others.
    """
    spark = stream.sparkSession
    parts = STREAM_PARTS or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = stored(
        stream.withColumn("key", key)
        .repartitionByRange(parts, "lang", "key")
        .withColumn("part", F.spark_partition_id()),
        "count-stream",
    )
    lengths = range(1, max_words)
    latest = [F.when(F.size("key") == k, F.struct("lang", "key", "n")) for k in lengths]
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = laid.groupBy("part").agg(*[F.max(x).alias(f"end{k}") for k, x in zip(lengths, latest)])
    # One row per part; their number does not depend on the input.
    ends = ends.select(
        "part", *[F.last(f"end{k}", True).over(before)["n"].alias(f"end{k}") for k in lengths]
    )
    here = (
        Window.partitionBy("part")
        .orderBy("lang", "key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = [
        F.last(F.when(F.size("key") == k, F.col("n")), True).over(here).alias(f"in{k}")
        for k in lengths
    ]
    counts = F.slice(
        F.array(*[F.coalesce(f"in{k}", f"end{k}") for k in lengths]), 1, F.size("key") - 1
    )
    return (
        laid.select("*", *found)
        .join(F.broadcast(ends), "part")
        .select(*stream.columns, counts.alias(into))
    )


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    top: int | None = TOP,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``lang rank phrase a l r n score`` of the phrases that stick together most.

    Texts, with A-Z in lower case, are cut at ``. , ; : ! ?`` and the controls 10 to 13 into
    pieces, and these at spaces and tabs into words. All counts are per language; a null language
    is ``und``, a null text is empty. Candidates are phrases of two to ``max_words`` words inside
    a piece that occur ``a >= min_count`` times, overlaps included. Cut after its first k words a
    candidate has parts with ``l`` and ``r`` occurrences, and the cut's score is the floor of
    ``1000 * a * n / (l * r)`` with ``n`` words in all; the lowest score counts, and of equal ones
    that of the smallest k. A candidate is dropped where a longer one that contains it occurs as
    often. The first ``top`` of a language by score, ``a`` (both falling) and phrase remain; None
    keeps all. An empty table gives no rows.

    Products are taken in decimals of 38 digits: exact while ``1000 * a * n`` is below 10 ** 38.
    A slice of ``SLICE_BYTES`` is held at a time, or a piece, if that is longer: about 60 bytes of
    arrays per byte of a text of one-letter words.
    """
    lang = F.coalesce(F.col(quoted(lang_col)).cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.col(quoted(text_col)).alias("text"))
    stream, totals = count_stream(texts, max_words, min_count, filter_bits)
    both = carried(stream, F.reverse("words"), max_words, "suffixes")
    both = stored(carried(both, F.col("words"), max_words, "prefixes"), "phrase-counts")
    size = F.size("words")
    longer = both.filter(size > 2)
    # A phrase inside a longer one that is as frequent is inside one that is one word longer.
    inner = longer.filter("n = element_at(prefixes, -1)").select(
        "lang", F.slice("words", 1, size - 1).alias("words")
    ).union(
        longer.filter("n = element_at(suffixes, -1)").select(
            "lang", F.slice("words", 2, size - 1).alias("words")
        )
    )
    wide = "decimal(38,0)"
    scored = F.transform(
        F.sequence(F.lit(1), size - 1),
        lambda k: F.struct(
            F.call_function(
                "div",
                F.lit(1000).cast("decimal(4,0)")
                * F.col("n").cast("decimal(15,0)")
                * F.col("total").cast("decimal(18,0)"),
                (
                    F.element_at("prefixes", k).cast("decimal(18,0)")
                    * F.element_at("suffixes", size - k).cast("decimal(18,0)")
                ).cast(wide),
            ).alias("score"),
            k.alias("k"),
            F.element_at("prefixes", k).alias("l"),
            F.element_at("suffixes", size - k).alias("r"),
        ),
    )
    kept = (
        both.filter(size > 1)
        .join(inner.hint("merge"), ["lang", "words"], "left_anti")
        .join(totals, "lang")
        .withColumn("cut", F.array_min(scored))
        .select(
            "lang",
            F.array_join("words", " ").alias("phrase"),
            F.col("n").alias("a"),
            "cut.l",
            "cut.r",
            F.col("total").alias("n"),
            "cut.score",
        )
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
