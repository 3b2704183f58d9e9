"""Spelling variants: words one edit apart, found by pivotal grams.

The bigrams of a word, rarest first, have a prefix of three. One edit destroys bigrams at no more
than two neighbouring places, so of two bigrams that do not overlap, the pivots, one survives in
any word one edit away; and if that word's prefix reaches as far in the order of grams, the
survivor is in it, one place off at the most. So the pivots of each word are looked up among the
prefixes of the words whose prefix ends later, at the places and lengths an edit allows, and what
is found is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import quoted, stored

#: Runs of these are words; the alphabet has at most 90 letters once A-Z are in lower case, so
#: there are 8,100 bigrams at the most, whatever the corpus.
LETTERS = "a-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form is so many times as frequent as its variant.
TIMES = 5
#: One occurrence in so many loses a letter, by its checksum.
DAMAGE = 199
#: Grams of a prefix: q * edits + 1; pivots: edits + 1.
GRAM, PREFIX, PIVOTS = 2, 3, 2
#: (length, place) of the other word's gram against the own one, for one edit.
SHIFTS = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))
#: Rows of one key that are compared in one piece.
BLOCK_ROWS = 2048
#: Characters searched at a time, and words a task gathers before it hands them on.
SLICE_CHARS, GATHERED = 1 << 22, 200_000


def _runs(text: str, find: re.Pattern, gap: re.Pattern) -> Iterator[list[str]]:
    """The runs of a text, slice by slice; a slice ends between runs."""
    start = 0
    while start < len(text):
        stop = start + SLICE_CHARS
        if stop < len(text):
            border = gap.search(text, stop)
            stop = border.start() if border else len(text)
        yield find.findall(text, start, stop)
        start = stop


def damaged(run: str, checksum: int, one_in: int = DAMAGE) -> str:
    """The run without the letter its checksum names, if it names one."""
    if checksum % one_in:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def count_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    damage: int = DAMAGE,
) -> DataFrame:
    """``word n`` of the words with that many letters and occurrences.

    Words are maximal runs of ``LETTERS`` with A-Z in lower case. An occurrence of a run in
    a document is damaged where ``damage`` divides the CRC-32 of ``<id>:<run>``; a null id is
    written as nothing. A text is searched whole, ``SLICE_CHARS`` at a time.
    """
    texts = docs.select(
        F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")).alias("id"),
        F.col(quoted(text_col)).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A damaged run may have one letter more than the word it becomes.
        find = re.compile(f"[{LETTERS}]{{{min_length},}}")
        gap = re.compile(f"[^{LETTERS}]")
        found: Counter[str] = Counter()

        def batch_of() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(found.values(), pa.int64())],
                names=["word", "n"],
            )
            found.clear()
            return rows

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for i, id_ in enumerate(batch.column(0).to_pylist()):
                # Bytes are lower-cased in A-Z alone.
                text = (texts[i].as_py() or b"").lower().decode("utf-8", "replace")
                start = zlib.crc32(f"{id_}:".encode())
                for runs in _runs(text, find, gap):
                    for word, n in Counter(runs).items():
                        found[damaged(word, zlib.crc32(word.encode(), start), damage)] += n
                if len(found) >= GATHERED:
                    yield batch_of()
        if found:
            yield batch_of()

    return (
        texts.mapInArrow(run, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= min_count) & (F.char_length("word") >= min_length))
    )


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """gram -> (place from the rarest, number of places it has), of ``words`` (word).

    At most 8,100 rows come to the driver, by the alphabet.
    """
    at = F.sequence(F.lit(1), F.char_length("word") - (GRAM - 1))
    grams = words.select(F.explode(F.transform(at, lambda i: F.substring("word", i, GRAM))).alias("g"))
    counts = sorted((r["count"], r["g"]) for r in grams.groupBy("g").count().collect())
    return {gram: (i, n) for i, (n, gram) in enumerate(counts)}


def signature(
    word: str, order: Mapping[str, tuple[int, int]]
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(prefix, pivots) of a word, as (gram, place) pairs.

    The prefix holds the ``PREFIX`` rarest grams, and every other place of the last of them, so
    that it is cut between grams and not between places of one. The pivots are ``PIVOTS`` grams
    of it that do not overlap and are rarest together, by dynamic programming over its places:
    the best choice of k grams up to a place either leaves out the gram there, or adds it to the
    best choice of k - 1 grams that end before it.
    """
    grams = [(order[word[i : i + GRAM]], i) for i in range(len(word) - GRAM + 1)]
    ranked = sorted((rank, i, n) for (rank, n), i in grams)
    last = ranked[PREFIX - 1][0]
    prefix = [g for g in ranked if g[0] <= last]
    places = sorted(prefix, key=lambda g: g[1])
    best: list[list[tuple | None]] = [[(0, ())] + [None] * PIVOTS]
    for j, (rank, i, n) in enumerate(places):
        free = j
        while free and places[free - 1][1] + GRAM > i:
            free -= 1
        row = list(best[j])
        for k in range(1, PIVOTS + 1):
            if before := best[free][k - 1]:
                choice = (before[0] + n, (*before[1], (rank, i)))
                row[k] = min(row[k], choice) if row[k] else choice
        best.append(row)
    return [(rank, i) for rank, i, _ in prefix], list(best[-1][PIVOTS][1])


def signatures(words: DataFrame, order: Mapping[str, tuple[int, int]]) -> DataFrame:
    """``word n length last prefix pivots`` for ``words`` (word, n); grams as numbers."""
    held = words.sparkSession.sparkContext.broadcast(dict(order))
    pairs = pa.list_(pa.struct([("gram", pa.int32()), ("place", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            signed = [signature(word, held.value) for word in names]
            arrays = [
                pa.array(
                    [[{"gram": g, "place": i} for g, i in s[part]] for s in signed], pairs
                )
                for part in (0, 1)
            ]
            lasts = [max(g for g, _ in prefix) for prefix, _ in signed]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(w) for w in names], pa.int32()),
                    pa.array(lasts, pa.int32()),
                    *arrays,
                ],
                names=["word", "n", "length", "last", "prefix", "pivots"],
            )

    part = "array<struct<gram:int,place:int>>"
    return words.mapInArrow(
        run, f"word string, n long, length int, last int, prefix {part}, pivots {part}"
    )


def near_pairs(signed: DataFrame) -> DataFrame:
    """``a na b nb``: the unordered pairs of words one edit apart, each once.

    A key is (gram, place, length). The rows of a frequent key are dealt to blocks on both sides
    and every pair of blocks is a task's worth of its own, so no key is too large for one.
    """
    key = ["gram", "place", "length"]
    own = ["word", "n", "last"]
    index = signed.select(*own, "length", F.inline("prefix")).select(*key, *own)
    shifts = F.array(*[F.struct(F.lit(a).alias("dl"), F.lit(b).alias("dp")) for a, b in SHIFTS])
    probes = (
        signed.select(*own, "length", F.inline("pivots"))
        .select("*", F.inline(shifts))
        .select("gram", (F.col("place") + F.col("dp")).alias("place"),
                (F.col("length") + F.col("dl")).alias("length"), *own)
    )

    def blocks(frame: DataFrame, name: str) -> DataFrame:
        return frame.groupBy(*key).agg(F.expr(f"count(*) DIV {BLOCK_ROWS} + 1").alias(name))

    keys = stored(blocks(index, "ni").join(blocks(probes, "np"), key), "gram-keys")

    def dealt(frame: DataFrame, mine: str, other: str) -> DataFrame:
        """The rows of keys that both sides have, each in a block and beside all of the other."""
        return (
            frame.join(keys, key)
            .withColumn("b" + mine, F.pmod(F.xxhash64("word"), F.col("n" + mine)).cast("int"))
            .withColumn("b" + other, F.explode(F.expr(f"sequence(0, cast(n{other} - 1 AS int))")))
            .select(*key, "bi", "bp", *own)
        )

    a, b = dealt(probes, "p", "i").alias("a"), dealt(index, "i", "p").alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*key, "bi", "bp")]
    # Of two words the one whose prefix ends first looks for the other.
    first = F.struct("a.last", "a.word") < F.struct("b.last", "b.word")
    one_edit = F.levenshtein("a.word", "b.word", 1) >= 0
    condition = same[0]
    for more in (*same[1:], first, one_edit):
        condition = condition & more
    return (
        a.join(b, condition)
        .select(
            F.col("a.word").alias("a"), F.col("a.n").alias("na"),
            F.col("b.word").alias("b"), F.col("b.n").alias("nb"),
        )
        .dropDuplicates(["a", "b"])
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word root`` for ``forms`` (word, form): where the forms lead to in the end.

    Each round follows as many steps as all rounds before it, and a form is several times as
    frequent as its word, so the rounds are few whatever the corpus.
    """
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(
            now.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")
            ),
            "roots",
        )
        now = after.select("word", "root")
        if after.filter("on").isEmpty():
            return now


def group_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    times: int = TIMES,
    damage: int = DAMAGE,
) -> DataFrame:
    """One row per word: ``word n n_near form form_n root``.

    For the words see :func:`count_words`. Two words are near if one letter inserted, deleted or
    replaced makes one the other. ``form`` is the most frequent near word, of equal ones the
    first in code-point order, if it occurs ``times`` as often; ``root`` is where the forms lead,
    the word itself if it has none. A null or empty text has no words; an empty table gives no
    rows; repeated rows count as often as they come; other columns play no part.
    """
    if min_length < PREFIX + 1:
        raise ValueError(f"words must have {PREFIX + 1} letters or more")
    words = stored(count_words(docs, id_col, text_col, min_length, min_count, damage), "word-counts")
    signed = stored(signatures(words, gram_order(words)), "word-signatures")
    pairs = stored(near_pairs(signed), "near-words")
    both = pairs.select("a", "b", "nb").union(pairs.select("b", "a", "na"))
    # Negative counts put the most frequent word first and the smallest of equals with it.
    near = both.toDF("word", "near", "near_n").groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("top"),
    )
    formed = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("top.n") >= times * F.col("n"), F.col("top")).alias("top"),
        ),
        "word-forms",
    )
    found = roots(formed.filter("top IS NOT NULL").select("word", F.col("top.word").alias("form")))
    return formed.join(found, "word", "left").select(
        "word",
        "n",
        "n_near",
        F.col("top.word").alias("form"),
        (-F.col("top.n")).alias("form_n"),
        F.coalesce("root", "word").alias("root"),
    )
