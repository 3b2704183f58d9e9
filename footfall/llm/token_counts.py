"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

The best way to cut a pre-token into vocabulary entries is found from left to right: the best
score up to a place needs only the best scores up to earlier places. Pre-tokens that begin alike
share those scores, so the distinct pre-tokens of a batch are walked as a trie, in sorted order:
the path to the last pre-token is kept, and the next one goes on from the node where it branches
off. Every trie node is computed once, and a terminal node stores its number of tokens.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Scores are whole numbers, in units of 1/1024 of a natural logarithm, so that sums are exact.
UNIT = 1024
#: Characters of text that are split at a time, and the pre-tokens a task remembers: when there
#: are more, it starts anew. Neither changes a result; longer pre-tokens are not remembered.
SLICE_CHARS, REMEMBERED, LONGEST = 1 << 19, 400_000, 64


def zipf_scores(ranks: dict[bytes, int], shift: float = 2.7) -> dict[bytes, int]:
    """Log probabilities of a ranked vocabulary by Zipf's law, 1 / (rank + shift), normalised.

    A byte that is not in the vocabulary costs ten more than its rarest entry.
    """
    if ranks:
        total = math.log(sum(1 / (r + shift) for r in ranks.values()))
        scores = {t: -round(UNIT * (math.log(r + shift) + total)) for t, r in ranks.items()}
    else:
        scores = {}
    unknown = min(scores.values(), default=0) - 10 * UNIT
    return {**{bytes([b]): unknown for b in range(256)}, **scores}


def terminal_counts(words: list[bytes], scores: dict[bytes, int]) -> list[int]:
    """For sorted distinct ``words`` the number of tokens of the best cut.

    The best cut has the largest sum of scores and, among equals, the fewest tokens.
    """
    longest = max(map(len, scores))
    get = scores.get
    best, tokens = [0], [0]  # by depth, along the path to the last word
    last = b""
    found = []
    for word in words:
        shared, most = 0, min(len(last), len(word))
        if last[:most] == word[:most]:
            shared = most
        else:
            while last[shared] == word[shared]:
                shared += 1
        del best[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            high = fewest = None
            for start in range(max(0, end - longest), end):
                score = get(word[start:end])
                if score is not None:
                    score += best[start]
                    if (
                        high is None
                        or score > high
                        or (score == high and tokens[start] + 1 < fewest)
                    ):
                        high, fewest = score, tokens[start] + 1
            best.append(high)
            tokens.append(fewest)
        found.append(tokens[-1])
        last = word
    return found


class Counter:
    """Counts tokens of texts; remembers the counts of pre-tokens within fixed bounds."""

    def __init__(self, scores: dict[bytes, int], pattern: str):
        import regex

        self.scores = scores
        self.split = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> Iterator[tuple[int, int]]:
        """(pre-tokens, tokens) of each text, in order."""
        waiting: list[str] = []
        size = 0
        for text in texts:
            waiting.append(text)
            size += len(text)
            if size >= SLICE_CHARS:
                yield from self._flush(waiting)
                waiting, size = [], 0
        yield from self._flush(waiting)

    def _flush(self, texts: list[str]) -> Iterator[tuple[int, int]]:
        lists = [self.split.findall(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = {word for words in lists for word in words if word not in known}
        ordered = sorted((word.encode("utf-8", "replace"), word) for word in new)
        counts = terminal_counts([data for data, _ in ordered], self.scores)
        long = {}
        for (_, word), n in zip(ordered, counts, strict=True):
            (known if len(word) <= LONGEST else long)[word] = n
        for words in lists:
            if long:
                yield len(words), sum(long.get(w) or known[w] for w in words)
            else:
                yield len(words), sum(map(known.__getitem__, words))


@lru_cache(maxsize=2)
def _counter(path: str, pattern: str) -> Counter:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        ranks = {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}
    return Counter(zipf_scores(ranks), pattern)


def count_tokens(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``n_pretokens`` and ``n_tokens`` under the vocabulary at ``path``.

    ``pattern`` splits the whole text into pre-tokens; each is cut into entries of the
    vocabulary by itself. A null or empty text has none. Own columns of these names are
    replaced. No rows are moved: each task walks the trie of its own pre-tokens, so a word that
    fills the corpus costs each task one path. Without ``keep_text`` the text is left out.
    """
    added = ("n_pretokens", "n_tokens")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    at = docs.columns.index(text_col)
    kept = [i for i, c in enumerate(docs.columns) if keep_text or i != at]
    schema = T.StructType(
        [
            *(docs.schema.fields[i] for i in kept),
            *(T.StructField(name, T.LongType(), False) for name in added),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, pattern)
        for batch in batches:
            found = list(counter.count([x or "" for x in batch.column(at).to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in kept),
                    pa.array([x[0] for x in found], pa.int64()),
                    pa.array([x[1] for x in found], pa.int64()),
                ],
                names=schema.names,
            )

    return docs.mapInArrow(run, schema)
