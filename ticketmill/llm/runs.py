"""Runs of repeated words in a text, by enumeration of maximal pairs.

A run is a stretch of words that repeats with a smallest period and that neither
neighbour continues. Words that stand one period apart in it are two copies of
one string, as long as the run less the period, that differ in the word before
(else the run would begin earlier) and in the word after. Such a pair of copies
is a maximal pair, and its distance is the period. So the runs are the maximal
pairs whose distance is short enough for their length; no run is extended or
searched for otherwise. Pairs at a multiple of the period cover the same stretch,
and the smallest distance of a stretch is kept.

Maximal pairs come from the tree of common prefixes, built from below. Suffixes
are sorted by doubling prefixes, for all texts of a batch at once in numpy;
common prefixes of neighbours follow from the ranks of each doubling. Those that
share enough words with another suffix near enough go on. A stack then joins
neighbouring intervals from the longest common prefix down. An interval keeps its
suffixes in a list for each word before them. When two intervals join, each suffix
of the smaller one looks for partners of other lists within reach of the larger
one, and every partner is a maximal pair. Copies of one string that stand less than
half its length apart are evenly spaced, and all but the first have the same
word before them. So before a suffix only the first copy in reach can be a
partner, and behind it all copies in reach are partners or none is. The pairs
are therefore as few as the repetitions of the runs, and a word repeated a
million times does not cost a million squared.

A text is worked off as a whole in one task, texts in batches of about as many
characters, so a task's memory follows the longest text or one batch.

Defined results: a null text and one without words have no words and no runs; the text of a
null id is not rewritten; repeated rows and null ids are rows like any other; an
empty table gives an empty one; columns other than the id and the text are
ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm.common import WORD, small_batches

#: A run has so many words, and its period so many times, at least.
LEAST, TIMES = 6, 4
#: Characters of texts that are worked off together.
BATCH_CHARS = 3_000_000

_WORDS = re.compile(WORD)

Rewrite = Callable[[int | None, list[str]], list[str]]


def _shortest(least: int, times: int) -> int:
    """Words that two copies at any allowed distance share at least."""
    return min(max((times - 1) * p, least - p) for p in range(1, least + 1))


class _Suffixes:
    """The suffixes of the texts in order, text by text, by doubling prefixes. What is behind a text counts as its largest word."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        n = len(words)
        key = np.repeat(np.arange(len(sizes)), sizes) * (int(words.max(initial=0)) + 1) + words
        self.order = np.argsort(key, kind="stable")
        new = np.ones(n, bool)
        new[1:] = np.diff(key[self.order]) != 0
        rank = np.full(n + 1, n, np.int64)
        rank[self.order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        #: ranks[k]: equal for suffixes that share their first 2**k words.
        self.ranks, self.n = [rank], n
        # Only suffixes that are not yet alone are sorted again.
        alone = np.append(new, True)
        left = np.flatnonzero(~(alone[:-1] & alone[1:]))
        while len(left):
            now = self.order[left]
            pair = rank[now] * (n + 1) + rank[np.minimum(now + (1 << len(self.ranks) - 1), n)]
            inner = np.argsort(pair, kind="stable")
            now, pair = now[inner], pair[inner]
            self.order[left] = now
            new = np.ones(len(left) + 1, bool)
            new[1:-1] = pair[1:] != pair[:-1]
            rank = rank.copy()
            rank[now] = left[np.maximum.accumulate(np.where(new[:-1], np.arange(len(left)), 0))]
            self.ranks.append(rank)
            left = left[~(new[:-1] & new[1:])]

    def common(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order that share ``least`` words or more with a neighbour, and what each shares with the one before, 0 if less."""
        k = least.bit_length() - 1
        none = np.zeros(0, np.int64)
        if k >= len(self.ranks):
            return none, none
        sorted_ranks = self.ranks[k][self.order]
        later = np.flatnonzero(sorted_ranks[1:] == sorted_ranks[:-1]) + 1
        one, two = self.order[later - 1], self.order[later]
        length = np.zeros(len(later), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            a, b = np.minimum(one + length, self.n), np.minimum(two + length, self.n)
            length += (self.ranks[k][a] == self.ranks[k][b]).astype(np.int64) << k
        shared = np.zeros(self.n + 1, np.int64)
        shared[later] = np.where(length >= least, length, 0)
        several = np.flatnonzero((shared[:-1] > 0) | (shared[1:] > 0))
        return self.order[several], shared[several]


def _near(order: np.ndarray, common: np.ndarray, times: int) -> np.ndarray:
    """Places of the groups in which some two suffixes stand close enough for the longest common prefix."""
    group = np.cumsum(common == 0) - 1
    n_groups = int(group[-1]) + 1 if len(group) else 0
    longest = np.zeros(n_groups, np.int64)
    np.maximum.at(longest, group, common)
    by_place = np.lexsort((order, group))
    gap = np.diff(order[by_place])
    inside = group[by_place][1:] == group[by_place][:-1]
    least = np.full(n_groups, np.iinfo(np.int64).max)
    np.minimum.at(least, group[by_place][1:][inside], gap[inside])
    return np.flatnonzero((least <= longest // (times - 1))[group])


def maximal_pairs(order: list[int], common: list[int], before: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, distance, common length) of the maximal pairs in reach, from sorted suffixes and their common prefixes.

    ``before`` has the class of each suffix: the word before it. ``common`` is 0
    where a group begins, and ends with a 0 beyond the last suffix.
    """
    found: list[tuple[int, int, int]] = []

    def join(one, two, length):
        (small, small_lists), (large, large_lists) = (one, two) if len(one[0]) <= len(two[0]) else (two, one)
        reach = length // (times - 1)
        if reach + length >= least:
            for x in small:
                own = before[x]
                k = bisect_left(large, x - reach)
                if k < len(large) and large[k] < x and before[large[k]] != own and x - large[k] + length >= least:
                    found.append((large[k], x - large[k], length))
                k = bisect_right(large, x)
                if k < len(large) and large[k] - x <= reach and before[large[k]] != own:
                    partners = large_lists[before[large[k]]]
                    for y in partners[bisect_right(partners, x) : bisect_right(partners, x + reach)]:
                        if y - x + length >= least:
                            found.append((x, y - x, length))
        _merged(large, small)
        for word, places in small_lists.items():
            if word in large_lists:
                _merged(large_lists[word], places)
            else:
                large_lists[word] = places
        return large, large_lists

    stack: list[tuple[int, tuple]] = []
    for i, x in enumerate(order):
        node = [x], {before[x]: [x]}
        after = common[i + 1]
        while stack and stack[-1][0] >= after and stack[-1][0] > 0:
            length, other = stack.pop()
            node = join(other, node, length)
        if after:
            stack.append((after, node))
    return found


def _merged(large: list[int], small: list[int]) -> None:
    """Sorted lists put together in the larger one."""
    if len(small) * 16 < len(large):
        for x in small:
            insort(large, x)
    else:
        large += small
        large.sort()


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word (in the flat array), length and smallest period of all runs, by first word, then period.

    ``words`` are numbers of words of texts of ``sizes``; ``times`` is 3 or more.
    """
    if times < 3:
        raise ValueError("times must be 3 or more")
    order, common = _Suffixes(words, sizes).common(_shortest(least, times))
    near = _near(order, common, times)
    order, common = order[near], common[near]
    starts = np.cumsum(sizes) - sizes
    before = np.concatenate([[-1], words[:-1].astype(np.int64)])[: len(words)]
    # The first word of a text has nothing before it.
    before[starts[sizes > 0]] = -1
    pairs = maximal_pairs(order.tolist(), [*common.tolist(), 0], _Classes(order, before), least, times)
    if not pairs:
        return (np.zeros(0, np.int64),) * 3
    start, period, length = np.array(pairs, np.int64).T
    length = length + period
    by = np.lexsort((period, length, start))
    start, period, length = start[by], period[by], length[by]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, period, length = start[smallest], period[smallest], length[smallest]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


class _Classes(dict):
    """The word before each suffix of the sorted ones."""

    def __init__(self, order: np.ndarray, before: np.ndarray):
        super().__init__(zip(order.tolist(), before[order].tolist(), strict=True))


def numbered(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the texts' words, equal for equal words, and the texts' sizes."""
    known: dict[str, int] = {}
    flat: list[int] = []
    for words in texts:
        for word in set(words):
            if word not in known:
                known[word] = len(known)
        flat += map(known.__getitem__, words)
    return np.array(flat, np.int64), np.array([len(words) for words in texts], np.int64)


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The words, for a tenth of the ids with a stretch up to the end that repeats 3 to 10 times."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


RUNS = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)
SPANS = "doc_id bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string"


def _even(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= BATCH_CHARS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _in_texts(ids: list[int | None], texts: list[str | None], least: int, times: int, rewrite: Rewrite | None) -> Iterator[tuple]:
    """For each text its runs (first words, lengths, periods) and the words that are left of it."""
    split = [_WORDS.findall(text or "") for text in texts]
    if rewrite:
        split = [rewrite(i, words) for i, words in zip(ids, split, strict=True)]
    numbers, sizes = numbered(split)
    start, length, period = find_runs(numbers, sizes, least, times)
    edges = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.cumsum(edges[:-1]) == 0
    ends = np.cumsum(sizes)
    cuts = np.searchsorted(start, np.concatenate([[0], ends]))
    for i, words in enumerate(split):
        mine = slice(cuts[i], cuts[i + 1])
        begin = int(ends[i] - sizes[i])
        if mine.start < mine.stop:
            words = [word for word, keep in zip(words, kept[begin : int(ends[i])].tolist(), strict=True) if keep]
        yield start[mine] - begin, length[mine], period[mine], words


def _detect(least: int, times: int, rewrite: Rewrite | None, digest: bool):
    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in (RUNS if digest else SPANS).split(", ")])
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for begin, stop in _even(texts):
                found = _in_texts(ids[begin:stop], texts[begin:stop], least, times, rewrite)
                make = _digested if digest else _listed
                rows = [(i, *make(*one)) for i, one in zip(ids[begin:stop], found, strict=True)]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return detect


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
_NONE = sha256(b"").hexdigest()


def _listed(start: np.ndarray, length: np.ndarray, period: np.ndarray, words: list[str]) -> tuple:
    return start, length, period, " ".join(words)


def _digested(start: np.ndarray, length: np.ndarray, period: np.ndarray, words: list[str]) -> tuple:
    collapsed = sha256(" ".join(words).encode()).hexdigest()
    if not len(start):
        return 0, None, None, None, None, _NONE, collapsed
    # The first of the longest: runs are in order of first word, then period.
    top = int(np.argmax(length))
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    s, n, p = int(start[top]), int(length[top]), int(period[top])
    return len(start), s, n, p, 1000 * n // p, sha256(lines.encode()).hexdigest(), collapsed


def _rows(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(spark)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def collapsed(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """``doc_id``, the runs of each text (``starts``, ``lengths``, ``periods``) and ``collapsed``: its words, of each run only the first period."""
    return _rows(spark, docs, id_col, text_col).mapInArrow(_detect(least, times, None, False), SPANS)


def digests(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES,
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """Number of runs, the longest run, and SHA-256 of the list of runs and of the collapsed words, of each text."""
    return _rows(spark, docs, id_col, text_col).mapInArrow(_detect(least, times, rewrite, True), RUNS)
