"""Quality rules with the perplexity of words and of characters, under modified Kneser-Ney models that Spark counts.

The model of characters is one of classes (letters without case, one class of
digits, of white space, of each common mark, hashed classes for other letters),
four at a time. For each language the n-grams lie in sorted arrays of their
hashes (the four classes packed in 24 bits) beside their probabilities; a lookup
is a binary search, an n-gram that is missing backs off to shorter ones.

The model of words has every word of every text, in one case, without tokens that
have neither letter nor digit, so it grows with the input. Blocks of texts send
each different word once, with its count, to the word's shard, where counts are
summed in sorted arrays of hashes, and get the sums back. Its counts are
discounted as modified Kneser-Ney does, by how many words of the language occur
once to four times, and what is taken off goes to the model of characters:
a word that is rare or new is as likely as its characters. A text's own
occurrences are taken off a word's count first, so that what no other text has is
new however often the text repeats it.

The languages' arrays are sent to the tasks one by one, and a task loads those
of the languages it meets.

A document is kept when it passes the base rules and both perplexities lie inside
its language's bands. Bands follow from all documents that pass the base
rules: around the language's median of log-perplexity, as wide as a multiple of
the spread that a mean over so many characters or words has in that language.
The lower word band also reaches twice as far as the language's lowest
twentieth, since near copies of other texts have low word perplexity and are
judged elsewhere.

Defined results: a null text is empty, has no perplexity and fails the base
rules; a text without any letter or digit has no word perplexity and is not kept; a null language is the empty one; repeated rows and null ids are judged
like any other; an empty table gives an empty one; other columns are ignored by
``verdicts`` and kept by ``kept``.
"""

from __future__ import annotations

import io
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import packing
from ticketmill.llm.common import WORD, ragged, small_batches, staged, tidy

# The base rules' symbols, and marks that are classes of their own.
SYMBOLS = "#*$%&|<>"
MARKS = (".", ",", "'\"", "-_", ":;", "!?", "()[]{}", SYMBOLS, "/\\@+=~^")

ORDER, BITS = 4, 6
MASK = [(1 << BITS * n) - 1 for n in range(ORDER + 1)]
WINDOW = 5
BATCH_CHARS = 2_000_000
#: A band's half width, in standard deviations of a text's mean over its characters ...
REACH = 8.0
#: ... and at least so much log-perplexity, which long texts of one language differ by.
MARGIN = 0.12
#: The word band's half width, in the same two terms.
WORD_REACH, WORD_MARGIN = 4.0, 0.4

TEXTS, WORD_COUNTS, CLASSES = 0, 1, 2

_WORDS = re.compile(WORD)
_LETTER = re.compile(r"[^\W_]")


@cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, 63, np.uint8)
    points = np.arange(0x80, 0x110000, dtype=np.uint64)
    # Letters beyond ASCII: 24 hashed classes, alike for both cases where these differ by position only.
    for point in range(0x80, 0x3000):
        char = chr(point)
        if char.isspace():
            table[point] = 0
        elif char.isalpha():
            low = ord(unicodedata.normalize("NFC", char.lower())[0])
            table[point] = 28 + low * 2654435761 % 2**32 // (2**32 // 24 + 1)
    far = points[points >= 0x3000]
    table[0x3000:] = (28 + far * np.uint64(2654435761) % np.uint64(2**32) // np.uint64(2**32 // 24 + 1)).astype(np.uint8)
    table[0x3000] = 0
    for char in "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f":
        table[ord(char)] = 0
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = 1 + i
    for char in "0123456789":
        table[ord(char)] = 27
    for i, marks in enumerate(MARKS):
        for char in marks:
            table[ord(char)] = 52 + i
    return table


def _joined_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-grams that end at each character of the texts, and how many each text has."""
    sizes = np.array([len(t) for t in texts], np.int64)
    gap = "   "
    points = np.frombuffer((gap + gap.join(texts)).encode("utf-32-le"), np.uint32)
    classes = _classes()[points].astype(np.uint32)
    keys = classes[3:] | classes[2:-1] << BITS | classes[1:-2] << 2 * BITS | classes[:-3] << 3 * BITS
    # Between two texts stand the three spaces before the next one.
    starts = np.cumsum(sizes + 3) - sizes - 3
    inside = np.ones(len(keys), bool)
    if len(texts) > 1:
        inside[(starts[1:, None] - np.arange(1, 4)).ravel()] = False
    return keys[inside], sizes


def _even(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_CHARS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _by_language(langs: list[str]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for i, lang in enumerate(langs):
        out.setdefault(lang, []).append(i)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, texts = (c.to_pylist() for c in batch.columns)
        for begin, stop in _even(texts):
            for lang, at in _by_language(langs[begin:stop]).items():
                keys, counts = np.unique(_joined_keys([texts[begin + i] for i in at])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int32)), pa.array(counts.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )


class Model:
    """Log-probabilities of n-grams and log back-off weights of their contexts, by order, in sorted arrays."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        levels = {ORDER: (grams[order].astype(np.uint32), counts[order])}
        for n in range(ORDER - 1, 0, -1):
            # Shorter n-grams count the different characters that stand before them.
            levels[n] = np.unique(levels[n + 1][0] & np.uint32(MASK[n]), return_counts=True)
        self.grams, self.log_p, self.contexts, self.log_weight = {}, {}, {}, {}
        lower = np.zeros(0)
        for n in range(1, ORDER + 1):
            grams, counts = levels[n]
            off = np.array([0.0, *_discounts(counts)])[np.minimum(counts, 3)]
            context = grams >> np.uint32(BITS)
            first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))[: len(grams)]
            total = np.add.reduceat(counts, first).astype(float)
            weight = np.add.reduceat(off, first) / total
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(grams))))
            before = 1 / (1 << BITS) if n == 1 else lower[np.searchsorted(levels[n - 1][0], grams & np.uint32(MASK[n - 1]))]
            lower = (counts - off) / total[of] + weight[of] * before
            self.grams[n], self.log_p[n] = grams, np.log(lower).astype(np.float32)
            self.contexts[n], self.log_weight[n] = context[first], np.log(np.maximum(weight, 1e-9)).astype(np.float32)

    def score(self, keys: np.ndarray) -> np.ndarray:
        """The natural logarithm of each n-gram's probability."""
        out = np.zeros(len(keys), np.float32)
        left = np.arange(len(keys))
        for n in range(ORDER, 0, -1):
            now = keys[left] & np.uint32(MASK[n])
            at, hit = _find(self.grams[n], now)
            out[left[hit]] += self.log_p[n][at[hit]]
            left, now = left[~hit], now[~hit]
            if not len(left):
                return out
            at, hit = _find(self.contexts[n], now >> np.uint32(BITS))
            out[left[hit]] += self.log_weight[n][at[hit]]
        out[left] -= np.float32(np.log(1 << BITS))
        return out

    def dump(self) -> bytes:
        file = io.BytesIO()
        parts = ((f"{name}{n}", getattr(self, name)[n]) for name in ("grams", "log_p", "contexts", "log_weight") for n in range(1, ORDER + 1))
        np.savez(file, **dict(parts))
        return file.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Model:
        model = cls.__new__(cls)
        arrays = np.load(io.BytesIO(data))
        for name in ("grams", "log_p", "contexts", "log_weight"):
            setattr(model, name, {n: arrays[f"{name}{n}"] for n in range(1, ORDER + 1)})
        return model


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _discounts(counts: np.ndarray) -> tuple[float, float, float]:
    """What is taken off counts of one, two, and three or more, from how many n-grams occur once to four times."""
    return _discounts_of([int((counts == i).sum()) for i in range(5)])


def _discounts_of(n: list[int]) -> tuple[float, float, float]:
    if 0 in n[1:]:
        return 0.5, 0.75, 1.0
    y = n[1] / (n[1] + 2 * n[2])
    off = (i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3))
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in enumerate(off, 1))


def _build(group: pa.Table) -> pa.Table:
    """One language's model. A group has at most as many rows as there are n-grams of classes."""
    model = Model(np.asarray(group["gram"]), np.asarray(group["n"]))
    return pa.table({"lang": [group["lang"][0].as_py()], "model": pa.array([model.dump()], pa.binary())})


def base_features(texts: list[str]) -> dict[str, np.ndarray]:
    """The base rules' counts of each text."""
    known: dict[str, int] = {}
    numbers: list[int] = []
    n_words, n_chars, symbols, lines = [], [], [], []
    for text in texts:
        words = _WORDS.findall(text)
        n_words.append(len(words))
        n_chars.append(sum(map(len, words)))
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        numbers += map(known.__getitem__, words)
        symbols.append(sum(map(text.count, SYMBOLS)))
        # The six characters of white space are the ones that strip to nothing here.
        filled = [line for line in text.split("\n") if line.strip("\t\x0b\x0c\r ")]
        lines.append(len(filled) - len(set(filled)))
    sizes = np.array(n_words, np.int64)
    return {
        "n_words": sizes,
        "word_chars": np.array(n_chars, np.int64),
        "n_symbols": np.array(symbols, np.int64),
        "n_dup_lines": np.array(lines, np.int64),
        "n_repeat_words": _repeated(np.array(numbers, np.uint64), sizes),
    }


def _repeated(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each text its words inside windows of five that the text has twice or more."""
    starts = np.cumsum(sizes) - sizes
    n_windows = np.maximum(sizes - WINDOW + 1, 0)
    at, _ = ragged(starts, n_windows)
    owner = np.repeat(np.arange(len(sizes), dtype=np.uint64), n_windows)
    key = owner * np.uint64(0x9E3779B97F4A7C15)
    for i in range(WINDOW):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[at + i]
    order = np.argsort(key, kind="stable")
    equal = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    edge = np.zeros(len(words) + 1, np.int64)
    hit = at[order[twice]]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + WINDOW, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return inside[starts + sizes] - inside[starts]


FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
NUMBERS = ", ".join(f"{name} bigint" for name in FEATURES)
SCORED = f"doc_id bigint, key string, lang string, {NUMBERS}, n_grams bigint, log_perplexity double, n_letter_words bigint, word_log_perplexity double"


class _Models:
    """The character models of the languages that a task meets; eight at a time."""

    def __init__(self, sent: dict):
        self.sent, self.loaded = sent, {}

    def __getitem__(self, lang: str) -> Model:
        if lang not in self.loaded:
            if len(self.loaded) >= 8:
                self.loaded.pop(next(iter(self.loaded)))
            self.loaded[lang] = Model.load(self.sent[lang].value)
        return self.loaded[lang]


def _sums(models: _Models, lang: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The log-probability of each text's characters, and how many it has. A language of empty texts has no model."""
    if not any(texts):
        return np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    model = models[lang]
    keys, sizes = _joined_keys(texts)
    sums = np.concatenate([[0.0], np.cumsum(model.score(keys), dtype=np.float64)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes], sizes


class _Block:
    """Texts of a run of rows: what is known of them, and the words that each one has, by language."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.known: dict[str, dict[str, int]] = {}
        self.rows: list[pa.RecordBatch] = []
        self.places: list[np.ndarray] = []
        self.often: list[np.ndarray] = []

    def add(self, rows: pa.RecordBatch, models: _Models) -> None:
        langs, texts = rows.column(2).to_pylist(), rows.column(3).to_pylist()
        mean, n_grams = np.full(len(texts), np.nan), np.zeros(len(texts), np.int64)
        for lang, at in _by_language(langs).items():
            sums, sizes = _sums(models, lang, [texts[i] for i in at])
            n_grams[at], mean[at] = sizes, -sums / np.maximum(sizes, 1)
        n_words = []
        for lang, text in zip(langs, texts, strict=True):
            known = self.known.setdefault(lang, {})
            words = _WORDS.findall(text.lower())
            bare = set()
            for word in set(words):
                if word not in known:
                    if _LETTER.search(word):
                        known[word] = len(known)
                    else:
                        bare.add(word)
            if bare:
                words = [word for word in words if word not in bare]
            places, often = np.unique(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), return_counts=True)
            self.places.append(places)
            self.often.append(often)
            n_words.append(len(words))
        features = base_features(texts)
        columns = [*rows.columns[:3], *(pa.array(features[f]) for f in FEATURES), pa.array(n_grams), pa.array(mean, mask=n_grams == 0), pa.array(n_words, pa.int64())]
        self.rows.append(pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "lang", *FEATURES, "n_grams", "log_perplexity", "n_letter_words"]))
        self.chars += sum(map(len, texts))

    def moved(self, shards: int, models: _Models) -> Iterator[packing.Row]:
        if not self.rows:
            return
        table = pa.Table.from_batches(self.rows)
        langs = table["lang"].to_pylist()
        order, classes, by_chars, asked = {}, [], [], {}
        for lang, known in self.known.items():
            words = list(known)
            keys = np.fromiter((xxhash.xxh64_intdigest(word) for word in words), np.uint64, len(words))
            keys = packing.mixed(keys ^ np.uint64(xxhash.xxh64_intdigest(lang))) >> np.uint64(64 - packing.KEY_BITS)
            by_key = np.argsort(keys, kind="stable")
            place = np.empty(len(words), np.int64)
            place[by_key] = np.arange(len(words))
            n = np.zeros(len(words), np.int64)
            for i, own in enumerate(langs):
                if own == lang:
                    # One entry for each different word of a text.
                    n[self.places[i]] += self.often[i]
            keys, n = keys[by_key], n[by_key]
            # In the texts' steps frequent words stand first, which makes steps small numbers.
            classes.append(_use_classes(n))
            by_use = np.empty(len(words), np.int64)
            by_use[_by_use(classes[-1])] = np.arange(len(words))
            order[lang] = by_use[place]
            logs = _sums(models, lang, [words[i] + " " for i in by_key.tolist()])[0].astype(np.float32)
            by_chars.append(packing.pack(logs.view(np.uint32)))
            for shard, part in packing.by_shard(keys, shards):
                asked.setdefault(shard, []).extend([lang.encode(), packing.pack_sorted(keys[part]), packing.pack(n[part])])
        for shard, fields in asked.items():
            yield self.number, shard, WORD_COUNTS, 0, packing.framed_list(fields)
        steps, often = [], []
        for lang, places, n in zip(langs, self.places, self.often, strict=True):
            at = order[lang][places]
            by_place = np.argsort(at)
            steps.append(np.diff(at[by_place], prepend=0))
            often.append(n[by_place])
        none = np.zeros(0, np.int64)
        steps, sizes = np.concatenate([none, *steps]), np.array([len(x) for x in often], np.int64)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        small = steps < 255
        texts = packing.framed(
            sink.getvalue().to_pybytes(), packing.pack(sizes), packing.pack(np.where(small, steps, 255), 1), packing.pack(steps[~small]),
            _pack_counts(np.concatenate([none, *often])), packing.framed(*by_chars),
            packing.framed(*(packing.pack(c, 1) for c in classes)), "\n".join(self.known).encode(),
        )
        yield self.number, packing.spread(self.number, shards), TEXTS, 0, texts


def _use_classes(n: np.ndarray) -> np.ndarray:
    """The number of bits of each count."""
    return np.frexp(n.astype(float))[1].astype(np.int64)


def _by_use(classes: np.ndarray) -> np.ndarray:
    """The words' places in the order of their keys, those of the most frequent class first."""
    return np.argsort(-classes, kind="stable")


def _pack_counts(n: np.ndarray) -> bytes:
    """Counts, nearly all of them small: one byte, and the others apart."""
    small = n < 255
    return packing.framed(packing.pack(np.where(small, n, 255), 1), packing.pack(n[~small]))


def _unpack_split(short: bytes, rest: bytes) -> np.ndarray:
    values = packing.unpack(short).astype(np.int64)
    values[values == 255] = packing.unpack(rest)
    return values


def _split(sent: dict, shards: int, block_chars: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[packing.Row]:
            models, block = _Models(sent), _Block(packing.first_block())
            for batch in batches:
                for begin, stop in _even(batch.column(3).to_pylist()):
                    block.add(batch.slice(begin, stop - begin), models)
                    if block.chars >= block_chars:
                        yield from block.moved(shards, models)
                        block = _Block(block.number + 1)
            yield from block.moved(shards, models)

        yield from packing.gathered(rows())

    return split


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block the counts that its words have in all texts, and for each language how many words have which count."""

    def rows() -> Iterator[packing.Row]:
        for shard, held in packing.in_groups(batches, 1):
            yield from (row for row in held if row[2] == TEXTS)
            by_lang: dict[bytes, list] = {}
            rows_asked = [row for row in held if row[2] == WORD_COUNTS]
            answers: list[list[bytes]] = [[] for _ in rows_asked]
            for answer, row in zip(answers, rows_asked, strict=True):
                fields = packing.unframed_list(row[4])
                for lang, keys, n in zip(fields[::3], fields[1::3], fields[2::3], strict=True):
                    by_lang.setdefault(lang, []).append((answer, packing.unpack_sorted(keys), packing.unpack(n).astype(np.int64)))
            for lang, asked in by_lang.items():
                keys, at = np.unique(np.concatenate([k for _, k, _ in asked]), return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, at, np.concatenate([n for *_, n in asked]))
                begin = 0
                for answer, own, _ in asked:
                    answer += [lang, _pack_counts(total[at[begin : begin + len(own)]])]
                    begin += len(own)
                classes = [int((total == i).sum()) for i in range(1, 5)]
                line = {"lang": lang.decode(), "words": int(total.sum()), "different": len(keys), **{f"n{i}": n for i, n in enumerate(classes, 1)}}
                yield -1 - shard, shard, CLASSES, 0, json.dumps(line).encode()
            for answer, row in zip(answers, rows_asked, strict=True):
                yield *row[:4], packing.framed_list(answer)

    yield from packing.gathered(rows())


CLASS_COUNTS = "lang string, words bigint, different bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint"


def word_classes(totals: DataFrame) -> DataFrame:
    """For each language its words, different words, and how many of these occur once, twice, three and four times."""
    lines = totals.where(F.col("kind") == CLASSES).select(F.inline(F.array(F.from_json(F.col("data").cast("string"), CLASS_COUNTS))))
    names = [c.split()[0] for c in CLASS_COUNTS.split(", ")[1:]]
    return lines.groupBy("lang").agg(*[F.sum(name).alias(name) for name in names])


def word_log_probabilities(total: np.ndarray, own: np.ndarray, by_chars: np.ndarray, classes: dict) -> np.ndarray:
    """Modified Kneser-Ney: discounted counts less the text's own ones, and what is taken off by characters."""
    off = np.array([0.0, *_discounts_of([0, *(classes[f"n{i}"] for i in range(1, 5))])])
    n = np.array([classes["n1"], classes["n2"], classes["different"] - classes["n1"] - classes["n2"]], float)
    weight = float((off[1:] * n).sum()) / classes["words"]
    others = np.maximum(total - own, 0)
    return np.log((others - off[np.minimum(others, 3)]) / classes["words"] + weight * np.exp(by_chars.astype(np.float64)) + 1e-300)


def _assemble(classes: dict):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in packing.in_groups(batches, 0):
            data = next(row[4] for row in held if row[2] == TEXTS)
            head, sizes, steps, far, often, by_chars, use, langs = packing.unframed(data, 8)
            table = pa.ipc.open_stream(head).read_all().combine_chunks()
            langs = langs.decode().split("\n")
            found: dict[str, list[np.ndarray]] = {lang: [np.zeros(0, np.int64)] for lang in langs}
            for row in held:
                if row[2] == WORD_COUNTS:
                    fields = packing.unframed_list(row[4])
                    for lang, counts in zip(fields[::2], fields[1::2], strict=True):
                        found[lang.decode()].append(_unpack_split(*packing.unframed(counts, 2)))
            totals = [np.concatenate(found[lang]) for lang in langs]
            chars = [packing.unpack(x).astype(np.uint32).view(np.float32) for x in packing.unframed(by_chars, len(langs))]
            by_use = [_by_use(packing.unpack(x).astype(np.int64)) for x in packing.unframed(use, len(langs))]
            steps, often, sizes = _unpack_split(steps, far), _unpack_split(*packing.unframed(often, 2)), packing.unpack(sizes).astype(np.int64)
            ends = np.cumsum(sizes)
            mean = np.full(len(sizes), np.nan)
            for i, lang in enumerate(table["lang"].to_pylist()):
                if sizes[i]:
                    mine = slice(int(ends[i] - sizes[i]), int(ends[i]))
                    which = langs.index(lang)
                    # Back in the order of keys, in which the sum is taken.
                    at = by_use[which][np.cumsum(steps[mine])]
                    by_key = np.argsort(at)
                    at, n = at[by_key], often[mine][by_key]
                    logs = word_log_probabilities(totals[which][at], n, chars[which][at], classes[lang])
                    mean[i] = -(n * logs).sum() / n.sum()
            words = table["n_letter_words"]
            out = table.append_column("word_log_perplexity", pa.array(mean, mask=sizes == 0)).set_column(
                table.schema.get_field_index("n_letter_words"), "n_letter_words", words
            )
            yield from out.combine_chunks().to_batches(max_chunksize=10_000)

    return assemble


def _texts(docs: DataFrame, id_col: str | None, text_col: str, lang_col: str) -> DataFrame:
    """``doc_id``, ``key`` (equal for equal language and text), ``lang`` and ``text``."""
    lang, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, text_col))
    doc_id = F.col(id_col) if id_col else F.lit(None)
    key = F.md5(F.concat(lang, F.lit("\n"), text).cast("binary"))
    return docs.select(doc_id.cast("bigint").alias("doc_id"), key.alias("key"), lang.alias("lang"), text.alias("text"))


def language_models(spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang`` and ``model``: the serialised model of each language, counted over every text."""
    texts = _texts(docs, None, text_col, lang_col).select("lang", "text")
    counted = texts.mapInArrow(tidy(_count), "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return counted.groupBy("lang").applyInArrow(_build, "lang string, model binary")


def scored(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    shards: int | None = None, block_chars: int = packing.BLOCK_CHARS,
) -> DataFrame:
    """The base counts and the mean negative log-probability of a character and of a word, of each row."""
    small_batches(spark)
    models = staged(spark, language_models(spark, docs, text_col, lang_col), "models")
    sent = {}
    for row in models.select("lang").collect():
        model = models.where(F.col("lang") == row.lang).first().model
        sent[row.lang] = spark.sparkContext.broadcast(bytes(model))
    shards = shards or packing.n_shards(spark)
    rows = _texts(docs, id_col, text_col, lang_col).mapInArrow(tidy(_split(sent, shards, block_chars)), packing.MOVED)
    totals = rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(tidy(_totals), packing.MOVED)
    totals = staged(spark, totals, "word_totals")
    # Seven numbers for each language that has words.
    classes = {row.lang: row.asDict() for row in word_classes(totals).collect()}
    blocks = totals.where(F.col("kind") != CLASSES).repartition("block").sortWithinPartitions("block", "kind", "shard", "seq")
    return blocks.mapInArrow(tidy(_assemble(classes)), SCORED)


def verdicts(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    reach: float = REACH, margin: float = MARGIN,
) -> DataFrame:
    """The base counts, ``base_failed``, ``kept``, both log-perplexities and their bands of each row; equal ``key``, equal verdict."""
    rows = staged(spark, scored(spark, docs, id_col, text_col, lang_col), "scored")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    rows = rows.withColumn("_root", F.sqrt(F.greatest(F.col("n_grams"), F.lit(1))))
    rows = rows.withColumn("_word_root", F.sqrt(F.greatest(F.col("n_letter_words"), F.lit(1))))
    good = rows.where(~F.col("base_failed"))
    ranks = F.percentile_approx("word_log_perplexity", [0.05, 0.5], 10000)
    middle = good.groupBy("lang").agg(F.percentile_approx("log_perplexity", 0.5, 10000).alias("middle"), ranks.alias("w"))
    middle = middle.select("lang", "middle", F.col("w")[1].alias("word_middle"), (F.col("w")[1] - F.col("w")[0]).alias("word_tail"))
    middle = staged(spark, middle, "middles")
    off = (F.col("log_perplexity") - F.col("middle")) * F.col("_root")
    word_off = (F.col("word_log_perplexity") - F.col("word_middle")) * F.col("_word_root")
    quartiles = [F.percentile_approx(x, [0.25, 0.75], 10000).alias(q) for x, q in ((off, "q"), (word_off, "w"))]
    # Quartiles of a normal distribution lie 1.349 standard deviations apart.
    spread = good.join(middle, "lang").groupBy("lang").agg(*quartiles)
    spread = spread.select("lang", *[((F.col(q)[1] - F.col(q)[0]) / 1.349).alias(name) for q, name in (("q", "spread"), ("w", "word_spread"))])
    bands = staged(spark, middle.join(spread, "lang"), "bands")
    wide = F.greatest(F.lit(margin), reach * F.col("spread") / F.col("_root"))
    word_wide = F.greatest(F.lit(WORD_MARGIN), WORD_REACH * F.col("word_spread") / F.col("_word_root"))
    inside = F.col("log_perplexity").between(F.col("low"), F.col("high")) & F.col("word_log_perplexity").between(F.col("word_low"), F.col("word_high"))
    judged = (
        rows.join(bands, "lang", "left")
        .withColumn("low", F.col("middle") - wide)
        .withColumn("high", F.col("middle") + wide)
        .withColumn("word_low", F.col("word_middle") - F.greatest(word_wide, 2 * F.col("word_tail")))
        .withColumn("word_high", F.col("word_middle") + word_wide)
        .withColumn("kept", F.coalesce(~F.col("base_failed") & inside, F.lit(False)))
    )
    columns = ("log_perplexity", "low", "high", "word_log_perplexity", "word_low", "word_high")
    return judged.select("doc_id", "key", *FEATURES, "base_failed", "kept", *columns)


def kept(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that the rules reject: an anti join on language and text, which is what the rules see."""
    judged = staged(spark, verdicts(spark, docs, id_col, text_col, lang_col).where(~F.col("kept")).select("key").distinct(), "rejected")
    lang, text = (F.coalesce(F.col(f"d.{c}").cast("string"), F.lit("")) for c in (lang_col, text_col))
    key = F.md5(F.concat(lang, F.lit("\n"), text).cast("binary"))
    return docs.alias("d").join(judged.alias("r"), key == F.col("r.key"), "left_anti")
