"""Secrets in texts: fixed patterns, and strings that a primed compressor finds new.

Three patterns report assignments, access keys and long hexadecimal runs. The
novelty scan then looks at every other string of key-like characters in a line
with a sensitive word or in a line beside it, before and behind the word, and
goes on through neighbouring strings as long as it reports them. It compresses the text around the string with zstd,
primed with a dictionary of common identifiers, once without and once with the
string. What the string adds, in bytes for each of its characters, is its
novelty: names, paths and words that the dictionary or the text around already
has add little, random keys add most of their bytes. Strings above the threshold
are reported as kind ``novel``. A string that a base pattern covers in part only
is measured and reported whole beside it. Letters in one case, as prose has them,
have a higher threshold.

Defined results: a null text is empty; repeated rows and null ids are scanned
like any other; an empty table gives an empty one; other columns are ignored by
``scan`` and kept by ``masked``. Texts are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm.common import small_batches, tidy

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")

# Words that make their neighbourhood sensitive.
SENSITIVE = (
    "password", "passwd", "passphrase", "secret", "token", "api key", "apikey", "api_key", "access key", "access_key",
    "private key", "private_key", "credential", "bearer", "authorization", "auth_key", "client_id", "connection string",
)
NEAR = re.compile("|".join(re.escape(word) for word in SENSITIVE), re.ASCII | re.IGNORECASE)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")
#: What stands between the lines of one block or the parts of one token.
JOINT = re.compile(r"""["'\\rn,]*\s*["']*|\.""", re.ASCII)
# Text of the kind that stands around secrets without being one.
IDENTIFIERS = (
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
    "true false null none undefined default example placeholder changeme your_password_here your-api-key xxxxxxxxxxxxxxxx "
    "os.environ process.env getenv config settings options parameters arguments request response headers session cookie "
    "user username password passwd passphrase secret secret_key token access_token refresh_token auth_token id_token "
    "api_key apikey access_key access_key_id secret_access_key private_key public_key client_id client_secret "
    "credential credentials bearer authorization authentication connection_string database_url "
    "https://www.example.com/api/v1/users http://localhost:8080/ /usr/local/lib/python/site-packages /home/user/.ssh/id_rsa "
    "import from return function class public private static final const let var string int boolean self this "
    "createUserWithEmailAndPassword getAccessToken setPassword validateToken AuthenticationManager PasswordEncoder "
    "ing tion ment ness able less ful ever over under with that this have from they which would there their "
)

#: A string of at least so many characters is a candidate.
MIN_CHARS = 16
#: Characters on both sides that count as its surroundings.
AROUND = 256
#: Compressed bytes that a character must add. Random base64 adds 0.75, random hex 0.5.
NOVELTY = 0.45
#: The same for letters in one case or title case, which prose has too: of its long words none added 0.6.
LETTERS_NOVELTY = 0.65
#: With fewer characters around, plain text is hardly compressed, and letters must add this much.
FEW_AROUND, BARE_NOVELTY = 128, 0.95

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    found = []
    lower = text.lower()
    if any(hint in lower for hint in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Novelty:
    """Compressed bytes that a string adds to its surroundings, for each character."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.press = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False).compress

    def reports(self, text: str, start: int, end: int, threshold: float) -> bool:
        """True where the string adds enough. Letters without digits or change of case, as in prose, have thresholds of their own."""
        string = text[start:end]
        if string.isalpha() and (string.islower() or string.isupper() or string.istitle()):
            few = min(start, AROUND) + min(len(text) - end, AROUND) < FEW_AROUND
            threshold = max(threshold, BARE_NOVELTY if few else LETTERS_NOVELTY)
        return self(text, start, end) >= threshold

    def __call__(self, text: str, start: int, end: int) -> float:
        around = (text[max(0, start - AROUND) : start] + text[end : end + AROUND]).encode()
        size = len(self.press(around))
        return (len(self.press(around + text[start:end].encode())) - size) / (end - start)


def _near_lines(text: str) -> list[tuple[int, int]]:
    """Stretches of the lines with a sensitive word, the line before and the line behind."""
    zones: list[tuple[int, int]] = []
    line_end = -1
    for near in NEAR.finditer(text):
        if near.end() <= line_end:
            continue
        begin = text.rfind("\n", 0, near.start())
        begin = text.rfind("\n", 0, begin) if begin > 0 else -1
        line_end = text.find("\n", near.end())
        line_end = line_end if line_end >= 0 else len(text)
        end = text.find("\n", line_end + 1)
        zones.append((begin + 1, end if end >= 0 else len(text)))
    return zones


def novel_spans(text: str, base: list[Span], novelty: Novelty, threshold: float, min_chars: int = MIN_CHARS) -> list[Span]:
    """Key-like strings around sensitive words that add much; those that a base span covers whole are reported by it already."""
    lower = text.lower()
    if not any(word in lower for word in SENSITIVE):
        return []
    zones = _near_lines(text)
    strings = [m.span() for m in CANDIDATE.finditer(text) if m.end() - m.start() >= min_chars]
    near, at = [], 0
    for i, (start, end) in enumerate(strings):
        while at < len(zones) and zones[at][1] <= start:
            at += 1
        if at < len(zones) and zones[at][0] < end:
            near.append(i)
    starts = [start for start, _, _ in base]
    furthest = list(accumulate((end for _, _, end in base), max))
    found, seen = [], set(near)
    while near:
        i = near.pop()
        start, end = strings[i]
        before = bisect_right(starts, start)
        if before and furthest[before - 1] >= end:
            continue
        if not novelty.reports(text, start, end, threshold):
            continue
        found.append((start, 3, end))
        # The next lines of a block and parts between dots are near a secret too.
        for j in (i - 1, i + 1):
            if 0 <= j < len(strings) and j not in seen and JOINT.fullmatch(text, *sorted((strings[min(i, j)][1], strings[max(i, j)][0]))):
                seen.add(j)
                near.append(j)
    return sorted(found)


def _scan(threshold: float, min_chars: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = []
            for text in batch.column(batch.num_columns - 1):
                text = text.as_py()
                base = base_spans(text)
                every = sorted(base + novel_spans(text, base, novelty, threshold, min_chars))
                found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in every])
            kept = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, spans)], names=[*batch.schema.names[:-1], "spans"])

    return scan


SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", novelty: float = NOVELTY, min_chars: int = MIN_CHARS
) -> DataFrame:
    """``doc_id`` and ``spans``: kind, start and end (code points, end exclusive), by start, then kind.

    Strings shorter than ``min_chars`` are words of prose and code and are not measured."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(_scan(novelty, min_chars), f"doc_id bigint, spans {SPANS}")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(scanned: DataFrame) -> DataFrame:
    """Numbers of base spans by kind, the digest of the base spans, and all spans."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return scanned.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:3]],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def _mask(at: int, threshold: float, mark: str, min_chars: int):
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, text in enumerate(texts):
                if not text:
                    continue
                base = base_spans(text)
                out, done = [], 0
                for start, _, end in sorted(base + novel_spans(text, base, novelty, threshold, min_chars)):
                    if start >= done:
                        out += [text[done:start], mark]
                    done = max(done, end)
                if out:
                    texts[i] = "".join([*out, text[done:]])
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return mask


def masked(
    docs: DataFrame, text_col: str = "text", novelty: float = NOVELTY, mark: str = "[SECRET]", min_chars: int = MIN_CHARS
) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark``; spans that overlap become one mark."""
    small_batches(docs.sparkSession)
    return docs.mapInArrow(tidy(_mask(docs.columns.index(text_col), novelty, mark, min_chars)), docs.schema)
