"""Secrets in texts: fixed patterns, and strings that a primed compressor finds novel."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.shingles import in_pieces, in_tasks

# Patterns of the base kinds, and the least length of what is kept (of group 2, of the match).
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "novel"]

#: Candidates of the compression test: runs of these characters with letters and digits.
CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
#: Words that make a place sensitive, looked for shortly before a candidate.
SENSITIVE = (
    r"secret|token|passw|\bpwd|credential|authoriz|\bauth\b|bearer|private|signature|session|cookie|api.?key|access.?key"
    r"|\bkey\s*[:=]"
)
BEFORE = 48
#: Characters on either side that the compressor is primed with.
AROUND = 256
#: What stands between lines of one value: a line break, indents, quotes and joining signs.
NEXT_LINE = r"""["',;+\x20\t]{0,8}(?:\r\n?|\n)["'\x20\t>#*|]{0,32}"""
KEY_BLOCK = r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(.*?)(?:-----END |\Z)"
#: Least marginal bytes for each character of a candidate.
NOVELTY = 0.75
#: Common identifiers of code and settings, with which the compressor is primed as well.
IDENTIFIERS = (
    "import from return function class public private static const let var def self this null none true false "
    "string number boolean integer float array object list dict map set key value index count length size name type "
    "id user username password secret token api_key apikey access_key client_id client_secret authorization bearer "
    "basic session cookie credential config settings environment localhost example default production development "
    "http https www com org net html json xml yaml utf-8 base64 sha256 md5 select insert update delete where table "
    "request response header body error exception message status code data file path directory version license "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 xxxxxxxxxxxxxxxx ----------------"
).encode()

_ASSIGN = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(ACCESS)
# Runs of hexadecimal digits never touch, so asking for the length at once finds the same ones.
_HEX = re.compile(HEX.replace("+", f"{{{LEAST['hex']},}}"))
_CANDIDATE = re.compile(CANDIDATE)
_NEXT_LINE, _KEY_BLOCK, _KEY_LINE = re.compile(NEXT_LINE), re.compile(KEY_BLOCK, re.DOTALL), re.compile(NEXT_LINE + r"([A-Za-z0-9+/=]+)")
_SENSITIVE = re.compile(SENSITIVE, re.ASCII | re.IGNORECASE)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and without overlaps within a kind."""
    found = [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    return found + [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]


def _size(content: bytes, known: bytes) -> int:
    primed = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return len(zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False).compress(content))


def novelty(text: str, start: int, end: int) -> float:
    """Marginal compressed bytes of ``text[start:end]``, for each of its bytes.

    The compressor knows the identifiers and the text around, without other places of the candidate
    itself; what it adds for the candidate after the text before it is the candidate's own information.
    """
    own = text[start:end].encode()
    before = text[max(0, start - AROUND) : start].encode("utf-8", "replace").replace(own, b"")
    after = text[end : end + AROUND].encode("utf-8", "replace").replace(own, b"")
    known = IDENTIFIERS + after + before
    return (_size(before[-16:] + own, known) - _size(before[-16:], known)) / len(own)


class _Covered:
    """Places that spans cover, looked up by halving."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def touch(self, start: int, end: int) -> bool:
        last = bisect_left(self.starts, end) - 1
        return last >= 0 and self.ends[last] > start


def novel_spans(text: str, taken: list[tuple[int, str, int]], least: float) -> list[tuple[int, str, int]]:
    """Strings in sensitive places that don't compress and that no base span touches.

    A line directly after a reported one is in a sensitive place too; inside a private key
    it is reported whatever its length, up to the end of the key.
    """
    if not _SENSITIVE.search(text):
        return []
    found, covered = [], _Covered((s, e) for s, _, e in taken)
    for m in _CANDIDATE.finditer(text):
        own = m[0]
        if not (any(c.isdigit() for c in own) and any(c.isalpha() for c in own)):
            continue
        if covered.touch(*m.span()):
            continue
        follows = found and _NEXT_LINE.fullmatch(text, found[-1][2], m.start())
        if (follows or _SENSITIVE.search(text, max(0, m.start() - BEFORE), m.start())) and novelty(text, *m.span()) >= least:
            found.append((m.start(), "novel", m.end()))
    return sorted(found + _key_lines(text, found, [(s, e) for s, _, e in taken])) if found else found


def _key_lines(text: str, found: list[tuple[int, str, int]], taken: list[tuple[int, int]]) -> list[tuple[int, str, int]]:
    """Lines of private keys that follow a line of ``found`` and are in neither list."""
    more, starts, covered = [], [s for s, _, _ in found], _Covered([*taken, *((s, e) for s, _, e in found)])
    for block in _KEY_BLOCK.finditer(text):
        first = bisect_left(starts, block.start(1))
        if first == len(starts) or starts[first] >= block.end(1):
            continue
        last = found[first][2]
        while m := _KEY_LINE.match(text, last, block.end(1)):
            last = m.end()
            if not covered.touch(m.start(1), m.end(1)):
                more.append((m.start(1), "novel", m.end(1)))
    return more


def _scan(least: float):
    def joined(spans: list[tuple[int, str, int]]) -> str:
        return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = {kind: k for k, kind in enumerate(KINDS)}
        for batch in in_pieces(batches):
            counts, digests, spans = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                base.sort(key=lambda x: (x[0], order[x[1]]))
                every = base + novel_spans(text or "", base, least)
                every.sort(key=lambda x: (x[0], order[x[1]]))
                counts.append([sum(x[1] == kind for x in every) for kind in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"],
            )

    return run


def find_secrets(docs: DataFrame, novelty: float = NOVELTY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each of ``docs``: id, counts by kind, ``base_sha256`` and ``spans``.

    ``spans`` are ``kind:start:end`` in code points (end exclusive), by start and then kind
    (assign, access, hex, novel), joined by commas; ``base_sha256`` is the digest of those of the first
    three kinds. Spans of one kind don't overlap. A ``novel`` span is a string of letters and
    digits shortly after a sensitive word that takes at least ``novelty`` compressed bytes for each of
    its own, given the text around and common identifiers, or a further line of such a value. The work is one pass: no shuffle.

    Null and empty texts have no spans. Rows with equal texts get equal results.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = in_tasks(texts, _scan(novelty), f"id {kind}, {counts}, base_sha256 string, spans string")
    return found.withColumnRenamed("id", id_column)
