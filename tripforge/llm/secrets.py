"""Secret scans: fixed patterns, and sliding-window entropy of candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripforge.llm.flat import slices

# Fixed patterns of the base kinds. Keywords match in either case, of ASCII letters only.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32

#: Length of the entropy window, which is also the least length of a candidate.
WINDOW = 20
#: Bits a character that a window must reach, by the narrowest class that holds the whole string.
MIN_BITS = {"digits": 2.8, "hex": 3.2, "letters": 3.65, "alphanumeric": 3.7, "base64": 3.7}
#: Pieces of candidates that are known not to be secrets; the last is a plain word.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"(?i:.*(?:example|sample|dummy|placeholder|changeme).*)",
    r"[a-z]+(?:[-_/][a-z]+)+",
    r"(?:ABCDEFGHIJKLMNOPQRSTUVWXYZ|abcdefghijklmnopqrstuvwxyz|0123456789)+\+*",
    r"[a-z]{0,19}",
)

_HEX = np.zeros(256, bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", np.uint8)] = True
_CLASSES = (
    ("digits", re.compile(r"[0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+")),
    ("letters", re.compile(r"[A-Za-z]+")),
    ("alphanumeric", re.compile(r"[A-Za-z0-9]+")),
)
_PIECE = re.compile(r"[^=/]+")
_PART = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]


def class_of(text: str) -> str:
    return next((name for name, pattern in _CLASSES if pattern.fullmatch(text)), "base64")


def dense_spans(text: str, bar: float | None = None) -> list[tuple[int, int]]:
    """Maximal unions of overlapping windows whose Shannon entropy reaches ``bar``, or else that of the text's class.

    A step of the window changes two counts, and so two terms of the sum.
    """
    bar = MIN_BITS[class_of(text)] if bar is None else bar
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for end, entering in enumerate(text, 1):
        count = counts.get(entering, 0)
        total += _PART[count + 1] - _PART[count]
        counts[entering] = count + 1
        if end > WINDOW:
            leaving = text[end - WINDOW - 1]
            count = counts[leaving]
            counts[leaving] = count - 1
            total += _PART[count - 1] - _PART[count]
        if end >= WINDOW and math.log2(WINDOW) - total / WINDOW >= bar - 1e-9:
            start = end - WINDOW
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
    return spans


def suspicious(text: str, allowed: re.Pattern) -> list[tuple[int, int]]:
    """Dense spans of a string and of its pieces between ``=`` and ``/``, each by the bar of its own class.

    A span goes where every piece it touches is on the allow list, so a name
    beside a secret, or a folder before it, hides nothing.
    """
    pieces = [(m.start(), m.end()) for m in _PIECE.finditer(text)]
    spans = dense_spans(text)
    if len(pieces) > 1:
        spans += [(a + x, a + y) for a, b in pieces if b - a >= WINDOW for x, y in dense_spans(text[a:b])]
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if all(allowed.fullmatch(text[a:b]) for a, b in pieces if a < end and b > start):
            continue
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def _runs(inside: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of maximal runs within one text each."""
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none
    edge = np.zeros(len(inside) + 1, bool)
    edge[starts] = True
    first = np.flatnonzero(inside & (~np.concatenate(([False], inside[:-1])) | edge[:-1]))
    last = np.flatnonzero(inside & (~np.concatenate((inside[1:], [False])) | edge[1:])) + 1
    long = last - first >= least
    return first[long], last[long]


def text_spans(text: str, hex_runs: list[tuple[int, int]], candidates: list[tuple[int, int]], allowed: re.Pattern) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of a text, in order; the runs are given in code points."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [(a, b, 2) for a, b in hex_runs]
    base = sorted(found, key=lambda x: (x[0], x[2]))
    for a, b in candidates:
        at = a
        for start, end in [*((x[0], x[1]) for x in base if x[0] < b and x[1] > a), (b, b)]:
            if start - at >= WINDOW:
                found += [(at + x, at + y, 3) for x, y in suspicious(text[at:start], allowed)]
            at = max(at, end)
    return sorted(found, key=lambda x: (x[0], x[2]))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


def secret_spans(docs: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of the base spans, and all spans.

    A pattern's span is its whole match. ``entropy`` spans are added where a
    string of 20 or more letters, digits and ``+/=_-`` has a dense window beside
    its base spans, in a piece that isn't on the allow list. A null or empty text has no
    spans. Other columns are ignored and repeated rows are scanned alike. The
    operator works row by row, so nothing is shuffled.
    """
    known = "|".join(f"(?:{x})" for x in allowed) or r"(?!)"

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(known)
        for batch in batches:
            for part in slices(batch["text"]):
                yield _scan(batch["doc_id"][part.first : part.last], part, pattern)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(scanned, schema)


def _scan(ids: pa.Array, part, allowed: re.Pattern) -> pa.RecordBatch:
    points = np.concatenate(([0], np.cumsum((part.data & 0xC0) != 0x80)))
    grouped: list[list[list[tuple[int, int]]]] = []
    for inside, least in ((_HEX[part.data], HEX_CHARS), (_CANDIDATE[part.data], WINDOW)):
        first, last = _runs(inside, part.starts[:-1], least)
        rows = np.searchsorted(part.starts, first, "right") - 1
        lists: list[list[tuple[int, int]]] = [[] for _ in range(part.last - part.first)]
        base = points[part.starts[rows]]
        for row, a, b in zip(rows.tolist(), (points[first] - base).tolist(), (points[last] - base).tolist(), strict=True):
            lists[row].append((a, b))
        grouped.append(lists)
    counts: list[list[int]] = [[], [], []]
    digests, spans = [], []
    body = part.data.tobytes()
    for row, (a, b) in enumerate(zip(part.starts[:-1], part.starts[1:], strict=True)):
        found = text_spans(body[a:b].decode(), grouped[0][row], grouped[1][row], allowed)
        base = [x for x in found if x[2] < 3]
        for kind in range(3):
            counts[kind].append(sum(x[2] == kind for x in base))
        digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
        spans.append(_joined(found))
    longs = [pa.array(x, pa.int64()) for x in counts]
    return pa.RecordBatch.from_arrays(
        [ids.cast(pa.int64()), *longs, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
        ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    )
