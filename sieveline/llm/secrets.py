"""Secret scans: keyed patterns, and sliding-window Shannon entropy per character class over candidate strings.

The patterns find what is written like a secret; the entropy scan finds what looks like one anywhere. Its windows move by
one character, and the entropy is updated from the two counts that change, so a candidate costs time in proportion
to its length. An allow list takes out strings that are random-looking by design or not random at all.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "entropy")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
#: A run either reaches 32 characters from its first one or not at all, so looking only at its start is the same.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class CharacterClass:
    """Candidates made of these characters alone, and the entropy in bits that a window of them needs."""

    name: str
    shape: re.Pattern
    least: float


#: From narrow to wide; a candidate belongs to the first whose shape it has.
CLASSES = (
    CharacterClass("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 3.2),
    CharacterClass("alphanumeric", re.compile(r"[A-Za-z0-9]+"), 3.9),
    CharacterClass("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.9),
)
WINDOW = 20

#: Suppressed as a whole: unique ids, letters joined by separators, digits joined by separators.
ALLOWED_SHAPES = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[A-Za-z_/+=-]+|[0-9_/+=-]+")
#: Suppressed is a run of letters and digits that holds one of them, and every window that overlaps it: pieces of an alphabet, of digits
#: or of keys, and placeholders.
ALLOWED_PARTS = re.compile(
    r"abcdefgh|01234567|12345678|98765432|qwertyui|example|sample|placeholder|changeme|xxxxxx|dummy", re.IGNORECASE
)
RUN = re.compile(r"[A-Za-z0-9]+")


def entropy_peaks(candidate: str, width: int = WINDOW) -> Iterator[tuple[int, float]]:
    """Start and entropy (bits per character) of each window, by incremental counts.

    ``sum(c * log2(c))`` over the counts changes in two terms when the window moves by one character.
    """
    width = min(width, len(candidate))
    weight = [0.0, *(c * math.log2(c) for c in range(1, width + 2))]  # a new character comes before the old one goes
    counts: dict[str, int] = {}
    total = 0.0
    for at, new in enumerate(candidate):
        before = counts.get(new, 0)
        total += weight[before + 1] - weight[before]
        counts[new] = before + 1
        if at >= width:
            old = candidate[at - width]
            total += weight[counts[old] - 1] - weight[counts[old]]
            counts[old] -= 1
        if at >= width - 1:
            yield at - width + 1, math.log2(width) - total / width


def entropy_spans(text: str, width: int = WINDOW) -> list[tuple[int, int]]:
    """Merged windows at or above the threshold of their candidate's class, unless the candidate, or a part of the window, is allowed."""
    found = []
    for match in CANDIDATE.finditer(text):
        body = match.group()
        if ALLOWED_SHAPES.fullmatch(body):
            continue
        parts = []
        if ALLOWED_PARTS.search(body):
            parts = [(m.start(), m.end()) for m in RUN.finditer(body) if ALLOWED_PARTS.search(body, m.start(), m.end())]
        span = min(width, len(body))
        limit = next(c.least for c in CLASSES if c.shape.fullmatch(body))
        start = end = -1
        passed = 0
        for at, bits in entropy_peaks(body, width):
            while passed < len(parts) and parts[passed][1] <= at:
                passed += 1
            if bits >= limit and not (passed < len(parts) and parts[passed][0] < at + span):
                if at > end:
                    if end >= 0:
                        found.append((match.start() + start, match.start() + end))
                    start = at
                end = at + span
        if end >= 0:
            found.append((match.start() + start, match.start() + end))
    return found


def secret_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) in order, in code points; none for null or empty."""
    if not text:
        return []
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    spans += [(start, 3, end) for start, end in entropy_spans(text)]
    return sorted(spans)


def written_out(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


FOUND = pa.schema(
    [
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("n_entropy", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every column of ``docs`` and ``n_assign, n_access, n_hex, n_entropy, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` (code points, end exclusive) by start, then kind, then end; ``base_sha256`` is the digest
    of those of the three pattern kinds. A null text counts as empty; repeated rows give repeated
    results; columns of ``docs`` named like the new ones are replaced. Texts stay where they are: no shuffle.
    """
    kept = [c for c in docs.columns if c not in FOUND.names]
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                found = [secret_spans(t) for t in part.column(place).to_pylist()]
                base = [written_out([s for s in spans if s[1] < 3]) for spans in found]
                new = [pa.array([sum(s[1] == k for s in spans) for spans in found], pa.int64()) for k in range(4)]
                new.append(pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()))
                new.append(pa.array([written_out(spans) for spans in found], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*kept, *FOUND.names])

    rows = docs.select(*kept)
    schema = ", ".join(
        [
            *(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema),
            "n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string",
        ]
    )
    return rows.mapInArrow(run, schema)
