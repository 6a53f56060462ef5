"""Benchmark passages in documents, found by one Aho-Corasick automaton over normalised windows.

The stated query set (the benchmark) is normalised, cut into windows of consecutive words and put into
an automaton; a text is normalised the same way and scanned once, whatever the number of windows.
Documents are neither shuffled nor compared with one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Bound on the characters of the windows in one automaton, and so on each broadcast block.
BLOCK_CHARS = 8_000_000

#: A-Z to a-z, other bytes below 0x80 that are neither digits nor letters to a blank; UTF-8 bytes from 0x80 stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

RESULT = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
RESULT_DDL = "n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"


def normal_words(text: str | None) -> list[bytes]:
    """Lower-case words as UTF-8, without punctuation; none for null."""
    return text.encode().translate(_FOLD).split() if text else []


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Start and end of each word of :func:`normal_words` in code points of the original text."""
    folded = text.encode().translate(_FOLD)
    found, at, seen = [], 0, 0
    for word in folded.split():
        here = folded.index(word, at)
        seen += len(folded[at:here].decode())
        size = len(word.decode())
        found.append((seen, seen + size))
        at, seen = here + len(word), seen + size
    return found


def windows_of(words: list[bytes], width: int = WINDOW) -> Iterator[bytes]:
    """Every run of ``width`` words; all of them as one if there are fewer, nothing if there are none."""
    if words:
        for i in range(max(1, len(words) - width + 1)):
            yield b" ".join(words[i : i + width])


def automaton_of(windows: list[tuple[bytes, list[str]]]):
    """An automaton whose entries are (number of words, items), with a blank at both ends of each window."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for window, items in windows:
        found.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, items))
    found.make_automaton()
    return found


def hits_of(words: list[bytes], automata: list) -> list[tuple[int, int, list[str]]]:
    """(first word, number of words, items) of each occurrence of a window."""
    if not words:
        return []
    line = f" {b' '.join(words).decode('latin-1')} "
    found = []
    for automaton in automata:
        for end, (width, items) in automaton.iter(line):
            found.append((end, width, items))
    if not found:
        return []
    found.sort(key=lambda hit: hit[0])
    hits, at, passed = [], 0, 0
    for end, width, items in found:  # the blank at ``end`` closes the last word of the occurrence
        passed += line.count(" ", at, end + 1)
        at = end + 1
        hits.append((passed - 1 - width, width, items))
    return hits


def scanned(texts: list[str | None], automata: list, known_hits: bool = True) -> dict[str, list]:
    out: dict[str, list] = {"n_words": [], "n_hit": [], "items": [], "spans": []}
    for text in texts:
        words = normal_words(text)
        covered: set[int] = set()
        items: set[str] = set()
        for first, width, own in hits_of(words, automata):
            covered.update(range(first, first + width))
            items.update(own)
        spans: list[dict[str, int]] = []
        if covered:
            offsets = word_offsets(text)
            last = -2
            for k in sorted(covered):
                if k == last + 1:
                    spans[-1]["end"] = offsets[k][1]
                else:
                    spans.append({"start": offsets[k][0], "end": offsets[k][1]})
                last = k
        out["n_words"].append(len(words))
        out["n_hit"].append(len(covered))
        out["items"].append(sorted(items))
        out["spans"].append(spans)
    return out


def query_blocks(benchmark: DataFrame, id: str, text: str, width: int, block_chars: int) -> list:
    """The windows with their items, in broadcast blocks of at most ``block_chars`` characters each.

    The rows are streamed through the driver one partition at a time; the benchmark is the stated
    query set. Windows that several items share are in a block once per block, with the items met there.
    """
    spark = benchmark.sparkSession
    blocks, block, size = [], {}, 0
    for row in benchmark.select(F.col(id).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        for window in windows_of(normal_words(row["t"]), width):
            if window not in block:
                if block and size + len(window) > block_chars:
                    blocks.append(spark.sparkContext.broadcast([(w, sorted(x)) for w, x in block.items()]))
                    block, size = {}, 0
                block[window] = set()
                size += len(window)
            if row["i"] is not None:
                block[window].add(row["i"])
    blocks.append(spark.sparkContext.broadcast([(w, sorted(x)) for w, x in block.items()]))
    return blocks


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Every column of ``docs`` and ``n_words, n_hit, items, spans``, one row per document.

    ``items`` holds the ids (as strings, sorted) of the benchmark items one of whose windows occurs,
    ``spans`` the hit passages in code points of the original text. A benchmark beyond ``block_chars``
    is scanned for in several automata, all within one pass over the documents. A null text has no
    words and no hits, neither has a null or empty benchmark item; an item with a null id marks words
    as hit but is not listed. Repeated rows, ids and items are kept apart or merged by these rules
    alone. Columns of ``docs`` named like the new ones are replaced.
    """
    blocks = query_blocks(benchmark, item_id, item_text, width, block_chars)
    kept = [c for c in docs.columns if c not in RESULT.names]
    place = kept.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [automaton_of(block.value) for block in blocks if block.value]
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                found = scanned(part.column(place).to_pylist(), automata)
                new = [pa.array(found[f.name], f.type) for f in RESULT]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*kept, *RESULT.names])

    rows = docs.select(*kept)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), RESULT_DDL])
    return rows.mapInArrow(scan, schema)
