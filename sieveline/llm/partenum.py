"""Similarity join of documents on word shingles by PartEnum signatures, exact for its threshold.

Sets of Jaccard similarity at least ``percent`` and sizes in one band differ in at most ``k`` elements. Elements are dealt into
``k // 2 + 1`` partitions, so that two such sets differ in at most one element in some partition, and each partition
into two halves, of which then at least one is equal: the halves of all partitions are the signatures, and sufficiently similar
sets share one. Sets near the end of a band also take the signatures of the next band. An empty half would be
shared by sets that have nothing in common; there the other half, which differs in at most one
element, stands in with its elements and with each of them left out.

Sets that share a signature meet in the group of its smallest member: one row per set and group, instead of one per pair. A row has a
sketch of its set, counts of its elements by buckets: two sets differ at least as much as their sketches do, so pairs whose
sketches differ too much are ruled out without their texts, and none that links is. What is left connects sets into candidate
components. Then a text moves once, to its component, where sets are compared in full.

Signatures are compared as 64-bit hashes, which can only add candidates; shingles are compared as 64-bit hashes of
their words, equal sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.components import connected
from sieveline.sources.scratch import discard, written

WORDS = 4
PERCENT = 85
#: Each band of sizes ends where the next begins: this times the size it begins with.
BAND_RATIO = 1.384
#: Bytes of text turned into shingles at a time; shingles compared, and sketches compared, in one task.
SLICE_BYTES, GROUP_SHINGLES, GROUP_SETS = 2 << 20, 1_500_000, 8_000
#: Least and most buckets of a sketch; in between there is at least one for two elements.
BUCKETS = (16, 1024)
#: Bytes up to which a table of ids and hashes is broadcast instead of shuffling the texts it points to.
BROADCAST_BYTES = 64 << 20

#: Words whose hashes a Python worker keeps.
MEMORY = 100_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

U = np.uint64
_P = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def multiplier(place: int) -> np.uint64:
    """The odd factor of the word at a place of a shingle, another one for each place."""
    return _P[place] if place < len(_P) else mixed(np.array([place], U))[0] | U(1)


class WordHashes(dict):
    """64-bit hash per word, computed when first asked for; forgets all beyond a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMORY:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


KNOWN = WordHashes()


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash per word, number of words per text) of lower-cased texts; null has no words."""
    split = [t.encode().translate(_LOWER).split() if t else [] for t in texts.to_pylist()]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    return np.fromiter(map(KNOWN.__getitem__, chain.from_iterable(split)), U, int(counts.sum())), counts


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of distinct shingles, ascending per text, one text after another; number per text).

    A text of fewer words has its whole sequence as the one shingle; one without words has none.
    """
    hashes, counts = word_hashes(texts)
    starts = np.cumsum(counts) - counts
    out, sizes = [], np.zeros(len(counts), np.int64)
    with np.errstate(over="ignore"):
        if len(hashes) >= words:
            n = len(hashes) - words + 1
            windows = sum((hashes[d : d + n] * multiplier(d) + U(d) for d in range(words)), np.zeros(n, U))
            windows = mixed(windows)
        for k in np.nonzero(counts)[0]:
            a, c = starts[k], counts[k]
            if c >= words:
                own = np.unique(windows[a : a + c - words + 1])
            else:
                part = hashes[a : a + c]
                own = mixed(np.array([sum((part[d : d + 1] * multiplier(d) + U(d + 101 * c) for d in range(c)), np.zeros(1, U))[0]], U))
            sizes[k] = len(own)
            out.append(own)
    return np.concatenate(out) if out else np.empty(0, U), sizes


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum per consecutive part, modulo 2^64; 0 for an empty one."""
    total = np.zeros(len(sizes), U)
    full = np.nonzero(sizes)[0]
    if len(full):
        total[full] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[full])
    return total


def set_keys(elements: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys per set; equal sets have equal ones, in whatever order their elements are."""
    with np.errstate(over="ignore"):
        return sums(mixed(elements ^ _P[0]), sizes), sums(mixed(elements ^ _P[1]), sizes)


def binary_keys(first: np.ndarray, second: np.ndarray) -> pa.Array:
    raw = np.column_stack([first, second]).astype(">u8").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(first), [None, pa.py_buffer(raw)]).cast(pa.binary())


def most_different(total: int, percent: int = PERCENT) -> int:
    """Most elements in one but not both of two linked sets with so many elements in all."""
    return (100 - percent) * total // (100 + percent)


def smallest_band(percent: int = PERCENT) -> int:
    """Least n with ``100 * n >= percent * (n + 1)``: smaller sets link only when equal."""
    return -(-percent // max(1, 100 - percent))


@cache
def bands(percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(first size, number of partitions) of each band."""
    first = [smallest_band(percent)]
    while first[-1] < 1 << 40:
        first.append(max(first[-1] + 1, int(np.ceil(first[-1] * BAND_RATIO))))
    parts = [most_different(2 * (nxt - 1), percent) // 2 + 1 for nxt in first[1:]]
    return np.array(first[:-1]), np.array(parts)


def signatures(elements: np.ndarray, sizes: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(signature, number of the set it belongs to) of all sets; those below the smallest band have none."""
    first, parts = bands(percent)
    own = np.searchsorted(first, sizes, side="right") - 1
    reach = np.searchsorted(first, sizes * 100 // percent, side="right") - 1
    chosen = np.nonzero(sizes >= first[0])[0]
    # the bands of a set: its own, and any further one in which a linked set of larger size can be
    visits = [np.column_stack([chosen, own[chosen]])]
    step = 1
    while len(chosen := chosen[reach[chosen] >= own[chosen] + step]):
        visits.append(np.column_stack([chosen, own[chosen] + step]))
        step += 1
    pairs = np.concatenate(visits)
    if not len(pairs):
        return np.empty(0, U), np.empty(0, np.int64)
    owner, band = pairs[:, 0], pairs[:, 1]
    starts, n = (np.cumsum(sizes) - sizes)[owner], sizes[owner]
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    values = elements[at]
    halves = 2 * parts[band]
    base = np.cumsum(halves) - halves
    with np.errstate(over="ignore"):
        dealt = mixed(values ^ np.repeat(mixed(band.astype(U) + U(1)), n))
        part = ((dealt >> U(32)) * np.repeat(parts[band].astype(U), n)) >> U(32)
        cell = np.repeat(base, n) + (U(2) * part + (dealt & U(1))).astype(np.int64)
        weight = mixed(values + _P[2])
        total = int(halves.sum())
        filled = np.bincount(cell, minlength=total)
        content = np.zeros(total, U)
        np.add.at(content, cell, weight)
        holder = np.repeat(np.arange(len(pairs)), halves)
        tag = mixed((band.astype(U) << U(40))[holder] + (np.arange(total) - base[holder]).astype(U))
        plain = np.nonzero(filled)[0]
        bare = np.nonzero(filled == 0)[0]
        # an element whose sibling half is empty is also left out once from what stands in for that half
        beside = np.nonzero(filled[cell ^ 1] == 0)[0]
        sibling = cell[beside] ^ 1
        out = [
            mixed(content[plain] + tag[plain]),
            mixed(mixed(content[bare ^ 1]) + tag[bare] + U(1)),
            mixed(mixed(content[cell[beside]] - weight[beside]) + tag[sibling] + U(1)),
        ]
    return np.concatenate(out), owner[np.concatenate([holder[plain], holder[bare], holder[sibling]])]


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about :data:`SLICE_BYTES` of text."""
    lengths = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64) + 1)
    groups = lengths // SLICE_BYTES
    cuts = [0, *(np.nonzero(np.diff(groups))[0] + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def bucket_numbers(sizes: np.ndarray) -> np.ndarray:
    """Buckets of the sketch of a set of each size: a power of two, at least half the size within the bounds."""
    least, most = BUCKETS
    return np.clip(1 << np.ceil(np.log2(np.maximum(sizes, 2) / 2)).astype(np.int64), least, most)


def sketches(elements: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Per set the number of its elements in each bucket, 255 for more; one byte each."""
    wide = bucket_numbers(sizes)
    base = np.cumsum(wide) - wide
    bucket = (mixed(elements ^ _P[3]) >> U(32)).astype(np.int64) & np.repeat(wide - 1, sizes)
    counts = np.bincount(np.repeat(base, sizes) + bucket, minlength=int(wide.sum()))
    raw = np.minimum(counts, 255).astype(np.uint8).tobytes()
    offsets = np.append(base, len(raw)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)])


def folded(sketch: np.ndarray, buckets: int) -> np.ndarray:
    """The sketch that the same set has with fewer buckets."""
    return np.minimum(sketch.reshape(-1, buckets).sum(axis=0), 255)


def similar_sketches(keys: list[bytes], sizes: list[int], found: list[bytes], percent: int = PERCENT) -> list[tuple[bytes, bytes]]:
    """A spanning forest over all pairs of sets that may link: their sketches differ by no more than linked sets do."""
    order = sorted(range(len(keys)), key=lambda k: (sizes[k], keys[k]))
    n = np.array([sizes[k] for k in order])
    wide = bucket_numbers(n)
    reach = np.searchsorted(n, n * 100 // percent, side="right")
    forest = Forest(len(order))
    for buckets in np.unique(wide).tolist():
        first, last = np.searchsorted(wide, [buckets, buckets + 1])
        rows = [folded(np.frombuffer(found[order[k]], np.uint8).astype(np.int16), buckets) for k in range(first, reach[last - 1])]
        table = np.array(rows, np.int16)
        for k in range(first, last):
            own = table[k - first]
            differ = np.abs(table[k - first + 1 : reach[k] - first] - own).sum(axis=1, dtype=np.int64)
            for j in (np.nonzero(differ <= (100 - percent) * (n[k] + n[k + 1 : reach[k]]) // (100 + percent))[0] + k + 1).tolist():
                forest.link(k, j)
    return [(keys[order[a]], keys[order[b]]) for a, b in forest.links]


class Forest:
    """Which of some numbered sets are connected, and links enough to connect them."""

    def __init__(self, size: int):
        self.root = list(range(size))
        self.links: list[tuple[int, int]] = []

    def top(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = self.root[self.root[k]]
            k = self.root[k]
        return k

    def link(self, a: int, b: int) -> None:
        x, y = self.top(a), self.top(b)
        if x != y:
            self.root[y] = x
            self.links.append((a, b))


def set_table(docs: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """(doc_id, body, n, short_key, key, sketch) per document: hash of the text, size of the set, its keys of 64 and 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                elements, sizes = shingle_sets(part.column(2), words)
                one, two = set_keys(elements, sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes), pa.array(one.view(np.int64)), binary_keys(one, two), sketches(elements, sizes)],
                    names=["doc_id", "body", "n", "short_key", "key", "sketch"],
                )

    rows = docs.select(F.col(id).alias("doc_id"), F.xxhash64(text).alias("body"), F.col(text))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, body long, n long, short_key long, key binary, sketch binary")


def memberships(docs: DataFrame, text: str, words: int, percent: int) -> DataFrame:
    """(leader, short_key), each once: sets that share a signature, with the smallest of them."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                elements, sizes = shingle_sets(part.column(0), words)
                keys, more = set_keys(elements, sizes)
                # equal sets have equal signatures: one of each is enough
                _, first = np.unique(np.column_stack([keys, more]), axis=0, return_index=True)
                kept = np.zeros(len(sizes), bool)
                kept[first] = True
                found, owner = signatures(elements[np.repeat(kept, sizes)], sizes[kept], percent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(keys[kept][owner].view(np.int64))], names=["signature", "short_key"]
                )

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows in order, those that do not begin their signature, with the one that does. Nothing is gathered."""
        last, leader = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.empty(len(sig), bool)
            new[0], new[1:] = sig[0] != last, sig[1:] != sig[:-1]
            run = np.cumsum(new) - 1
            leaders = key[new]
            own = np.where(run >= 0, leaders[run] if len(leaders) else 0, 0 if leader is None else leader)
            rows = np.unique(np.column_stack([own, key])[own != key], axis=0)
            last, leader = sig[-1], own[-1]
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["leader", "short_key"])

    pairs = docs.select(text).mapInArrow(signed, "signature long, short_key long")
    ordered = pairs.repartition("signature").sortWithinPartitions("signature", "short_key")
    return ordered.mapInArrow(led, "leader long, short_key long").distinct()


def links_among(keys: list[bytes], sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links among some sets; all pairs that can link and are not connected yet are compared.

    Sets of which too few elements occur in another one are put aside first, as often as that leaves new ones. Then the set with
    the most common elements is compared with all, and all that do not link with it are compared with all.
    """
    seen: dict[bytes, np.ndarray] = dict(zip(keys, sets, strict=True))
    names, left = list(seen), list(seen.values())
    if len(left) == 2:
        common = len(np.intersect1d(*left, assume_unique=True))
        linked = 100 * common >= percent * (len(left[0]) + len(left[1]) - common)
        return [(names[0], names[1])] if linked else []
    alive = np.arange(len(left))
    while len(alive) > 1:
        sizes = np.array([len(left[k]) for k in alive])
        _, number, times = np.unique(np.concatenate([left[k] for k in alive]), return_inverse=True, return_counts=True)
        shared = np.add.reduceat(times[number] > 1, np.cumsum(sizes) - sizes, dtype=np.int64)
        able = 100 * shared >= percent * sizes
        if able.all():
            break
        alive = alive[able]
    if len(alive) < 2:
        return []
    owner = np.repeat(np.arange(len(alive)), sizes)
    by_element = owner[np.argsort(number, kind="stable")]
    ends = np.cumsum(times)
    starts = np.cumsum(sizes) - sizes
    forest = Forest(len(alive))

    def compare(k: int) -> None:
        own = number[starts[k] : starts[k] + sizes[k]]
        common = np.bincount(np.concatenate([by_element[ends[e] - times[e] : ends[e]] for e in own]), minlength=len(alive))
        for j in np.nonzero(100 * common >= percent * (sizes[k] + sizes - common))[0].tolist():
            forest.link(k, j)

    middle = int(np.argmax(np.add.reduceat(times[number], starts) / sizes))
    compare(middle)
    for k in range(len(alive)):
        if forest.top(k) != forest.top(middle):
            compare(k)
    return [(names[alive[a]], names[alive[b]]) for a, b in forest.links]


def grouped_rows(batches: Iterator[pa.RecordBatch], of: int, text: int | None = None) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Consecutive rows that agree in the first ``of`` columns, with those values; batches with a text come in slices."""
    group, held = None, []
    for batch in batches:
        for part in slices(batch, text) if text is not None else [batch]:
            places = list(zip(*(part.column(k).to_pylist() for k in range(of)), strict=True))
            start = 0
            for end in range(1, len(places) + 1):
                if end == len(places) or places[end] != places[start]:
                    if places[start] != group and held:
                        yield group, held
                        held = []
                    group = places[start]
                    held.append(part.slice(start, end - start))
                    start = end
    if held:
        yield group, held


def pair_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = zip(*pairs, strict=True) if pairs else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()) for c in columns], names=["a", "b"])


def in_bytes(table: DataFrame, id: str = "doc_id") -> int:
    """At most so many bytes that a table of ids and hashes takes up."""
    row = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length(F.col(id).cast("string"))).alias("width")).first()
    return row["n"] * ((row["width"] or 0) + 128)


def met_with(docs: DataFrame, id: str, text: str, places: DataFrame) -> DataFrame:
    """The texts of documents with their rows of ``places`` (doc_id, body, ...). A small table of places is broadcast."""
    bodies = docs.select(F.col(id).alias("_id"), F.xxhash64(text).alias("_body"), F.col(text).alias("text"))
    small = in_bytes(places) <= BROADCAST_BYTES
    return bodies.join(F.broadcast(places) if small else places, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_body") == F.col("body")))


def candidate_links(found: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """(a, b): enough pairs of sets with similar sketches to connect all that share a signature and may link."""
    members = found.unionByName(found.select("leader", F.col("leader").alias("short_key"))).distinct()
    sets = table.where(F.col("n") > 0).groupBy("short_key", "key").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # sets that share a key of 64 bits by chance are both members
    placed = members.join(sets, "short_key")
    shares = members.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / GROUP_SETS).cast("int").alias("blocks")).where("blocks > 1")
    parts = F.coalesce("blocks", F.lit(1))
    block = F.pmod(F.xxhash64("key"), parts).cast("int")
    dealt = (
        placed.join(shares, "leader", "left")
        .withColumn("_own", block)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("leader", F.least("_own", "_other").alias("low"), F.greatest("_own", "_other").alias("high"), "key", "n", "sketch")
    )

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple[bytes, bytes]] = []
        for _, parts in grouped_rows(batches, 3):
            keys, sizes, found = ([x for p in parts for x in p.column(k).to_pylist()] for k in (3, 4, 5))
            pairs += similar_sketches(keys, sizes, found, percent) if len(keys) > 1 else []
            if len(pairs) > 10_000:
                yield pair_batch(pairs)
                pairs = []
        yield pair_batch(pairs)

    place = ["leader", "low", "high"]
    return dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(sifted, "a binary, b binary")


def compared(met: DataFrame, words: int, percent: int) -> DataFrame:
    """(root, a, b) from rows (root, block, hub, text): the links of each block, and with b null what does not connect to its hub."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def result() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 3
            out = pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()) for c in columns], names=["root", "a", "b"])
            rows.clear()
            return out

        for (root, _), parts in grouped_rows(batches, 2, 3):
            keys, sets, hub = [], [], None
            for part in parts:
                elements, sizes = shingle_sets(part.column(3), words)
                ends = np.cumsum(sizes)
                own = binary_keys(*set_keys(elements, sizes)).to_pylist()
                sets += [elements[e - n : e] for e, n in zip(ends, sizes, strict=True)]
                hub = next((k for k, is_hub in zip(own, part.column(2).to_pylist(), strict=True) if is_hub), hub)
                keys += own
            pairs = links_among(keys, sets, percent) if len(keys) > 1 else []
            rows += [(root, a, b) for a, b in pairs]
            if hub is not None:
                place = {k: i for i, k in enumerate(dict.fromkeys(keys))}
                forest = Forest(len(place))
                for a, b in pairs:
                    forest.link(place[a], place[b])
                rows += [(root, k, None) for k, i in place.items() if forest.top(i) != forest.top(place[hub])]
            if len(rows) > 10_000:
                yield result()
        yield result()

    place = ["root", "block"]
    ordered = met.select(*place, "hub", "text").repartition(*place).sortWithinPartitions(*place)
    return ordered.mapInArrow(run, "root binary, a binary, b binary")


def links(docs: DataFrame, table: DataFrame, id: str, text: str, words: int, percent: int) -> DataFrame:
    """(a, b): keys of different sets that link, enough of them to connect every component.

    A component of more than :data:`GROUP_SHINGLES` shingles is dealt into blocks. Each block has the hub of the component beside its
    own sets, so sets that connect to the hub are connected in one go; only those that do not are sent to the other blocks.
    """
    found = written(memberships(docs, text, words, percent), "memberships")
    edges = written(candidate_links(found, table, percent), "candidates")
    roots = connected(edges)
    # the text to take a set from: of the smallest id
    sources = table.where(F.col("n") > 0).groupBy("key").agg(F.min(F.struct("doc_id", "body", "n")).alias("of"))
    placed = roots.join(sources, F.col("node") == F.col("key")).select("root", "key", "of.*")
    shares = placed.groupBy("root").agg(F.ceil(F.sum("n") / GROUP_SHINGLES).cast("int").alias("blocks"))
    dealt = written(placed.join(shares, "root").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")), "dealt")
    discard(found, roots)
    ends = edges.select("a").unionByName(edges.select(F.col("b").alias("a"))).groupBy("a").agg(F.count(F.lit(1)).alias("links"))
    wide = dealt.where("blocks > 1")
    hubs = wide.join(ends, F.col("key") == F.col("a")).groupBy("root").agg(F.max_by("key", F.struct("links", "key")).alias("hub_key"))
    copies = wide.join(hubs, "root").where(F.col("key") == F.col("hub_key")).select(
        "root", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("hub"), "doc_id", "body"
    )
    own = dealt.select("root", "block", F.lit(False).alias("hub"), "doc_id", "body")
    places = written(own.unionByName(copies), "places")
    first = written(compared(met_with(docs, id, text, places), words, percent), "compared")
    direct = first.where(F.col("b").isNotNull()).select("a", "b")
    apart = first.where(F.col("b").isNull()).select("root", F.col("a").alias("key"))
    if apart.isEmpty():
        discard(edges, dealt, places)
        return direct
    visiting = apart.join(dealt, ["root", "key"]).select(
        "root", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("hub"), "doc_id", "body"
    )
    again = own.join(apart.select("root").distinct(), "root", "left_semi").unionByName(visiting).distinct()
    second = written(compared(met_with(docs, id, text, again), words, percent), "compared")
    discard(edges, dealt, places)
    return direct.unionByName(second.select("a", "b"))


def classified(docs: DataFrame, id: str, text: str, words: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """(doc_id, body, n, root, component_id) per document, and the stored tables it reads; ``root`` is the key of its component."""
    table = written(set_table(docs, id, text, words), "sets")
    linked = written(links(docs, table, id, text, words, percent), "linked")
    roots = connected(linked)
    discard(linked)
    sets = table.where(F.col("n") > 0).groupBy("key").agg(F.min("doc_id").alias("smallest"))
    rooted = sets.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    components = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    of_set = rooted.select("key", "root").join(components, "root").select("key", "root", "component_id")
    return table.join(of_set, "key", "left").select("doc_id", "body", "n", "root", "component_id"), [table, roots]


def similarity_classes(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Words are runs of other than blanks, A-Z lower-cased; the set of a document has its distinct shingles of ``words``
    words. Documents link if ``100 * common >= percent * union``; ``component_id`` is the smallest id reachable by links. Texts without
    words and null texts have an empty set, link with nothing and are their own component, repeated or not. Null
    ids are passed over where there is another, so a component of null ids alone has a null id. Other columns are not read.
    """
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    rows, _ = classified(docs, id, text, words, percent)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def without_similar(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with one of each component left: that of the smallest id, or hash of the text if ids are null.

    Of rows repeated in id and text one stays. Documents without words stay all. Columns keep their names and values.
    Only ids and hashes of what goes, or is repeated, are joined to the texts.
    """
    rows, made = classified(docs, id, text, words, percent)
    place = F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("id"), F.col("body").alias("body"))
    full = written(rows.where(F.col("n") > 0).select("root", place.alias("place")), "placed")
    first = full.groupBy("root").agg(F.min("place").alias("first"))
    marks = (
        full.join(first, "root")
        .groupBy("place")
        .agg(F.max(F.col("place") == F.col("first")).alias("stays"), F.count(F.lit(1)).alias("times"))
        .where(~F.col("stays") | (F.col("times") > 1))
        .select(F.col("place.id").alias("_id"), F.col("place.body").alias("_body"), "stays")
    )
    stored = written(marks, "marks")
    discard(full, *made)
    small = in_bytes(stored, "_id") <= BROADCAST_BYTES
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id).alias("_own"), F.xxhash64(text).alias("_hash"))
    marked = row.join(
        F.broadcast(stored) if small else stored, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_body")), "left"
    )
    once = marked.where(F.col("stays").isNull()).select("_row.*")
    repeated = marked.where(F.col("stays")).dropDuplicates(["_own", "_hash"]).select("_row.*")
    return once.unionByName(repeated)
