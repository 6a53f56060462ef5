"""Language identification by unigram pieces, with all segmentations of a word summed.

Per language a probability for each piece of a fixed public vocabulary; the likelihood of a word is the sum over
all ways to cut it into pieces (forward algorithm), that of a text the product over its words. The
probabilities are fitted by expectation maximisation over the same segmentations on a bounded sample of labelled texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.partenum import slices
from sieveline.sources.scratch import discard, written

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Expected number of labelled documents per language that the model is fitted on.
SAMPLE = 800
ROUNDS = 3
#: Words of up to so many letters are scored together in plain probabilities, longer ones one by one and rescaled on the way. The
#: model is fitted on the former.
SHORT = 32
START = "▁"
#: Probability of a character that no piece covers, in every language.
UNKNOWN = 1e-7
SMOOTHING = 0.02
#: Words whose scores a Python worker keeps, and bytes of those scores.
MEMORY, MEMORY_BYTES = 1_000_000, 64 << 20

_RUNS = re.compile(r"[^\W\d_]+")


def words_in(text: str | None) -> list[str]:
    """Runs of letters in lower case; none for null."""
    found = _RUNS.findall(text.lower()) if text else []
    if not all(map(str.isalpha, found)):  # numbers that are no digits, such as in m²
        found = [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]
    return found


class Pieces(dict):
    """Number per piece, and an automaton that finds all of them in a line of words."""

    def __init__(self, numbers: dict[str, int]):
        import ahocorasick

        super().__init__(numbers)
        self.width = max(map(len, numbers), default=1)
        self.automaton = ahocorasick.Automaton()
        for piece, number in numbers.items():
            self.automaton.add_word(piece, number * (self.width + 1) + len(piece))
        if numbers:
            self.automaton.make_automaton()

    def matches(self, line: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end, length, number) of every occurrence."""
        found = list(self.automaton.iter(line)) if self else []
        ends, values = (np.fromiter(c, np.int64, len(found)) for c in (zip(*found, strict=True) if found else ((), ())))
        return ends + 1, values % (self.width + 1), values // (self.width + 1)


def load_pieces(path: str) -> Pieces:
    """Number per piece of a SentencePiece model; pieces of other than letters and the word start are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    usable = {p for p in pieces if p == START or p.removeprefix(START).isalpha()}
    return Pieces({p: i for i, p in enumerate(sorted(usable))})


def lattice(words: list[str], pieces: Pieces) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(end, length, words, piece numbers) in order of ends: the pieces of that length that end there; -2 for a character without one."""
    marked = [START + w for w in words]
    sizes = np.array([len(m) for m in marked])
    starts = np.cumsum(sizes + 1) - sizes - 1
    end, size, number = pieces.matches("\n".join(marked))
    word = np.searchsorted(starts, end, side="left") - 1
    end = end - starts[word]
    # characters that are no piece themselves
    bare = np.zeros((len(words), int(sizes.max()) + 1), bool)
    bare[:, 1:] = np.arange(1, bare.shape[1]) <= sizes[:, None]
    bare[word[size == 1], end[size == 1]] = False
    at, place = np.nonzero(bare)
    word, end = np.concatenate([word, at]), np.concatenate([end, place])
    size, number = np.concatenate([size, np.ones(len(at), np.int64)]), np.concatenate([number, np.full(len(at), -2)])
    key = end * (pieces.width + 2) + size
    order = np.argsort(key, kind="stable")
    cuts = np.nonzero(np.diff(key[order]))[0] + 1
    return [(int(end[o[0]]), int(size[o[0]]), word[o], number[o]) for o in np.split(order, cuts) if len(o)]


def padded(probabilities: np.ndarray) -> np.ndarray:
    """Rows per piece, then one for unknown characters (at -2) and one for no piece (at -1)."""
    languages = probabilities.shape[1]
    return np.vstack([probabilities, np.full((1, languages), UNKNOWN), np.zeros((1, languages))])


def forward(steps: list[tuple[int, int, np.ndarray, np.ndarray]], shape: tuple[int, int], table: np.ndarray) -> np.ndarray:
    """Probability of each prefix of each word, summed over its segmentations: (word, end, language)."""
    alpha = np.zeros((*shape, table.shape[1]))
    alpha[:, 0] = 1.0
    for end, size, rows, ids in steps:
        alpha[rows, end] += alpha[rows, end - size] * table[ids]
    return alpha


def long_logs(word: str, pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Log probability of one word of any length in each language: only the prefixes that a piece can reach back to are held."""
    marked = START + word
    ends, sizes, numbers = pieces.matches(marked)
    order = np.argsort(ends, kind="stable")
    bounds = np.searchsorted(ends[order], np.arange(len(marked) + 2))
    recent = [np.ones(table.shape[1])]  # prefixes that end here, one character earlier, and so on
    log = np.zeros(table.shape[1])
    for end in range(1, len(marked) + 1):
        own = order[bounds[end] : bounds[end + 1]]
        total = sum((recent[s - 1] * table[n] for s, n in zip(sizes[own].tolist(), numbers[own].tolist(), strict=True)), np.zeros(table.shape[1]))
        if not (sizes[own] == 1).any():
            total = total + recent[0] * table[-2]
        recent = [total, *recent[: max(pieces.width, 1) - 1]]
        if total.min(initial=1.0) < 1e-100:
            scale = np.maximum(total, 1e-300)
            recent = [r / scale for r in recent]
            log += np.log(scale)
    return log + np.log(np.maximum(recent[0], 1e-300))


def word_logs(words: list[str], pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, all segmentations summed."""
    out = np.empty((len(words), table.shape[1]))
    short = sorted((i for i in range(len(words)) if len(words[i]) <= SHORT), key=lambda i: len(words[i]))
    for k in range(0, len(short), 2048):
        chosen = short[k : k + 2048]
        part = [words[i] for i in chosen]
        ends = np.array([len(w) + 1 for w in part])
        alpha = forward(lattice(part, pieces), (len(part), int(ends.max()) + 1), table)
        out[chosen] = np.log(np.maximum(alpha[np.arange(len(chosen)), ends], 1e-300))
    for i in range(len(words)):
        if len(words[i]) > SHORT:
            out[i] = long_logs(words[i], pieces, table)
    return out


def expected_counts(words: list[str], counts: np.ndarray, pieces: Pieces, column: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words, given probabilities of one language."""
    table = padded(column[:, None])
    totals = np.zeros(len(table))
    for k in range(0, len(words), 2048):
        part = words[k : k + 2048]
        steps = lattice(part, pieces)
        ends = np.array([len(w) + 1 for w in part])
        alpha = forward(steps, (len(part), int(ends.max()) + 1), table)[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[np.arange(len(part)), ends] = 1.0
        whole = alpha[np.arange(len(part)), ends]
        scale = counts[k : k + 2048] / np.maximum(whole, 1e-300)
        for end, size, rows, ids in reversed(steps):
            p = table[ids, 0]
            np.add.at(totals, ids, scale[rows] * alpha[rows, end - size] * p * beta[rows, end])
            beta[rows, end - size] += p * beta[rows, end]
    return totals[: len(column)]


class Model:
    """Languages (sorted) and the probability of each piece in each: bounded by vocabulary and languages."""

    def __init__(self, path: str, languages: list[str], probabilities: np.ndarray):
        self.path, self.languages, self.probabilities = path, languages, probabilities


def sample_of(docs: DataFrame, id: str, text: str, lang: str, sample: int) -> DataFrame:
    """(lang, word, n): word counts of about ``sample`` labelled documents per language, chosen by a hash.

    Only rows with a language whose id is not held out are looked at. Documents are chosen before their texts are split.
    """
    open_rows = docs.where(F.col(lang).isNotNull() & ~held_out(id) & F.col(text).isNotNull())
    sizes = open_rows.groupBy(lang).agg(F.count(F.lit(1)).alias("_rows")).withColumnRenamed(lang, "_lang")  # one row per language
    draw = F.pmod(F.xxhash64(F.col(id), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    # one row per language, of which the model on the driver has a whole column: else all texts of a language would meet in one task
    chosen = open_rows.join(F.broadcast(sizes), F.col(lang) == F.col("_lang")).where(draw * F.col("_rows") < sample)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for language, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter(words_in(body)).items():
                    if len(word) <= SHORT:
                        found[language, word] += n
            rows = list(found.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())],
                names=["lang", "word", "n"],
            )

    words = chosen.select("_lang", text).mapInArrow(counted, "lang string, word string, n long")
    return words.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def held_out(id: str):
    """Documents that no model may be fitted on: CRC32 of the id as text leaves no rest modulo 5. A null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("null")).cast("binary")) % 5 == 0


def fit(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    vocabulary: str = VOCABULARY,
    sample: int = SAMPLE,
    rounds: int = ROUNDS,
) -> Model:
    """Fit the piece probabilities of every language found among the open rows.

    Each round sends out the current table, gathers expected counts per language and piece, and normalises them:
    at most vocabulary times languages rows reach the driver, whatever the corpus.
    """
    words = written(sample_of(docs, id, text, lang, sample), "langwords")
    languages = sorted(r[0] for r in words.select("lang").distinct().collect())  # one row per language
    n_pieces = len(load_pieces(vocabulary))
    probabilities = np.full((n_pieces, len(languages)), 1.0 / max(n_pieces, 1))
    spark = docs.sparkSession
    for _ in range(rounds if languages else 0):
        sent = spark.sparkContext.broadcast((languages, probabilities))

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, current = sent.value  # noqa: B023
            pieces = load_pieces(vocabulary)
            totals = np.zeros_like(current)
            for batch in batches:
                langs = batch.column(0).to_pylist()
                found, counts = batch.column(1).to_pylist(), batch.column(2).to_numpy()
                for k, name in enumerate(names):
                    rows = [i for i, x in enumerate(langs) if x == name]
                    if rows:
                        totals[:, k] += expected_counts([found[i] for i in rows], counts[rows], pieces, current[:, k])
            piece, language = np.nonzero(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(language, pa.int32()), pa.array(piece, pa.int32()), pa.array(totals[piece, language])],
                names=["language", "piece", "n"],
            )

        parts = words.select("lang", "word", "n").mapInArrow(expect, "language int, piece int, n double")
        counts = np.full_like(probabilities, SMOOTHING)
        for row in parts.groupBy("language", "piece").agg(F.sum("n").alias("n")).collect():
            counts[row["piece"], row["language"]] += row["n"]
        probabilities = counts / counts.sum(axis=0)
    discard(words)
    return Model(vocabulary, languages, probabilities)


class Scorer:
    """Scores texts with a model, keeping the scores of words met before, in bounded memory.

    Words are kept as 64-bit hashes in order, beside their scores: a word takes no more room than these numbers.
    """

    def __init__(self, model: Model):
        self.languages = model.languages
        self.pieces, self.table = load_pieces(model.path), padded(model.probabilities)
        self.most = max(1, min(MEMORY, MEMORY_BYTES // (8 * (len(model.languages) + 1))))
        self.forget()

    def forget(self) -> None:
        self.keys, self.logs = np.empty(0, np.uint64), np.empty((0, len(self.languages)))

    def scores(self, words: list[str]) -> np.ndarray:
        """Log probabilities of distinct words; those not met before are scored together."""
        import xxhash

        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in words), np.uint64, len(words))
        place = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(words), bool)
        if len(self.keys):
            known = self.keys[np.minimum(place, len(self.keys) - 1)] == hashes
        out = np.empty((len(words), len(self.languages)))
        out[known] = self.logs[place[known]]
        new = np.nonzero(~known)[0]
        if len(new):
            out[new] = word_logs([words[k] for k in new.tolist()], self.pieces, self.table)
            if len(self.keys) + len(new) > self.most:
                self.forget()
            fresh, first = np.unique(hashes[new][: self.most], return_index=True)
            at = np.searchsorted(self.keys, fresh)
            self.keys = np.insert(self.keys, at, fresh)
            self.logs = np.insert(self.logs, at, out[new[first]], axis=0)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        split = [words_in(t) for t in texts]
        number: dict[str, int] = {}
        flat = np.fromiter((number.setdefault(w, len(number)) for words in split for w in words), np.int64, sum(map(len, split)))
        logs = self.scores(list(number)) if self.languages else np.empty((len(number), 0))
        out, at = [], 0
        for words in split:
            own = flat[at : at + len(words)]
            at += len(words)
            if not self.languages or not words:
                out.append(("und", 0.0))
                continue
            total = logs[own].sum(axis=0)
            weights = np.exp(total - total.max())
            best = int(weights.argmax())
            out.append((self.languages[best], float(weights[best] / weights.sum())))
        return out


def scorer_of(model: Model) -> Scorer:
    """The scorer of a model in this worker: made once, and kept with what it has learned for later tasks."""
    if not hasattr(model, "scorer"):
        model.scorer = Scorer(model)
    return model.scorer


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every column of ``docs`` and ``lang_pred, score``.

    ``score`` is the posterior probability of the predicted language under equal priors; texts without letters (and null) are
    ``und`` with score 0. Ties go to the language that sorts first. Each row is judged by its whole text alone, so
    repeated rows agree. Columns of ``docs`` named like the new ones are replaced.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    place = kept.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(sent.value)
        for batch in batches:
            for part in slices(batch, place):
                found = scorer.predict(part.column(place).to_pylist())
                new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*kept, "lang_pred", "score"])

    rows = docs.select(*kept)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "lang_pred string, score double"])
    return rows.mapInArrow(run, schema)
