"""Personal data: patterns propose spans, validators confirm them, nearby context words adjust the score.

Everything is a column expression. Where a pattern matches follows from splitting the text at it: the pieces
between matches and the matches themselves, in turn, add up to code point offsets.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.texts import bind, spans_digest, text_of


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """The Luhn checksum of the digits holds: every second digit from the right doubled, less 9 above 9."""
    digits = F.transform(F.split(F.reverse(only_digits(value)), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod_97(value: Column) -> Column:
    """The check of international account numbers: first four characters last, letters as 10 to 35, rest 1 modulo 97."""
    compact = F.translate(value, " ", "")
    turned = F.concat(F.substring(compact, 5, 1 << 20), F.substring(compact, 1, 4))
    places = F.transform(
        F.split(turned, ""), lambda c: F.when(F.length(c) == 0, F.lit(None)).when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    )
    rest = F.aggregate(
        F.filter(places, lambda n: n.isNotNull()), F.lit(0), lambda a, n: F.when(n > 9, (a * 100 + n) % 97).otherwise((a * 10 + n) % 97)
    )
    return rest == 1


#: Lengths of account numbers by country, after the ISO 13616 registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def account_number(head: Column, tail: Column) -> Column:
    """The account number that ``head`` and a first part of ``tail`` make, or null.

    It can end at any blank, or where the tail does, if the check holds. The end that gives the length usual in its country
    goes before others, a later one before an earlier one.
    """
    size = lambda v: F.length(F.translate(v, " ", ""))
    usual = F.coalesce(*[F.when(head.rlike(f"^({names.replace(' ', '|')})"), F.lit(n)) for n, names in IBAN_LENGTHS.items()])

    def ends(words: Column) -> Column:
        first_parts = F.transform(words, lambda _, i: F.array_join(F.slice(words, F.lit(1), F.size(words) - i), " "))
        return F.filter(first_parts, lambda v: size(v).between(15, 34) & v.rlike("^[A-Z0-9 ]+$") & mod_97(v))

    def best(found: Column) -> Column:
        return F.coalesce(F.get(F.filter(found, lambda v: size(v) == usual), F.lit(0)), F.get(found, F.lit(0)))

    return bind(bind(F.split(F.concat(head, tail), " "), ends), best)


def small_parts(value: Column) -> Column:
    """Every dot-separated number is at most 255; leading zeros do not matter."""
    numbers = F.transform(F.split(value, "\\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(numbers, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))


def digits_between(least: int, most: int) -> Callable[[Column], Column]:
    return lambda value: F.length(only_digits(value)).between(least, most)


@dataclass(frozen=True)
class Kind:
    """A pattern with its validator, the score of a confirmed match and the words that raise it.

    ``needle`` is a character class that every match contains: a text without it is not searched. Repetition is
    possessive and matches start at run starts, so the search takes time in proportion to the text and no
    stack; on the base patterns neither changes what matches. Where a match ends can be left to ``whole``: the pattern then
    matches its head, with what may follow as a group in a lookahead, and ``whole`` makes the match of both, or null.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: tuple[str, ...]
    needle: str
    #: A match below this score is not reported; base kinds are reported whatever the context.
    least: float = 0.0
    whole: Callable[[Column, Column], Column] | None = None


LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE_KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
        lambda v: F.lit(True),
        0.8,
        ("mail", "contact", "write", "schreib", "correo", "courriel"),
        "@",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", small_parts, 0.6, ("ip", "host", "server", "address", "adresse"), "[0-9]\\.[0-9]"),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda v: F.when(F.length(only_digits(v)).between(13, 19), luhn(v)).otherwise(F.lit(False)),
        0.7,
        ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment"),
        "[0-9][\\x20-]?[0-9]",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", digits_between(9, 15), 0.6, ("phone", "call", "tel", "mobile", "fax"), "\\+[0-9]"),
)
MORE_KINDS = (
    Kind(
        "iban",
        # one more letter or digit after the longest run shows that no number ends there
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]?))",
        mod_97,
        0.8,
        ("iban", "account", "bank", "konto", "compte", "cuenta"),
        "[A-Z]{2}[0-9]{2}",
        whole=account_number,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda v: ~v.rlike("^(000|666|9)|-00-|-0000$"),
        0.3,
        ("ssn", "social", "security"),
        "[0-9]-[0-9]",
        0.5,
    ),
)
#: Characters before a match in which context words are looked for, and what a word adds to the score.
REACH, RAISE = 60, 0.2
#: Matches whose offsets are added up together.
BLOCK = 256

SPAN = "array<struct<kind: int, start: long, end: long, score: double>>"


def spans_of(text: Column, kind: Kind, number: int) -> Column:
    """The confirmed matches of one kind, in order, with offsets in code points."""

    def running(steps: Column, at: Column, width: Callable[[Column], Column], made: Callable[[Column, Column], Column], kind: str) -> Column:
        """``made(position, step)`` of each step, the position being ``at`` and the widths of the steps before."""
        zero = F.struct(at.alias("at"), F.array().cast(f"array<{kind}>").alias("found"))
        return F.aggregate(
            steps,
            zero,
            lambda a, s: F.struct((a["at"] + width(s)).alias("at"), F.concat(a["found"], F.array(made(a["at"], s))).alias("found")),
            lambda a: a["found"],
        )

    def starts(steps: Column) -> Column:
        # in blocks, since every step copies what its aggregate has found so far
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")), lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)))
        whole = lambda s: s["gap"] + s["size"]
        based = running(
            blocks,
            F.lit(0).cast("long"),
            lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda n, s: n + whole(s)),
            lambda at, b: F.struct(at.alias("at"), b.alias("block")),
            "struct<at: long, block: array<struct<gap: long, size: long, hit: string>>>",
        )
        one = lambda at, s: F.struct((at + s["gap"]).alias("start"), s["hit"].alias("hit"))
        return F.flatten(F.transform(based, lambda b: running(b["block"], b["at"], whole, one, "struct<start: long, hit: string>")))

    def apart(found: Column) -> Column:
        """Without those that begin before the end of one kept."""
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")), lambda b: F.slice(found, b * BLOCK + 1, F.lit(BLOCK)))
        state = lambda end, kept, kind: F.struct(end.alias("end"), kept.cast(kind).alias("kept"))
        one, many = "array<struct<start: long, hit: string>>", "array<array<struct<start: long, hit: string>>>"

        def add(a: Column, s: Column) -> Column:
            taken = state(s["start"] + F.length(s["hit"]), F.concat(a["kept"], F.array(s)), one)
            return F.when(s["start"] >= a["end"], taken).otherwise(a)

        def add_block(a: Column, b: Column) -> Column:
            return bind(F.aggregate(b, state(a["end"], F.array(), one), add), lambda r: state(r["end"], F.concat(a["kept"], F.array(r["kept"])), many))

        return F.flatten(F.aggregate(blocks, state(F.lit(0).cast("long"), F.array(), many), add_block, lambda a: a["kept"]))

    def placed(pair: Column) -> Column:
        gaps, hits = pair["gaps"], pair["hits"]
        steps = F.transform(
            hits, lambda h, i: F.struct(F.length(F.get(gaps, i)).cast("long").alias("gap"), F.length(h).cast("long").alias("size"), (kind.whole(h, F.get(pair["tails"], i)) if kind.whole else h).alias("hit"))
        )
        return F.when(F.size(hits) > 0, bind(steps, starts)).otherwise(F.array().cast("array<struct<start: long, hit: string>>"))

    def scored(s: Column) -> Column:
        ahead = F.lower(F.substring(text, F.greatest(s["start"] - REACH, F.lit(0)).cast("int") + 1, F.least(s["start"], F.lit(REACH)).cast("int")))
        near = ahead.rlike(rf"(?<![\p{{L}}])(?:{'|'.join(kind.context)})")
        score = F.when(near, F.lit(min(1.0, kind.score + RAISE))).otherwise(F.lit(kind.score))
        return F.struct(
            F.lit(number).alias("kind"), s["start"].alias("start"), (s["start"] + F.length(s["hit"])).alias("end"), score.alias("score")
        )

    parts = [F.split(text, kind.pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hits")]
    if kind.whole:
        parts.append(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1)).alias("tails"))
    valid = F.filter(bind(F.struct(*parts), placed), lambda s: kind.valid(s["hit"]))
    if kind.whole:
        valid = bind(valid, lambda v: F.when(F.size(v) > 1, bind(v, apart)).otherwise(v))
    spans = F.transform(valid, scored)
    if kind.least > 0:
        spans = F.filter(spans, lambda s: s["score"] >= kind.least)
    return F.when(text.rlike(kind.needle), spans).otherwise(F.array().cast(SPAN))


def find_personal_data(
    docs: DataFrame, text: str = "text", base: tuple[Kind, ...] = BASE_KINDS, more: tuple[Kind, ...] = MORE_KINDS
) -> DataFrame:
    """Every column of ``docs`` and ``found``: an array of (kind, start, end, score) by kind, then start.

    ``kind`` counts from 0 through ``base``, then ``more``; offsets are code points, ends exclusive. Base kinds
    are reported whatever their score, the others from their ``least`` on. A null text counts as empty and repeated
    rows give repeated results. A column of ``docs`` named ``found`` is replaced. One projection: no shuffle.
    """
    kinds = [*base, *more]
    body = text_of(text)
    return docs.withColumn("found", F.concat(*[spans_of(body, kind, k) for k, kind in enumerate(kinds)]))


def span_texts(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` per span."""
    labels = F.array(*[F.lit(n) for n in names])
    return F.transform(spans, lambda s: F.concat_ws(":", F.element_at(labels, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))


def personal_data_report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per base kind, the digest of the base spans, all spans and their scores as text, per document."""
    names = [k.name for k in (*BASE_KINDS, *MORE_KINDS)]
    found = find_personal_data(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")))
    spans = F.col("found")

    def number(k: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")

    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{kind.name}") for k, kind in enumerate(BASE_KINDS)],
        spans_digest(span_texts(F.filter(spans, lambda s: s["kind"] < len(BASE_KINDS)), names)).alias("base_sha256"),
        F.array_join(span_texts(spans, names), ",").alias("spans"),
        F.array_join(F.transform(spans, lambda s: F.round(s["score"], 2).cast("string")), ",").alias("scores"),
    )
