"""Secrets and personal data against regular expressions of plain Python."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sieveline.llm import pii, secrets
from sieveline.llm.queries import op4_secrets, op6_personal_data
from tests.llm import brute
from tests.llm.conftest import AWKWARD


def by_text(df):
    return {r["text"]: r for r in df.collect()}


def same_secrets(row, text):
    counts, digest, base = brute.secrets(text)
    assert [row["n_assign"], row["n_access"], row["n_hex"]] == counts
    assert row["base_sha256"] == digest
    spans = [s for s in row["spans"].split(",") if s]
    assert [s for s in spans if not s.startswith("entropy")] == base


def test_secrets_of_documents(spark, sf_dir, texts):
    for row in op4_secrets(spark, sf_dir).collect():
        same_secrets(row, texts[row["doc_id"]])


def test_secrets_of_awkward_rows(awkward):
    found = secrets.scan_secrets(awkward.withColumn("spans", F.lit("clash")))
    assert found.count() == len(AWKWARD)
    for text, row in by_text(found).items():
        same_secrets(row, text)


def test_incremental_entropy_is_entropy():
    rng = random.Random(5)
    for _ in range(50):
        text = "".join(rng.choice("abcdefAB01+/") for _ in range(rng.randint(1, 90)))
        width = rng.randint(1, 30)
        found = list(secrets.entropy_peaks(text, width))
        width = min(width, len(text))
        assert [at for at, _ in found] == list(range(len(text) - width + 1))
        for at, bits in found:
            counts = Counter(text[at : at + width]).values()
            assert bits == pytest.approx(-sum(c / width * math.log2(c / width) for c in counts))


def test_entropy_spans_and_allow_list():
    key = "wJalrXUtnFEMIK7MDENGbPxRfiCYz9Qh2Lk"
    assert secrets.entropy_spans(f"see {key} here") == [(4, 4 + len(key))]
    for quiet in (
        "123e4567-e89b-12d3-a456-426614174000",
        "internationalisation-and-localisation",
        "2024-01-01-2024-12-31-00000",
        "abcdefghijklmnopqrstuvwxyz0123456789",
        "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1",
        "EXAMPLEwJalrXUtnFEMIK7MDENGbPxRfiCYz",
    ):
        assert secrets.entropy_spans(quiet) == []


def test_allowed_parts_suppress_the_windows_they_are_in():
    value = "9fK2xQ7vLmZ4tR8wYb3N"
    for before in ("my_cred=", "sample_cred=", "/srv/example/", "dummy-dummy/changeme="):
        text = f"see {before}{value}, and more"
        start = text.index(value)
        ((first, last),) = secrets.entropy_spans(text)
        assert last == start + len(value) and first <= start
        assert not secrets.ALLOWED_PARTS.search(text[first:last])
    assert secrets.entropy_spans(f"{value}/example/{value}") == [(0, 21), (28, 49)]
    assert secrets.entropy_spans(("example/" * 20_000)[:-1]) == []


def brute_entropy_spans(text, width=secrets.WINDOW):
    """Windows that are random and overlap no allowed run, merged, by looking at each window anew."""
    spans = []
    for m in secrets.CANDIDATE.finditer(text):
        body = m.group()
        if secrets.ALLOWED_SHAPES.fullmatch(body):
            continue
        limit = next(c.least for c in secrets.CLASSES if c.shape.fullmatch(body))
        quiet = {k for r in secrets.RUN.finditer(body) if secrets.ALLOWED_PARTS.search(r.group()) for k in range(r.start(), r.end())}
        own = []
        for at in range(len(body) - width + 1):
            counts = Counter(body[at : at + width]).values()
            bits = -sum(c / width * math.log2(c / width) for c in counts)
            if bits >= limit - 1e-12 and not quiet & set(range(at, at + width)):
                if own and at <= own[-1][1]:
                    own[-1][1] = at + width
                else:
                    own.append([at, at + width])
        spans += [(m.start() + a, m.start() + b) for a, b in own]
    return spans


def test_entropy_spans_by_brute_force(texts):
    rng = random.Random(7)
    pieces = ["example", "sample", "/", "_", "-", "=", "12345678", "9fK2xQ7vLmZ4", "tR8wYb3NpQ", "deadbeef01", "aaaa", " ", "Zx9"]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    for text in [*made, *[t for t in texts.values() if t]]:
        assert secrets.entropy_spans(text) == brute_entropy_spans(text)


def same_personal(row, text):
    counts, digest, base = brute.personal(text)
    assert [row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]] == counts
    assert row["base_sha256"] == digest
    spans = [s for s in row["spans"].split(",") if s]
    assert [s for s in spans if s.split(":")[0] in ("email", "ip", "card", "phone")] == base
    assert len([s for s in row["scores"].split(",") if s]) == len(spans)


def test_personal_data_of_documents(spark, sf_dir, texts):
    for row in op6_personal_data(spark, sf_dir).collect():
        same_personal(row, texts[row["doc_id"]])


def test_personal_data_of_awkward_rows(awkward):
    keyed = awkward.withColumn("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = {hashlib.sha256((r[1] or "").encode()).hexdigest(): r[1] for r in AWKWARD}
    rows = pii.personal_data_report(keyed).collect()
    assert len(rows) == len(AWKWARD)
    for row in rows:
        same_personal(row, texts[row["doc_id"]])


def test_validators_and_context(spark):
    def found(text):
        rows = pii.find_personal_data(spark.createDataFrame([(text,)], "text string")).collect()
        names = [k.name for k in (*pii.BASE_KINDS, *pii.MORE_KINDS)]
        return [(names[s["kind"]], text[s["start"] : s["end"]], round(s["score"], 2)) for s in rows[0]["found"]]

    assert found("pay to GB82 WEST 1234 5698 7654 32.") == [("iban", "GB82 WEST 1234 5698 7654 32", 0.8)]
    assert found("bank account GB82WEST12345698765432.") == [("iban", "GB82WEST12345698765432", 1.0)]
    assert found("pay to GB83 WEST 1234 5698 7654 32.") == []
    assert found("number 123-45-6789") == []
    assert found("his social number 123-45-6789") == [("ssn", "123-45-6789", 0.5)]
    assert found("visa card 4111-1111-1111-1111")[0] == ("card", "4111-1111-1111-1111", 0.9)
    assert found("4111-1111-1111-1112") == []
    assert found("\U0001f600é a@b.co") == [("email", "a@b.co", 0.8)]


def test_account_numbers_end_before_what_follows(spark):
    dense, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    other, third = "GB29 NWBK 6016 1331 9268 19", "FR1420041010050500013M02606"
    cases = [
        (f"{number} {after}", [number])
        for number in (dense, spaced, other, third)
        for after in ("BIC COBADEFFXXX", "Bitte zahlen", "A note", "1234 56", "77", "X", "x", "\u00e9")
    ]
    cases += [
        (f"{dense} {other} {spaced} {third}", [dense, other, spaced, third]),
        (f"\U0001f600 {dense}, {third} and {dense}x", [dense, third]),
        ("DE88370400440532013000 BIC", []),
        (f"x{dense} {dense}A {dense}0123456789012", []),
        (" ".join([dense, spaced] * 400), [dense, spaced] * 400),
    ]
    rows = pii.find_personal_data(spark.createDataFrame([(t,) for t, _ in cases], "text string")).collect()
    iban = [k.name for k in (*pii.BASE_KINDS, *pii.MORE_KINDS)].index("iban")
    found = {r["text"]: [r["text"][s["start"] : s["end"]] for s in r["found"] if s["kind"] == iban] for r in rows}
    assert found == dict(cases)


def test_personal_data_is_one_projection(documents, plan_of):
    plan = plan_of(pii.find_personal_data(documents))
    assert not any(word in plan for word in ("Exchange", "Python", "Arrow", "Generate"))


def test_empty(no_docs):
    assert secrets.scan_secrets(no_docs).collect() == []
    assert pii.personal_data_report(no_docs).collect() == []
