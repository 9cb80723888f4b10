import hashlib
import random
import re

import pytest

from corpusloom.llm import secrets
from corpusloom.llm.queries import op2_secret_spans

NAMES = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
PLAIN = [
    ("assign", re.compile(rf"({NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m.group(2)) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m.group()) >= 24),
]


def brute(text):
    spans = [(m.start(), i, m.end()) for i, (_, p, ok) in enumerate(PLAIN) for m in p.finditer(text or "") if ok(m)]
    return [(PLAIN[i][0], a, b) for a, i, b in sorted(spans)]


@pytest.fixture(scope="module")
def scanner():
    return secrets.Scanner(secrets.BASE_RULES + secrets.MORE_RULES)


def test_base_spans_are_those_of_the_expressions(scanner, documents):
    parts = ["token", "secret", "password", "api_key", "apikey", "=", ":", " ", "'", '"', "abc", "AKIA", "AKIAAAAA",
             "0123456789abcdef", "deadbeef", "xyz12345", "é", "passwd", "ToKeN", "ghp_", "eyJ", "."]
    random.seed(5)
    made = ["".join(random.choice(parts) for _ in range(random.randint(1, 25))) for _ in range(4000)]
    for text in [*made, *(t for _, t in documents)]:
        assert [s for s in scanner.spans_of_text(text) if s[0] in ("assign", "access", "hex")] == brute(text), repr(text)


@pytest.mark.parametrize(
    ("kind", "text"),
    [
        ("github", "ghp_" + "a1B2" * 9),
        ("slack", "xoxb-" + "12345-" * 4 + "abc"),
        ("google", "AIza" + "x_-A1" * 7),
        ("jwt", "eyJhbGciOiJI.eyJzdWIiOiIxMjM0NTY3.SflKxwRJSMeKKF2QT4"),
        ("pem", "-----BEGIN RSA PRIVATE KEY-----"),
    ],
)
def test_more_kinds(scanner, kind, text):
    assert (kind, 3, 3 + len(text)) in scanner.spans_of_text(f"é: {text} .")


def test_automaton_is_minimal_and_one(scanner):
    table = secrets.combine(scanner.forward)
    assert (secrets._minimal(table[:, :256], table[:, 256]).shape[0]) == len(table)


def test_unsupported_rule():
    with pytest.raises(ValueError, match="not supported"):
        secrets.compile_rule(r"a\b")


def test_query_and_edge_cases(spark, small_dir, documents, tmp_path):
    by_id = {r["doc_id"]: r for r in op2_secret_spans(spark, small_dir).collect()}
    for key, text in documents:
        spans = brute(text)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        row = by_id[key]
        assert row["base_sha256"] == digest
        assert row["n_hex"] == sum(k == "hex" for k, _, _ in spans)
    long = "x" * 300_000 + " token=abcdefgh"
    rows = [(1, None, "a"), (None, "", "b"), (2, long, "c"), (2, long, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = secrets.find_secrets(df).collect()
    assert sorted(len(r["spans"]) for r in found) == [0, 0, 1, 1]
    assert secrets.find_secrets(df.limit(0)).count() == 0
