"""What the character models call random: recall on random strings, silence on identifiers, blocks without seams."""

import random
import string

import pyarrow as pa
import pytest

from tidemark.llm import queries, secrets
from tidemark.llm.texts import BLOCK

NAMES = (
    "get set user account balance history list create update delete remove find index buffer stream reader writer parser session manager "
    "handler factory service client server request response config option value string number array object graph vertex cache queue thread "
    "worker listener callback promise exception message payload header column schema partition cluster replica commit window counter "
    "schedule pipeline executor network socket router"
).split()
STYLES = {
    "camel": lambda ws: "".join(w.capitalize() for w in ws), "lower camel": lambda ws: ws[0] + "".join(w.capitalize() for w in ws[1:]),
    "constant": lambda ws: "_".join(ws).upper(), "snake": "_".join, "kebab": "-".join, "path": "/".join,
    "numbered": lambda ws: "_".join(ws) + "42",
}
RANDOM = {
    "base64": string.ascii_letters + string.digits + "+/", "alphanumeric": string.ascii_letters + string.digits,
    "lower": string.ascii_lowercase + string.digits, "upper": string.ascii_uppercase + string.digits,
}


@pytest.fixture(scope="module")
def model(spark):
    queries.reachable(spark)
    return secrets.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def called(text, model):
    return any(kind == "markov" for _, kind, _ in secrets.all_spans(text, model))


@pytest.mark.parametrize("style", STYLES)
def test_identifiers_are_ordinary(model, style):
    rng = random.Random(style)
    strings = [s for s in (STYLES[style](rng.choices(NAMES, k=5)) for _ in range(1500)) if len(s) >= secrets.RUN]
    assert len(strings) > 1000
    assert sum(called(s, model) for s in strings) < 0.02 * len(strings)


@pytest.mark.parametrize("kind", RANDOM)
@pytest.mark.parametrize("length", [20, 32])
def test_random_strings_are_found(model, kind, length):
    rng = random.Random(kind)
    strings = ["".join(rng.choices(RANDOM[kind], k=length)) for _ in range(1500)]
    assert sum(called(f"see {s}.", model) or bool(secrets.base_spans(s)) for s in strings) > 0.98 * len(strings)


def test_a_model_without_any_sample(spark):
    empty = secrets.fit(spark.createDataFrame([], "doc_id long, text string"))
    assert not called("getUserAccountBalanceHistory", empty) and not called("Zq9xLk2vTb7RwY4sHn8P", empty)


@pytest.mark.parametrize("shift", [-40, -20, -1, 0, 1, 20])
def test_a_secret_at_the_end_of_a_block(spark, model, shift):
    secret = "Zq9xLk2vTb7RwY4sHn8PfJ3mD6gC"
    text = ("word " * (BLOCK // 5 + 20))[: BLOCK + shift - 1] + " " + secret + " and " + "0f" * 15 + " more" * (BLOCK // 5)
    assert secrets._suspects(pa.array([text, "none", text[:BLOCK - 60]])).tolist() == [True, False, False]
    docs = spark.createDataFrame([(1, text), (2, "x" * (2 * BLOCK))], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.scan_secrets(docs, model).collect()}
    at = BLOCK + shift
    assert got == {1: f"markov:{at}:{at + len(secret)},hex:{at + len(secret) + 5}:{at + len(secret) + 35}", 2: ""}
