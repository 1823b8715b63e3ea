"""Columns of the caller that are called like something inside the operators stay as they are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, queries, secrets, shards, tokencount, urlfilter

NAMES = ("key", "_key", "_id", "id_key", "_at", "at", "judged", "_judged", "_found", "range", "base", "bit", "margin", "tie", "cell")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, f"some text of number {k} token = 'abcdef12345'", "en") for k in range(20)] + [(None, None, None)]
    named = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return named.select("*", *(F.lit(f"mine {n}").alias(n) for n in NAMES))


def kept(found, rows):
    got = found.select(*NAMES).distinct().collect()
    assert found.count() == rows and [tuple(r) for r in got] == [tuple(f"mine {n}" for n in NAMES)]


def test_shards(docs):
    kept(shards.shard_documents(docs, 3), 21)


def test_urls(docs):
    kept(urlfilter.judge_urls(docs.withColumn("url", F.lit("http://a.com/b")), queries.URL_RULES), 21)


def test_tokens(docs):
    kept(tokencount.token_counts(docs, queries.public_tokenizers.path(queries.TOKENIZER)), 21)


def test_languages(docs):
    kept(langid.predict(docs.drop("_judged").withColumn("_judged", F.lit("mine _judged")), langid.fit(docs)), 21)


def test_secrets(docs):
    kept(secrets.scan_secrets(docs, secrets.fit(docs)), 21)
