from __future__ import annotations

import json
import os
import uuid

import pytest

from tidemark.session import build_session, run_dir


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests", "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark, request):
    return run_dir(spark, f"test-{request.node.originalname}")


@pytest.fixture
def plan():
    def text(df, mode="simple"):
        return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)

    return text


class Inbox:
    """A folder of JSON files; each `put` is one file, later files are read later."""

    def __init__(self, path):
        self.path, self.files = path, 0
        os.makedirs(path)

    def put(self, *rows):
        name = f"{self.path}/{uuid.uuid4().hex}.json"
        with open(name, "w") as out:
            out.writelines(json.dumps(row) + "\n" for row in rows)
        self.files += 1
        os.utime(name, (1_700_000_000 + self.files, 1_700_000_000 + self.files))


@pytest.fixture
def inbox(folder):
    return Inbox(f"{folder}/inbox")
