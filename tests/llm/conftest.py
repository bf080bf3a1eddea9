import os

import pytest
from llm_rows import document_rows, make

from signalmill.llm.common import tokenizer_path


@pytest.fixture(scope="session")
def doc_rows():
    return document_rows()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return make(spark, doc_rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make(spark, [])


@pytest.fixture(scope="session")
def bpe():
    path = tokenizer_path("byte_bpe_50k.json")
    if not os.path.exists(path):
        pytest.skip("no tokenizer files here")
    return path
