from __future__ import annotations

import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Python workers find the library however pytest was started
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

#: Null, empty, blank, tiny, tied and repeated texts, a long one, other scripts.
ODD = [
    None,
    "",
    " \t\n",
    "one",
    "a b c d",
    "The same text twice, with some more words to fill a window of ten.",
    "The same text twice, with some more words to fill a window of ten.",
    "x" * 50_000,
    "word " * 20_000,
    "éàü 中文字符 😀   nbsp em",
    "\x00\x01 control <|endoftext|> 'll 've",
]


@pytest.fixture(scope="session")
def docs(spark):
    """Odd documents with a repeated key, a null key, and columns whose names the operators use themselves."""
    rows = [(i, t, "en", i, f"k{i}") for i, t in enumerate(ODD)]
    rows += [(3, "another text of the same key", "de", 1, "x"), (3, "one", "en", 3, "k3"), (None, "text without a key", "fr", 2, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, node long, row string").repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("false")
