import public_tokenizers
import pytest

from segmart.llm.bpe import Ranks
from segmart.llm.tokens import Vocabulary

SCHEMA = "doc_id bigint, text string, key string, length int, kept boolean, sequence_id string"


@pytest.fixture(scope="session")
def vocabulary():
    path = public_tokenizers.path("byte_bpe_50k.json")
    return Vocabulary.read(path, public_tokenizers.PATTERN)


@pytest.fixture(scope="session")
def ranks():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return Ranks.read(path, public_tokenizers.PATTERN)


@pytest.fixture
def docs(spark):
    """Documents from pairs of id and text, with further columns under clashing names."""
    def build(*pairs):
        rows = [(i, text, "k", 1, False, "s") for i, text in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture
def odd_docs(docs):
    """Nulls, empty and long texts, ties, repeated rows and white space of all kinds."""
    long = " ".join(f"Word{i % 977}" for i in range(6000)) + "."
    return docs(
        (1, None), (2, ""), (3, " \t\n\x0b"), (4, "one"), (5, "two  words"), (6, "two words"),
        (7, long), (8, long), (9, long.lower()), (9, "another text under the same id, in nine words"),
        (10, "repeated row"), (10, "repeated row"), (None, "no id at all"), (None, None),
        (11, "Ünïcode \U0001f642 <|endoftext|> \r\n\n  x"),
    )
