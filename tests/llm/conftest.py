import pytest

from llm_helpers import odd_documents, write_tables


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    rows = odd_documents()
    return write_tables(spark, tmp_path_factory.mktemp("odd"), rows), rows


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("nothing"), [])


@pytest.fixture(scope="session")
def vocab():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def library(vocab):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocab)
