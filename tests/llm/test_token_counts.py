import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rillstone.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    return T.Counter(PATH), Tokenizer.from_file(PATH)


def test_equals_library_on_documents(spark, sf_dir, both):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in T.token_counts(docs, PATH).collect()}
    for r in docs.select("doc_id", "text").collect():
        n = len(both[1].encode(r.text, add_special_tokens=False).ids)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_bytes, got[r.doc_id].over_limit) == (n, len(r.text.encode()), n > 1024)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_equals_library_on_any_text(both, text):
    assert both[0].count(text) == len(both[1].encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "aaaa" * 500, "  \n\n \t x  ", "don't we'll I'M", "1234567890" * 30])
def test_special_and_long_pieces(both, text):
    assert both[0].count(text) == len(both[1].encode(text, add_special_tokens=False).ids)


def test_memory_of_pieces_is_bounded(both, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 10)
    monkeypatch.setattr(T, "LONG_TEXT", 50)
    text = " ".join(f"tok{i}" for i in range(200))
    counter = T.Counter(PATH)
    assert counter.count(text) == len(both[1].encode(text, add_special_tokens=False).ids)
    assert len(counter) <= 10
