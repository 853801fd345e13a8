import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from .tables import SMALL
from folioscan.llm.token_counts import TokenCounter, count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


COUNTER = TokenCounter(PATH)
PARTS = ["<|startoftext|>", "<|endoftext|>", "<|", "'s", "'ll", "Σ", "ß", "é", "İ", "\xa0", "\x1c", "中文", "\U0001f600"]


@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from(PARTS), st.text(alphabet="ab ", max_size=9)), max_size=12))
@settings(max_examples=300, deadline=None)
def test_random_texts(library, parts):
    text = "".join(parts)
    assert COUNTER.count([text]) == lengths(library, [text])


def test_every_code_point(library):
    """Alone, after and before letters, digits and other characters; surrogates are no text."""
    for low in range(0, 0x110000, 0x8000):
        chars = [chr(i) for i in range(low, low + 0x8000) if not 0xD800 <= i < 0xE000]
        texts = [f"a{c}!{c}1{c}{c}b {c} {c}a{c}" for c in chars]
        assert COUNTER.count(texts) == lengths(library, texts), hex(low)


def test_documents(spark, library):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in count_tokens(rows, PATH, ["doc_id"]).collect()}
    texts = {r.doc_id: r.text for r in rows.collect()}
    for (i, text), n in zip(texts.items(), lengths(library, texts.values())):
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(text.encode()), n > 2048)


def test_awkward_rows(awkward, nothing, library):
    want = [r.text for r in awkward.collect()]
    got = sorted(r.n_tokens for r in count_tokens(awkward, PATH, ["doc_id"]).collect())
    assert got == sorted(lengths(library, want))
    assert count_tokens(nothing, PATH, ["doc_id"]).count() == 0


def test_a_text_without_blanks_and_one_of_many_pieces(library):
    texts = ["a" * 50_000, "ab" * 30_000 + "é" * 5_000, "word " * 150_000, "é\n" * 120_000]
    assert COUNTER.count(texts) == lengths(library, texts)
