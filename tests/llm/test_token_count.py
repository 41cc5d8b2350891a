import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from tessera.llm import token_count

VOCABULARY = token_count.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer(Unigram(VOCABULARY, 0, True))


COUNTER = token_count.Counter(VOCABULARY)


def want(tokenizer, text):
    return len(tokenizer.encode(token_count.MARK + text.replace(" ", token_count.MARK)).ids) if text else 0


def test_equals_the_tokenizer(docs, tokenizer):
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(docs, VOCABULARY).collect()}
    assert got == {r.doc_id: want(tokenizer, r.text) for r in docs.collect()}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abet  \n▁é🙂<0xA>s/", max_size=60) | st.text(max_size=40))
def test_any_text(text):
    tokenizer = Tokenizer(Unigram(VOCABULARY, 0, True))
    assert COUNTER.tokens(text)[0] == want(tokenizer, text)


def test_ties_and_unknowns():
    words = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aba", -3.0), ("▁", -1.0), *((f"<0x{k:02X}>", 0.0) for k in range(256))]
    own = Tokenizer(Unigram(words, 0, True))
    counter = token_count.Counter(words)
    for text in ("ab", "aba", "abab", "ba ab", "zaz", "éé ab", "\n\n", "a" * 300):
        assert counter.tokens(text)[0] == want(own, text), text


def test_dirty_rows(dirty, empty, tokenizer):
    got = sorted(((r.doc_id, r.n_tokens) for r in token_count.count_tokens(dirty, VOCABULARY).collect()), key=repr)
    assert got == sorted(((r.doc_id, want(tokenizer, r.text or "")) for r in dirty.collect()), key=repr)
    assert token_count.count_tokens(empty, VOCABULARY).count() == 0
