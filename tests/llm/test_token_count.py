import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventflow.llm.token_count import TokenCounter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tools():
    return TokenCounter(PATH, public_tokenizers.PATTERN), Tokenizer.from_file(PATH)


ODD = ["", " ", "a" * 3000, "aaaaaaaaa " * 50, "<|endoftext|>", "x <|endoftext|><|endoftext|> y", "\n\n \t\r\n a",
       "y'll've  don't", "żółć 漢字 😀😀 ½ ٣٤", "\x1c\x85 　 a", "é", "'s's 's"]


def test_equals_the_library(tools):
    counter, library = tools
    assert list(counter.count(ODD)) == [len(library.encode(t, add_special_tokens=False)) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=["Cs"]), max_size=60), max_size=5))
def test_equals_the_library_on_any_text(tools, texts):
    counter, library = tools
    assert list(counter.count(texts)) == [len(library.encode(t, add_special_tokens=False)) for t in texts]


def test_forgetting_changes_nothing(tools):
    small = TokenCounter(PATH, public_tokenizers.PATTERN, remember=3)
    for _ in range(3):
        assert list(small.count(ODD)) == list(tools[0].count(ODD))


def test_rows(spark, tools):
    rows = [(1, None, "x"), (2, "", None), (2, "", None), (None, "hello there", "x"), (5, "word " * 60_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, token_counts(docs, PATH, public_tokenizers.PATTERN).collect()), key=str)
    library = tools[1]
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False)), n > 512) for i, t, _ in rows]
    assert got == sorted(want, key=str)
    assert token_counts(docs.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
