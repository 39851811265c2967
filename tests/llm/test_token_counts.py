from collections import Counter

import public_tokenizers
import pytest
from helpers import SF, awkward, documents, nothing
from hypothesis import given, settings
from hypothesis import strategies as st

from hourweave.llm.token_counts import PreTokens, op5_token_counts, token_counts

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(library, rows):
    return Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in rows)


def result(frame):
    return Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in frame.collect())


def test_query_equals_the_library(spark, library):
    got = op5_token_counts(spark, SF)
    assert result(got) == expected(library, documents())
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got.collect())


def test_awkward_documents_in_blocks_of_any_size(spark, library):
    docs = awkward(spark)
    want = expected(library, [(r["doc_id"], r["text"]) for r in docs.collect()])
    for block in (1, 500, 1 << 20):
        assert result(token_counts(docs, PATH, block)) == want
    assert token_counts(nothing(spark), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", " ", " ", "　",
                                 "​", "a", "Ab", "'s", "'LL", "12", "!?", "́", "é", "İ", "²",
                                 "你", "\U0001f600", "<|endoftext|>", "_", "\x00"]), max_size=14))
def test_pieces_of_pre_tokens_sum_to_the_whole(parts):
    from tokenizers import Tokenizer

    text, library = "".join(parts), test_pieces_of_pre_tokens_sum_to_the_whole.__dict__.setdefault("t", Tokenizer.from_file(PATH))
    own = PreTokens(PATH).cut(text)
    assert "".join(own) == text
    assert sum(len(library.encode(x, add_special_tokens=False)) for x in own) == len(library.encode(text, add_special_tokens=False))
