import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import SF, awkward, documents, nothing
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourweave.llm.encoding import Encoder
from hourweave.llm.mph import Lookup, build
from hourweave.llm.token_files import op1_token_files, write_tokens

BYTES, WORDS = (str(public_tokenizers.path(x)) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ENCODERS = {False: Encoder(BYTES, False), True: Encoder(WORDS, True)}


def library_ids(path, texts):
    from tokenizers import Tokenizer

    return [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("words", [False, True])
def test_chunked_encoding_of_corpus_texts_is_the_librarys(words):
    texts = [t or "" for _, t in documents()]
    got = [np.frombuffer(x, "<u4").tolist() for x in ENCODERS[words].encode(texts)]
    assert got == library_ids(WORDS if words else BYTES, texts)


@pytest.mark.parametrize("words", [False, True])
@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", " ", " ",
                                 "　", "​", "a", "Ab", "'s", "'LL", "12", "!?", "́", "é", "İ",
                                 "Σ", "你", "\U0001f600", "<|endoftext|>", "<|startoftext|>", "_", "\x00"]),
                max_size=14))
def test_chunked_encoding_of_odd_texts_is_the_librarys(words, parts):
    text = "".join(parts)
    got = np.frombuffer(ENCODERS[words].encode([text])[0], "<u4").tolist()
    assert got == ENCODERS[words].library.encode(text, add_special_tokens=False).ids


def test_perfect_hash_is_minimal_and_perfect():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 5000):
        h1, h2 = r.integers(0, 2**63, (2, n), dtype=np.uint64)
        assert sorted(Lookup(build(h1, h2)).slots(h1, h2).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        build(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def test_query_equals_direct_encoding(spark):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in op1_token_files(spark, SF).collect()}
    rows, at, want = documents(), 0, {}
    for (doc_id, _), ids in zip(rows, library_ids(BYTES, [t or "" for _, t in rows]), strict=True):
        ids = [*ids, 0]
        want[doc_id] = (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    assert got == want


def test_awkward_documents_and_missing_keys(spark):
    docs = awkward(spark)
    files = write_tokens(docs, BYTES)
    keys = spark.createDataFrame([(4, 1), (4, 2), (4, 3), (1, 1), (99, 1), (None, 1), (None, 2), (None, 3)],
                                 "doc_id long, copy int")
    got = {(r["doc_id"], r["copy"]): np.frombuffer(r["ids"], "<u4").tolist() for r in files.read(keys).collect()}
    assert got.keys() == {(4, 1), (4, 2), (1, 1), (None, 1), (None, 2)}
    assert got[1, 1] == [0] and got[4, 1] == got[4, 2]
    assert files.payload.agg(F.sum("n_ids")).first()[0] == sum(
        len(x) + 1 for x in library_ids(BYTES, [r["text"] or "" for r in docs.collect()]))


def test_empty_table(spark):
    files = write_tokens(nothing(spark), BYTES)
    assert files.read(spark.createDataFrame([(1, 1)], "doc_id long, copy int")).count() == 0
