import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from chartstreak.llm import byte_bpe as op

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")]
PARTS = ["a", "The", " ", "  ", "\n", "\t", "'s", "'RE", "012", "½²ªµ", "\x85", "\xa0", "\x1c", "日本", "🙂", "́", "İ",
         "\x00", "\x7f", "-_/", "ingthere", "<|endoftext|>", "éèü", " ß"]


def reference(path):
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=PATHS, ids=["50k", "multi"])
def pair(request):
    return op.ByteBpe(request.param, public_tokenizers.PATTERN), reference(request.param)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=5)), max_size=15))
def test_equals_the_library(pair, parts):
    bpe, library = pair
    text = "".join(parts)
    ids = bpe.encode(text)
    assert ids == library.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 4000, " " * 3000 + "x", "ab" * 3000, "\n" * 700, "é" * 2000, "日本" * 900])
def test_long_words(pair, text):
    bpe, library = pair
    assert bpe.encode(text) == library.encode_ordinary(text)


def test_query_columns_and_round_trip(spark):
    library = reference(PATHS[0])
    texts = ["", None, "One two  three.\n", "ünï 日本 🙂", "x" * 20_000, "One two  three.\n"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens", "2 as ids")
    out = op.round_trip_digests(df, PATHS[0], public_tokenizers.PATTERN).collect()
    got = {r.doc_id: tuple(r)[1:] for r in out}
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256((t or "").encode()).hexdigest())
    encoded = op.encode_documents(df, PATHS[0], public_tokenizers.PATTERN)
    back = op.decode_documents(encoded, PATHS[0], public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), bytes(r.content).decode()) for r in back) == sorted((str(i), t or "") for i, t in rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.round_trip_digests(df, PATHS[0], public_tokenizers.PATTERN).collect() == []
