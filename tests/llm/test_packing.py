import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chartstreak.llm import packing as op

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)
PARTS = ["a", "The", "éÉ", " ", "\n", "\t", ".", "'s", "'RE", "01", "½²", "\x85", "\xa0", "\x1c", "日本", "🙂", "́",
         "İ", "Σς", "\x00", "\xad", "<|endoftext|>", "<|startoftext|>", "ﬁ", "Å", "ing", "×", "don't", "__"]


@pytest.fixture(scope="module")
def encoder():
    return op.WordEncoder(VOCABULARY)


def ids_of(text):
    return np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=15))
def test_encoder_equals_the_tokenizer(encoder, parts):
    assert encoder.encode("".join(parts)) == ids_of("".join(parts))


def test_memo_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(encoder.words, "most", 50)
    for i in range(500):
        assert encoder.encode(f"日{i} the") == ids_of(f"日{i} the")
    assert len(encoder.words.young) <= 50 and len(encoder.words.old) <= 50
    monkeypatch.setattr(encoder.parts, "most", 50)
    encoder.parts.clear()
    for i in range(500):
        assert encoder.encode(f"{chr(97 + i % 26) * (1 + i // 26)} the") == ids_of(
            f"{chr(97 + i % 26) * (1 + i // 26)} the")
    assert len(encoder.parts) <= 50 and len(encoder.parts.old) <= 50


def test_another_vocabulary_is_used_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    other, whole = op.WordEncoder(path), Tokenizer.from_file(path)
    assert not other.known_steps
    for text in ("Hello  World.\n I'm 42", "naïve 日本"):
        assert other.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_a_length_of_many_pieces_is_numbered_in_many_windows(spark):
    pieces = spark.range(3000).selectExpr("id as doc_id", "0 as piece", "cast(if(id % 3 = 0, 7, id % 5 + 1) as long) as length")
    rows = op.pack(pieces, capacity=20, rows_per_salt=50).collect()
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows) == 3000
    bins: dict = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 20


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 4), max_size=6), st.integers(0, 20))
def test_fullest_is_fullest(counts, room):
    uses = op.fullest(counts, room)
    assert all(n <= counts[x] for x, n in uses.items())
    best = 0
    pool = [x for x, n in counts.items() for _ in range(n)]
    sums = {0}
    for x in pool:
        sums |= {s + x for s in sums if s + x <= room}
    best = max(sums)
    assert sum(x * n for x, n in uses.items()) == best


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 30), max_size=8))
def test_plan_places_every_piece_once(histogram):
    bins, ranks = Counter(), Counter()
    for length, low, high, uses, first, _ in op.fill_plan(histogram, 16):
        ranks[length] += high - low
        for r in range(low, high):
            bins[first + (r - low) // uses] += length
    assert ranks == Counter(histogram) and all(n <= 16 for n in bins.values())
    assert sorted(bins) == list(range(len(bins)))


def test_plan_is_optimal_on_a_perfect_instance():
    rng = random.Random(2)
    lengths = Counter()
    for _ in range(300):
        left = 4096
        while left:
            x = min(left, rng.randint(1, 2000))
            lengths[x] += 1
            left -= x
    plan = op.fill_plan(dict(lengths))
    assert max(b + (h - lo) // u for _, lo, h, u, b, _ in plan) <= 303


def test_documents_are_packed(spark):
    rng = random.Random(3)
    words = ["alpha", "béta", "gamma's", "delta,"]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 300, 900, 5000, 20_000])))) for i in range(60)]
    rows += [(60, None), (None, "null id"), (61, ""), (5, rows[5][1]), (62, "x" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as piece", "2 as `length`", "3 as salt")
    out = op.pack_documents(df).collect()
    want = Counter()
    for i, text in rows:
        ids = ids_of(text or "") + (1).to_bytes(4, "little")
        for n, at in enumerate(range(0, len(ids), 4 * 4096)):
            piece = ids[at:at + 4 * 4096]
            want[i, n, at // 4, len(piece) // 4, zlib.crc32(piece)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-sum(r.length for r in out) // 4096) + 1


def test_sequences_hold_the_ids(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "three"), (3, "")], "doc_id long, text string")
    packed = op.pack(op.token_pieces(df, VOCABULARY, keep_ids=True))
    row = op.sequences(packed).collect()
    assert len(row) == 1
    by_doc = {1: "one two", 2: "three", 3: ""}
    want = b"".join(ids_of(by_doc[p.doc_id]) + (1).to_bytes(4, "little") for p in row[0].pieces)
    assert bytes(row[0].ids) == want


def test_empty_table(spark):
    assert op.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
