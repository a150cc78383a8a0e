"""Cross-tokenizer alignment against whole-text encoding and pairwise overlaps."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chartstreak.llm import token_alignment as ta

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"
CHARS = "ab  \n\t\r.,'!1é ﬁ　\xa0\x85\x1c\x00▁漢字\U0001F600​ "


@pytest.fixture(scope="module")
def tokens():
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    char = ta.byte_of_char()

    def both(text):
        """((id, bytes) of A, of B) or None."""
        first = [(i, bytes(char[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        second = [(i, bytes([i - 3]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                  for i in b.encode(text)]
        spelt = (" " + text).encode()
        ok = text and b"".join(x for _, x in first) == spelt == b"".join(x for _, x in second)
        return (first, second) if ok else None
    return both


def ranges(tokens):
    out, at = [], 0
    for i, x in tokens:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def expected(docs, both):
    per_doc, count = [], Counter()
    for doc, text in docs:
        found = both(text or "")
        if not found:
            per_doc.append((doc, None))
            continue
        a, b = map(ranges, found)
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = ";".join(",".join(str(i) for i, _, e in a if s < e <= t) + "|" + ",".join(
            str(j) for j, _, e in b if s < e <= t) for s, t in zip([0, *ends], ends))
        per_doc.append((doc, (len(a), len(b), len(ends), links, groups)))
        count.update(set(links))
    highest = {}
    for (i, _), n in count.items():
        highest[i] = max(n, highest.get(i, 0))
    out = []
    for doc, found in per_doc:
        if not found:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, groups = found
        out.append((doc, n_a, n_b, n_groups, len(links), sum(count[x] == highest[x[0]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(groups.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(spark, docs, schema=SCHEMA, **how):
    out = ta.align_documents(spark.createDataFrame(docs, schema), A_PATH, B_PATH, **how)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def documents():
    rng = random.Random(12)
    words = ["the", "alignment", "tokenizer", "naïve", "don't", "U.S.", "3.14", "漢字", "wh", "thndsh", "(x)"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25))) + rng.choice([".", "", "\n", " \n "])) for i in range(60)]
    docs += [(100 + i, "".join(rng.choices(CHARS, k=rng.randint(1, 30)))) for i in range(150)]
    docs += [(300, None), (301, ""), (302, "<|endoftext|> <s> </s> <0x41>"), (None, "a null id"), (303, "x" * 3000),
             (304, " leading"), (305, "\n"), (306, "▁ is no space")]
    docs += [(400 + i, "one text that a third of all documents hold") for i in range(100)] + [(400, docs[0][1])] * 2
    return docs


def test_equals_brute_force(spark, tokens):
    docs = documents()
    want = expected(docs, tokens)
    assert result(spark, docs) == want
    # counts beyond the broadcast bound are joined by a shuffle
    assert result(spark, docs, broadcast_max_rows=0) == want


def test_empty_and_extra_columns(spark, tokens):
    assert result(spark, []) == []
    docs = [(1, "same", "x", 2, 3), (2, "same", "y", 3, 4), (3, None, None, None, None)]
    got = result(spark, docs, SCHEMA + ", digest string, number int, pair long")
    assert got == expected([d[:2] for d in docs], tokens)


def test_blocks_equal_whole_texts():
    both = ta.aligner(A_PATH, B_PATH)
    assert both.blockwise
    rng = random.Random(5)
    texts = ["".join(rng.choices(CHARS, k=rng.randint(0, 60))) for _ in range(1500)]
    for text, got in zip(texts, both.align(texts)):
        want = both.whole(text) if text else None
        assert (got is None) == (want is None)
        if got:
            assert got[:5] == want[:5]
            assert (np.repeat(got[5], got[6]) == np.sort(np.frombuffer(want[5], np.int64))).all()


def test_vocabularies_that_do_not_split_are_encoded_whole(spark, tokens, monkeypatch):
    whole = ta.Aligner(A_PATH, B_PATH)
    whole.blockwise = False
    texts = [t or "" for _, t in documents()[:90]]
    for text, got in zip(texts, whole.align(texts)):
        found = tokens(text)
        assert (got is None) == (found is None)
        if got:
            assert got[:2] == tuple(map(len, found))


def test_groups_are_returned(spark):
    docs = spark.createDataFrame([(1, "hello world"), (2, "hello world")], SCHEMA)
    row = ta.align_texts(docs, A_PATH, B_PATH, keep_groups=True).first()
    assert row.times == 2 and row.n_bytes == 11
    assert row.n_groups == row.groups.count(";") + 1
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert sum(row.links) == row.n_links
