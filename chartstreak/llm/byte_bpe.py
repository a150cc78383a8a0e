"""Byte-level BPE encoding and decoding by longest matches and pair compatibility.

A word (one match of the split pattern) is mapped byte by byte to Latin-1, so
an Aho-Corasick automaton over the vocabulary finds all tokens in it in one
pass. Encoding walks from the longest match at each position: a token may
follow another only if merging the two in rank order would not have joined
bytes across their border (``compatible``, memoised by pair). If no token of
any length fits, the walk steps back. Each position is visited once, and the
only sequence whose neighbours are all compatible is the one that merging in
rank order gives.

Words are encoded once per worker: two generations of at most ``WORDS_KEPT``
words are remembered, so memory is bounded and frequent words stay.

Defined results: null text counts as empty and has no tokens; repeated rows are
encoded each; an empty table gives an empty result; other columns are not read.
The vocabulary file's path is a parameter.
"""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.llm.common import Generations, quoted, table, text_of
from chartstreak.session import workers_import_package

WORDS_KEPT = 150_000
LONGEST_KEPT = 64
BORDER = "Ā"  # not a Latin-1 character, so in no token

# The split pattern's classes for texts within Latin-1 (letters, numbers, white space by Unicode).
L1_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
L1_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
L1_SPACE = "\t-\r \x85\xa0"
BEYOND_LATIN1 = re.compile("[^\x00-\xff]")

_codecs: dict = {}


def latin1_pattern(pattern: str) -> re.Pattern:
    """``pattern`` (as the regex library takes it) for texts within Latin-1, compiled by ``re``."""
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{L1_SPACE}{L1_LETTER}{L1_NUMBER}]")
    out = out.replace(r"\p{L}", f"[{L1_LETTER}]").replace(r"\p{N}", f"[{L1_NUMBER}]")
    return re.compile(out.replace(r"\S", f"[^{L1_SPACE}]").replace(r"\s", f"[{L1_SPACE}]"))


def unicode_pattern(pattern: str):
    """``pattern`` with white space by the Unicode property, as tokenizer libraries read it."""
    space = r"\p{White_Space}"
    out = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{space}\p{{L}}\p{{N}}]")
    return regex.compile(out.replace(r"\S", rf"[^{space}]").replace(r"\s", f"[{space}]"))


class ByteBpe:
    """Vocabulary, pair lookup and word memo of one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.size = max(ranks.values()) + 1
        self.vocabulary = [b""] * self.size
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.fast, self.full = latin1_pattern(pattern), unicode_pattern(pattern)
        self.known: dict = {}
        self.words = Generations(WORDS_KEPT)
        self._halves(ranks)

    def _halves(self, ranks: dict) -> None:
        """The two tokens whose merge makes each token, in rank order, and the merges by pair."""
        self.joined: dict = {}
        self.left, self.right = list(range(self.size)), list(range(self.size))
        shorter: dict = {}
        for rank, token in enumerate(self.vocabulary):
            if len(token) > 1:
                for cut in range(len(token) - 1, 0, -1):
                    a, b = ranks.get(token[:cut], rank), ranks.get(token[cut:], rank)
                    if a < rank and b < rank and self.compatible(a, b, rank):
                        self.left[rank], self.right[rank] = a, b
                        self.joined[a, b] = rank
                        break
        self.known.clear()
        for token, rank in ranks.items():
            shorter[rank] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), -1)
        self.shorter = shorter
        self.length = [len(t) for t in self.vocabulary]

    def compatible(self, a: int, b: int, limit: int | None = None) -> bool:
        """Whether merging in rank order (ranks below ``limit``) leaves the border between ``a`` and ``b``.

        The later of the two tokens' last merges is undone again and again; the
        border is crossed if the tokens then at it merge earlier than the merge
        just undone.
        """
        limit = self.size if limit is None else limit
        while True:
            if self.joined.get((a, b), limit) < limit:
                return False
            if a > b:
                limit, a_next = a, self.right[a]
                if a_next != a:
                    a = a_next
                    continue
                limit, b_next = b + 1, self.left[b]
                if b_next == b:
                    return True
                b = b_next
            else:
                limit, b_next = b + 1, self.left[b]
                if b_next != b:
                    b = b_next
                    continue
                limit, a_next = a, self.right[a]
                if a_next == a:
                    return True
                a = a_next

    def _walk(self, longest: list, begin: int, end: int) -> tuple:
        """Tokens of the bytes from ``begin`` to ``end``; ``longest`` has the longest match at each position."""
        length, shorter, known = self.length, self.shorter, self.known
        out: list = []
        at, token, dead = begin, longest[begin], set()
        while True:
            last = out[-1] if out else -1
            while token >= 0:
                after = at + length[token]
                if after <= end and after not in dead:
                    if last < 0:
                        break
                    fits = known.get((last, token))
                    if fits is None:
                        fits = known[last, token] = self.compatible(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = after
                if at == end:
                    return tuple(out)
                token = longest[at]
            else:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                token = shorter[token]

    def _new_words(self, words: list) -> dict:
        """Encode distinct words: one pass of the automaton over all of them, then one walk each."""
        length, out, texts = self.length, {}, [w.encode().decode("latin-1") for w in words]
        longest: list = [-1] * (sum(map(len, texts)) + len(texts))
        for end, token in self.automaton.iter(BORDER.join(texts)):
            begin = end + 1 - length[token]
            if longest[begin] < 0 or length[token] > length[longest[begin]]:
                longest[begin] = token
        at = 0
        for word, text in zip(words, texts):
            out[word] = self._walk(longest, at, at + len(text))
            at += len(text) + 1
        if len(self.known) > 4 * WORDS_KEPT:
            self.known.clear()
        return out

    def split(self, text: str) -> list:
        return (self.full if BEYOND_LATIN1.search(text) else self.fast).findall(text)

    def encode(self, text: str) -> list:
        words = self.split(text)
        parts = list(map(self.words.young.get, words))
        if None in parts:
            found = {w: self.words.get(w) for w in {w for w, p in zip(words, parts) if p is None}}
            found |= self._new_words([w for w, p in found.items() if p is None])
            for w, p in found.items():
                if len(w) <= LONGEST_KEPT:
                    self.words.keep(w, p)
            parts = [found[w] if p is None else p for w, p in zip(words, parts)]
        return list(chain.from_iterable(parts))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


def codec(path: str, pattern: str) -> ByteBpe:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = ByteBpe(path, pattern)
    return _codecs[path, pattern]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    workers_import_package(docs.sparkSession)
    return docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_of(text_col).alias("text"))


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""
    def encode(batches):
        bpe = codec(path, pattern)
        for frame in batches:
            ids = [np.array(bpe.encode(t), np.int32) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "ids": ids})
    return _texts(docs, id_col, text_col).mapInPandas(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, content binary): the bytes of the ids, the texts in UTF-8 if they came from texts."""
    workers_import_package(encoded.sparkSession)

    def decode(batches):
        bpe = codec(path, pattern)
        for frame in batches:
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"),
                                "content": [bpe.decode(ids) for ids in frame["ids"]]})
    return encoded.select("doc_id", "ids").mapInPandas(decode, "doc_id long, content binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass; number of ids and digests of ids and of decoded bytes."""
    def digest(batches):
        bpe = codec(path, pattern)
        names = [str(i) for i in range(bpe.size)]
        for frame in batches:
            out = []
            for text in frame["text"]:
                ids = bpe.encode(text)
                out.append((len(ids), hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest(),
                            hashlib.sha256(bpe.decode(ids)).hexdigest()))
            rows = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            rows.insert(0, "doc_id", frame["doc_id"].astype("Int64").to_numpy())
            yield rows
    return _texts(docs, id_col, text_col).mapInPandas(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return round_trip_digests(table(spark, sf_dir, "documents"),
                              public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
