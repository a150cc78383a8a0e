"""Cross-tokenizer alignment over distinct texts.

Two tokenizers, A (byte-level) and B (pieces that begin with a space), cut the bytes of
``" " + text``. Byte offsets where tokens of both end cut the text into groups; an A
and a B token are linked where their byte ranges overlap. The number of documents that
hold a pair of ids linked says how usual the pair is, and each document is measured by
how many of its links are the most usual of their A id.

Texts are shuffled once, whole, to fold equal ones; each distinct text is encoded and
aligned once, and its pairs count as often as it occurs. What is measured goes back to
the documents by the text's SHA-256 and length (two distinct texts that met there would
have to collide).

A text is encoded block by block: a block is white space and what follows up to the
next blank or line end. Neither tokenizer merges across that border, which is checked
on the vocabularies when they are loaded (``splits``); vocabularies for which it does
not hold, and texts with a block whose tokens do not spell it, are encoded whole. A
block's alignment is remembered (two generations of at most ``BLOCKS_KEPT``), so
frequent words are encoded once per worker; the new blocks
of a batch are encoded in runs and aligned as arrays.

The pair counts are written and joined to the pairs of the texts; they are broadcast
only under ``broadcast_max_rows`` counted rows (24 bytes each), above that the join
shuffles and Spark can split a frequent pair. The highest count per A id has at most one
row per id of A's vocabulary.

Defined results: null and empty texts, and texts whose tokens of A or B do not spell
them, have no tokens: zeros and an empty digest; null ids stay null; repeated rows are
documents of their own. An empty table gives an empty result. Other columns are not
read. Vocabulary paths are parameters.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import accumulate, chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.llm.common import Generations, quoted, table, text_of
from chartstreak.session import materialise, workers_import_package

BLOCKS_KEPT = 200_000
RUN = 100  # new blocks encoded together
LONGEST_KEPT = 64
GUARD = "\n"
PAIR = 1 << 32  # a pair of ids is a * PAIR + b
BLOCK = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")

_aligners: dict = {}


def byte_of_char() -> dict:
    """The byte of each character in which a byte-level vocabulary is spelt."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: a byte-level vocabulary; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.char = byte_of_char()
        self.spelt: dict = {}

    def bytes_of(self, token: int) -> bytes:
        out = self.spelt.get(token)
        if out is None:
            piece = self.tokenizer.id_to_token(token)
            try:
                out = bytes(map(self.char.__getitem__, piece))
            except KeyError:
                out = piece.encode()
            self.spelt[token] = out
        return out

    def encode(self, texts: list) -> list:
        """Ids of each text, special tokens not added."""
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def splits(self) -> bool:
        """Whether a text's ids are those of its blocks (words and white space are parted before the merges)."""
        probe = ["  a b\n\n c!\t?\n d'll  1 　x\r\n", " x\x1c y\x85z\n .. \xa0q  \n"]
        return all(self.encode([t])[0] == [i for ids in self.encode(BLOCK.findall(t)) for i in ids] for t in probe)


class Pieces:
    """Tokenizer B: a sentencepiece model, which puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelt: dict = {}
        self.guard = self.model.encode(GUARD)

    def bytes_of(self, token: int) -> bytes:
        out = self.spelt.get(token)
        if out is None:
            piece = self.model.id_to_piece(token)
            out = bytes([int(piece[3:5], 16)]) if self.model.is_byte(token) else piece.replace("▁", " ").encode()
            self.spelt[token] = out
        return out

    def encode(self, texts: list) -> list:
        return self.model.encode(texts, num_threads=1)

    def encode_blocks(self, blocks: list) -> list:
        """Ids of blocks inside a text: each behind a line end, whose own ids are taken off."""
        n = len(self.guard)
        return [ids[n:] for ids in self.model.encode([GUARD + b for b in blocks], num_threads=1)]

    def splits(self) -> bool:
        """Whether no piece reaches over the border of blocks, and the line end stands alone."""
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        joined = any("▁" in p.lstrip("▁") or len(p) > 1 and "\n" in p for p in pieces)
        probe = "\n  a b\n\n c!\n d  "
        whole = self.model.encode(probe)
        parts = self.guard + [i for b in self.encode_blocks(BLOCK.findall(probe[1:])) for i in b]
        return not joined and len(self.guard) == 2 and whole == parts and \
            b"".join(map(self.bytes_of, whole)) == (" " + probe).encode()


def overlaps(a_ends: list, b_ends: list) -> tuple[list, list]:
    """((i, j) of overlapping tokens, (i, j) behind each group) for tokens that end at these offsets."""
    links, cuts, i, j = [], [], 0, 0
    while i < len(a_ends) and j < len(b_ends):
        links.append((i, j))
        a, b = a_ends[i], b_ends[j]
        i += a <= b
        j += b <= a
        if a == b:
            cuts.append((i, j))
    return links, cuts


def alignment(a: list, b: list, a_bytes: list, b_bytes: list, content: bytes) -> tuple | None:
    """(n_a, n_b, n_groups, n_links, groups, pairs) of one text's tokens; None if they do not spell ``content``."""
    a_parts, b_parts = [a_bytes[i] for i in a], [b_bytes[i] for i in b]
    if not b"".join(a_parts) == content == b"".join(b_parts):
        return None
    links, cuts = overlaps(list(accumulate(map(len, a_parts))), list(accumulate(map(len, b_parts))))
    ends = [(0, 0), *cuts]
    groups = ";".join(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m]))
                      for (i, j), (k, m) in zip(ends, ends[1:]))
    return (len(a), len(b), len(cuts), len(links), groups,
            np.array([a[i] * PAIR + b[j] for i, j in links], np.int64).tobytes())


class Aligner:
    """Both tokenizers and the remembered blocks."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.blockwise = self.a.splits() and self.b.splits()
        self.known = Generations(BLOCKS_KEPT)
        self.a_bytes = [self.a.bytes_of(i) for i in range(self.a.tokenizer.get_vocab_size())]
        self.b_bytes = [self.b.bytes_of(i) for i in range(self.b.model.get_piece_size())]
        self.a_size, self.b_size = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        # ids as text with what follows them in a group
        self.a_more, self.a_last, self.b_more, self.b_last = (
            np.array([f"{i}{mark}" for i in range(n)], object)
            for n, mark in ((len(self.a_bytes), ","), (len(self.a_bytes), "|"), (len(self.b_bytes), ","),
                            (len(self.b_bytes), ";")))

    def whole(self, text: str) -> tuple | None:
        return alignment(self.a.encode([" " + text])[0], self.b.encode([text])[0], self.a_bytes, self.b_bytes,
                         (" " + text).encode())

    def _fresh(self, blocks: list) -> list:
        """The alignments of new blocks: runs of them are encoded together and aligned as arrays."""
        runs = [blocks[i:i + RUN] for i in range(0, len(blocks), RUN)]
        texts = ["".join(r) for r in runs]
        a, b = self.a.encode(texts), self.b.encode_blocks(texts)
        found, good = {}, []
        for n, (run, text) in enumerate(zip(runs, texts)):
            content = text.encode()
            if (b"".join(map(self.a_bytes.__getitem__, a[n])) == content
                    == b"".join(map(self.b_bytes.__getitem__, b[n]))):
                good.append(n)
            else:
                for block, x, y in zip(run, self.a.encode(run), self.b.encode_blocks(run)):
                    found[block] = alignment(x, y, self.a_bytes, self.b_bytes, block.encode())
        if good:
            some = [block for n in good for block in runs[n]]
            found.update(zip(some, self._arrays(some, *(np.array(list(chain.from_iterable(x[n] for n in good)))
                                                        for x in (a, b)))))
        return [found[block] for block in blocks]

    def _arrays(self, blocks: list, a: np.ndarray, b: np.ndarray) -> list:
        """``alignment`` of each of ``blocks``, whose tokens in a row are ``a`` and ``b``."""
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        block_ends = np.cumsum([len(x.encode()) for x in blocks])
        # each end of either tokenizer closes one link, each common end a group
        union, cuts = np.union1d(a_ends, b_ends), np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not np.isin(block_ends, cuts).all():
            raise ValueError("a token reaches over the border of two blocks")
        pairs = a[np.searchsorted(a_ends, union)] * PAIR + b[np.searchsorted(b_ends, union)]
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        marks = np.empty(len(a) + len(b), object)
        marks[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = np.where(
            np.isin(a_ends, cuts), self.a_last[a], self.a_more[a])
        marks[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = np.where(
            np.isin(b_ends, cuts), self.b_last[b], self.b_more[b])
        marks = marks.tolist()
        at = [np.searchsorted(x, block_ends, "right") for x in (a_ends, b_ends, cuts, union)]
        counts = [np.diff(x, prepend=0).tolist() for x in at]
        places = (at[0] + at[1]).tolist()
        data, links = pairs.tobytes(), (8 * at[3]).tolist()
        return [(*c, "".join(marks[i:j])[:-1], data[k:m]) for *c, i, j, k, m in zip(
            *counts, [0, *places], places, [0, *links], links)]

    def _blocks(self, distinct: list) -> list:
        known = [self.known.get(x) for x in distinct]
        fresh = [n for n, x in enumerate(known) if x is None]
        new = self._fresh([distinct[n] for n in fresh]) if fresh else []
        for n, value in zip(fresh, new):
            known[n] = value
            if value is not None and len(distinct[n]) <= LONGEST_KEPT:
                self.known.keep(distinct[n], value)
        return known

    def align(self, texts: list):
        """(n_a, n_b, n_groups, n_links, groups, distinct pairs, links of each) per text; None without tokens."""
        parts = [BLOCK.findall(" " + t) if self.blockwise else [] for t in texts]
        distinct = list(dict.fromkeys(chain.from_iterable(parts)))
        code = dict(zip(distinct, range(len(distinct))))
        found = self._blocks(distinct) if distinct else []
        strange = {n for n, x in enumerate(found) if x is None}
        nothing = (0, 0, 0, 0, "", b"")
        found = [x or nothing for x in found]
        counts = np.array([x[:4] for x in found], np.int64).reshape(-1, 4)
        strings, ends = [x[4] for x in found], np.concatenate([[0], np.cumsum(counts[:, 3])])
        pairs = np.frombuffer(b"".join(x[5] for x in found), np.int64)
        for text, blocks in zip(texts, parts):
            codes = list(map(code.__getitem__, blocks))
            if text and codes and strange.isdisjoint(codes):
                at = np.array(codes)
                sizes = counts[at, 3]
                places = np.repeat(ends[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                yield (*counts[at].sum(axis=0).tolist(), ";".join([strings[c] for c in codes]), *_counted(pairs[places]))
            else:
                one = self.whole(text) if text else None
                yield one and (*one[:5], *_counted(np.frombuffer(one[5], np.int64)))


def _counted(pairs: np.ndarray) -> tuple:
    pairs, links = np.unique(pairs, return_counts=True)
    return pairs, links.astype(np.int32)


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


ALIGNED = ["digest", "n_bytes", "times", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _aligned(a_path: str, b_path: str, keep_groups: bool):
    def run(batches):
        both = aligner(a_path, b_path)
        for frame in batches:
            out = []
            for digest, size, times, found in zip(frame["digest"], frame["n_bytes"], frame["times"],
                                                  both.align(list(frame["text"]))):
                if found:
                    *counts, groups, pairs, links = found
                    out.append((digest, size, times, *counts, hashlib.sha256(groups.encode()).hexdigest(), pairs, links,
                                groups))
            rows = pd.DataFrame(out, columns=[*ALIGNED, "pairs", "links", "groups"])
            yield rows if keep_groups else rows.drop(columns="groups")
    return run


def align_texts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text",
                keep_groups: bool = False) -> DataFrame:
    """One row per distinct text with tokens: counts, digest of its groups, its distinct pairs and their links.

    ``times`` is the number of rows with the text; ``keep_groups`` adds the groups themselves.
    """
    workers_import_package(docs.sparkSession)
    text = text_of(text_col)
    texts = docs.select(text.alias("text")).where("text != ''").groupBy("text").agg(F.count("*").alias("times"))
    texts = texts.select(F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").alias("n_bytes"),
                         "times", "text")
    return texts.mapInPandas(
        _aligned(a_path, b_path, keep_groups),
        "digest binary, n_bytes int, times long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, links array<int>" + (", groups string" if keep_groups else ""))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold the pair linked, and whether no pair of its A id has more."""
    counts = aligned.select(F.explode("pairs").alias("pair"), "times").groupBy("pair").agg(F.sum("times").alias("count"))
    counts = materialise(counts, "pair-counts")
    a = F.shiftright("pair", 32).alias("a")
    highest = counts.groupBy(a).agg(F.max("count").alias("highest"))   # at most a row per id of A
    return (counts.withColumn("a", a).join(F.broadcast(highest), "a")
            .select("pair", "count", (F.col("count") == F.col("highest")).alias("best")))


def usual_links(aligned: DataFrame, counts: DataFrame, broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """(number, n_best, count_sum) of each text, by the counts of its pairs."""
    counts = materialise(counts, "best-pairs")
    small = counts.count() <= broadcast_max_rows
    # sorted exchanges otherwise, between which Spark can split a frequent pair
    counts = F.broadcast(counts) if small else counts.hint("merge")
    links = aligned.select("number", F.explode(F.arrays_zip("pairs", "links")).alias("z")).select(
        "number", F.col("z.pairs").alias("pair"), F.col("z.links").alias("links"))
    joined = links.join(counts, "pair")
    return joined.groupBy("number").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("links") * F.col("count")).cast("long").alias("count_sum"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                    broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """The measures of every document."""
    aligned = materialise(align_texts(docs, a_path, b_path, text_col).withColumn(
        "number", F.monotonically_increasing_id()), "aligned-texts")
    usual = usual_links(aligned, pair_counts(aligned), broadcast_max_rows)
    # written first, so that the join stands between plain exchanges and Spark can split a frequent text
    measures = materialise(aligned.drop("pairs", "links", "times").join(usual, "number").drop("number"),
                           "text-measures").hint("merge")
    text = text_of(text_col)
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       F.octet_length(text).alias("n_bytes"))
    joined = rows.join(measures, ["digest", "n_bytes"], "left")
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return joined.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                         F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))
