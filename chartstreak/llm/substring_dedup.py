"""Substring dedup by sliding sentence spans.

A text is divided into sentences (after ``.``, ``!`` or ``?`` with white space,
and at line ends). A sentence is divided where the words say so: after a word
whose pair with the next one has the smallest hash among the ``NEAR`` pairs on
each side, all in the sentence. Where a cut stands depends on the words around
it alone, so two copies of a passage are cut alike but for their ends, wherever
in a sentence they begin. What is still longer than ``LONGEST`` words (words that
repeat with a short period, mostly) is divided every ``PART`` words from the last
cut. A unit at the end of a passage that also holds other words does not match;
matches are not extended word by word, so such words stay, and so does a passage
of which fewer than ``span`` whole units or ``least_words`` words match. Every run of
``span`` consecutive sentences is hashed (words only, so white space does not
matter). Spark finds the occurrences that are not the first of their run: equal runs
of one batch of rows meet where they are hashed, and all but the first of them are
known to be later ones there. The first of each batch meet by one shuffle and are
numbered in order. A run that stands in every text is so one row per batch there.
Sentences covered by a run that is not the first go, if the covered stretch has
at least ``least_words`` words; shorter stretches (a common line) stay.

The first occurrence is the one with the smallest (id, row number, position), so
of any removed sentence an earlier copy stays. What stays of a text is
unchanged, white space included; a text without repeats is returned as it is.

A text is told from another by its id and the 128 bits of its digest, a run by 128 bits
of its words: at 10^12 runs a false match has odds of one in 10^14.

Only hashes and positions are shuffled by hash, once. Positions of one text are
gathered per text, so a group is never larger than one text. Texts are shuffled
once, to meet their covered positions.

Defined results: null text counts as empty and comes back empty; a text whose
sentences are all covered comes back empty; rows that repeat id and text are one
document (both are returned alike); null ids sort first. An empty table gives an
empty result. All other columns are passed through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartstreak.llm.common import fresh, quoted, table, text_of
from chartstreak.session import materialise, workers_import_package

NEAR, LONGEST, PART = 4, 16, 12
SENTENCE_END = re.compile(r"[.!?]+\s+|\s*\n\s*")
WORD = re.compile(r"\S+")
MIX, OTHER_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _pieces(text: str) -> tuple[list, list, list]:
    """All words, (begin, end, first word) of each sentence with words, and the first words of the units."""
    begin, words, spots = 0, [], []
    ends = [m.end() for m in SENTENCE_END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    for end in ends:
        here = text[begin:end].split()
        if here:
            spots.append((begin, end, len(words)))
            words += here
        begin = end
    firsts = [first for _, _, first in spots]
    width = 2 * NEAR + 1
    if len(words) > width:
        one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        pair = (one[:-1] ^ (one[1:] >> np.uint64(7))) * MIX + one[1:]
        pair = (pair ^ (pair >> np.uint64(32))) * MIX
        # least[i] is the smallest of NEAR pairs from i on
        least = pair[:len(pair) - NEAR + 1].copy()
        for i in range(1, NEAR):
            np.minimum(least, pair[i:len(pair) - NEAR + 1 + i], out=least)
        n = len(pair) - 2 * NEAR
        middle = pair[NEAR:NEAR + n]
        ok = (middle < least[:n]) & (middle <= least[NEAR + 1:NEAR + 1 + n])
        sentence = np.repeat(np.arange(len(firsts)), np.diff(firsts + [len(words)]))
        ok &= sentence[:n] == sentence[width:width + n]
        firsts = np.sort(np.concatenate([firsts, np.flatnonzero(ok) + NEAR + 1])).tolist()
    out = []
    for first, end in zip(firsts, firsts[1:] + [len(words)]):
        out += range(first, end, PART) if end - first > LONGEST else [first]
    return words, spots, out


def sentences(text: str) -> Iterator[tuple[int, list]]:
    """(start, words) of each sentence or part of one; it reaches to the next start."""
    words, spots, firsts = _pieces(text)
    ends, at = firsts[1:] + [len(words)], 0
    for (begin, end, first), (_, _, after) in zip(spots, spots[1:] + [(0, 0, len(words))]):
        starts = None
        while at < len(firsts) and firsts[at] < after:
            if firsts[at] > first and starts is None:
                starts = [m.start() for m in WORD.finditer(text, begin, end)]
            yield (starts[firsts[at] - first] if firsts[at] > first else begin), words[firsts[at]:ends[at]]
            at += 1


def span_hashes(text: str, span: int) -> np.ndarray:
    """128 bits (two columns) of each run of ``span`` consecutive sentences."""
    words, _, firsts = _pieces(text)
    units = (" ".join(words[a:b]).encode() for a, b in zip(firsts, firsts[1:] + [len(words)]))
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, units)), ">u8").astype(np.uint64).reshape(-1, 2)
    if len(both) < span:
        return np.empty((0, 2), np.int64)
    out = np.zeros((len(both) - span + 1, 2), np.uint64)
    for i in range(span):
        out = (out ^ both[i:len(both) - span + 1 + i]) * np.array([MIX, OTHER_MIX])
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def without(text: str, runs, span: int, least_words: int) -> tuple[str, int, int]:
    """``text`` without the sentences that the runs cover; number of sentences and words removed."""
    units = list(sentences(text))
    covered = np.zeros(len(units), bool)
    for at in runs:
        covered[at:at + span] = True
    starts = [s for s, _ in units] + [len(text)]
    starts[0] = 0
    out, gone, gone_words, at = [], 0, 0, 0
    while at < len(units):
        end = at
        while end < len(units) and covered[end] == covered[at]:
            end += 1
        words = sum(len(w) for _, w in units[at:end])
        if covered[at] and words >= least_words:
            gone, gone_words = gone + end - at, gone_words + words
        else:
            out.append(text[starts[at]:starts[end]])
        at = end
    return ("".join(out), gone, gone_words) if gone else (text, 0, 0)


def _hashes(span: int):
    def hashes(batches):
        for frame in batches:
            found = [span_hashes(t, span) for t in frame["text"]]
            sizes = np.array([len(x) for x in found], np.int64)
            both, ends = np.concatenate([np.empty((0, 2), np.int64), *found]), np.cumsum(sizes)
            row = np.repeat(np.arange(len(found)), sizes)
            place = (np.arange(len(row)) - (ends - sizes)[row]).astype(np.int32)
            # equal runs side by side in order of their rows' ids; the sort leaves rows and places of one id in order
            order = np.lexsort((frame["doc_id"].to_numpy()[row], frame["has_id"].to_numpy()[row], both[:, 1], both[:, 0]))
            again = np.zeros(len(row), bool)
            again[order[1:]] = (both[order[1:]] == both[order[:-1]]).all(axis=1)
            texts = [(slice(end - n, end), ~again[end - n:end]) for n, end in zip(sizes, ends)]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "has_id": frame["has_id"], "code": frame["code"],
                                "number": frame["number"],
                                "spans": [both[at, 0][new] for at, new in texts],
                                "more": [both[at, 1][new] for at, new in texts],
                                "places": [place[at][new] for at, new in texts],
                                "known": [place[at][~new] for at, new in texts]})
    return hashes


def _code(text: Column) -> Column:
    """128 bits of a text's digest."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def repeated_runs(docs: DataFrame, id_col: str, text_col: str, span: int) -> DataFrame:
    """(doc_id, code, runs): positions of the runs that are not the first of their kind, per text."""
    workers_import_package(docs.sparkSession)
    text = text_of(text_col)
    id_ = F.col(quoted(id_col)).cast("long")
    src = docs.select(F.coalesce(id_, F.lit(0)).alias("doc_id"), id_.isNotNull().alias("has_id"), _code(text).alias("code"),
                      F.monotonically_increasing_id().alias("number"), text.alias("text"))
    spans = materialise(src.mapInPandas(
        _hashes(span), "doc_id long, has_id boolean, code binary, number long, spans array<long>, more array<long>, "
                       "places array<int>, known array<int>"), "spans")
    spans = spans.withColumn("doc_id", F.when(F.col("has_id"), F.col("doc_id")))
    # a row stands by its written number; rows of one id and text by the smallest of theirs
    heads = spans.groupBy("doc_id", "code").agg(F.min("number").alias("number"))
    rows = spans.select("doc_id", "number", F.explode(F.arrays_zip("spans", "more", "places")).alias("run"))
    rows = rows.select("doc_id", "number", F.col("run.spans").alias("span"), F.col("run.more").alias("more"),
                       F.col("run.places").alias("pos"))
    nth = F.row_number().over(Window.partitionBy("span", "more").orderBy("doc_id", "number", "pos"))
    later = rows.select("number", "pos", nth.alias("nth")).where("nth > 1").select("number", "pos")
    known = spans.select("number", F.explode("known").alias("pos"))
    runs = later.union(known).groupBy("number").agg(F.collect_set("pos").alias("runs"))
    return heads.join(runs, "number").select("doc_id", "code", "runs")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 3,
                   least_words: int = 32, counts: bool = False) -> DataFrame:
    """``docs`` with repeated passages removed from the text.

    ``counts`` adds what was removed (``removed_sentences``, ``removed_words``, with an underscore
    behind where ``docs`` has the name). ``least_words=1`` removes every covered stretch.
    """
    runs = repeated_runs(docs, id_col, text_col, span)
    id_, code, at = fresh(docs, "run_doc"), fresh(docs, "run_code"), fresh(docs, "runs")
    runs = runs.select(F.col("doc_id").alias(id_), F.col("code").alias(code), F.col("runs").alias(at))

    @F.pandas_udf("text string, removed_sentences int, removed_words int")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, places in batches:
            yield pd.DataFrame([(t, 0, 0) if p is None else without(t, p, span, least_words)
                                for t, p in zip(texts, places)],
                               columns=["text", "removed_sentences", "removed_words"])
    joined = docs.join(runs, F.col(quoted(id_col)).cast("long").eqNullSafe(F.col(id_))
                       & (_code(text_of(text_col)) == F.col(code)), "left")
    new = fresh(docs, "cut_text")
    joined = joined.withColumn(new, cut(text_of(text_col), F.col(at)))
    columns = [F.col(f"{new}.text").alias(c) if c.lower() == text_col.lower() else F.col(quoted(c)) for c in docs.columns]
    if counts:
        columns += [F.col(f"{new}.{c}").alias(fresh(docs, c)) for c in ("removed_sentences", "removed_words")]
    return joined.select(*columns)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, counts=True)
