"""Best-fit packing of token sequences by minimum bin slack.

``token_pieces`` encodes whole texts and cuts only what is longer than the
capacity. ``pack`` gives every piece a sequence and an offset:

1. Spark counts the pieces of each length: at most ``capacity`` rows, however
   large the corpus, so this histogram may go to the driver.
2. ``fill_plan`` repeats minimum bin slack on the histogram. A bin starts with
   the longest remaining piece; a bitset subset-sum over the remaining lengths
   (with their counts) finds the fullest feasible combination, which is
   removed. The same combination is removed as often as the counts allow, so
   the plan has a few rows per length instead of one per bin.
3. Pieces are numbered within their length: windows over (length, salt) plus
   the counts of earlier salts; a length has a salt per ``rows_per_salt`` pieces, so
   one that a third of all rows share is spread over as many windows as it needs. A broadcast join with the plan (bounded by
   the capacity, not by the corpus) turns the number into sequence and offset.

Defined results: null text counts as empty; an empty text is one piece holding
only the end id; repeated rows are packed each; null ids are kept. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartstreak.llm.common import quoted, table, text_of
from chartstreak.session import materialise, workers_import_package

CAPACITY = 4096
END_ID = 1
PARTS_KEPT = 200_000
ROWS_PER_SALT = 100_000
LONGEST_KEPT = 64

_encoders: dict = {}
little_ids = sys.byteorder == "little" and array("I").itemsize == 4


# The steps before the merges that the fast way restates; other files are encoded by their tokenizer whole.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

# The same for texts of printed Latin-1 characters, blanks and line ends.
BEYOND_L1 = re.compile("[^ \n!-~\xa1-\xff]")
L1_TOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                      "|[^ \na-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in PRINTED} | {b: chr(256 + n) for n, b in enumerate(
    b for b in range(256) if b not in PRINTED)}


def _bytes(ids) -> bytes:
    return array("I", ids).tobytes() if little_ids else b"".join(i.to_bytes(4, "little") for i in ids)


class Memo(dict):
    """Ids by part, made when missed; a full young generation becomes the old one, from which hits are renewed."""

    def __init__(self, most: int, make):
        super().__init__()
        self.most, self.make, self.old = most, make, {}

    @property
    def young(self) -> dict:
        return self

    def __missing__(self, unit: str) -> bytes:
        code = self.old.get(unit)
        if code is None:
            code = self.make(unit)
        if len(unit) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[unit] = code
        return code


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit bytes, parts of words encoded once per worker.

    The tokenizer drops white space and no match or normal form reaches across
    a blank, so a text's ids are those of the parts that its pattern finds, in order. A
    text of printed Latin-1 characters is lowered and split as the tokenizer does,
    and only parts not yet known go to the tokenizer's model; of any other text the
    blank-separated words with other characters go through the whole tokenizer. A file
    whose normalizer or pre-tokenizer is not the one restated here is used whole.
    Two generations of at most ``PARTS_KEPT`` parts and words are remembered, so
    memory is bounded and frequent ones stay.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        steps = json.loads(self.tokenizer.to_str())
        self.known_steps = steps["normalizer"] == NORMALIZER and steps["pre_tokenizer"] == PRE_TOKENIZER
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts, self.words = Memo(PARTS_KEPT, self._part), Memo(PARTS_KEPT, self._word)

    def _whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _part(self, part: str) -> bytes:
        spelt = part if part.isascii() else "".join(map(BYTE_CHARS.__getitem__, part.encode()))
        return _bytes([t.id for t in self.tokenizer.model.tokenize(spelt)])

    def _plain(self, text: str) -> bool:
        return not BEYOND_L1.search(text) and not any(s in text for s in self.special)

    def _latin1(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, L1_TOKEN.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        return self._latin1(word) if self._plain(word) else self._whole(word)

    def encode(self, text: str) -> bytes:
        if not self.known_steps:
            return self._whole(text)
        if self._plain(text):
            return self._latin1(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def _encoder(vocabulary: str) -> WordEncoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = WordEncoder(vocabulary)
    return _encoders[vocabulary]


def _cutter(vocabulary: str, capacity: int, end_id: int, keep_ids: bool):
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        encode = _encoder(vocabulary).encode
        for frame in batches:
            out = []
            for doc, text in zip(frame["doc_id"], frame["text"]):
                ids = encode(text) + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at:at + 4 * capacity]
                    out.append((doc, n, at // 4, len(piece) // 4, zlib.crc32(piece), piece if keep_ids else None))
            rows = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            rows["doc_id"] = rows["doc_id"].astype("Int64")
            yield rows if keep_ids else rows.drop(columns="ids")
    return cut


def token_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; ``ids`` (bytes, little-endian 32 bit) only if asked for."""
    workers_import_package(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return (docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
            .mapInPandas(_cutter(vocabulary, capacity, end_id, keep_ids), schema))


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths that fills most of ``room``: {length: uses}.

    Long lengths enter the subset-sum first; it stops once ``room`` is reached.
    """
    reach, before, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        before.append((length, reach))
        left, chunk = min(counts[length], room // length), 1
        while left:
            chunk = min(chunk, left)
            reach |= (reach << (chunk * length)) & mask
            left -= chunk
            chunk *= 2
        if reach >> room & 1:
            break
    target, uses = reach.bit_length() - 1, {}
    for length, prior in reversed(before):
        n = 0
        while not prior >> target & 1:
            target -= length
            n += 1
        if n:
            uses[length] = n
    return uses


def fill_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Rows (length, first rank, end rank, uses per bin, first bin, offset in the bin)."""
    counts, used, rows, bins = dict(histogram), dict.fromkeys(histogram, 0), [], 0
    for longest in sorted(counts, reverse=True):
        while counts[longest]:
            counts[longest] -= 1
            uses = fullest(counts, capacity - longest)
            counts[longest] += 1
            uses[longest] = uses.get(longest, 0) + 1
            times = min(counts[x] // n for x, n in uses.items())
            offset = 0
            for length in sorted(uses, reverse=True):
                n = uses[length]
                rows.append((length, used[length], used[length] + n * times, n, bins, offset))
                used[length] += n * times
                counts[length] -= n * times
                offset += n * length
            bins += times
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``pieces`` (columns doc_id, piece, length and any others) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    pieces = materialise(pieces, "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.count("*")).collect()}
    # a salt per ``rows_per_salt`` pieces of a length; one row per length
    salts = spark.createDataFrame([(x, -(-n // rows_per_salt)) for x, n in histogram.items()], "length long, salts long")
    pieces = pieces.join(F.broadcast(salts), "length").select(
        *pieces.columns, F.pmod(F.xxhash64("doc_id", "piece"), F.col("salts")).alias("salt"))
    counts = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    plan = spark.createDataFrame(fill_plan(histogram, capacity),
                                 "length long, low long, high long, uses long, bin long, place long")
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = (pieces.withColumn("rank", F.row_number().over(within) - 1).join(starts, ["length", "salt"])
              .withColumn("rank", F.col("rank") + F.col("before")).drop("before", "salt").alias("p"))
    plan = F.broadcast(plan).alias("q")
    placed = ranked.join(plan, (F.col("p.length") == F.col("q.length")) & (F.col("p.rank") >= F.col("q.low"))
                         & (F.col("p.rank") < F.col("q.high")))
    turn = F.col("p.rank") - F.col("q.low")
    return placed.select(
        *[F.col(f"p.{quoted(c)}") for c in pieces.columns if c != "salt"],
        (F.col("q.bin") + F.floor(turn / F.col("q.uses"))).alias("sequence_id"),
        (F.col("q.place") + turn % F.col("q.uses") * F.col("p.length")).cast("long").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence (from pieces kept with their ids); at most ``capacity`` tokens a row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "piece")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"),
        F.expr("transform(parts, p -> struct(p.doc_id, p.piece, p.offset))").alias("pieces"))


def pack_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """All pieces of ``docs`` placed; the vocabulary defaults to the public word vocabulary."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return pack(token_pieces(docs, vocabulary)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
