"""Language identification with bit-sliced Bloom filters of n-grams.

One array of cells serves all languages: bit ``l`` of a cell belongs to
language ``l``. An n-gram sets its languages' bits in ``HASHES`` cells, and the
AND of those cells is the mask of all languages that contain the n-gram. A text
is decided by the number of its n-grams that each language contains, corrected
for the share of false positives that the language's bits give, which is the
language's fill to the power of the number of hashes.

``fit`` learns from about ``rows_per_language`` whole labelled texts of each
language, picked by a hash of the id (the bound is a parameter; a language with
fewer rows is learned from all of them). Every n-gram of those texts is in the
filter. Tasks find the distinct n-grams, Spark joins their languages into one
mask per n-gram and their masks into one per cell, and only the cells reach the
driver: three jobs for any number of languages. The cells are about eight per
distinct n-gram, within ``CELL_BITS``; beyond the upper end the filter grows
fuller, which raises the share of false positives that is taken off, but loses
no n-gram.

Defined results: a text that is null or has no letter is ``und`` with score 0;
equal texts get equal results; ties go to the language that sorts first; without
any labelled row every text is ``und``, and ``keep_known_languages`` then keeps
every text that has a letter. Rows with a null id are not learned
from and not held out. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.llm.common import quoted, table
from chartstreak.session import materialise, workers_import_package

ORDERS = (3, 4)
HASHES = 2
CELL_BITS = 20, 22         # least and most; a cell is one bit per language
UNKNOWN = "und"
BLANK = 32
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]

_letters: list = []


def letters(codes: np.ndarray) -> np.ndarray:
    """Whether each code point is a letter (str.isalpha)."""
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x10000)]))
    known = _letters[0][np.minimum(codes, 0xFFFF)]
    for i in np.flatnonzero(codes > 0xFFFF):
        known[i] = chr(codes[i]).isalpha()
    return known


def grams(text: str | None) -> np.ndarray:
    """64-bit hashes of all n-grams of the lower-cased text; other characters than letters are one blank."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters(codes)
    if not letter.any():
        return np.empty(0, np.uint64)
    codes = np.where(letter, codes, BLANK).astype(np.uint64)
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    codes = codes[kept]
    if codes[-1] != BLANK:
        codes = np.append(codes, np.uint64(BLANK))
    codes = np.concatenate([np.array([BLANK], np.uint64), codes])
    out = []
    for n in ORDERS:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for i in range(n):
                h += (codes[i:len(codes) - n + 1 + i] + np.uint64(1)) * MIX[i]
            h ^= h >> np.uint64(29)
            out.append(h * MIX[1])
    return np.concatenate(out)


def cells_of(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cells of each n-gram, one array per hash."""
    mask = np.uint64((1 << bits) - 1)
    return [((hashes >> np.uint64(64 - bits * (i + 1))) & mask).astype(np.int64) for i in range(HASHES)]


def _cell(gram: Column, bits: int, i: int) -> Column:
    """``cells_of`` as a column."""
    return F.shiftrightunsigned(gram, 64 - bits * (i + 1)).bitwiseAND(F.lit((1 << bits) - 1))


@dataclass
class Model:
    languages: list[str]
    cells: np.ndarray         # one mask per cell; an extra axis of 64-bit words
    false_positive: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        hashes = grams(text)
        if not len(hashes) or not self.languages:
            return UNKNOWN, 0.0
        hits = np.zeros(len(self.languages))
        places = cells_of(hashes, self.cells.shape[1].bit_length() - 1)
        for word in range(self.cells.shape[0]):
            masks = self.cells[word][places[0]]
            for more in places[1:]:
                masks &= self.cells[word][more]
            base = 64 * word
            here = range(base, min(base + 64, len(self.languages)))
            if len(here) <= 16:
                counts = np.bincount(masks.astype(np.int64), minlength=1 << len(here))
                held = np.arange(len(counts))
                for bit in here:
                    hits[bit] = counts[(held >> (bit - base)) & 1 == 1].sum()
            else:
                for bit in here:
                    hits[bit] = ((masks >> np.uint64(bit - base)) & np.uint64(1)).sum()
        share = (hits / len(hashes) - self.false_positive) / np.maximum(1 - self.false_positive, 1e-9)
        best = int(np.argmax(share))
        return self.languages[best], float(min(1.0, max(0.0, share[best])))


def build(languages: list[str], bits: int, touched: pd.DataFrame) -> Model:
    """The filter of (word, cell, mask) rows; bit ``l % 64`` of word ``l // 64`` is language ``l``'s."""
    words = max(1, -(-len(languages) // 64))
    cells = np.zeros((words, 1 << bits), np.uint16 if len(languages) <= 16 else np.uint64)
    masks = touched["mask"].to_numpy(np.int64).view(np.uint64)
    cells[touched["word"].to_numpy(np.int64), touched["cell"].to_numpy(np.int64)] = masks.astype(cells.dtype)
    fill = [np.count_nonzero(cells[l // 64] & cells.dtype.type(1 << (l % 64))) / (1 << bits)
            for l in range(len(languages))]
    return Model(languages, cells, np.array(fill) ** HASHES)


def _distinct(batches):
    for frame in batches:
        for number, texts in frame.groupby("number")["text"]:
            found = np.unique(np.concatenate([np.unique(grams(t)) for t in texts]))
            yield pd.DataFrame({"number": number, "gram": found.view(np.int64)})


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows_per_language: int = 4_000, cell_bits: tuple[int, int] = CELL_BITS) -> Model:
    """Learn from the rows of ``labelled`` that have an id and a language."""
    workers_import_package(labelled.sparkSession)
    rows = labelled.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(lang_col)).cast("string").alias("lang"),
                           F.col(quoted(text_col)).cast("string").alias("text")
                           ).where(F.col("id").isNotNull() & F.col("lang").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(x for x in sizes if x != UNKNOWN)
    if not languages:
        return build([], cell_bits[0], pd.DataFrame({"word": [], "cell": [], "mask": []}))
    learned = labelled.sparkSession.createDataFrame(
        [(n, l, min(1.0, rows_per_language / sizes[n])) for l, n in enumerate(languages)],
        "lang string, number int, odds double")
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(F.col("text").isNotNull()).join(F.broadcast(learned), "lang").where(draw < F.col("odds"))
    bit = F.expr("shiftleft(1L, number % 64)")
    masks = materialise(
        sample.select("number", "text").mapInPandas(_distinct, "number int, gram long")
        .select("gram", F.expr("number div 64").alias("word"), bit.alias("mask"))
        .groupBy("gram", "word").agg(F.bit_or("mask").alias("mask")), "language-grams")
    bits = min(cell_bits[1], max(cell_bits[0], (8 * masks.count()).bit_length()))
    touched = (masks.select("word", "mask", F.explode(F.array(*[_cell(F.col("gram"), bits, i) for i in range(HASHES)]))
                            .alias("cell"))
               .groupBy("word", "cell").agg(F.bit_or("mask").alias("mask")))
    return build(languages, bits, touched.toPandas())


def predictor(spark: SparkSession, model: Model):
    """A function of a text column that gives struct(lang_pred, score)."""
    workers_import_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])
    return predict


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text, modulo ``folds``."""
    return F.coalesce(F.crc32(F.col(quoted(id_col)).cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    predict = predictor(docs.sparkSession, model)
    found = docs.select(F.col(quoted(id_col)).alias("doc_id"), held_out(id_col).alias("held_out"),
                        predict(F.col(quoted(text_col)).cast("string")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_known_languages(docs: DataFrame, model: Model, least_score: float = 0.05,
                         text_col: str = "text") -> DataFrame:
    """The documents with a language; ``und`` and texts of hardly any known n-gram go.

    A model that learned no language tells nothing about a text: all that have a letter stay.
    """
    if not model.languages:
        workers_import_package(docs.sparkSession)

        @F.pandas_udf("boolean")
        def has_letter(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: any(map(str.isalpha, t or ""))).astype(bool)
        return docs.where(has_letter(F.col(quoted(text_col)).cast("string")))
    predict = predictor(docs.sparkSession, model)
    found = predict(F.col(quoted(text_col)).cast("string"))
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least_score))


def learn(docs: DataFrame) -> Model:
    """The model of the documents outside the held-out fold."""
    return fit(docs.where(~held_out()))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
