"""Language identification by rank-order profiles.

A profile is the ``size`` most frequent letter n-grams (1 to 3 letters, words
padded with a space on either side) in order of frequency. A document goes to
the language whose profile is nearest by the out-of-place distance: the sum,
over the document's own profile, of how far each n-gram's rank is from its rank
in the language's profile, an absent n-gram counting as ``size`` places.

Fitting counts n-grams in each task, which sends its sums on when it holds many
different ones, and adds the counts up by (language, n-gram). The most
frequent n-grams of a language are picked in two steps, first in salted parts,
so no task gets all n-grams of one language. Predicting is one pass over the
texts against profiles of ``size`` entries a language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.common import Scratch

UNDETERMINED = "und"
#: Characters of one language that a task holds before they are counted.
HELD_CHARS = 1 << 21
#: Different n-grams, over languages, that a task holds before they are sent on.
HELD_GRAMS = 1 << 20
#: Languages that one pass compares with; more take further passes.
LANGUAGES_AT_ONCE = 1000
SALTS = 64


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """By code point: 2 a letter, 1 a mark, 0 anything else."""
    first = {"L": 2, "M": 1}
    return np.fromiter((first.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), "u1", 0x110000)


def gram_codes(text: str | None) -> np.ndarray:
    """A code of three 21-bit code points for every n-gram of the text's words (a letter and the letters and
    marks that follow it) in lower case."""
    x = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    kind = kinds()[x]
    if not (kind == 2).any():
        return np.empty(0, "i8")
    if (kind == 1).any():  # a mark that follows no letter is no part of a word
        at = np.arange(len(x))
        kind = kind * (np.maximum.accumulate(np.where(kind == 2, at, -1)) > np.maximum.accumulate(np.where(kind == 0, at, -1)))
    x = np.concatenate([[32], np.where(kind, x, 32), [32]]).astype("i8")
    space = x == 32
    x = x[~space | np.r_[True, ~space[:-1]]]  # one space between words
    inner = x[1:-1] != 32
    letters = x[1:-1][inner]
    return np.concatenate([letters << 42, x[:-1] << 42 | x[1:] << 21, (x[:-2] << 42 | x[1:-1] << 21 | x[2:])[inner]])


def count_codes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in ascending order, and how often each occurs."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][: len(codes)])
    return codes[first], np.diff(np.r_[first, len(codes)])


def add_counts(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([a[1], b[1]]), len(codes)).astype("i8")


def ranked(codes: np.ndarray, times: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, equally frequent ones by code."""
    return codes[np.argsort(-times, kind="stable")[:size]]


def fit_profiles(docs: DataFrame, size: int = 300, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row for each place of each language's profile: ``lang, place`` (from 0) ``, gram``.

    Rows with a null text or a null language are left out; rows that repeat
    count as often as they are there. A language none of whose texts has a
    letter has no profile. Equally frequent n-grams are ordered by code, so the
    profiles do not depend on how the rows are partitioned.
    """
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, list[str]] = {}
        chars: dict[str, int] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        none = (np.empty(0, "i8"), np.empty(0, "i8"))

        def settle(lang: str) -> None:
            chars.pop(lang)
            sums[lang] = add_counts(sums.get(lang, none), count_codes(gram_codes("\n".join(texts.pop(lang)))))

        def send(lang: str) -> pa.RecordBatch:
            codes, times = sums.pop(lang)
            return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(codes)), pa.array(codes), pa.array(times)], schema=schema)

        for part in parts:
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
                chars[lang] = chars.get(lang, 0) + len(text)
                if chars[lang] > HELD_CHARS:
                    settle(lang)
                    if sum(len(codes) for codes, _ in sums.values()) > HELD_GRAMS:
                        yield from map(send, list(sums))
                elif len(chars) > 64:  # many languages: none may be held for long
                    for other in list(chars):
                        settle(other)
                    yield from map(send, list(sums))
        for lang in list(chars):
            settle(lang)
        yield from map(send, list(sums))

    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counted = labelled.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = [F.desc("n"), F.asc("gram")]
    for by in (["lang", F.pmod(F.xxhash64("gram"), F.lit(SALTS))], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*best))
        counted = counted.withColumn("place", place - 1).where(F.col("place") < size)
    return counted.select("lang", "place", "gram")


class Profiles:
    """Profiles of some languages as one table of places, absent n-grams at ``size``."""

    def __init__(self, rows: list, size: int):
        self.size = size
        self.langs = sorted({r["lang"] for r in rows}, key=lambda x: x.encode("utf-8", "surrogatepass"))
        at = {lang: i for i, lang in enumerate(self.langs)}
        self.codes, where = np.unique(np.array([r["gram"] for r in rows], "i8"), return_inverse=True)
        # a last row for n-grams that no profile has
        self.places = np.full((len(self.codes) + 1, len(self.langs)), size, "i4")
        self.places[where, [at[r["lang"]] for r in rows]] = [r["place"] for r in rows]

    def distances(self, profile: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each language, from 0 to 1 (no n-gram in common)."""
        if not len(self.codes):
            return np.ones(0)
        at = np.searchsorted(self.codes, profile)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == profile, at, len(self.codes))
        places = self.places[at]
        off = np.abs(places - np.arange(len(profile), dtype="i4")[:, None])
        off[places == self.size] = self.size
        return off.sum(axis=0) / (self.size * len(profile))


def predict(docs: DataFrame, profiles: DataFrame, size: int = 300, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``; other columns are not read.

    ``lang_pred`` is the nearest language; of equally near ones the first by
    UTF-8 bytes. ``score``: how much nearer it is than the next one, as a share of the
    next one's distance (1: an exact match; a single language is compared with the largest distance). A text that is null or has no letter is
    ``und`` with score 0, as is every text where no language was learned. Each
    row is judged for itself, so repeated rows have equal results, and null ids
    stay null. No rows in, no rows out.
    """
    spark = docs.sparkSession
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("near", pa.float64()), ("next", pa.float64())])
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.lit(None).cast("string").alias("lang"), F.lit(1.0).alias("near"), F.lit(1.0).alias("next")
    )
    stored = Scratch(spark, "langid").write(profiles, "profiles")
    langs = [r["lang"] for r in stored.where("place = 0").select("lang").orderBy("lang").collect()]
    for begin in range(0, len(langs), LANGUAGES_AT_ONCE):
        block = langs[begin : begin + LANGUAGES_AT_ONCE]
        rows = stored.where(F.col("lang").between(block[0], block[-1])).collect()
        table = spark.sparkContext.broadcast(Profiles(rows, size))

        def nearest(parts: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            known = table.value
            for part in parts:
                out = []
                for text, lang, near, after in zip(*(part.column(i).to_pylist() for i in range(1, 5)), strict=True):
                    profile = ranked(*count_codes(gram_codes(text)), size)
                    if len(profile):
                        far = known.distances(profile)
                        i = int(far.argmin())
                        rest = np.delete(far, i).min(initial=1.0)
                        # an earlier block's language goes first where it is as near
                        if lang is None or far[i] < near:
                            lang, near, after = known.langs[i], float(far[i]), float(min(rest, near))
                        else:
                            after = float(min(after, far[i]))
                    out.append((lang, near, after))
                a, b, c = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(a, "string"), pa.array(b, "double"), pa.array(c, "double")], schema=schema)

        found = found.mapInArrow(nearest, "doc_id long, text string, lang string, near double, next double")
    score = F.when(F.col("lang").isNull(), 0.0).when(F.col("next") > 0, 1 - F.col("near") / F.col("next")).otherwise(0.0)
    return found.select("doc_id", F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang_pred"), score.alias("score"))


def held_out(parts: int = 4, part: int = 2, id_col: str = "doc_id"):
    """Whether the CRC-32 of the id as text leaves ``part`` when divided by ``parts``; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame, size: int = 300) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: profiles of the documents that are not held out, applied to all."""
    profiles = fit_profiles(docs.where(~held_out()), size)
    found = predict(docs, profiles, size)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
