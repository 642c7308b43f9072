"""Language ID by rank-order profiles.

A profile is the list of a language's most frequent character n-grams (one to
three letters, a blank at word ends) over all its training documents, most
frequent first.  A document's own most frequent n-grams are ranked the same
way, and its distance to a profile is the sum of the differences of ranks
("out of place"), an n-gram that the profile lacks costing the profile's
length.  The nearest language wins; score = 1 - distance / greatest distance.

Training is one distributed count: tasks count n-grams per language, Spark
sums them, and the first ``profile`` n-grams per language (a bounded table)
are broadcast.  Language, source and id play no part in a prediction.

A text that is null or has no letter is ``und`` with score 0; so is every text
if there is nothing to learn from.  Ties in counts go to the lower n-gram code,
ties in distance to the language that is first by name.  Null ids are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE, ORDER = 400, 3
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")
_BITS = 21                                     # a code point
#: Distinct n-grams that a training task holds before it hands them on.
TASK_GRAMS = 1_000_000


def codes(text: str) -> np.ndarray:
    """The codes of all n-grams of a text's words (lower case, blank at both ends)."""
    letters = " " + _OTHER.sub(" ", text.lower()).strip() + " "
    c = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    two = (c[:-1] << _BITS) | c[1:]
    three = (two[:-1] << _BITS) | c[2:]
    blank = c == 32
    # a blank stands at the ends of an n-gram only
    return np.concatenate((c[~blank], two, three[~blank[1:-1]]))


def ranked(text: str, top: int) -> np.ndarray:
    """A document's ``top`` most frequent n-gram codes, most frequent first."""
    value, count = counted(codes(text))
    if len(value) > top:
        least = np.partition(count, len(count) - top)[len(count) - top]
        keep = count >= least
        value, count = value[keep], count[keep]
    return value[np.lexsort((value, -count))][:top]


def counted(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    value = np.sort(value)
    at = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.zeros(0, np.int64)
    return value[at], np.diff(np.append(at, len(value)))


class Profiles:
    """Profiles as one sorted table of codes with a rank per language."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int):
        self.top = top
        self.langs = sorted({r[0] for r in rows})
        number = {name: i for i, name in enumerate(self.langs)}
        self.codes = np.array(sorted({r[1] for r in rows}), np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), top, np.int32)   # last row: in no profile
        for name, code, rank in rows:
            self.ranks[np.searchsorted(self.codes, code), number[name]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0
        own = ranked(text, self.top)
        at = np.searchsorted(self.codes, own)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != own)] = len(self.codes)
        known = self.ranks[at]
        off = np.where(known == self.top, self.top, np.abs(known - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(off.argmin())
        return self.langs[best], float(1.0 - off[best] / (self.top * len(own)))


def learn(docs: DataFrame, text: Column, lang: Column, profile: int = PROFILE) -> DataFrame:
    """(lang, code, rank): the ``profile`` most frequent n-grams of each language over all ``docs``."""
    train = docs.select(lang.alias("lang"), text.alias("text")).where("lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts):
            value = np.concatenate([p[0] for p in parts])
            n = np.concatenate([p[1] for p in parts])
            order = np.argsort(value, kind="stable")
            value, n = value[order], n[order]
            at = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
            return value[at], np.add.reduceat(n, at)

        def rows():
            for name, parts in held.items():
                value, n = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(value)), pa.array(value), pa.array(n, pa.int64())],
                                                 ["lang", "code", "n"])

        for b in batches:
            for name, t in zip(b.column(0), b.column(1)):
                if not _LETTER.search(t := t.as_py()):
                    continue
                part = counted(codes(t))
                held.setdefault(name.as_py(), []).append(part)
                size += len(part[0])
                if size > TASK_GRAMS:                      # fold what repeats; hand on what is still too much
                    held = {k: [merged(v)] for k, v in held.items()}
                    size = sum(len(v[0][0]) for v in held.values())
                    if size > TASK_GRAMS // 2:
                        yield from rows()
                        held, size = {}, 0
        yield from rows()

    counts = train.mapInArrow(count, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("code"))
    return (counts.withColumn("rank", F.row_number().over(w) - 1).where(F.col("rank") < profile)
            .select("lang", "code", "rank"))


def predict(docs: DataFrame, profiles: DataFrame, text_col: str = "text", profile: int = PROFILE) -> DataFrame:
    """``docs`` with lang_pred and score; profiles (languages x ``profile`` rows) are broadcast."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast([tuple(r) for r in profiles.collect()])
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("rest"), F.col(text_col).alias("text"))
    rest = packed.schema["rest"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(model.value, profile)
        for b in batches:
            found = [known.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["rest", "text", "lang_pred", "score"])

    out = packed.mapInArrow(run, f"rest {rest}, text string, lang_pred string, score double")
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns],
                      "lang_pred", "score")


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text, modulo 4, is 2 (null id: as empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(4)) == 2


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the documents that are not held out, predict all: (id, held_out, lang_pred, score)."""
    train = docs.where(~held_out(F.col(id_col)))
    profiles = learn(train, F.col(text_col), F.col(lang_col))
    thin = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return predict(thin, profiles, "_text").select(
        F.col(id_col), held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score")
