"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent n-grams, most frequent first. A document's
profile is compared with every language's by the out-of-place distance: for
each of the document's n-grams how far its rank is from the rank it has in the
language, the largest possible distance if it is not there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import column_of, crc32_of_id, slices, table, text_of

# N-grams of one to three characters; ranks a profile holds.
LONGEST = 3
PROFILE = 400
# First picked within this many shares of a language's n-grams, then among those.
SHARES = 64
HELD_OUT, FOLDS = 0, 5
# Texts whose n-grams are counted together; each byte of them takes some 70 meanwhile.
LEARNED_BYTES = 1 << 19
UNKNOWN = "und"

# Characters are packed 21 bits each, the last one lowest; 1 is the border of a word,
# so that a border and a letter are not the letter alone.
_BITS, _BORDER = 21, 1


def codes_of(text: str) -> np.ndarray:
    """Letters of the lower-cased text as code points, runs of other characters as one border."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    kinds, where = np.unique(points, return_inverse=True)
    letter = np.array([chr(p).isalpha() for p in kinds.tolist()], bool)[where]
    codes = np.where(letter, points, _BORDER).astype(np.uint64)
    if not letter.any():
        return codes[:0]
    codes = np.concatenate(([np.uint64(_BORDER)], codes, [np.uint64(_BORDER)]))
    return codes[(codes > _BORDER) | np.concatenate(([True], codes[:-1] > _BORDER))]


def grams_of(codes: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """All n-grams of a code row, but those of borders alone."""
    out, now = [codes[codes > _BORDER]], codes
    for n in range(2, longest + 1):
        if len(codes) < n:
            break
        now = (now[:-1] << np.uint64(_BITS)) | codes[n - 1:]
        out.append(now)
    return np.concatenate(out)


def ranked(grams: np.ndarray, profile: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by the n-gram itself."""
    kinds, n = np.unique(grams, return_counts=True)
    if len(kinds) > profile:
        # All that may be among the first, ties at the edge included.
        edge = np.partition(n, len(n) - profile)[len(n) - profile]
        keep = n >= edge
        kinds, n = kinds[keep], n[keep]
    return kinds[np.argsort(-n, kind="stable")][:profile]


@dataclass
class Profiles:
    """Language names, all their n-grams in order, and the rank of each in each language."""

    names: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    profile: int

    @classmethod
    def of(cls, rows: list[tuple[str, int, int]], profile: int = PROFILE) -> Profiles:
        """From (language, n-gram, rank)."""
        names = sorted({r[0] for r in rows})
        grams = np.unique(np.array([r[1] for r in rows], np.uint64))
        ranks = np.full((len(grams) + 1, len(names)), profile, np.int32)
        at = np.searchsorted(grams, np.array([r[1] for r in rows], np.uint64))
        column = {name: i for i, name in enumerate(names)}
        for place, (name, _, rank) in zip(at.tolist(), rows):
            ranks[place, column[name]] = rank
        return cls(names, grams, ranks, profile)

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language, the first by name on a tie, and how near it is, 0 to 1."""
        codes = codes_of(text)
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(grams_of(codes), self.profile)
        at = np.searchsorted(self.grams, own)
        found = np.append(self.grams, np.uint64(0))[at] == own
        theirs = self.ranks[np.where(found, at, len(self.grams))]
        place = np.arange(len(own), dtype=np.int32)[:, None]
        distance = np.where(theirs == self.profile, self.profile, np.abs(theirs - place)).sum(0)
        best = int(distance.argmin())
        return self.names[best], 1 - float(distance[best]) / (self.profile * len(own))


def training(docs: DataFrame) -> DataFrame:
    """The rows profiles may be learned from: a language is given, the fold is not held out."""
    return docs.where(F.col("lang").isNotNull() & (fold() != HELD_OUT))


def fold():
    return crc32_of_id("doc_id") % FOLDS


def learn(docs: DataFrame, profile: int = PROFILE) -> list[tuple[str, int, int]]:
    """(language, n-gram, rank) of every language in ``docs``, from all its texts.

    N-grams are counted where the texts are, the counts summed by Spark. What
    comes back is ``profile`` rows a language, whatever the corpus size.
    """
    def count(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            texts, langs = column_of(batch, "text"), column_of(batch, "lang").to_pylist()
            for a, b in slices(texts, LEARNED_BYTES):
                by: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(langs[a:b], texts.slice(a, b - a).to_pylist()):
                    by.setdefault(lang, []).append(grams_of(codes_of(text)))
                for lang, rows in by.items():
                    found = np.unique(np.concatenate(rows), return_counts=True)
                    held[lang] = _merged(held.get(lang), found)
                    if len(held[lang][0]) > 1 << 18:
                        yield _counted(lang, *held.pop(lang))
        for lang, found in held.items():
            yield _counted(lang, *found)

    rows = training(docs).select(text_of().alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = (rows.mapInArrow(count, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    first = [F.desc("n"), "gram"]
    share = F.pmod(F.xxhash64("gram"), F.lit(SHARES))
    near = counts.withColumn("share", share).withColumn("at", F.row_number().over(
        Window.partitionBy("lang", "share").orderBy(*first))).where(F.col("at") <= profile)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*first)) - 1
    top = near.withColumn("rank", rank).where(F.col("rank") < profile)
    return [tuple(r) for r in top.select("lang", "gram", "rank").orderBy("lang", "rank").collect()]


def _merged(a, b):
    if a is None:
        return b
    kinds, where = np.unique(np.concatenate((a[0], b[0])), return_inverse=True)
    return kinds, np.bincount(where, np.concatenate((a[1], b[1]))).astype(np.int64)


def _counted(lang: str, grams: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(n), pa.string()), pa.array(grams.astype(np.int64)),
         pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


def identify(docs: DataFrame, profiles: list[tuple[str, int, int]],
             column: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score appended; the texts alone decide.

    ``und`` with score 0 if the text is null or has no letter, or if nothing was
    learned. Columns of these names are replaced; repeated rows stay repeated.
    """
    model = Profiles.of(profiles)

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts):
        import pandas as pd

        return pd.DataFrame([model.predict(t) if t else (UNKNOWN, 0.0) for t in texts],
                            columns=["lang_pred", "score"])

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, guess(F.col(f"`{column}`")).alias("__guess")).select(
        *kept, F.col("__guess.lang_pred").alias("lang_pred"),
        F.col("__guess.score").alias("score"))


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is in some language, all their columns.

    Rejected are texts that are null or have no letter, and those that share
    no n-gram with any profile (score 0).
    """
    rows = docs.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns])
                       .alias("row"))
    judged = identify(rows, learn(docs))
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0)).select("row.*")


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text", (fold() == HELD_OUT).alias("held_out"))
    return identify(rows, learn(docs)).select("doc_id", "held_out", "lang_pred", "score")
