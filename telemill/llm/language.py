"""Language of a text by rank-order n-gram profiles.

A profile lists a language's most frequent letter n-grams (1 to 3 letters inside a
word, with a mark before and after it), best first. A text's own most frequent
n-grams are ranked the same way, and the language with the smallest sum of
out-of-place distances wins (Cavnar and Trenkle).

Profiles are counted by Spark over a sample of labelled documents bounded by
``SAMPLE`` per language; every document is then ranked over its whole text.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import crc32_mod
from .words import first_of_runs

PROFILE = 400
#: Labelled documents of a language that its profile is counted from.
SAMPLE = 1_000
ORDERS = 3
OUT = "doc_id long, held_out boolean, lang_pred string, score double, distance long, runner_up string"
COUNTED = "lang string, gram long, n long"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """1 for each code point that is a letter, 2 for a mark on one, else 0."""
    table = np.zeros(0x110000, np.int8)
    for c in range(0x110000):
        table[c] = "LM".find(unicodedata.category(chr(c))[0]) + 1
    return table


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text: letters at 21 bits each, 0 for the gap beside a word; none without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    kind = _letters()[points]
    if not (kind == 1).any():
        return np.zeros(0, np.int64)
    letter = kind > 0
    x = np.where(letter, points, 0).astype(np.int64)
    x = np.concatenate([[0], x, [0]])
    x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]
    if len(x) < 3:
        return np.zeros(0, np.int64)
    one = x[1:-1]
    inner = one != 0
    two = (x[:-1] << 21 | x[1:]) + (1 << 62)
    three = x[:-2] << 42 | x[1:-1] << 21 | x[2:]
    return np.concatenate([one[inner], two, three[inner]])


def ranked(text: str, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams of a text, best first; equal counts go by code."""
    g = np.sort(grams(text))
    at = first_of_runs(g)
    n = np.diff(np.append(at, len(g)))
    g = g[at]
    if len(g) > most:  # no n-gram below the count of the last place can be in
        least = np.partition(n, len(n) - most)[len(n) - most]
        g, n = g[n >= least], n[n >= least]
    return g[np.lexsort((g, -n))][:most]


@dataclass
class Profiles:
    langs: list[str]
    grams: np.ndarray  # sorted n-grams of any profile
    ranks: np.ndarray  # rank of each in each language, PROFILE where it has none

    def predict(self, text: str | None):
        """Language, score, distance and second language; score is 1 - distance / largest distance."""
        own = ranked(text) if text else np.zeros(0, np.int64)
        if len(own) == 0 or not self.langs:
            return "und", 0.0, None, None
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        known = self.grams[at] == own
        place = np.arange(len(own))[known]
        rank = self.ranks[at[known]]
        # what a profile lacks is as far away as can be
        apart = np.where(rank == PROFILE, PROFILE, np.abs(rank - place[:, None])).sum(axis=0)
        apart = apart + PROFILE * int((~known).sum())
        order = np.argsort(apart, kind="stable")
        best = order[0]
        score = 1.0 - float(apart[best]) / (PROFILE * len(own))
        second = self.langs[order[1]] if len(order) > 1 else None
        return self.langs[best], min(1.0, max(0.0, score)), int(apart[best]), second


def _count(batches):
    """N-gram counts by language of a partition's documents."""
    for batch in batches:
        by: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by.setdefault(lang, []).append(grams(text))
        for lang, parts in by.items():
            g = np.sort(np.concatenate(parts))
            at = first_of_runs(g)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(g[at]), pa.array(np.diff(np.append(at, len(g))))],
                names=["lang", "gram", "n"],
            )


def fit(docs: DataFrame, folds: int = 3, held: int = 1) -> Profiles:
    """Profiles from text and lang of documents whose crc32(doc_id) modulo ``folds`` isn't ``held``.

    Rows without id, text or lang don't count. Of each language a share that makes
    about ``SAMPLE`` documents is counted, chosen by a hash of the id. The driver
    gets a count and ``PROFILE`` rows per language.
    """
    known = docs.select("doc_id", "text", "lang").filter("text is not null and lang is not null").filter(
        crc32_mod("doc_id", folds) != held
    )
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("k")).collect()
    if not sizes:
        return Profiles([], np.zeros(0, np.int64), np.zeros((0, 1), np.int64))
    size = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], r["k"])))
    u = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.filter(u * F.element_at(size, F.col("lang")) < SAMPLE).select("lang", "text")
    counts = sample.mapInArrow(_count, COUNTED).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("rank", F.row_number().over(best) - 1).filter(F.col("rank") < PROFILE).collect()
    langs = sorted({r["lang"] for r in rows})
    every = np.unique(np.array([r["gram"] for r in rows], np.int64))
    ranks = np.full((len(every), max(1, len(langs))), PROFILE, np.int64)
    for r in rows:
        ranks[np.searchsorted(every, r["gram"]), langs.index(r["lang"])] = r["rank"]
    return Profiles(langs, every, ranks)


def identify(docs: DataFrame, profiles: Profiles, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1), distance and runner_up of every row.

    ``und`` with score 0 for null texts, texts without a letter, and where nothing
    was learned. Equal distances go to the language first in order of name. Columns
    other than doc_id and text are ignored; a null id stays null and isn't held out.
    """
    def run(batches):
        for batch in batches:
            found = [profiles.predict(t.as_py()) for t in batch.column("text")]
            lang, score, apart, second = zip(*found, strict=True) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(apart, pa.int64()), pa.array(second, pa.string())],
                names=[f.split()[0] for f in OUT.split(", ")],
            )

    ready = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(crc32_mod("doc_id", folds) == held, F.lit(False)).alias("held_out"), "text",
    )
    return ready.mapInArrow(run, OUT)
