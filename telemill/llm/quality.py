"""Quality of documents by co-training on two views.

One classifier sees the text (shape of words, lines and characters, repetition), the
other what is known about the page (source, language, stated length). Both start
from the labelled documents; each round either one names the unlabelled documents
of which it is surest, and those become examples for the other. In the end each view
is calibrated on labelled documents kept aside, and a last logistic regression over
both calibrated logits scores every document.

Training runs in numpy on feature rows of a bounded sample. Features and scores of
all documents are made in one pass without shuffles.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, scratch
from .tables import crc32_mod, ships_package
from .words import first_of_runs, slices, word_hashes, words_of

#: Labelled documents of either class that training may see.
SAMPLE = 2_000
ROUNDS = 8
#: Unlabelled documents that a view names per round, of all there are, and how sure it has to be.
NAMED, SURE = 80, 0.9
BUCKETS = 48
TEXT, META = 13, BUCKETS + 9
OUT = "doc_id long, held_out boolean, score double, predicted int, text_score double, page_score double"


def _table(test) -> np.ndarray:
    return np.array([test(c) for c in range(256)])


UPPER = _table(lambda c: 65 <= c <= 90)
LETTER = _table(lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128)
DIGIT = _table(lambda c: 48 <= c <= 57)
MARK = _table(lambda c: 33 <= c < 127 and not chr(c).isalnum())
ODD = _table(lambda c: chr(c) in "|!<>{}[]#*=_~^\\@$%&+")
HIGH = _table(lambda c: c >= 128)
NEWLINE = _table(lambda c: c == 10)


def text_features(column) -> np.ndarray:
    """A row of ``TEXT`` numbers for each text; a text without words has zeros."""
    parts = [np.zeros((0, TEXT))]
    for _, part in slices(column):
        w = words_of(part)
        n = w.counts.astype(float)
        some = np.maximum(n, 1)
        first = w.first
        hashes = word_hashes(w)
        x = np.zeros((len(n), TEXT))
        sums = {}
        edges = np.concatenate([[0], np.flatnonzero(np.diff(w.doc)) + 1]) if len(w.doc) else np.zeros(0, np.int64)
        at = w.doc[edges] if len(edges) else edges
        for name, flags in (("upper", UPPER), ("letter", LETTER), ("digit", DIGIT), ("mark", MARK), ("odd", ODD), ("high", HIGH)):
            if len(edges):
                total = np.concatenate([[0], np.cumsum(flags[w.data])])
                own = np.zeros(len(n))
                last = np.append(edges[1:], len(w.starts)) - 1
                own[at] = total[w.ends[last]] - total[w.starts[edges]]
                sums[name] = own
            else:
                sums[name] = np.zeros(len(n))
        size = np.bincount(w.doc, (w.ends - w.starts).astype(float), minlength=len(n))
        x[:, 0] = np.log1p(n)
        x[:, 1] = size / some
        for k, name in enumerate(("upper", "letter", "digit", "mark", "odd", "high"), 2):
            x[:, k] = sums[name] / np.maximum(size, 1)
        same = np.zeros(len(hashes), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
        x[:, 8] = np.bincount(w.doc, same, minlength=len(n)) / some
        single = w.ends - w.starts == 1
        x[:, 9] = np.bincount(w.doc, single, minlength=len(n)) / some
        for r in np.flatnonzero(n > 0):
            h = np.sort(hashes[first[r] : first[r + 1]])
            runs = np.diff(np.append(first_of_runs(h), len(h)))
            x[r, 10] = len(runs) / len(h)
            x[r, 11] = runs.max() / len(h)
        lines = np.concatenate([[0], np.cumsum(NEWLINE[w.data])])
        if len(edges):
            x[at, 12] = np.log1p((lines[w.ends[last]] - lines[w.starts[edges]]) / some[at])
        parts.append(x)
    return np.concatenate(parts)


def page_features(source, lang, n_chars) -> np.ndarray:
    """A row of ``META`` numbers from source, lang and n_chars; nulls have features of their own."""
    x = np.zeros((len(source), META))
    for r, (s, g, n) in enumerate(zip(source.to_pylist(), lang.to_pylist(), n_chars.to_pylist(), strict=True)):
        x[r, BUCKETS - 1 if s is None else zlib.crc32(s.encode()) % (BUCKETS - 1)] = 1
        x[r, BUCKETS + (7 if g is None else zlib.crc32(g.encode()) % 7)] = 1
        x[r, BUCKETS + 8] = 0.0 if n is None else np.log1p(max(0, n))
    return x


@dataclass
class Logistic:
    mean: np.ndarray
    spread: np.ndarray
    weight: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return self.scale * (z @ self.weight[:-1] + self.weight[-1]) + self.shift


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> Logistic:
    """Ridge logistic regression by Newton steps."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.hstack([np.clip((x - mean) / spread, -8, 8), np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    keep = ridge * np.append(np.ones(x.shape[1]), 1e-3)
    for _ in range(25):
        p = sigmoid(z @ w)
        step = np.linalg.solve((z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(keep), z.T @ (weight * (p - y)) + keep * w)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, spread, w)


@dataclass
class CoTrained:
    text: Logistic | None
    page: Logistic | None
    both: Logistic | None
    share: float

    def score(self, text: np.ndarray, page: np.ndarray):
        """Combined, text and page probability of good quality."""
        if self.both is None:
            same = np.full(len(text), self.share)
            return same, same, same
        a, b = self.text.logit(text), self.page.logit(page)
        return sigmoid(self.both.logit(np.stack([a, b], axis=1))), sigmoid(a), sigmoid(b)


@dataclass
class ArrayPool:
    """Unlabelled rows of both views, held here."""

    views: list[np.ndarray]

    def surest(self, models, taken: set[bytes], most: int) -> dict[tuple[int, int], list[tuple[float, bytes]]]:
        x = np.hstack(self.views)
        return _surest(x, [r.tobytes() for r in x], self.views, models, taken, most)


@dataclass
class TablePool:
    """Unlabelled rows as a table of packed features (``x``), however many."""

    rows: DataFrame

    def surest(self, models, taken: set[bytes], most: int) -> dict[tuple[int, int], list[tuple[float, bytes]]]:
        """Every task finds its surest rows; of these, a few for each task, the surest are kept."""

        def run(batches):
            best: dict[tuple[int, int], list] = {}
            for batch in batches:
                raw = batch.column("x").to_pylist()
                x = np.frombuffer(b"".join(raw)).reshape(len(raw), TEXT + META)
                for kind, found in _surest(x, raw, [x[:, :TEXT], x[:, TEXT:]], models, taken, most).items():
                    best[kind] = _first(best.get(kind, []) + found, most)
            rows = [(v, lab, s, r) for (v, lab), found in best.items() for s, r in found]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            types = [pa.int32(), pa.int32(), pa.float64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["view", "label", "sure", "x"])

        found = self.rows.mapInArrow(run, "view int, label int, sure double, x binary").distinct()
        place = F.row_number().over(W.partitionBy("view", "label").orderBy(F.desc("sure"), "x"))
        out: dict[tuple[int, int], list] = {}
        for r in found.withColumn("_at", place).filter(F.col("_at") <= most).collect():
            out.setdefault((r["view"], r["label"]), []).append((r["sure"], bytes(r["x"])))
        return {k: _first(v, most) for k, v in out.items()}


def _first(found: list[tuple[float, bytes]], most: int) -> list[tuple[float, bytes]]:
    """The surest different rows; equally sure ones in order of their features."""
    return sorted(set(found), key=lambda f: (-f[0], f[1]))[:most]


def _surest(x, raw, views, models, taken, most) -> dict[tuple[int, int], list[tuple[float, bytes]]]:
    """By view and label, the rows that the view's model is surest of, without those taken."""
    out = {}
    for own, view in enumerate(views):
        p = sigmoid(models[own].logit(view))
        for label, sure in ((1, p), (0, 1 - p)):
            # equal rows stand for one, so all that are sure enough are looked through
            at = np.flatnonzero(sure >= SURE)
            out[own, label] = _first([(float(sure[i]), raw[i]) for i in at.tolist() if raw[i] not in taken], most)
    return out


def co_train(views: list[np.ndarray], y: np.ndarray, pool, weight: np.ndarray | None = None) -> CoTrained:
    """Train from labelled rows of both views and an unlabelled ``pool`` (``ArrayPool``, ``TablePool``) of both.

    In a round each view's model names the rows of the whole pool that it is surest of, at most ``NAMED``
    in the proportion of the labels, and they train the other view.
    """
    if len(y) == 0 or y.min() == y.max():
        return CoTrained(None, None, None, float(y.mean()) if len(y) else 0.5)
    weight = np.ones(len(y)) if weight is None else weight
    aside = np.arange(len(y)) % 4 == 0  # for calibration
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        aside = np.ones(len(y), bool)
        train = aside
    else:
        train = ~aside
    known = [(v[train], y[train].astype(float), weight[train]) for v in views]
    split = views[0].shape[1]
    taken: set[bytes] = set()
    models: list[Logistic] = [logistic(*k) for k in known]
    for _ in range(ROUNDS):
        gained = False
        # enough for each, whatever the others take first
        surest = pool.surest(models, taken, 2 * NAMED + 4)
        for own, other in ((0, 1), (1, 0)):
            for label in (1, 0):
                most = max(1, int(NAMED * (y.mean() if label else 1 - y.mean())))
                found = [f for f in surest.get((own, label), []) if f[1] not in taken][:most]
                if found:
                    rows = np.stack([np.frombuffer(r) for _, r in found])
                    part = rows[:, split:] if other else rows[:, :split]
                    x, t, w = known[other]
                    sure = np.array([s for s, _ in found])
                    known[other] = (np.vstack([x, part]), np.append(t, np.full(len(found), float(label))), np.append(w, sure * 0.5))
                    taken |= {r for _, r in found}
                    gained = True
        models = [logistic(*k) for k in known]
        if not gained:
            break
    z, w = y[aside].astype(float), weight[aside]
    for view, model in zip(views, models, strict=True):
        line = logistic(model.logit(view[aside])[:, None], z, w, ridge=1e-2)
        slope = line.weight[0] / line.spread[0]
        model.scale, model.shift = float(slope), float(line.weight[1] - slope * line.mean[0])
    logits = np.stack([m.logit(v[aside]) for m, v in zip(models, views, strict=True)], axis=1)
    return CoTrained(models[0], models[1], logistic(logits, z, w, ridge=1e-1), float(y.mean()))


def _ready(docs: DataFrame) -> DataFrame:
    """The columns that both views read; a missing column counts as null."""
    have = {c.lower() for c in docs.columns}
    pick = lambda name, kind: (F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)).alias(name)
    return docs.select(pick("doc_id", "long"), pick("text", "string"), pick("source", "string"), pick("lang", "string"), pick("n_chars", "double"))


def _features(batches):
    for batch in batches:
        x = np.hstack([text_features(batch.column("text")), page_features(*(batch.column(c) for c in ("source", "lang", "n_chars")))])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("y"), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "y", "x"]
        )


@ships_package
def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> CoTrained:
    """Co-train from ``labels.quality`` of documents whose crc32(doc_id) modulo ``folds`` isn't ``held``.

    About ``SAMPLE`` labelled documents of each class, chosen by a hash of the id, come to the
    driver as features. Pseudo-labels are looked for among all documents of other folds
    without a usable label; of these the driver gets the few that a round names. Rows without
    id or label don't count; labels other than 0 count as good, and of several labels of an
    id the smallest holds.
    """
    known = (
        labels.filter("quality is not null").groupBy("doc_id")
        .agg(F.min((F.col("quality") != 0).cast("int")).alias("y"))
        .filter(crc32_mod("doc_id", folds) != held)
    )
    counts = {int(r["y"]): r["k"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("k")).collect()}
    if len(counts) < 2:
        return co_train([np.zeros((0, TEXT)), np.zeros((0, META))], np.zeros(0), None)
    u = lambda c: F.pmod(F.xxhash64(c, F.lit(13)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.when(F.col("y") == 1, min(1.0, SAMPLE / counts[1])).otherwise(min(1.0, SAMPLE / counts[0]))
    # about 2 * SAMPLE ids at any input size, so they may be broadcast
    chosen = known.filter(u("doc_id") < share).select(F.col("doc_id").alias("_id"), "y")
    ready = _ready(docs)
    named = ready.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).drop("_id")
    kind = "doc_id long, y int, x binary"
    # of documents without a usable label, whatever the reason; held-out ones stay out. Labels
    # are joined with features, not with texts, which are some five times as long
    pool = ready.filter(crc32_mod("doc_id", folds) != held).withColumn("y", F.lit(None).cast("int"))
    pool = pool.mapInArrow(_features, kind).join(known.select("doc_id"), "doc_id", "left_anti")
    rows = named.mapInArrow(_features, kind).distinct().collect()
    rows = sorted(((r["doc_id"], r["y"], bytes(r["x"])) for r in rows))
    x = np.array([np.frombuffer(r[2]) for r in rows]).reshape(len(rows), TEXT + META)
    y = np.array([r[1] for r in rows], np.int64)
    prior = {k: counts[k] / (counts[0] + counts[1]) for k in (0, 1)}
    got = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    weight = np.array([prior[k] * len(y) / got[k] for k in y])
    with scratch(docs.sparkSession):
        free = materialize(pool.select("x"), "page-features")
        return co_train([x[:, :TEXT], x[:, TEXT:]], y, TablePool(free), weight)


@ships_package
def score(docs: DataFrame, model: CoTrained, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher is better), predicted, text_score, page_score of every row.

    ``docs``: ``doc_id``, ``text`` and, where they exist, ``source``, ``lang`` and
    ``n_chars``; other columns are ignored. Nulls are features like any other; a text
    without words is judged by its page. Equal rows get equal scores. A null id stays
    null and isn't held out. No rows give no rows.
    """
    def run(batches):
        for batch in batches:
            p, a, b = model.score(text_features(batch.column("text")), page_features(*(batch.column(c) for c in ("source", "lang", "n_chars"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(a), pa.array(b)],
                names=[f.split()[0] for f in OUT.split(", ")],
            )

    ready = _ready(docs).withColumn("held_out", F.coalesce(crc32_mod("doc_id", folds) == held, F.lit(False)))
    return ready.mapInArrow(run, OUT)
