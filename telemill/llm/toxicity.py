"""Toxicity of documents by a recurrent network over overlapping windows.

A token is read twice: as a word (an embedding, for words seen in training) and as
characters (the mean of its bytes' embeddings, with what follows up to the next
token, so case and punctuation count). A gated recurrent unit reads each window
from either side, attention pools the states, and one logit results. Windows of
``WINDOW`` tokens start every ``STRIDE`` tokens until the text ends; a document has
the largest logit of all its windows, calibrated to a probability.

The network is trained in numpy on the driver, on a sample of labelled documents
bounded by ``SAMPLE``. Only document labels are known, so each pass trains on the
windows that score highest in their document. The model (some hundred kB) goes to
the tasks; scoring is one pass without shuffles and treats every document alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import crc32_mod
from .words import GAP, LOWER, find, slices, utf8, word_hashes

WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM = 8, 6, 6
#: Labelled documents of either class that training may see.
SAMPLE = 1_000
VOCABULARY = 4_000
ROUNDS, BATCH = 6, 128
OUT = "doc_id long, held_out boolean, score double, predicted int, n_windows long"
#: Tokens end at ASCII white space and punctuation, so "idiot!!" is the word "idiot".
SPLIT = GAP.copy()
SPLIT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


class Tokens:
    """Word hashes, characters and windows of a batch of texts."""

    def __init__(self, column):
        data, offsets = utf8(column)
        w = find(data, offsets, SPLIT)
        self.n_docs = len(w.counts)
        self.hashes = word_hashes(w, fold=LOWER)
        self.data, self.starts = data, w.starts
        # characters of a token: up to the next token of the text, or its end
        self.stops = np.append(w.starts[1:], len(data))[: len(w.doc)]
        np.minimum(self.stops, offsets[1:][w.doc], out=self.stops)
        n = w.counts
        per = np.where(n > 0, np.maximum(0, -(-(n - WINDOW) // STRIDE)) + 1, 0)
        self.of = np.repeat(np.arange(self.n_docs), per)
        at = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        self.begin = w.first[:-1][self.of] + at * STRIDE
        self.length = np.minimum(WINDOW, w.first[1:][self.of] - self.begin)
        self.n_windows = per


class Model:
    def __init__(self, vocabulary: np.ndarray, odds: np.ndarray, seed: int = 0):
        """``vocabulary``: sorted hashes; ``odds``: log odds of each, the first dimension at the start."""
        r = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        f = lambda *shape: r.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.vocabulary = vocabulary
        word = r.normal(0, 0.1, (len(vocabulary) + 1, WORD_DIM)).astype(np.float32)
        word[0] = 0
        word[1:, 0] = odds
        self.p = {"word": word, "char": r.normal(0, 0.3, (256, CHAR_DIM)).astype(np.float32)}
        for side in "fb":
            self.p |= {f"w{side}": f(d, 3 * h), f"u{side}": f(h, 3 * h), f"b{side}": np.zeros(3 * h, np.float32)}
            self.p[f"b{side}"][:h] = -1
        self.p |= {"att": f(2 * h, 1)[:, 0], "out": f(2 * h, 1)[:, 0], "bias": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, t: Tokens, lo: int = 0, hi: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Word id and input vector of the tokens from ``lo`` to ``hi``."""
        hashes, starts, stops = t.hashes[lo:hi], t.starts[lo:hi], t.stops[lo:hi]
        ids = np.zeros(len(hashes), np.int64)
        if len(self.vocabulary):
            at = np.searchsorted(self.vocabulary, hashes)
            at[at == len(self.vocabulary)] = 0
            ids = np.where(self.vocabulary[at] == hashes, at + 1, 0)
        x = np.empty((len(ids), WORD_DIM + CHAR_DIM), np.float32)
        x[:, :WORD_DIM] = self.p["word"][ids]
        i = 0
        while i < len(ids):  # sums of bytes in blocks, so that long texts need little memory
            j = max(i + 1, int(np.searchsorted(stops, starts[i] + (1 << 18), "right")))
            rows = self.p["char"][t.data[starts[i] : stops[j - 1]]]
            x[i:j, WORD_DIM:] = np.add.reduceat(rows, starts[i:j] - starts[i], axis=0)
            i = j
        x[:, WORD_DIM:] /= (stops - starts).astype(np.float32)[:, None]
        return ids, x

    def _scan(self, xs, side):
        """States of one direction for inputs already projected, (time, window, 3 * hidden)."""
        h, u = HIDDEN, self.p[f"u{side}"]
        state = np.zeros((xs.shape[1], h), np.float32)
        out, kept = np.empty((len(xs), xs.shape[1], h), np.float32), []
        for k in range(len(xs)) if side == "f" else reversed(range(len(xs))):
            gates = 1 / (1 + np.exp(-(xs[k][:, : 2 * h] + state @ u[:, : 2 * h])))
            z, r = gates[:, :h], gates[:, h:]
            c = np.tanh(xs[k][:, 2 * h :] + (r * state) @ u[:, 2 * h :])
            kept.append((state, z, r, c))
            state = state + z * (c - state)
            out[k] = state
        return out, kept

    def _project(self, x):
        """Gate inputs of all tokens for both directions, with a last row for padding that keeps the state."""
        out = []
        for side in "fb":
            g = np.empty((len(x) + 1, 3 * HIDDEN), np.float32)
            g[:-1] = x @ self.p[f"w{side}"] + self.p[f"b{side}"]
            g[-1] = 0
            g[-1, :HIDDEN] = -40
            out.append(g)
        return out

    def forward(self, proj, begin, length):
        steps = np.arange(int(length.max()))[:, None]
        live = steps < length
        at = np.where(live, begin + steps, len(proj[0]) - 1)
        hf, kf = self._scan(proj[0][at], "f")
        hb, kb = self._scan(proj[1][at], "b")
        h = np.concatenate([hf, hb], axis=2)
        e = np.where(live, h @ self.p["att"], -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tw,twh->wh", a, h)
        return pooled @ self.p["out"] + self.p["bias"][0], (at, live, h, a, pooled, kf, kb)

    def windows(self, t: Tokens, block: int = 1024) -> np.ndarray:
        """Logits of all windows, a block of them and their tokens at a time."""
        logits = np.zeros(len(t.begin), np.float32)
        for i in range(0, len(logits), block):
            begin, length = t.begin[i : i + block], t.length[i : i + block]
            lo, hi = int(begin[0]), int((begin + length).max())
            logits[i : i + block] = self.forward(self._project(self.inputs(t, lo, hi)[1]), begin - lo, length)[0]
        return logits

    def documents(self, t: Tokens) -> np.ndarray:
        """The largest logit of each document; that of no window is the bias alone."""
        out = np.full(t.n_docs, -np.inf, np.float32)
        np.maximum.at(out, t.of, self.windows(t))
        return np.where(np.isneginf(out), np.float32(self.p["bias"][0]), out)

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits.astype(np.float64) + self.shift, -40, 40)))

    def gradients(self, t: Tokens, ids, x, chosen, y, weight):
        """Gradients of the cross entropy of the chosen windows."""
        p, h = self.p, HIDDEN
        proj = self._project(x)
        logit, (at, live, states, a, pooled, kf, kb) = self.forward(proj, t.begin[chosen], t.length[chosen])
        d = (1 / (1 + np.exp(-logit)) - y) * weight / len(y)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"], g["bias"] = pooled.T @ d, np.array([d.sum()], np.float32)
        dpool = d[:, None] * p["out"]
        ds = np.einsum("twh,wh->tw", states, dpool)
        de = a * (ds - (a * ds).sum(axis=0))
        g["att"] = np.einsum("tw,twh->h", de, states)
        dh = a[:, :, None] * dpool + de[:, :, None] * p["att"]
        dx = np.zeros((len(x) + 1, x.shape[1]), np.float32)
        xx = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
        for side, kept, part in (("f", kf, dh[:, :, :h]), ("b", kb, dh[:, :, h:])):
            u, w = p[f"u{side}"], p[f"w{side}"]
            carry = np.zeros((len(d), h), np.float32)
            order = list(range(len(at))) if side == "f" else list(reversed(range(len(at))))
            for n in reversed(range(len(order))):
                k = order[n]
                state, z, r, c = kept[n]
                carry = carry + part[k]
                dz = carry * (c - state) * z * (1 - z)
                dc = carry * z * (1 - c * c)
                drs = dc @ u[:, 2 * h :].T
                dr = drs * state * r * (1 - r)
                dg = np.concatenate([dz, dr, dc], axis=1) * live[k][:, None]
                g[f"u{side}"][:, : 2 * h] += state.T @ dg[:, : 2 * h]
                g[f"u{side}"][:, 2 * h :] += (r * state).T @ dg[:, 2 * h :]
                g[f"b{side}"] += dg.sum(axis=0)
                g[f"w{side}"] += xx[at[k]].T @ dg
                np.add.at(dx, at[k], dg @ w.T)
                carry = carry * (1 - z) + drs * r + dg[:, : 2 * h] @ u[:, : 2 * h].T
        used = np.unique(at[live])
        np.add.at(g["word"], ids[used], dx[used, :WORD_DIM])
        g["word"][0] = 0
        for i in used:
            span = t.data[t.starts[i] : t.stops[i]]
            np.add.at(g["char"], span, dx[i, WORD_DIM:] / len(span))
        return g, logit


def _vocabulary(t: Tokens, first: np.ndarray, y: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of a few of ``docs`` at least that tell the classes apart best, with log odds.

    A few is 1 in 200, and three at least, so that words which only a group of copies
    shares don't stand for a class.
    """
    own = [np.unique(t.hashes[first[r] : first[r + 1]]) for r in docs]
    y = y[docs]
    every, at = np.unique(np.concatenate(own), return_inverse=True)
    n = np.bincount(at, minlength=len(every))
    bad = np.bincount(at, np.repeat(y, [len(x) for x in own]), minlength=len(every))
    odds = np.log((bad + 0.5) / (y.sum() + 1)) - np.log((n - bad + 0.5) / (len(y) - y.sum() + 1))
    rank = np.lexsort((every, -np.abs(odds) * np.sqrt(n)))
    best = np.sort(rank[n[rank] >= max(3, len(y) // 200)][:VOCABULARY])
    return every[best], np.clip(odds[best], -3, 3).astype(np.float32)


def train(texts: list[str | None], toxic: list[int], prior: float | None = None, seed: int = 0) -> Model:
    """Fit a model. ``prior`` is the share of toxic documents to calibrate for, by default the sample's.

    A quarter of the sample, if it has some of either class, is kept from training and
    calibrates the scores.
    """
    y = np.array(toxic, np.float32)
    if len(y) == 0 or y.min() == y.max():
        model = Model(np.zeros(0, np.uint64), np.zeros(0, np.float32))
        share = min(0.99, max(0.01, float(y.mean()) if len(y) else 0.01))
        model.scale, model.shift = 0.0, float(np.log(share / (1 - share)))
        return model
    column = pa.array(texts, pa.large_string())
    t = Tokens(column)
    first = np.searchsorted(t.starts, utf8(column)[1])
    r = np.random.default_rng(seed)
    aside = np.zeros(len(y), bool)
    for label in (0, 1):
        own = r.permutation(np.flatnonzero(y == label))
        aside[own[: len(own) // 4]] = True
    if min(aside[y == 0].sum(), aside[y == 1].sum()) < 5:
        aside[:] = False
    docs = np.flatnonzero(~aside)
    model = Model(*_vocabulary(t, first, y, docs), seed=seed)
    if len(model.vocabulary) == 0:
        model = Model(np.zeros(1, np.uint64), np.zeros(1, np.float32), seed=seed)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.p.items()}
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    step = 0
    for turn in range(ROUNDS):
        if turn == 0:  # by the log odds of their words
            at = np.searchsorted(model.vocabulary, t.hashes)
            at[at == len(model.vocabulary)] = 0
            odds = np.where(model.vocabulary[at] == t.hashes, model.p["word"][at + 1, 0], 0)
            sums = np.concatenate([[0], np.cumsum(np.maximum(odds, 0))])
            logits = sums[t.begin + t.length] - sums[t.begin]
        else:
            logits = model.windows(t)
        order = np.lexsort((logits, t.of))
        last = np.append(t.of[order][1:] != t.of[order][:-1], True)
        top = order[last]
        top = top[~aside[t.of[top]]]
        for _ in range(2):
            for part in np.array_split(r.permutation(top), max(1, len(top) // BATCH)):
                own = _tokens_of(t, part)
                ids, x = model.inputs(own)
                doc = t.of[part]
                g, _ = model.gradients(own, ids, x, np.arange(len(part)), y[doc], weight[doc])
                step += 1
                rate = 0.02 / (1 + turn / 3)
                for k, v in model.p.items():
                    m, s = moment[k]
                    m += 0.1 * (g[k] - m)
                    s += 0.001 * (g[k] ** 2 - s)
                    v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
                    v *= 1 - (1e-3 if k in ("word", "char") else 1e-4) * rate
    logits = model.documents(t).astype(np.float64)
    share = float(y.mean()) if prior is None else prior
    if aside.any():
        logits, y = logits[aside], y[aside]
    _calibrate(model, logits, y, np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean())))
    return model


def _tokens_of(t: Tokens, part: np.ndarray) -> Tokens:
    """The tokens of some windows, as windows of their own."""
    own = object.__new__(Tokens)
    size = t.length[part]
    at = np.repeat(t.begin[part], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    spans = [t.data[a:b] for a, b in zip(t.starts[at], t.stops[at], strict=True)]
    width = np.array([len(s) for s in spans])
    own.data = np.concatenate(spans)
    own.stops = np.cumsum(width)
    own.starts, own.hashes = own.stops - width, t.hashes[at]
    own.begin, own.length = np.cumsum(size) - size, size
    return own


def _calibrate(model: Model, logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
    """Scale and shift of logistic calibration, by Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        d, w = weight * (p - y), weight * p * (1 - p) + 1e-9
        x = np.stack([logits, np.ones_like(logits)])
        hess = (x * w) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, x @ d + 1e-3 * np.array([a - 1, b]))
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    model.scale, model.shift = max(float(a), 1e-3), float(b)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> Model:
    """Train on ``labels.toxic`` of documents whose crc32(doc_id) modulo ``folds`` isn't ``held``.

    Of each class a share that makes about ``SAMPLE`` documents, chosen by a hash of
    the id, goes to the driver. Rows without id, text or label don't count, labels
    other than 0 count as toxic, and of several labels of an id the largest holds.
    """
    known = (
        labels.filter("toxic is not null").groupBy("doc_id")
        .agg(F.max((F.col("toxic") != 0).cast("int")).alias("y"))
        .filter(crc32_mod("doc_id", folds) != held)
    )
    counts = {int(r["y"]): r["k"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("k")).collect()}
    if len(counts) < 2:
        return train([], [])
    share = F.when(F.col("y") == 1, min(1.0, SAMPLE / counts[1])).otherwise(min(1.0, SAMPLE / counts[0]))
    # about 2 * SAMPLE ids at any input size, so they may be broadcast
    u = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.filter(u < share).select(F.col("doc_id").alias("_id"), "y")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "y").filter("text is not null").distinct()
    sample = sorted((tuple(r) for r in rows.collect()))
    return train([r[1] for r in sample], [r[2] for r in sample], counts[1] / (counts[0] + counts[1]))


def _scores(model: Model, column):
    """Score and window count of every text, about a MB of text at a time."""
    score, windows = [], []
    for _, part in slices(column):
        t = Tokens(part)
        score.append(model.probability(model.documents(t)))
        windows.append(t.n_windows)
    return np.concatenate([np.zeros(0), *score]), np.concatenate([np.zeros(0, np.int64), *windows])


def score(docs: DataFrame, model: Model, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (score >= 0.5) and n_windows of every row.

    All windows of the whole text are read. Null and empty texts, and texts without a
    token, have no window and get the calibrated bias of the network. Equal texts
    get equal scores, up to single precision. Columns other than doc_id and text are ignored; a null id stays
    null and isn't held out. No rows give no rows.
    """
    def run(batches):
        for batch in batches:
            s, n = _scores(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(n)],
                names=[f.split()[0] for f in OUT.split(", ")],
            )

    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(crc32_mod("doc_id", folds) == held, F.lit(False)).alias("held_out"), "text")
    return ready.mapInArrow(run, OUT)


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that aren't predicted toxic."""
    def run(batches):
        for batch in batches:
            s, _ = _scores(model, batch.column("text"))
            yield batch.filter(pa.array(s < 0.5))

    return docs.mapInArrow(run, docs.schema)
