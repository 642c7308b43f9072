"""LM scoring by masked pseudo-likelihood.

Tokens are the UTF-8 bytes of a text.  A small network predicts each token
from the two before and the two after it (beyond a text's ends: a pad of 0);
the sum of log P(token | both sides) scores the document.

Network (numpy): an embedding per place of the window, concatenated; one tanh
layer; softmax over the 256 tokens.

Training is data-parallel over all documents.  Tasks count the distinct
windows of their texts, Spark sums the counts (so what is gathered grows with
the corpus), and the counted windows are dealt by context.  In each round every
task starts from the broadcast weights, takes Adam steps over its share in
mini-batches, and returns its weights; their mean, weighted by tokens, starts
the next round.  Weights are of fixed size (some 150 KB) and there are at most
``TRAIN_TASKS`` of them, so the driver holds a bounded amount.

Scoring is a narrow pass: windows that a task has met before are looked up in
a bounded cache, new ones go through the network.

Null and empty texts: 0 tokens, sum 0.0, mean null.  Repeated rows score alike.
With no text at all to train on, the untrained network gives every token
1/256.  Very long texts are worked on in overlapping pieces of a bounded size;
their sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.llm import textops as T
from popcorr.session import cut_lineage

RADIUS, EMBED, HIDDEN, VOCAB = 2, 12, 48, 256
ROUNDS, PASSES, STEP, BATCH, TRAIN_TASKS = 4, 2, 0.004, 256, 24
#: Distinct windows that a task holds: counted, or with their log-probabilities.
TASK_WINDOWS, PIECE = 1_000_000, 1 << 20


# ── the network ──────────────────────────────────────────────────────────────
def initial(seed: int = 7) -> list[np.ndarray]:
    """[embeddings (place, token, embed), W1, b1, W2, b2]; the last layer starts at 0, so at first all tokens are equal."""
    rng = np.random.default_rng(seed)
    wide = 2 * RADIUS * EMBED
    return [rng.normal(0, 0.3, (2 * RADIUS, VOCAB, EMBED)).astype(np.float32),
            rng.normal(0, wide ** -0.5, (wide, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
            np.zeros((HIDDEN, VOCAB), np.float32), np.zeros(VOCAB, np.float32)]


def split_context(context: np.ndarray) -> np.ndarray:
    """The four bytes of packed contexts, outermost left first."""
    return np.stack([(context >> s) & 255 for s in range(8 * (2 * RADIUS - 1), -1, -8)], 1)


def forward(p: list[np.ndarray], places: np.ndarray):
    x = p[0][np.arange(2 * RADIUS), places].reshape(len(places), -1)
    h = np.tanh(x @ p[1] + p[2])
    z = h @ p[3] + p[4]
    z -= z.max(axis=1, keepdims=True)
    np.subtract(z, np.log(np.exp(z).sum(axis=1, keepdims=True)), out=z)
    return x, h, z


def gradients(p: list[np.ndarray], places: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Of the mean negative log-probability; counts (context, token) weigh the tokens."""
    x, h, z = forward(p, places)
    weight = counts.sum(axis=1, keepdims=True)
    dz = (np.exp(z) * weight - counts) / weight.sum()
    dh = (dz @ p[3].T) * (1 - h * h)
    dx = (dh @ p[1].T).reshape(len(places), 2 * RADIUS, EMBED)
    de = np.zeros_like(p[0])
    for k in range(2 * RADIUS):
        np.add.at(de[k], places[:, k], dx[:, k])
    return [de, x.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0)]


class Adam:
    def __init__(self, p: list[np.ndarray], step: float):
        self.p, self.step, self.t = [a.copy() for a in p], step, 0
        self.m, self.v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]

    def update(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        rate = self.step * (1 - 0.999 ** self.t) ** 0.5 / (1 - 0.9 ** self.t)
        for a, m, v, g in zip(self.p, self.m, self.v, grads):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= rate * m / (np.sqrt(v) + 1e-8)


def pack(p: list[np.ndarray]) -> bytes:
    return np.concatenate([a.ravel() for a in p]).astype(np.float32).tobytes()


def unpack(raw: bytes | np.ndarray) -> list[np.ndarray]:
    flat = np.frombuffer(raw, np.float32) if isinstance(raw, bytes) else raw
    out, at = [], 0
    for a in initial():
        out.append(flat[at:at + a.size].reshape(a.shape).copy())
        at += a.size
    return out


# ── windows of texts ─────────────────────────────────────────────────────────
def windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte: context of four bytes, then the byte itself, as one number."""
    n = len(data)
    place = np.arange(n, dtype=np.int64) + RADIUS * (1 + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)))
    padded = np.zeros(n + RADIUS * (len(offsets) + 1), np.int64)
    padded[place] = data
    code = np.zeros(n, np.int64)
    for d in [*range(-RADIUS, 0), *range(1, RADIUS + 1), 0]:
        code = (code << 8) | padded[place + d]
    return code


def pieces(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, windows, offsets) in runs of a bounded size; a long text comes in several pieces of its row."""
    for start, _, data, offsets in T.slices(texts, PIECE):
        if len(data) <= 2 * PIECE:
            yield start, windows(data, offsets), offsets
            continue
        for a in range(0, len(data), PIECE):             # one long text: pieces with what stands around them
            lo, hi = max(0, a - RADIUS), min(len(data), a + PIECE + RADIUS)
            code = windows(data[lo:hi], np.array([0, hi - lo]))
            stop = min(a + PIECE, len(data))
            yield start, code[a - lo:stop - lo], np.array([0, stop - a])


def _fold(value: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(value, kind="stable")
    value, n = value[order], n[order]
    at = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
    return value[at], np.add.reduceat(n, at)


def count_windows(texts: DataFrame) -> DataFrame:
    """(context, token, n) over all texts; equal windows are added up in the tasks before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows(value, n):
            return pa.RecordBatch.from_arrays([pa.array(value >> 8), pa.array((value & 255).astype(np.int32)), pa.array(n, pa.int64())],
                                              ["context", "token", "n"])

        for b in batches:
            for _, code, _ in pieces(b.column(0)):
                if not len(code):
                    continue
                code = np.sort(code)
                at = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
                held.append((code[at], np.diff(np.append(at, len(code)))))
                size += len(at)
                if size > 2 * TASK_WINDOWS:
                    held = [_fold(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))]
                    size = len(held[0][0])
                    if size > TASK_WINDOWS:
                        yield rows(*held[0])
                        held, size = [], 0
        if held:
            yield rows(*_fold(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])))

    return texts.mapInArrow(count, "context bigint, token int, n bigint").groupBy("context", "token").agg(F.sum("n").alias("n"))


def train(texts: DataFrame, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Weights after ``rounds`` of data-parallel training over all texts."""
    sc = texts.sparkSession.sparkContext
    dealt = cut_lineage(count_windows(texts).repartition(TRAIN_TASKS, F.pmod(F.xxhash64("context"), F.lit(TRAIN_TASKS)))
                        .sortWithinPartitions(F.xxhash64("context"), "context", "token"), "lm_windows")
    weights = initial()
    for r in range(rounds):
        start = sc.broadcast(pack(weights))

        def learn(batches: Iterator[pa.RecordBatch], start=start, step=STEP / (1 + r)) -> Iterator[pa.RecordBatch]:
            model, seen = Adam(unpack(start.value), step), 0
            for b in batches:
                context, token, n = (b.column(i).to_numpy() for i in range(3))
                at = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
                group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(context))))
                for k in [*range(0, len(at), BATCH)] * PASSES:
                    lo, hi = at[k], at[k + BATCH] if k + BATCH < len(at) else len(context)
                    m = min(BATCH, len(at) - k)
                    counts = np.zeros((m, VOCAB), np.float32)
                    counts[group[lo:hi] - k, token[lo:hi]] = n[lo:hi]
                    model.update(gradients(model.p, split_context(context[at[k:k + m]]), counts))
                seen += int(n.sum())
            if seen:
                part = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([seen]), pa.array([pack(model.p)], pa.binary())],
                                                 ["part", "seen", "weights"])

        found = sorted(dealt.mapInArrow(learn, "part long, seen long, weights binary").collect())
        if not found:
            break
        total = sum(f[1] for f in found)
        weights = unpack(sum(np.frombuffer(f[2], np.float32).astype(np.float64) * (f[1] / total) for f in found).astype(np.float32))
    return weights


class Scores:
    """Log-probabilities of windows, with a bounded cache of those met before."""

    def __init__(self, weights: list[np.ndarray]):
        self.p = weights
        self.known, self.value = np.zeros(0, np.int64), np.zeros(0, np.float32)

    def compute(self, code: np.ndarray) -> np.ndarray:
        """Of sorted distinct windows: each context goes through the network once."""
        out = np.empty(len(code), np.float32)
        context = code >> 8
        at = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
        group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(code))))
        for k in range(0, len(at), 4096):
            lo, hi = at[k], at[k + 4096] if k + 4096 < len(at) else len(code)
            z = forward(self.p, split_context(context[at[k:k + 4096]]))[2]
            out[lo:hi] = z[group[lo:hi] - k, code[lo:hi] & 255]
        return out

    def __call__(self, code: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(code, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        old = self.known[at] == distinct if len(self.known) else np.zeros(len(distinct), bool)
        value = np.empty(len(distinct), np.float32)
        value[old] = self.value[at[old]] if old.any() else 0
        new = distinct[~old]
        if len(new):
            value[~old] = fresh = self.compute(new)
            if len(self.known) + len(new) > 2 * TASK_WINDOWS:
                self.known, self.value = new, fresh
            else:
                both = np.concatenate((self.known, new))
                order = np.argsort(both, kind="stable")
                self.known, self.value = both[order], np.concatenate((self.value, fresh))[order]
        return value[back]


def score(docs: DataFrame, weights: list[np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, log_likelihood, mean_log_prob) of every document; a narrow pass."""
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(pack(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Scores(unpack(model.value))
        for b in batches:
            n, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.float64)
            for start, code, offsets in pieces(b.column(1)):
                sums = np.concatenate(([0.0], np.cumsum(look(code).astype(np.float64)))) if len(code) else np.zeros(1)
                rows = slice(start, start + len(offsets) - 1)
                n[rows] += np.diff(offsets)
                total[rows] += np.diff(sums[offsets])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(total)], ["id", "n_tokens", "log_likelihood"])

    kind = thin.schema["id"].dataType.simpleString()
    out = thin.mapInArrow(run, f"id {kind}, n_tokens bigint, log_likelihood double")
    return out.select(F.col("id").alias(id_col), "n_tokens", "log_likelihood",
                      F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_prob"))


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on all documents, score all documents."""
    return score(docs, train(docs.select(F.col(text_col).alias("text"))), id_col, text_col)
