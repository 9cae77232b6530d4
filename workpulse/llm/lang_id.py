"""Language identification by a bidirectional gated recurrent network over bytes.

Each direction is a recurrent layer with one gate: from the byte's row of a
table and the last state h, f = sigmoid(g_f + (hU)_f), c = tanh(g_c + f (hU)_c)
and h' = h + f (c - h). A softmax over both directions' states labels every
byte; a document's probabilities are the mean over all of its bytes.

Training is numpy backpropagation through time on the driver, over a sample
of labelled rows of fixed size: ``SAMPLE_PER_LANGUAGE`` windows for each
language, picked by a hash of the id at a hashed place of the whole text.
Prediction covers whole texts: each is read in windows of ``WINDOW`` bytes
(the last one reaches back so that it is full, and only its new bytes count),
many windows at a time, in one pass without a shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score
0; so is every text if there is nothing to learn from. Rows without an id are
predicted, never learned from, and not held out. Repeated rows each get a row;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import table

#: Bound of the training sample: windows per language, and their characters.
SAMPLE_PER_LANGUAGE = 600
SAMPLE_CHARS = 96
MAX_LANGUAGES = 500
HIDDEN = 8
WINDOW = 256
#: Windows that are read together.
TOGETHER = 2048
TRAIN_BYTES = 64
STEPS = 260
UNKNOWN = "und"


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


@dataclass
class Model:
    """Weights: per direction a byte table (256, 2H) and a matrix U (H, 2H); head (2H, K) and bias."""

    languages: list[str]
    p: dict[str, np.ndarray]

    @classmethod
    def start(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Model:
        r = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p[f"W{d}"] = r.normal(0, 0.5, (256, 2 * hidden))
            p[f"U{d}"] = r.normal(0, 0.4, (hidden, 2 * hidden))
        p["V"], p["c"] = r.normal(0, 0.3, (2 * hidden, len(languages))), np.zeros(len(languages))
        return cls(languages, {k: v.astype(np.float32) for k, v in p.items()})

    def states(self, x: np.ndarray, d: str, keep: bool = False):
        """States after each step, (L, B, H), of bytes x (L, B); with what backpropagation needs if ``keep``."""
        W, U = self.p[f"W{d}"], self.p[f"U{d}"]
        H = len(U)
        h = np.zeros((x.shape[1], H), dtype=np.float32)
        out, kept = np.empty((*x.shape, H), dtype=np.float32), []
        for t in range(len(x)):
            g, q = W[x[t]], h @ U
            f = sigmoid(g[:, :H] + q[:, :H])
            c = np.tanh(g[:, H:] + f * q[:, H:])
            if keep:
                kept.append((h, q, f, c))
            h = h + f * (c - h)
            out[t] = h
        return (out, kept) if keep else out

    def position_probabilities(self, x: np.ndarray) -> np.ndarray:
        """(L, B, K) for bytes x (L, B)."""
        both = np.concatenate([self.states(x, "f"), self.states(x[::-1], "b")[::-1]], 2)
        return softmax(both @ self.p["V"] + self.p["c"])

    def loss_and_gradients(self, x: np.ndarray, y: np.ndarray):
        """Mean cross-entropy of every position's label (y per sequence) and its gradients."""
        L, B = x.shape
        (hf, kf), (hb, kb) = self.states(x, "f", True), self.states(x[::-1], "b", True)
        both = np.concatenate([hf, hb[::-1]], 2)
        prob = softmax(both @ self.p["V"] + self.p["c"])
        loss = -np.log(prob[:, np.arange(B), y] + 1e-9).mean()
        prob[:, np.arange(B), y] -= 1
        d = prob / np.float32(L * B)
        H2, K = self.p["V"].shape
        grad = {"V": both.reshape(-1, H2).T @ d.reshape(-1, K), "c": d.sum((0, 1))}
        dboth = d @ self.p["V"].T
        H = H2 // 2
        for name, xs, kept, dout in (("f", x, kf, dboth[:, :, :H]), ("b", x[::-1], kb, dboth[::-1, :, H:])):
            U = self.p[f"U{name}"]
            dU, dW, dh = np.zeros_like(U), np.zeros_like(self.p[f"W{name}"]), np.zeros((B, H), dtype=np.float32)
            for t in range(L - 1, -1, -1):
                h, q, f, c = kept[t]
                dh = dh + dout[t]
                dc = dh * f * (1 - c * c)
                df = (dh * (c - h) + dc * q[:, H:]) * f * (1 - f)
                dq = np.concatenate([df, dc * f], 1)
                dU += h.T @ dq
                np.add.at(dW, xs[t], np.concatenate([df, dc], 1))
                dh = dh * (1 - f) + dq @ U.T
            grad[f"U{name}"], grad[f"W{name}"] = dU, dW
        return loss, grad

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = 128, rate: float = 0.02, seed: int = 11) -> None:
        """Adam over batches of the windows x (N, L) with labels y (N)."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            at = r.integers(0, len(x), min(batch, len(x)))
            _, grad = self.loss_and_gradients(np.ascontiguousarray(x[at].T), y[at])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            now = rate * (1 - 0.9 * step / steps)
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """(N, K): mean of the position probabilities of each text; zeros for an empty one."""
        total = np.zeros((len(texts), len(self.languages)))
        size = np.array([len(t) for t in texts], dtype=np.int64)
        own, first, counted = windows(size)
        flat = np.frombuffer(b"".join(texts) + b" " * WINDOW, dtype=np.uint8)
        begin = np.cumsum(size) - size
        step = np.arange(WINDOW)
        for i in range(0, len(own), TOGETHER):
            o, s, n = own[i:i + TOGETHER], first[i:i + TOGETHER], counted[i:i + TOGETHER]
            x = flat[np.minimum(step[:, None] + (begin[o] + s)[None, :], len(flat) - 1)]
            x = np.where(step[:, None] < (size[o] - s)[None, :], x, np.uint8(32))  # short texts end in spaces
            counts = (step[:, None] >= (np.minimum(size[o] - s, WINDOW) - n)[None, :]) & (step[:, None] < (size[o] - s)[None, :])
            np.add.at(total, o, pooled(self, x, counts))
        return total / np.maximum(size, 1)[:, None]

    def label(self, text: bytes) -> np.ndarray:
        """The language (index) of every byte."""
        out = np.zeros(len(text), dtype=np.int32)
        _, first, counted = windows(np.array([len(text)], dtype=np.int64))
        for s, n in zip(first.tolist(), counted.tolist()):
            part = np.frombuffer(text[s:s + WINDOW], dtype=np.uint8)
            out[s + len(part) - n:s + len(part)] = self.position_probabilities(part[:, None])[-n:, 0].argmax(1)
        return out


def windows(size: np.ndarray):
    """Of texts of these sizes: each window's text, first byte and number of bytes that count (its last ones)."""
    n = -(-size // WINDOW)
    own = np.repeat(np.arange(len(size)), n)
    k = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    first = np.maximum(0, np.minimum(k * WINDOW, size[own] - WINDOW))
    return own, first, np.minimum(size[own] - k * WINDOW, WINDOW)


def pooled(model: Model, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the position probabilities over the positions that count, (B, K)."""
    p = model.p
    H = len(p["Uf"])
    forward = model.states(x, "f")
    h = np.zeros((x.shape[1], H), dtype=np.float32)
    total = np.zeros((x.shape[1], len(p["c"])), dtype=np.float32)
    W, U, Vf, Vb = p["Wb"], p["Ub"], p["V"][:H], p["V"][H:]
    weight = counts.astype(np.float32)
    for t in range(len(x) - 1, -1, -1):
        g, q = W[x[t]], h @ U
        f = sigmoid(g[:, :H] + q[:, :H])
        h = h + f * (np.tanh(g[:, H:] + f * q[:, H:]) - h)
        e = np.exp(np.minimum(forward[t] @ Vf + h @ Vb + p["c"], np.float32(30)))
        total += e * (weight[t] / e.sum(1))[:, None]
    return total


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def sample(df: DataFrame, key: str, text: str, lang: str) -> list[tuple[str, bytes]]:
    """At most SAMPLE_PER_LANGUAGE windows of each language, the ones with the smallest hashes of their ids."""
    rows = df.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL AND text != ''")
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return []
    # A cut of the hash that about twice the sample passes, so that nothing has to be sorted as a whole.
    cuts = df.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, 2.0 * SAMPLE_PER_LANGUAGE / r["count"]) * 2**40) for r in sizes], "lang string, cut double")
    hashed = rows.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 40)))
    start = 1 + F.pmod(F.xxhash64("id", F.lit("place")), F.greatest(F.lit(1), F.char_length("text") - SAMPLE_CHARS))
    picked = (hashed.join(F.broadcast(cuts), "lang").where("h < cut")
              .select("lang", "h", "id", F.substr("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("window")).collect())
    out, taken = [], dict.fromkeys((r["lang"] for r in sizes), 0)
    for r in sorted(picked, key=lambda r: (r["h"], r["id"], r["window"])):
        if taken[r["lang"]] < SAMPLE_PER_LANGUAGE:
            taken[r["lang"]] += 1
            out.append((r["lang"], r["window"].encode()))
    return out


def fit(rows: list[tuple[str, bytes]]) -> Model | None:
    """Train on (language, window) rows; None without rows."""
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    x = np.stack([np.frombuffer(w[:TRAIN_BYTES].ljust(TRAIN_BYTES), dtype=np.uint8) for _, w in rows])
    model = Model.start(languages)
    model.train(x, np.array([languages.index(lang) for lang, _ in rows]))
    return model


def predict(df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score of every row."""
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = df.select(F.col(key), F.when(letters, F.col(text)).alias("text"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            at = [i for i, t in enumerate(texts) if t] if model else []
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if at:
                prob = model.documents([texts[i].encode() for i in at])
                for i, p in zip(at, prob):
                    k = int(p.argmax())
                    lang[i], score[i] = model.languages[k], min(1.0, float(p[k]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang), pa.array(score, pa.float64())],
                                             names=[key, "lang_pred", "score"])

    return rows.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def spans(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of bytes of one language: key, start, end (bytes, end exclusive), lang."""
    rows = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches):
        for b in batches:
            ids, start, end, lang = [], [], [], []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = model.label(t.encode())
                cuts = [0, *(np.flatnonzero(got[1:] != got[:-1]) + 1).tolist(), len(got)] if len(got) else []
                for i, j in zip(cuts, cuts[1:]):
                    ids.append(doc), start.append(i), end.append(j), lang.append(model.languages[got[i]])
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                                              pa.array(lang, pa.string())], names=[key, "start", "end", "lang"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, start long, end long, lang string")


def op4_lang_id(spark, sf_dir):
    """Languages of all documents, learned from the two thirds that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    model = fit(sample(docs.where(rest != 1), "doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
