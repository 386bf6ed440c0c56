"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes. A passage becomes a vector
of the shares of its byte classes and of their successions, its fill and how
much of it occurs again in the document; a learned layer encodes it. Gated
attention, softmax over the bag of w . (tanh(V h) * sigmoid(U h)), weighs the
passages; the score is the logistic of a linear form of the weighted sum. Only the
label of the document is known; encoder, gates and score are learned together.

Training takes at most ``MOST_LABELLED`` labelled documents, in the order of a hash,
whose passages fill at most ``MOST_BYTES``, and runs on the driver: the bounds are
fixed whatever the table. A document in the sample is there with every passage; one
that alone would fill more than a sixteenth of the room is left out of it. Scoring is
map-only, over every passage of every text.

Defined cases: a null text is empty; an empty text is one empty passage and gets a
score; without any labelled row the score is 0.5; repeated rows and null ids are
scored like others; an empty table gives an empty result; other columns are
ignored and never reach the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import stored
from foliant.llm.labelled import held_out, training_sample

PASSAGE = 512
MOST_LABELLED = 4_000
MOST_BYTES = 64 << 20  # of described passages
HIDDEN = 32
GATE = 16
THRESHOLD = 0.3
_SLICE = 1 << 21  # bytes described at a time


def _classes() -> np.ndarray:
    table = np.zeros(256, np.int64)
    groups = ["aeiou", "bcdfghjklmnpqrstvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r",
              "\n", ".,;:", "!?", "*#$%&@^~+=", "|<>{}[]\\/_", "'\"()-`"]
    for k, group in enumerate(groups, 1):
        table[[ord(c) for c in group]] = k
    table[0x80:0xC0], table[0xC0:] = len(groups) + 1, len(groups) + 2
    return table


_CLASS = _classes()
_KINDS = int(_CLASS.max()) + 1
FEATURES = _KINDS + _KINDS**2 + 3


def _repeats(data: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word starts after a blank, and whether the 16 bytes from there occur again in the document."""
    blank = _CLASS[data] == 5
    starts = np.flatnonzero(blank[:-1] & ~blank[1:] & (owner[:-1] == owner[1:])) + 1
    starts = starts[starts + 16 <= len(data)]
    starts = starts[owner[starts] == owner[starts + 15]]
    if not len(starts):
        return starts, np.zeros(0, bool)
    key = owner[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(16):
        key = (key ^ data[starts + k]) * np.uint64(0x100000001B3)
        key ^= key >> np.uint64(29)
    _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
    return starts, counts[back] > 1


def describe(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages and the number of passages of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    passages = np.maximum(1, -(-sizes // PASSAGE))
    data = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(passages) - passages
    begin = np.cumsum(sizes) - sizes
    at = (np.arange(len(data)) - begin[owner]) // PASSAGE + first[owner]
    total = int(passages.sum())
    kinds = _CLASS[data]
    out = np.zeros((total, FEATURES), np.float32)
    fill = np.bincount(at, minlength=total).astype(np.float32)
    scale = np.maximum(fill, 1.0)[:, None]
    out[:, :_KINDS] = np.bincount(at * _KINDS + kinds, minlength=total * _KINDS).reshape(total, -1) / scale
    if len(data) > 1:
        inner = owner[:-1] == owner[1:]
        code = (at[:-1] * _KINDS + kinds[:-1]) * _KINDS + kinds[1:]
        pairs = np.bincount(code[inner], minlength=total * _KINDS**2).reshape(total, -1)
        out[:, _KINDS:-3] = np.sqrt(pairs / scale)
        starts, again = _repeats(data, owner)
        words = np.bincount(at[starts], minlength=total)
        out[:, -3] = np.bincount(at[starts], weights=again, minlength=total) / np.maximum(words, 1)
        out[:, -2] = words / scale[:, 0] * 4
    out[:, -1] = fill / PASSAGE
    return out, passages


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Encoder, gated attention and score; ``weights`` is all it has learned."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        weights = {
            "E": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)),
            "e": np.zeros(HIDDEN),
            "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "w": rng.normal(0, GATE**-0.5, GATE),
            "c": rng.normal(0, HIDDEN**-0.5, HIDDEN),
            "b": np.zeros(1),
        }
        self.weights = {k: v.astype(np.float32) for k, v in weights.items()}
        self.trained = False

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict:
        p = self.weights
        x = np.clip((x - self.mean) / self.spread, -6, 6).astype(np.float32)
        h = np.tanh(x @ p["E"] + p["e"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        logits = (v * u) @ p["w"]
        starts = np.cumsum(sizes) - sizes
        bag = np.repeat(np.arange(len(sizes)), sizes)
        a = np.exp(logits - np.maximum.reduceat(logits, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z, "bag": bag, "starts": starts,
                "score": _sigmoid(z @ p["c"] + p["b"])}

    def gradient(self, f: dict, y: np.ndarray) -> dict:
        p, n = self.weights, len(y)
        d = ((f["score"] - y) / n).astype(np.float32)
        dz = d[:, None] * p["c"]
        da = (dz[f["bag"]] * f["h"]).sum(axis=1)
        mean = np.add.reduceat(f["a"] * da, f["starts"])[f["bag"]]
        dlogit = f["a"] * (da - mean)
        dgate = dlogit[:, None] * p["w"]
        dv, du = dgate * f["u"] * (1 - f["v"] ** 2), dgate * f["v"] * f["u"] * (1 - f["u"])
        dh = f["a"][:, None] * dz[f["bag"]] + dv @ p["V"].T + du @ p["U"].T
        dpre = dh * (1 - f["h"] ** 2)
        return {"E": f["x"].T @ dpre, "e": dpre.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
                "w": (f["v"] * f["u"]).T @ dlogit, "c": f["z"].T @ d, "b": np.array([d.sum()])}

    def fit(self, x, sizes, y, epochs: int = 12, batch: int = 64, rate: float = 3e-3, decay: float = 1e-4):
        if not len(y):
            return self
        self.trained = True
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-3
        rng = np.random.default_rng(11)
        ends = np.cumsum(sizes)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(order), batch):
                bags = order[at : at + batch]
                rows = np.concatenate([np.arange(ends[b] - sizes[b], ends[b]) for b in bags])
                grads = self.gradient(self.forward(x[rows], sizes[bags]), y[bags])
                step += 1
                for k, g in grads.items():
                    g = g + decay * self.weights[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    drift = first[k] / (1 - 0.9**step)
                    size = np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                    self.weights[k] -= np.float32(rate * (1 - epoch / epochs)) * drift / size
        return self

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.trained:
            return np.full(len(texts), 0.5)
        out = np.empty(len(texts))
        group: list[bytes] = []
        size = done = 0

        def flush():
            nonlocal group, size, done
            out[done : done + len(group)] = self.forward(*describe(group))["score"]
            done, group, size = done + len(group), [], 0

        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass")
            if group and size + len(data) > _SLICE:
                flush()
            group.append(data)
            size += len(data)
        if group:
            flush()
        return out


def _bags(docs: DataFrame, labels: DataFrame, most: int, most_bytes: int) -> DataFrame:
    """key, x (described passages), y of the sampled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, label in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "label")), strict=True):
                x, _ = describe([(text or "").encode("utf-8", "surrogatepass")])
                columns = [
                    pa.array([key], pa.int64()),
                    pa.array([x.astype(np.float16).tobytes()], pa.binary()),
                    pa.array([label], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "x", "y"])

    sample = training_sample(docs, labels, "label", most)
    keyed = sample.select(F.xxhash64("id", "text").alias("key"), "text", "label")
    rows = stored(keyed.mapInArrow(run, "key long, x binary, y int"))
    # At most ``most`` rows of two numbers.
    sizes = rows.select("key", F.length("x").cast("long").alias("size")).filter(F.col("size") <= most_bytes // 16)
    order = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = sizes.withColumn("filled", F.sum("size").over(order)).filter(F.col("filled") <= most_bytes)
    return rows.join(F.broadcast(kept.select("key").distinct()), "key", "left_semi")


def fit_quality(
    docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, most_bytes: int = MOST_BYTES
) -> AttentionModel:
    """Train on a bounded sample. ``docs``: id, text; ``labels``: id, label."""
    rows = _bags(docs, labels, most, most_bytes).orderBy("key", "y").toPandas()
    bags = [np.frombuffer(b, np.float16).reshape(-1, FEATURES) for b in rows["x"]]
    if not bags:
        return AttentionModel()
    x = np.concatenate(bags).astype(np.float32)
    return AttentionModel().fit(x, np.array([len(b) for b in bags]), rows["y"].to_numpy(float))


def score_quality(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """id, score. ``docs``: id, text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores)], names=["id", "score"])

    return docs.select(F.col("id").cast("long").alias("id"), "text").mapInArrow(run, "id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """id, held_out, score, predicted."""
    scored = score_quality(docs, fit_quality(docs, labels))
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scored.select("id", held_out(F.col("id")).alias("held_out"), "score", predicted.alias("predicted"))
