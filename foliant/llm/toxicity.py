"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w . x - t_k): one weight vector for all thresholds, and
thresholds that ascend by construction. Features are words and their beginnings of
4 to 6 letters, as 64-bit hashes; x holds 1 for each that occurs. Weights are not
negative (a benign word never excuses a toxic one) and L1 keeps them sparse.
The expected severity is the sum of P(grade > k) over the thresholds.

Where only a flag is known, ``grades_from_flags`` derives grades: 0 for clean
documents; a flagged one gets 1 to 3 by how many different features it uses that
the sample shows in flagged documents only.

Training takes at most ``MOST_LABELLED`` labelled documents and runs on the driver;
features seen in fewer than ``LEAST_DOCS`` flagged ones, or not clearly more often
there than in clean ones, get no weight and stay on the executors. Scoring is map-only
over whole texts.

Defined cases: a null or empty text has no features and gets the severity of a clean
text; without labelled rows every document is clean; repeated rows and null ids
are scored like others; a very long text is one set of features, in one task; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import stored
from foliant.llm.labelled import held_out, training_sample

GRADES = 4
MOST_LABELLED = 6_000
LEAST_DOCS = 3
THRESHOLD = 0.5
_KEEP = 100_000
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[int]:
    """Hashes of the word and of its beginnings."""
    parts = {"=" + word, *(word[:n] for n in (4, 5, 6) if len(word) >= n)}
    return [xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) for p in parts]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def document_features(text: str | None) -> np.ndarray:
    found = [h for w in words_of(text) for h in features_of(w)]
    return np.unique(np.array(found, np.uint64))


def grades_from_flags(columns: np.ndarray, rows: np.ndarray, flags: np.ndarray, width: int) -> np.ndarray:
    """Grades 0 to 3 from 0/1 flags and the sparse features (row, column)."""
    flagged = np.bincount(columns[flags[rows] > 0], minlength=width)
    clean = np.bincount(columns[flags[rows] == 0], minlength=width)
    telling = (flagged >= LEAST_DOCS) & (clean == 0)
    hits = np.bincount(rows, weights=telling[columns], minlength=len(flags))
    grades = np.zeros(len(flags), np.int64)
    if flags.any():
        low, high = np.quantile(hits[flags > 0], [1 / 3, 2 / 3])
        grades = np.where(flags > 0, 1 + (hits > low) + (hits > high), 0)
    return grades


class _Words(dict):
    """word -> its features that carry weight."""

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _KEEP:
            self.clear()
        found = self[word] = tuple([h for h in features_of(word) if h in self.weights])
        return found


class OrdinalModel:
    """Shared weights by feature hash and ascending thresholds."""

    def __init__(self, grades: int = GRADES):
        self.grades = grades
        self.weights: dict[int, float] = {}
        self.thresholds = np.linspace(4.0, 6.0, grades - 1)

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        """P(grade > k) per row and threshold."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - sums[:, None], -30, 30)))

    def fit(self, rows, columns, hashes, grades, rounds: int = 300, rate: float = 0.3, sparsity: float = 5e-4):
        """Projected AdaGrad on the likelihood of P(grade > k), all rows at once."""
        n, cuts = len(grades), self.grades - 1
        # Screening: a weight needs a feature that graded documents use more often.
        graded = np.bincount(columns[grades[rows] > 0], minlength=len(hashes))
        clear = np.bincount(columns[grades[rows] == 0], minlength=len(hashes))
        lift = graded / max(1, int((grades > 0).sum())) > 2 * clear / max(1, int((grades == 0).sum()))
        useful = (graded >= LEAST_DOCS) & lift
        place, kept = np.cumsum(useful) - 1, useful[columns]
        rows, columns, hashes = rows[kept], place[columns[kept]], hashes[useful]
        width = len(hashes)
        # Clean and graded documents weigh the same in all.
        clean = max(1, int((grades == 0).sum()))
        share = np.where(grades == 0, 0.5 / clean, 0.5 / max(1, n - clean))[:, None]
        w = np.zeros(width)
        above = grades[:, None] > np.arange(cuts)[None, :]
        base, steps = np.array([4.0]), np.zeros(cuts - 1)
        seen_w, seen_t = np.full(width, 1e-8), np.full(cuts, 1e-8)
        for _ in range(rounds):
            gaps = np.exp(steps)
            self.thresholds = np.concatenate([base, base + np.cumsum(gaps)])
            sums = np.bincount(rows, weights=w[columns], minlength=n)
            miss = (self.probabilities(sums) - above) * share
            slope = np.bincount(columns, weights=miss.sum(axis=1)[rows], minlength=width) + sparsity
            slope_t = -miss.sum(axis=0)
            by_gap = slope_t[::-1].cumsum()[::-1]
            slope_t = np.concatenate([by_gap[:1], by_gap[1:] * gaps])
            seen_w += slope * slope
            seen_t += slope_t * slope_t
            w = np.maximum(0.0, w - rate * slope / np.sqrt(seen_w))
            move = rate * slope_t / np.sqrt(seen_t)
            base, steps = base - move[:1], np.clip(steps - move[1:], -5, 5)
        self.weights = {int(h): float(x) for h, x in zip(hashes, w, strict=True) if x > 1e-6}
        return self

    def sums(self, texts: list[str | None]) -> np.ndarray:
        if not hasattr(self, "_words"):
            self._words = _Words(self.weights)
        get, weight = self._words.__getitem__, self.weights
        out = np.empty(len(texts))
        for k, text in enumerate(texts):
            hits = {h for found in filter(None, map(get, words_of(text))) for h in found}
            out[k] = sum(sorted(weight[h] for h in hits))
        return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, graded: bool = False) -> OrdinalModel:
    """Train on a bounded sample. ``docs``: id, text; ``labels``: id, label (a 0/1
    flag, or with ``graded`` a grade from 0 to GRADES - 1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [document_features(t).view(np.int64) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "y": batch["label"], "x": x})

    sample = training_sample(docs, labels, "label", most).select("id", "text", "label")
    sample = stored(
        sample.mapInPandas(run, "id long, y int, x array<long>").withColumn(
            "doc", F.monotonically_increasing_id()
        )
    )
    known = sample.select("id", "doc", "y").orderBy("id", "doc").toPandas()
    model = OrdinalModel()
    y = known["y"].to_numpy(np.int64)
    bad = int((y > 0).sum())
    if not bad:
        return model
    # Only features that pass the screening of ``fit`` come to the driver.
    pairs = sample.select("doc", (F.col("y") > 0).cast("int").alias("bad"), F.explode("x").alias("h"))
    seen, clear = F.col("seen"), F.col("clear") / F.lit(max(1, len(y) - bad))
    useful = (
        pairs.groupBy("h")
        .agg(F.sum("bad").alias("seen"), F.sum(1 - F.col("bad")).alias("clear"))
        .filter((seen >= LEAST_DOCS) & (seen / F.lit(bad) > 2 * clear))
        .select("h")
    )
    found = pairs.join(useful, "h").select("doc", "h").toPandas()
    rows = pd.Series(np.arange(len(known)), index=known["doc"]).loc[found["doc"]].to_numpy()
    hashes, columns = np.unique(found["h"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
    order = np.lexsort((columns, rows))
    rows, columns = rows[order], columns[order]
    grades = np.clip(y, 0, GRADES - 1) if graded else grades_from_flags(columns, rows, y, len(hashes))
    return model.fit(rows, columns, hashes, grades)


def score_toxicity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """id, severity (expected grade), toxic_probability. ``docs``: id, text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    names = ["id", "severity", "toxic_probability"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = shared.value.probabilities(shared.value.sums(batch.column("text").to_pylist()))
            columns = [batch.column("id"), pa.array(above.sum(axis=1)), pa.array(above[:, 0])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("id").cast("long").alias("id"), "text")
    return rows.mapInArrow(run, "id long, severity double, toxic_probability double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """id, held_out, severity, toxic_probability, toxic (1 where P(grade > 0) >= threshold)."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select(
        "id",
        held_out(F.col("id")).alias("held_out"),
        "severity",
        "toxic_probability",
        F.when(F.col("toxic_probability") >= threshold, 1).otherwise(0).alias("toxic"),
    )
