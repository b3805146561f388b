"""A quality classifier: a generalised additive model with pairwise interactions.

One pass over the texts writes a narrow table of measures. A bounded sample of labelled rows is binned by quantiles, and
boosting goes round the features in turn: each step fits a tree of few leaves to the current gradients of one feature,
and the tree, being a step function of bins, is added to the feature's lookup table. Then pairs of features with the
largest remaining gain get tables of their own in the same way. A score is the sum of looked-up entries.

SAMPLE_ROWS labelled rows at most are used for fitting, those with the smallest hash of doc_id; everything else covers
all rows. Rows whose crc32(doc_id) mod 3 is 1 are held out and never used for fitting. Labels, lang, source and doc_id
are no inputs of a score.

Cases: null and empty texts have a score like others. Rows without a label, or with a null one, are scored only. With no
labelled rows, or labels of one kind, every score is the smoothed share of label 1. Repeated rows get equal scores;
documents that share an id share its labels. An empty table gives an empty result. Columns other than the named ones
are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import by_value, stored, table

by_value(__name__)

#: Bound of the fitting sample.
SAMPLE_ROWS = 20_000
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 10
RATE, LEAVES, SMOOTH, LEAST_ROWS = 0.1, 4, 5.0, 20

FEATURES = (
    "log_words", "word_length", "longest_word", "distinct_words", "words_per_line", "repeated_lines", "upper", "digits",
    "symbols", "exclamations", "bars", "stops", "other_marks", "beyond_ascii", "short_words", "top_word",
)
_BYTE_SETS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "symbols": b"#*$%&<>@^~=+\\/{}[]_",
    "exclamations": b"!?",
    "bars": b"|",
    "stops": b".",
    "other_marks": b",;:'\"()-",
    "beyond_ascii": bytes(range(128, 256)),
}


def measures(text: str | None) -> list[float]:
    """The values of FEATURES of a whole text."""
    data = (text or "").encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n = max(1, len(words))
    held: dict[bytes, int] = {}
    for w in words:
        held[w] = held.get(w, 0) + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    chars = max(1, len(data))
    shares = {k: float(counts[list(v)].sum()) / chars for k, v in _BYTE_SETS.items()}
    own = {
        "log_words": float(np.log1p(len(words))),
        "word_length": sum(map(len, words)) / n,
        "longest_word": float(max(map(len, held), default=0)),
        "distinct_words": len(held) / n,
        "words_per_line": n / max(1, len(lines)),
        "repeated_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "short_words": sum(c for w, c in held.items() if len(w) <= 3) / n,
        "top_word": max(held.values(), default=0) / n,
    } | shares
    return [own[name] for name in FEATURES]


def measured(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id and one double for each feature."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([measures(t.as_py()) for t in batch.column("text")], float).reshape(-1, len(FEATURES))
            columns = [pa.array(rows[:, i]) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *FEATURES])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from fitting."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


@dataclass
class AdditiveModel:
    """Lookup tables of single features and of pairs, and the edges of their bins."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of label 1: sums of table entries."""
        total = np.full(len(rows), self.base)
        for i, (edges, entries) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += entries[np.searchsorted(edges, rows[:, i], side="right")]
        coarse = [np.searchsorted(e, rows[:, i], side="right") for i, e in enumerate(self.pair_edges)]
        for (i, j), entries in zip(self.pairs, self.pair_tables, strict=True):
            total += entries[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def edges_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges of quantile bins."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def step_tree(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A tree of at most LEAVES leaves over ordered bins: the value of each bin."""
    g, h, n = (np.concatenate([[0], np.cumsum(x)]) for x in (grad, hess, rows))
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + SMOOTH)
    leaves = [(0, len(grad))]
    for _ in range(LEAVES - 1):
        best = (1e-9, None, None)
        for lo, hi in leaves:
            cut = np.arange(lo + 1, hi)
            cut = cut[(n[cut] - n[lo] >= LEAST_ROWS) & (n[hi] - n[cut] >= LEAST_ROWS)]
            if len(cut):
                gain = worth(lo, cut) + worth(cut, hi) - worth(lo, hi)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (lo, hi), int(cut[k]))
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(grad))
    for lo, hi in leaves:
        out[lo:hi] = -(g[hi] - g[lo]) / (h[hi] - h[lo] + SMOOTH)
    return out


def pair_tree(grad: np.ndarray, hess: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both axes into four cells: its gain and the value of each cell of the grid."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (grad, hess))
    a, b = np.meshgrid(np.arange(1, grad.shape[0]), np.arange(1, grad.shape[1]), indexing="ij")
    if not a.size:
        return 0.0, np.zeros_like(grad)

    def cells(t: np.ndarray) -> list[np.ndarray]:
        low, up, left, whole = t[a, b], t[a, -1], t[-1, b], t[-1, -1]
        return [low, up - low, left - low, whole - up - left + low]

    gs, hs = cells(g), cells(h)
    gain = sum(x**2 / (y + SMOOTH) for x, y in zip(gs, hs, strict=True)) - g[-1, -1] ** 2 / (h[-1, -1] + SMOOTH)
    k = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [-x[k] / (y[k] + SMOOTH) for x, y in zip(gs, hs, strict=True)]
    out = np.empty_like(grad)
    ca, cb = int(a[k]), int(b[k])
    out[:ca, :cb], out[:ca, cb:], out[ca:, :cb], out[ca:, cb:] = values
    return float(gain[k]), out


def fit(rows: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Cyclic boosting on a bounded sample."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(labels) < 2 * LEAST_ROWS or labels.min() == labels.max():
        return model
    width = rows.shape[1]
    model.edges = [edges_of(rows[:, i], BINS) for i in range(width)]
    model.pair_edges = [edges_of(rows[:, i], PAIR_BINS) for i in range(width)]
    fine = [np.searchsorted(e, rows[:, i], side="right") for i, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, rows[:, i], side="right") for i, e in enumerate(model.pair_edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    filled = [np.bincount(f, minlength=len(t)) for f, t in zip(fine, model.tables, strict=True)]
    total = np.full(len(labels), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return p - labels, p * (1 - p)

    for _ in range(ROUNDS):
        for i in range(width):
            grad, hess = slopes()
            size = len(model.tables[i])
            step = RATE * step_tree(np.bincount(fine[i], grad, size), np.bincount(fine[i], hess, size), filled[i])
            model.tables[i] += step
            total += step[fine[i]]
    shapes = [len(e) + 1 for e in model.pair_edges]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[i] * shapes[j] + coarse[j], values, shapes[i] * shapes[j]).reshape(shapes[i], shapes[j])

    grad, hess = slopes()
    gains = {(i, j): pair_tree(grid(i, j, grad), grid(i, j, hess))[0] for i in range(width) for j in range(i)}
    model.pairs = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    model.pair_tables = [np.zeros((shapes[i], shapes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            grad, hess = slopes()
            step = RATE * pair_tree(grid(i, j, grad), grid(i, j, hess))[1]
            model.pair_tables[k] += step
            total += step[coarse[i], coarse[j]]
    return model


def fitted(features: DataFrame, labels: DataFrame, label: str) -> AdditiveModel:
    """A model from at most SAMPLE_ROWS labelled rows that are not held out."""
    known = labels.filter(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).alias("label"))
    sample = (
        features.join(known, "doc_id")
        .orderBy(F.xxhash64("doc_id"), *FEATURES)
        .limit(SAMPLE_ROWS)  # the documented bound of the fitting sample
        .select(*FEATURES, F.col("label").cast("double").alias("label"))
        .toArrow()
    )
    data = np.column_stack([sample.column(f).to_numpy() for f in (*FEATURES, "label")]) if sample.num_rows else np.zeros((0, len(FEATURES) + 1))
    return fit(data[:, :-1], data[:, -1])


def scored(features: DataFrame, model: AdditiveModel) -> DataFrame:
    """features -> doc_id, score."""
    kind = features.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(rows))], ["doc_id", "score"])

    return features.mapInArrow(run, f"doc_id {kind}, score double")


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    features = stored(measured(table(spark, sf_dir, "documents")), "features")
    model = fitted(features, table(spark, sf_dir, "labels").select("doc_id", "quality"), "quality")
    return scored(features, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
