"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector for all ordered thresholds.  Features are a text's
distinct words and their beginnings and endings, hashed, with log2(1 + count) as value; the expected severity is the
sum over k of P(grade > k).

Labels that only tell toxic from not give grades as follows: 0 where not toxic; else 1 to `levels`, by the share of the
text's words that carry evidence (features that nearly only toxic training rows have), cut at equal shares of rows.

Defined cases: null and empty texts have no features and get the severity of the thresholds alone; a label row without
its document, and a null label, teach nothing; repeated label rows count once a row; without labels of both
kinds every severity is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, letter_words, mix, row_slices, run_hashes, sample_share

TABLE = 1 << 20
AFFIXES = ((0, 4), (0, 5), (0, 6), (1, 4), (1, 5))


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, table row, value) of the texts' features, by text and row."""
    code, starts, ends, first = letter_words(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    hashed, owners = [run_hashes(code, starts, ends)], [owner]
    spans = ends - starts
    for kind, (at_end, k) in enumerate(AFFIXES, 1):
        has = spans > k
        a = ends[has] - k if at_end else starts[has]
        hashed.append(mix(run_hashes(code, a, a + k) + np.uint64(kind)))
        owners.append(owner[has])
    row = (np.concatenate(hashed) >> np.uint64(44)).astype(np.int64)
    key, count = np.unique(np.concatenate(owners) * TABLE + row, return_counts=True)
    return key // TABLE, key % TABLE, np.log2(1 + count)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


class Ordinal:
    def __init__(self, weights: np.ndarray, cuts: np.ndarray):
        self.weights, self.cuts = weights, cuts

    def above(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > k) for every text and threshold."""
        owner, row, value = features(texts)
        s = np.bincount(owner, self.weights[row] * value, len(texts))
        return _sigmoid(s[:, None] - self.cuts[None, :])


def fit(owner: np.ndarray, row: np.ndarray, value: np.ndarray, grade: np.ndarray, rounds: int = 200, l2: float = 1e-3, rate: float = 0.05, least_rows: int = 5) -> Ordinal:
    """Maximum likelihood by Adam over the features that least_rows rows or more have."""
    seen = np.bincount(row, minlength=TABLE)
    keep = seen[row] >= least_rows
    owner, value = owner[keep], value[keep]
    used, col = np.unique(row[keep], return_inverse=True)
    n, levels = len(grade), int(grade.max())
    # a feature's value is scaled by its log-odds of being toxic, so that the few telling ones need little weight
    toxic = (grade > 0).astype(float)
    yes, no = np.bincount(col, toxic[owner], len(used)), np.bincount(col, 1 - toxic[owner], len(used))
    odds = np.log((yes + 0.5) / (toxic.sum() + 1)) - np.log((no + 0.5) / (n - toxic.sum() + 1))
    value = value * odds[col]
    share = np.array([(grade > k).mean() for k in range(levels)])
    cuts = np.log((1 - share) / share)
    params = np.concatenate([np.zeros(len(used)), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, rounds + 1):
        w, steps = params[: len(used)], np.exp(params[len(used) + 1 :])
        cuts = params[len(used)] + np.concatenate([[0.0], np.cumsum(steps)])
        s = np.bincount(owner, w[col] * value, n)
        edge = np.concatenate([[-np.inf], cuts, [np.inf]])
        hi, lo = edge[grade + 1] - s, edge[grade] - s
        a = np.where(np.isinf(hi), 1.0, _sigmoid(np.where(np.isinf(hi), 0, hi)))
        b = np.where(np.isinf(lo), 0.0, _sigmoid(np.where(np.isinf(lo), 0, lo)))
        p = np.maximum(a - b, 1e-9)
        ds = (a + b - 1) / n
        g = np.zeros_like(params)
        g[: len(used)] = np.bincount(col, ds[owner] * value, len(used)) - l2 * w
        da, db = a * (1 - a) / p / n, b * (1 - b) / p / n
        dcut = np.array([da[grade == k].sum() - db[grade == k + 1].sum() for k in range(levels)])
        tails = np.cumsum(dcut[::-1])[::-1]
        g[len(used)] = tails[0]
        g[len(used) + 1 :] = tails[1:] * steps
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    weights = np.zeros(TABLE)
    weights[used] = params[: len(used)] * odds
    return Ordinal(weights, params[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(params[len(used) + 1 :]))]))


def grades(owner: np.ndarray, row: np.ndarray, value: np.ndarray, toxic: np.ndarray, levels: int) -> np.ndarray:
    """Grades of rows that are labelled toxic or not, by density of evidence."""
    have, have_toxic = np.bincount(row, minlength=TABLE), np.bincount(row, toxic[owner], TABLE)
    evidence = (have_toxic >= 3) & (have_toxic >= 0.95 * have)
    density = np.bincount(owner, evidence[row] * value, len(toxic)) / np.maximum(1, np.bincount(owner, minlength=len(toxic)))
    cuts = np.quantile(density[toxic == 1], np.arange(1, levels) / levels)
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, density, "right"), 0).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, train_rows: int, levels: int, id_col: str, text_col: str, label_col: str) -> Ordinal | None:
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    sample = sample_share(known, "_id", train_rows)
    rows = docs.select(id_col, F.col(text_col).alias("_t")).join(F.broadcast(sample), F.col(id_col) == F.col("_id")).select("_y", "_t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 1):
                owner, row, value = features(part.column(1).to_pylist())
                at = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x)) for x in (row.astype(np.int32), value.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], names=["y", "rows", "vals"])

    got = rows.mapInArrow(run, "y int, rows array<int>, vals array<float>").toArrow().combine_chunks()
    y = np.asarray(got.column("y").combine_chunks() if isinstance(got.column("y"), pa.ChunkedArray) else got.column("y"))
    if not len(y) or y.min() > 0 or y.max() <= 0:
        return None
    lists = got.column("rows").combine_chunks()
    owner = np.repeat(np.arange(len(y)), np.diff(np.asarray(lists.offsets)))
    row, value = np.asarray(lists.flatten()).astype(np.int64), np.asarray(got.column("vals").combine_chunks().flatten()).astype(np.float64)
    return fit(owner, row, value, grades(owner, row, value, (y > 0).astype(np.int64), levels))


def score(docs: DataFrame, labels: DataFrame, train_rows: int = 5000, levels: int = 3, cut: float = 0.5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, expected_severity, grade, toxic) of every row: toxic where P(grade > 0) is `cut` or more."""
    bounded_batches(docs.sparkSession)
    model = train(docs, labels, train_rows, levels, id_col, text_col, label_col)
    if model:
        model.weights = model.weights.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 1):
                n = part.num_rows
                if model:
                    above = model.above(part.column(1).to_pylist())
                    values = [above.sum(axis=1), (above >= 0.5).sum(axis=1).astype(np.int32), above[:, 0] >= cut]
                else:
                    values = [[None] * n] * 3
                columns = [pa.array(v, k) for v, k in zip(values, (pa.float64(), pa.int32(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[id_col, "expected_severity", "grade", "toxic"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, expected_severity double, grade int, toxic boolean")
