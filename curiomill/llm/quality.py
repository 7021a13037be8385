"""Operator 7: quality classifier by regularised quadratic discriminant analysis.

Document statistics are transformed so that a Gaussian fits them (logarithms of counts, logits of shares). Each class
has a mean and a covariance that is shrunk towards the pooled covariance and then towards a multiple of the identity.
A score is the difference of the two log densities, by Mahalanobis distances with Cholesky factors kept from the fit,
turned into a probability by a logistic fit on labelled rows.

Class moments are sums over all labelled rows outside the held-out fold, made on the executors; the logistic fit takes
at most CALIBRATION_ROWS of these rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.llm import words as W
from curiomill.llm.tables import bounded_sample, kept

TOWARDS_POOLED = 0.1
TOWARDS_IDENTITY = 0.02
CALIBRATION_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3

KIND = np.zeros(256, np.uint8)  # 0 other, 1 lower-case letter, 2 upper-case letter, 3 digit, 4 point or comma, 5 symbol
KIND[97:123] = 1
KIND[128:] = 1
KIND[65:91] = 2
KIND[48:58] = 3
KIND[[ord(c) for c in ".,;:?'\"-()"]] = 4
KIND[[ord(c) for c in "#$%&*|!<>{}[]\\^~`@_=+/"]] = 5


def _logit(x: np.ndarray) -> np.ndarray:
    return np.log((x + 0.005) / (1.005 - x))


def statistics(block: W.Block) -> np.ndarray:
    """Transformed statistics of each row, (rows, features)."""
    rows = block.rows
    size = np.diff(block.offsets).astype(float)
    n = np.diff(block.first_word).astype(float)
    some, any_word = np.maximum(size, 1), np.maximum(n, 1)

    def bytes_with(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return np.diff(total[block.offsets]).astype(float)

    def words_with(values: np.ndarray) -> np.ndarray:
        return np.bincount(block.row, weights=values, minlength=rows)

    kind = KIND[block.data]
    of = {k: bytes_with(kind == k) for k in (1, 2, 3, 4, 5)}
    letters = np.maximum(of[1] + of[2], 1)
    lines = bytes_with(block.data == 10) + 1
    length = (block.end - block.start).astype(float)
    mean = words_with(length) / any_word
    spread = np.sqrt(np.maximum(words_with(length**2) / any_word - mean**2, 0))
    h = W.word_hashes(block)
    last = kind[block.end - 1]
    symbol = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(kind == 5, out=symbol[1:])
    with_symbol = symbol[block.end] > symbol[block.start]
    point = np.isin(block.data[block.end - 1], np.frombuffer(b".?", np.uint8))
    one_row, _ = W.distinct(block.row, h)
    different = np.bincount(one_row, minlength=rows).astype(float)
    pair_row, pair = W.shingles(block, 3, whole=False)
    triples = np.bincount(pair_row, minlength=rows).astype(float)
    triple_row, _ = W.distinct(pair_row, pair)
    different_triples = np.bincount(triple_row, minlength=rows).astype(float)
    same_as_before = np.zeros(len(h), bool)
    same_as_before[1:] = (h[1:] == h[:-1]) & (block.row[1:] == block.row[:-1])
    columns = [
        np.log1p(size), np.log1p(n), np.log1p(mean), np.log1p(spread),
        _logit((of[1] + of[2]) / some), _logit(of[2] / letters), _logit(of[3] / some), _logit(of[4] / some), _logit(of[5] / some),
        _logit(words_with(with_symbol) / any_word), _logit(words_with(last == 5) / any_word), _logit(words_with(point) / any_word),
        _logit(words_with(length <= 2) / any_word), np.log1p(n / (words_with(point) + 1)), np.log1p(n / lines),
        np.log((different + 1) / (np.sqrt(n) + 1)), _logit(different / any_word),
        _logit((different_triples + 1) / (triples + 1)), _logit(words_with(same_as_before) / any_word),
    ]
    return np.stack(columns, axis=1)


FEATURES = 19


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in W.blocks(batch.column("text")):
            x = statistics(block)
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, FEATURES), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(block.first, block.rows), values], ["id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, FEATURES)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, sums and sums of products of each class, as one array."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        x, y = _matrix(batch.column("x")), batch.column("label").to_numpy()
        for label in np.unique(y):
            own = x[y == label]
            sums = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
            total[int(label)] = total.get(int(label), 0) + sums
    for label, sums in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([label], pa.int32()), pa.array([sums.tolist()], pa.list_(pa.float64()))], ["label", "sums"])


class Model(NamedTuple):
    means: np.ndarray  # (2, features)
    whiten: np.ndarray  # (2, features, features): inverses of the Cholesky factors
    offset: float  # of the log density difference: determinants
    slope: float
    intercept: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density under class 1 less that under class 0."""
        d = [(((x - m) @ w.T) ** 2).sum(axis=1) for m, w in zip(self.means, self.whiten, strict=True)]
        return (d[0] - d[1]) / 2 + self.offset

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.intercept + self.slope * self.difference(x)
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _flat(score: float) -> Model:
    """A model that gives every row the same score."""
    score = min(max(score, 1e-6), 1 - 1e-6)
    return Model(np.zeros((2, FEATURES)), np.stack([np.eye(FEATURES)] * 2), 0.0, 0.0, float(np.log(score / (1 - score))))


def held_out(id_col: str) -> F.Column:
    """The fold that is not learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return kept(source.mapInArrow(_features, "id long, x array<double>"), "features")


def fit(found: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Learn from all labelled rows outside the held-out fold. ``found``: result of ``features``."""
    labelled = labels.filter(F.col(label_col).isin(0, 1) & ~held_out(id_col)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    train = kept(found.join(labelled.hint("merge"), "id").select("id", "x", "label"), "train")
    parts = train.select("x", "label").mapInArrow(_moments, "label int, sums array<double>")
    summed = parts.select("label", F.posexplode("sums")).groupBy("label", "pos").agg(F.sum("col").alias("total")).collect()
    sums = np.zeros((2, 1 + FEATURES + FEATURES**2))
    for r in summed:
        sums[r.label, r.pos] = r.total
    n = sums[:, 0]
    if n.min() < 2:
        return _flat(n[1] / n.sum() if n.sum() else 0.5)
    means = sums[:, 1 : 1 + FEATURES] / n[:, None]
    cov = np.stack([s[1 + FEATURES :].reshape(FEATURES, FEATURES) / k - np.outer(m, m) for s, k, m in zip(sums, n, means, strict=True)])
    pooled = (cov * n[:, None, None]).sum(axis=0) / n.sum()
    cov = (1 - TOWARDS_POOLED) * cov + TOWARDS_POOLED * pooled
    level = np.trace(cov, axis1=1, axis2=2) / FEATURES + 1e-9
    cov = (1 - TOWARDS_IDENTITY) * cov + TOWARDS_IDENTITY * level[:, None, None] * np.eye(FEATURES)
    factors = np.linalg.cholesky(cov)
    logs = np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1)
    model = Model(means, np.linalg.inv(factors), float(logs[0] - logs[1]), 1.0, 0.0)

    sample = bounded_sample(train, ["id", "label"], CALIBRATION_ROWS)
    d = np.clip(model.difference(np.array([r.x for r in sample])), -200, 200)
    y = np.array([r.label for r in sample], float)
    d, w = d / 10, np.zeros(2)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    design = np.stack([np.ones_like(d), d], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        gradient = design.T @ (p - target) + 1e-3 * w
        hessian = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1, 5 / max(np.abs(step).max(), 1e-9))
    return model._replace(slope=max(float(w[1]) / 10, 1e-6), intercept=float(w[0]))


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column("x"))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(x)), pa.array(model.difference(x))], ["id", "score", "log_density_difference"])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score whole texts: (id, held_out, score 0 to 1, predicted, log_density_difference) for each row.

    Null texts count as empty; empty texts have a score too, as the model extrapolates. With labels of fewer than two
    rows in a class every row gets the share of label 1, or 0.5 without labels. Labels other than 0 and 1 are ignored;
    an id labelled twice counts twice. A null id is scored, never learned from and not held out. Only the text is
    input of a score; other columns are ignored.
    """
    found = features(docs, id_col, text_col)
    scored = found.mapInArrow(partial(_scores, model=fit(found, labels)), "id long, score double, log_density_difference double")
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "log_density_difference",
    )


def _good(batches: Iterator[pa.RecordBatch], model: Model, text_col: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [model.score(statistics(block)) >= THRESHOLD for block in W.blocks(batch.column(text_col))]
        if keep:
            yield batch.filter(pa.array(np.concatenate(keep)))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least THRESHOLD; learned as in ``score_quality``."""
    model = fit(features(docs, id_col, text_col), labels)
    return docs.mapInArrow(partial(_good, model=model, text_col=text_col), docs.schema)
