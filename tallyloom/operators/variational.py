"""Online variational fit of LDA over blocks of sparse rows, and what a fitted model says of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.clustering import LocalLDAModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.util import Identifiable
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

SHAPE = 100.0           # first guesses are drawn from a gamma distribution of this shape and mean 1
DONE = 1e-3             # a row is finished when its shares of topics move by no more, on the mean
BLOCK = 2**18           # entries of a block of rows
CELLS = 2**19           # entries times topics that are worked on at once
SLICE = 2**17           # numbers of a sum that one task adds up
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BLOCKS = "size binary, term binary, count binary"
_ARROW = pa.schema([(x, pa.binary()) for x in ("size", "term", "count")])


# --- functions of numbers above 0 ---------------------------------------------------------
def _tail(y: np.ndarray) -> np.ndarray:
    """log y - digamma(y) for y of 6 or more."""
    z = 1 / (y * y)
    return 0.5 / y + z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z * (1 / 132 - z * 691 / 32760)))))


def _first_six(x: np.ndarray) -> np.ndarray:
    """1 / x + ... + 1 / (x + 5) by one division."""
    u = x * (x + 5)
    return (2 * x + 5) * ((3 * u + 20) * u + 24) / (u * (u + 4) * (u + 6))


def digamma(x: np.ndarray) -> np.ndarray:
    return np.log(x + 6) - _tail(x + 6) - _first_six(x)


def exp_digamma(x: np.ndarray) -> np.ndarray:
    return (x + 6) * np.exp(-_tail(x + 6) - _first_six(x))


def trigamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    z = 1 / (y * y)
    return 1 / y + z / 2 + z / y * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z * (1 / 30 - z * 5 / 66)))) + sum(1 / (x + i) ** 2 for i in range(6))


def log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    z = 1 / (y * y)
    series = 1 / y * (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188))))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - sum(np.log(x + i) for i in range(6))


def _log_shares(x: np.ndarray) -> np.ndarray:
    """Expected logs of shares with such Dirichlet numbers along the last axis."""
    return digamma(x) - digamma(x.sum(-1, keepdims=True))


# --- rows ------------------------------------------------------------------------------
def _sparse(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries of each row, terms, counts) of a column of vectors; entries of 0 are left out."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    at, v = pc.struct_field(vectors, "indices"), pc.struct_field(vectors, "values")
    n = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    count = v.flatten().to_numpy(zero_copy_only=False)
    dense = pc.fill_null(pc.equal(pc.struct_field(vectors, "type"), 1), False).to_numpy(zero_copy_only=False)
    term = np.arange(count.size) - np.repeat(np.cumsum(n) - n, n)
    term[~np.repeat(dense, n)] = at.flatten().to_numpy(zero_copy_only=False)
    if (count == 0).any():
        n = np.bincount(np.repeat(np.arange(n.size), n)[count != 0], minlength=n.size)
        term, count = term[count != 0], count[count != 0]
    return n, term.astype(np.int32), count.astype(np.float64)


def packed(rows: DataFrame, features: str = "features") -> DataFrame:
    """Rows as blocks of sizes, terms and counts; rows without entries, of which nothing is learned, are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, term, count = _sparse(b.column(0))
            n = n[n > 0]
            end = np.cumsum(n)
            first = start = 0
            while first < n.size:
                last = max(int(np.searchsorted(end, start + BLOCK, "right")), first + 1)
                stop = int(end[last - 1])
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (
                    n[first:last].astype(np.int32), term[start:stop], count[start:stop].astype(np.float32))], schema=_ARROW)
                first, start = last, stop

    return rows.select(features).mapInArrow(run, BLOCKS)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for b in batches:
        for n, t, c in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            yield np.frombuffer(n, np.int32), np.frombuffer(t, np.int32), np.frombuffer(c, np.float32).astype(float)


def infer(size: np.ndarray, term: np.ndarray, count: np.ndarray, odds: np.ndarray, alpha: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """The Dirichlet numbers (gamma) of each row, from a first ``guess`` for all or for each. ``odds``: for each term and
    topic the exponent of the expected log share, up to a factor of the term's own. Rows of like length are worked
    on together until each is done."""
    out = np.tile(alpha, (size.size, 1))
    start = np.cumsum(size) - size
    guess = np.broadcast_to(guess, out.shape)
    order = np.argsort(size, kind="stable")
    order = order[size[order] > 0]
    first = 0
    while first < order.size:
        widths = size[order[first:first + CELLS]]
        last = first + max(1, int(np.searchsorted(widths * np.arange(1, widths.size + 1) * alpha.size, CELLS, "right")))
        docs = order[first:last]
        first = last
        place = np.arange(int(size[docs].max()))
        real = place < size[docs][:, None]
        at = np.where(real, start[docs][:, None] + place, 0)
        c, e = np.where(real, count[at], 0.0), odds[term[at]]
        g, left = guess[docs], np.ones(docs.size, bool)
        while left.any():
            t = exp_digamma(g)
            share = c / ((e @ t[:, :, None])[:, :, 0] + 1e-100)
            new = t * (share[:, None, :] @ e)[:, 0, :] + alpha
            # Single precision would do for the sums, but not for the end: rounding alone keeps some rows moving.
            moving = np.abs(new - g).sum(1) > DONE * alpha.size
            g, ended = new, left & ~moving
            out[docs[ended]] = g[ended]
            left &= moving
            if 4 * np.count_nonzero(left) <= 3 * left.size:
                docs, c, e, g = docs[left], c[left], e[left], g[left]
                left = np.ones(docs.size, bool)
    return out


def _odds(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From a table (terms, topics): exponents of expected log shares over the largest of their term, and those logs."""
    log = digamma(table) - digamma(table.sum(0))
    most = log.max(1)
    return np.exp(log - most[:, None]), most


# --- the fit ---------------------------------------------------------------------------
class LDA:
    """Online variational Bayes: each pass draws rows (with replacement, ``sample`` of all on the mean), finds
    their topics and moves the table of terms and topics, and the document prior, towards what they say."""

    def __init__(self, k: int, max_iter: int, sample: float, seed: int, terms: int, names: dict[str, str],
                 offset: float = 1024.0, decay: float = 0.51):
        self.k, self.max_iter, self.sample, self.seed, self.terms, self.names = k, max_iter, sample, seed, terms, names
        self.offset, self.decay = offset, decay

    def fit(self, blocks: DataFrame) -> LocalLDAModel:
        """``blocks``: as ``packed`` gives them. The driver holds a few arrays of the table's size."""
        k, eta = self.k, 1.0 / self.k
        rng = np.random.default_rng(self.seed)
        table, alpha = rng.gamma(SHAPE, 1 / SHAPE, (self.terms, k)), np.full(k, 1.0 / k)
        rows = int(blocks.selectExpr("sum(length(size) div 4) AS n").first().n or 0)
        for i in range(1, self.max_iter + 1):
            odds = _odds(table)[0]
            sums = self._drawn(blocks, odds, alpha, i)
            drawn = sums[-1]
            if not drawn:
                continue
            by = (self.offset + i) ** -self.decay
            table *= 1 - by
            table += by * (sums[:-k - 1].reshape(table.shape) * odds * (rows / drawn) + eta)
            alpha = self._prior(alpha, sums[-k - 1:-1] / drawn, drawn, by)
        return local_model(blocks.sparkSession, table, alpha, eta, self.k, self.names)

    def _drawn(self, blocks: DataFrame, odds: np.ndarray, alpha: np.ndarray, turn: int) -> np.ndarray:
        """One pass: the sums by term and topic, of the rows' expected logs, and of rows, end to end."""
        sent = blocks.sparkSession.sparkContext.broadcast((odds, alpha))
        sample, seed = self.sample, self.seed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            odds, alpha = sent.value
            rng = np.random.default_rng([seed, turn, TaskContext.get().partitionId()])
            table, logs, drawn = np.zeros(odds.shape), np.zeros(alpha.size), 0
            for size, term, count in _unpacked(batches):
                times = rng.poisson(sample, size.size)
                term, count = (x[np.repeat(times > 0, size)] for x in (term, count))
                size, times = size[times > 0], times[times > 0]
                gamma = infer(size, term, count, odds, alpha, rng.gamma(SHAPE, 1 / SHAPE, (size.size, alpha.size)))
                logs += times @ _log_shares(gamma)
                drawn += int(times.sum())
                share, first = exp_digamma(gamma), 0
                for d, n in enumerate(size.tolist()):
                    at, c = term[first:first + n], count[first:first + n]
                    e = odds[at]
                    table[at] += np.outer(c * times[d] / (e @ share[d] + 1e-100), share[d])
                    first += n
            if drawn:
                # Tables cross the network in single precision and are added up in double precision.
                flat = np.concatenate([table.ravel(), logs, [drawn]]).astype(np.float32)
                for i in range(0, flat.size, SLICE):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([flat[i:i + SLICE].tobytes()], pa.binary())],
                                                     names=["at", "x"])

        size = odds.size + alpha.size + 1
        total = np.zeros(size)
        slices = -(-size // SLICE)
        for at, x in _added(blocks.mapInArrow(run, "at long, x binary"), slices):
            total[at:at + x.size] = x
        sent.destroy()
        return total

    @staticmethod
    def _prior(alpha: np.ndarray, logs: np.ndarray, n: float, by: float) -> np.ndarray:
        """A Newton step of the document prior; none where a number would leave the numbers above 0."""
        grad = n * (logs - _log_shares(alpha))
        c, q = n * float(trigamma(alpha.sum(keepdims=True))[0]), -n * trigamma(alpha)
        new = alpha - by * (grad - (grad / q).sum() / (1 / c + (1 / q).sum())) / q
        return new if (new > 0).all() else alpha


def _added(parts: DataFrame, slices: int) -> list[tuple[int, np.ndarray]]:
    """Equal slices of all tasks added up where they meet."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for at, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(raw, np.float32).astype(np.float64)
                sums[at] = sums[at] + x if at in sums else x
        for at, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([x.tobytes()], pa.binary())], names=["at", "x"])

    conf = parts.sparkSession.conf
    most, before = int(conf.get("spark.sql.shuffle.partitions")), conf.get(RELEASE, None)
    # Shuffle files of a sum are of no more use; else they would lie until the driver collects garbage, a table for
    # each task and pass.
    conf.set(RELEASE, "true")
    try:
        got = parts.repartition(min(most, slices), "at").mapInArrow(add, "at long, x binary").toArrow()
    finally:
        conf.unset(RELEASE) if before is None else conf.set(RELEASE, before)
    return [(at, np.frombuffer(x, np.float64)) for at, x in zip(got["at"].to_pylist(), got["x"].to_pylist(), strict=True)]


def local_model(spark: SparkSession, table: np.ndarray, alpha: np.ndarray, eta: float, k: int, names: dict[str, str]) -> LocalLDAModel:
    """The library's own model of a table (terms, topics), to save, load and describe."""
    jvm = spark.sparkContext._jvm
    matrix = jvm.org.apache.spark.mllib.linalg.Matrices.fromML(_py2java(spark.sparkContext, DenseMatrix(
        *table.shape, np.ascontiguousarray(table.T).ravel())))
    prior = jvm.org.apache.spark.mllib.linalg.Vectors.fromML(_py2java(spark.sparkContext, DenseVector(alpha)))
    old = jvm.org.apache.spark.mllib.clustering.LocalLDAModel(matrix, prior, float(eta), SHAPE)
    uid = Identifiable().uid.replace("Identifiable", "LDA")
    made = LocalLDAModel(JavaWrapper._new_java_obj("org.apache.spark.ml.clustering.LocalLDAModel", uid, table.shape[0], old, spark._jsparkSession))
    return made._set(k=k, optimizer="online", **names)


# --- what a model says of rows ------------------------------------------------------------
def _learned(model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table by term and topic, document prior, first guess) of a local model."""
    alpha = model.estimatedDocConcentration().toArray()
    return model.topicsMatrix().toArray(), alpha, np.random.default_rng(0).gamma(SHAPE, 1 / SHAPE, alpha.size)


def shares(model, rows: DataFrame, key: str, features: str = "features", name: str = "gamma") -> DataFrame:
    """(key, shares of topics); a row without a known term gets the learned prior."""
    table, alpha, guess = _learned(model)
    sent = rows.sparkSession.sparkContext.broadcast((_odds(table)[0], alpha, guess))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gamma = infer(*_sparse(b.column(1)), *sent.value)
            gamma /= gamma.sum(1, keepdims=True)
            ends = pa.array(np.arange(0, gamma.size + 1, gamma.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, pa.array(gamma.ravel()))], names=[key, name])

    return rows.select(key, features).mapInArrow(run, StructType([rows.schema[key], StructField(name, ArrayType(DoubleType()))]))


def bound_per_word(model, rows: DataFrame, features: str = "features") -> float:
    """The variational bound of the rows' log probability over their words."""
    table, alpha, guess = _learned(model)
    eta = float(model._java_obj.oldLocalModel().topicConcentration())
    odds, most = _odds(table)
    sent = rows.sparkSession.sparkContext.broadcast((odds, most, alpha, guess))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, most, alpha, guess = sent.value
        bound = words = 0.0
        for b in batches:
            size, term, count = _sparse(b.column(0))
            words += float(count.sum())
            gamma = infer(size, term, count, odds, alpha, guess)[size > 0]
            logs = _log_shares(gamma)
            share, first = np.exp(logs), 0
            for d, n in enumerate(size[size > 0].tolist()):
                at, c = term[first:first + n], count[first:first + n]
                bound += float(c @ (np.log(odds[at] @ share[d]) + most[at]))
                first += n
            bound += float(((alpha - gamma) * logs + log_gamma(gamma) - log_gamma(alpha)).sum())
            bound += float(log_gamma(alpha.sum(keepdims=True))[0] * len(gamma) - log_gamma(gamma.sum(1)).sum())
        yield pa.RecordBatch.from_arrays([pa.array([bound]), pa.array([words])], names=["bound", "words"])

    got = rows.select(features).mapInArrow(run, "bound double, words double").groupBy().sum("bound", "words").first()
    logs = digamma(table) - digamma(table.sum(0))
    topics = float(((eta - table) * logs + log_gamma(table)).sum()) - table.size * float(log_gamma(np.array([eta]))[0])
    topics += float((log_gamma(np.array([eta * table.shape[0]])) - log_gamma(table.sum(0))).sum())
    return ((got[0] or 0.0) + topics) / got[1] if got[1] else float("nan")
