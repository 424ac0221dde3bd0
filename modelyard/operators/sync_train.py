"""Synchronous mini-batch training of a dense network, one short Spark job a step.

Every worker holds one shard of the rows (R9) in the order of the endless
batches (R7).  At each step every worker takes its rows of the step's batch and
sums their gradients under the weights it is sent; the sums are added up in the
order of the workers and make one update, so the weights are the same for all.
Only weights and gradients travel, as many numbers as the network has weights,
whatever the number of rows.  (A barrier's ``allGather`` in place of the job
takes a second a step: Spark looks that often whether a barrier is passed.)

A shard lies in partitions of ``STEPS_HELD`` steps, and a step's job runs on the
partitions of that step alone.  A lost task is run again by itself; the order is
fixed by the keys, so it gives the same sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batching import repeat_batches

# The defaults of the network that is trained this way.
HIDDEN, CLASSES, BATCH = 64, 10, 64
RATE, DECAY, EPSILON = 0.001, 0.9, 1e-7
# Steps whose rows of one shard lie in one partition.
STEPS_HELD = 32


class DenseNet:
    """One hidden layer of rectified units and a softmax, in doubles."""

    def __init__(self, n_in: int, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 1,
                 rate: float = RATE, optimizer: str = "rmsprop"):
        if optimizer not in ("rmsprop", "sgd"):
            raise ValueError(f"unknown optimizer {optimizer}")
        rng = np.random.default_rng(seed)
        self.shapes = [(n_in, hidden), (hidden,), (hidden, classes), (classes,)]
        self.cuts = np.cumsum([int(np.prod(s)) for s in self.shapes])
        self.rate, self.optimizer = rate, optimizer
        flat = []
        for shape in self.shapes:
            # Uniform within sqrt(6 / (in + out)) for weights, zero for biases.
            bound = math.sqrt(6 / sum(shape)) if len(shape) == 2 else 0.0
            flat.append(rng.uniform(-bound, bound, int(np.prod(shape))) if bound else np.zeros(shape))
        self.weights = np.concatenate(flat)
        self.squares = np.zeros_like(self.weights)

    def _parts(self, flat: np.ndarray) -> list[np.ndarray]:
        return [p.reshape(s) for p, s in zip(np.split(flat, self.cuts[:-1]), self.shapes)]

    def probabilities(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hidden activations, class probabilities) of the rows of ``x``."""
        w1, b1, w2, b2 = self._parts(self.weights)
        h = np.maximum(x @ w1 + b1, 0.0)
        z = h @ w2 + b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return h, e / e.sum(axis=1, keepdims=True)

    def sums(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """[rows, summed cross-entropy, summed gradients] of some rows."""
        if not len(y):
            return np.zeros(len(self.weights) + 2)
        w2 = self._parts(self.weights)[2]
        h, p = self.probabilities(x)
        rows = np.arange(len(y))
        loss = -np.log(np.maximum(p[rows, y], EPSILON)).sum()
        d2 = p.copy()
        d2[rows, y] -= 1.0
        d1 = (d2 @ w2.T) * (h > 0)
        grads = [x.T @ d1, d1.sum(axis=0), h.T @ d2, d2.sum(axis=0)]
        return np.concatenate([[len(y), loss], *[g.ravel() for g in grads]])

    def step(self, total: np.ndarray) -> float:
        """One update from the sums of a whole batch; returns its mean loss."""
        g = total[2:] / total[0]
        if self.optimizer == "rmsprop":
            self.squares = DECAY * self.squares + (1 - DECAY) * g * g
            g = g / (np.sqrt(self.squares) + EPSILON)
        self.weights = self.weights - self.rate * g
        return float(total[1] / total[0])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _by_step(batches: Iterator[pa.RecordBatch], n_in: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(step, features, labels) of rows that arrive in step order."""
    step, xs, ys = None, [], []
    for b in batches:
        if not b.num_rows:
            continue
        of = b.column("batch_id").to_numpy()
        x = _matrix(b.column("mk_x"), n_in)
        y = b.column("mk_y").to_numpy().astype(np.int64)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
        for a, e in zip(edges, edges[1:]):
            if step is not None and of[a] != step:
                yield step, np.concatenate(xs), np.concatenate(ys)
                xs, ys = [], []
            step = int(of[a])
            xs.append(x[a:e])
            ys.append(y[a:e])
    if step is not None:
        yield step, np.concatenate(xs), np.concatenate(ys)


def _packed(n_in: int):
    """One row for each step of a partition: the step, its features and labels as bytes."""
    def run(batches):
        for step, x, y in _by_step(batches, n_in):
            yield pa.RecordBatch.from_pydict(
                {"step": pa.array([step], pa.int64()), "x": pa.array([x.tobytes()], pa.binary()),
                 "y": pa.array([y.tobytes()], pa.binary())})
    return run


def _sums_of(step: int, net_args: dict, n_in: int, weights: np.ndarray):
    """What a worker adds to ``step``: the sums of its rows, if it has any."""
    def run(rows):
        for r in rows:
            if r["step"] == step:
                net = DenseNet(n_in, **net_args)
                net.weights = weights
                yield net.sums(np.frombuffer(r["x"]).reshape(-1, n_in), np.frombuffer(r["y"], np.int64))
    return run


@dataclass
class SyncFit:
    """A trained network, the loss of every step, and a row per worker."""

    net: DenseNet
    losses: list[float]
    workers: list[tuple[int, int, int]]

    def predict(self, df: DataFrame, features: str, n_in: int) -> DataFrame:
        """Add ``prediction int`` and ``probability array<double>``; null features get nulls.

        The weights go with the task, a fixed number whatever the rows.
        """
        net = self.net
        schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields)}, " \
                 "prediction int, probability array<double>"

        def run(batches):
            for b in batches:
                x = b.column(features)
                known = x.is_valid().to_numpy(zero_copy_only=False)
                label = np.zeros(len(known), np.int32)
                probs = iter(())
                if known.any():
                    p = net.probabilities(_matrix(x.filter(x.is_valid()), n_in))[1]
                    label[known] = p.argmax(axis=1)
                    probs = iter(p.tolist())
                rows = [next(probs) if k else None for k in known]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(label, pa.int32(), mask=~known), pa.array(rows, pa.list_(pa.float64()))],
                    names=[*b.schema.names, "prediction", "probability"])
        return df.mapInArrow(run, schema)


def sync_fit(df: DataFrame, features: str, label: str, keys: Sequence[str], n_in: int, n_tasks: int,
             batch_size: int = BATCH, steps: int | None = None, epochs: int | None = None,
             hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 1, rate: float = RATE,
             optimizer: str = "rmsprop") -> SyncFit:
    """Train on ``n_tasks`` workers in step; give exactly one of ``steps`` or ``epochs``.

    ``features`` is an array of ``n_in`` numbers, ``label`` an integer from 0 to
    ``classes - 1``; rows in which either is null are left out before they are
    numbered.  Row i goes to worker ``i % n_tasks``, and position p of the
    repeated rows to step ``p div batch_size``, so the batches, and up to
    rounding the weights, are the same for any number of workers.
    """
    rows = (df.where(F.col(features).isNotNull() & F.col(label).isNotNull())
            .select(*keys, F.col(features).alias("mk_x"), F.col(label).cast("bigint").alias("mk_y")))
    n = rows.count()
    if not n or (steps if steps is not None else epochs) < 1:
        raise ValueError("no rows or no steps to train on")
    fed = repeat_batches(rows, keys, batch_size, epochs=epochs, steps=steps, n_rows=n)
    n_steps = steps if steps is not None else math.ceil(epochs * n / batch_size)
    shard = F.pmod(F.col("p") - F.lit(n).cast("bigint") * F.col("epoch"), F.lit(n_tasks))
    part = F.floor(F.col("batch_id") / STEPS_HELD) * n_tasks + shard
    packed = (fed.select("batch_id", "p", "mk_x", "mk_y", part.cast("int").alias("mk_part"))
              .repartitionById(math.ceil(n_steps / STEPS_HELD) * n_tasks, F.col("mk_part"))
              .sortWithinPartitions("p").mapInArrow(_packed(n_in), "step long, x binary, y binary"))
    net_args = {"hidden": hidden, "classes": classes, "seed": seed, "rate": rate, "optimizer": optimizer}
    net, losses, n_rows = DenseNet(n_in, **net_args), [], [0] * n_tasks
    held = packed.rdd.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for step in range(n_steps):
            work = _sums_of(step, net_args, n_in, net.weights)
            first = step // STEPS_HELD * n_tasks
            told = held.context.runJob(held.mapPartitionsWithIndex(
                lambda i, rows, work=work: ((i, s) for s in work(rows))), lambda found: found,
                range(first, first + n_tasks))
            total = np.zeros(len(net.weights) + 2)
            for i, sums in told:
                total += sums
                n_rows[i - first] += int(sums[0])
            losses.append(net.step(total))
    finally:
        held.unpersist()
    return SyncFit(net, losses, [(w, rows, n_steps) for w, rows in enumerate(n_rows)])
