"""Mini-batch softmax regression, dealt by (run, shard).

Documents are dealt once, by the hash of their key, to shards of about ``SHARD_DOCS`` documents; a cell is
one shard and one group of runs. In an epoch the task of a cell steps its runs over its shard's mini-batches,
in an order that a keyed bijection of seed, epoch and shard decides, and the parameters of a run
are averaged over its shards by document count. So the outcome depends on settings and documents alone, not
on files, partitions or batches of rows.

Parameters are tables of blocks that executors write and read; the driver sees one loss and one score for each
run and epoch. The dealt documents lie in buckets by cell, so an epoch moves parameters, not documents, and
sorts nothing. Documents that one task can hold are stepped through there, shard by shard, by a task for each group
of runs that runs all their epochs at once, with the same result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textspark.operators.optim import BETA1, BETA2, EPS, MOMENTUM, check_optimizer
from textspark.operators.shuffle import keys, places
from textspark.operators.softmax import BIAS
from textspark.session import claim, drop_tables, materialise, materialise_at, work_dir
from textspark.sources.artefacts import exists, load_json, save_json

ROWS = 1024  # features of one block of parameters
SHARD_DOCS = 8192  # documents of one shard, about: what one task steps through between two averages
SLICE_BITS = 3  # a shard is packed in 2^3 slices of its keys, so in tasks of about 1024 documents
PIECE_DOCS = 32  # documents of one row of the dealt table; Spark copies a row several times on its way to Python
PARAMETER_BYTES = 512 << 20  # parameters and moments of the configurations that share a pass
SCORED = 64  # documents scored together
BLOCK_CELLS = 8 << 20  # numbers of a batch with all columns, at most
WHOLE_BYTES = 192 << 20  # documents of up to so many bytes are held by every task that trains a group of runs
RAW, GAPS, COUNTS = 0, 1, 2  # numbers of a piece as they are; columns as gaps in small bytes; values as counts in small bytes, too

BLOCK_COLUMNS = ["run", "block", "n", "steps", "loss", "w", "m", "v"]
BLOCKS = "run int, block int, n double, steps bigint, loss double, w array<double>, m array<double>, v array<double>"


@dataclass
class Setting:
    """Optimiser settings of one run."""

    optimizer: str = "adam"
    lr: float = 0.03
    l2: float = 1e-4
    batch_size: int = 16

    def __post_init__(self):
        check_optimizer(self.optimizer)


@dataclass
class State:
    """Parameters (classes last, the bias in the last row) and the moments of the optimiser."""

    w: np.ndarray
    m: np.ndarray
    v: np.ndarray
    steps: int = 0

    @classmethod
    def start(cls, n_features: int, n_classes: int, seed: int) -> "State":
        scale = (2.0 / (n_features + n_classes)) ** 0.5
        w = np.random.default_rng(seed).standard_normal((n_features + 1, n_classes)) * scale
        w[-1] = 0.0
        return cls(w, np.zeros_like(w), np.zeros_like(w))

    def copy(self) -> "State":
        return State(self.w.copy(), self.m.copy(), self.v.copy(), self.steps)

    def blocks(self, run: int, n: int, loss: float) -> pd.DataFrame:
        at = range(0, len(self.w), ROWS)
        cut = {name: [x[i : i + ROWS].ravel() for i in at] for name, x in (("w", self.w), ("m", self.m), ("v", self.v))}
        return pd.DataFrame({"run": run, "block": range(len(at)), "n": float(n), "steps": self.steps, "loss": loss, **cut})

    @classmethod
    def of(cls, frame: pd.DataFrame, n_classes: int) -> "State":
        """From the blocks of one run."""
        rows = frame.sort_values("block")
        w, m, v = (np.concatenate(rows[c].to_list()).reshape(-1, n_classes) for c in ("w", "m", "v"))
        return cls(w, m, v, int(rows["steps"].max()))


@dataclass
class Scale:
    """TF-IDF weights of counts: unit L2 norm per document."""

    idf: np.ndarray
    sublinear: bool

    def raw(self, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        tf = counts.astype(np.float64)
        return (1 + np.log(tf) if self.sublinear else tf) * self.idf[columns]

    def values(self, sizes: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The weights of documents of ``sizes`` terms, end to end."""
        raw = self.raw(columns, counts)
        return raw / np.repeat(norms(sizes, raw), sizes)


def norms(sizes: np.ndarray, raw: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.sqrt(np.bincount(owner, raw * raw, len(sizes)))


def small_bytes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers from 0 as bytes, each as often 255 as it goes and then the rest; and how many bytes each takes."""
    times, rest = np.divmod(numbers, 255)
    taken = times + 1
    out = np.full(int(taken.sum()), 255, np.uint8)
    out[np.cumsum(taken) - 1] = rest
    return out, taken


def small_numbers(data: bytes) -> np.ndarray:
    """The numbers of ``small_bytes``."""
    read = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(read != 255)
    if len(ends) == len(read):
        return read.astype(np.int64)
    return np.diff(np.cumsum(read, dtype=np.int64)[ends], prepend=0)


def _columns_bytes(sizes: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending columns of documents as ``small_bytes`` of the gaps between them."""
    gaps, first = np.diff(columns, prepend=0), (np.cumsum(sizes) - sizes)[sizes > 0]
    gaps[first] = columns[first]
    return small_bytes(gaps)


def count_bytes(sizes: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    """Of documents with ``sizes`` columns, ascending in each, the columns and counts as one run of bytes a document."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out = []
    for data, taken in (_columns_bytes(sizes, columns.astype(np.int64)), small_bytes(counts - 1)):
        ends = np.append(0, np.cumsum(np.bincount(owner, taken, len(sizes)).astype(np.int64)))
        out.append(pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]))
    return [*out, pa.array(sizes, pa.int32())]


def read_counts(sizes: np.ndarray, columns: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Columns and counts from their ``count_bytes``, all documents end to end."""
    return _cumulated(small_numbers(columns), sizes), small_numbers(counts) + 1


class Documents:
    """Sparse features and classes of the documents of one shard, in the order of their keys.

    Features stay in few bytes: a batch reads the parts of its documents, and counts become weights there.
    """

    def __init__(self, pieces: pd.DataFrame, scale: Scale | None = None) -> None:
        rows = pieces.sort_values("piece")
        self.y = np.frombuffer(b"".join(rows["y"]), "<i4").astype(np.int64)
        self.columns: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        norm, width = [], 0
        small = rows["small"] if "small" in rows else [0] * len(rows)
        for form, lengths, columns, values in zip(small, rows["sizes"], rows["columns"], rows["values"]):
            sizes = np.frombuffer(lengths, "<i4")
            ends = np.cumsum(sizes)[:-1]
            if form == RAW:
                whole, value = np.frombuffer(columns, "<i4"), np.frombuffer(values, "<f8")
            else:
                whole = _cumulated(small_numbers(columns), sizes)
                value = np.frombuffer(values, "<f8") if form == GAPS else _narrow(small_numbers(values) + 1)
            width = max(width, int(whole.max(initial=-1)) + 1)
            self.columns += np.split(whole if form == RAW else _narrow(whole), ends)
            self.values += np.split(value, ends)
            if scale:
                norm.append(norms(sizes, scale.raw(whole, value)))
        self.scale, self.norm, self.width = scale, np.concatenate([np.empty(0), *norm]), width
        self.lengths = np.array([len(c) for c in self.columns], np.int64)
        self._seen, self._place = np.zeros(width, bool), np.zeros(width, np.int64)

    def __len__(self) -> int:
        return len(self.y)

    def _parts(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and value of every number of some documents."""
        sizes = self.lengths[some]
        own, values = np.concatenate([self.columns[i] for i in some]), np.concatenate([self.values[i] for i in some])
        where = np.repeat(np.arange(len(some)), sizes)
        if self.scale:
            values = self.scale.raw(own, values) / np.repeat(self.norm[some], sizes)
        return where, own, values

    def batch(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct columns of some documents and their dense block, with a bias column of ones."""
        where, own, values = self._parts(some)
        self._seen[own] = True
        columns = np.flatnonzero(self._seen)
        self._seen[columns] = False
        self._place[columns] = np.arange(len(columns))
        block = np.zeros((len(some), len(columns) + 1))
        block[where, self._place[own]] = values
        block[:, -1] = 1.0
        return np.append(columns, -1), block

    def block(self, some: np.ndarray, n_features: int) -> tuple[slice, np.ndarray]:
        """All columns and the dense block of some documents, with a bias column of ones."""
        where, own, values = self._parts(some)
        block = np.zeros((len(some), n_features + 1))
        block.ravel()[where * (n_features + 1) + own] = values
        block[:, -1] = 1.0
        return slice(None), block

    def read(self, some: np.ndarray, n_features: int) -> tuple[np.ndarray | slice, np.ndarray]:
        """``block`` where the documents have most columns anyway, else ``batch``."""
        is_wide = self.lengths[some].sum() >= n_features and n_features * len(some) <= BLOCK_CELLS
        return self.block(some, n_features) if is_wide else self.batch(some)

    def hits(self, w: np.ndarray) -> int:
        """Documents whose class has the largest score."""
        return int(self.all_hits(np.ascontiguousarray(w.T)[None])[0])

    def all_hits(self, w: np.ndarray) -> np.ndarray:
        """``hits`` of several parameters, runs x classes x columns."""
        found, flat = np.zeros(len(w), np.int64), w.reshape(-1, w.shape[2])
        for low in range(0, len(self), SCORED):
            some = np.arange(low, min(low + SCORED, len(self)))
            columns, block = self.read(some, w.shape[2] - 1)
            z = (flat[:, columns] @ block.T).reshape(len(w), -1, len(some))
            found += (np.argmax(z, axis=1) == self.y[some]).sum(axis=1)
        return found


def _cumulated(gaps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Columns of documents of ``sizes`` from the gaps between them."""
    total = np.append(0, np.cumsum(gaps))
    return total[1:] - np.repeat(total[np.cumsum(sizes) - sizes], sizes)


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


class Stack:
    """Parameters and moments of several runs with one batch size, runs x classes x columns, so that they share matrix products.

    Moments of Adam are kept without the factors 1 - beta.
    """

    def __init__(self, runs: list[tuple[Setting, State]]) -> None:
        self.settings = [s for s, _ in runs]
        self.w, self.m, self.v = (np.stack([getattr(s, name).T for _, s in runs]) for name in "wmv")
        self.steps = [s.steps for _, s in runs]
        for k, setting in enumerate(self.settings):
            if setting.optimizer != "sgd":
                self.m[k] /= 1 - BETA1
                self.v[k] /= 1 - BETA2

    def copy(self) -> "Stack":
        return self.only(range(len(self.settings)))

    def only(self, some) -> "Stack":
        """A copy of some of the runs."""
        out = object.__new__(Stack)
        some = list(some)
        out.settings, out.steps = [self.settings[k] for k in some], [self.steps[k] for k in some]
        out.w, out.m, out.v = self.w[some], self.m[some], self.v[some]
        return out

    def state(self, k: int) -> State:
        a, b = (1, 1) if self.settings[k].optimizer == "sgd" else (1 - BETA1, 1 - BETA2)
        return State(self.w[k].T.copy(), self.m[k].T * a, self.v[k].T * b, self.steps[k])

    def epoch(self, docs: Documents, order: list[int]) -> np.ndarray:
        """Steps all runs over the documents in the order of ``order``; the mean losses."""
        line, size = np.argsort(places(len(docs), order)), self.settings[0].batch_size
        losses, grad = np.zeros(len(self.settings)), np.empty((self.w.shape[0] * self.w.shape[1], self.w.shape[2]))
        rest = np.empty(self.w.shape[1:])
        for at in range(0, len(line), size):
            some = line[at : at + size]
            losses += self._step(*docs.read(some, self.w.shape[2] - 1), docs.y[some], grad, rest) * len(some)
        return losses / len(docs)

    def _step(self, columns: np.ndarray | slice, block: np.ndarray, y: np.ndarray, grad: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """One optimiser step in place; the losses before it. ``grad`` and ``rest`` are only places to work in."""
        runs, n = len(self.settings), len(y)
        flat = self.w.reshape(grad.shape)
        z = (flat[:, columns] @ block.T).reshape(runs, -1, n)
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z, out=z)
        p /= p.sum(axis=1, keepdims=True)
        picked = np.arange(n)
        losses = -np.log(p[:, y, picked] + 1e-12).mean(axis=1)
        p[:, y, picked] -= 1.0
        p /= n
        for k, setting in enumerate(self.settings):
            if setting.optimizer == "sgd":
                p[k] *= setting.lr
        if isinstance(columns, slice):
            np.matmul(p.reshape(-1, n), block, out=grad)
        else:
            grad.fill(0.0)
            grad[:, columns] = p.reshape(-1, n) @ block
        for k, setting in enumerate(self.settings):
            g, w, m, v = grad.reshape(self.w.shape)[k], self.w[k], self.m[k], self.v[k]
            is_sgd = setting.optimizer == "sgd"
            if setting.l2 > 0:
                all_w = w.ravel()
                losses[k] += 0.5 * setting.l2 * float(all_w @ all_w - w[:, -1] @ w[:, -1])
                np.multiply(w, setting.l2 * setting.lr if is_sgd else setting.l2, out=rest)
                rest[:, -1] = 0.0
                g += rest
            self.steps[k] += 1
            if is_sgd:
                v *= MOMENTUM
                v -= g
                w += v
                continue
            m *= BETA1
            m += g
            v *= BETA2
            np.multiply(g, g, out=g)
            v += g
            np.sqrt(v, out=g)
            scale = ((1 - BETA2) / (1 - BETA2 ** self.steps[k])) ** 0.5
            g += EPS / scale
            np.divide(m, g, out=g)
            g *= setting.lr * (1 - BETA1) / (1 - BETA1 ** self.steps[k]) / scale
            w -= g
        return losses

    def average(self, others: list["Stack"], shares: list[int]) -> None:
        """Becomes the mean of others by their shares; steps as in ``epoch_plan``."""
        total = sum(shares)
        for name in "wmv":
            mean = getattr(self, name)
            mean.fill(0.0)
            for other, share in zip(others, shares):
                mean += getattr(other, name) * (share / total)
        for k in range(len(self.steps)):
            self.steps[k] = int(np.ceil(sum(o.steps[k] * n for o, n in zip(others, shares)) / total - 1e-9))


def _epoch(docs: Documents, runs: list[tuple[Setting, State]], order: list[int]) -> list[float]:
    """Steps all runs, in place, over the documents in the order of ``order``; the mean losses. Runs share batches."""
    losses = [0.0] * len(runs)
    for size in {s.batch_size for s, _ in runs}:
        own = [k for k, (s, _) in enumerate(runs) if s.batch_size == size]
        stack = Stack([runs[k] for k in own])
        for k, loss in zip(own, stack.epoch(docs, order)):
            losses[k] = float(loss)
        for i, k in enumerate(own):
            vars(runs[k][1]).update(vars(stack.state(i)))
    return losses


def _no_rows(names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([], dtype=object) for c in names})


# -- documents


def sparse_columns(df: DataFrame) -> DataFrame:
    """``indices, values, y`` of documents with ML vectors ``features``, and ``doc_id`` if there is one; or their ``count_bytes``."""
    key = ["doc_id"] if "doc_id" in df.columns else []
    if "features" not in df.columns:
        return df.select(*key, "indices", "values", "sizes", "y")
    raw = F.unwrap_udt("features")
    return df.select(*key, vector_indices(raw).alias("indices"), raw["values"].alias("values"), "y")


def vector_indices(raw: Column) -> Column:
    """Positions of the stored numbers of an ML vector; a dense one stores all."""
    dense = F.when(F.size(raw["values"]) > 0, F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    return F.when(raw["type"] == 1, F.coalesce(dense, F.array().cast("array<int>"))).otherwise(raw["indices"])


PIECE = "shard int, piece int, n bigint, small int, y binary, sizes binary, columns binary, values binary"


@dataclass
class Dealt:
    """Documents in cells: cell ``group * shards + shard`` holds a shard for a group of runs.

    Before ``spread``, and where every task reads all documents, they are there once, in the cells of group 0.
    """

    table: DataFrame
    shards: int
    groups: int
    n: int
    scale: Scale | None = None
    name: str | None = None
    path: str = ""

    def group(self, run: int) -> int:
        return run % self.groups

    def bytes(self) -> int:
        return self.table.agg(F.sum(F.octet_length("columns") + F.octet_length("values"))).first()[0] or 0

    def spread(self) -> None:
        """A copy of the documents for every group of runs."""
        if self.groups == 1:
            return
        cell = F.explode(F.transform(F.sequence(F.lit(0), F.lit(self.groups - 1)), lambda g: g * self.shards + F.col("shard"))).alias("cell")
        cells = self.table.select(cell, *[c for c in self.table.columns if c != "cell"])
        buckets, old = min(self.shards * self.groups, 1 << 16), Dealt(self.table, 1, 1, 0, None, self.name, self.path)
        self.name, self.path = _bucketed(cells.repartition(buckets, "cell"), buckets)
        self.table = self.table.sparkSession.table(self.name)
        old.drop()

    def drop(self) -> None:
        """The table and its files go."""
        if self.name:
            self.table.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")
        drop_tables(self.table.sparkSession, [self.path])


def _bucketed(cells: DataFrame, buckets: int) -> tuple[str, str]:
    """Name and folder of a table of cells, written in buckets: rows that are dealt to as many partitions move no more."""
    name, path = f"textspark_{uuid.uuid4().hex}", f"{work_dir(cells.sparkSession)}/stage-{uuid.uuid4().hex}"
    claim(path)
    cells.write.bucketBy(buckets, "cell").option("path", path).saveAsTable(name)
    return name, path


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition as pieces of one slot, a slice of a shard, each; pieces of a shard are numbered by slice."""
    slot, piece, held = None, 0, []

    def made() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        if "sizes" in table.column_names:
            form, sizes = COUNTS, table["sizes"].to_numpy().astype("<i4")
            columns, values = (b"".join(table[c].to_pylist()) for c in ("indices", "values"))
        else:
            form, sizes = GAPS, pc.list_value_length(table["values"]).to_numpy().astype("<i4")
            lists = [table[c].combine_chunks().flatten() for c in ("indices", "values")]
            columns = _columns_bytes(sizes, lists[0].to_numpy(zero_copy_only=False).astype(np.int64))[0].tobytes()
            values = lists[1].to_numpy(zero_copy_only=False).astype("<f8").tobytes()
        numbers = ((slot >> SLICE_BITS, pa.int32()), (piece, pa.int32()), (len(sizes), pa.int64()), (form, pa.int32()))
        row = [pa.array([x], t) for x, t in numbers]
        parts = [table["y"].to_numpy().astype("<i4").tobytes(), sizes.tobytes(), columns, values]
        return pa.RecordBatch.from_arrays([*row, *(pa.array([x], pa.binary()) for x in parts)], names=["shard", "piece", "n", "small", "y", "sizes", "columns", "values"])

    for batch in batches:
        key = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        for lo, hi in zip(cuts, cuts[1:]):
            while lo < hi:
                if slot != key[lo] or sum(b.num_rows for b in held) >= PIECE_DOCS:
                    if held:
                        yield made()
                    piece = piece + 1 if slot == key[lo] else int(key[lo]) % (1 << SLICE_BITS) << (31 - SLICE_BITS)
                    slot, held = int(key[lo]), []
                step = min(hi - lo, PIECE_DOCS - sum(b.num_rows for b in held))
                held.append(batch.slice(lo, step))
                lo += step
    if held:
        yield made()


def deal(docs: DataFrame, groups: int, shards: int | None = None, bucketed: bool = True, n: int | None = None, scale: Scale | None = None) -> Dealt:
    """Deals ``sparse_columns`` once; documents without a key are told apart by their content.

    Documents lie there once, for ``groups`` they are copied by ``spread``. ``n``, if it is known, is their number.
    """
    spark = docs.sparkSession
    n = docs.count() if n is None else n
    shards = shards or max(-(-n // SHARD_DOCS), 1)
    content = [c for c in docs.columns if c != "doc_id"]
    key = F.xxhash64(*(["doc_id"] if "doc_id" in docs.columns else content))
    # The upper bits of a key, in its order: slices one after the other are the shard in the order of its keys.
    part = F.shiftright(key, 64 - SLICE_BITS) + (1 << (SLICE_BITS - 1))
    slot = F.pmod(key, F.lit(shards)) * (1 << SLICE_BITS) + part
    rows = docs.select(slot.cast("long").alias("slot"), key.alias("_key"), *content)
    rows = rows.repartition(min(shards << SLICE_BITS, 1 << 16), "slot").sortWithinPartitions("slot", "_key", *content).select("slot", *content)
    cells = rows.mapInArrow(_packed, PIECE).select(F.col("shard").alias("cell"), *[x.split(" ")[0] for x in PIECE.split(", ")])
    if not bucketed:
        table, path = materialise_at(cells)
        return Dealt(table, shards, groups, n, scale, None, path)
    buckets = min(shards, 1 << 16)
    name, path = _bucketed(cells.repartition(buckets, "cell"), buckets)
    return Dealt(spark.table(name), shards, groups, n, scale, name, path)


# -- runs


@dataclass
class Run:
    """One configuration under training; ``best`` and ``last`` name tables of blocks in the shared folder."""

    setting: Setting
    number: int = 0
    history: list[dict] = field(default_factory=list)
    best: str = ""
    last: str = ""
    best_score: float = -1.0
    best_epoch: int = 0
    waited: int = 0
    train_acc: float = 0.0

    def record(self, epoch: int, loss: float, score: float, path: str = "") -> None:
        """Keep the first strict improvement; count the epochs since."""
        self.history.append({"epoch": epoch, "loss": loss, "score": score})
        self.last = path
        if score > self.best_score:
            self.best_score, self.best_epoch, self.best, self.waited = score, epoch, path, 0
        else:
            self.waited += 1

    def weights(self, spark: SparkSession, n_features: int, n_classes: int, last: bool = False) -> DataFrame:
        """``(term_id, w)`` of the best epoch, or the last one; the bias is term ``BIAS``."""
        blocks = spark.read.parquet(self.last if last else self.best).where(F.col("run") == self.number)
        if "best" in blocks.columns:
            blocks = blocks.where(F.col("best") != F.lit(last))
        size = F.size("w") / n_classes
        row = F.transform(
            F.sequence(F.lit(0).cast("long"), size.cast("long") - 1),
            lambda i: F.struct((F.col("block") * ROWS + i).alias("term_id"), F.slice("w", (i * n_classes + 1).cast("int"), F.lit(n_classes)).alias("w")),
        )
        term = F.when(F.col("term_id") == n_features, F.lit(BIAS)).otherwise(F.col("term_id")).cast("long")
        return blocks.select(F.inline(row)).select(term.alias("term_id"), "w")


def _cells_of(blocks: DataFrame, dealt: Dealt) -> DataFrame:
    """Blocks once for every cell of their run's group."""
    first = F.pmod(F.col("run"), F.lit(dealt.groups)) * dealt.shards
    return blocks.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(dealt.shards - 1)), lambda s: first + s)))


def start_blocks(spark: SparkSession, runs: list[Run], n_features: int, n_classes: int, seed: int) -> str:
    """The table of start values, made by one task from the seed; all runs start alike."""
    numbers = [r.number for r in runs]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number in frame["run"]:
                yield State.start(n_features, n_classes, seed).blocks(number, 1, 0.0)

    return materialise_at(spark.createDataFrame([(n,) for n in numbers], "run int").mapInPandas(work, BLOCKS))[1]


def given_blocks(start: DataFrame, runs: list[Run], n_features: int) -> str:
    """The table of start values from ``(term_id, w)`` with every feature, and the bias as term ``BIAS``."""
    at = F.when(F.col("term_id") == BIAS, F.lit(n_features)).otherwise(F.col("term_id"))
    rows = start.select(F.floor(at / ROWS).cast("int").alias("block"), at.alias("at"), "w")
    w = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "w"))), lambda r: r["w"]))
    blocks = rows.groupBy("block").agg(w.alias("w"))
    zeros = F.transform("w", lambda _: F.lit(0.0))
    run = F.explode(F.array(*[F.lit(r.number) for r in runs])).alias("run")
    out = blocks.select(run, "block", F.lit(1.0).alias("n"), F.lit(0).cast("bigint").alias("steps"), F.lit(0.0).alias("loss"), "w", zeros.alias("m"), zeros.alias("v"))
    return materialise_at(out)[1]


def epoch_plan(blocks: DataFrame, dealt: Dealt, settings: dict[int, Setting], n_classes: int, seed: int, epoch: int) -> DataFrame:
    """The blocks after one more epoch: cells step, then runs are averaged over their shards by document count."""

    scale = dealt.scale

    def cell(documents: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        if not len(documents) or not len(given):
            return _no_rows(BLOCK_COLUMNS)
        docs, shard = Documents(documents, scale), int(documents["shard"].iloc[0])
        own = [(run, State.of(rows, n_classes)) for run, rows in given.groupby("run")]
        losses = _epoch(docs, [(settings[run], state) for run, state in own], keys(seed, epoch, shard))
        return pd.concat([state.blocks(run, len(docs), loss) for (run, state), loss in zip(own, losses)])

    laid = _cells_of(blocks.where(F.col("run").isin(*settings)), dealt)
    moved = dealt.table.groupBy("cell").cogroup(laid.groupBy("cell")).applyInPandas(cell, BLOCKS)
    mean = [vector_to_array(Summarizer.mean(array_to_vector(F.col(c)), F.col("n"))).alias(c) for c in ("w", "m", "v")]
    share = F.sum(F.col("n"))
    return moved.groupBy("run", "block").agg(
        share.alias("n"), F.ceil(F.sum(F.col("steps") * F.col("n")) / share - 1e-9).alias("steps"), (F.sum(F.col("loss") * F.col("n")) / share).alias("loss"), *mean
    )


def accuracies(dealt: Dealt, blocks: DataFrame, runs: list[int], n_classes: int) -> dict[int, float]:
    """Accuracy of every run on dealt documents; 0 for an empty table."""

    scale = dealt.scale

    def cell(documents: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        if not len(documents) or not len(given):
            return _no_rows(["run", "hits"])
        own = [(run, np.concatenate(rows.sort_values("block")["w"].to_list()).reshape(-1, n_classes).T) for run, rows in given.groupby("run")]
        hits = Documents(documents, scale).all_hits(np.stack([w for _, w in own]))
        return pd.DataFrame({"run": [run for run, _ in own], "hits": hits})

    laid = _cells_of(blocks.where(F.col("run").isin(*runs)).select("run", "block", "w"), dealt)
    scored = dealt.table.groupBy("cell").cogroup(laid.groupBy("cell")).applyInPandas(cell, "run int, hits long")
    found = {r["run"]: r["hits"] for r in scored.groupBy("run").agg(F.sum("hits").alias("hits")).collect()}
    return {run: found.get(run, 0) / dealt.n if dealt.n else 0.0 for run in runs}


def train(
    train_df: DataFrame,
    dev_df: DataFrame | None,
    settings: list[Setting],
    n_features: int,
    n_classes: int,
    epochs: int,
    patience: int,
    seed: int = 42,
    shards: int | None = None,
    checkpoint: str | None = None,
    start: DataFrame | None = None,
    beside: int = 1,
    scale: Scale | None = None,
    sizes: tuple[int, int] | None = None,
) -> list[Run]:
    """Train all settings side by side with early stopping on the dev accuracy.

    Both tables hold ML vectors ``features``, class numbers ``y`` and a ``doc_id``. Without a dev table the
    train accuracy is scored and nothing stops early. ``shards`` follows the number of documents unless it
    is given. With ``checkpoint``, a folder, every epoch leaves its parameters, history and patience
    there, and a call that finds one of the same settings goes on from it. ``start`` gives the first
    parameters as ``(term_id, w)``, all features and the bias (term ``BIAS``). As ``beside`` calls run side by
    side, the cores are shared by so many. No documents are an error.

    In place of vectors there may be ``count_bytes``, with the ``scale`` that makes weights of counts; ``sizes`` are the
    numbers of train and dev documents, if they are known.
    """
    spark = train_df.sparkSession
    at_once = max(PARAMETER_BYTES // ((n_features + 1) * n_classes * 3 * 8), 1)
    data = sparse_columns(train_df)
    n = sizes[0] if sizes else data.count()
    if not n:
        raise ValueError("no documents to train on")
    held_out = None if dev_df is None else sparse_columns(dev_df)
    shards = shards or max(-(-n // SHARD_DOCS), 1)
    # Every group reads all documents, so there are no more than keep the cores busy.
    cores = -(-2 * spark.sparkContext.defaultParallelism // beside)
    groups = max(min(-(-cores // shards), len(settings)), 1)
    runs, made = [Run(s, k) for k, s in enumerate(settings)], []
    try:
        made.append(deal(data, groups, shards, True, n, scale))
        # Scoring one shard with all runs is cheap, so dev documents need no more groups than the train ones.
        if held_out is not None:
            made.append(deal(held_out, groups, None, True, sizes and sizes[1], scale))
        dealt, scored = made[0], made[-1]
        # What one task can hold is trained to the end there, group of runs by group of runs.
        whole = checkpoint is None and start is None and sum(d.bytes() for d in made) <= WHOLE_BYTES
        if whole:
            dealt.groups = max(min(cores, len(settings)), 1)
        else:
            for one in made:
                one.spread()
        for first in range(0, len(runs), at_once):
            some = runs[first : first + at_once]
            if whole:
                _all_epochs(some, dealt, None if held_out is None else scored, n_features, n_classes, epochs, patience, seed)
            else:
                folder = checkpoint and f"{checkpoint}/{first}"
                _advance(some, dealt, scored, n_features, n_classes, epochs, patience, seed, held_out is not None, folder, start)
    finally:
        for one in made:
            one.drop()
    return runs


def _all_epochs(
    runs: list[Run], dealt: Dealt, scored: Dealt | None, n_features: int, n_classes: int, epochs: int, patience: int, seed: int
) -> None:
    """Each task trains a group of runs to the end over all shards, and returns histories and blocks."""
    given = {r.number: asdict(r.setting) for r in runs}
    groups, tested, scale = dealt.groups, scored is not None, dealt.scale
    schema = BLOCKS + ", best boolean, history array<struct<epoch: int, loss: double, score: double>>, train_acc double"

    def trained(own: list[Run], shards: dict[int, Documents], tests: list[Documents]) -> Iterator[pd.DataFrame]:
        n, n_tests = sum(len(d) for d in shards.values()), sum(len(d) for d in tests)
        begin = State.start(n_features, n_classes, seed)
        best: dict[int, np.ndarray] = {}
        last: dict[int, np.ndarray] = {}
        for size in dict.fromkeys(r.setting.batch_size for r in own):
            live = [r for r in own if r.setting.batch_size == size]
            stack = Stack([(r.setting, begin) for r in live])
            for epoch in range(1, epochs + 1):
                parts, losses = [], np.zeros(len(live))
                for shard, docs in shards.items():
                    part = stack.copy() if len(shards) > 1 else stack
                    losses += part.epoch(docs, keys(seed, epoch, shard)) * len(docs) / n
                    parts.append(part)
                if len(shards) > 1:
                    stack.average(parts, [len(d) for d in shards.values()])
                scores = sum(d.all_hits(stack.w) for d in tests) / n_tests if n_tests else np.zeros(len(live))
                for k, run in enumerate(live):
                    run.record(epoch, float(losses[k]), float(scores[k]))
                    if not run.waited:
                        best[run.number] = stack.w[k].T.copy()
                going = [k for k, r in enumerate(live) if epoch < epochs and not (tested and r.waited >= patience)]
                if len(going) < len(live):
                    last |= {r.number: stack.w[k].T.copy() for k, r in enumerate(live) if k not in going}
                    live, stack = [live[k] for k in going], stack.only(going)
                if not live:
                    break
        for run in own:
            final = best.get(run.number, last[run.number])
            train_acc = sum(d.hits(final) for d in shards.values()) / n
            for is_best, w in ((True, final), (False, last[run.number])):
                none = np.zeros((0, n_classes))  # moments are of use only to go on
                blocks = State(w, none, none, run.history[-1]["epoch"]).blocks(run.number, n, 0.0)
                blocks["best"] = is_best
                blocks["history"] = [run.history if is_best and b == 0 else [] for b in blocks["block"]]
                blocks["train_acc"] = train_acc
                yield blocks

    def group(number: int):
        def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = [f for f in frames if len(f)]
            if not held:
                return
            pieces = pd.concat(held)
            del held
            own = [Run(Setting(**s), run) for run, s in given.items() if run % groups == number]
            parts = {k: Documents(p, scale) for k, p in pieces.groupby(["train", "shard"])}
            del pieces
            shards = {int(shard): docs for (train, shard), docs in parts.items() if train}
            yield from trained(own, shards, [docs for (train, _), docs in parts.items() if not train] if tested else [*shards.values()])

        return work

    parts = dealt.table.withColumn("train", F.lit(True))
    if scored is not None:
        parts = parts.unionByName(scored.table.withColumn("train", F.lit(False)))

    def done(number: int) -> tuple[DataFrame, str]:
        return materialise_at(parts.coalesce(1).mapInPandas(group(number), schema))

    # A job for each group, side by side: one plan for all of them would put them into one task.
    numbers = [g for g in range(groups) if any(run % groups == g for run in given)]
    with ThreadPoolExecutor(len(numbers)) as pool:
        started = [pool.submit(copy_context().run, done, g) for g in numbers]
        tables = [s.result() for s in started]
    for table, path in tables:
        for row in table.where("best and block = 0").select("run", "history", "train_acc").collect():
            run = next(r for r in runs if r.number == row["run"])
            for entry in row["history"]:
                run.record(entry["epoch"], entry["loss"], entry["score"], path)
            run.best = run.last = path
            run.train_acc = row["train_acc"]


def _advance(
    runs: list[Run], dealt: Dealt, scored: Dealt, n_features: int, n_classes: int, epochs: int, patience: int, seed: int, stops: bool, checkpoint: str | None, start: DataFrame | None
) -> None:
    """Epoch by epoch, one job each and one to score; tables of epochs that are nobody's best go."""
    spark = dealt.table.sparkSession
    place = f"{checkpoint}/state" if checkpoint else None
    done, path = _resumed(spark, runs, place)
    if path is None:
        path = start_blocks(spark, runs, n_features, n_classes, seed) if start is None else given_blocks(start, runs, n_features)
        for run in runs:
            run.best = run.last = path

    for epoch in range(done + 1, epochs + 1):
        live = [r for r in runs if not stops or r.waited < patience]
        if not live:
            break
        settings = {r.number: r.setting for r in live}
        plan = epoch_plan(spark.read.parquet(path), dealt, settings, n_classes, seed, epoch)
        kept = {r.best for r in runs} | {r.last for r in runs}
        if checkpoint:
            table, new = plan, f"{checkpoint}/epoch-{epoch}"
            table.write.mode("overwrite").parquet(new)
            table = spark.read.parquet(new)
        else:
            table, new = materialise_at(plan)
        losses = {r["run"]: r["loss"] for r in table.where("block = 0").select("run", "loss").collect()}
        scores = accuracies(scored, table, list(settings), n_classes)
        for run in live:
            run.record(epoch, losses[run.number], scores[run.number], new)
        if place:
            _save(spark, runs, place, epoch, new)
        drop_tables(spark, sorted(kept - {r.best for r in runs} - {r.last for r in runs}))
        path = new
    by_table: dict[str, list[Run]] = {}
    for run in runs:
        by_table.setdefault(run.best, []).append(run)
    for best, own in by_table.items():
        found = accuracies(dealt, spark.read.parquet(best), [r.number for r in own], n_classes)
        for run in own:
            run.train_acc = found[run.number]


def _save(spark: SparkSession, runs: list[Run], place: str, epoch: int, path: str) -> None:
    """The manifest of an epoch; it is complete before an older one goes, so one always is."""
    save_json(spark, f"{place}-{epoch}", {"epoch": epoch, "path": path, "runs": [asdict(r) for r in runs]})
    drop_tables(spark, [f"{place}-{epoch - 1}"])


def _resumed(spark: SparkSession, runs: list[Run], place: str | None) -> tuple[int, str | None]:
    """Takes over the newest manifest, if it is of the same settings: its epoch and parameters."""
    if place is None:
        return 0, None
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place).getParent()
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0, None
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    epochs = sorted((int(n.split("-")[1]) for n in names if n.startswith("state-") and exists(spark, f"{folder}/{n}/_SUCCESS")), reverse=True)
    if not epochs:
        return 0, None
    saved = load_json(spark, f"{place}-{epochs[0]}")
    if [r["setting"] for r in saved["runs"]] != [asdict(r.setting) for r in runs]:
        raise ValueError(f"the checkpoint at {place} is of other settings")
    for run, entry in zip(runs, saved["runs"]):
        for name, value in entry.items():
            if name != "setting":
                setattr(run, name, value)
    return saved["epoch"], saved["path"]
