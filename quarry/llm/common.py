"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import cut_lineage, cut_lineage_by, ensure_checkpoint_dir, ship_package

# A-Z to a-z, every other byte unchanged
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


BATCH = "8m"                 # bytes of a batch that goes to a Python worker


def prepare(spark: SparkSession) -> None:
    """Make the session ready for Python workers and reliable checkpoints. Batches for workers are bounded by bytes (a
    smaller bound of the session's own stays): a batch stands in the executor's memory twice, beside its heap."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "67108864b") in ("67108864b", "64m", "64MB"):
        spark.conf.set(key, BATCH)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the scan prunes columns as usual."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Project to the named columns under fixed names, so that extra columns of the input, whatever they
    are called, can never clash with an operator's own."""
    return df.select(*[F.col(f"`{src}`").alias(name) for name, src in columns.items()])


def give_back() -> None:
    """Return freed memory to the system. Python workers outlive their tasks, and what their allocators keep for
    later counts against the executor while other work runs there."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_KEPT: dict[str, dict] = {}   # what this worker keeps from task to task, by module


def kept(module: str) -> dict:
    """A place for what tasks of a module load once and find again in the same worker. It is emptied as soon as a task
    of another module comes to the worker."""
    return _KEPT.setdefault(module, {})


def let_go(module: str) -> None:
    """Drop what tasks of other modules kept in this worker."""
    for name, things in _KEPT.items():
        if name != module and things:
            things.clear()
            give_back()


def tidy(f: Callable) -> Callable:
    """``f`` for mapInArrow (a generator), a grouped (table) or a cogrouped (key, left, right) applyInArrow, which
    gives memory back when it is done."""
    if inspect.isgeneratorfunction(f):
        def over_batches(batches):
            let_go(f.__module__)
            try:
                yield from f(batches)
            finally:
                give_back()
        return over_batches
    if f.__code__.co_argcount == 1:
        def over_group(table):
            let_go(f.__module__)
            try:
                return f(table)
            finally:
                give_back()
        return over_group

    def over_cogroup(key, left, right):
        let_go(f.__module__)
        try:
            return f(key, left, right)
        finally:
            give_back()
    return over_cogroup


def text_chunks(src: DataFrame, chunk_bytes: int) -> DataFrame:
    """The rows of ``src`` in chunks of about ``chunk_bytes`` bytes of its binary column ``text`` (a longer text is a
    chunk of its own): ``chunk``, ``n_bytes`` and ``body``, the rows as a compressed Arrow stream. Chunks are dealt
    over the cluster by their number and checkpointed; joins and cogroups by ``chunk`` do not move them again."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def put() -> pa.RecordBatch:
            nonlocal number
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(held).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(table)
            number += 1
            return pa.RecordBatch.from_pydict({"chunk": pa.array([number], pa.int64()),
                                               "n_bytes": pa.array([size], pa.int64()),
                                               "body": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(
                zero_copy_only=False).astype(np.int64)
            at = 0
            while at < batch.num_rows:
                room = np.cumsum(lengths[at:] + 16)
                n = max(1, int(np.searchsorted(room, chunk_bytes - size, side="right")))
                held.append(batch.slice(at, n))
                size += int(room[min(n, len(room)) - 1])
                at += n
                if size >= chunk_bytes or at < batch.num_rows:
                    yield put()
                    held, size = [], 0
        if held:
            yield put()

    return cut_lineage_by(src.mapInArrow(tidy(gather), "chunk long, n_bytes long, body binary"),
                          shuffle_partitions(src.sparkSession), "chunk")


def zip_(x: np.ndarray) -> bytes:
    """The numbers of an array, compressed."""
    return len(x).to_bytes(8, "little") + bytes(pa.compress(np.ascontiguousarray(x).tobytes(), "zstd"))


def unzip(raw: bytes, kind) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.decompress(raw[8:], n * np.dtype(kind).itemsize, "zstd"), kind)


def packed_slices(t: pa.Table, of: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The rows of a table by the slice that ``of`` names for each, every slice as one compressed Arrow stream."""
    order = np.argsort(of, kind="stable")
    t, of = t.take(pa.array(order)).combine_chunks(), of[order]
    edge = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else of
    for a, b in zip(edge, np.append(edge[1:], len(of))):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(t.slice(a, b - a))
        yield int(of[a]), sink.getvalue().to_pybytes()


def summed(tables: list[pa.Table], keys: list[str], *values: str) -> pa.Table:
    """Tables as one, with a row for each key and the sums of its values."""
    whole = pa.concat_tables(tables).group_by(keys).aggregate([(v, "sum") for v in values])
    return whole.rename_columns([n.removesuffix("_sum") for n in whole.column_names]).select([*keys, *values])


def rows_of(body: pa.Scalar) -> pa.Table:
    """The rows of one chunk."""
    return pa.ipc.open_stream(body.as_buffer()).read_all()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge list ``(a, b)`` of longs, as ``(node, component)`` with the
    component named by its smallest node. Only nodes that have an edge appear.

    Alternates the two star operations of Kiveris et al. ("Connected Components in MapReduce and Beyond"):
    large-star points every larger neighbour of a node at the node's smallest neighbour, small-star does it for
    the smaller ones. Each is one aggregation and one join on the node, so a hub's neighbours are spread by
    Spark's skew join; nothing is gathered per node or on the driver. Each round is a reliable checkpoint.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        if small:  # a > b: all smaller neighbours and the node itself go to the smallest one
            joined = both.join(least, "a")
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b")))
        else:      # larger neighbours go to the smallest of the neighbourhood
            out = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where("a > b").distinct()

    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = cut_lineage(e)
    last = None
    for _ in range(rounds):
        e = cut_lineage(star(star(e, small=False), small=True))
        # stable when every node has one edge, to a node that has none below it
        now = e.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("decimal(38,0)")).alias("h"),
                    F.count_distinct("a").alias("d")).first()
        if now == last or now["n"] == 0:
            break
        last = now
    else:
        raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


__all__ = ["LOWER", "components", "cut_lineage", "give_back", "kept", "let_go", "only", "packed_slices", "prepare",
           "read", "rows_of", "shuffle_partitions", "summed", "text_chunks", "tidy", "unzip", "zip_"]
