"""Near-duplicate embeddings by hierarchical navigable small-world graphs.

Equal vectors of a label are one class. The classes of a label are dealt into shards of a bounded size, each with a
graph of its own; every class queries every shard of its label, in blocks, and what the graphs offer is verified by its
cosine in double precision. In every block and shard a sample of the queries is compared with all vectors of the shard;
until that audit finds the wanted share of the true pairs, the beam is doubled (at last to the whole shard). A task
passes on the number of links of each class and a spanning forest of the links it found, not the links; the forests
are united by distributed connected components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import hnsw
from quarry.llm.common import components, cut_lineage, tidy

COSINE = 0.98
SHARD = 16_384               # classes of a graph
BLOCK = 2_048                # classes that query it in one task
RECALL = 0.99                # share of true pairs that an audit must find
AUDIT = 48                   # queries that an audit compares at a time
PAIRS = 64                   # true pairs that it must see
_SLACK = 1e-4                # single precision offers a little more; double precision decides


def unit(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in double precision and their lengths."""
    v = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1) if raw else np.zeros((0, 1))
    return v, np.sqrt((v * v).sum(1))


def verified(v: np.ndarray, length: np.ndarray, q: np.ndarray, q_length: float, nodes: np.ndarray,
             least: float) -> np.ndarray:
    return nodes[(v[nodes] @ q) / (length[nodes] * q_length) >= least]


def search_block(v: np.ndarray, length: np.ndarray, uid: np.ndarray, graph: hnsw.Graph, q: np.ndarray,
                 q_length: np.ndarray, q_uid: np.ndarray, least: float, recall: float,
                 pairs: int = PAIRS) -> tuple[list[np.ndarray], float, int, int]:
    """Verified links of every query into one shard; the share of an audit's true pairs that the graph offered, how many
    true pairs the audit saw, and the beam it took.

    The audit compares queries with the whole shard, in an order that tells nothing about them, until it has seen
    ``pairs`` true pairs; a vector's pair with itself is none. In a block with fewer true pairs every query is audited.
    If the widest beam finds too few (nodes can be out of reach of the entry), all queries are compared with the shard.
    """
    x = (q / q_length[:, None]).astype(np.float32)
    order = np.random.default_rng(len(q)).permutation(len(q))
    true: dict[int, np.ndarray] = {}
    seen = 0

    def exactly(some: np.ndarray) -> None:
        cosine = (q[some] @ v.T) / (q_length[some, None] * length[None, :])
        for i, row in zip(some.tolist(), cosine):
            near = np.flatnonzero(row >= least - 1e-9)         # the same arithmetic decides as for offered nodes
            true[i] = verified(v, length, q[i], q_length[i], near, least)

    for lo in range(0, len(order), AUDIT):
        some = order[lo:lo + AUDIT]
        exactly(some)
        seen += sum(int((uid[true[i]] != q_uid[i]).sum()) for i in some.tolist())
        if seen >= pairs:
            break
    audited = np.array(sorted(true), np.int64)
    beam, share = min(hnsw.BEAM, max(1, len(v))), 1.0
    while seen:
        got = 0
        for lo in range(0, len(audited), hnsw.BATCH):
            some = audited[lo:lo + hnsw.BATCH]
            for i, o in zip(some.tolist(), graph.near(x[some], least - _SLACK, beam)):
                got += int(np.isin(true[i][uid[true[i]] != q_uid[i]], o).sum())
        share = got / seen
        if share >= recall or beam >= len(v):
            break
        beam = min(2 * beam, len(v))
    if share < recall:
        exactly(np.array([i for i in range(len(q)) if i not in true], np.int64))
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(q)
    for lo in range(0, len(q), hnsw.BATCH):
        for i, o in enumerate(graph.near(x[lo:lo + hnsw.BATCH], least - _SLACK, beam), lo):
            out[i] = verified(v, length, q[i], q_length[i], o, least)
    for i, nodes in true.items():
        out[i] = np.union1d(out[i], nodes)
    return out, share, seen, beam


def link_embeddings(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    least: float = COSINE, shard: int = SHARD, block: int = BLOCK,
                    recall: float = RECALL, audits: str | None = None) -> DataFrame:
    """One row per row of ``df``: ``id`` (long), ``n_links`` (other vectors of the same label with a cosine of
    ``least`` or more), ``component_id`` (smallest id reachable by links), ``kept`` (``id = component_id``).

    Vectors that are null, zero or hold null or non-finite components, rows with a null label or id, and vectors of
    different lengths link with nothing; such a row has 0 links and is its own component. Equal vectors are linked.
    Rows that share an id are vectors of their own but one node of the components. An empty table gives an empty
    result. Other columns are not read. With a path in ``audits``, a row for each block and shard is written there:
    ``label``, ``shard``, ``block``, ``recall`` of the graph, ``pairs`` that the audit saw, and ``beam``.
    """
    v = F.col("v")
    src = df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
                    F.col(f"`{vector}`").cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite
                        & F.exists(v, lambda x: x != 0), F.lit(False))

    @F.arrow_udf("binary")
    def raw(vectors: pa.Array) -> pa.Array:
        return pa.array([None if x is None else np.array(x, np.float64).tobytes() for x in vectors.to_pylist()],
                        pa.binary())

    rows = cut_lineage(src.withColumn("ok", usable).select("id", "label", "ok", F.when(F.col("ok"), raw("v")).alias("v")))
    group = ["label", "dim"]
    classes = cut_lineage(rows.where("ok").groupBy("label", F.length("v").alias("dim"), "v").agg(
        F.min("id").alias("id"), F.count("*").alias("m")).withColumn("uid", F.monotonically_increasing_id()))
    sizes = classes.groupBy(*group).agg(F.count("*").alias("n"))
    sizes = sizes.select(*group, F.ceil(F.col("n") / shard).alias("shards"), F.ceil(F.col("n") / block).alias("blocks"))
    dealt = cut_lineage(classes.join(sizes, group).withColumns({
        "shard": F.pmod(F.xxhash64("uid"), F.col("shards")),
        "block": F.pmod(F.xxhash64("uid", F.lit(1)), F.col("blocks"))}))

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("uid")
        x, length = unit(t.column("v").to_pylist())
        g = hnsw.Graph(x / length[:, None])
        one = lambda a: pa.array([a], pa.binary())
        return pa.table({**{k: t.column(k).slice(0, 1) for k in (*group, "shard", "blocks")},
                         **{k: one(np.array(t.column(k).to_pylist(), np.int64).tobytes()) for k in ("uid", "id", "m")},
                         "x": one(b"".join(t.column("v").to_pylist())), "links": pa.array(
                             [[k.tobytes() for k in g.links]], pa.list_(pa.binary()))})

    graphs = cut_lineage(dealt.groupBy(*group, "shard").applyInArrow(
        tidy(build), "label string, dim int, shard long, blocks long, uid binary, id binary, m binary, x binary, "
               "links array<binary>"))
    graphs = graphs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    queries = dealt.select(*group, "block", "uid", "id", "v", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"uid": [], "links": [], "a": [], "b": [], "recall": [], "pairs": [], "beam": []}
        if left.num_rows and right.num_rows:
            row = {k: right.column(k)[0].as_py() for k in ("uid", "id", "m", "x", "links")}
            uid, ids, m = (np.frombuffer(row[k], np.int64) for k in ("uid", "id", "m"))
            x = np.frombuffer(row["x"], np.float64).reshape(len(uid), -1)
            length = np.sqrt((x * x).sum(1))
            links = [np.frombuffer(k, np.int32).reshape(len(uid), -1) for k in row["links"]]
            graph = hnsw.Graph(x / length[:, None], links)
            q_uid, q_id = (left.column(k).to_numpy() for k in ("uid", "id"))
            q, q_length = unit(left.column("v").to_pylist())
            found, share, seen, beam = search_block(x, length, uid, graph, q, q_length, q_uid, least, recall)
            audit = {"recall": round(share * 10**6), "pairs": seen, "beam": beam}
            # a spanning forest over the shard's classes, then the queries
            root = np.arange(len(uid) + len(q_uid))
            name = np.concatenate([ids, q_id])
            for i, nodes in enumerate(found):
                other = nodes[uid[nodes] != q_uid[i]]
                out["uid"].append(int(q_uid[i]))
                out["links"].append(int(m[other].sum()))
                out["a"].append(None)
                out["b"].append(None)
                if not len(other):
                    continue
                mine = len(uid) + i
                tops = np.unique(root[other])
                tops = tops[tops != root[mine]]
                if len(tops):
                    for t in tops:
                        out["uid"].append(None)
                        out["links"].append(None)
                        out["a"].append(int(name[mine]))
                        out["b"].append(int(name[t]))
                    root[np.isin(root, tops)] = root[mine]
            for k in ("uid", "links", "a", "b"):
                out[k].append(None)
            n = len(out["uid"])
            for k, x_ in audit.items():
                out[k] = [None] * (n - 1) + [x_]
        n = len(out["uid"])
        names = {"label": pa.array([key[0].as_py()] * n, pa.string()), "shard": pa.array([key[2].as_py()] * n, pa.int64()),
                 "block": pa.array([key[3].as_py()] * n, pa.int64())}
        return pa.table({**{k: pa.array(c, pa.int64()) for k, c in out.items()}, **names})

    found = cut_lineage(queries.groupBy(*group, "shard", "block").cogroup(
        graphs.groupBy(*group, "shard", "block")).applyInArrow(
            tidy(search), "uid long, links long, a long, b long, recall long, pairs long, beam long, label string, "
                          "shard long, block long"))
    if audits:
        found.where("beam is not null").select("label", "shard", "block", (F.col("recall") / 1e6).alias("recall"), "pairs",
                                               "beam").write.parquet(audits)
    counts = found.where("uid is not null").groupBy("uid").agg(F.sum("links").alias("links"))
    same = rows.where("ok").join(classes.select("label", "v", F.col("id").alias("least"), "m").where("m > 1"),
                                 ["label", "v"]).select(F.col("id").alias("a"), F.col("least").alias("b"))
    joined = components(found.where("a is not null").select("a", "b").union(same))
    by_class = classes.join(counts, "uid").select("label", "v", (F.col("links") + F.col("m") - 1).alias("links"))
    out = rows.join(by_class, ["label", "v"], "left").join(
        joined.select(F.col("node").alias("id"), "component"), "id", "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
