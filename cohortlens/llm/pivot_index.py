"""Embedding near-duplicates by a pivot-permutation index (operator 3).

A bounded sample of vectors serves as pivots.  Every vector is described by
its ``depth`` nearest pivots in order and posted to their inverted lists,
kept per label.  Two vectors of one list are candidates if they share at
least ``shared`` pivots; the list of their first shared pivot owns the pair.
Candidates are verified by cosine in double precision.

Equal vectors of a label become one class with a weight first, so copies cost
nothing.  A list with more members than ``block`` is cut by hash into cells,
and each pair of cells is a task, so no list meets whole.  Tasks return link
counts a vector and a spanning forest, never all pairs; components come from
the forests.

Links are between equal, non-null labels.  A vector that is null, empty,
zero, or holds a null or non-finite component links with nothing, and so does
one of another length.  Rows that repeat an id are separate vectors for the
counts and one node for the components.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import storage
from cohortlens.llm.components import components

PIVOTS = 128
DEPTH = 10
SHARED = 2
BLOCK = 2048


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as doubles."""
    n = len(col)
    flat = np.asarray(col.flatten()).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so very large and very small vectors keep their direction."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _classes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(rep, label, vec, copies): one row for equal usable vectors of a label."""
    ok = (F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
          & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
          & F.exists("vec", lambda x: x != 0))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    # 0.0 and -0.0 are the same component
    return (rows.where(ok).withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))
            .groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")))


def _pivots(classes: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """Pivot directions by vector length: those with the smallest hashes, at most ``pivots`` rows."""
    pick = storage.bounded_sample(classes, "rep", pivots).select("vec").collect()
    by: dict[int, list] = {}
    for r in pick:
        by.setdefault(len(r.vec), []).append(r.vec)
    return {n: _unit(np.array(v)) for n, v in by.items()}


def _postings(classes: DataFrame, pivots, depth: int) -> DataFrame:
    """One row a class and list: (label, pivot, rep, copies, vec, near); near: its nearest pivots in order."""
    def run(batches):
        by = pivots.value
        for batch in batches:
            vec = batch.column(2)
            size = np.diff(np.asarray(vec.offsets))
            for n in np.unique(size):
                rows = np.flatnonzero(size == n)
                part = batch.take(pa.array(rows))
                p = by.get(int(n))
                m = len(rows)
                if p is None:  # no pivot of this length: one list
                    near = np.full((m, 1), -int(n))
                else:
                    near = np.argsort(-(_unit(_matrix(part.column(2))) @ p.T), axis=1, kind="stable")[:, :depth]
                    near = near + int(n) * (1 << 20)  # lists of each length apart
                k = near.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), part.column(3),
                     pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * k), pa.array(near.ravel().astype(np.int64)))],
                    names=["label", "rep", "vec", "copies", "near"])

    kind = classes.schema["label"].dataType.simpleString()
    got = classes.select("label", "rep", "vec", "copies").mapInArrow(
        run, f"label {kind}, rep long, vec array<double>, copies long, near array<long>")
    return got


def _verify(rows: DataFrame, threshold: float, shared: int) -> DataFrame:
    """Per task: (rep, links, root): links found (by weight) and an edge of a spanning forest."""
    def pairs(pivot, left, right, out):
        a_rep, a_w, a_x, a_near = left
        b_rep, b_w, b_x, b_near = right
        same = left is right
        cos = a_x @ b_x.T
        i, j = np.nonzero(cos >= threshold - 1e-9)
        if same:
            up = i < j
            i, j = i[up], j[up]
        if not len(i):
            return
        # shared pivots of the pairs, and the first of them in pivot order
        na, nb = a_near[i], b_near[j]
        hit = (na[:, :, None] == nb[:, None, :]).any(2)
        first = np.where(hit, na, np.iinfo(np.int64).max).min(1)
        exact = np.einsum("ij,ij->i", a_x[i], b_x[j])
        ok = (hit.sum(1) >= min(shared, na.shape[1])) & (first == pivot) & (exact >= threshold)
        i, j = i[ok], j[ok]
        if len(i):
            out.append((a_rep[i], b_rep[j], a_w[i], b_w[j]))

    def forest(out):
        a, b = np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])
        wa, wb = np.concatenate([o[2] for o in out]), np.concatenate([o[3] for o in out])
        nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
        links = np.bincount(inv, np.concatenate([wb, wa]), minlength=len(nodes)).astype(np.int64)
        x, y = inv[:len(a)], inv[len(a):]
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[x], root[y])
            new = root.copy()
            np.minimum.at(new, x, low)
            np.minimum.at(new, y, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pa.RecordBatch.from_pydict({"rep": nodes, "links": links, "root": nodes[root]})

    def run(batches):
        task, held = None, ([], [], [], [], [])

        def done():
            if task is None or not held[0]:
                return None
            side = np.array(held[0])
            near = np.array(held[4], np.int64)
            rep, w, x = np.array(held[1], np.int64), np.array(held[2], np.int64), _unit(np.array(held[3]))
            part = lambda s: (rep[side == s], w[side == s], x[side == s], near[side == s])
            out = []
            pivot = int(task.split("/")[-3])
            if (side == 0).any():
                own = part(0)
                pairs(pivot, own, own, out)
            else:
                pairs(pivot, part(1), part(2), out)
            return forest(out) if out else None

        for batch in batches:
            for t, side, rep, w, vec, near in zip(*(batch.column(c).to_pylist() for c in range(6))):
                if t != task:
                    got = done()
                    if got is not None:
                        yield got
                    task, held = t, ([], [], [], [], [])
                for h, v in zip(held, (side, rep, w, vec, near)):
                    h.append(v)
        got = done()
        if got is not None:
            yield got

    rows = rows.repartition("task").sortWithinPartitions("task").select("task", "side", "rep", "copies", "vec", "near")
    return rows.mapInArrow(run, "rep long, links long, root long")


def near_duplicates(vectors: DataFrame, folder: str, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", pivots: int = PIVOTS, depth: int = DEPTH, shared: int = SHARED,
                    block: int = BLOCK) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    classes = storage.stage(_classes(vectors, id_col, vec_col, label_col), folder, "classes")
    index = storage.stage(_postings(classes, spark.sparkContext.broadcast(_pivots(classes, pivots)), depth), folder, "index")
    lists = index.select("label", "rep", "copies", "vec", "near", F.explode("near").alias("pivot"))
    cells = (index.select("label", F.explode("near").alias("pivot")).groupBy("label", "pivot")
             .agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("parts"), F.count(F.lit(1)).alias("size")).where("size > 1"))
    name = lambda c1, c2: F.concat_ws("/", F.col("label").cast("string"), "pivot", c1, c2)
    entry = lambda task, side: F.struct(task.alias("task"), F.lit(side).alias("side"))
    cut = lists.join(cells, ["label", "pivot"]).withColumn("cell", F.pmod(F.xxhash64("rep"), F.col("parts")))
    tasks = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda j: F.when(
        j == F.col("cell"), entry(name("cell", "cell"), 0)).when(j > F.col("cell"), entry(name("cell", j), 1))
        .otherwise(entry(name(j, "cell"), 2)))
    rows = cut.withColumn("t", F.explode(tasks)).select("t.task", "t.side", "rep", "copies", "vec", "near")
    found = storage.stage(_verify(rows, threshold, shared), folder, "found")
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), folder, "linked")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of = (classes.join(counts, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
          .select("label", "vec", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                  F.coalesce("component", "rep").alias("component_id")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vec"))
    return rows.join(of, ["label", "vec"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))
