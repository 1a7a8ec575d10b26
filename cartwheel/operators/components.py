"""Similarity graph and connected components (E10 core).

The graph of pairs with cosine ≥ t is never written out. Equal vectors are one node with a
weight. Nodes lie in the cells of a k-means partition, and two cells are weighed by their centroids'
angle and their radii: they may hold no close pair (nothing is compared), only close
pairs (counts and links follow from the cells' sizes and one representative), or some, and only then are their
rows compared, in tiles of bounded size. A compared pair of tiles returns what is linear in its rows:
neighbour counts, a spanning forest of its links, or each row's best core. Links between tiles join the
components found inside them, so a dense group's links do not grow with its pairs of tiles.

``connected_components`` alternates large-star and small-star rounds on the
edge list (Kiveris et al., 2014). Each round is a few grouped aggregates and
joins; the edge list is checkpointed into the shared checkpoint folder after
every round, so plans and lineage stay short and a lost executor recomputes
one round.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import scalars as S
from cartwheel.session import ensure_checkpointing, written

BLOCK_ROWS = 4096  # rows of a tile, at least
CELLS = 16  # a row is shipped about once per tile it meets: tiles grow with the table, not their number,
BLOCK_VALUES = 4_000_000  # until they hold so many vector values
SLICE_VALUES = 2_000_000  # cosines computed at once
MAX_CELLS = 4096  # k-means cells; beyond MAX_CELLS * BLOCK_ROWS rows a cell is cut into tiles by a hash


def _assign(centroids: "np.ndarray"):
    """mapInArrow: nearest centroid and the angle to it, for unit vectors (one matrix product per batch)."""
    import numpy as np
    import pyarrow as pa

    from cartwheel.operators.vectors import vector_matrix

    def run(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x = vector_matrix(rb.column("_v"))
            cos = x @ centroids.T
            cell = cos.argmax(axis=1)
            best = np.clip(cos[np.arange(len(cell)), cell], -1.0, 1.0)
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(cell.astype("int32")), pa.array(np.arccos(best))],
                                             names=[*rb.schema.names, "cell", "_ang"])
    return run


def _meetings(centroids: "np.ndarray", radius: "np.ndarray", alpha: float, slack: float):
    """mapInArrow over cell numbers: (i, j, sure), i ≤ j, of cells that may hold a close pair; sure: that hold no other."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for rb in batches:
            for i in rb.column(0).to_pylist():
                if radius[i] < 0:
                    continue
                reach = radius[i] + radius[i:]
                apart = np.arccos(np.clip(centroids[i:] @ centroids[i], -1.0, 1.0))
                apart[0] = 0.0
                near = np.flatnonzero((radius[i:] >= 0) & (apart - reach <= alpha + slack))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), i, np.int32)), pa.array((near + i).astype("int32")),
                                                  pa.array((apart + reach <= alpha - slack)[near])], names=["i", "j", "sure"])
    return run


def _forest(sim, t: float, left: "np.ndarray", right: "np.ndarray") -> list:
    """Pairs of names with sim ≥ t thinned to a spanning forest; equal names are one node already. ``sim`` gives rows of cosines."""
    import numpy as np

    names, where = np.unique(np.concatenate([left, right]), return_inverse=True)
    a_of, b_of = where[:len(left)], where[len(left):]
    group = np.arange(len(names))  # each name's tree
    out, at, step = [], 0, 1
    while at < len(left):  # slices grow: most links of a dense tile join nothing new after its first rows
        step = max(1, min(step, SLICE_VALUES // max(1, len(right))))
        i, j = np.nonzero(sim(slice(at, min(at + step, len(left)))) >= t)
        x, y = a_of[i + at], b_of[j]
        at, step = at + step, min(2 * step, 256)
        apart = np.flatnonzero(group[x] != group[y])
        if not len(apart):
            continue
        _, first = np.unique(group[x[apart]] * len(names) + group[y[apart]], return_index=True)
        root: dict[int, int] = {}
        for k in apart[first].tolist():
            p, q = (_root(root, int(g)) for g in (group[x[k]], group[y[k]]))
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((names[x[k]], names[y[k]]))
        flat = np.arange(len(names))
        moved = list(root)
        flat[moved] = [_root(root, g) for g in moved]
        group = flat[group]
    return out


def _root(root: dict[int, int], x: int) -> int:
    while x in root:
        up = root[x]
        if up in root:
            root[x] = root[up]
        x = up
    return x


def _tiles(kind: str, threshold: float):
    """cogroup applyInArrow over one pair of tiles (the same tile twice: ``ta`` = ``tb``).

    ``degree``: (a, b, cos) = (node, weight of its neighbours here, null); ``forest``: links among the
    names; ``border``: each non-core's best core here.
    """
    import numpy as np
    import pyarrow as pa

    from cartwheel.operators.vectors import vector_matrix

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cos", pa.float64())])

    def run(key, lefts: pa.Table, rights: pa.Table) -> pa.Table:
        if not lefts.num_rows or not rights.num_rows:
            return schema.empty_table()
        same = key[0].as_py() == key[1].as_py()
        a, b = lefts.column("id").to_numpy(), rights.column("id").to_numpy()
        x, y = (vector_matrix(t.column("_v").combine_chunks()) for t in (lefts, rights))
        step = max(1, SLICE_VALUES // len(b))
        slices = [slice(at, min(at + step, len(a))) for at in range(0, len(a), step)]
        if kind == "forest":
            def later(rows: slice) -> "np.ndarray":
                sim = x[rows] @ y.T
                if same:
                    sim[a[rows][:, None] >= b[None, :]] = -2.0
                return sim
            links = _forest(later, threshold, lefts.column("name").to_numpy(), rights.column("name").to_numpy())
            return pa.table({"a": pa.array([p for p, _ in links], pa.int64()), "b": pa.array([q for _, q in links], pa.int64()),
                             "cos": pa.nulls(len(links), pa.float64())}, schema=schema)
        if kind == "degree":
            wa, wb = lefts.column("w").to_numpy(), rights.column("w").to_numpy()
            near_a, near_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            for rows in slices:
                close = x[rows] @ y.T >= threshold
                if same:
                    close &= a[rows][:, None] != b[None, :]
                near_a[rows] = close @ wb
                if not same:
                    near_b += wa[rows] @ close
            nodes, counts = (a, near_a) if same else (np.concatenate([a, b]), np.concatenate([near_a, near_b]))
            kept = counts > 0
            return pa.table({"a": nodes[kept], "b": counts[kept].astype(np.int64), "cos": pa.nulls(int(kept.sum()), pa.float64())},
                            schema=schema)
        order = np.argsort(b, kind="stable")  # ties go to the smaller core
        y, b = y[order], b[order]
        at, most = np.zeros(len(a), np.int64), np.zeros(len(a))
        for rows in slices:
            sim = x[rows] @ y.T
            best = np.where(sim >= threshold, sim, -np.inf)
            at[rows] = best.argmax(axis=1)
            most[rows] = best[np.arange(len(best)), at[rows]]
        rows = np.flatnonzero(np.isfinite(most))
        return pa.table({"a": a[rows], "b": b[at[rows]], "cos": most[rows]}, schema=schema)
    return run


class ThresholdGraph:
    """The graph of rows with cosine ≥ ``threshold``, by cells and tiles (see the module note).

    ``nodes``: node (smallest id of an equal vector), vector, weight, cell, tile, written once; ``members``: id, node;
    ``meet``: pairs of cells (i, j, sure). Rows without vector are no nodes; ids must be unique. At most MAX_CELLS
    centroids and one number per cell reach the driver. A comparison ships a row once per tile its own tile has to meet.
    """

    def __init__(self, corpus: DataFrame, threshold: float, id_col: str = "id", vec: str = "embedding",
                 n_cells: int | None = None, seed: int = 7, slack: float = 1e-7, block: int | None = None):
        self.threshold, self.slack, self.block = threshold, slack, block
        unit = corpus.where(F.col(vec).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"),
                                                            S.l2_normalize(vec, as_float=False).alias("_v"))
        unit = written(unit.withColumn("_h", F.xxhash64("_v")), "unit")
        nodes = written(unit.groupBy("_h", "_v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("w")), "nodes")
        self.members = unit.join(nodes.select("_h", "_v", F.col("id").alias("node")), ["_h", "_v"]).select("id", "node")
        self._cells(nodes, n_cells, seed)

    def _cells(self, nodes: DataFrame, n_cells: int | None, seed: int) -> None:
        """Cells of about ``block`` rows, tiles of at most about ``block``, and the pairs of cells that meet."""
        import numpy as np

        from pyspark.ml.functions import array_to_vector
        from pyspark.ml.stat import Summarizer

        from cartwheel.operators.vectors import centroids_of, fit_cells

        n, wide = nodes.agg(F.count(F.lit(1)), F.max(F.size("_v"))).first()
        self.block = self.block or max(BLOCK_ROWS, min(n // CELLS, BLOCK_VALUES // max(1, wide or 1)))
        n_cells = n_cells or max(1, min(MAX_CELLS, n // self.block))
        if n and n_cells > 1:
            c = np.array([x["c"] for x in centroids_of(fit_cells(nodes, n_cells, "_v", seed))], dtype=np.float64)
        elif n:  # one cell around the mean
            c = nodes.agg(Summarizer.mean(array_to_vector("_v"))).first()[0].toArray()[None, :]
            c /= np.linalg.norm(c) or 1.0
        else:
            c = np.zeros((1, 1))
        cells = written(nodes.select("id", "w", "_v").mapInArrow(_assign(c), "id bigint, w bigint, _v array<double>, cell int, _ang double"), "cells")
        self.per_cell = written(cells.groupBy("cell").agg(F.max("_ang").alias("radius"), F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")), "per-cell")
        per = self.per_cell.collect()  # a row per cell
        radius, parts = np.full(len(c), -1.0), np.ones(len(c), np.int64)
        for r in per:
            # A zero vector is near no centroid and close to nothing: a cell with one has no sure pairs and a full radius.
            radius[r["cell"]], parts[r["cell"]] = r["radius"], -(-r["n"] // self.block)
        alpha = math.acos(max(-1.0, min(1.0, self.threshold)))
        self.meet = written(nodes.sparkSession.range(len(c)).mapInArrow(_meetings(c, radius, alpha, self.slack), "i int, j int, sure boolean"), "meetings")
        first = (np.cumsum(parts) - parts).tolist()
        part = F.pmod(F.xxhash64("id", F.lit(13)), _lookup(parts.tolist(), "cell"))
        self.nodes = cells.drop("_ang").withColumn("tile", (_lookup(first, "cell") + part).cast("int"))
        tiles = self.per_cell.select("cell", F.explode(F.sequence(_lookup(first, "cell"), _lookup(first, "cell") + _lookup(parts.tolist(), "cell") - 1))
                                     .alias("tile"))
        named = lambda cell, tile: tiles.select(F.col("cell").alias(cell), F.col("tile").alias(tile))
        self.tile_pairs = written(self.meet.join(named("i", "ta"), "i").join(named("j", "tb"), "j").where("ta <= tb or i <> j")
                                  .select("ta", "tb", "sure"), "tile-pairs")

    def compare(self, kind: str, pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
        """Rows of ``left`` and ``right`` (nodes, columns as ``_tiles`` reads) tile against tile, for every (ta, tb) of ``pairs``."""
        meets = lambda rows, side: rows.withColumnRenamed("tile", side).join(pairs.select("ta", "tb"), side).drop("cell")
        lefts, rights = meets(left, "ta"), meets(right, "tb")
        rights = rights.select(*[F.col(c).alias(c) for c in rights.columns])  # columns of its own, where both sides are one table
        return lefts.groupBy("ta", "tb").cogroup(rights.groupBy("ta", "tb")).applyInArrow(_tiles(kind, self.threshold), "a bigint, b bigint, cos double")

    def run(self, kind: str, cores: DataFrame | None = None) -> DataFrame:
        """(a, b, cos): ``forest`` — links that connect what the graph (among ``cores``) connects; ``border`` — for each node
        that is no core its best core, per tile; ``degree`` — see ``degrees``. ``cores``: node; all nodes without it.
        """
        if kind == "degree":
            return self.compare(kind, self.tile_pairs.where("not sure"), self.nodes, self.nodes)
        marked = self.nodes if cores is None else self.nodes.join(cores.select(F.col("node").alias("id")), "id", "left_semi")
        if kind == "border":
            others = self.nodes.join(cores.select(F.col("node").alias("id")), "id", "left_anti")
            swapped = self.tile_pairs.where("ta <> tb").select(F.col("tb").alias("ta"), F.col("ta").alias("tb"))
            return self.compare(kind, self.tile_pairs.select("ta", "tb").unionByName(swapped), others, marked)
        # One node stands for a cell whose nodes are all close; cells that are close as a whole are linked by theirs.
        first = marked.groupBy("cell").agg(F.min("id").alias("rep"))
        whole = self.meet.where("sure and i = j").select(F.col("i").alias("cell")).join(first, "cell")
        star = marked.join(whole, "cell").where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
        rep = lambda cell, name: first.select(F.col("cell").alias(cell), F.col("rep").alias(name))
        sure = self.meet.where("sure and i <> j").join(rep("i", "ra"), "i").join(rep("j", "rb"), "j")
        # All of i is close to all of j: i's nodes link to j's representative, j's to i's. A cell of such a pair needs one such star.
        once = sure.groupBy("i").agg(F.min("rb").alias("rb")).select(F.col("i").alias("cell"), "rb").unionByName(
            sure.groupBy("j").agg(F.min("ra").alias("rb")).select(F.col("j").alias("cell"), "rb"))
        cross = marked.join(once, "cell").select(F.col("rb").alias("a"), F.col("id").alias("b")).unionByName(
            sure.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        known = star.unionByName(cross)
        inside = self.compare(kind, self.tile_pairs.where("not sure and ta = tb"), marked.withColumn("name", F.col("id")),
                              marked.withColumn("name", F.col("id"))).select("a", "b")
        links = written(known.unionByName(inside), "links")
        rest = self.tile_pairs.where("not sure and ta <> tb")
        if rest.isEmpty():
            return links.withColumn("cos", F.lit(None).cast("double"))
        found = connected_components(links).withColumnRenamed("node", "id")
        named = written(marked.join(found, "id", "left").withColumn("name", F.coalesce("component", "id")).drop("component"), "named")
        between = self.compare(kind, rest, named, named).select("a", "b")
        return links.unionByName(between).withColumn("cos", F.lit(None).cast("double"))

    def degrees(self) -> DataFrame:
        """(node, deg): rows with cosine ≥ threshold, the node's own row and its equals included."""
        weight = lambda cell, name: self.per_cell.select(F.col("cell").alias(cell), F.col("w").alias(name))
        sure = self.meet.where("sure").join(weight("i", "wi"), "i").join(weight("j", "wj"), "j")
        whole = (sure.select(F.col("i").alias("cell"), F.col("wj").alias("near")).unionByName(
            sure.where("i <> j").select(F.col("j").alias("cell"), F.col("wi").alias("near"))).groupBy("cell").agg(F.sum("near").alias("whole")))
        own = self.meet.where("sure and i = j").select(F.col("i").alias("cell"), F.lit(True).alias("clique"))
        near = self.run("degree").groupBy("a").agg(F.sum("b").alias("near"))
        rows = self.nodes.select(F.col("id").alias("a"), "w", "cell").join(near, "a", "left").join(whole, "cell", "left").join(own, "cell", "left")
        own_rows = F.when(F.col("clique"), F.lit(0)).otherwise(F.col("w"))  # a sure cell's weight has the node's own rows
        return rows.select(F.col("a").alias("node"), (own_rows + F.coalesce("near", F.lit(0)) + F.coalesce("whole", F.lit(0))).alias("deg"))


def _lookup(values: list[int], key: str) -> "F.Column":
    """Per-cell integer from a list indexed by cell (at most MAX_CELLS entries)."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col(key) + F.lit(1))


def _norm_edges(df: DataFrame, x: str, y: str) -> DataFrame:
    return (df.select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v"))
            .where(F.col("u") != F.col("v")).distinct())


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
        edges.select(F.col("v").alias("a"), F.col("u").alias("b")))


def large_star(edges: DataFrame) -> DataFrame:
    adj = _both(edges)
    mins = adj.groupBy("a").agg(F.min("b").alias("mb"))
    out = adj.where(F.col("b") > F.col("a")).join(mins, "a").select(F.col("b").alias("x"),
                                                                      F.least("a", "mb").alias("y"))
    return _norm_edges(out, "x", "y")


def small_star(edges: DataFrame) -> DataFrame:
    adj = _both(edges).where(F.col("b") < F.col("a"))
    mins = adj.groupBy("a").agg(F.min("b").alias("mb"))
    out = adj.join(mins, "a").select(F.col("b").alias("x"), F.col("mb").alias("y")).unionByName(
        mins.select(F.col("a").alias("x"), F.col("mb").alias("y")))
    return _norm_edges(out, "x", "y")


def _fingerprint(edges: DataFrame) -> tuple:
    """Order-independent digest of an edge set (count and two hash sums), one small job."""
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFF))).alias("h1"),
                  F.sum(F.hash("v", "u").cast("bigint")).alias("h2")).first()
    return (r["n"], r["h1"], r["h2"])


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b", max_rounds: int | None = None) -> DataFrame:
    """Component of every node that occurs in ``edges``: (node, component = smallest node id).

    Runs one action per round (the convergence test); stops when a round
    leaves the edge set unchanged. A caller's ``max_rounds`` that is not enough raises.
    """
    ensure_checkpointing(edges.sparkSession)
    e = _norm_edges(edges, src, dst).checkpoint(eager=True)
    seen = _fingerprint(e)
    for i in itertools.count():
        if max_rounds is not None and i >= max_rounds:
            raise RuntimeError(f"components did not settle within {max_rounds} rounds")
        # Each round reads its input several times, so the plan must be cut every round
        # (checkpoint into the shared folder); the fingerprint then reads the written files.
        e = small_star(large_star(e)).checkpoint(eager=True)
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    adj = _both(e)
    return adj.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")) \
        .select(F.col("a").alias("node"), "component")


def threshold_components(corpus: DataFrame, threshold: float, id_col: str = "id", vec: str = "embedding",
                         n_cells: int | None = None) -> DataFrame:
    """Every corpus row with its component in the graph of pairs with cosine ≥ threshold.

    Isolated rows, and rows without vector, are their own component. Output: id, component.
    """
    graph = ThresholdGraph(corpus, threshold, id_col, vec, n_cells)
    comp = connected_components(graph.run("forest"))
    named = graph.members.join(comp, "node", "left").select(
        F.col("id").alias("_id"), F.coalesce("component", "node").alias("component"))
    ids = corpus.select(id_col)
    return ids.join(named, F.col(id_col) == F.col("_id"), "left").select(
        id_col, F.coalesce(F.col("component"), F.col(id_col)).alias("component"))
