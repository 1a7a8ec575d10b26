"""Vector search over cells: exact with pruned cells (E4, J7), and by product-quantised codes with exact re-ranking (E5).

Unit vectors lie in the cells of a k-means partition (at most ``MAX_CELLS``). Of a cell the driver knows its centroid,
its radius (the largest angle to the centroid) and its size; angles obey the triangle inequality, so no row of a
cell scores above cos(angle to the centroid − radius) for a query.

* ``knn_pruned``: a query first meets its nearest cells until they hold ``floor`` rows; its k-th score
  there rules out every cell whose bound is lower, and only the rest is searched. Same rows as ``knn_exact``.
  For the rest, cells lie side by side in blocks of bounded size: a query is sent to a block once, with its cells there as bits, not once a cell.
* ``knn_codes``: the same cells are scanned by codes instead of vectors, one byte per ``subspaces``-th part of a row's
  difference from its centroid. A score is that of the vector a code stands for, decoded a cell at a time.
  The best max(10·k, 50) rows by code of each query are re-ranked by their vectors.

Codebooks are trained per part in a task of its own, on a sample of at most ``SAMPLE_VALUES`` values drawn by a hash of the
ids; every row is coded.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions import scalars as S
from cartwheel.operators.pairwise import MOST_PARTS
from cartwheel.operators.vectors import CORPUS_VALUES, SLICE_VALUES, _arrow_type, _best, centroids_of, fit_cells, knn_exact, vector_matrix
from cartwheel.session import written

if TYPE_CHECKING:
    import numpy as np

MAX_CELLS = 1024
CELL_ROWS = 500
FLOOR = 50
SAMPLE_VALUES = 4_000_000
CODE_ROWS = 200_000  # coded rows of a block
CODE_QUERY_VALUES = 500_000  # vector values of the queries that meet a block of codes
QUERY_VALUES = 2_000_000  # and of those that meet a block of vectors
BLOCKS = 16  # of an index, at least, of
LEAST_ROWS = 4096  # rows each, at least
CELL_STEP = 4096  # rows of a cell scored at once
PROBE_ROWS = 256  # queries that choose their cells at once


@dataclass
class Cells:
    """An index: ``rows`` (id, embedding, cell; unit vectors, written), and per cell its centroid, radius and size."""

    rows: DataFrame
    centroids: "np.ndarray"
    radius: "np.ndarray"
    size: "np.ndarray"


def _placed(centroids: "np.ndarray"):
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for rb in batches:
            if rb.num_rows:
                cos = vector_matrix(rb.column("embedding")) @ centroids.T
                cell = cos.argmax(axis=1)
                angle = np.arccos(np.clip(cos[np.arange(len(cell)), cell], -1.0, 1.0))
                yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(cell.astype("int32")), pa.array(angle)], names=["id", "embedding", "cell", "angle"])
    return run


def build_cells(corpus: DataFrame, n_cells: int | None = None, id_col: str = "id", vec: str = "embedding", cell_rows: int = CELL_ROWS,
                seed: int = 7) -> Cells:
    """Every row with a vector in its nearest cell; about ``cell_rows`` rows a cell, at most MAX_CELLS cells."""
    import numpy as np

    key = corpus.schema[id_col].dataType.simpleString()
    rows = written(corpus.where(F.col(vec).isNotNull()).select(F.col(id_col).alias("id"), S.l2_normalize(vec, as_float=False).alias("embedding")), "unit")
    n = rows.count()
    n_cells = n_cells or max(2, min(MAX_CELLS, n // cell_rows))
    c = np.array([x["c"] for x in centroids_of(fit_cells(rows, n_cells, "embedding", seed))]) if n > 1 else np.ones((1, 1))
    if n == 1:
        c = np.array([rows.first()["embedding"]])
    found = written(rows.mapInArrow(_placed(c), f"id {key}, embedding array<double>, cell int, angle double"), "cells") if n else \
        rows.withColumns({"cell": F.lit(0), "angle": F.lit(0.0)})
    radius, size = np.full(len(c), -1.0), np.zeros(len(c), np.int64)
    for r in found.groupBy("cell").agg(F.max("angle").alias("r"), F.count(F.lit(1)).alias("n")).collect():  # a row per cell
        radius[r["cell"]], size[r["cell"]] = r["r"], r["n"]
    return Cells(found.drop("angle"), c, radius, size)


@dataclass
class Layout:
    """Blocks of an index: ``members`` (the cells of each block), and per cell its first block and the number of its blocks."""

    members: list["np.ndarray"]
    first: "np.ndarray"
    count: "np.ndarray"


def layout(cells: Cells, most_rows: int) -> Layout:
    """Blocks of at most ``most_rows`` rows, about: cells side by side, a larger cell as several blocks (dealt by a hash of the ids).

    There are some ``BLOCKS`` blocks unless they would be small.
    """
    import numpy as np

    rows = max(1, min(most_rows, max(LEAST_ROWS, -(-int(cells.size.sum()) // BLOCKS))))
    members: list[list[int]] = []
    first, count, held = np.zeros(len(cells.size), np.int64), np.ones(len(cells.size), np.int64), rows
    for cell, n in enumerate(cells.size.tolist()):
        if not members or held + n > rows:
            count[cell] = max(1, -(-n // rows))
            first[cell], held = len(members), 0
            members += [[] for _ in range(count[cell])]
        else:
            first[cell] = len(members) - 1
        for b in range(first[cell], first[cell] + count[cell]):
            members[b].append(cell)
        held = held + n if count[cell] == 1 else rows
    return Layout([np.array(m) for m in members], first, count)


def _in_blocks(rows: DataFrame, at: Layout) -> DataFrame:
    """Rows (id, cell, …) with their ``block``."""
    of = lambda per_cell: F.element_at(F.array(*[F.lit(int(v)) for v in per_cell]), F.col("cell") + 1)
    return rows.withColumn("block", (of(at.first) + F.pmod(F.xxhash64("id", F.lit(3)), of(at.count))).cast("int"))


def _probes(cells: Cells, floor: int, bounded: bool, at: Layout | None = None):
    """mapInArrow over queries: the nearest cells that hold ``floor`` rows; or, given a k-th score, what else may beat it.

    A row per query and cell; or, with a layout, one per query and block, with the k-th score (null at first) and the cells as bits.
    """
    import numpy as np
    import pyarrow as pa

    c, radius, size = cells.centroids, cells.radius, cells.size

    def chosen(qvec: "np.ndarray", low: "np.ndarray") -> "np.ndarray":
        cos = np.clip(qvec @ c.T, -1.0, 1.0)
        cos[:, size == 0] = -2.0
        order = np.argsort(-cos, axis=1, kind="stable")
        held = np.cumsum(size[order], axis=1) - size[order]
        first = np.zeros(cos.shape, bool)
        np.put_along_axis(first, order, (held < floor) & (size[order] > 0), axis=1)
        if not bounded:
            return first
        best = np.cos(np.maximum(np.arccos(np.clip(cos, -1.0, 1.0)) - radius[None, :], 0.0)) + 1e-7
        return ~first & (size > 0)[None, :] & ~(best < low[:, None])  # no k-th score: every cell

    def run(batches):
        for rb in (batch.slice(s, PROBE_ROWS) for batch in batches for s in range(0, batch.num_rows, PROBE_ROWS)):
            if not size.any():
                continue
            low = rb.column("low").to_numpy(zero_copy_only=False) if bounded else np.full(rb.num_rows, np.nan)
            met = chosen(vector_matrix(rb.column("qvec")), low)
            if at is None:
                q, cell = np.nonzero(met)
                yield pa.RecordBatch.from_arrays([rb.column("qid").take(pa.array(q)), rb.column("qvec").take(pa.array(q)), pa.array(cell.astype("int32"))],
                                                 names=["qid", "qvec", "cell"])
                continue
            for b, members in enumerate(at.members):
                q = np.flatnonzero(met[:, members].any(axis=1))
                if len(q):
                    bits = np.packbits(met[np.ix_(q, members)], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [rb.column("qid").take(pa.array(q)), rb.column("qvec").take(pa.array(q)), pa.array(low[q], from_pandas=True),
                         pa.array(np.full(len(q), b, np.int32)), pa.array([x.tobytes() for x in bits], pa.binary()),
                         pa.array(met[np.ix_(q, members)].sum(axis=1))], names=["qid", "qvec", "low", "block", "cells", "met"])
    return run


PROBE = "low double, block int, cells binary, met bigint"


def _best_of_block(at: Layout, keep: int, digits: int | None, schema, vectors_of):
    """cogroup applyInArrow over a block of queries (as ``_probes``) and a block of rows: each query's best rows in its cells.

    Scores are taken a cell and a bounded number at once. What is below a query's ``low``, or its ``keep``-th score so far, goes at once.
    ``vectors_of(rows)`` gives a function from places to vectors.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    margin = 10.0 ** -digits if digits is not None else 0.0  # rounded scores tie further apart

    def run(key, queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        members = at.members[key[1].as_py()]
        q = vector_matrix(queries.column("qvec").combine_chunks())
        bits = np.frombuffer(b"".join(queries.column("cells").to_pylist()), np.uint8).reshape(len(q), -1)
        low = np.nan_to_num(queries.column("low").to_numpy(), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        ids = rows.column("id").combine_chunks()
        code = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
        cell = rows.column("cell").to_numpy()
        order, vectors = np.argsort(cell, kind="stable"), vectors_of(rows)
        starts, ends = (np.searchsorted(cell[order], members, side) for side in ("left", "right"))
        held, fresh, n = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)], [], 0

        def tightened() -> list:
            who, score, place = (np.concatenate(p) for p in zip(held, *fresh, strict=True))
            best = _best(who, score, code[place], keep)
            who, score, place = who[best], score[best], place[best]
            last = np.flatnonzero(np.diff(who, append=-1))
            full = last[np.diff(last, prepend=-1) == keep]
            low[who[full]] = np.maximum(low[who[full]], score[full] - margin)
            return [who, score, place]

        for j in range(len(members)):
            asked = np.flatnonzero(bits[:, j >> 3] & (128 >> (j & 7)))
            for s in range(starts[j], ends[j], CELL_STEP) if len(asked) else ():
                places = order[s:min(s + CELL_STEP, ends[j])]
                x = vectors(places)
                step = max(1, SLICE_VALUES // len(places))
                for t in range(0, len(asked), step):
                    who = asked[t:t + step]
                    score, least = q[who] @ x.T, low[who]
                    new = np.isneginf(least)
                    if len(places) > keep and new.any():
                        least[new] = np.partition(score[new], len(places) - keep, axis=1)[:, len(places) - keep] - margin
                    i, r = np.divmod(np.flatnonzero(score >= least[:, None]), score.shape[1])
                    score = score[i, r]
                    fresh.append((who[i], np.round(score, digits) if digits is not None else score, places[r]))
                    n += len(i)
                    if n > SLICE_VALUES:
                        held, fresh, n = tightened(), [], 0
        who, score, place = tightened()
        found = {"qid": queries.column("qid").combine_chunks().take(pa.array(who)), "id": ids.take(pa.array(place)), "score": pa.array(score),
                 "cell": pa.array(cell[place], pa.int32())}
        return pa.Table.from_arrays([found[n] for n in schema.names], schema=schema)
    return run


def _rescored(schema):
    """cogroup applyInArrow over a block of queries, each with the ids of its candidates there, and a block of rows: exact scores."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        q, x = (vector_matrix(t.column(c).combine_chunks()) for t, c in ((queries, "qvec"), (rows, "embedding")))
        ids, asked = rows.column("id").combine_chunks(), queries.column("ids").combine_chunks()
        wanted = pc.list_flatten(asked)
        code = pc.rank(pa.concat_arrays([ids, wanted]), sort_keys="ascending", tiebreaker="dense").to_numpy()
        order = np.argsort(code[:len(ids)], kind="stable")
        start, end = (np.searchsorted(code[:len(ids)][order], code[len(ids):], side) for side in ("left", "right"))
        n = end - start
        who = np.repeat(np.repeat(np.arange(len(q)), pc.list_value_length(asked).to_numpy()), n)
        place = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)]
        step = max(1, SLICE_VALUES // max(1, x.shape[1]))
        score = np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", q[who[s:s + step]], x[place[s:s + step]]) for s in range(0, len(who), step)]])
        return pa.Table.from_arrays([queries.column("qid").combine_chunks().take(pa.array(who)), ids.take(pa.array(place)), pa.array(score)], schema=schema)
    return run


def _meeting(queries: DataFrame, rows: DataFrame, blocks: int, query_blocks: int):
    """Both sides by (qb, block), the rows once for each block of queries; dealt by number, as a block of codes is few bytes and much work."""
    queries = queries.withColumn("qb", F.pmod(F.xxhash64("qid", F.lit(11)), F.lit(query_blocks)).cast("int"))
    rows = rows.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    parts = min(MOST_PARTS, 3 * blocks * query_blocks)
    return tuple(df.repartition(parts, "qb", "block").groupBy("qb", "block") for df in (queries, rows))


def _unit_queries(queries: DataFrame, qid: str, qvec: str) -> DataFrame:
    return written(queries.where(F.col(qvec).isNotNull()).select(F.col(qid).alias("qid"), S.l2_normalize(qvec, as_float=False).alias("qvec")), "queries")


def _ddl(queries: DataFrame, more: str) -> str:
    return f"qid {queries.schema['qid'].dataType.simpleString()}, qvec array<double>, {more}"


def _top(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("id"))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.lit(k))


def second_probes(q: DataFrame, cells: Cells, first: DataFrame, k: int, floor: int, at: Layout) -> DataFrame:
    """(qid, qvec, low, block, cells, met): by block, the cells a query's k-th score of the first pass does not rule out."""
    low = first.where(F.col("rank") == F.lit(k)).select("qid", F.col("score").alias("low"))
    return q.join(low, "qid", "left").mapInArrow(_probes(cells, floor, True, at), _ddl(q, PROBE))


def _query_blocks(q: DataFrame, cells: Cells, values: int) -> int:
    return max(1, -(-q.count() * cells.centroids.shape[1] // values))


def _found_in(q: DataFrame, cells: Cells, more: list[tuple]) -> tuple:
    """Arrow schema and DDL of (qid, id, score) and more columns."""
    import pyarrow as pa

    types = [q.schema["qid"].dataType, cells.rows.schema["id"].dataType]
    schema = pa.schema([("qid", _arrow_type(types[0])), ("id", _arrow_type(types[1])), ("score", pa.float64()), *more])
    return schema, f"qid {types[0].simpleString()}, id {types[1].simpleString()}, score double" + "".join(f", {n} {t}".replace("int32", "int") for n, t in more)


def knn_pruned(queries: DataFrame, cells: Cells, k: int = 5, qid: str = "qid", qvec: str = "qvec", digits: int | None = None,
               floor: int = FLOOR) -> DataFrame:
    """Qid, id, score, rank of the k rows of highest cosine, exact; ties to the smaller id.

    Rows and queries without vector take no part; zero vectors score 0.
    """
    q = _unit_queries(queries, qid, qvec)
    floor = max(floor, k)
    near = written(knn_exact(q.mapInArrow(_probes(cells, floor, False), _ddl(q, "cell int")), cells.rows, k, digits=digits, q_category="cell",
                             category="cell").drop("rank"), "near-hits")
    # Rounded scores tie further apart: the bound gives way by the rounding.
    kth = _top(near, k).withColumn("score", F.col("score") - F.lit(10.0 ** -digits if digits is not None else 0.0))
    at = layout(cells, CORPUS_VALUES // cells.centroids.shape[1])
    schema, ddl = _found_in(q, cells, [])
    left, right = _meeting(second_probes(q, cells, kth, k, floor, at), _in_blocks(cells.rows, at), len(at.members), _query_blocks(q, cells, QUERY_VALUES))
    vectors_of = lambda rows: (lambda x: lambda places: x[places])(vector_matrix(rows.column("embedding").combine_chunks()))
    more = left.cogroup(right).applyInArrow(_best_of_block(at, k, digits, schema, vectors_of), ddl)
    return _top(near.unionByName(more), k)


def skipped_share(queries: DataFrame, cells: Cells, k: int = 5, qid: str = "qid", qvec: str = "qvec", floor: int = FLOOR) -> float:
    """Share of the (query, cell) meetings that ``knn_pruned`` does not make."""
    q = _unit_queries(queries, qid, qvec)
    floor = max(floor, k)
    probes = q.mapInArrow(_probes(cells, floor, False), _ddl(q, "cell int"))
    kth = _top(knn_exact(probes, cells.rows, k, q_category="cell", category="cell").drop("rank"), k)
    import numpy as np

    whole = Layout([np.arange(len(cells.size))], np.zeros(len(cells.size), np.int64), np.ones(len(cells.size), np.int64))
    made = probes.count() + (second_probes(q, cells, kth, k, floor, whole).agg(F.sum("met")).first()[0] or 0)
    return 1.0 - made / max(q.count() * int((cells.size > 0).sum()), 1)


# ---- codes -------------------------------------------------------------------

def parts_of(dim: int, subspaces: int) -> list[tuple[int, int]]:
    """[start, end) of each part of a vector."""
    edges = [dim * i // subspaces for i in range(subspaces + 1)]
    return list(zip(edges, edges[1:], strict=False))


def _train(centroids: "np.ndarray", spans: list[tuple[int, int]], values: int, seed: int, rounds: int = 12):
    """applyInArrow over the sample's vectors, cut to a part in a group of its own: the part's codebook by Lloyd's rounds."""
    import numpy as np
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        a, b = spans[part]
        table = table.take(pa.array(np.argsort(np.array(table.column("_h").to_pylist()), kind="stable")))
        x = vector_matrix(table.column("embedding").combine_chunks()) - centroids[table.column("cell").to_numpy(), a:b]
        book = x[np.random.default_rng(seed + part).permutation(len(x))[:values]].copy()
        step = max(1, SLICE_VALUES // len(book))
        for _ in range(rounds):
            near = np.concatenate([((book * book).sum(axis=1)[None, :] - 2 * x[s:s + step] @ book.T).argmin(axis=1) for s in range(0, len(x), step)])
            n = np.bincount(near, minlength=len(book))
            total = np.zeros_like(book)
            np.add.at(total, near, x)
            book[n > 0] = total[n > 0] / n[n > 0, None]
        return pa.table({"part": pa.array([part], pa.int32()), "book": pa.array([book.tolist()], pa.list_(pa.list_(pa.float64())))})
    return run


def fit_codebooks(cells: Cells, subspaces: int = 16, values: int = 256, seed: int = 7, sample_values: int = SAMPLE_VALUES) -> list["np.ndarray"]:
    """A codebook per part (values × part of the dimensions), trained on what is left beside the centroids. Dims × values numbers."""
    import numpy as np

    n, dim = int(cells.size.sum()), cells.centroids.shape[1]
    spans = parts_of(dim, min(subspaces, dim))
    share = min(1.0, sample_values / max(n * dim, 1))
    drawn = cells.rows.withColumn("_h", F.xxhash64("id", F.lit(seed))).where(F.pmod("_h", F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    cuts = F.array(*[F.struct(F.lit(i).alias("part"), F.slice("embedding", a + 1, b - a).alias("embedding")) for i, (a, b) in enumerate(spans)])
    found = (drawn.select("_h", "cell", F.inline(cuts)).groupBy("part")
             .applyInArrow(_train(cells.centroids, spans, values, seed), "part int, book array<array<double>>").collect())
    books = {r["part"]: np.array(r["book"]) for r in found}
    return [books.get(i, np.zeros((1, b - a))) for i, (a, b) in enumerate(spans)]


def encode(cells: Cells, books: list["np.ndarray"]) -> DataFrame:
    """(id, cell, code): a byte per part for every row of the index, written."""
    import numpy as np
    import pyarrow as pa

    centroids, spans = cells.centroids, parts_of(cells.centroids.shape[1], len(books))

    def run(batches):
        for rb in batches:
            if rb.num_rows:
                x = vector_matrix(rb.column("embedding")) - centroids[rb.column("cell").to_numpy()]
                code = np.stack([((m * m).sum(axis=1)[None, :] - 2 * x[:, a:b] @ m.T).argmin(axis=1) for m, (a, b) in zip(books, spans, strict=True)], axis=1)
                yield pa.RecordBatch.from_arrays([rb.column("id"), rb.column("cell"), pa.array([c.tobytes() for c in code.astype(np.uint8)], pa.binary())],
                                                 names=["id", "cell", "code"])
    key = cells.rows.schema["id"].dataType.simpleString()
    return written(cells.rows.mapInArrow(run, f"id {key}, cell int, code binary"), "codes")


def _decoded(books: list["np.ndarray"], centroids: "np.ndarray"):
    """From a block of codes, a function from places of one cell to the vectors its codes stand for."""
    import numpy as np

    def vectors_of(rows):
        code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(rows.num_rows, len(books))
        cell = rows.column("cell").to_numpy()
        return lambda places: centroids[cell[places]] + np.concatenate([m[code[places, i]] for i, m in enumerate(books)], axis=1)
    return vectors_of


def knn_codes(queries: DataFrame, cells: Cells, codes: DataFrame, books: list["np.ndarray"], k: int = 5, qid: str = "qid", qvec: str = "qvec",
              digits: int | None = None, floor: int | None = None) -> DataFrame:
    """E5: qid, id, score, rank; the best max(10·k, 50) rows by code (``floor``), re-ranked exactly.

    Cells are chosen as in ``knn_pruned``, so only the codes lose recall. Fewer candidates than the floor come back only from
    a table with fewer rows.
    """
    import pyarrow as pa

    floor = floor or max(10 * k, FLOOR)
    q = _unit_queries(queries, qid, qvec)
    at, query_blocks = layout(cells, CODE_ROWS), _query_blocks(q, cells, CODE_QUERY_VALUES)
    schema, ddl = _found_in(q, cells, [("cell", pa.int32())])
    dealt = _in_blocks(codes, at)

    def scan(probes: DataFrame) -> DataFrame:
        left, right = _meeting(probes, dealt, len(at.members), query_blocks)
        return left.cogroup(right).applyInArrow(_best_of_block(at, floor, None, schema, _decoded(books, cells.centroids)), ddl)

    near = written(scan(q.mapInArrow(_probes(cells, floor, False, at), _ddl(q, PROBE))), "near-codes")
    more = scan(second_probes(q, cells, _top(near, floor), floor, floor, at))
    candidates = _top(near.unionByName(more), floor).where(F.col("id").isNotNull()).select("qid", "id", "cell")
    # Candidates meet the vectors by blocks, as queries do: a vector is sent once a block of queries, not once a candidate.
    at = layout(cells, CORPUS_VALUES // cells.centroids.shape[1])
    schema, ddl = _found_in(q, cells, [])
    asked = q.join(_in_blocks(candidates, at).groupBy("qid", "block").agg(F.collect_list("id").alias("ids")), "qid")
    left, right = _meeting(asked, _in_blocks(cells.rows, at), len(at.members), _query_blocks(q, cells, QUERY_VALUES))
    exact = left.cogroup(right).applyInArrow(_rescored(schema), ddl)
    return _top(exact.withColumn("score", F.round("score", digits)) if digits is not None else exact, k)
