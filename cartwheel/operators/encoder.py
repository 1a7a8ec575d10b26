"""A text encoder fitted in Spark (E2's model in place of the hash): word vectors from co-occurrence.

With the documents x terms matrix A (tf-idf, rows of length one) and random signs R for the terms, the vectors are the
rows of (AᵀA)^passes R: the range finder of a randomised factorisation, whose passes pull out the strongest directions.
Orthonormal columns (the range's basis) are the default. A pass reads the texts once: a task has the terms' vectors broadcast,
weighs its documents whole, and adds what they give to the terms, one row per term and task to be summed. Nothing per
(document, term) is shuffled, except for documents that are several rows of the table: those are joins and sums.

The model has at most ``max_terms`` words (the most frequent ones, ties by the word) of ``dim`` floats, so its size has a
bound that does not grow with the corpus: 32,768 x 64 x 4 bytes = 8 MB, which is what an encoder broadcasts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.vectors import tokens
from cartwheel.session import written

MAX_TERMS = 32_768
MAX_VALUES = 64_000_000  # of a model: 256 MB of floats
MIN_DOCS = 2
STEP = 65_536  # tokens whose vectors a task holds at once


def signs(term: Column, dim: int) -> list[Column]:
    """The term's random signs: one md5 per column, the same in every engine."""
    return [F.when(F.substring(F.md5(F.concat(F.lit(f"{j}:"), term).cast("binary")), 1, 1) < "8", F.lit(1.0)).otherwise(F.lit(-1.0))
            for j in range(dim)]


def _names(dim: int) -> list[str]:
    return [f"f{j}" for j in range(dim)]


def _gram(dim: int):
    """mapInPandas: the partition's part of FᵀF, as (i, j, x)."""
    def run(frames):
        import pandas as pd
        total = np.zeros((dim, dim))
        for frame in frames:
            x = frame.to_numpy(np.float64)
            total += x.T @ x
        i, j = np.indices((dim, dim))
        yield pd.DataFrame({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "x": total.ravel()})
    return run


def whitening(factors: DataFrame, dim: int) -> np.ndarray:
    """The matrix that makes the columns orthonormal; directions without any weight become zero. dim² numbers reach the driver."""
    parts = factors.select(*_names(dim)).mapInPandas(_gram(dim), "i int, j int, x double")
    gram = np.zeros((dim, dim))
    for r in parts.groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        gram[r.i, r.j] = r.x
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    alive = value > 1e-12 * max(value.max(initial=0.0), 1e-300)
    scale = np.where(alive, 1 / np.sqrt(np.where(alive, value, 1.0)), 0.0)
    return vector * scale


def _passed(sent: Broadcast, dim: int):
    """mapInArrow: token lists, each a whole document, to the partition's part of Aᵀ(A f), one row per term it has."""
    import pyarrow as pa

    def run(batches):
        terms, model = sent.value
        place, idf, factor = {t: i for i, t in enumerate(terms)}, model[:, 0], model[:, 1:]
        total, seen = np.zeros((len(terms), dim)), np.zeros(len(terms), bool)
        for rb in batches:
            row, at = places(rb.column("_tok"), place)
            if not len(at):
                continue
            pair, tf = np.unique(row * len(terms) + at, return_counts=True)  # by document, then term
            row, at = pair // len(terms), pair % len(terms)
            w = tf * idf[at]
            w /= np.sqrt(np.bincount(row, w * w))[row]
            x = np.zeros((rb.num_rows, dim))
            for start in range(0, len(at), STEP):
                part = slice(start, start + STEP)
                summed_into(x, row[part], w[part, None] * factor[at[part]])
            order = np.argsort(at, kind="stable")
            row, at, w = row[order], at[order], w[order]
            for start in range(0, len(at), STEP):
                part = slice(start, start + STEP)
                summed_into(total, at[part], w[part, None] * x[row[part]])
            seen[at] = True
        held = np.flatnonzero(seen)
        for start in range(0, len(held), STEP):
            part = held[start:start + STEP]
            yield pa.RecordBatch.from_arrays([pa.array([terms[i] for i in part], pa.string()), *[pa.array(total[part, j]) for j in range(dim)]],
                                             names=["term", *_names(dim)])
    return run


def _model(table: DataFrame, dim: int, kind=np.float64, beside: int = 0) -> tuple[list[str], np.ndarray]:
    """(term, v) on the driver: vectors of at most ``MAX_VALUES`` numbers, and ``beside`` more a term."""
    held = table.limit(MAX_VALUES // dim + 1).toPandas()
    if len(held) * dim > MAX_VALUES:
        raise ValueError("the model is too large to broadcast")
    return held["term"].tolist(), np.array(held["v"].tolist(), np.float64).reshape(len(held), dim + beside).astype(kind)


def fit(docs: DataFrame, path: str, text: str = "text", key: str = "id", dim: int = 64, passes: int = 1, orthonormal: bool = True,
        max_terms: int = MAX_TERMS, min_docs: int = MIN_DOCS) -> "Encoder":
    """Fit on the whole table and write (term, idf, factor) to ``path``; rows with one key are one document, null keys too.

    Words of fewer than ``min_docs`` documents have no co-occurrence to learn from. An empty table gives a model
    without words, which encodes every text as zeros.
    """
    if max_terms * dim > MAX_VALUES:
        raise ValueError(f"{max_terms} terms of {dim} values are too large a model to broadcast")
    spark, names = docs.sparkSession, _names(dim)
    words = docs.select(F.col(key).alias("doc"), tokens(text).alias("_tok"))
    keys = words.groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
    n_docs, repeated = keys.agg(F.count(F.lit(1)), F.count_if(F.col("n") > 1)).first()
    held, tf = words, None
    if repeated:
        several = written(keys.where("n > 1").select(F.col("doc").alias("of")), "repeated-keys")
        held = words.join(several, F.col("doc").eqNullSafe(F.col("of")), "left_anti")
        cut = words.join(several, F.col("doc").eqNullSafe(F.col("of")), "left_semi").select("doc", F.explode("_tok").alias("term"))
        tf = written(cut.groupBy("doc", "term").agg(F.count(F.lit(1)).cast("double").alias("tf")), "term-counts")
    once = held.select(F.explode(F.array_distinct("_tok")).alias("term"))
    found = (once if tf is None else once.unionAll(tf.select("term"))).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kept = found.where(F.col("df") >= min_docs).orderBy(F.desc("df"), "term").limit(max_terms)
    kept = written(kept.select("term", (F.log(F.lit(1.0 + n_docs) / (F.col("df") + 1)) + 1).alias("idf")), "terms")
    weights = None if tf is None else _weights(tf, kept)
    factors = kept.select("term", *[c.alias(f) for c, f in zip(signs(F.col("term"), dim), names, strict=True)])
    summed = [F.sum(F.col("w") * F.col(f)).alias(f) for f in names]
    for _ in range(passes):
        sent = spark.sparkContext.broadcast(_model(kept.join(factors, "term").select("term", F.array("idf", *names).alias("v")), dim, beside=1))
        parts = held.select("_tok").mapInArrow(_passed(sent, dim), ", ".join(["term string", *[f"{f} double" for f in names]]))
        if weights is not None:
            rows = weights.join(factors, "term").groupBy("doc").agg(*summed).withColumnRenamed("doc", "of")
            parts = parts.unionAll(weights.join(rows, F.col("doc").eqNullSafe(F.col("of"))).groupBy("term").agg(*summed))
        factors = written(parts.groupBy("term").agg(*[F.sum(f).alias(f) for f in names]), "factors")
        sent.destroy()
    if orthonormal:
        basis = whitening(factors, dim)
        turned = [sum((F.col(f) * float(basis[i, j]) for i, f in enumerate(names)), F.lit(0.0)) for j in range(dim)]
        factors = factors.select("term", *[c.alias(f) for c, f in zip(turned, names, strict=True)])
    kept.join(factors, "term").select("term", "idf", F.array(*names).alias("factor")).write.parquet(path)
    return load(spark, path, dim)


def _weights(tf: DataFrame, kept: DataFrame) -> DataFrame:
    """(doc, term, w): counts times idf, a document's weights of length one."""
    weights = tf.join(kept, "term").select("doc", "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = weights.groupBy(F.col("doc").alias("of")).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    return written(weights.join(length, F.col("doc").eqNullSafe(F.col("of"))).select("doc", "term", (F.col("w") / F.col("length")).alias("w")),
                   "term-weights")


#: Of this Python worker: the models it has loaded, by their id.
_LOADED: dict[str, tuple[dict[str, int], np.ndarray]] = {}


def model_of(mark: str, sent: Broadcast) -> tuple[dict[str, int], np.ndarray]:
    """The model in this worker, built from the broadcast once however many batches and tasks it encodes."""
    if mark not in _LOADED:
        terms, matrix = sent.value
        _LOADED[mark] = {t: i for i, t in enumerate(terms)}, matrix
    return _LOADED[mark]


@dataclass(frozen=True)
class Encoder:
    """``hash_embed(..., encoder=…)``: text to unit vector, the sum of its words' vectors times their idf."""

    sent: Broadcast
    dim: int
    double: bool = False
    mark: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __call__(self, df: DataFrame, text: str, out: str) -> DataFrame:
        kept = df.drop(out)
        kind = "double" if self.double else "float"
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), f"`{out}` array<{kind}>"])
        return kept.withColumn("_tok", tokens(text)).mapInArrow(_encoded(self.mark, self.sent, self.dim, out, self.double), schema)


def load(spark: SparkSession, path: str, dim: int, double: bool = False) -> Encoder:
    """The encoder of a fitted model: at most ``MAX_VALUES`` numbers, read once and broadcast once."""
    table = spark.read.parquet(path).select("term", F.transform("factor", lambda x: x * F.col("idf")).alias("v"))
    return Encoder(spark.sparkContext.broadcast(_model(table, dim, np.float64 if double else np.float32)), dim, double)


def places(lists, place: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Of every known token in the lists: its row, ascending, and its term's place."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    coded = pc.list_flatten(lists).dictionary_encode()
    known = np.array([place.get(t, -1) for t in coded.dictionary.to_pylist()], np.int64)
    at = known[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(lists)), sizes)[at >= 0], at[at >= 0]


def summed_into(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds each row to ``out`` at its place; places ascend."""
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out[at[first]] += np.add.reduceat(rows, first, axis=0)


def _encoded(mark: str, sent: Broadcast, dim: int, out: str, double: bool):
    """mapInArrow: token lists to unit vectors."""
    import pyarrow as pa

    def run(batches):
        place, matrix = model_of(mark, sent)
        for rb in batches:
            if rb.num_rows == 0:
                continue
            rows, at = places(rb.column("_tok"), place)
            x = np.zeros((rb.num_rows, dim))
            for start in range(0, len(at), STEP):  # a text longer than a step is summed in several
                summed_into(x, rows[start:start + STEP], matrix[at[start:start + STEP]].astype(np.float64))
            norm = np.sqrt((x * x).sum(axis=1))
            x = (x / np.where(norm > 0, norm, 1.0)[:, None]).astype(np.float64 if double else np.float32)
            vec = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, dim, dtype=np.int32)), pa.array(x.ravel()))
            tok = rb.schema.get_field_index("_tok")
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(rb.columns) if i != tok] + [vec],
                                             names=[n for n in rb.schema.names if n != "_tok"] + [out])
    return run
