"""Language identification: language family first, then one-versus-one linear SVMs within it.

Texts are read as byte n-grams (orders 1 to 4, over lower-cased letters), hashed
into ``BUCKETS`` features and scaled to frequencies. One family of classifiers
tells language families apart, further ones tell each pair of languages of a
family apart; each is a linear support vector machine, trained in a task of its own by
dual coordinate descent. A prediction sums, for every classifier, the weights of all n-grams of the whole text, lets the families
duel, and then the languages of the winning family.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import batches_of, extended, texts

UNDETERMINED = "und"
ORDERS = 4
BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
SCALE = 100.0  # frequencies in percent
BATCH_BYTES = 1_000_000  # text scored at once in a task

# Families of language codes; a code not listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "semitic": ["am", "ar", "he"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

# ASCII that is not a letter separates words; bytes of other characters stay.
GAPS = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


def letters(text: str | None) -> bytes:
    """Lower-cased words of a text, each with a space on both sides; empty if it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return b""
    found = text.lower().encode("utf-8", "replace").translate(GAPS).split()
    return b" " + b" ".join(found) + b" " if found else b""


def grams(cleaned: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature of each n-gram (orders x positions) and each text's positions [start, end).

    Zero bytes part the texts, so no n-gram of a text holds bytes of another.
    """
    pad = b"\0" * ORDERS
    data = np.frombuffer(pad.join([*cleaned, b""]) + pad, np.uint8).astype(np.uint32)
    sizes = np.array([len(c) for c in cleaned], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + ORDERS)[:-1]]).astype(np.int64)
    n = max(len(data) - ORDERS, 0)
    out = np.empty((ORDERS, n), np.uint16)
    rolling = np.zeros(n, np.uint32)
    for k in range(ORDERS):
        rolling = rolling * np.uint32(257) + data[k:k + n] + np.uint32(1)
        mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(2654435761 + 2 * k)
        out[k] = mixed >> np.uint32(32 - BUCKET_BITS)
    return out, starts, starts + sizes


@dataclass
class Model:
    """Duels (left, right, level) and their weights: columns of ``weights``, offsets in ``bias``."""
    langs: list[str]
    duels: list[tuple[str, str, str]]
    weights: np.ndarray
    bias: np.ndarray

    def margins(self, cleaned: list[bytes]) -> np.ndarray:
        if not self.duels:
            return np.zeros((len(cleaned), 0))
        features, starts, ends = grams(cleaned)
        summed = self.weights[features[0]]
        for row in features[1:]:
            summed += self.weights[row]
        out = np.zeros((len(cleaned), len(self.duels)))
        full = np.flatnonzero(ends > starts)
        if len(full):
            bounds = np.stack([starts[full], ends[full]], 1).ravel()
            summed = np.concatenate([summed, np.zeros((1, summed.shape[1]), summed.dtype)])
            totals = np.add.reduceat(summed, bounds, axis=0, dtype=np.float64)[::2]
            out[full] = totals * (SCALE / ORDERS) / (ends - starts)[full, None]
        return out + self.bias

    def winner(self, level: str, names: list[str], margins: np.ndarray) -> tuple[str, float]:
        """The name with most duels won (ties: larger margins, then name) and its mean probability."""
        if len(names) == 1:
            return names[0], 1.0
        wins, gains, odds = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0)
        for (left, right, where), m in zip(self.duels, margins, strict=True):
            if where == level:
                p = 1.0 / (1.0 + np.exp(-np.clip(2.0 * m, -60, 60)))
                wins[left if m >= 0 else right] += 1
                for name, sign, chance in ((left, 1, p), (right, -1, 1 - p)):
                    gains[name] += sign * m
                    odds[name] += chance / (len(names) - 1)
        best = min(names, key=lambda n: (-wins[n], -gains[n], n))
        return best, float(odds[best])

    def predict(self, found: list[str | None]) -> tuple[list[str], list[float]]:
        cleaned = [letters(t) for t in found]
        by_family: dict[str, list[str]] = {}
        for lang in self.langs:
            by_family.setdefault(family_of(lang), []).append(lang)
        langs, scores = [], []
        for text, m in zip(cleaned, self.margins(cleaned), strict=True):
            if not text or not self.langs:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            family, p = self.winner("", sorted(by_family), m)
            lang, q = self.winner(family, by_family[family], m)
            langs.append(lang)
            scores.append(p * q)
        return langs, scores


def features(docs: DataFrame) -> DataFrame:
    """(lang, text) rows to (lang, indices, values): sparse n-gram frequencies of whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of([batch], "text", BATCH_BYTES):
                cleaned = [letters(t) for t in texts(part, "text")]
                found, starts, ends = grams(cleaned)
                idx, val = [], []
                for s, e in zip(starts, ends, strict=True):
                    counts = np.bincount(found[:, s:e].ravel(), minlength=BUCKETS)
                    kept = np.flatnonzero(counts)
                    idx.append(kept.astype(np.int32))
                    val.append(counts[kept] * (SCALE / ORDERS) / max(e - s, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("lang")), pa.array(idx, pa.list_(pa.int32())),
                     pa.array(val, pa.list_(pa.float64()))], names=["lang", "indices", "values"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, indices array<int>, values array<double>")


def svm(x: np.ndarray, y: np.ndarray, cost: float, epochs: int) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge) by dual coordinate descent; returns weights and offset for unscaled features.

    Features are scaled by the square root of their mean (rare n-grams gain, noise does
    not), rows to a mean length of 1; both scales are folded back into the weights.
    """
    scale = 1.0 / np.sqrt(x.mean(axis=0, dtype=np.float64) + 1e-3)
    z = (x * scale).astype(np.float32)
    size = float(np.sqrt(np.einsum("ij,ij->i", z, z).mean())) or 1.0
    z = np.concatenate([z / size, np.ones((len(z), 1), np.float32)], axis=1)
    norms = np.einsum("ij,ij->i", z, z) + 0.5 / cost
    w, alpha = np.zeros(z.shape[1], np.float32), np.zeros(len(z))
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(z)):
            g = y[i] * float(z[i] @ w) - 1.0 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - g / norms[i], 0.0)
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * z[i]
                alpha[i] = new
    return w[:-1] * scale / size, float(w[-1])


def _train(cost: float, epochs: int):
    def run(group: pa.Table) -> pa.Table:
        idx, val = texts(group, "indices"), texts(group, "values")
        x = np.zeros((len(idx), BUCKETS), np.float32)
        for row, i, v in zip(x, idx, val, strict=True):
            row[i] = v
        y = np.array(texts(group, "side"), np.float64)
        order = np.lexsort((x[:, :64].sum(axis=1), y))  # the same order whatever tasks the rows came from
        w, b = svm(x[order], y[order], cost, epochs)
        return pa.table({"duel": pa.array(texts(group, "duel")[:1], pa.int32()), "weights": pa.array([w.tolist()], pa.list_(pa.float64())),
                         "bias": pa.array([b], pa.float64())})
    return run


def mark_limit(n: int, wanted: int) -> int:
    """Largest signed 64-bit hash of those that about ``wanted`` of ``n`` texts have."""
    return (min(n, wanted) << 64) // n - (1 << 63) - 1


def sample(rows: DataFrame, counts: dict[str, int], per_language: int) -> DataFrame:
    """The ``per_language`` texts of each language with the smallest marks, of (lang, text, mark) rows; copies count once.

    ``counts``: distinct marks of each language. Some more texts than wanted pass a limit
    on the mark first, so what is ranked does not grow with the input.
    """
    limits = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, mark_limit(n, 2 * per_language + 100))])
    some = rows.where(F.col("mark") <= F.element_at(limits, F.col("lang"))).dropDuplicates(["lang", "mark"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    return some.withColumn("rank", rank).where(F.col("rank") <= per_language).select("lang", "text")


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 400,
        cost: float = 1.0, epochs: int = 15) -> Model:
    """Train on a bounded sample: ``per_language`` distinct texts of each language (all, if it has fewer).

    A text that many rows repeat counts once, so the sample, and the group a duel
    trains on, does not grow with the input or its copies. Rows without language or
    letters teach nothing. No labelled rows: a model that answers ``und``.
    """
    rows = (labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("mark", F.xxhash64("text")))
    counts = {r["lang"]: r["n"] for r in rows.select("lang", "mark").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    families = sorted({family_of(k) for k in langs})
    duels = [(a, b, "") for a, b in itertools.combinations(families, 2)]
    duels += [(a, b, f) for f in families for a, b in itertools.combinations([k for k in langs if family_of(k) == f], 2)]
    weights, bias = np.zeros((BUCKETS, len(duels)), np.float32), np.zeros(len(duels))
    if not duels:
        return Model(langs, duels, weights, bias)
    chosen = sample(rows, counts, per_language)
    sides = {k: [(i, 1.0 if k == a or family_of(k) == a and not level else -1.0) for i, (a, b, level) in enumerate(duels)
                 if (k in (a, b) if level else family_of(k) in (a, b))] for k in langs}
    roles = F.create_map(*[x for k in langs for x in (F.lit(k), F.array(*[
        F.struct(F.lit(i).alias("duel"), F.lit(y).alias("side")) for i, y in sides[k]]))])
    train = features(chosen).withColumn("role", F.explode(F.element_at(roles, F.col("lang"))))
    fitted = (train.select(F.col("role.duel").alias("duel"), F.col("role.side").alias("side"), "indices", "values")
              .groupBy("duel").applyInArrow(_train(cost, epochs), "duel int, weights array<double>, bias double"))
    for r in fitted.collect():  # one row per duel
        weights[:, r["duel"]], bias[r["duel"]] = r["weights"], r["bias"]
    return Model(langs, duels, weights, bias)


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1) appended; one row per input row.

    ``und`` with score 0 where the text is null or has no letter. A map over Arrow
    batches, whole texts, no shuffle; the model (``BUCKETS`` weights per duel) is
    what travels to the tasks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches_of(batches, text_col, BATCH_BYTES):
            langs, scores = model.predict(texts(part, text_col))
            yield extended(part, {lang_out: pa.array(langs, pa.string()), score_out: pa.array(scores, pa.float64())})

    kept = docs.drop(lang_out, score_out)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{schema}, `{lang_out}` string, `{score_out}` double")


def held_out(id_col: str = "doc_id") -> F.Column:
    """Documents the model never learns from: crc32 of the id as text, modulo 3, is 1 (null id: held out too)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))


def language_report(docs: DataFrame) -> DataFrame:
    """Contract of ``op8_language``: per document held_out, lang_pred and score."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    model = fit(rows.where(~held_out()))
    found = identify(rows.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
