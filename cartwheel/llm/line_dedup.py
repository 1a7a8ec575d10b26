"""Line dedup: documents that share rare lines are aligned, and common blocks go from the later one.

A line's key is the hash of its words. Keys that few documents hold (``RARE``) link
all their holders; keys that many hold link each holder with the first one only. So
do runs of adjacent lines that just reach the words of a block, from each line on and
up to each line: whatever block a document shares, it meets the first document that
has each such run of it. Links stay linear in the lines. Each linked pair is aligned with patience diff (common
ends, then lines unique on both sides in their longest common order, then the gaps
between them; a gap without such a line by a longest common subsequence); runs of
aligned lines with enough words are deleted from the later document. Alignment sees line keys only; texts move once, to meet what they lose.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import batches_of, staged, texts

RARE = 8  # documents that hold a rare line, at most
LINK_WORDS = 3  # words of a line that can link documents
BLOCK_WORDS = 8  # words of a block that is deleted
BATCH_BYTES = 4_000_000

SPANS = "array<struct<start:int,end:int>>"
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

MATCH, NONE = 1 << 32, -(1 << 60)  # alignment score of an aligned line (one that goes on a run: 1 more), and of what cannot be


def line_keys(text: str | None) -> tuple[list[int], list[int], list[int]]:
    """Number, key and word count of each line that has words (lines part at line feeds; A-Z count as a-z)."""
    at, keys, sizes = [], [], []
    for i, line in enumerate((text or "").encode("utf-8", "replace").lower().split(b"\n")):
        if found := line.split():
            at.append(i)
            keys.append(xxhash.xxh64_intdigest(b" ".join(found)) - (1 << 63))
            sizes.append(len(found))
    return at, keys, sizes


def run_keys(keys: list[int], sizes: list[int], min_words: int) -> list[int]:
    """Keys of the shortest runs of two or more adjacent lines with ``min_words`` words, from each line on and up to each line.

    Every line of a block with that many words is in such a run inside the block (or has the words alone, and its own key).
    """
    runs, first, words = set(), 0, 0
    for last, n in enumerate(sizes):
        words += n
        if words >= min_words:
            if not runs:
                runs.add((first, last))
            while words - sizes[first] >= min_words:  # lines that reach the words with this line and did not before
                words -= sizes[first]
                first += 1
                runs.add((first, last))
            runs.add((first, last))
    data = np.array(keys, np.int64)
    return [xxhash.xxh64_intdigest(data[a:b + 1].tobytes()) - (1 << 63) for a, b in sorted(runs) if a < b]


# ---- alignment -------------------------------------------------------------

def longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence (ordered by the first number) whose second numbers rise."""
    tops: list[int] = []
    top_at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        back[i] = top_at[k - 1] if k else -1
        if k == len(tops):
            tops.append(b)
            top_at.append(i)
        else:
            tops[k], top_at[k] = b, i
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def prefix_scores(x: np.ndarray, x_at: np.ndarray, y: np.ndarray, y_at: np.ndarray, joined: bool) -> tuple[np.ndarray, np.ndarray]:
    """Scores of ``x`` against each prefix of ``y``: the best, and the best whose last pair is the last line of both.

    ``x_at``, ``y_at``: line positions, which say what is adjacent; ``joined``: a pair of the first lines goes on a run.
    """
    best, last = np.zeros(len(y) + 1, np.int64), np.full(len(y) + 1, NONE)
    next_y = np.diff(y_at, prepend=y_at[0]) == 1
    next_x = np.diff(x_at, prepend=x_at[0]) == 1
    for p, key in enumerate(x):
        at = np.flatnonzero(y == key)
        scores = best[at]
        if next_x[p]:
            scores = np.maximum(scores, np.where(next_y[at], last[at] + 1, NONE))
        scores += MATCH
        if joined and not p and len(at) and not at[0]:
            scores[0] += 1
        last.fill(NONE)
        last[at + 1] = scores
        best[at + 1] = np.maximum(best[at + 1], scores)
        np.maximum.accumulate(best, out=best)
    return best, last


def longest_common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Longest common subsequence as positions in ``a`` and ``b``; of several, one with most pairs that go on a run.

    Hirschberg's halving: memory linear in the lines, time the product of the shared lines of both.
    """
    shared = set(a) & set(b)
    x_at, y_at = (np.array([p for p, key in enumerate(s) if key in shared], np.int64) for s in (a, b))
    if len(x_at) > len(y_at):
        return sorted((i, k) for k, i in longest_common(b, a))
    x, y = np.array(a, np.int64)[x_at], np.array(b, np.int64)[y_at]
    out = []
    work = [(0, len(x), 0, len(y), False, False)]  # the flags: a pair of the first, last lines goes on a run outside
    while work:
        p, r, q, s, first, last = work.pop()
        if p == r or q == s:
            continue
        if r - p == 1:
            if len(at := q + np.flatnonzero(y[q:s] == x[p])):
                out.append((p, int(max(at, key=lambda n: (first and n == q) + (last and n == s - 1)))))
            continue
        half = (p + r) // 2
        best, upto = prefix_scores(x[p:half], x_at[p:half], y[q:s], y_at[q:s], first)
        rest, after = (v[::-1] for v in prefix_scores(x[half:r][::-1], -x_at[half:r][::-1], y[q:s][::-1], -y_at[q:s][::-1], last))
        parted = best + rest
        cut = int(parted.argmax())
        through = np.full(s - q + 1, NONE)
        if x_at[half] - x_at[half - 1] == 1:
            through[1:-1] = np.where(np.diff(y_at[q:s]) == 1, upto[1:-1] + after[1:-1] + 1, NONE)
        run = int(through.argmax())
        if through[run] > parted[cut]:
            cut = q + run
            out += [(half - 1, cut - 1), (half, cut)]
            work.append((p, half - 1, q, cut - 1, first, bool(half - 1 > p and cut - 1 > q and x_at[half - 1] - x_at[half - 2] == 1
                                                              and y_at[cut - 1] - y_at[cut - 2] == 1)))
            work.append((half + 1, r, cut + 1, s, bool(half + 1 < r and cut + 1 < s and x_at[half + 1] - x_at[half] == 1
                                                       and y_at[cut + 1] - y_at[cut] == 1), last))
        else:
            work += [(p, half, q, q + cut, first, False), (half, r, q + cut, s, False, last)]
    return sorted((int(x_at[i]), int(y_at[k])) for i, k in out)


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences, rising in both."""
    out = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, j, k, m = work.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        left, right = Counter(a[i:j]), Counter(b[k:m])
        place = {x: p for p, x in enumerate(b[k:m], k) if right[x] == 1}
        anchors = longest_rising([(p, place[x]) for p, x in enumerate(a[i:j], i) if left[x] == 1 and x in place])
        if not anchors:
            out += [(i + p, k + q) for p, q in longest_common(a[i:j], b[k:m])]
            continue
        out += anchors
        for p, q in [*anchors, (j, m)]:
            work.append((i, p, k, q))
            i, k = p + 1, q + 1
    return sorted(out)


def common_blocks(early: list[int], late: list[int], sizes: list[int], min_words: int) -> list[tuple[int, int]]:
    """[first, last] positions in ``late`` of aligned runs with at least ``min_words`` words."""
    blocks, run = [], []
    for i, k in [*patience(early, late), (-2, -2)]:
        if run and (i, k) != (run[-1][0] + 1, run[-1][1] + 1):
            first, last = run[0][1], run[-1][1]
            if sum(sizes[first:last + 1]) >= min_words:
                blocks.append((first, last))
            run = []
        run.append((i, k))
    return blocks


# ---- documents -------------------------------------------------------------

def sequences(docs: DataFrame, min_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, mark, text) to one row per distinct document: its id, text mark, lines with words, and keys of runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches_of(batches, "text", BATCH_BYTES):
            found = [line_keys(t) for t in texts(part, "text")]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *(pa.array([f[c] for f in found], pa.list_(t))
                                                   for c, t in ((0, pa.int32()), (1, pa.int64()), (2, pa.int32()))),
                 pa.array([run_keys(keys, sizes, min_words) for _, keys, sizes in found], pa.list_(pa.int64()))],
                names=["doc_id", "mark", "at", "keys", "sizes", "runs"])

    schema = "doc_id bigint, mark bigint, at array<int>, keys array<bigint>, sizes array<int>, runs array<bigint>"
    return docs.select("doc_id", "mark", "text").mapInArrow(run, schema).dropDuplicates(["doc_id", "mark"])


def place(doc_id: str = "doc_id", mark: str = "mark") -> Column:
    """A document's place in the order: by id, null last; then by the mark of its text."""
    return F.struct(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("doc_id"), F.col(mark).alias("mark"))


def linked_pairs(seqs: DataFrame, rare: int = RARE, link_words: int = LINK_WORDS) -> DataFrame:
    """Pairs of places (early, late) that share a line or run: all holders of a rare line, else each with the first."""
    long = F.filter(F.zip_with("keys", "sizes", lambda k, n: F.when(n >= link_words, k)), lambda k: k.isNotNull())

    def tagged(keys: str | Column, run: bool) -> Column:
        return F.transform(F.array_distinct(keys), lambda k: F.struct(k.alias("key"), F.lit(run).alias("run")))

    both = F.concat(tagged(long, False), tagged("runs", True))
    lines = seqs.select(place().alias("doc"), F.explode(both).alias("line")).select("doc", "line.*")
    holders = lines.groupBy("key", "run").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first")).where("n > 1")
    # Written, so that the join below shuffles both sides itself and Spark may split a hot line's rows.
    holders = staged(holders, "line-holders")
    shared = lines.join(holders, ["key", "run"])
    starred = F.col("run") | (F.col("n") > rare)
    star = shared.where(starred & (F.col("doc") != F.col("first"))).select(
        F.col("first").alias("early"), F.col("doc").alias("late"))
    # Grouped by a hash of the key, not the key: the rare rows are shuffled anew, and Spark may split the join's hot keys.
    few = (shared.where(~starred).groupBy(F.xxhash64("key").alias("key"))
           .agg(F.sort_array(F.collect_list("doc")).alias("docs")))
    pairs = F.flatten(F.transform("docs", lambda a, i: F.transform(
        F.slice("docs", i + 2, F.size("docs")), lambda b: F.struct(a.alias("early"), b.alias("late")))))
    return star.unionByName(few.select(F.explode(pairs).alias("p")).select("p.early", "p.late")).distinct()


def aligned(pairs: DataFrame, seqs: DataFrame, min_words: int = BLOCK_WORDS) -> DataFrame:
    """Per later document the line spans that go: (doc_id, mark, spans); each pair is aligned on its own row."""
    keyed = seqs.select(place().alias("doc"), "at", "keys", "sizes")
    rows = (pairs.join(keyed.select(F.col("doc").alias("early"), F.col("keys").alias("early_keys")), "early")
            .join(keyed.withColumnRenamed("doc", "late"), "late")
            .select("late.doc_id", "late.mark", "early_keys", "at", "keys", "sizes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for early, at, keys, sizes in zip(*(texts(batch, c) for c in ("early_keys", "at", "keys", "sizes")), strict=True):
                spans.append([{"start": at[a], "end": at[b] + 1} for a, b in common_blocks(early, keys, sizes, min_words)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, ARROW_SPANS)],
                                             names=["doc_id", "mark", "spans"])

    found = rows.mapInArrow(run, f"doc_id bigint, mark bigint, spans {SPANS}")
    return (found.where(F.size("spans") > 0).select("doc_id", "mark", F.explode("spans").alias("span")).distinct()
            .groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list("span")).alias("spans")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE,
                link_words: int = LINK_WORDS, min_words: int = BLOCK_WORDS, spans_out: str = "removed_lines") -> DataFrame:
    """``docs`` with ``text_col`` less the deleted lines, and their spans (line numbers, end exclusive) appended.

    One row per input row. Null and empty texts lose nothing; a null id orders last,
    documents of one id order by their text. Rows that repeat id and text are one
    document: they lose the same and nothing to each other. Blank lines inside a
    deleted block go with it. A column called ``spans_out`` is replaced.
    """
    kept = docs.drop(spans_out)
    marked = kept.withColumns({"__id": F.col(id_col).cast("bigint"), "__mark": F.xxhash64(F.col(text_col))})
    seqs = staged(sequences(marked.select(F.col("__id").alias("doc_id"), F.col("__mark").alias("mark"),
                                          F.col(text_col).cast("string").alias("text")), min_words), "line-keys")
    lost = aligned(linked_pairs(seqs, rare, min(link_words, min_words)), seqs, min_words).select(
        F.col("doc_id").alias("__lost_id"), F.col("mark").alias("__lost_mark"), F.col("spans").alias("__spans"))
    joined = marked.join(lost, F.col("__id").eqNullSafe(F.col("__lost_id")) & (F.col("__mark") == F.col("__lost_mark")), "left")
    lines = F.filter(F.split(text_col, "\n", -1), lambda _, i: ~F.exists(
        "__spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    text = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(F.array_join(lines, "\n"))
    spans = F.coalesce("__spans", F.array().cast(SPANS))
    return joined.withColumns({text_col: text, spans_out: spans}).select(*kept.columns, spans_out)


def line_report(docs: DataFrame) -> DataFrame:
    """Query ``op9_lines``: doc_id, lines, lines removed, digest and length of the kept text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("bigint")
    out = dedup_lines(rows.withColumn("n_lines", lines))
    # Spans may overlap when several documents gave them; a line counts once.
    n = F.size(F.array_distinct(F.flatten(F.transform("removed_lines", lambda s: F.sequence(s["start"], s["end"] - 1)))))
    return out.select("doc_id", "n_lines", n.cast("bigint").alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
                      F.char_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("kept_chars"))
