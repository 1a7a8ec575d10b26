"""Merkle manifest of a dataset: leaves per document, a subtree per source, proofs and tamper checks.

A leaf is the SHA-256 of a row's fields; in each source the leaves ascend by id, and every ``FAN``
consecutive nodes become their digest until one is left, the source's subroot; the subroots,
in order of the sources, become the root the same way. The trees are never in one place:

* up: a superblock, ``SPAN`` = FAN³ consecutive nodes of a source, is reduced to one node by
  ``applyInPandas``; rounds go on until every source has one node (three rounds reach 7·10¹⁰ rows);
* down: the nodes outside a superblock that its proofs need (at most 15 a level) follow from the
  superblock above it, and meet its leaves in a cogroup, where one ``applyInPandas`` reduces the
  superblock again, joins its part of the proofs to the outer part, and folds every leaf back to the root.

Small sources share a group: its key is where a superblock starts in the whole order, so a group has
at most two superblocks' rows however many sources there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import staged
from cartwheel.operators.ranking import sorted_index

FAN = 16
STEPS = 3  # levels of a superblock
SPAN = FAN ** STEPS
HEX = 64  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 5

NODE = "tree bigint, first bigint, n bigint, pos bigint, digest binary"
OUTER = "tree bigint, first bigint, pos bigint, lefts array<string>, rights array<string>, subroot string, root string"
PROOF = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def field(value: str | Column) -> Column:
    """A field as hashed: `-` if null, else its UTF-8 byte count, `:`, the value."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*fields: str | Column) -> Column:
    """Digest of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(f) for f in fields]), 256))


def lower_ascii(text: str | Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def depth(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def reduced(nodes: list[str], steps: int) -> list[list[str]]:
    """The joined digests of each run, level by level, and the nodes that are left at the end."""
    levels = []
    for _ in range(steps):
        runs = ["".join(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)]
        levels.append(runs)
        nodes = [digest(r) for r in runs]
    return [*levels, nodes]


def siblings(levels: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """Digests left and right of node ``at``'s ancestors, level by level."""
    lefts, rights = [], []
    for runs in levels[:-1]:
        run, place = divmod(at, FAN)
        lefts.append(runs[run][:place * HEX])
        rights.append(runs[run][(place + 1) * HEX:])
        at = run
    return lefts, rights


def fold(node: str, lefts: list[str], rights: list[str]) -> str:
    for a, b in zip(lefts, rights, strict=True):
        node = digest(a + node + b)
    return node


def superblocks(rows: pd.DataFrame) -> Iterator[tuple[tuple[int, int], pd.DataFrame]]:
    """((tree, number of the superblock), its nodes in order) of a group."""
    rows = rows.sort_values(["tree", "pos"], kind="stable")
    yield from rows.groupby([rows["tree"], rows["pos"] // SPAN], sort=False)


def _reduce(rows: pd.DataFrame) -> pd.DataFrame:
    out = []
    for (tree, block), part in superblocks(rows):
        n = int(part["n"].iloc[0])
        top = reduced([x.hex() for x in part["digest"]], min(STEPS, depth(n)))[-1]
        out.append((tree, part["first"].iloc[0], -(-n // SPAN), block, bytes.fromhex(top[0])))
    return pd.DataFrame(out, columns=["tree", "first", "n", "pos", "digest"])


def outer_of(outer: pd.DataFrame) -> dict[tuple[int, int], tuple]:
    return {(t, p): (list(a), list(b), s, r) for t, p, a, b, s, r in
            zip(outer["tree"], outer["pos"], outer["lefts"], outer["rights"], outer["subroot"], outer["root"], strict=True)}


def _expand(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Siblings of each node up to the root: those inside its superblock, then the superblock's own."""
    above, out = outer_of(outer), []
    for (tree, block), part in superblocks(rows):
        levels = reduced([x.hex() for x in part["digest"]], min(STEPS, depth(int(part["n"].iloc[0]))))
        lefts, rights, subroot, root = above[tree, block]
        for at, pos in enumerate(part["pos"]):
            a, b = siblings(levels, at)
            out.append((tree, part["first"].iloc[0], pos, a + lefts, b + rights, subroot, root))
    return pd.DataFrame(out, columns=["tree", "first", "pos", "lefts", "rights", "subroot", "root"])


def _finish(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Proof and folded root of each leaf of the group's superblocks."""
    above, out = outer_of(outer), []
    for (tree, block), part in superblocks(rows):
        leaves = [x.hex() for x in part["digest"]]
        levels = reduced(leaves, min(STEPS, depth(int(part["n"].iloc[0]))))
        lefts, rights, subroot, root = above[tree, block]
        tail = "".join(a + b for a, b in zip(lefts, rights, strict=True))
        for at, (doc_id, own, shown) in enumerate(zip(part["doc_id"], leaves, part["shown"], strict=True)):
            a, b = siblings(levels, at)
            proof = "".join(x + y for x, y in zip(a, b, strict=True)) + tail
            folded = fold(own if shown is None else shown.hex(), a + lefts, b + rights)
            out.append((doc_id, own, subroot, root, digest(proof), folded, folded == root))
    return pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def by_superblock(nodes: DataFrame, level: int, block: Column | None = None) -> DataFrame:
    """Adds the group key of round ``level``: where the node's superblock starts in the whole order, in superblocks."""
    width = SPAN ** (level + 1)
    block = F.expr(f"pos div {SPAN}") if block is None else block
    return nodes.withColumn("_start", F.col("first") + block * F.lit(width)).withColumn("_key", F.expr(f"_start div {width}")).drop("_start")


def climb(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of every round that still has several in a tree, and one node per tree. ``most``: nodes of the largest tree."""
    rounds, tops, at = [nodes], [], 0
    while True:
        up = by_superblock(rounds[-1], at).groupBy("_key").applyInPandas(_reduce, NODE)
        most = -(-most // SPAN)
        if most == 1:
            tops.append(up)
            break
        up = staged(up, f"merkle-nodes-{at}")
        tops.append(up.where("n = 1"))
        rounds.append(up.where("n > 1"))
        at += 1
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return rounds, staged(top, "merkle-tops")


def descend(rounds: list[DataFrame], tops: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` over the nodes of the lowest round, cogrouped with what lies outside their superblocks.

    ``tops`` (as OUTER): what lies outside each whole tree. A tree that one superblock covers takes it from there,
    any other from the round above.
    """
    outer = tops
    for at in reversed(range(len(rounds))):
        left = by_superblock(rounds[at], at).groupBy("_key")
        right = by_superblock(outer, at, F.col("pos")).groupBy("_key")
        if at == 0:
            return left.cogroup(right).applyInPandas(fn, schema)
        inner = left.cogroup(right).applyInPandas(_expand, OUTER)
        outer = inner.unionByName(tops.join(rounds[at].select("tree").distinct(), "tree", "left_anti"))
    raise AssertionError("no round")


def ordered_leaves(docs: DataFrame, shown: Column | None = None, fields: tuple[str, ...] = FIELDS,
                   id_col: str = "doc_id", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(leaves, sources). Leaves: tree, first, n, pos, digest, doc_id, shown; sources: tree, source, first, n.

    ``shown`` is the digest a row shows when it is checked (null: its own). Ids ascend, null first; rows that share
    an id go by their digest. A source's leaves have consecutive places in one global sort, so ``first`` and ``n`` give
    each its place in its own tree; no window runs over a source.
    """
    kept = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       leaf(*fields).alias("digest"), (F.lit(None).cast("binary") if shown is None else shown).alias("shown"))
    kept = staged(kept, "merkle-leaves").withColumn("_mark", F.monotonically_increasing_id())
    placed = sorted_index(kept, [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("digest"), F.asc("_mark")], "_at")
    sources = placed.groupBy("source").agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = staged(sorted_index(sources, [F.asc("first")], "tree"), "merkle-sources")
    leaves = placed.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    leaves = leaves.select("tree", "first", "n", (F.col("_at") - F.col("first")).alias("pos"), "digest", "doc_id", "shown")
    return staged(leaves, "merkle-placed"), sources


def _above(tops: DataFrame, sources: DataFrame, total: int) -> DataFrame:
    """What lies outside each source's tree (as OUTER), from the tree of the subroots."""
    crown = tops.select(F.lit(0).cast("bigint").alias("tree"), F.lit(0).cast("bigint").alias("first"), F.lit(total).cast("bigint").alias("n"),
                        F.col("tree").alias("pos"), "digest")
    rounds, top = climb(crown, total)
    whole = top.select("tree", "first", F.lit(0).cast("bigint").alias("pos"), F.array().cast("array<string>").alias("lefts"),
                       F.array().cast("array<string>").alias("rights"), F.lit("").alias("subroot"), F.lower(F.hex("digest")).alias("root"))
    found = descend(rounds, whole, _expand, OUTER).select(F.col("pos").alias("tree"), "lefts", "rights", "root")
    return (found.join(tops.select("tree", F.lower(F.hex("digest")).alias("subroot")), "tree").join(sources.select("tree", "first"), "tree")
            .select("tree", "first", F.lit(0).cast("bigint").alias("pos"), "lefts", "rights", "subroot", "root"))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """One row per source: source, n leaves, subroot, root (an empty table has none)."""
    leaves, sources = ordered_leaves(docs, None, fields, id_col, source_col)
    size = sources.agg(F.max("n"), F.count(F.lit(1))).first()
    if not size[1]:
        return sources.select("source", "n", F.lit("").alias("subroot"), F.lit("").alias("root"))
    _, tops = climb(leaves.drop("doc_id", "shown"), size[0])
    return sources.join(_above(tops, sources, size[1]).select("tree", "subroot", "root"), "tree").select("source", "n", "subroot", "root")


def prove(docs: DataFrame, shown: Column | None = None, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
          source_col: str = "source") -> DataFrame:
    """Each row's leaf, subroot, root, digest of its proof, the root folded from what it shows, and whether that is the root.

    ``shown`` is the digest that is checked against the manifest; null shows the row's own. Null fields hash as `-`; null
    ids come first, a null source is a source of its own, repeated rows are leaves of their own, empty and long texts
    are whole leaves; only the named columns are read. An empty table has no rows.
    """
    leaves, sources = ordered_leaves(docs, shown, fields, id_col, source_col)
    size = sources.agg(F.max("n"), F.count(F.lit(1))).first()  # two numbers
    if not size[1]:
        return docs.sparkSession.createDataFrame([], PROOF.replace("doc_id string", "doc_id bigint"))
    rounds, tops = climb(leaves.drop("doc_id", "shown"), size[0])
    rows = descend([leaves.withColumn("doc_id", F.col("doc_id").cast("string")), *rounds[1:]], _above(tops, sources, size[1]), _finish, PROOF)
    return rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))  # as text through pandas: a null would make doubles of the ids


def manifest_report(docs: DataFrame) -> DataFrame:
    """Contract of ``op11_merkle``: every fifth document, by a checksum of its id, shows its text in lower case."""
    tampered = leaf(*[lower_ascii(F.col(f)) if f == "text" else f for f in FIELDS])
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPER_MODULUS == 0
    return prove(docs, F.when(chosen, tampered))


def _report_sql(levels: int = 6, source_levels: int = 3) -> str:
    """The same rows by windows over whole levels: up to 16⁶ documents of a source, 16³ sources."""
    def tree(name: str, group: str, count: int) -> str:
        out = []
        for k in range(count):
            run = f"PARTITION BY {group}, i // 16 ORDER BY i ROWS BETWEEN"
            out.append(f"""{name}_s{k} AS (SELECT *, CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
  CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r FROM {name}_{k}),
{name}_{k + 1} AS (SELECT {group}, i // 16 AS i, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h
  FROM {name}_{k} GROUP BY {group}, i // 16, n)""")
        return ",\n".join(out)

    def part(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hashed = [" || ".join(part(lowered if low and c == "text" else c) for c in FIELDS) for low in (False, True)]
    joins, proofs, folds = [], [], []
    prior = "p.shown"
    for name, at, key, count in (("t", "p.i", "s", levels), ("g", "p.s", "one", source_levels)):
        for k in range(count):
            x = f"{name}{k}"
            joins.append(f"JOIN {name}_s{k} {x} ON {x}.{key} = {'p.s' if key == 's' else '0'} AND {x}.i = {at} // {16 ** k}")
            proofs.append(f"{x}.l || {x}.r")
            folds.append((f"{x}_f", f"CASE WHEN {x}_n > 1 THEN sha256({x}_l || {prior} || {x}_r) ELSE {prior} END", x))
            prior = f"{x}_f"
    carried = ", ".join(f"{x}.n AS {x}_n, {x}.l AS {x}_l, {x}.r AS {x}_r" for _, _, x in folds)
    folded = "f0"
    chain = []
    last = "p"
    for i, (name, how, _) in enumerate(folds):
        chain.append(f"f{i} AS (SELECT *, {how.replace('p.shown', 'shown')} AS {name} FROM {last})")
        last = f"f{i}"
    folded = last
    return f"""
WITH d AS (SELECT doc_id, source, sha256({hashed[0]}) AS h, sha256({hashed[1]}) AS low,
  list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
    lambda k: list_concat([CAST(ascii(substr(CAST(doc_id AS VARCHAR), k, 1)) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) AS crc FROM documents),
e AS (SELECT doc_id, h, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN low ELSE h END AS shown, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d),
t_0 AS (SELECT s, i, n, h FROM e),
{tree("t", "s", levels)},
g_0 AS (SELECT 0 AS one, s AS i, count(*) OVER () AS n, h FROM t_{levels}),
{tree("g", "one", source_levels)},
p AS (SELECT p.*, {" || ".join(proofs)} AS proof, {carried} FROM e p {" ".join(joins)}),
{", ".join(chain)}
SELECT f.doc_id, f.h AS leaf, sub.h AS subroot, top.h AS root, sha256(f.proof) AS proof_sha256, f.{folds[-1][0]} AS folded_root,
       f.{folds[-1][0]} = top.h AS verified
FROM {folded} f JOIN t_{levels} sub ON sub.s = f.s CROSS JOIN g_{source_levels} top"""


REPORT_SQL = _report_sql()
