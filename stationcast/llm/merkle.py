"""A Merkle manifest of a table: every row gets the witness that proves it against one root.

Rows are numbered in the order of their group, and aligned blocks of consecutive rows are appended, one
by one, to a tree each. A node that waits for its siblings is an open subtree with a partial witness,
which every later sibling extends; when the run of siblings is complete, the witness goes to all rows
below. Roots of blocks are nodes of the next round, appended in the same way, until one is left; the
roots of the groups make the last tree.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.prefix import prefix_sums
from stationcast.llm.store import null_safe_join, stored

ARITY = 8
BLOCK_LEVELS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def node_digest(children: list[bytes]) -> bytes:
    """SHA-256 of the children's digests as hexadecimal text."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def height(n: int, arity: int = ARITY) -> int:
    """Rounds until ``n`` nodes are one."""
    rounds = 0
    while n > 1:
        n = -(-n // arity)
        rounds += 1
    return rounds


class Appender:
    """A tree that grows by appended nodes, and the witnesses of all of them.

    A witness holds, level by level, the length of the run of siblings, the own place in it (a byte
    each) and the other members' digests from left to right.
    """

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.witnesses: list[bytearray] = []
        self.open: list[list[tuple]] = []      # per level (digest, first, stop, siblings so far)

    def append(self, digest: bytes) -> None:
        place = len(self.witnesses)
        self.witnesses.append(bytearray())
        self._join(0, digest, place, place + 1)

    def _join(self, level: int, digest: bytes, first: int, stop: int) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        for *_, siblings in run:
            siblings += digest
        run.append((digest, first, stop, bytearray(b"".join(node[0] for node in run))))
        if len(run) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for k, (_, first, stop, siblings) in enumerate(run):
            step = bytes([len(run), k]) + siblings
            for place in range(first, stop):
                self.witnesses[place] += step
        self._join(level + 1, node_digest([node[0] for node in run]), run[0][1], run[-1][2])

    def close(self, levels: int) -> bytes:
        """Complete what is open below ``levels``, short runs included, and return the root."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        return self.open[levels][0][0]


def steps(witness: bytes):
    """(place, siblings) of each level, from the leaf up."""
    at = 0
    while at < len(witness):
        size, place = witness[at], witness[at + 1]
        stop = at + 2 + 32 * (size - 1)
        yield place, [bytes(witness[i:i + 32]) for i in range(at + 2, stop, 32)]
        at = stop


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for place, siblings in steps(witness):
        leaf = node_digest([*siblings[:place], leaf, *siblings[place:]])
    return leaf


def proof_digest(witness: bytes) -> str:
    """SHA-256 of all siblings as hexadecimal text, from the leaf up, left to right."""
    return hashlib.sha256(b"".join(d for _, level in steps(witness) for d in level).hex().encode()
                          ).hexdigest()


def row_digest(columns: list[Column]) -> Column:
    """SHA-256 of a row's values, each ``-`` if null, else its length in bytes, ``:`` and its text."""
    texts = [column.cast("string") for column in columns]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts]), 256))


def with_witnesses(nodes: DataFrame, most: int, arity: int = ARITY,
                   block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``nodes`` with their ``witness`` and the ``root`` of their tree.

    ``nodes`` has tree, n (nodes of that tree), position (from 0, without gaps), digest and any other
    columns; ``most`` is the largest n. A task holds one block of ``arity ** block_levels`` nodes at
    a time, so a tree of any size is spread over as many groups as it has blocks. Blocks are stored;
    the next round reads only their roots.
    """
    block = arity ** block_levels
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)

    def append(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("position")
        n = group.column("n")[0].as_py()
        tree = Appender(arity)
        for digest in group.column("digest").to_pylist():
            tree.append(digest)
        root = tree.close(height(n, arity) if n <= block else block_levels)
        witnesses = pa.array([bytes(w) for w in tree.witnesses], pa.binary())
        return group.append_column("witness", witnesses).append_column(
            "root", pa.array([root] * len(group), pa.binary()))

    blocks = stored(nodes.groupBy("tree", F.expr(f"position div {block}"))
                    .applyInArrow(append, f"{schema}, witness binary, root binary"), "blocks")
    if most <= block:
        return blocks
    heads = blocks.where(F.col("position") % block == 0).select(
        "tree", F.expr(f"(n + {block - 1}) div {block}").alias("n"),
        F.expr(f"position div {block}").alias("position"), F.col("root").alias("digest"))
    upper = with_witnesses(heads, -(-most // block), arity, block_levels)
    above = upper.select("tree", F.col("position").alias("__block"), F.col("witness").alias("__above"),
                         F.col("root").alias("__root"))
    joined = null_safe_join(blocks.withColumn("__block", F.expr(f"position div {block}")), above,
                            ["tree", "__block"])
    return joined.withColumns({"witness": F.concat("witness", "__above"), "root": F.col("__root")}
                              ).drop("__block", "__above", "__root")


def manifest(leaves: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Witnesses of all rows of ``leaves`` (tree STRING, doc_id, digest BINARY, other columns).

    Per tree the rows ascend by doc_id, null ids first, rows of equal id by digest; while several nodes
    remain, every ``arity`` consecutive ones, the last of them possibly fewer, become their digest; a
    tree of one row is that row. The trees' roots, null first, then by the bytes of the name, make the
    tree of the root in the same way. Adds subroot, root and witness (see ``Appender``; from the row
    to the root), and drops what it is computed from. Repeated rows are leaves of their own; an empty
    table gives no rows. Rows equal in tree, id and digest are sorted in one task, as digests.
    """
    names = [c for c in leaves.columns if c not in ("tree", "digest")]
    order = ["tree", "doc_id", "digest"]
    numbered, _ = prefix_sums(leaves.withColumn("one", F.lit(1)), order, {"before": "one"})
    numbered = stored(numbered.drop("one"), "leaves")
    trees = stored(numbered.groupBy("tree").agg(F.count("*").alias("n"),
                                                F.min("before").alias("first")), "trees")
    sizes = trees.agg(F.max("n"), F.count("*")).first()
    placed = null_safe_join(numbered, trees, ["tree"]).withColumn(
        "position", F.col("before") - F.col("first")).drop("before", "first")
    rows = with_witnesses(placed, sizes[0] or 0, arity, block_levels)

    subroots = stored(rows.where("position = 0").select("tree", F.col("root").alias("digest")), "roots")
    numbered, _ = prefix_sums(subroots.withColumn("one", F.lit(1)), ["tree"], {"position": "one"})
    top = numbered.select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("name"),
                          F.lit(sizes[1]).cast("bigint").alias("n"), "position", "digest")
    top = stored(with_witnesses(top, sizes[1], arity, block_levels).select(
        F.col("name").alias("tree"), F.col("witness").alias("__above"), F.col("root").alias("__top")),
        "top")
    return null_safe_join(rows, top, ["tree"]).select(
        *names, F.col("digest").alias("leaf"), F.col("root").alias("subroot"),
        F.col("__top").alias("root"), F.concat("witness", "__above").alias("witness"))


def verified(rows: DataFrame, presented: str) -> DataFrame:
    """The rows' proofs checked: adds proof_sha256, and folded_root, what the digest in column
    ``presented`` and the witness lead to."""
    kept = [c for c in rows.columns if c not in (presented, "witness")]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)

    def fold(batches):
        for batch in batches:
            witnesses = batch.column("witness").to_pylist()
            roots = [folded(leaf, w) for leaf, w in zip(batch.column(presented).to_pylist(), witnesses)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept],
                 pa.array([proof_digest(w) for w in witnesses], pa.string()),
                 pa.array(roots, pa.binary())], [*kept, "proof_sha256", "folded_root"])

    return rows.mapInArrow(fold, f"{schema}, proof_sha256 string, folded_root binary")


def document_leaves(docs: DataFrame) -> DataFrame:
    """The digest of every document and, as ``presented``, that of what is checked against it: where 3
    divides the checksum of the id, A-Z of the text are lower-cased. A null id is not tampered with."""
    def leaf(text: Column) -> Column:
        return row_digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(F.col("lang").alias("tree"), "doc_id", leaf(F.col("text")).alias("digest"),
                       F.when(tampered, leaf(F.translate("text", UPPER, LOWER))).alias("presented"))


def op12_merkle_manifest(spark, docs: DataFrame) -> DataFrame:
    """The manifest of all documents, one tree a language, and a check of every proof against rows of
    which some were tampered with; order, ties and odd rows as in ``manifest``."""
    rows = manifest(document_leaves(docs)).withColumn("presented", F.coalesce("presented", "leaf"))
    checked = verified(rows, "presented")
    return checked.select(
        "doc_id", *[F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")], "proof_sha256",
        F.lower(F.hex("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"))
