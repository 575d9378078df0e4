"""Merkle manifest of a table, with a witness for every row.

Rows are leaves.  Within a group they ascend by the order columns; every ARITY
consecutive nodes have the hash of their joined digests as parent (the last run may have
fewer nodes, even one), until one node is left, the group's subroot.  The subroots in
the order of the groups give the root in the same way.

Witnesses are built while nodes are appended (``Subtrees``): a node joins the open run of
its level; when its last sibling arrives the run is closed, extends the partial witness of
every leaf below it, and its hash is appended one level higher.  The work is spread by
cutting a group into aligned blocks of ARITY ** LEVELS nodes.  A block is one row with
all its nodes, which are the partial witnesses of its leaves up to the root of the block; the
block roots are then the nodes that are appended in the next round, and so on until
each group has one.  On the way down every block receives the rest of the witness that all
its leaves share.  No task holds more than a block, whatever the size of a group.

Defined results: a null field is ``-``, any other its UTF-8 length, ``:`` and the value as
text; null groups and order values come first; rows equal in the order columns follow
each other by their leaves; repeated rows are leaves of their own; an empty table has
no row and no root; columns that are no field are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subrev.llm.common import Scratch, by_batch
from subrev.llm.prefix import _join, bucket_starts

ARITY = 8
#: Levels of one block: it holds ARITY ** LEVELS nodes.
LEVELS = 4
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Position in a run, and the digests of the run, as hex text.
Step = tuple[int, list[bytes]]


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def node_hash(run: list[bytes]) -> bytes:
    return sha256(b"".join(run)).hexdigest().encode()


def fold(leaf: bytes, witness: list[Step]) -> bytes:
    """The root that a leaf and the siblings on its way give."""
    for at, run in witness:
        leaf = node_hash([*run[:at], leaf, *run[at + 1:]])
    return leaf


class Subtrees:
    """The nodes of one block, appended one after the other, and the witnesses they give."""

    def __init__(self, arity: int = ARITY) -> None:
        self.arity = arity
        self.closed: list[list[bytes]] = [[]]  # nodes of closed runs, level by level
        self.open: list[list[bytes]] = [[]]

    def append(self, node: bytes, level: int = 0) -> None:
        if level == len(self.open):
            self.open.append([])
            self.closed.append([])
        self.open[level].append(node)
        if len(self.open[level]) == self.arity:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        self.closed[level] += run
        self.append(node_hash(run), level + 1)

    def finish(self, levels: int | None = None) -> bytes:
        """Close what is open up to one node, or up to a given number of levels, and return that node."""
        level = 0
        while level < levels if levels is not None else len(self.closed[level]) + len(self.open[level]) > 1:
            if self.open[level]:
                self._close(level)
            level += 1
        return self.open[level][0]

    def witness(self, leaf: int) -> list[Step]:
        """Siblings of a leaf on the way up, as far as runs are closed; it grows with later appends."""
        out = []
        for nodes in self.closed:
            start = leaf - leaf % self.arity
            if start >= len(nodes):
                break
            out.append((leaf % self.arity, nodes[start: start + self.arity]))
            leaf //= self.arity
        return out


def _pack(path: list[Step]) -> bytes:
    return b"".join(bytes([at, len(run)]) + bytes.fromhex(b"".join(run).decode()) for at, run in path)


def _unpack(data: bytes) -> list[Step]:
    out, i = [], 0
    while i < len(data):
        at, n = data[i], data[i + 1]
        out.append((at, [data[j: j + 32].hex().encode() for j in range(i + 2, i + 2 + 32 * n, 32)]))
        i += 2 + 32 * n
    return out


def numbered(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` (with column ``grp``), written, with ``idx`` from 0 on in each group by ``order``, and the group's ``size``.

    Rows are cut by ranges, so a group may hold any share of them and an order value too.
    """
    keys = ["grp", *order, "_tie"]
    cut = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    cut = scratch.keep(name, cut.drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    cut = cut.withColumn("_part", F.shiftright("_at", 33))
    runs = cut.groupBy("grp", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    starts = bucket_starts(runs, ["grp"], "_part", "_n", "_before")
    starts = _join(starts, runs.groupBy("grp").agg(F.sum("_n").alias("size")), ["grp"], take="size")
    starts = starts.select("grp", "_part", F.struct((F.col("_before") - F.col("_first")).alias("shift"), "size").alias("_start"))
    placed = _join(cut, starts, ["grp", "_part"], take="_start")
    return placed.select(*[c for c in rows.columns], (F.col("_at") + F.col("_start.shift")).alias("idx"), F.col("_start.size").alias("size"))


def _round(nodes: DataFrame) -> DataFrame:
    """Blocks (grp, block, size, root, levels, payload) of nodes (grp, idx, size, node, payload); ``size`` counts the group's blocks."""
    whole = ARITY ** LEVELS
    blocks = nodes.groupBy("grp", F.floor(F.col("idx") / whole).alias("block")).agg(
        F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("idx", "node", "payload"))).alias("rows"))

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.column("rows")
        roots, levels = [], []
        for one, size in zip(rows, batch.column("size").to_pylist()):
            tree = Subtrees()
            for node in one.values.field("node").to_pylist():
                tree.append(node.hex().encode())
            roots.append(bytes.fromhex(tree.finish(None if size <= whole else LEVELS).decode()))
            levels.append([bytes.fromhex(b"".join(x).decode()) for x in tree.closed if x])
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("grp", "block", "size", "rows")), pa.array(roots, pa.binary()),
                                           pa.array(levels, pa.list_(pa.binary()))], names=["grp", "block", "size", "rows", "root", "levels"])

    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    built = blocks.mapInArrow(by_batch(build), f"grp {kinds['grp']}, block bigint, size bigint, rows {kinds['rows']}, root binary, levels array<binary>")
    return built.select("grp", "block", F.ceil(F.col("size") / whole).alias("size"), "root", "levels", F.col("rows.payload").alias("payload"))


def build(nodes: DataFrame, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks above ``nodes`` (grp, idx, size, node, payload), and (grp, root) of every group."""
    rounds, tops = [], []
    while True:
        blocks = scratch.keep(f"{name}{len(rounds)}", _round(nodes))
        rounds.append(blocks)
        tops.append(blocks.where("size = 1").select("grp", "root"))
        if not (blocks.agg(F.max("size")).first()[0] or 1) > 1:
            break
        nodes = blocks.where("size > 1").select("grp", F.col("block").alias("idx"), "size", F.col("root").alias("node"), F.lit(0).alias("payload"))
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    return rounds, roots


def _steps(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]], list[Step]]]:
    """Row, nodes by level, and the witness from the root of the block on."""
    for i, (levels, path) in enumerate(zip(batch.column("levels").to_pylist(), batch.column("path").to_pylist())):
        yield i, [[x[j: j + 32].hex().encode() for j in range(0, len(x), 32)] for x in levels], _unpack(path)


def _paths(nodes: list[list[bytes]], n: int, rest: list[Step]) -> Iterator[list[Step]]:
    """The whole witness of each of the ``n`` leaves of a block."""
    tails = [rest]
    for level in range(len(nodes) - 1, 0, -1):
        tails = [[(i % ARITY, nodes[level][i - i % ARITY: i - i % ARITY + ARITY]), *tails[i // ARITY]] for i in range(len(nodes[level]))]
    if not nodes:
        yield from tails * n
        return
    for i in range(n):
        start = i - i % ARITY
        yield [(i - start, nodes[0][start: start + ARITY]), *tails[i // ARITY]]


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The first round's blocks with the witness ``path`` from the block's root on.

    ``tops`` are (grp, top): a struct that holds the path from each group's own root on, and goes to all its blocks.
    """
    def children(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, idx, paths = [], [], []
        for i, nodes, rest in _steps(batch):
            n = len(nodes[0]) if nodes else 1
            first = batch.column("block")[i].as_py() * ARITY ** LEVELS
            found = [_pack(p) for p in _paths(nodes, n, rest)]
            row += [i] * n
            idx += range(first, first + n)
            paths += found
        take = pa.array(row, pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("grp").take(take), pa.array(idx, pa.int64()), batch.column("top").take(take), pa.array(paths, pa.binary())],
                                          names=["grp", "block", "top", "path"])

    kinds = {f.name: f.dataType.simpleString() for f in tops.schema}
    below: DataFrame | None = None
    for k in range(len(rounds) - 1, -1, -1):
        blocks = rounds[k]
        done = _join(blocks.where("size = 1"), tops, ["grp"], take="top").withColumn("path", F.col("top.path"))
        if below is not None:
            given = below.select("grp", "block", F.struct("top", "path").alias("given"))
            more = _join(blocks.where("size > 1"), given, ["grp", "block"], take="given")
            done = done.unionByName(more.withColumn("top", F.col("given.top")).withColumn("path", F.col("given.path")).drop("given"))
        if k:
            below = done.select("grp", "block", "levels", "top", "path").mapInArrow(by_batch(children), f"grp {kinds['grp']}, block bigint, top {kinds['top']}, path binary")
        else:
            return done
    raise ValueError("no rounds")


def manifest(rows: DataFrame, group: Column, order: Column, leaf: Column, payload: Column, scratch: Scratch) -> DataFrame:
    """Blocks with their nodes (``levels``), the ``payload`` of their leaves, the witness ``path`` from the block on, and ``top`` (subroot, root)."""
    # Written first: the cut by ranges reads its input twice, and the texts are to be hashed once.
    leaves = scratch.keep("hashed", rows.select(group.alias("grp"), order.alias("_by"), leaf.alias("node"), payload.alias("payload")))
    rounds, subroots = build(numbered(leaves, ["_by", "node"], scratch, "leaves").select("grp", "idx", "size", "node", "payload"), scratch, "blocks")
    groups = numbered(subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("_by"), F.col("root").alias("node")), ["_by"], scratch, "subroots")
    over = groups.select("grp", "idx", "size", "node", F.struct(F.col("_by").alias("grp"), F.col("node").alias("subroot")).alias("payload"))
    above, root = build(over, scratch, "top")
    start = root.select("grp", F.struct(F.lit(b"").alias("path"), "root").alias("top"))

    def tops(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, grp, subroot, paths = [], [], [], []
        for i, nodes, rest in _steps(batch):
            held = batch.column("payload")[i].values
            row += [i] * len(held)
            grp.append(held.field("grp"))
            subroot.append(held.field("subroot"))
            paths += [_pack(p) for p in _paths(nodes, len(held), rest)]
        whole = batch.column("top").field("root").take(pa.array(row, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.concat_arrays(grp), pa.concat_arrays(subroot), whole, pa.array(paths, pa.binary())],
                                          names=["grp", "subroot", "root", "path"])

    kind = leaves.schema["grp"].dataType.simpleString()
    found = descend(above, start).select("levels", "payload", "top", "path").mapInArrow(by_batch(tops), f"grp {kind}, subroot binary, root binary, path binary")
    found = scratch.keep("tops", found)
    return descend(rounds, found.select("grp", F.struct("path", "subroot", "root").alias("top")))


def each_leaf(blocks: DataFrame, work: Callable[[pa.StructArray, bytes, bytes, list[list[Step]], list[bytes]], list[pa.Array]], schema: str) -> DataFrame:
    """A row per leaf, made by ``work`` from the payload of a block, subroot, root, witnesses and leaves."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, nodes, rest in _steps(batch):
                payload, top = batch.column("payload")[i].values, batch.column("top")[i].as_py()
                paths = list(_paths(nodes, len(payload), rest))
                leaves = nodes[0] if nodes else [batch.column("root")[i].as_py().hex().encode()]
                yield pa.RecordBatch.from_arrays(work(payload, top["subroot"], top["root"], paths, leaves), names=names)

    return blocks.select("root", "levels", "payload", "top", "path").mapInArrow(run, schema)


def document_blocks(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The manifest of ``documents``: leaves per language by doc_id, with the leaf of the tampered row where one is."""
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    columns = [F.col(c) for c in FIELDS]
    other = leaf_hash([*columns[:-1], F.translate("text", _UPPER, _UPPER.lower())])
    payload = F.struct("doc_id", F.when(changed, other).alias("tampered"))
    return manifest(docs, F.col("lang"), F.col("doc_id"), leaf_hash(columns), payload, scratch)


def witnesses(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, positions, siblings): what proves each row, level by level; digests as binary."""
    def work(payload: pa.StructArray, subroot: bytes, root: bytes, paths: list[list[Step]], leaves: list[bytes]) -> list[pa.Array]:
        n = len(payload)
        siblings = [[[bytes.fromhex(x.decode()) for j, x in enumerate(run) if j != at] for at, run in p] for p in paths]
        return [payload.field("doc_id").cast(pa.int64()), pa.array([bytes.fromhex(x.decode()) for x in leaves], pa.binary()), pa.array([subroot] * n, pa.binary()),
                pa.array([root] * n, pa.binary()), pa.array([[at for at, _ in p] for p in paths], pa.list_(pa.int32())),
                pa.array(siblings, pa.list_(pa.list_(pa.binary())))]

    scratch = Scratch(docs.sparkSession, "merkle")
    return each_leaf(document_blocks(docs, scratch), work,
                     "doc_id bigint, leaf binary, subroot binary, root binary, positions array<int>, siblings array<array<binary>>")


def tamper_check(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): which rows still agree with the manifest."""
    def work(payload: pa.StructArray, subroot: bytes, root: bytes, paths: list[list[Step]], leaves: list[bytes]) -> list[pa.Array]:
        n, proofs, folded = len(payload), [], []
        for path, leaf, other in zip(paths, leaves, payload.field("tampered").to_pylist()):
            proofs.append(sha256(b"".join([x for at, run in path for x in run[:at] + run[at + 1:]])).hexdigest())
            folded.append(fold(leaf if other is None else other.hex().encode(), path).decode())
        whole = root.hex()
        return [payload.field("doc_id").cast(pa.int64()), pa.array([x.decode() for x in leaves], pa.string()), pa.array([subroot.hex()] * n, pa.string()),
                pa.array([whole] * n, pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array([f == whole for f in folded])]

    scratch = Scratch(docs.sparkSession, "merkle")
    return each_leaf(document_blocks(docs, scratch), work,
                     "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
