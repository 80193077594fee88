"""The prefix tree of rebuilt conversations, by Patricia construction over sorted sequences.

A turn is known by 128 bits of the SHA-256 of its role and text; a conversation is the sequence of
its turns' digests, put end to end, so that sorting the bytes brings shared prefixes together. The
sequences are range-sorted. Each range goes through its rows once with a stack and creates only the points
of its compressed tree: branches, ends and leaves. Members, leaves and saved tokens are summed as points close; the
unary nodes between two points are one edge with the suffix sums of its words, from which they are expanded at the end.

What other ranges can share are prefixes of a range's first or last sequence. A range gives these as *seams*, with what
hangs below them there; the seams of all ranges (a few for each) are merged, and their
totals are exact for the whole table. A hot prefix, or one sequence that a third of all conversations have, is
thereby spread over as many ranges as its rows fill.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.scratch import stage
from tilewright.llm.workers import releasing

SIZE = 16  # bytes of a digest
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()
#: A row of the compressed tree. ``kind``: point, seam or ends (a piece of a seam's members' ids). Of points: ``edge_sums`` are the words
#: from each unary node above to the last one, topmost first; ``parent`` is a seam's key or null, then ``parent_conv_id`` tells.
POINTS = "kind string, range_no int, node binary, parent binary, parent_conv_id long, conv_id long, depth int, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string, edge_sums array<long>, piece long, ends binary"
_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
_COLUMNS = [(name, _TYPES[kind]) for name, kind in (c.split() for c in POINTS.split(", "))]
PIECE_BYTES = 1 << 20


def digest(role: Column, text: Column) -> Column:
    """Digits of a turn's digest; the role's length keeps it apart from the text."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * SIZE)


def rebuilt_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", family: int = 20, most_shared: int = 4) -> DataFrame:
    """``conv_id, path, words``: each conversation c with its first h turns replaced by those of conversation c - c % family; h is crc32(c) % most_shared."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    rows = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), digest(role, text).alias("d"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("w"))
    rows = rows.where(F.col("conv_id").isNotNull()).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    # Dealt by family: the grouping and the window below need no further shuffle.
    own = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "d", "w"))).alias("turns"))
    first = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, most_shared - 1)), ignorenulls=True).over(Window.partitionBy("base"))
    h = F.crc32(F.col("conv_id").cast("string")) % most_shared
    shared = F.coalesce(F.slice(first, F.lit(1), h.cast("int")), F.slice("turns", 1, 0))
    whole = F.concat(shared, F.slice("turns", (h + 1).cast("int"), F.greatest(F.size("turns"), F.lit(1))))
    found = own.withColumn("whole", whole)
    return found.select("conv_id", F.unhex(F.array_join(F.transform("whole", lambda t: t["d"]), "")).alias("path"), F.transform("whole", lambda t: t["w"]).alias("words"))


class _Point:
    """An open node of the compressed tree: what is below it so far."""

    __slots__ = ("depth", "ends", "least", "n", "children", "leaves", "saved", "text", "first", "waiting")

    def __init__(self, depth: int, first: bool = False):
        self.depth, self.first = depth, first  # first: on the path of the range's first sequence
        self.ends = self.n = self.children = self.leaves = self.saved = 0
        self.least, self.text, self.waiting = None, bytearray(), []


class RangeTree:
    """The compressed tree of one range of sorted sequences: hand in rows in order, then ``finish``; both give rows of :data:`POINTS`."""

    def __init__(self, range_no: int):
        self.range_no, self.path, self.words, self.stack, self.first_nodes = range_no, None, None, [], []

    def add(self, conv_id: int, path: bytes, words: list[int]) -> Iterator[dict]:
        length = len(path) // SIZE
        if self.path is None:
            self.stack, self.first_nodes = [_Point(d, True) for d in range(length + 1)], node_keys(path)
        elif path != self.path:
            shared = common_depth(self.path, path)
            yield from self._close_below(shared)
            if length > self.stack[-1].depth:
                self.stack.append(_Point(length))
        self.path, self.words = path, words
        top = self.stack[-1]
        top.n, top.least = top.n + 1, conv_id if top.least is None else min(top.least, conv_id)
        top.text += (b",%d" if top.ends else b"%d") % conv_id
        top.ends += 1
        if top.first and len(top.text) > PIECE_BYTES:
            yield self._piece(top, self.first_nodes)

    def _piece(self, point: _Point, nodes: list[bytes]) -> dict:
        data, point.text = bytes(point.text), bytearray()
        return {"kind": "ends", "node": nodes[point.depth], "piece": point.ends, "ends": data}

    def _close_below(self, depth: int) -> Iterator[dict]:
        while self.stack[-1].depth > depth:
            point = self.stack.pop()
            if self.stack[-1].depth < depth:
                self.stack.append(_Point(depth))
            yield from self._close(point, self.stack[-1])

    def _close(self, point: _Point, parent: _Point) -> Iterator[dict]:
        parent.n, parent.least = parent.n + point.n, point.least if parent.least is None else min(parent.least, point.least)
        if point.first:
            yield from self._seam(point, self.first_nodes)
            return
        edge, more = self.words[parent.depth : point.depth - 1], point.n - 1
        sums = np.cumsum(edge[::-1])[::-1].tolist()
        leaves, saved = point.leaves + (point.children == 0), point.saved + more * self.words[point.depth - 1]
        ends = hashlib.sha256(point.text).hexdigest()
        for row in point.waiting:
            yield row | {"parent_conv_id": point.least}
        parent.waiting.append({"kind": "point", "conv_id": point.least, "depth": point.depth, "n_convs": point.n, "n_children": point.children, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": ends, "edge_sums": sums})
        parent.children, parent.leaves, parent.saved = parent.children + 1, parent.leaves + leaves, parent.saved + saved + more * (sums[0] if sums else 0)
        if parent.first:  # its own totals are known only once all ranges are
            yield from self._hang(parent, self.first_nodes)

    def _hang(self, point: _Point, nodes: list[bytes]) -> Iterator[dict]:
        rows, point.waiting = point.waiting, []
        for row in rows:
            yield row | {"parent": nodes[point.depth]}

    def _seam(self, point: _Point, nodes: list[bytes]) -> Iterator[dict]:
        yield from self._hang(point, nodes)
        if point.text:
            yield self._piece(point, nodes)
        words = self.words[point.depth - 1] if point.depth else 0
        yield {"kind": "seam", "node": nodes[point.depth], "parent": nodes[point.depth - 1] if point.depth else None, "conv_id": point.least, "depth": point.depth, "n_convs": point.n, "n_children": point.children, "n_leaves": point.leaves, "saved_tokens": point.saved, "words": words}

    def finish(self) -> Iterator[dict]:
        """The path of the last sequence: all its nodes are seams."""
        if self.path is None:
            return
        nodes, opened = node_keys(self.path), {p.depth: p for p in self.stack}
        below = None
        for depth in range(len(self.path) // SIZE, -1, -1):
            point = opened.get(depth) or _Point(depth)
            if below:
                point.n, point.least = point.n + below.n, below.least if point.least is None else min(point.least, below.least)
            yield from self._seam(point, nodes)
            below = point


def node_keys(path: bytes) -> list[bytes]:
    """A key for each prefix, the empty one first: 128 bits of its SHA-256."""
    whole, out = hashlib.sha256(), []
    for at in range(0, len(path) + 1, SIZE):
        out.append(whole.copy().digest()[:SIZE])
        whole.update(path[at : at + SIZE])
    return out


def common_depth(a: bytes, b: bytes) -> int:
    """How many digests two sequences share at their start."""
    low, high = 0, min(len(a), len(b)) // SIZE
    step = 1
    while low + step <= high and a[low * SIZE : (low + step) * SIZE] == b[low * SIZE : (low + step) * SIZE]:
        low, step = low + step, 2 * step
    while step:  # the first step that failed is halved until none is left
        if low + step <= high and a[low * SIZE : (low + step) * SIZE] == b[low * SIZE : (low + step) * SIZE]:
            low += step
        step //= 2
    return low


def _batch(rows: list[dict], range_no: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([range_no] * len(rows) if name == "range_no" else [r.get(name) for r in rows], kind) for name, kind in _COLUMNS], [name for name, _ in _COLUMNS])


def compressed_tree(paths: DataFrame) -> DataFrame:
    """The compressed trees of all ranges of ``paths`` (:func:`rebuilt_conversations`), written: rows of :data:`POINTS`."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no, rows = TaskContext.get().partitionId(), []
        tree = RangeTree(range_no)
        for batch in batches:
            for conv_id, path, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "words"))):
                rows += tree.add(conv_id, path, words)
                if len(rows) >= 2048:
                    yield _batch(rows, range_no)
                    rows = []
        rows += tree.finish()
        for at in range(0, len(rows), 2048):
            yield _batch(rows[at : at + 2048], range_no)

    sorted_ = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    return stage(sorted_.select("conv_id", "path", "words").mapInArrow(releasing(build), POINTS), "prefix-points")


def merge_seams(rows: list[dict]) -> list[dict]:
    """Seams of all ranges, each node once, with the totals of the whole table. ``rows`` are in order of ranges; within one, of any order."""
    nodes: dict[bytes, dict] = {}
    for r in rows:
        own = nodes.setdefault(r["node"], {k: r[k] for k in ("node", "parent", "depth", "words")} | {"conv_id": r["conv_id"], "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0})
        own["conv_id"] = min(own["conv_id"], r["conv_id"])
        for k in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            own[k] += r[k]
    out = sorted(nodes.values(), key=lambda r: -r["depth"])
    for r in out:  # a node's parent is a seam, one less deep
        if r["parent"] is not None:
            nodes[r["parent"]]["n_children"] += 1
    for r in out:
        r["n_leaves"] += r["n_children"] == 0
        r["saved_tokens"] += (r["n_convs"] - 1) * r["words"]
        if r["parent"] is not None:
            up = nodes[r["parent"]]
            up["n_leaves"], up["saved_tokens"] = up["n_leaves"] + r["n_leaves"], up["saved_tokens"] + r["saved_tokens"]
    for r in out:
        r["parent_conv_id"] = nodes[r["parent"]]["conv_id"] if r["parent"] is not None else None
    return out


def hash_ends(pieces: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of members' ids that came in pieces, one range after the other; streamed, however many they are."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = whole = None
        last = None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([whole.hexdigest()], pa.string())], ["node", "ends_sha256"])

        for batch in batches:
            for own, range_no, data in zip(*(batch.column(c).to_pylist() for c in ("node", "range_no", "ends"))):
                if own != node:
                    if node is not None:
                        yield row()
                    node, whole, last = own, hashlib.sha256(), None
                if last is not None and last != range_no:
                    whole.update(b",")
                whole.update(data)
                last = range_no
        if node is not None:
            yield row()

    dealt = pieces.select("node", "range_no", "piece", "ends").repartition("node").sortWithinPartitions("node", "range_no", "piece")
    return dealt.select("node", "range_no", "ends").mapInArrow(releasing(digests), "node binary, ends_sha256 string")


NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_nodes(paths: DataFrame) -> DataFrame:
    """Every node of the prefix tree of ``paths``: unary nodes are expanded from the edges of the compressed tree."""
    spark, tree = paths.sparkSession, compressed_tree(paths)
    shape = "node binary, parent binary, depth int, words long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, parent_conv_id long"
    names = [c.split()[0] for c in shape.split(", ")]
    found = [r.asDict() for r in tree.where("kind = 'seam'").select("range_no", *names[:-1]).collect()]  # two paths a range
    merged = spark.createDataFrame([tuple(r[n] for n in names) for r in merge_seams(found)], shape)
    ends = stage(hash_ends(tree.where("kind = 'ends'")), "prefix-ends")
    seams = merged.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    known = F.broadcast(merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("seam_conv_id")))  # held by the driver already
    points = tree.where("kind = 'point'").join(known, "parent", "left").withColumn("parent_conv_id", F.coalesce("seam_conv_id", "parent_conv_id"))
    on_edge, n = F.col("place") < F.size("edge_sums"), F.size("edge_sums")
    each = points.withColumn("place", F.explode(F.sequence(F.lit(0), n)))
    unary = each.select(
        "conv_id",
        (F.col("depth") - n + F.col("place")).cast("long").alias("depth"),
        F.when(F.col("place") == 0, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(on_edge, F.lit(1).cast("long")).otherwise(F.col("n_children")).alias("n_children"),
        "n_leaves",
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.coalesce(F.get("edge_sums", F.col("place")), F.lit(0))).alias("saved_tokens"),
        F.when(on_edge, F.lit(NOTHING)).otherwise(F.col("ends_sha256")).alias("ends_sha256"),
    )
    return unary.union(seams.withColumn("depth", F.col("depth").cast("long")).select(*NODES))


def conversation_tree(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Nodes of the prefix tree of the rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are in order of ``turn``, null first; equal ones in order of their digest, and a repeated row is a turn of its own. Null roles and texts are empty. Rows with
    a null conversation id belong to none and are left out. A conversation of whose turns none are left, as it has few and its base is absent, is a member of the root
    alone. Other columns are not read. An empty table gives no nodes. A conversation's digests (16 bytes a turn) must fit a task, not its texts.
    """
    return prefix_nodes(rebuilt_conversations(turns, id_col, turn_col, role_col, text_col))
