"""The prefix trie of rebuilt conversations, from sorted shards and the skeleton of their splitters.

1. Each conversation becomes its path: a 16-byte digest per turn, the turns of
   the conversation it starts like in front. Texts go no further than this.
2. Splitters, taken at even ranks of a bounded sample of (path, id), cut all
   conversations into shards. The trie of the splitters' paths, the skeleton, is
   sent to every task.
3. The members of a node lie next to each other in this order. A node in two
   shards therefore is a prefix of the splitter between them: every node outside
   the skeleton lies in one shard, which finishes it in one pass with a stack.
4. A skeleton node leaves a partial row in each shard it touches; these are summed
   by node, then along the skeleton to the root. As splitters also cut by
   id, copies of one conversation are spread over as many shards as they fill.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwatch.llm.common import table, written

#: Fixed by the contract: a conversation starts like the first of its five, for its crc32 modulo this many turns.
GROUP, HEADS = 5, 9
ENTRY = 16
#: Turns that a shard is meant to hold, splitters at most, bytes of all their paths at most, turns of a splitter's path.
SHARD_TURNS, MOST_SPLITTERS, MOST_BYTES, SPLITTER_TURNS = 1024, 4095, 4 << 20, 256
#: Conversations sampled per splitter.
SAMPLED = 8
ROWS_OUT = 4096

_PATHS = pa.schema([("conv_id", pa.int64()), ("path", pa.binary()), ("sizes", pa.binary())])
_NODES = pa.schema([
    ("skeleton", pa.int32()), ("shard", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("parent_skeleton", pa.int32()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("size", pa.int64()), ("ends", pa.string())])
_NODE_COLUMNS = (
    "skeleton int, shard int, conv_id bigint, depth bigint, parent_conv_id bigint, parent_skeleton int, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, size bigint, ends string")


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One path per conversation, from turns in order, the group's first conversation before the others."""
    held = head = None

    def finished() -> tuple[int, bytes, bytes]:
        conv_id, base, shared, entries, sizes = held
        if conv_id != base:
            entries = head[1][:shared] + entries[shared:] if head and head[0] == base else entries[shared:]
            sizes = head[2][:shared] + sizes[shared:] if head and head[0] == base else sizes[shared:]
        return conv_id, b"".join(entries), b"".join(sizes)

    for batch in batches:
        out: list[tuple[int, bytes, bytes]] = []
        for conv_id, base, shared, entry, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "base", "shared", "entry", "size"))):
            if held is None or held[0] != conv_id:
                if held:
                    out.append(finished())
                    if held[0] == held[1]:
                        head = held[0], held[3][:HEADS], held[4][:HEADS]
                held = conv_id, base, shared, [], []
            held[3].append(entry)
            held[4].append(size.to_bytes(4, "little"))
        if out:
            yield table(dict(zip(_PATHS.names, zip(*out))), _PATHS)
    if held:
        yield table(dict(zip(_PATHS.names, zip(*[finished()]))), _PATHS)


def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """``conv_id, path, sizes`` of every conversation; sizes are the texts' UTF-8 bytes, four bytes a turn."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", empty("role").alias("role"), empty("text").alias("text"))
    length = F.octet_length("role").cast("string")
    entry = F.unhex(F.md5(F.concat(length, F.lit(":"), "role", "text")))
    keyed = own.select(
        "conv_id", (F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int").alias("shared"),
        "turn", "role", "text", entry.alias("entry"), F.octet_length("text").alias("size"))
    ordered = keyed.repartition("base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.select("conv_id", "base", "shared", "entry", "size").mapInArrow(
        _rebuild, "conv_id bigint, path binary, sizes binary")


@dataclass
class Skeleton:
    """The splitters in order, and the trie of their paths."""

    splitters: list[tuple[bytes, int]]
    child: dict[tuple[int, bytes], int] = field(default_factory=dict)
    parent: list[int] = field(default_factory=lambda: [-1])

    def __post_init__(self):
        for path, _ in self.splitters:
            at = 0
            for i in range(0, len(path), ENTRY):
                key = at, path[i: i + ENTRY]
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(at)
                at = self.child[key]

    def children(self) -> list[int]:
        counts = [0] * len(self.parent)
        for parent in self.parent[1:]:
            counts[parent] += 1
        return counts


def _splitters(paths: DataFrame, shard_turns: int) -> list[tuple[bytes, int]]:
    """At most MOST_SPLITTERS splitters, of MOST_BYTES in all, at even ranks of a sample several times as large."""
    cut = F.substring("path", 1, SPLITTER_TURNS * ENTRY)
    n, turns, size = paths.agg(
        F.count("*"), F.coalesce(F.sum(F.greatest(F.octet_length("path") / ENTRY, F.lit(1))), F.lit(0)),
        F.coalesce(F.sum(F.octet_length(cut)), F.lit(0))).first()
    if not n:
        return []
    wanted = min(int(turns // shard_turns), MOST_SPLITTERS, int(MOST_BYTES * n // max(size, 1)))
    if wanted < 1:
        return []
    share = min(1.0, wanted * SAMPLED / n)
    drawn = paths.filter(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 62)) <= F.lit(int(share * (1 << 62)))).select(cut, "conv_id")
    sample = sorted((bytes(path), conv_id) for path, conv_id in drawn.collect())
    picked = [sample[(i + 1) * len(sample) // (wanted + 1)] for i in range(wanted)] if sample else []
    return sorted(set(picked))


class _Node:
    __slots__ = ("entry", "size", "skeleton", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends", "digest", "held")

    def __init__(self, entry: bytes, size: int, skeleton: int):
        self.entry, self.size, self.skeleton = entry, size, skeleton
        self.conv_id, self.n_convs, self.n_children, self.n_leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.digest, self.held = [], None, []

    def end(self, conv_id: int) -> None:
        """One more conversation ends here; ids come in ascending order."""
        self.n_convs += 1
        if self.conv_id is None or conv_id < self.conv_id:
            self.conv_id = conv_id
        if self.skeleton >= 0:
            self.ends.append(str(conv_id))
        elif self.digest is None:
            self.digest = hashlib.sha256(str(conv_id).encode())
        else:
            self.digest.update(f",{conv_id}".encode())


_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _finish(skeleton: Skeleton):
    """Nodes of the shards: whole rows of those outside the skeleton, partial rows of the others."""

    def shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Node] = []
        shard, before = None, b""
        rows: list[tuple] = []

        def close() -> None:
            """Takes the innermost open node off the stack."""
            node, depth = stack.pop(), len(stack)
            parent = stack[-1] if stack else None
            if parent:
                parent.n_convs += node.n_convs
                if parent.conv_id is None or node.conv_id < parent.conv_id:
                    parent.conv_id = node.conv_id
            if node.skeleton >= 0:
                rows.append((
                    node.skeleton, shard, node.conv_id, depth, None, skeleton.parent[node.skeleton], node.n_convs,
                    node.n_children, node.n_leaves, node.saved, node.size, ",".join(node.ends)))
                return
            leaves = node.n_leaves if node.n_children else 1
            saved = node.saved + (node.n_convs - 1) * node.size
            # the children's parent is known from here on
            rows.extend(row[:4] + (node.conv_id,) + row[5:] for row in node.held)
            row = (None, shard, node.conv_id, depth, None, None, node.n_convs, node.n_children, leaves, saved, node.size,
                   node.digest.hexdigest() if node.digest else _NO_ENDS)
            parent.n_children += 1
            parent.n_leaves += leaves
            parent.saved += saved
            if parent.skeleton >= 0:
                rows.append(row[:5] + (parent.skeleton,) + row[6:])
            else:
                parent.held.append(row)

        def taken() -> pa.RecordBatch:
            done = table(dict(zip(_NODES.names, zip(*rows))), _NODES)
            rows.clear()
            return done

        for batch in batches:
            for its_shard, conv_id, path, sizes in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "sizes"))):
                if its_shard != shard:
                    while stack:
                        close()
                    shard, before = its_shard, b""
                    stack.append(_Node(b"", 0, 0))
                depth = len(path) // ENTRY
                same = 0
                while same < depth and same + 1 < len(stack) and stack[same + 1].entry == path[same * ENTRY: (same + 1) * ENTRY]:
                    same += 1
                while len(stack) > same + 1:
                    close()
                for i in range(same, depth):
                    entry = path[i * ENTRY: (i + 1) * ENTRY]
                    above = stack[-1].skeleton
                    stack.append(_Node(entry, int.from_bytes(sizes[4 * i: 4 * i + 4], "little"),
                                       skeleton.child.get((above, entry), -1) if above >= 0 else -1))
                stack[-1].end(conv_id)
                if len(rows) >= ROWS_OUT:
                    yield taken()
        while stack:
            close()
        if rows:
            yield taken()

    return shard_rows


def _deal(skeleton: Skeleton):
    """Adds each path's shard: the number of splitters at or before it."""
    schema = pa.schema([("shard", pa.int32()), *_PATHS])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shards = pa.array([bisect_right(skeleton.splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shards, *(batch.column(c) for c in _PATHS.names)], schema=schema)

    return deal


def _lift(skeleton: Skeleton):
    """What a skeleton node adds to itself and to every node above it."""
    schema = pa.schema([("skeleton", pa.int32()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])

    def lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for at, leaves, saved in zip(*(batch.column(c).to_pylist() for c in schema.names)):
                while at >= 0:
                    out.append((at, leaves, saved))
                    at = skeleton.parent[at]
                if len(out) >= ROWS_OUT:
                    yield table(dict(zip(schema.names, zip(*out))), schema)
                    out = []
            if out:
                yield table(dict(zip(schema.names, zip(*out))), schema)

    return lift


def _join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each skeleton node, from its shards' runs of ids in order; no run but one is held."""
    schema = pa.schema([("skeleton", pa.int32()), ("ends_sha256", pa.string())])
    at = digest = None
    for batch in batches:
        out: list[tuple[int, str]] = []
        for node, ends in zip(batch.column("skeleton").to_pylist(), batch.column("ends").to_pylist()):
            if node != at:
                if digest:
                    out.append((at, digest.hexdigest()))
                at, digest = node, hashlib.sha256(ends.encode())
            else:
                digest.update(f",{ends}".encode())
        if out:
            yield table(dict(zip(schema.names, zip(*out))), schema)
    if digest:
        yield table({"skeleton": [at], "ends_sha256": [digest.hexdigest()]}, schema)


def prefix_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``turns`` has ``conv_id, turn, role, text``; a null role or text is empty,
    rows without a conv_id belong to no conversation and are left out. Turns of
    equal number go by role, then text; repeated rows are turns of their own. An
    empty table has no root. Very long texts are read once for their digest; of
    a conversation, 20 bytes per turn are held at once. Other columns are left behind.
    """
    paths = written(rebuilt_paths(turns), "paths")
    skeleton = Skeleton(_splitters(paths, shard_turns))
    shards = len(skeleton.splitters) + 1
    dealt = paths.mapInArrow(_deal(skeleton), "shard int, conv_id bigint, path binary, sizes binary")
    nodes = written(
        dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(
            _finish(skeleton), _NODE_COLUMNS), "nodes")

    parts = nodes.filter("skeleton IS NOT NULL")
    in_trie = turns.sparkSession.createDataFrame(
        list(enumerate(skeleton.children())), "skeleton int, in_skeleton int")
    summed = written(
        parts.groupBy("skeleton").agg(
            F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_skeleton").alias("parent_skeleton"),
            F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("outside"), F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("saved"), F.first("size").alias("size"))
        .join(F.broadcast(in_trie), "skeleton").withColumn("n_children", F.col("outside") + F.col("in_skeleton")), "skeleton")
    subtrees = summed.select(
        "skeleton", (F.col("leaves") + (F.col("n_children") == 0).cast("bigint")).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")).mapInArrow(
        _lift(skeleton), "skeleton int, n_leaves bigint, saved_tokens bigint").groupBy("skeleton").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    ends = parts.filter("ends != ''").select("skeleton", "shard", "ends").repartition("skeleton").sortWithinPartitions(
        "skeleton", "shard").select("skeleton", "ends").mapInArrow(_join_ends, "skeleton int, ends_sha256 string")

    # The skeleton is bounded by MOST_SPLITTERS and MOST_BYTES.
    above = F.broadcast(summed.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("above")))
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    inner = summed.select("skeleton", "conv_id", "depth", "parent_skeleton", "n_convs", "n_children").join(subtrees, "skeleton").join(
        ends, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))).join(
        above, "parent_skeleton", "left").withColumn("parent_conv_id", F.col("above"))
    outer = nodes.filter("skeleton IS NULL").withColumnRenamed("ends", "ends_sha256").join(above, "parent_skeleton", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return inner.select(*columns).unionByName(outer.select(*columns))
