"""The trie of what conversations begin with, from ternary search trees over shards of sorted turn sequences.

A turn is coded in 20 bytes, the MD5 of role and text and the text's length, and a conversation is the bytes of its turns in
order. A node is a distinct sequence of first turns; the root is the one of none. A conversation belongs to all nodes
it begins with and ends in one.

Method. Sequences are dealt out by ranges of (sequence, conv_id) and sorted, so that a first turn or a whole
conversation that very many share is spread over tasks. A task cuts its range into shards of about `SHARD` turns, numbers a
shard's turns by a dictionary and inserts the distinct sequences, the median first, then the medians of the halves, into a
ternary search tree, which so is balanced. An iterative traversal adds up members, leaves and savings from the leaves up.
Only prefixes of a shard's first or last sequence can occur in other shards as well. Those boundary nodes keep
what is known of them open: members add up, whereas children, leaves and savings are added when a child is closed. Neighbouring
runs are merged, in a task and then `FAN` partitions at a time, in as many rounds as it takes; a merge closes what is
a prefix neither of its run's first sequence nor of its last. Every round is a written table.

Ends of a node that lie in several partitions stay pieces in order, which are hashed one after the other. Children of
boundary nodes get their parent's conv_id by a join with salted keys, since most nodes may be children of one.

Memory: a shard, and the ends of one partition's open nodes. A sequence takes 20 bytes a turn and is one value, so a
conversation can have about 100 million turns.

Defined cases: a null role or text is empty; a null turn comes first, rows of one turn stand by the MD5 of role and text, repeated
rows are turns of their own; rows without conv_id belong to no conversation; an empty table gives no node, not even a root;
columns other than the four are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.storage import keep

CODE = 20
#: Turns of a shard, unless a single sequence has more.
SHARD = 200_000
#: Partitions whose boundary nodes are merged at once.
FAN = 16
#: Ways a boundary node's children are dealt when they look for its conv_id.
SALT = 32

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
#: Rows between the steps: nodes whose parent is known, nodes still looking for theirs, open nodes, and ends of open nodes.
KNOWN, LOOKING, OPEN, ENDS = range(4)
_SCHEMA = (
    "kind int, piece int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, bytes long, ends string, has_ends boolean, is_first boolean, is_last boolean"
)
_NAMES = [part.split()[0] for part in _SCHEMA.split(", ")]
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
_ARROW = pa.schema([(part.split()[0], _KINDS[part.split()[1]]) for part in _SCHEMA.split(", ")])


# ---- sequences of turns


def sequences(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, codes: every conversation's turns in order, each as 40 hexadecimal digits."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said).cast("binary"))
    length = F.lpad(F.lower(F.hex(F.octet_length(said).cast("long"))), 8, "0")
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.concat(digest, length).alias("code")
    )
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull(), "turn", "code"))).alias("rows"))
    return listed.select("conv_id", F.col("rows.code").alias("codes"))


def as_bytes(codes: Column) -> Column:
    return F.unhex(F.array_join(codes, ""))


def rebuild(listed: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """conv_id, seq: conversations that share beginnings, for trials.

    Conversation c takes the first h turns of conversation c - c % `group` and its own from the h-th on, where h is the
    CRC-32 of its number modulo `most`.
    """
    own = listed.select(
        "conv_id",
        "codes",
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int").alias("h"),
    )
    base = listed.select(F.col("conv_id").alias("base"), F.col("codes").alias("first"))
    none = F.array().cast("array<string>")
    begin = F.slice(F.coalesce("first", none), F.lit(1), F.col("h"))
    rest = F.slice("codes", F.col("h") + 1, F.greatest(F.size("codes") - F.col("h"), F.lit(0)))
    return own.join(base, "base", "left").select("conv_id", as_bytes(F.concat(begin, rest)).alias("seq"))


# ---- one shard


def _keys(seq: bytes) -> list[bytes]:
    """The key of every prefix of a sequence, the root's first."""
    own, out = hashlib.md5(), [hashlib.md5().digest()]
    for i in range(0, len(seq), CODE):
        own.update(seq[i : i + CODE])
        out.append(own.copy().digest())
    return out


def _sha256(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else EMPTY_SHA256


class TernaryTree:
    """A ternary search tree over numbered turns. Node 0 is the root; a node's `up` is the prefix one turn shorter."""

    def __init__(self):
        self.turn, self.low, self.equal, self.high, self.up, self.depth = [-1], [-1], [-1], [-1], [-1], [0]

    def _new(self, turn: int, up: int) -> int:
        for values, value in ((self.turn, turn), (self.low, -1), (self.equal, -1), (self.high, -1), (self.up, up), (self.depth, self.depth[up] + 1)):
            values.append(value)
        return len(self.turn) - 1

    def insert(self, turns: list[int]) -> list[int]:
        """The nodes of a sequence's prefixes, the root first."""
        turn, low, equal, high = self.turn, self.low, self.equal, self.high
        node, path = 0, [0]
        for t in turns:
            at, links, above = equal[node], equal, node
            while at >= 0 and turn[at] != t:
                links, above = (low, at) if t < turn[at] else (high, at)
                at = links[at]
            if at < 0:
                at = links[above] = self._new(t, node)
            path.append(at)
            node = at
        return path

    def insert_medians(self, many: list[list[int]]) -> list[list[int]]:
        """Sorted sequences inserted so that the tree is balanced; the nodes of each one's prefixes."""
        paths: list[list[int]] = [[]] * len(many)
        spans = [(0, len(many))]
        while spans:
            a, b = spans.pop()
            if a < b:
                middle = (a + b) // 2
                paths[middle] = self.insert(many[middle])
                spans += [(a, middle), (middle + 1, b)]
        return paths

    def preorder(self) -> list[int]:
        """All nodes, prefixes before what they begin."""
        out, stack = [], [0]
        while stack:
            node = stack.pop()
            out.append(node)
            stack.extend(x for x in (self.high[node], self.low[node], self.equal[node]) if x >= 0)
        return out


class _Open:
    """What is known of a node that may go on in another run."""

    __slots__ = ("parent_key", "depth", "bytes", "n_convs", "conv_id", "children", "leaves", "saved", "ids", "has_ends")

    def __init__(self, parent_key, depth, bytes_, n_convs, conv_id, children, leaves, saved, ids, has_ends):
        self.parent_key, self.depth, self.bytes, self.n_convs, self.conv_id = parent_key, depth, bytes_, n_convs, conv_id
        self.children, self.leaves, self.saved, self.ids, self.has_ends = children, leaves, saved, ids, has_ends

    def add(self, other: _Open) -> None:
        self.n_convs += other.n_convs
        self.conv_id = min(self.conv_id, other.conv_id)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ids = self.ids + other.ids
        self.has_ends |= other.has_ends


class _Run:
    """Neighbouring sequences: their open nodes by key, the keys of the first sequence and of the last."""

    def __init__(self, nodes: dict[bytes, _Open], first: bytes, last: bytes):
        self.nodes, self.first, self.last = nodes, first, last

    def _path(self, key: bytes | None) -> set[bytes]:
        out = set()
        while key is not None:
            out.add(key)
            key = self.nodes[key].parent_key
        return out

    def joined(self, after: _Run) -> _Run:
        nodes = self.nodes
        for key, node in after.nodes.items():
            if key in nodes:
                nodes[key].add(node)
            else:
                nodes[key] = node
        return _Run(nodes, self.first, after.last)

    def closed(self, all_: bool = False) -> list[dict]:
        """Takes out the nodes that nothing outside the run can share (or all), as rows."""
        stay = set() if all_ else self._path(self.first) | self._path(self.last)
        rows = []
        for key in sorted(self.nodes.keys() - stay, key=lambda k: -self.nodes[k].depth):
            node = self.nodes.pop(key)
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n_convs - 1) * node.bytes
            above = self.nodes.get(node.parent_key)
            if above is not None:
                above.children += 1
                above.leaves += leaves
                above.saved += saved
            sha = None if node.has_ends and not node.ids else _sha256(node.ids)
            rows.append(
                dict.fromkeys(_NAMES)
                | {"kind": LOOKING, "key": key, "parent_key": node.parent_key, "depth": node.depth, "conv_id": node.conv_id, "n_convs": node.n_convs}
                | {"n_children": node.children, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": sha}
            )
        return rows

    def rows(self, piece: int) -> list[dict]:
        """The open nodes as rows; their ends apart."""
        out = []
        for key, node in self.nodes.items():
            base = dict.fromkeys(_NAMES) | {"piece": piece, "key": key}
            out.append(
                base
                | {"kind": OPEN, "parent_key": node.parent_key, "depth": node.depth, "bytes": node.bytes, "conv_id": node.conv_id}
                | {"n_convs": node.n_convs, "n_children": node.children, "n_leaves": node.leaves, "saved_tokens": node.saved}
                | {"has_ends": node.has_ends, "is_first": key == self.first, "is_last": key == self.last}
            )
            if node.ids:
                out.append(base | {"kind": ENDS, "ends": ",".join(map(str, node.ids))})
        return out


def shard(found: list[tuple[bytes, int]]) -> tuple[pa.RecordBatch, _Run]:
    """Of sorted (sequence, conv_id): the rows of nodes that lie wholly inside, and the run of those at the edges."""
    distinct: list[bytes] = []
    ids: list[list[int]] = []
    for seq, conv_id in found:
        if not distinct or distinct[-1] != seq:
            distinct.append(seq)
            ids.append([])
        ids[-1].append(conv_id)
    coded = [[seq[i : i + CODE] for i in range(0, len(seq), CODE)] for seq in distinct]
    codes = sorted({code for seq in coded for code in seq})
    number = {code: i for i, code in enumerate(codes)}
    size = [int.from_bytes(code[16:], "big") for code in codes]
    tree = TernaryTree()
    paths = tree.insert_medians([[number[code] for code in seq] for seq in coded])

    n = len(tree.turn)
    up, ends = tree.up, {path[-1]: own for path, own in zip(paths, ids)}
    members, children, leaves, saved = [0] * n, [0] * n, [0] * n, [0] * n
    least: list[int | None] = [None] * n
    for node, own in ends.items():
        members[node], least[node] = len(own), own[0]
    edge: dict[int, bytes] = {}
    for seq, path in ((distinct[0], paths[0]), (distinct[-1], paths[-1])):
        edge |= zip(path, _keys(seq))
    order = tree.preorder()
    for node in reversed(order):
        above = up[node]
        if above < 0:
            continue
        if node not in edge:
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * size[tree.turn[node]]
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
        members[above] += members[node]
        least[above] = least[node] if least[above] is None or least[node] < least[above] else least[above]

    inside = [node for node in order if node not in edge]
    parents = [up[node] for node in inside]
    columns = dict.fromkeys(_NAMES) | {
        "kind": [LOOKING if p in edge else KNOWN for p in parents],
        "parent_key": [edge.get(p) for p in parents],
        "depth": [tree.depth[node] for node in inside],
        "conv_id": [least[node] for node in inside],
        "parent_conv_id": [None if p in edge else least[p] for p in parents],
        "n_convs": [members[node] for node in inside],
        "n_children": [children[node] for node in inside],
        "n_leaves": [leaves[node] for node in inside],
        "saved_tokens": [saved[node] for node in inside],
        "ends_sha256": [_sha256(ends.get(node, [])) for node in inside],
    }
    rows = pa.RecordBatch.from_arrays([pa.array(columns[f.name] or [None] * len(inside), f.type) for f in _ARROW], schema=_ARROW)
    nodes = {
        key: _Open(
            edge.get(up[node]),
            tree.depth[node],
            size[tree.turn[node]] if node else 0,
            members[node],
            least[node],
            children[node],
            leaves[node],
            saved[node],
            ends.get(node, []),
            node in ends,
        )
        for node, key in edge.items()
    }
    return rows, _Run(nodes, edge[paths[0][-1]], edge[paths[-1][-1]])


def shards(most: int):
    """For mapInArrow: sorted (seq, conv_id) to nodes, and the partition's open nodes with their ends."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        run, held, turns = None, [], 0

        def flush():
            nonlocal run, held, turns
            inside, own = shard(held)
            held, turns = [], 0
            run = own if run is None else run.joined(own)
            closed = run.closed()
            return [inside, *([pa.RecordBatch.from_pylist(closed, _ARROW)] if closed else [])]

        for batch in batches:
            for seq, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((seq, conv_id))
                turns += len(seq) // CODE + 1
                if turns >= most:
                    yield from flush()
        if held:
            yield from flush()
        if run is not None:
            yield pa.RecordBatch.from_pylist(run.rows(partition), _ARROW)

    return rows


# ---- between shards


def merger(last: bool):
    """For applyInArrow: the open nodes of neighbouring runs to closed ones and to those of the run they make."""

    def rows(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        by_piece: dict[int, list[dict]] = {}
        for r in table.to_pylist():
            by_piece.setdefault(r["piece"], []).append(r)
        run, out = None, []
        for piece in sorted(by_piece):
            nodes, first, end = {}, None, None
            for r in by_piece[piece]:
                nodes[r["key"]] = _Open(
                    r["parent_key"], r["depth"], r["bytes"], r["n_convs"], r["conv_id"], r["n_children"], r["n_leaves"], r["saved_tokens"], [], r["has_ends"]
                )
                first = r["key"] if r["is_first"] else first
                end = r["key"] if r["is_last"] else end
            own = _Run(nodes, first, end)
            run = own if run is None else run.joined(own)
            out += run.closed()
        out += run.closed(all_=True) if last else run.rows(key[0].as_py())
        return pa.Table.from_pylist(out, _ARROW)

    return rows


def _ends_hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, own, keys, shas = None, None, [], []
    for batch in batches:
        for k, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if own is not None:
                    keys.append(key)
                    shas.append(own.hexdigest())
                key, own = k, hashlib.sha256(ends.encode())
            else:
                own.update(b"," + ends.encode())
    if own is not None:
        keys.append(key)
        shas.append(own.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], names=["of", "sha"])


def prefix_trie(seqs: DataFrame, shard_turns: int = SHARD, fan: int = FAN) -> DataFrame:
    """The nodes over `seqs` (conv_id, one row each; seq, the bytes of its turns).

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves (of the subtree), saved_tokens (bytes
    of the last text for every member but one, over the subtree), ends_sha256 (of the conv_ids that end here).
    """
    dealt = seqs.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    rows = keep(dealt.select("seq", "conv_id").mapInArrow(shards(shard_turns), _SCHEMA))
    made, open_ = [rows.where(F.col("kind") <= LOOKING)], rows.where(F.col("kind") == OPEN)
    while True:
        newest = open_.agg(F.max("piece").alias("p")).first()["p"]
        if newest is None:
            break
        run = F.floor(F.col("piece") / fan).cast("int")
        merged = keep(open_.groupBy(run.alias("run")).applyInArrow(merger(newest < fan), _SCHEMA))
        made.append(merged.where(F.col("kind") == LOOKING))
        open_ = merged.where(F.col("kind") == OPEN)

    nodes = made[0]
    for more in made[1:]:
        nodes = nodes.unionAll(more)
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    looking = nodes.where(F.col("kind") == LOOKING)
    edge = looking.where("key IS NOT NULL")
    pieces = rows.where(F.col("kind") == ENDS).select("key", "ends", "piece").repartition("key").sortWithinPartitions("key", "piece")
    hashed = pieces.select("key", "ends").mapInArrow(_ends_hashed, "of binary, sha string")
    edge = edge.join(hashed, F.col("key") == F.col("of"), "left").withColumn("ends_sha256", F.coalesce("ends_sha256", "sha")).drop("of", "sha")
    edge = keep(edge)
    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALT)).cast("int")
    parents = edge.select(F.col("key").alias("of"), F.col("conv_id").alias("above"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("part"))
    children = looking.where("key IS NULL").unionAll(edge).withColumn("salt", salt)
    found = children.join(parents, (F.col("parent_key") == F.col("of")) & (F.col("salt") == F.col("part")), "left")
    found = found.withColumn("parent_conv_id", F.col("above"))
    return nodes.where(F.col("kind") == KNOWN).select(*out).unionAll(found.select(*out))


def report(conversations: DataFrame) -> DataFrame:
    """The nodes over conversations rebuilt to share beginnings."""
    return prefix_trie(keep(rebuild(sequences(conversations))))
