"""The prefix trie of conversations, by union-find over sorted neighbours.

A conversation is the sequence of its turns; a turn is named by 32 hexadecimal digits of the SHA-256 of its
role and text, so that texts are shuffled nowhere.  Conversations are sorted by those names: any
that share their first d turns then stand next to each other, and what a neighbour shares
(LCP) tells all that any two share.

Local forests.  The sort cuts the conversations into ranges, a task each.  A task takes its LCP edges in descending
depth and merges their ends' components by union-find.  A merge at depth d creates the branching
node of depth d: components that reach deeper become its children and are final; one of
the same depth is the same node.  A component stands for the chain of nodes between its parent's depth and its own.

Contraction.  Only nodes on the way from the root to a task's first or last conversation can
continue in another task.  A task keeps of them what lies below in complete subtrees as sums, so that
its forest is contracted to two paths.

Merging.  Neighbouring forests share as many nodes of their facing paths as these have labels (a
digest of the prefix) in common.  Those are merged by union-find, deepest first, for up to ``fan_in``
forests in a task, which leaves a forest of two paths again, until one is left.  What no outer path
holds any more is final.

A node is known by its smallest member and its depth.  Where the parent was still open
when a node became final, the parent's label is resolved by a join at the end.  Members that
end at a node are hashed where they stand, as a run of the sorted conversations; a run that
crosses tasks is hashed in one stream over its pieces, so a third of all conversations may be alike.

Cases: a null role or text is empty; turns are ordered with nulls first, equal turn numbers by their names; rows without
a conversation id take no part; a rebuilt conversation without turns ends at the root; repeated rows are turns
of their own; an empty table gives no rows; further columns are ignored.  Texts of any length are hashed whole.  A
conversation's names and sizes, some 60 bytes a turn, are one row.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histdim.llm.frames import shuffle_partitions, stored

#: Digits of a turn's name.
NAME = 32
NOTHING = hashlib.sha256(b"").hexdigest()
#: Bytes of joined ids in a piece of a run that crosses tasks.
PIECE = 1 << 20

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, label string, parent_label string, ends_label string")
PATH = ("forest long, side int, depth long, label string, n long, least long, "
        "children long, leaves long, saved long, bytes long, ends string")
_NODE = [x.split()[0] for x in NODE.split(", ")]
_PATH = [x.split()[0] for x in PATH.split(", ")]
ROWS = f"kind string, {NODE}, path struct<{PATH.replace(' ', ':').replace(',:', ',')}>, piece struct<task:long,at:long,ids:binary>"


# --- conversations ------------------------------------------------------------------


def conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv, names, sizes): a row for each conversation, its turns' names and the UTF-8 bytes of their texts in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # The role's length keeps role and text apart.
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.substring(F.sha2(whole.cast("binary"), 256), 1, NAME).alias("name"), F.octet_length(text).cast("long").alias("size"))
    grouped = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "name", "size"))).alias("seq"))
    return grouped.select("conv", F.col("seq.name").alias("names"), F.col("seq.size").alias("sizes"))


def rebuilt(convs: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Conversation c with the first h turns of conversation c - c % ``group`` in place of its own first h,
    h = crc32(c) % ``most``."""
    head = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most)).cast("int")
    base = convs.filter(F.col("conv") % group == 0).select(
        F.col("conv").alias("base"), F.slice("names", 1, most - 1).alias("base_names"), F.slice("sizes", 1, most - 1).alias("base_sizes"))
    both = convs.withColumn("base", F.col("conv") - F.col("conv") % group).join(base, "base", "left").withColumn("h", head)

    def mixed(own, other, kind):
        first = F.slice(F.coalesce(other, F.array().cast(kind)), F.lit(1), F.col("h"))
        return F.concat(first, F.slice(F.col(own), F.col("h") + 1, F.greatest(F.size(own), F.lit(1))))

    return both.select("conv", mixed("names", F.col("base_names"), "array<string>").alias("names"),
                       mixed("sizes", F.col("base_sizes"), "array<bigint>").alias("sizes"))


# --- forests in a task -----------------------------------------------------------------


@dataclass
class Tree:
    """A component: conversations that share their first ``depth`` turns."""

    depth: int
    n: int
    least: int
    first: int                                       # place of its first conversation
    last: int
    kids: list[Tree] = field(default_factory=list)
    ends: tuple[int, int] | None = None              # places of the members that end here: a run


def forest(depths: list[int], convs: list[int], shared: list[int]) -> Tree:
    """The trie of sorted conversations of these depths, of which neighbours share ``shared`` turns."""
    of = [Tree(d, 1, c, i, i, ends=(i, i)) for i, (d, c) in enumerate(zip(depths, convs))]
    up = list(range(len(of)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for e in sorted(range(len(shared)), key=lambda e: -shared[e]):
        a, b, d = find(e), find(e + 1), shared[e]
        one, two = (t if t.depth == d else Tree(d, t.n, t.least, t.first, t.last, [t]) for t in (of[a], of[b]))
        # The smaller of the two lists moves into the larger; members stand from left to right all the same.
        if len(one.kids) < len(two.kids):
            one.kids, two.kids = two.kids, one.kids
        one.kids += two.kids
        # Members that end at d sort before all that go on, so they are one run at the left.
        if one.ends and two.ends:
            one.ends = (one.ends[0], two.ends[1])
        one.n, one.least, one.last = one.n + two.n, min(one.least, two.least), two.last
        up[b], of[a] = a, one
    top = of[find(0)]
    return top if top.depth == 0 else Tree(0, top.n, top.least, top.first, top.last, [top])


class Output:
    """Rows of ``ROWS``."""

    def __init__(self):
        self.rows = []

    def node(self, conv, depth, parent, n, children, leaves, saved, ends, label=None, parent_label=None, ends_label=None):
        self.rows.append({"kind": "node", **dict(zip(_NODE, (conv, depth, parent, n, children, leaves, saved, ends, label, parent_label, ends_label)))})

    def path(self, row: dict):
        self.rows.append({"kind": "path", "path": row})

    def piece(self, ends_label: str, task: int, at: int, ids: bytes):
        self.rows.append({"kind": "piece", "ends_label": ends_label, "piece": {"task": task, "at": at, "ids": ids}})


def labels_of(key: str, depth: int) -> list[str]:
    """A digest of each prefix of the first ``depth`` turns."""
    h, out = hashlib.sha256(), [NOTHING]
    for d in range(depth):
        h.update(key[d * NAME:(d + 1) * NAME].encode())
        out.append(h.copy().hexdigest())
    return out


def local_forest(task: int, keys: list[str], convs: list[int], sizes: list[np.ndarray]) -> list[dict]:
    """Final nodes, contracted paths and pieces of runs of a task's sorted conversations."""
    out, last = Output(), len(keys) - 1
    depths = [len(k) // NAME for k in keys]
    shared = [_shared(a, b) for a, b in zip(keys, keys[1:])]
    root = forest(depths, convs, shared)
    side = {0: labels_of(keys[0], depths[0]), last: labels_of(keys[last], depths[last])}

    def ids(run) -> bytes:
        return ",".join(map(str, convs[run[0]:run[1] + 1])).encode()

    # Children before parents, without recursion: conversations may have many turns.
    order, stack = [], [(root, None, -1)]
    while stack:
        t, parent, above = stack.pop()
        order.append((t, parent, above))
        stack += [(k, t, t.depth) for k in t.kids]
    sums = {}          # id of a tree: what its complete children hold
    top_row = {}       # id of a tree: the row of its top node, until its parent is known
    done = {}          # id of a tree: (leaves, saved) of its whole subtree, with its chain
    for t, parent, above in reversed(order):
        open_left, open_right = t.first == 0, t.last == last
        children, leaves, saved = len(t.kids), 0, 0
        closed = [k for k in t.kids if not (k.first == 0 or k.last == last)]
        for k in closed:
            leaves, saved = leaves + done[id(k)][0], saved + done[id(k)][1]
        if open_left or open_right:
            sums[id(t)] = (len(closed), leaves, saved)
            label = side[0 if open_left else last][t.depth]
            for k in closed:
                row = out.rows[top_row[id(k)]]
                row["parent_conv_id"], row["parent_label"] = None, label
            continue
        leaves = leaves or 1
        size = sizes[t.first]
        ends = hashlib.sha256(ids(t.ends)).hexdigest() if t.ends else NOTHING
        for d in range(t.depth, above, -1):
            saved += (t.n - 1) * int(size[d - 1])
            bottom = d == t.depth
            out.node(t.least, d, t.least, t.n, children if bottom else 1, leaves, saved, ends if bottom else NOTHING)
        top_row[id(t)] = len(out.rows) - 1
        done[id(t)] = (leaves, saved)
        for k in t.kids:
            out.rows[top_row[id(k)]]["parent_conv_id"] = t.least

    for t, parent, above in order:
        open_left, open_right = t.first == 0, t.last == last
        if not (open_left or open_right):
            continue
        at = 0 if open_left else last
        which = 2 if open_left and open_right else 0 if open_left else 1
        ends = None
        if t.ends:
            ends = side[at][t.depth]
            _pieces(out, ends, task, convs, t.ends)
        for d in range(t.depth, above, -1):
            bottom = d == t.depth
            children, leaves, saved = sums[id(t)] if bottom else (0, 0, 0)
            size = int(sizes[at][d - 1]) if d else 0
            out.path(dict(zip(_PATH, (task, which, d, side[at][d], t.n, t.least, children, leaves, saved, size, ends if bottom else None))))
    return out.rows


def _pieces(out: Output, label: str, task: int, convs: list[int], run: tuple[int, int]) -> None:
    step = PIECE // 20
    for at in range(run[0], run[1] + 1, step):
        out.piece(label, task, at, ",".join(map(str, convs[at:min(at + step, run[1] + 1)])).encode())


def _shared(a: str, b: str) -> int:
    """Turns that two keys have in common, found by halving."""
    low, high = 0, min(len(a), len(b)) // NAME
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * NAME:mid * NAME] == b[low * NAME:mid * NAME]:
            low = mid
        else:
            high = mid - 1
    return low


# --- forests of several tasks ------------------------------------------------------------


def merge_forests(to: int, paths: list[dict], final: bool) -> list[dict]:
    """Merges neighbouring contracted forests (rows of ``PATH``) into one numbered ``to``; ``final``: there
    is no other, so nothing stays open."""
    out = Output()
    numbers = sorted({p["forest"] for p in paths})
    left = {f: [] for f in numbers}
    right = {f: [] for f in numbers}
    for i, p in sorted(enumerate(paths), key=lambda x: x[1]["depth"]):
        if p["side"] != 1:
            left[p["forest"]].append(i)
        if p["side"] != 0:
            right[p["forest"]].append(i)
    up = list(range(len(paths)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    edges = [(d, a, b) for f, g in zip(numbers, numbers[1:]) for d, (a, b) in enumerate(zip(right[f], left[g]))
             if paths[a]["label"] == paths[b]["label"]]
    for _, a, b in sorted(edges, reverse=True):
        up[find(b)] = find(a)
    parent = {}
    for way in (*left.values(), *right.values()):
        for a, b in zip(way, way[1:]):
            parent[find(b)] = find(a)
    merged = {}
    for i, p in enumerate(paths):
        m = merged.get(find(i))
        if m is None:
            merged[find(i)] = dict(p)
        else:
            for c in ("n", "children", "leaves", "saved"):
                m[c] += p[c]
            m["least"], m["ends"] = min(m["least"], p["least"]), m["ends"] or p["ends"]
    first, last = {find(i) for i in left[numbers[0]]}, {find(i) for i in right[numbers[-1]]}
    outer = set() if final else first | last
    for r in sorted(merged, key=lambda r: -merged[r]["depth"]):
        m, at = merged[r], parent.get(r)
        if r in outer:
            out.path(m | {"forest": to, "side": 2 if r in first and r in last else 0 if r in first else 1})
            continue
        leaves, saved = m["leaves"] or 1, m["saved"] + (m["n"] - 1) * m["bytes"]
        above = merged.get(at)
        if above is not None:
            above["children"] += 1
            above["leaves"] += leaves
            above["saved"] += saved
        known = above is not None and at not in outer
        out.node(m["least"], m["depth"], above["least"] if known else None, m["n"], m["children"], leaves, saved, NOTHING,
                 m["label"], None if known or above is None else above["label"], m["ends"])
    return out.rows


# --- Spark --------------------------------------------------------------------------------


def _schema(spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], ROWS).schema)


def prefix_trie(convs: DataFrame, fan_in: int = 64) -> DataFrame:
    """A row for each distinct prefix of the conversations (conv, names, sizes)."""
    spark = convs.sparkSession
    schema = _schema(spark)

    def rows(found: list[dict]) -> list[pa.RecordBatch]:
        return pa.Table.from_pylist(found, schema).to_batches()

    def local(batches):
        keys, ids, sizes = [], [], []
        for batch in batches:
            keys += batch.column(0).to_pylist()
            ids += batch.column(1).to_pylist()
            sizes += [x.values.to_numpy() if x.is_valid else np.zeros(0, np.int64) for x in batch.column(2)]
        if keys:
            yield from rows(local_forest(TaskContext.get().partitionId(), keys, ids, sizes))

    def merging(final: bool):
        def merge(key, table):
            found = merge_forests(key[0].as_py(), table.drop_columns(["group"]).to_pylist(), final)
            return pa.Table.from_batches(rows(found), schema)
        return merge

    tasks = shuffle_partitions(spark)
    ordered = convs.select(F.array_join("names", "").alias("key"), "conv", "sizes").repartitionByRange(
        tasks, "key", "conv").sortWithinPartitions("key", "conv")
    parts, open_forests = [stored(ordered.mapInArrow(local, ROWS), "forest")], tasks
    while not parts[1:] or open_forests > 1:
        open_forests = -(-open_forests // fan_in)
        paths = parts[-1].filter("kind = 'path'").select("path.*")
        grouped = paths.withColumn("group", F.floor(F.col("forest") / fan_in).cast("long")).groupBy("group")
        parts.append(stored(grouped.applyInArrow(merging(open_forests == 1), ROWS), "merged"))

    nodes = parts[0].filter("kind = 'node'")
    for part in parts[1:]:
        nodes = nodes.unionByName(part.filter("kind = 'node'"))
    nodes = nodes.select(*_NODE)
    # Parents that were open when their children became final: nodes of the merged paths.
    known = nodes.filter("label IS NOT NULL").select(F.col("label").alias("parent_label"), F.col("conv_id").alias("found"))
    pieces = parts[0].filter("kind = 'piece'").select("ends_label", "piece.*")
    nodes = nodes.join(known, "parent_label", "left").join(_hashed_runs(pieces), "ends_label", "left")
    return nodes.select("conv_id", "depth", F.coalesce("parent_conv_id", "found").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        "saved_tokens", F.coalesce("run_sha256", "ends_sha256").alias("ends_sha256"))


def _hashed_runs(pieces: DataFrame) -> DataFrame:
    """(ends_label, run_sha256): the digest of each run's joined ids, read piece by piece."""

    def hashed(batches):
        label, h = None, None
        for batch in batches:
            for now, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if now != label:
                    if label is not None:
                        yield _run(label, h)
                    label, h = now, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.as_py())
        if label is not None:
            yield _run(label, h)

    def _run(label, h):
        return pa.RecordBatch.from_pydict({"ends_label": [label], "run_sha256": [h.hexdigest()]})

    return (pieces.repartition("ends_label").sortWithinPartitions("ends_label", "task", "at").select("ends_label", "ids")
            .mapInArrow(hashed, "ends_label string, run_sha256 string"))
