"""A Merkle manifest of a table: leaf digests, one tree a group, a tree of the groups, proofs and folding.

A leaf is the SHA-256 of a row's fields. The leaves of a group, in the order of
the table's ids, are the lowest nodes of its tree; every 16 consecutive nodes
have a parent, the SHA-256 of their digests as hex text, until one node is left.
These, in the order of their groups, make the upper tree in the same way.

A parent is hashed child by child, and a copy of the hash state is retained
before each child slot (its midstate). To fold a changed leaf into a new root,
the state before the leaf's slot is resumed with the new digest and the siblings
to its right only; the result takes its slot in the next parent.

Work is done in subtrees of 16^3 leaves, each one group of bounded size:

1. Leaves are numbered within their groups by a range shuffle of digests.
2. Upwards, a subtree's rows become its top digest; tops are the nodes of the
   next round, so a round shrinks a table 4096 times.
3. Downwards, each subtree's task gets the siblings of its ancestors (the left
   and the right of 15 a level) beside its nodes, and from these all states.

A hot group has many subtrees, and no task has more than one group of 4096 nodes
and its ancestors' siblings at a time. The tables between the rounds are stored.

Rows that repeat are leaves of their own. Equal ids are put in the order of their
leaves; NULL ids come first, as does the NULL group. An empty table has no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordered import dense_id
from tidemark.operators.skew import join_heavy
from tidemark.storage import materialize

ARITY = 16
#: Levels of nodes that one task takes, and the lowest nodes these have.
LEVELS = 3
SPAN = ARITY**LEVELS

Sibling = tuple[str, str]  # digests left of a slot, and right of it


def leaf_of(*fields: Column) -> Column:
    """The digest of a row: of each field its UTF-8 length, a colon and its text; NULL is a hyphen."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]).cast("binary"), 256)


# --- one parent, one subtree ----------------------------------------------------------------

class Parent:
    """A node over at most 16 digests, with the hash state before each of its slots."""

    def __init__(self, children: list[str]):
        self.children = "".join(children)
        self.states = []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def siblings(self, slot: int) -> Sibling:
        return self.children[: 64 * slot], self.children[64 * slot + 64 :]

    def fold(self, slot: int, child: str) -> str:
        """The digest with another child in ``slot``: its state, the child, and what is right of it."""
        state = self.states[slot].copy()
        state.update((child + self.children[64 * slot + 64 :]).encode())
        return state.hexdigest()


class Ancestor:
    """A parent known by one child's siblings only; keeps that slot's state."""

    def __init__(self, sibling: Sibling):
        self.state = hashlib.sha256(sibling[0].encode())
        self.right = sibling[1].encode()

    def fold(self, child: str) -> str:
        state = self.state.copy()
        state.update(child.encode() + self.right)
        return state.hexdigest()


class Subtree:
    """Parents over consecutive nodes: three levels, or for a whole tree up to its single top."""

    def __init__(self, nodes: list[str], whole: bool):
        self.levels: list[list[Parent]] = []
        while (len(nodes) > 1) if whole else (len(self.levels) < LEVELS):
            row = [Parent(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
            self.levels.append(row)
            nodes = [p.digest for p in row]
        self.top = nodes[0]

    def siblings(self, at: int) -> list[Sibling]:
        out = []
        for row in self.levels:
            out.append(row[at // ARITY].siblings(at % ARITY))
            at //= ARITY
        return out

    def fold(self, at: int, digest: str) -> str:
        for row in self.levels:
            digest = row[at // ARITY].fold(at % ARITY, digest)
            at //= ARITY
        return digest


# --- rounds ---------------------------------------------------------------------------------

NODE = "tree long, pos long, n long, digest string"
PATH = "array<struct<left:string,right:string>>"
_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_PART = f"pos div {SPAN} AS part"


@dataclass
class Forest:
    """The nodes of each round, lowest first, and the trees' tops (``tree``, ``digest``, ``round``)."""

    rounds: list[DataFrame]
    tops: DataFrame


def _subtree(nodes: pa.Table) -> tuple[pa.Table, Subtree]:
    nodes = nodes.sort_by("pos")
    return nodes, Subtree(nodes["digest"].to_pylist(), nodes["n"][0].as_py() <= SPAN)


def _top(nodes: pa.Table) -> pa.Table:
    nodes, made = _subtree(nodes)
    pos, n = nodes["pos"][0].as_py() // SPAN, -(-nodes["n"][0].as_py() // SPAN)
    return pa.table({"tree": nodes["tree"].slice(0, 1), "pos": [pos], "n": [n], "digest": [made.top]})


def _grow(nodes: DataFrame) -> Forest:
    """Trees over stored nodes ``tree``, ``pos``, ``n`` (of the tree), ``digest``, and what else a leaf carries."""
    rounds, tops = [], []
    while True:
        rounds.append(nodes)
        above = nodes.select("tree", "pos", "n", "digest").groupBy("tree", F.expr(_PART)).applyInArrow(_top, NODE)
        above = materialize(above, "merkle-nodes")
        tops.append(above.filter("n = 1").select("tree", "digest", F.lit(len(rounds) - 1).alias("round")))
        nodes = above.filter("n > 1")
        if nodes.isEmpty():
            return Forest(rounds, reduce(DataFrame.unionByName, tops))


def _paths(made: Subtree, above: list[Sibling], n: int) -> pa.Array:
    """The siblings of each of a subtree's ``n`` nodes, up to the root."""
    own = [[{"left": a, "right": b} for a, b in made.siblings(i) + above] for i in range(n)]
    return pa.array(own, _PATH)


def _descend(
    forest: Forest, start: DataFrame, visit: Callable[[pa.Table, Subtree, list[Sibling], pa.Table], pa.Table], schema: str
) -> DataFrame:
    """Hand every lowest subtree its ancestors' siblings, and collect what ``visit`` makes of it.

    ``start`` has a row for each tree: ``tree``, ``round``, ``path`` (siblings
    above its top) and further columns, which reach ``visit`` in its last argument.
    """
    carried = [f for f in start.schema if f.name not in ("tree", "round", "path")]
    names = [f.name for f in carried]
    passed = f"tree long, part long, path {PATH}" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in carried)

    def pass_on(nodes: pa.Table, made: Subtree, above: list[Sibling], right: pa.Table) -> pa.Table:
        same = {c: [right[c][0].as_py()] * len(nodes) for c in names}
        return pa.table({"tree": nodes["tree"], "part": nodes["pos"], "path": _paths(made, above, len(nodes)), **same})

    paths = None
    for level in reversed(range(len(forest.rounds))):
        whole = start.filter(F.col("round") == level).select("tree", F.lit(0).cast("long").alias("part"), "path", *names)
        paths = whole if paths is None else whole.unionByName(paths)

        handle = visit if level == 0 else pass_on

        def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            nodes, made = _subtree(left)
            above = [(s["left"], s["right"]) for s in right["path"][0].as_py()]
            return handle(nodes, made, above, right)

        met = forest.rounds[level].groupBy("tree", F.expr(_PART)).cogroup(paths.groupBy("tree", "part"))
        if level == 0:
            return met.applyInArrow(run, schema)
        paths = materialize(met.applyInArrow(run, passed), "merkle-paths")


# --- the manifest ---------------------------------------------------------------------------

@dataclass
class Manifest:
    """Trees of groups and the upper tree over their tops.

    ``leaves`` has a row for each input row: ``tree``, ``pos``, ``n`` (leaves of
    the tree), ``digest``, ``id`` and further columns; ``groups`` names the
    ``tree`` of each ``group``, numbered in the order of the groups.
    """

    leaves: DataFrame
    groups: DataFrame
    lower: Forest
    upper: Forest

    def root(self) -> str | None:
        found = self.upper.tops.select("digest").first()
        return found.digest if found else None


def manifest(table: DataFrame, group: str, order: str, leaf: Column, **also: Column) -> Manifest:
    """Trees over the rows of ``table``; ``also`` are further columns to keep beside each leaf."""
    rows = materialize(table.select(
        F.col(group).alias("group"), F.col(order).alias("id"), leaf.alias("digest"), *[c.alias(n) for n, c in also.items()]
    ), "merkle-leaves")
    numbered = dense_id(rows, [F.col("group"), F.col("id"), F.col("digest")], "at")
    # groups follow each other in that order, so their first numbers are ordered as they are
    found = numbered.groupBy("group").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = materialize(dense_id(found, [F.col("first")], "tree"), "merkle-groups")
    placed = join_heavy(numbered, groups, ["group"], null_safe=True)
    leaves = materialize(
        placed.select("tree", (F.col("at") - F.col("first")).alias("pos"), "n", "digest", "id", *also), "merkle-leaves"
    )
    lower = _grow(leaves)
    many = lower.tops.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(groups.count()).cast("long").alias("n"), "digest"
    )
    return Manifest(leaves, groups.select("tree", "group"), lower, _grow(materialize(many, "merkle-nodes")))


def _starts(made: Manifest) -> DataFrame:
    """``tree``, ``round``, ``path``, ``subroot`` and ``root`` of each group's tree."""

    def visit(nodes: pa.Table, subtree: Subtree, above: list[Sibling], start: pa.Table) -> pa.Table:
        return pa.table({
            "tree": nodes["pos"], "path": _paths(subtree, above, len(nodes)), "subroot": nodes["digest"],
            "root": [start["root"][0].as_py()] * len(nodes),
        })

    top = made.upper.tops.select("tree", "round", F.expr(f"CAST(array() AS {PATH})").alias("path"), F.col("digest").alias("root"))
    found = _descend(made.upper, top, visit, f"tree long, path {PATH}, subroot string, root string")
    return materialize(found.join(made.lower.tops.select("tree", "round"), "tree"), "merkle-paths")


def proofs(made: Manifest) -> DataFrame:
    """Of each leaf ``id``, ``pos``, ``leaf``, ``subroot``, ``root`` and ``path``: siblings of every level up to the root."""

    def visit(nodes: pa.Table, subtree: Subtree, above: list[Sibling], start: pa.Table) -> pa.Table:
        same = {c: [start[c][0].as_py()] * len(nodes) for c in ("subroot", "root")}
        return pa.table({
            "id": nodes["id"], "pos": nodes["pos"], "leaf": nodes["digest"], **same,
            "path": _paths(subtree, above, len(nodes)),
        })

    kind = made.leaves.schema["id"].dataType.simpleString()
    return _descend(
        made.lower, _starts(made), visit, f"id {kind}, pos long, leaf string, subroot string, root string, path {PATH}"
    )


def fold(made: Manifest, changed: str) -> DataFrame:
    """Put each leaf's ``changed`` digest (NULL: its own) in its place, and compute the root that follows.

    Columns ``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of the
    siblings, level by level, left to right), ``folded_root`` and ``verified``
    (it is the root). All but ``folded_root`` are those of the unchanged table.
    """

    def visit(nodes: pa.Table, subtree: Subtree, above: list[Sibling], start: pa.Table) -> pa.Table:
        root = start["root"][0].as_py()
        ancestors = [Ancestor(s) for s in above]
        beyond = "".join(a + b for a, b in above).encode()
        proof, folded = [], []
        for i, (own, new) in enumerate(zip(nodes["digest"].to_pylist(), nodes[changed].to_pylist())):
            seen = hashlib.sha256("".join(a + b for a, b in subtree.siblings(i)).encode())
            seen.update(beyond)
            proof.append(seen.hexdigest())
            digest = subtree.fold(i, own if new is None else new)
            for ancestor in ancestors:
                digest = ancestor.fold(digest)
            folded.append(digest)
        return pa.table({
            "id": nodes["id"], "leaf": nodes["digest"], "subroot": [start["subroot"][0].as_py()] * len(nodes),
            "root": [root] * len(nodes), "proof_sha256": proof, "folded_root": folded,
            "verified": [f == root for f in folded],
        })

    kind = made.leaves.schema["id"].dataType.simpleString()
    return _descend(
        made.lower, _starts(made), visit,
        f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )
