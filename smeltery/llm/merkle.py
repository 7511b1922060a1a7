"""Merkle manifest of a dataset: a persistent tree of documents in which versions share nodes.

Leaves are hashes of rows, in order of their id within a branch (a language). Every ``FAN`` nodes in a
row have a parent; what remains of each branch is its subroot, and the subroots have a root the same
way. The tree is cut into aligned blocks of ``FAN ** LEVELS`` nodes: a task holds one block, hands its
top on as a node of the next table, and these tables shrink by the block's size from one to the next.

Every tampered leaf makes a version of the tree. Inside its block the version copies the ancestors of
the leaf and shares all other nodes with the first version; above the block it goes on along the
block's path, whose untouched siblings the upper tables hand down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import cut, prepared, row_number_key
from smeltery.llm.ranks import numbered

FAN = 8
# Levels of a block, which holds so many levels' worth of nodes: 4,096.
LEVELS = 4

# A path: for each level the digests before and behind one's own, joined, from the leaf upwards.
_PATH = "array<struct<before:string,behind:string>>"
_NODE = "branch string, place long, of long, digest string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class PersistentTree:
    """The nodes of all versions of one block, kept in a growing list; a version is its root's number."""

    def __init__(self, leaves: list[str], levels: int | None) -> None:
        """Build the first version, up to ``levels`` levels or, if None, until one node remains."""
        self.digests: list[str] = []
        self.children: list[tuple[int, ...]] = []
        row = [self._add(leaf, ()) for leaf in leaves]
        self.rows = [row]
        while len(row) > 1 if levels is None else len(self.rows) <= levels:
            row = [self._parent(tuple(row[i : i + FAN])) for i in range(0, len(row), FAN)]
            self.rows.append(row)
        self.first = row[0]

    def _add(self, own: str, children: tuple[int, ...]) -> int:
        self.digests.append(own)
        self.children.append(children)
        return len(self.digests) - 1

    def _parent(self, children: tuple[int, ...]) -> int:
        return self._add(digest("".join(self.digests[c] for c in children)), children)

    def with_leaf(self, place: int, leaf: str) -> int:
        """A version with another leaf: only the leaf's ancestors are copied."""
        node = self._add(leaf, ())
        for row in self.rows[1:]:
            here = place % FAN
            place //= FAN
            old = self.children[row[place]]
            node = self._parent((*old[:here], node, *old[here + 1 :]))
        return node

    def path(self, place: int) -> list[tuple[str, str]]:
        """The digests beside the path from a leaf of the first version to its root."""
        found = []
        for below, row in zip(self.rows, self.rows[1:], strict=False):
            start = place - place % FAN
            beside = [self.digests[n] for n in below[start : start + FAN]]
            here = place - start
            found.append(("".join(beside[:here]), "".join(beside[here + 1 :])))
            place //= FAN
        return found


def folded(node: str, path: list[tuple[str, str]]) -> str:
    for before, behind in path:
        node = digest(before + node + behind)
    return node


def _field(column: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(_field, columns)).cast("binary"), 256)


def _blocked(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / FAN**levels))


def _tree(block: pd.DataFrame, levels: int) -> PersistentTree:
    """The first version of a block; the only block of a branch ends in the branch's subroot."""
    return PersistentTree(block["digest"].tolist(), None if block["of"].iloc[0] <= FAN**levels else levels)


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The top of every block, as a node of the next table."""

    def top(block: pd.DataFrame) -> pd.DataFrame:
        tree = _tree(block.sort_values("place"), levels)
        row = block.iloc[0]
        return pd.DataFrame(
            {
                "branch": [row["branch"]],
                "place": [row["block"]],
                "of": [-(-row["of"] // FAN**levels)],
                "digest": [tree.digests[tree.first]],
            }
        )

    return nodes.groupBy("branch", "block").applyInPandas(top, _NODE)


def _grown(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Tables of nodes, from the leaves up to the one with a single node per branch."""
    tables = [_blocked(leaves, levels)]
    while len(tables) == 1 or tables[-1].where("of > 1").head(1):
        tables.append(_blocked(cut(_tops(tables[-1], levels)), levels))
    return tables


def _beneath(
    nodes: DataFrame,
    above: DataFrame,
    answer: Callable[[PersistentTree, pd.DataFrame, pd.Series], pd.DataFrame],
    schema: str,
    levels: int,
) -> DataFrame:
    """Apply ``answer`` to every block, given its tree and the row of ``above`` about its top."""

    def visit(block: pd.DataFrame, tops: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place", ignore_index=True)
        return answer(_tree(block, levels), block, tops.iloc[0])

    tops = above.withColumnRenamed("place", "block")
    return nodes.groupBy("branch", "block").cogroup(tops.groupBy("branch", "block")).applyInPandas(visit, schema)


def _steps(top: pd.Series) -> list[tuple[str, str]]:
    return [(step["before"], step["behind"]) for step in top["path"]]


def _paths(tables: list[DataFrame], last: DataFrame, lowest: int, levels: int) -> DataFrame:
    """Paths of the nodes of table ``lowest``, from those (``branch, place, path``) of the last one."""

    def answer(tree: PersistentTree, block: pd.DataFrame, top: pd.Series) -> pd.DataFrame:
        upper = _steps(top)
        paths = [[{"before": a, "behind": b} for a, b in tree.path(i) + upper] for i in range(len(block))]
        return pd.DataFrame({"branch": block["branch"], "place": block["place"], "path": paths})

    for nodes in reversed(tables[lowest:-1]):
        last = cut(_beneath(nodes, last, answer, f"branch string, place long, path {_PATH}", levels))
    return last


def merkle_manifest(
    docs: DataFrame,
    tampered: Column,
    forged_text: Column,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    branch_col: str = "lang",
    text_col: str = "text",
    levels: int = LEVELS,
) -> DataFrame:
    """One row per input row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``leaf`` is the sha256 of the named columns. Per value of ``branch_col`` the leaves ascend by id; of
    eight nodes in a row the parent is the sha256 of their joined digests, until one remains, the
    ``subroot`` (a lone leaf itself). The subroots, by branch (null first, by UTF-8 bytes), make ``root``
    alike. ``proof_sha256`` hashes the siblings of the path to the root. Rows ``tampered`` get a version of
    the tree with their ``text_col`` replaced by ``forged_text``; ``folded_root`` is that version's root,
    for other rows the one their own leaf folds to, and ``verified`` tells whether it is ``root``. ``levels`` is the
    height of the blocks that tasks hold; it changes no result.

    Nulls: a null value of a named column hashes as ``-``; null ids come first in their branch, null
    branches are one branch; a null in ``tampered`` counts as false. Ties: equal ids are ordered by leaf,
    equal rows are alike in all columns. Repeated rows are leaves of their own. An empty table gives no
    rows, a single row is its own root with a proof of nothing. Texts of any length are hashed whole, once
    as they are and once forged. Other columns, of whatever name, are not read.
    """
    prepared(docs.sparkSession)
    as_is = {c: F.col(c) for c in columns}
    forged = as_is | {text_col: forged_text} if text_col in as_is else as_is
    branch = F.coalesce(F.concat(F.lit("+"), F.col(branch_col).cast("string")), F.lit(""))
    rows = docs.select(
        branch.alias("branch"),
        F.col(id_col).alias("id"),
        leaf_digest(list(as_is.values())).alias("digest"),
        F.when(tampered, leaf_digest(list(forged.values()))).alias("forged"),
        row_number_key().alias("row"),
    )
    # Cut before they are sorted, as dealing rows by ranges reads them twice.
    tables = _grown(cut(numbered(cut(rows), "branch", ["id", "digest", "row"])), levels)
    # The subroots are the leaves of a tree of their own, which holds a single branch.
    subroots = tables[-1].select(F.lit("").alias("branch"), F.col("branch").alias("name"), "digest")
    upper = _grown(cut(numbered(subroots, "branch", ["name"])), levels)
    whole = upper[-1].head(1)
    root = whole[0]["digest"] if whole else None
    over = _paths(upper, upper[-1].select("branch", "place", F.array().cast(_PATH).alias("path")), 0, levels)
    named = upper[0].join(over, "place").select(F.col("name").alias("branch"), "path", F.col("digest").alias("subroot"))
    tops = named.select("branch", F.lit(0).cast("long").alias("place"), "path")
    paths = _paths(tables, tops, 1, levels).join(named.select("branch", "subroot"), "branch")

    def answer(tree: PersistentTree, block: pd.DataFrame, top: pd.Series) -> pd.DataFrame:
        upwards = _steps(top)
        first = folded(tree.digests[tree.first], upwards)
        proofs, found = [], []
        for place, leaf in enumerate(block["forged"]):
            proofs.append(digest("".join(before + behind for before, behind in tree.path(place) + upwards)))
            forged_version = tree.with_leaf(place, leaf) if isinstance(leaf, str) else tree.first
            unchanged = forged_version == tree.first
            found.append(first if unchanged else folded(tree.digests[forged_version], upwards))
        return pd.DataFrame(
            {
                "doc_id": block["id"],
                "leaf": block["digest"],
                "subroot": top["subroot"],
                "proof_sha256": proofs,
                "folded_root": found,
            }
        )

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string"
    return _beneath(tables[0], paths, answer, schema, levels).select(
        "doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
