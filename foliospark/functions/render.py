"""Markdown of tables and document trees. A tree is an array of nodes whose children are positions in it."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql.types import StringType

from ..schemas import TREE
from .pieces import by_pieces
from .text import BIDI

DEEPEST = 30
_MARKS = re.compile(re.sub(r"\\x\{([0-9A-F]{4})\}", r"\\u\1", BIDI))


def table(grid: Mapping | None) -> str:
    """A pipe table of the whole grid; cells outside it are dropped, of several for one place the last stays."""
    grid = grid or {}
    rows, cols, cells = grid.get("rows") or 0, grid.get("cols") or 0, grid.get("cells") or []
    if not (rows and cols and cells):
        return ""
    placed = {(c.get("row") or 0, c.get("col") or 0): (c.get("content") or "").replace("|", "\\|").replace("\n", " ") for c in cells}
    out = ["| " + " | ".join(placed.get((r, c), "") for c in range(cols)) + " |" for r in range(rows)]
    out.insert(1, "| " + " | ".join(["---"] * cols) + " |")
    return "\n".join(out)


class Tree:
    """Renders a tree from its roots down; nodes deeper than DEEPEST below a root are left out."""

    def __init__(self, nodes: Sequence[Mapping], image_placeholder: bool = True) -> None:
        self.nodes = nodes
        self.images = image_placeholder

    def roots(self) -> list[int]:
        below = {c for n in self.nodes for c in n.get("children") or ()}
        return [i for i in range(len(self.nodes)) if i not in below]

    def _title(self, node: Mapping, text: str) -> str:
        level = node.get("heading_level")
        return f"{'#' * (2 if level is None else level)} {text}"

    def _parts(self, i: int, depth: int) -> list[str]:
        node = self.nodes[i]
        kind, kids = node.get("node_type"), node.get("children") or []
        text, heading = (node.get("text") or "").strip(), (node.get("heading_text") or "").strip()
        if kind == "paragraph":
            return [text]
        if kind == "heading":
            title = (node.get("heading_text") or node.get("text") or "").strip()
            return [self._title(node, title)] if title else []
        if kind == "group":
            rest = [k for k in kids if k < len(self.nodes) and self.nodes[k].get("node_type") != "heading"]
            return [*([self._title(node, heading)] if heading else []), self.walk(rest, depth + 1)]
        if kind == "list":
            return [self.walk(kids, depth + 1)]
        if kind == "list_item":
            return [f"- {text}"] if text else []
        if kind == "table":
            return [table(node.get("grid"))]
        if kind == "image" and self.images:
            note = (node.get("description") or "").strip()
            return [f"<!-- image -->\n{note}" if note else "<!-- image -->"]
        return []

    def walk(self, at: Sequence[int], depth: int = 0) -> str:
        if depth > DEEPEST:
            return ""
        return "\n\n".join(p for i in at if i < len(self.nodes) for p in self._parts(i, depth) if p)


def document(nodes: Sequence[Mapping] | None, flat: str, tables: Sequence[str] | None = None, table_fallback: bool = True, image_placeholder: bool = True) -> str:
    """The tree without directional marks; else the tables' Markdown; else the flat text."""
    if nodes:
        tree = Tree(nodes, image_placeholder)
        if (text := tree.walk(tree.roots())).strip():
            return _MARKS.sub("", text)
    joined = "\n\n".join(t.strip() for t in tables or () if t and t.strip()) if table_fallback else ""
    return joined or flat


@by_pieces(StringType())
def render_tree(trees: pa.Array) -> pa.Array:
    """Markdown of a column of trees (schemas.TREE)."""
    return pa.array([document(t, "") if t is not None else None for t in trees.to_pylist()], pa.string())


@by_pieces(StringType())
def render_grid(grids: pa.Array) -> pa.Array:
    """Markdown of a column of grids (schemas.GRID)."""
    return pa.array([table(g) for g in grids.to_pylist()], pa.string())


__all__ = ["TREE", "Tree", "document", "render_grid", "render_tree", "table"]
