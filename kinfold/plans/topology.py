"""Type-graph planning: topological orders, BFS and the traversal plan.

The type graph is the dictionary (tens of labels), so the plan is a short
Python list built on the driver.  Orders are by longest path from the root,
ties broken by label, which is a valid topological order and deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass

from kinfold.model import Dictionary, GraphError

UP = "up"
DOWN = "down"


@dataclass(frozen=True)
class Step:
    pos: int
    way: str  # UP or DOWN
    label: str


def _neighbours(d: Dictionary, label: str, direction: str) -> list[str]:
    if direction == UP:
        return sorted({e.dst_label for e in d.edges_by_child(label)})
    return sorted({e.src_label for e in d.edges_by_parent(label)})


def topology_depths(d: Dictionary, root: str, direction: str) -> dict[str, int]:
    """Longest-path depth of every label reachable from ``root``.

    ``direction`` UP follows child -> parent links, DOWN parent -> child.
    A cycle reachable from the root raises instead of looping.
    """
    if root not in d.node_tables:
        raise GraphError(f"root type {root!r} does not exist in the dictionary")
    depth = {root: 0}
    frontier = {root}
    for _ in range(len(d.node_tables) + 1):
        nxt: set[str] = set()
        for u in sorted(frontier):
            for v in _neighbours(d, u, direction):
                if depth[u] + 1 > depth.get(v, -1):
                    depth[v] = depth[u] + 1
                    nxt.add(v)
        frontier = nxt
        if not frontier:
            return depth
    raise GraphError(f"type graph has a cycle reachable from {root!r}")


def topology_order(d: Dictionary, root: str, direction: str) -> list[str]:
    """Root first, then reachable labels in topological order."""
    depth = topology_depths(d, root, direction)
    return sorted(depth, key=lambda lbl: (depth[lbl], lbl))


def upward_path(d: Dictionary, root: str) -> list[str]:
    return topology_order(d, root, UP)


def downward_path(d: Dictionary, root: str) -> list[str]:
    return topology_order(d, root, DOWN)


def bfs_levels(d: Dictionary, root: str) -> dict[str, int]:
    """Breadth-first level of every descendant type of ``root``."""
    if root not in d.node_tables:
        raise GraphError(f"root type {root!r} does not exist in the dictionary")
    level = {root: 0}
    queue = [root]
    while queue:
        u = queue.pop(0)
        for v in _neighbours(d, u, DOWN):
            if v not in level:
                level[v] = level[u] + 1
                queue.append(v)
    return level


def traversal_plan(d: Dictionary, root: str, extra: list[str] | None = None,
                   include_upward: bool = False) -> list[Step]:
    """Ordered visits.

    With ``include_upward``: the upward path (root included), then the extra
    types in the given order, then the downward path without the root.
    Without it: the downward path from the root only; extras are ignored.
    """
    extra = list(extra or [])
    for lbl in extra:
        if lbl not in d.node_tables:
            raise GraphError(f"extra type {lbl!r} does not exist in the dictionary")
    if not include_upward:
        labels = [(DOWN, lbl) for lbl in downward_path(d, root)]
    else:
        labels = ([(UP, lbl) for lbl in upward_path(d, root)]
                  + [(DOWN, lbl) for lbl in extra]
                  + [(DOWN, lbl) for lbl in downward_path(d, root)[1:]])
    return [Step(i, way, lbl) for i, (way, lbl) in enumerate(labels)]


def record_ranks(plan: list[Step]) -> dict[str, int]:
    """Output rank per label: parents always before children (O1).

    Upward labels come first, farthest ancestor first; then extras and the
    downward path in visit order.  A label met twice keeps its upward rank if
    it has one, else its last downward visit, which is its downward-path
    position when it is on that path, else its extra position.
    """
    up = [s.label for s in plan if s.way == UP]
    seq = list(reversed(up)) + [s.label for s in plan if s.way == DOWN]
    pos: dict[str, int] = {}
    for i, lbl in enumerate(seq):
        if i < len(up):
            pos[lbl] = i
        elif lbl not in up:
            pos[lbl] = i
    # dense ranks 0..n-1 in position order
    return {lbl: r for r, lbl in enumerate(sorted(pos, key=pos.__getitem__))}
