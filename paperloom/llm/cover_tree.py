"""Cover trees in numpy and the dual-tree search for the largest inner products.

A node covers its points by a ball around its centre, which is one of its points; the children's centres are a
net of the node's points: each point is within half the node's radius of its centre, and the centres are
further apart than that. Where that takes more than ``CHILDREN`` centres, the balls of so many stay wider. Nodes keep
the true radius of their points, so the bounds hold either way.
"""

from __future__ import annotations

import numpy as np

LEAF = 200
CHILDREN = 64


class Tree:
    """Nodes in arrays: centre point, radius, first child and child count; the points of leaves in ``order``."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.members: list[np.ndarray] = []
        everyone = np.arange(len(points))
        gaps = self._gaps(0, everyone)
        self._grow(0, everyone, gaps)
        self.norm = np.sqrt((points.astype(np.float64) ** 2).sum(axis=1)) if len(points) else np.zeros(0)

    def _gaps(self, centre: int, of: np.ndarray) -> np.ndarray:
        delta = self.points[of] - self.points[centre]
        return np.sqrt(np.einsum("ij,ij->i", delta, delta))

    def _new(self, centre: int, radius: float) -> int:
        self.centre.append(centre)
        self.radius.append(radius)
        self.children.append([])
        self.members.append(np.empty(0, np.int64))
        return len(self.centre) - 1

    def _grow(self, centre: int, members: np.ndarray, gaps: np.ndarray) -> int:
        """Iterative, so that chains of shrinking balls do not meet the recursion limit."""
        root = self._new(centre, float(gaps.max(initial=0.0)))
        todo = [(root, members, gaps)]
        while todo:
            node, members, gaps = todo.pop()
            radius = self.radius[node]
            if len(members) <= LEAF or radius == 0:
                self.members[node] = members
                continue
            reach = radius / 2
            nearest, owner = gaps.copy(), np.full(len(members), self.centre[node])
            net = [self.centre[node]]
            # the centre stays in the net; the first uncovered point joins it until all are covered
            while len(net) < CHILDREN:
                far = int((nearest > reach).argmax())
                if nearest[far] <= reach:
                    break
                other = self._gaps(int(members[far]), members)
                closer = other < nearest
                nearest[closer], owner[closer] = other[closer], members[far]
                net.append(int(members[far]))
            _, sizes = np.unique(owner, return_counts=True)
            if 10 * sizes.max() > 9 * len(members):  # no two points are close: finer balls would hold one point each
                self.members[node] = members
                continue
            for point in net:
                mine = owner == point
                child = self._new(point, float(nearest[mine].max(initial=0.0)))
                self.children[node].append(child)
                todo.append((child, members[mine], nearest[mine]))
        return root


def top_products(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(row of the query, row of the data point, score) for each query's ``k`` best; equal ids never meet.

    Ties go to the smaller data id. Points hold whole numbers; node pairs are dropped only if their bound is
    below the worst kth score of the query node, so ties stay.
    """
    largest = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (queries, data)]
    exact = largest[0] * largest[1] * max(queries.shape[1], 1) < 2**52
    left, right = Tree(queries.astype(np.float64)), Tree(data.astype(np.float64))
    count = len(queries)
    best = np.full((count, k), -np.inf)
    best_ids = np.full((count, k), np.iinfo(np.int64).max)
    best_rows = np.full((count, k), -1)
    best_exact = None if exact else np.full((count, k), None, object)
    todo: list[tuple[int, int]] = [(0, 0)] if count and len(data) else []
    members = [None] * len(left.centre)

    def inside(node: int) -> np.ndarray:
        if members[node] is None:
            kids = left.children[node]
            members[node] = np.concatenate([inside(c) for c in kids]) if kids else left.members[node]
        return members[node]

    def compare(rows: np.ndarray, points: np.ndarray) -> None:
        if exact:
            scores = left.points[rows] @ right.points[points].T
        else:
            wide = queries[rows].astype(object) @ data[points].T.astype(object)
            scores = wide.astype(np.float64)
        same = query_ids[rows][:, None] == data_ids[points][None, :]
        scores = np.where(same, -np.inf, scores)
        better = (scores >= best[rows, -1][:, None]) & (scores > -np.inf)
        for at in np.flatnonzero(better.any(axis=1)).tolist():
            row, line = rows[at], scores[at]
            found = np.flatnonzero(better[at])
            values = np.concatenate([best[row], line[found]])
            ids = np.concatenate([best_ids[row], data_ids[points[found]]])
            places = np.concatenate([best_rows[row], points[found]])
            if best_exact is None:
                order = np.lexsort((ids, -values))[:k]
            else:
                sharp = np.concatenate([best_exact[row], wide[at][found]])
                order = np.array(sorted(range(len(ids)), key=lambda i: (places[i] < 0, -(sharp[i] or 0), ids[i]))[:k])
                best_exact[row] = sharp[order]
            best[row], best_ids[row], best_rows[row] = values[order], ids[order], places[order]

    while todo:
        a, b = todo.pop()
        ca, cb = left.centre[a], right.centre[b]
        ra, rb = left.radius[a], right.radius[b]
        bound = left.points[ca] @ right.points[cb] + ra * right.norm[cb] + rb * left.norm[ca] + ra * rb
        if bound * (1 + 1e-9) + 1e-6 < best[inside(a), -1].min() and bound >= 0:
            continue
        if bound < 0 and bound * (1 - 1e-9) + 1e-6 < best[inside(a), -1].min():
            continue
        kids_a, kids_b = left.children[a], right.children[b]
        if not kids_a and not kids_b:
            compare(left.members[a], right.members[b])
        elif kids_b and (rb >= ra or not kids_a):
            # the most promising child is popped first, so the kth scores rise early
            promise = right.points[[right.centre[c] for c in kids_b]] @ left.points[ca]
            todo += [(a, kids_b[i]) for i in np.argsort(promise, kind="stable")]
        else:
            todo += [(c, b) for c in kids_a]
    out = []
    for row in range(count):
        for place in range(k):
            if best_rows[row, place] >= 0:
                point = int(best_rows[row, place])
                score = int(best[row, place]) if best_exact is None else int(best_exact[row, place])
                out.append((row, point, score))
    return out
