"""Cover trees over bounded blocks of rows, for searches by inner product.

A row x is given one more entry, sqrt(M^2 - |x|^2) with M the largest length in the block.
All rows then have length M, and with a 0 added to a query q, |q - x|^2 = |q|^2 + M^2 - 2 q.x:
a larger inner product is a smaller distance. A node stands for rows within its covering
radius of its centre, so the centre's distance bounds the inner products of all of them.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Callable
from dataclasses import asdict, dataclass

import numpy as np

#: Rows of a node that are verified one by one instead of being split.
LEAF = 16
#: Stands for no inner product; those that occur are less than 2^62 in size.
NONE = -(1 << 62) - 1
NO_ID = np.iinfo(np.int64).max
#: Room for rounding, as a share of the squared lengths.
SLACK = 1e-9


@dataclass
class Tree:
    """Rows in the order of the nodes that verify them, and the nodes.

    Node k verifies rows[own[k]:own[k + 1]]; its children are the nodes
    child[k]:child[k] + children[k]. `pure` marks nodes all of whose rows have
    label[k]. Node 0 is the root.
    """

    rows: np.ndarray
    ids: np.ndarray
    marks: np.ndarray
    labels: np.ndarray
    square: np.ndarray  # M^2, of one entry
    centre: np.ndarray
    radius: np.ndarray
    own: np.ndarray
    child: np.ndarray
    children: np.ndarray
    pure: np.ndarray
    label: np.ndarray


def to_bytes(arrays) -> bytes:
    """A Tree or Queries as bytes; whole numbers are stored as small as they fit."""
    held = {}
    for name, values in asdict(arrays).items():
        if name in ("rows", "vectors") and np.abs(values).max(initial=0) < 1 << 31:
            values = values.astype(np.int32)
        held[name] = values
    out = io.BytesIO()
    np.savez(out, **held)
    return out.getvalue()


def from_bytes(kind, data: bytes):
    with np.load(io.BytesIO(data)) as held:
        made = {name: held[name] for name in held.files}
    for name in {"rows", "vectors"} & made.keys():
        made[name] = made[name].astype(np.int64)
    return kind(**made)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact; in doubles where these hold them."""
    longest = [float((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) for x in (a, b)]
    if longest[0] * longest[1] < 2.0**104:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def build(rows: np.ndarray, ids: np.ndarray, marks: np.ndarray, labels: np.ndarray) -> Tree:
    """The tree of a block; the block's distances are held at once, so it should have a few thousand rows at most."""
    lengths = (rows.astype(np.float64) ** 2).sum(axis=1)
    square = float(lengths.max(initial=0))
    added = np.sqrt(square - lengths)
    near = 2 * square - 2 * (rows.astype(np.float64) @ rows.T.astype(np.float64) + np.outer(added, added))
    np.maximum(near, 0, out=near)

    order: list[np.ndarray] = []
    centre, radius, own, child, children, members_of = [0], [], [0], [], [], [np.arange(len(rows))]
    at = 0
    while at < len(centre):
        members, middle = members_of[at], centre[at]
        away = near[middle, members]
        furthest = float(away.max(initial=0))
        radius.append(np.sqrt(furthest + SLACK * square))
        child.append(len(centre))
        mine = members
        if len(members) > LEAF and furthest > SLACK * square:
            # cover the members by balls of half the radius; the first is the node's own centre
            limit, rest, single = furthest / 4, members, []
            pick = middle
            while len(rest):
                inside = near[pick, rest] <= limit
                group, rest = rest[inside], rest[~inside]
                if len(group) > 1:
                    centre.append(int(pick))
                    members_of.append(group)
                else:
                    single.append(group)
                pick = rest[0] if len(rest) else pick
            mine = np.concatenate(single) if single else members[:0]
        children.append(len(centre) - child[-1])
        order.append(mine)
        own.append(own[-1] + len(mine))
        at += 1
    first = [m[0] if len(m) else 0 for m in members_of]
    pure = [bool(len(m)) and bool((labels[m] == labels[m[0]]).all()) for m in members_of]
    placed = np.concatenate(order)
    place = np.empty(len(rows), np.int64)
    place[placed] = np.arange(len(rows))
    return Tree(
        rows[placed], ids[placed], marks[placed], labels[placed], np.array([square]), place[centre], np.array(radius), np.array(own),
        np.array(child), np.array(children), np.array(pure), labels[first],
    )


def descend(tree: Tree, vectors: np.ndarray, wanted: Callable, verify: Callable) -> None:
    """Best-first descent of many queries at once.

    `wanted(queries, node, low, high)` tells for which of the queries a node may
    still matter whose inner products lie between low and high. `verify(queries,
    start, stop, scores)` is given the exact inner products with rows start:stop. The
    node with the highest bound of any query that wants it comes first.
    """
    if not len(tree.rows) or not len(vectors):
        return
    length = (vectors.astype(np.float64) ** 2).sum(axis=1)
    square = float(tree.square[0])

    def bounds(queries: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = length[queries, None] + square
        exact = products(vectors[queries], tree.rows[tree.centre[nodes]])
        away = np.sqrt(np.maximum(both - 2.0 * exact, 0) + SLACK * both)
        room = SLACK * both + 1
        low = (both - (away + tree.radius[nodes]) ** 2) / 2 - room
        near = np.sqrt(np.maximum(both - 2.0 * exact - SLACK * both, 0)) - tree.radius[nodes]
        return low, (both - np.maximum(near, 0) ** 2) / 2 + room

    everyone = np.arange(len(vectors))
    low, high = bounds(everyone, np.array([0]))
    open_nodes = [(-high.max(), 0, everyone, low[:, 0], high[:, 0])]
    while open_nodes:
        _, node, queries, low, high = heapq.heappop(open_nodes)  # no two entries have the same node
        still = wanted(queries, node, low, high)
        queries = queries[still]
        if not len(queries):
            continue
        start, stop = tree.own[node], tree.own[node + 1]
        if stop > start:
            verify(queries, start, stop, products(vectors[queries], tree.rows[start:stop]))
        if not tree.children[node]:
            continue
        nodes = np.arange(tree.child[node], tree.child[node] + tree.children[node])
        lows, highs = bounds(queries, nodes)
        for k, below in enumerate(nodes):
            still = wanted(queries, below, lows[:, k], highs[:, k])
            if still.any():
                heapq.heappush(open_nodes, (-highs[still, k].max(), int(below), queries[still], lows[still, k], highs[still, k]))


def take_best(scores: np.ndarray, ids: np.ndarray, best: np.ndarray, best_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The highest scores of each row, of new ones and those so far; of equal ones, the smaller ids.

    `scores` has NONE where a pair is out of the question. Rows come back in falling
    order, as many columns as `best` has.
    """
    k = best.shape[1]
    limit = best[:, -1]
    if scores.shape[1] > k:
        limit = np.maximum(limit, np.partition(scores, -k, axis=1)[:, -k])
    who, which = np.nonzero((scores >= limit[:, None]) & (scores != NONE))
    if not len(who):
        return best, best_ids
    n = len(best)
    rows = np.concatenate([who, np.repeat(np.arange(n), k)])
    values = np.concatenate([scores[who, which], best.ravel()])
    names = np.concatenate([ids[which], best_ids.ravel()])
    order = np.lexsort((names, -values, rows))
    starts = np.searchsorted(rows[order], np.arange(n))
    pick = order[starts[:, None] + np.arange(k)]
    return values[pick], names[pick]
