"""A sample whose shares match target proportions in several dimensions at once.

Hierarchical top-down allocation over the category tree (one level per dimension). A node splits its quota over
its children in proportion to their rows times the factors of the categories below them. What a child cannot
hold is unmet and goes to its siblings; what they cannot hold either is not given to their parent at all but to
its siblings, so to cousins. After a pass, a category that is still short gets a larger factor and one that has
too much a smaller one, and the tree is passed again; so unmet quota of one category reaches those cousins that
hold it. The last pass gives whole rows by largest remainder. Only the few rows that rounding leaves in the
wrong category are moved between leaves afterwards. The leaves draw by permuted rank.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.cap import apportion
from millrace.llm.draw import permuted_prefix
from millrace.session import durable

OTHER = "other"


#: Passes over the tree at most, and the change of the factors below which the passes end.
PASSES, SETTLED = 600, 1e-6


def _fill(total: float, weight: np.ndarray, room: np.ndarray) -> np.ndarray:
    """total split by weight, nowhere more than room; what one cannot hold goes to the others."""
    out = np.zeros(len(weight))
    free = room > 0
    left = min(total, float(room.sum()))
    while left > 1e-9 and free.any():
        w = np.where(free, weight, 0.0)
        if w.sum() <= 0:
            w = np.where(free, room, 0.0)
        give = left * w / w.sum()
        full = free & (out + give >= room - 1e-12)
        if not full.any():
            return out + give
        left -= float((room - out)[full].sum())
        out[full] = room[full]
        free &= ~full
    return out


class _Tree:
    """The leaves in order, with their ancestors of each level as ranges of leaves."""

    def __init__(self, leaves: dict[tuple, int]) -> None:
        self.names = sorted(leaves)
        self.have = np.array([leaves[x] for x in self.names], np.int64)
        self.depth = len(self.names[0])

    def children(self, lo: int, hi: int, level: int) -> list[tuple[int, int]]:
        cuts = [lo, *[k for k in range(lo + 1, hi) if self.names[k][level] != self.names[k - 1][level]], hi]
        return list(zip(cuts, cuts[1:], strict=False))

    def down(self, n: float, weight: np.ndarray, split) -> np.ndarray:
        """The quota of every leaf if each node splits its own over its children by split(quota, weights, room)."""
        out = np.zeros(len(self.names))
        todo = [(0, len(self.names), 0, n)]
        while todo:
            lo, hi, level, q = todo.pop()
            if level == self.depth:
                out[lo] = q
                continue
            kids = self.children(lo, hi, level)
            room = np.array([self.have[a:b].sum() for a, b in kids], float)
            take = split(q, np.array([weight[a:b].sum() for a, b in kids]), room)
            todo += [(a, b, level + 1, t) for (a, b), t in zip(kids, take, strict=True) if t > 0]
        return out


def allocate(leaves: dict[tuple, int], targets: list[dict[str, float]], minimums: list[dict[str, int]], n: int) -> tuple[dict[tuple, int], int]:
    """(quota of every leaf, rows moved at the end): each quota is at most what the leaf has, in all min(n, all rows).

    leaves: rows by category tuple. targets and minimums: by level, by category; a category that is missing
    there has target 0 and gets rows only where nothing else is left.
    """
    n = min(n, sum(leaves.values()))
    if not leaves or n <= 0:
        return dict.fromkeys(leaves, 0), 0
    tree = _Tree(leaves)
    names, have = tree.names, tree.have
    cats = [(d, c) for d in range(tree.depth) for c in sorted({x[d] for x in names})]
    member = np.array([[x[d] == c for d, c in cats] for x in names], bool)
    avail = member.T.astype(np.int64) @ have
    want = np.array([n * targets[d].get(c, 0.0) for d, c in cats])
    floor = np.minimum([minimums[d].get(c, 0) for d, c in cats], avail)
    # What a category cannot reach goes to the others of its level in proportion; categories without target come last.
    aim = np.zeros(len(cats))
    for d in range(tree.depth):
        own = np.array([k == d for k, _ in cats])
        aim[own] = _fill(float(n), np.maximum(want, floor)[own], avail[own].astype(float))
    factor = np.where(aim > 0, 1.0, 1e-9)
    level = np.array([d for d, _ in cats])
    settled = 0
    for k in range(PASSES):
        leaf = have * np.prod(np.where(member, factor, 1.0), axis=1)
        total = member.T @ tree.down(float(n), leaf, _fill)
        # One level at a time, else two of them would mend the same error twice.
        change = np.where((aim > 0) & (level == k % tree.depth), np.clip(aim / np.maximum(total, 1e-9), 0.2, 5.0), 1.0)
        factor = np.clip(factor * change, 1e-9, 1e9)
        settled = settled + 1 if np.abs(np.log(change)).max() < SETTLED else 0
        if settled >= tree.depth:
            break
    leaf = have * np.prod(np.where(member, factor, 1.0), axis=1)
    exact = tree.down(float(n), leaf, _fill)
    # The weights of the last pass are the settled quotas; whole rows by largest remainder at every node.
    got = tree.down(n, exact, lambda q, w, room: apportion(int(q), room.astype(np.int64), w)).astype(np.int64)
    moved = _settle_last(got, have, member, want, floor, n)
    return dict(zip(names, got.tolist(), strict=True)), moved


def _settle_last(got: np.ndarray, have: np.ndarray, member: np.ndarray, want: np.ndarray, floor: np.ndarray, n: int) -> int:
    """Moves rows between leaves while the error of the shares falls; in place. Returns the number of rows moved."""
    ints = member.astype(np.int64)
    heavy = 1e6  # a missing row of a minimum outweighs any error of the shares
    cost = lambda t: np.abs(t - want).sum(axis=-1) + heavy * np.maximum(floor - t, 0).sum(axis=-1)
    total, moved = ints.T @ got, 0
    step = 1 << max(0, int(n).bit_length() - 6)
    while step:
        a, b = np.flatnonzero(got >= step), np.flatnonzero(have - got >= step)
        best, move = cost(total) - 1e-9, None
        for x in a:
            c = cost(total - step * ints[x] + step * ints[b]) if len(b) else np.zeros(0)
            if len(b) and c.min() < best:
                best, move = float(c.min()), (x, b[int(c.argmin())])
        if move is None:
            step //= 2
            continue
        got[move[0]] -= step
        got[move[1]] += step
        total = ints.T @ got
        moved += step
    return moved


def _quotas(df: DataFrame, dims: list[str], targets: DataFrame, rate: float):
    rows = [r.asDict() for r in targets.select("dim", "category", "target_share", "min_rows").collect()]  # one row per category
    share = [{r["category"]: r["target_share"] or 0.0 for r in rows if r["dim"] == d and r["category"] is not None} for d in dims]
    least = [{r["category"]: r["min_rows"] or 0 for r in rows if r["dim"] == d and r["category"] is not None} for d in dims]
    folded = [F.when(F.col(d).isin(list(s)), F.col(d)).otherwise(F.lit(OTHER)) if s else F.lit(OTHER) for d, s in zip(dims, share, strict=True)]
    counts = df.groupBy(*[f.alias(d) for f, d in zip(folded, dims, strict=True)]).agg(F.count(F.lit(1)).alias("_n")).collect()
    leaves = {tuple(r[d] for d in dims): r["_n"] for r in counts}
    n = int(sum(leaves.values()) * rate)
    return share, least, folded, leaves, *allocate(leaves, share, least, n)


def sample_to_targets(df: DataFrame, key: Column, dims: list[str], targets: DataFrame, rate: float, seed: int = 7) -> DataFrame:
    """A share `rate` of the rows of df (rounded down), all columns, drawn so that each dimension's shares match.

    targets: dim, category, target_share, min_rows. A category without target, or null, counts as `other`
    with target 0 and is drawn only where nothing else is left. key must be unique for an exact size; rows
    with equal keys share their place in the permutation, ties taken in any order. Same seed and rows, same
    sample. An empty table gives an empty sample.
    """
    df = durable(df)  # read for the counts and for the draw
    _, _, folded, _, quota, _ = _quotas(df, dims, targets, rate)
    named = df.withColumn("_draw_leaf", F.concat_ws("\x1f", *folded))
    return permuted_prefix(named, "_draw_leaf", key, {"\x1f".join(k): v for k, v in quota.items()}, seed).drop("_draw_leaf")


def target_report(df: DataFrame, dims: list[str], targets: DataFrame, rate: float) -> DataFrame:
    """Per dim and category: target_share, min_rows, available, drawn, actual_share, shortfall (rows missing to target or minimum), and moved_last, how many of all rows were moved between leaves after the tree was passed.

    The counts are those of sample_to_targets with the same arguments, which draws each leaf's quota exactly.
    Categories that stand only in the data are reported with target 0.
    """
    share, least, _, leaves, quota, moved = _quotas(df, dims, targets, rate)
    n = sum(quota.values())
    out = []
    for k, d in enumerate(dims):
        for c in sorted({*share[k], *(x[k] for x in leaves)}):
            have = sum(v for x, v in leaves.items() if x[k] == c)
            got = sum(v for x, v in quota.items() if x[k] == c)
            want = max(round(n * share[k].get(c, 0.0)), least[k].get(c, 0) if n else 0)
            out.append((d, c, float(share[k].get(c, 0.0)), int(least[k].get(c, 0)), have, got, got / n if n else 0.0, max(0, want - got), moved))
    return df.sparkSession.createDataFrame(out, "dim string, category string, target_share double, min_rows int, available long, drawn long, actual_share double, shortfall long, moved_last long")
