"""Embedding near-duplicates by dual traversal of cover trees.

Vectors of one label are scaled to length one, so that a cosine threshold is a distance. Equal
vectors become one class. Pivots from the upper levels of a cover tree over a bounded sample split
a label into cells; a vector visits another cell only if the plane between the two pivots is
within the threshold distance of it. Inside a task, cover trees with halving radii are traversed
in pairs: a pair of nodes whose covering radii cannot bridge the gap is dropped, a pair that lies
wholly within the threshold is counted without being listed, and the rest is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import components
from shelfcast.settings import settle

# Classes aimed at per cell, pivots of all labels together, sampled classes per pivot.
CELL, MAX_PIVOTS, PER_PIVOT = 4096, 8192, 16
# Members of a node that are compared directly.
LEAF = 24
# Slack of distances; comparisons at the threshold itself use the cosine.
SLACK = 1e-6


@dataclass
class Node:
    center: int
    radius: float
    members: np.ndarray
    children: list[Node] = field(default_factory=list)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ y.T), 0.0))


def cover(points: np.ndarray, members: np.ndarray, center: int, radius: float) -> list[np.ndarray]:
    """Groups around centres at least ``radius`` apart; every member is within it of its centre,
    which comes first. The given centre stays one."""
    rest = np.concatenate([[center], members[members != center]])
    groups = []
    while len(rest):
        head = rest[:64]
        close = _distance(points[head], points[head]) <= radius
        chosen: list[int] = []
        for k in range(len(head)):
            if not close[k, chosen].any():
                chosen.append(k)
        centers = head[chosen]
        gap = _distance(points[rest], points[centers])
        gap[chosen, np.arange(len(chosen))] = 0.0
        near, best = gap.min(axis=1), gap.argmin(axis=1)
        inside = near <= radius
        for k, c in enumerate(centers.tolist()):
            mine = rest[inside & (best == k)]
            groups.append(np.concatenate([[c], mine[mine != c]]))
        rest = rest[~inside]
    return groups


def build(points: np.ndarray, members: np.ndarray | None = None, center: int | None = None) -> Node:
    """Cover tree: a node's children have half its radius, and its centre is one of theirs."""
    members = np.arange(len(points)) if members is None else members
    center = int(members[0]) if center is None else center
    radius = float(_distance(points[members], points[[center]]).max())
    root = Node(center, radius, members)
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.members) <= LEAF or node.radius <= SLACK:
            continue
        half = node.radius / 2
        for group in cover(points, node.members, node.center, half):
            far = float(_distance(points[group], points[group[:1]]).max()) if len(group) > 1 else 0.0
            node.children.append(Node(int(group[0]), far, group))
        todo += [c for c in node.children if len(c.members) > 1]
    return root


class Links:
    """Link counts and spanning links of the classes of one task."""

    def __init__(self, weight: np.ndarray):
        self.weight, self.count = weight, np.zeros(len(weight), np.int64)
        self.parent = np.arange(len(weight))
        self.pairs: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def tie(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.pairs.append((i, j))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.count, i, self.weight[j])
        np.add.at(self.count, j, self.weight[i])
        for a, b in zip(i.tolist(), j.tolist()):
            self.tie(a, b)

    def add_all(self, left: np.ndarray, right: np.ndarray) -> None:
        """All pairs of two member lists (the same list: all pairs within it)."""
        if left is right:
            self.count[left] += self.weight[left].sum() - self.weight[left]
        else:
            self.count[left] += self.weight[right].sum()
            self.count[right] += self.weight[left].sum()
        for k in left[1:].tolist():
            self.tie(int(left[0]), k)
        for k in right.tolist():
            if k != left[0]:
                self.tie(int(left[0]), k)


def traverse(points: np.ndarray, one: Node, two: Node, threshold: float, links: Links) -> None:
    """All pairs between two trees (or within one) with cosine of at least ``threshold``."""
    reach = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold)))
    todo = [(one, two)]
    while todo:
        a, b = todo.pop()
        same = a is b
        gap = 0.0 if same else float(_distance(points[[a.center]], points[[b.center]])[0, 0])
        if gap - a.radius - b.radius > reach + SLACK:
            continue
        if (2 * a.radius if same else gap + a.radius + b.radius) < reach - SLACK:
            links.add_all(a.members, b.members)
            continue
        if not a.children and not b.children:
            _compare(points, a.members, b.members, same, threshold, links)
            continue
        left = a.children if a.children else [a]
        right = left if same else (b.children if b.children else [b])
        lc, rc = np.array([n.center for n in left]), np.array([n.center for n in right])
        lr, rr = np.array([n.radius for n in left]), np.array([n.radius for n in right])
        single_l = np.array([len(n.members) == 1 for n in left])
        single_r = np.array([len(n.members) == 1 for n in right])
        for k in range(0, len(left), 1024):
            part = slice(k, k + 1024)
            cosine = points[lc[part]] @ points[rc].T
            near = np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0)) - lr[part, None] - rr <= reach + SLACK
            if same:
                near &= np.arange(k, k + len(near))[:, None] <= np.arange(len(right))
            i, j = np.nonzero(near)
            plain = single_l[part][i] & single_r[j]
            hit = plain & (cosine[i, j] >= threshold) & (~(same & (i + k == j)))
            links.add(lc[part][i[hit]], rc[j[hit]])
            todo += [(left[x + k], right[y]) for x, y in zip(i[~plain].tolist(), j[~plain].tolist())]


def _compare(points, left, right, same, threshold, links) -> None:
    for k in range(0, len(left), 2048):
        cosine = points[left[k : k + 2048]] @ points[right].T
        hit = cosine >= threshold
        if same:
            hit &= np.arange(k, k + len(hit))[:, None] < np.arange(len(right))
        i, j = np.nonzero(hit)
        links.add(left[k + i], right[j])


def unit_vectors(rows: DataFrame) -> DataFrame:
    """(id, label, unit): double vectors of length one as bytes; null where there is no direction."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            bounds = lists.offsets.to_numpy()
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            bounds = bounds - bounds[0] if len(bounds) else bounds
            out = []
            for i, valid in enumerate(lists.is_valid().to_pylist()):
                v = flat[bounds[i] : bounds[i + 1]]
                top = np.abs(v).max() if valid and len(v) else 0.0
                if not np.isfinite(top) or top == 0.0 or not np.isfinite(v).all():
                    out.append(None)
                    continue
                v = v / top
                out.append((v / np.sqrt(v @ v) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["id", "label", "unit"])

    return rows.mapInArrow(scale, "id long, label string, unit binary")


def _pivots(classes: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """Pivots per label and dimension, from the upper levels of a cover tree over a bounded sample."""
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL)
    sizes = sizes.orderBy(F.desc("n"), "label", "dim").limit(MAX_PIVOTS // 2).collect()
    total = sum(r["n"] for r in sizes)
    if not total:
        return {}
    wanted = {(r["label"], r["dim"]): max(2, min(-(-r["n"] // CELL), MAX_PIVOTS * r["n"] // total)) for r in sizes}
    spark = classes.sparkSession
    share = spark.createDataFrame(
        [(k[0], k[1], min(1.0, 1.5 * PER_PIVOT * v / next(r["n"] for r in sizes if (r["label"], r["dim"]) == k))) for k, v in wanted.items()],
        "label string, dim int, share double",
    )
    rows = classes.join(F.broadcast(share), ["label", "dim"]).filter(F.pmod(F.xxhash64("unit"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    found: dict[tuple[str, int], list[np.ndarray]] = {}
    for r in rows.select("label", "dim", "unit").orderBy("label", "dim", "unit").limit(2 * PER_PIVOT * MAX_PIVOTS).toLocalIterator():
        found.setdefault((r["label"], r["dim"]), []).append(np.frombuffer(bytes(r["unit"])))
    out = {}
    for key, vectors in found.items():
        points = np.array(vectors)
        level = [build(points)]
        while len(level) < wanted[key] and any(n.children for n in level):
            level = [c for n in level for c in (n.children or [n])]
        # The largest nodes of the first level with enough of them.
        level = sorted(level, key=lambda n: (-len(n.members), n.center))[: wanted[key]]
        out[key] = points[[n.center for n in level]]
    return out


def near_groups(
    df: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row.

    Vectors link when their labels are equal and not null, their dimensions equal and their cosine
    in double precision is at least ``threshold``. Null, empty and zero vectors, those with null or
    non-finite components, and rows with a null label or id link with nothing (a null id stays null
    and is not kept). Repeated rows are vectors of their own that link with each other; rows of one
    id share a component. Other columns are ignored. An empty table gives an empty table.
    """
    rows = unit_vectors(
        df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    )
    rows = settle(rows.withColumn("unit", F.when(F.col("id").isNotNull() & F.col("label").isNotNull(), F.col("unit"))), "units")
    classes = rows.filter("unit is not null").groupBy("label", "unit").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"))
    classes = classes.withColumn("dim", (F.length("unit") / 8).cast("int")).withColumn("c", F.xxhash64("label", "unit"))
    classes = settle(classes, "classes")
    found = settle(_dual(classes, threshold), "found")
    counts = found.filter("n is not null").groupBy(F.col("a").alias("c")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("n is null").select("a", "b")).withColumnRenamed("node", "rep")
    # Ids with several vectors tie their classes together.
    ids = rows.filter("unit is not null").groupBy("id").agg(F.count_distinct("unit", "label").alias("kinds")).filter("kinds > 1")
    ties = rows.join(ids, "id", "left_semi").join(classes, ["label", "unit"]).filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    ties = settle(ties.distinct(), "ties")
    if not ties.isEmpty():
        roots = components(roots.select(F.col("rep").alias("a"), F.col("root").alias("b")).union(ties)).withColumnRenamed("node", "rep")
    joined = classes.select("label", "unit", "rep", "m", "c").join(counts, "c", "left").join(roots, "rep", "left")
    joined = joined.select("label", "unit", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component"))
    component = F.coalesce("component", "id")
    return rows.join(joined, ["label", "unit"], "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _dual(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, null): a spanning link of representatives; (class, null, n): link counts."""
    pivots = _pivots(classes)
    reach = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dim = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            unit = batch.column(2)
            row, cell, home = [], [], []
            for key in sorted(set(zip(label, dim))):
                mine = np.array([i for i, k in enumerate(zip(label, dim)) if k == key])
                if key not in pivots:
                    row.append(mine), cell.append(np.zeros(len(mine), np.int64)), home.append(np.ones(len(mine), bool))
                    continue
                p = pivots[key]
                x = np.frombuffer(b"".join(unit[int(i)].as_py() for i in mine)).reshape(len(mine), -1)
                cosine = x @ p.T
                own = cosine.argmax(axis=1)
                between = _distance(p, p)
                # Distance from x to the plane halfway between its pivot and another one.
                plane = (cosine.max(axis=1)[:, None] - cosine) / np.maximum(between[own], 1e-300)
                goes = (plane <= reach + SLACK) & (np.arange(len(p)) > own[:, None])
                i, q = np.nonzero(goes)
                row += [mine, mine[i]]
                cell += [own, q]
                home += [np.ones(len(mine), bool), np.zeros(len(i), bool)]
            if not row:
                continue
            take = pa.array(np.concatenate(row))
            out = [batch.column(k).take(take) for k in range(5)]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(np.concatenate(cell).astype(np.int32)), pa.array(np.concatenate(home))],
                ["label", "dim", "unit", "rep", "m", "cell", "home"],
            )

    placed = classes.select("label", "dim", "unit", "rep", "m").mapInArrow(
        place, "label string, dim int, unit binary, rep long, m long, cell int, home boolean"
    ).withColumn("c", F.xxhash64("label", "unit"))
    placed = settle(placed, "placed")
    key = ["label", "dim", "cell"]
    fan = lambda home: F.ceil(F.count(F.when(F.col("home") == home, 1)) / F.lit(CELL)).cast("int")
    blocks = placed.groupBy(*key).agg(fan(True).alias("own"), fan(False).alias("guests"))
    dealt = placed.join(blocks, key).filter("own > 0")
    mine = F.pmod("c", F.when(F.col("home"), F.col("own")).otherwise(F.greatest(F.col("guests"), F.lit(1)))).cast("int")
    dealt = dealt.withColumn("block", mine)
    # Home blocks meet each other; guest blocks (numbered below zero) meet home blocks.
    others = F.sequence(F.lit(0), F.col("own") - 1)
    as_home = F.concat(
        F.transform(others, lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j"))),
        F.when(F.col("guests") > 0, F.transform(F.sequence(F.lit(1), F.greatest("guests", F.lit(1))), lambda g: F.struct((-g).alias("i"), F.col("block").alias("j"))))
        .otherwise(F.expr("cast(array() as array<struct<i:int,j:int>>)")),
    )
    as_guest = F.transform(others, lambda j: F.struct((-F.col("block") - 1).alias("i"), j.alias("j")))
    dealt = dealt.select("label", "dim", "cell", "unit", "c", "rep", "m", "block", "home", F.explode(F.when(F.col("home"), as_home).otherwise(as_guest)).alias("pair"))
    dealt = dealt.select(*key, "pair.i", "pair.j", "unit", "c", "rep", "m", F.when(F.col("home"), F.col("block")).otherwise(-F.col("block") - 1).alias("block"))

    def join(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        points = np.frombuffer(b"".join(table.column("unit").to_pylist())).reshape(table.num_rows, -1)
        block, rep = table.column("block").to_numpy(), table.column("rep").to_numpy()
        links = Links(table.column("m").to_numpy())
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if i == j:
            tree = build(points, left)
            traverse(points, tree, tree, threshold, links)
        elif len(left) and len(right):
            traverse(points, build(points, left), build(points, right), threshold, links)
        some = np.flatnonzero(links.count)
        a = [*(int(rep[x]) for x, _ in links.pairs), *table.column("c").to_numpy()[some].tolist()]
        b = [*(int(rep[y]) for _, y in links.pairs), *[None] * len(some)]
        n = [*[None] * len(links.pairs), *links.count[some].tolist()]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return dealt.groupBy(*key, "i", "j").applyInArrow(join, "a long, b long, n long")
