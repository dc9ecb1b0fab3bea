"""Hard negatives by exact inner products, found with cover trees.

Every vector gets one further coordinate that brings it to the same length, so all lie on a
sphere and an inner product with an anchor is a matter of the angle between them. A node of
the tree has a centre and a covering angle; the inner products of all vectors below it lie
between two bounds, and a node whose bounds miss the wanted window is not entered. What is
left is looked at in order of its upper bound, until nothing better can come.

The top of the tree is a net of cells, laid over a bounded sample; every vector is put into
the cell of its nearest centre, and cells are cut into parts of a size that fits in a task,
which have trees of their own. Scores of the sample bound the searches from the start: they
are scores of real rows, so what is below them need not be looked for.

Rows of equal vectors and labels have equal scores for any anchor, so they are one point, and
a search of k rows needs no more than the k smallest ids of it. Anchors that are one point are
searched for once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.text import in_batches
from marquee.operators.joins import lookup_join
from marquee.session import shared_dir

POSITIVES, NEGATIVES = 5, 3
#: A negative's score is at least and at most so many hundredths of the positive's.
LOW, HIGH = 50, 95

#: Points that the cells are laid over; points in a part; most cells.
SAMPLE, PART_POINTS, CELLS = 4_096, 4_096, 1_024
#: Points that a node is not cut below; children of a node; anchors that are searched for together.
LEAF, CHILDREN, TOGETHER = 512, 16, 256

_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
#: Angles and bounds are widened by so much, which is far above what rounding does to them.
_SLACK = 1e-6

_QUERY = "key string, label int, q array<bigint>, windows array<struct<score:bigint,lo:bigint,hi:bigint>>"
_WINDOW = pa.struct([("score", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


# Vectors on the sphere


def on_sphere(x: np.ndarray, length: float) -> np.ndarray:
    """Unit vectors: ``x`` with a last coordinate that brings every row to ``length``, divided by it."""
    if not length:
        return np.hstack([np.zeros_like(x, dtype=np.float64), np.ones((len(x), 1))])
    x = x / length
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))])


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def score_bounds(cosine: np.ndarray, radius: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product within ``radius`` of a centre at this cosine from the anchor's direction.

    ``most`` is the product of the anchor's length and the sphere's radius. What is bounded is
    the cosine of the angle with the radius added and taken off.
    """
    cosine = np.clip(cosine, -1.0, 1.0)
    sine = np.sqrt(1.0 - cosine * cosine)
    spread = np.minimum(np.pi, radius + _SLACK)
    along, across = cosine * np.cos(spread), sine * np.sin(spread)
    slack = 1.0 + _SLACK * most
    low = np.where(cosine <= -np.cos(spread), -1.0, along - across)
    high = np.where(cosine >= np.cos(spread), 1.0, along + across)
    return most * low - slack, most * high + slack


def directions(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors as unit vectors of the sphere's space, and their lengths. The zero vector is as far from all points."""
    lengths = np.sqrt((q * q).sum(axis=1))
    unit = np.hstack([q / np.where(lengths, lengths, 1.0)[:, None], np.zeros((len(q), 1))])
    return unit, lengths


class CoverTree:
    """A tree over the rows of ``x``. A level has centres, covering angles, and which rows lie below.

    The children's centres of a node are its own and then always the row farthest from all,
    until half of the node's angle covers its rows or there are ``CHILDREN`` of them. Angles
    are measured afterwards, so they hold at any level whatever the data.
    """

    def __init__(self, x: np.ndarray):
        self.length = float(np.sqrt((x * x).sum(axis=1)).max(initial=0.0))
        self.unit = on_sphere(x, self.length)
        #: One entry a level: centres, angles, the node of the level above, and the leaf or -1.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.leaves: list[np.ndarray] = []
        nodes = [(0, np.arange(len(x)), -1)] if len(x) else []
        while nodes:
            nodes = self._level(nodes)

    def _level(self, nodes: list[tuple[int, np.ndarray, int]]) -> list[tuple[int, np.ndarray, int]]:
        centres, radii, parents, leaf, below = [], [], [], [], []
        for at, (centre, rows, parent) in enumerate(nodes):
            apart = angles(self.unit[rows], self.unit[centre][None])[:, 0]
            radius = float(apart.max())
            ends = len(rows) <= LEAF or radius <= 1e-7
            centres.append(centre)
            radii.append(radius)
            parents.append(parent)
            leaf.append(len(self.leaves) if ends else -1)
            if ends:
                self.leaves.append(rows)
            else:
                below += [(c, r, at) for c, r in self._split(centre, rows, apart, radius)]
        self.levels.append((np.array(centres), np.array(radii), np.array(parents), np.array(leaf)))
        return below

    def _split(self, centre: int, rows: np.ndarray, apart: np.ndarray, radius: float) -> list[tuple[int, np.ndarray]]:
        chosen, nearest, least = [centre], np.zeros(len(rows), np.int64), apart.copy()
        while len(chosen) < CHILDREN and least.max() > radius / 2:
            far = int(rows[least.argmax()])
            now = angles(self.unit[rows], self.unit[far][None])[:, 0]
            closer = now < least
            least[closer], nearest[closer] = now[closer], len(chosen)
            chosen.append(far)
        return [(c, rows[nearest == n]) for n, c in enumerate(chosen) if (nearest == n).any()]

    def reach(self, unit: np.ndarray, lengths: np.ndarray, lo: np.ndarray, hi: np.ndarray,
              of: np.ndarray) -> np.ndarray:
        """Upper bound of every leaf for every window, -inf where the window is missed.

        ``unit`` and ``lengths`` are the anchors'; window k wants scores from ``lo[k]`` to
        ``hi[k]`` of anchor ``of[k]``.
        """
        found = np.full((len(of), len(self.leaves)), -np.inf)
        alive = np.ones((len(of), 1), bool)
        for depth, (centres, radii, parents, leaf) in enumerate(self.levels):
            entered = alive[:, parents] if depth else alive
            low, high = score_bounds(unit @ self.unit[centres].T, radii, (lengths * self.length)[:, None])
            entered = entered & (high[of] >= lo[:, None]) & (low[of] <= hi[:, None])
            ends = leaf >= 0
            found[:, leaf[ends]] = np.where(entered[:, ends], high[of][:, ends], -np.inf)
            alive = entered
        return found


@dataclass
class Part:
    """The points of one part with their tree. ``exact`` says that doubles hold every score."""

    x: np.ndarray
    labels: np.ndarray
    ids: list[list[int]]
    exact: bool

    def __post_init__(self) -> None:
        self.tree = CoverTree(self.x.astype(np.float64))
        self.values = self.x.astype(np.float64) if self.exact else self.x
        self.first = np.array([i[0] for i in self.ids], np.int64)
        self.kinds, at = np.unique(self.labels, return_inverse=True)
        #: Which labels a leaf has.
        self.held = np.zeros((len(self.tree.leaves), len(self.kinds)), bool)
        for n, rows in enumerate(self.tree.leaves):
            self.held[n, at[rows]] = True

    def best(self, q: np.ndarray, label: np.ndarray, of: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int,
             same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, score and point of the first ``k`` points or more of every window, best first.

        Points have the anchor's label, or with ``same`` false another. Leaves are looked at
        by their upper bound, twice as many each time, until the k-th score is above all.
        """
        unit, lengths = directions(q.astype(np.float64))
        reach = self.tree.reach(unit, lengths, lo, hi, of)
        own = self.kinds[None, :] == label[of][:, None]
        usable = own if same else ~own
        reach[~((usable.astype(np.uint8) @ self.held.T.astype(np.uint8)) > 0)] = -np.inf
        order = np.argsort(-reach, axis=1, kind="stable")
        values = q.astype(self.values.dtype)
        window = score = point = np.zeros(0, np.int64)
        kth = np.full(len(of), -np.inf)
        done, width, n_leaves = 0, 1, len(self.tree.leaves)
        while done < n_leaves:
            next_leaves = order[:, done : done + width]
            bound = np.take_along_axis(reach, next_leaves, axis=1)
            wanted = (bound > -np.inf) & (bound >= kth[:, None])
            if not wanted.any():
                break
            rows, columns = np.nonzero(wanted)
            found = [(window, score, point)]
            leaves = next_leaves[rows, columns]
            by_leaf = np.argsort(leaves, kind="stable")
            starts = np.flatnonzero(np.diff(leaves[by_leaf], prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(by_leaf)]):
                members = self.tree.leaves[leaves[by_leaf[a]]]
                units = rows[by_leaf[a:b]]
                anchors, own_row = np.unique(of[units], return_inverse=True)
                got = values[anchors] @ self.values[members].T
                got = (np.rint(got) if self.exact else got).astype(np.int64)[own_row]
                fits = (self.labels[members][None, :] == label[of[units]][:, None]) == same
                fits &= (got >= lo[units][:, None]) & (got <= hi[units][:, None])
                u, p = np.nonzero(fits)
                found.append((units[u], got[u, p], members[p]))
            window, score, point = (np.concatenate(c) for c in zip(*found))
            window, score, point, kth = self._first(window, score, point, k, len(of))
            done, width = done + width, 2 * width
        return window, score, point

    def _first(self, window: np.ndarray, score: np.ndarray, point: np.ndarray, k: int,
               count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((self.first[point], -score, window))
        window, score, point = window[order], score[order], point[order]
        place = np.arange(len(window)) - np.searchsorted(window, window)
        kth = np.full(count, -np.inf)
        kth[window[place == k - 1]] = score[place == k - 1]
        stay = place < k
        return window[stay], score[stay], point[stay], kth

    def rows(self, keys: list[str], windows: list[list[dict]], q: np.ndarray, label: np.ndarray, k: int,
             same: bool) -> Iterator[tuple]:
        """Key, score that the window is of, score and id of the first ``k`` rows of every window."""
        of = np.repeat(np.arange(len(keys)), [len(w) for w in windows])
        flat = [w for ws in windows for w in ws]
        lo, hi = (np.array([w[e] for w in flat], np.int64) for e in ("lo", "hi"))
        window, score, point = self.best(q, label, of, lo, hi, k, same)
        at = 0
        while at < len(window):
            end = int(np.searchsorted(window, window[at], side="right"))
            listed = sorted((-int(s), i) for s, p in zip(score[at:end], point[at:end]) for i in self.ids[p])
            for negated, i in listed[:k]:
                yield keys[of[window[at]]], flat[window[at]]["score"], -negated, i
            at = end


# Rows


def vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id``, ``label`` and ``q``, whole-numbered vectors, of the rows that take part, each once.

    A row with a null id, label or vector, or with a null in its vector, takes no part. Rows
    of the same id, label and vector are one. ``key`` is the same for the same label and
    vector.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"),
                     F.col(vector_col).cast("array<bigint>").alias("q")).where(
        "id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL AND forall(q, x -> x IS NOT NULL)")
    told = F.concat_ws(":", F.col("label").cast("string"), F.md5(F.concat_ws(",", F.col("q").cast("array<string>"))))
    return rows.withColumn("key", told).distinct()


def points(rows: DataFrame, k: int) -> DataFrame:
    """One row per label and vector, with the ``k`` smallest ids in order."""
    order = Window.partitionBy("key").orderBy("id")
    return (
        rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        .groupBy("key").agg(F.any_value("label").alias("label"), F.any_value("q").alias("q"),
                            F.array_sort(F.collect_list("id")).alias("ids"))
    )


@dataclass
class Net:
    """The cells over a sample, which also bounds searches.

    ``radius`` and ``first_part`` and ``parts`` are by cell; ``dim`` is the length that
    shorter vectors are filled up to with zeros.
    """

    dim: int
    length: float
    exact: bool
    sample: np.ndarray
    sample_labels: np.ndarray
    centres: np.ndarray
    radius: np.ndarray | None = None
    first_part: np.ndarray | None = None
    parts: np.ndarray | None = None


def lay_net(found: DataFrame, sample: int, part_points: int, cells: int) -> Net:
    """Cells over at most ``sample`` points, those of the smallest digests; their number grows with the points."""
    chance = F.xxhash64("key")
    norm = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    count, dim, longest, largest = found.agg(
        F.count("*"), F.max(F.size("q")), F.max(norm),
        F.max(F.array_max(F.transform("q", lambda x: F.abs(x.cast("double")))))).first()
    share = min(1.0, 2.0 * sample / max(1, count))
    drawn = found.where(chance < F.lit(min(_MOST, int(_LEAST + share * 2.0 ** 64)))).orderBy(chance, "key").limit(
        sample).select("label", "q").collect()
    dim = max(1, dim or 0)
    x = np.zeros((len(drawn), dim), np.int64)
    for at, row in enumerate(drawn):
        x[at, : len(row.q)] = row.q
    length = math.sqrt(longest or 0.0)
    unit = on_sphere(x.astype(np.float64), length)
    chosen = [0] if len(unit) else []
    least = angles(unit, unit[:1])[:, 0] if len(unit) else np.zeros(0)
    while chosen and len(chosen) < min(cells, -(-count // part_points)) and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, angles(unit, unit[chosen[-1:]])[:, 0])
    return Net(dim, length, dim * (largest or 0.0) ** 2 < 2.0 ** 53, x,
               np.array([r.label for r in drawn], np.int64), unit[chosen])


def in_cells(found: DataFrame, net: Net) -> DataFrame:
    """Points with the ``cell`` of their nearest centre and how far ``apart`` from it they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = angles(on_sphere(matrix(batch.column("q"), net.dim).astype(np.float64), net.length), net.centres)
            cell = apart.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(apart[np.arange(len(cell)), cell])],
                names=[*batch.schema.names, "cell", "apart"])

    kind = found.schema["ids"].dataType.simpleString()
    return found.select("key", "label", "q", "ids").mapInArrow(
        run, f"key string, label int, q array<bigint>, ids {kind}, cell int, apart double")


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """A column of vectors as rows, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim)[None, :] < lengths[:, None]] = values
    return out


def routed(anchors: DataFrame, net: Net, k: int, same: bool) -> DataFrame:
    """Every anchor once per cell that its windows reach into, with those windows.

    A window's lower end is raised to the k-th score that the sample has in it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from in_batches(rows(batch), _routed_schema, lambda row: 64 + 8 * net.dim + 24 * len(row[4]))

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for at in range(0, batch.num_rows, TOGETHER):
            yield from some_rows(batch.slice(at, TOGETHER))

    def some_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        q, labels = matrix(batch.column("q"), net.dim), batch.column("label").to_numpy()
        keys, windows = batch.column("key").to_pylist(), batch.column("windows").to_pylist()
        unit, lengths = directions(q.astype(np.float64))
        products = _products(net, q)
        lows, highs = score_bounds(unit @ net.centres.T, net.radius, (lengths * net.length)[:, None])
        for at, (key, wanted) in enumerate(zip(keys, windows)):
            scores = np.sort(products[at][(net.sample_labels == labels[at]) == same])
            low, high = lows[at], highs[at]
            sure = []
            for w in wanted:
                within = scores[np.searchsorted(scores, w["lo"]) : np.searchsorted(scores, w["hi"], "right")]
                lo = max(w["lo"], int(within[-k])) if len(within) >= k else w["lo"]
                sure.append((w | {"lo": lo}, (high >= lo) & (low <= w["hi"])))
            for cell in np.flatnonzero(np.any([s for _, s in sure], axis=0)) if sure else ():
                yield int(cell), key, int(labels[at]), q[at], [w for w, s in sure if s[cell]]

    return anchors.select("key", "label", "q", "windows").mapInArrow(run, f"cell int, {_QUERY}")


_routed_schema = pa.schema([("cell", pa.int32()), ("key", pa.string()), ("label", pa.int32()),
                            ("q", pa.list_(pa.int64())), ("windows", pa.list_(_WINDOW))])


def _products(net: Net, q: np.ndarray) -> np.ndarray:
    if net.exact:
        return np.rint(q.astype(np.float64) @ net.sample.T.astype(np.float64)).astype(np.int64)
    return q @ net.sample.T


def searched(placed: DataFrame, anchors: DataFrame, net: Net, k: int, same: bool) -> DataFrame:
    """The first ``k`` rows of every window: ``key``, ``window``, ``score``, ``id`` and ``place``.

    Points and anchors of a part meet in one task, the points first; anchors pass by.
    """
    spark = placed.sparkSession
    table = F.broadcast(spark.createDataFrame(
        [(n, int(f), int(p)) for n, (f, p) in enumerate(zip(net.first_part, net.parts))],
        "cell int, first_part bigint, parts bigint"))  # one row per cell, CELLS at most
    none = F.lit(None)
    part = F.col("first_part") + F.pmod(F.xxhash64("key"), "parts")
    held = placed.join(table, "cell").select(
        part.alias("part"), F.lit(0).alias("turn"), "key", "label", "q", "ids",
        none.cast("array<struct<score:bigint,lo:bigint,hi:bigint>>").alias("windows"))
    asked = routed(anchors, net, k, same).join(table, "cell").select(
        F.explode(F.sequence("first_part", F.col("first_part") + F.col("parts") - 1)).alias("part"),
        F.lit(1).alias("turn"), "key", "label", "q", none.cast(placed.schema["ids"].dataType).alias("ids"), "windows")
    met = held.unionByName(asked).repartition("part").sortWithinPartitions("part", "turn")
    kind = placed.schema["ids"].dataType.elementType.simpleString()
    local = met.mapInArrow(_search(net.dim, net.exact, k, same), f"key string, window bigint, score bigint, id {kind}")
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), "id")
    return local.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _search(dim: int, exact: bool, k: int, same: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pieces, tree, schema = None, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if schema is None:
                ids = batch.schema.field("ids").type.value_type
                schema = pa.schema([("key", pa.string()), ("window", pa.int64()), ("score", pa.int64()), ("id", ids)])
            numbers, turn = batch.column("part").to_numpy(), batch.column("turn").to_numpy()
            cuts = np.flatnonzero(np.diff(numbers) | np.diff(turn)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                some = batch.slice(a, b - a)
                if numbers[a] != part:
                    part, pieces, tree = numbers[a], [], None
                if turn[a] == 0:
                    pieces.append((matrix(some.column("q"), dim), some.column("label").to_numpy(),
                                   some.column("ids").to_pylist()))
                    continue
                if tree is None and pieces:
                    x, labels, ids = zip(*pieces)
                    tree = Part(np.concatenate(x), np.concatenate(labels), [i for some_ids in ids for i in some_ids], exact)
                if tree is None:
                    continue
                for at in range(0, some.num_rows, TOGETHER):
                    few = some.slice(at, TOGETHER)
                    rows = tree.rows(few.column("key").to_pylist(), few.column("windows").to_pylist(),
                                     matrix(few.column("q"), dim), few.column("label").to_numpy(), k, same)
                    yield from in_batches(rows, schema, lambda row: 72)

    return run


def hard_negatives(df: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, sample: int = SAMPLE, part_points: int = PART_POINTS,
                   cells: int = CELLS) -> DataFrame:
    """For every anchor and each of its positives, the best rows of other labels in a window below the positive.

    Vectors are whole numbers and a score is an inner product; higher scores come first, of
    equal ones the smaller id. ``anchor`` says which rows of ``df`` are anchors. An anchor's
    positives are its first ``positives`` rows of the same label and another id. Negatives
    have ``low`` to ``high`` hundredths of the positive's score. A vector that is shorter than
    others counts as filled up with zeros.

    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``; a pair without negatives has no row. Rows that ``vectors`` leaves out
    take no part; rows of one id with unlike vectors are rows of their own, and none is a
    positive of another. ``sample``, ``part_points`` and ``cells`` change the plan, not the
    result.
    """
    shared_dir(df.sparkSession)
    rows = vectors(df, id_col, vector_col, label_col).checkpoint()
    marked = vectors(df.where(anchor), id_col, vector_col, label_col).checkpoint()
    found = points(rows, positives + 1).checkpoint()
    net = lay_net(found, sample, part_points, cells)
    if not len(net.centres):
        kind = rows.schema["id"].dataType.simpleString()
        return df.sparkSession.createDataFrame([], (
            f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score bigint, negative_score bigint"))
    placed = in_cells(found, net).checkpoint()
    sizes = {r.cell: (r.n, r.radius) for r in placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("apart").alias("radius")).collect()}  # one row per cell, CELLS at most
    net.radius = np.array([sizes.get(n, (0, -1.0))[1] for n in range(len(net.centres))])
    net.parts = np.array([max(1, -(-sizes.get(n, (0, 0))[0] // part_points)) for n in range(len(net.centres))])
    net.first_part = np.cumsum(net.parts) - net.parts

    asked = marked.select("key", "label", "q").distinct()
    all_scores = F.array(F.struct(F.lit(0).cast("bigint").alias("score"), F.lit(_LEAST).alias("lo"), F.lit(_MOST).alias("hi")))
    near = searched(placed, asked.withColumn("windows", all_scores), net, positives + 1, True)
    near = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(
        "place", F.col("score").alias("positive_score"), F.col("id").alias("positive_id")))).alias("near")).checkpoint()

    score = F.col("score")
    wanted = near.select("key", F.explode(F.array_distinct("near.positive_score")).alias("score")).select(
        "key", F.struct("score", _hundredths(score, low, True).alias("lo"), _hundredths(score, high, False).alias("hi")
                        ).alias("window")).where("window.lo <= window.hi")
    windows = wanted.groupBy("key").agg(F.collect_list("window").alias("windows"))
    hard = searched(placed, asked.join(windows, "key"), net, negatives, False).groupBy("key").agg(F.collect_list(F.struct(
        F.col("window").alias("positive_score"), F.col("place").alias("rank"), F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"))).alias("hard"))

    told = near.join(hard, "key")
    mined = lookup_join(marked.select("key", F.col("id").alias("anchor_id")), told, "key")
    others = F.slice(F.filter("near", lambda p: p["positive_id"] != F.col("anchor_id")), 1, positives)
    return (
        mined.select("anchor_id", "hard", F.explode(others).alias("positive"))
        .select("anchor_id", F.col("positive.positive_id").alias("positive_id"), F.explode(F.filter(
            "hard", lambda n: n["positive_score"] == F.col("positive.positive_score"))).alias("negative"))
        .select("anchor_id", "positive_id", F.col("negative.rank").cast("int").alias("rank"), "negative.negative_id",
                "negative.positive_score", "negative.negative_score")
    )


def _hundredths(score: Column, share: int, up: bool) -> Column:
    """``share`` hundredths of a whole number, rounded to the next one, without leaving whole numbers."""
    hundred, share = F.lit(100).cast("bigint"), F.lit(share).cast("bigint")
    rest = F.pmod(score, hundred)
    whole = F.call_function("div", score - rest, hundred) * share
    return whole + F.call_function("div", rest * share + (99 if up else 0), hundred)
