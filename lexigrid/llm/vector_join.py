"""Near duplicates among vectors of one label: an exact metric range join under the angle between them.

Vectors link if they have the same label and their cosine, in double precision, is `cosine` or more. Equal vectors of a label are one
node, which counts its copies. Angles are a metric. The nodes of a label are a cell; a cell with more than `CELL` nodes is partitioned
by pivots drawn from it. A node's home is at its nearest pivot: in the pivot's ball, if the angle between them is at most half the
range, else in its shell. Where a node can have partners in another home it goes there as a visitor: by the triangle inequality only
if its angle to that pivot is at most the one to its own plus twice the range, and within the range of the angles that the other home
holds. Of two homes the earlier one sends the visitors, so a pair meets once. All nodes of a ball are in range of each other, and a
visitor whose angle and the other home's radius add up to the range is in range of all of it: such links are counted by sums, so a large
group of near copies is never compared pair by pair. Cells that are still too large are partitioned again, up to a bounded number of
pivots a round. Then cells join independently, home by home and home by visitors, in blocks of at most `CELL` by `CELL` nodes. A
block returns how many vectors each node is linked to and a spanning forest of the links, never all pairs.

Where shells do not divide a cell (vectors in many dimensions that are all far from each other: every shell is in reach of every other),
they stay one cell, and its blocks compare all of its pairs; the join stays exact, which then costs time, never memory.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and vectors without a label, link with
nothing; nor do vectors of different lengths. Rows of equal vec_id are rows of their own. A null vec_id never names a component
unless all of its members have none, and is counted as a partner like any other. An empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import stored
from lexigrid.llm.components import component_labels

#: Nodes of a cell, and of either side of a block.
CELL = 4096
#: Pivots of a cell that is partitioned, at most, and of all cells that are partitioned in one round.
PIVOTS, ROUND_PIVOTS = 64, 8192
#: Slack of bounds on angles, far above what rounding does to them.
SLACK = 1e-6
#: A cell whose balls take a smaller share and whose shells do not divide it is joined as it is.
SHARE = 0.1

#: Cells of balls have negative numbers. home: null marks a visitor that is in range of the whole cell. kind: 0 from a ball, 1 from a
#: shell, 2 a visitor before.
NODE = "node long, cell long, home boolean, kind int, angle double, n long, vector array<double>"
_NODE = pa.schema([
    ("node", pa.int64()), ("cell", pa.int64()), ("home", pa.bool_()), ("kind", pa.int32()), ("angle", pa.float64()), ("n", pa.int64()), ("vector", pa.list_(pa.float64()))
])
LINK = "a long, b long, n long"


def _vectors(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector"))


def nodes(vectors: DataFrame) -> DataFrame:
    """node, label, vector, n (rows that hold it) and first (smallest vec_id) of each distinct vector that can link."""
    usable = F.expr(
        "label is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(vector, x -> x <> 0)"
    )
    found = _vectors(vectors).filter(usable).groupBy("label", "vector").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    return stored(found.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of a column whose vectors have one length."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches with vectors of one cell."""
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.take(pa.array(np.argsort(batch.column("cell").to_numpy(), kind="stable")))
        cell = batch.column("cell").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def _placed(part: pa.RecordBatch, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Angles to the pivots, and the place of the home: balls come first, then shells."""
    angle = np.arccos(np.clip(_matrix(part.column("vector")) @ pivots.T, -1, 1))
    near = angle.argmin(axis=1)
    return angle, near + len(pivots) * (angle[np.arange(len(near)), near] > reach / 2 - SLACK)


def _numbers(first: int, n: int) -> np.ndarray:
    """Cell numbers of n balls and n shells."""
    return np.concatenate((-(first + np.arange(n)), first + n + np.arange(n)))


def _homes(pivots, reach: float):
    """Home nodes of the partitioned cells, in their new cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_cell(batches):
            first, centres = pivots.value[part.column("cell")[0].as_py()]
            angle, place = _placed(part, centres, reach)
            cell = _numbers(first, len(centres))[place]
            own = angle[np.arange(len(place)), place % len(centres)]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(cell), part.column("home"), part.column("kind"), pa.array(own), part.column("n"), part.column("vector")], schema=_NODE)

    return run


def _visits(pivots, bounds, reach: float):
    """Visitors of the new cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_cell(batches):
            first, centres = pivots.value[part.column("cell")[0].as_py()]
            angle, place = _placed(part, centres, reach)
            cells = _numbers(first, len(centres))
            low, high, met = bounds.value[part.column("cell")[0].as_py()]
            least, angle = angle.min(axis=1, keepdims=True), np.concatenate((angle, angle), axis=1)
            go = (angle <= least + 2 * reach + SLACK) & (angle <= high + reach + SLACK) & (angle >= low - reach - SLACK)
            home = part.column("home").to_numpy(zero_copy_only=False).astype(bool)
            go &= ~home[:, None] | (np.arange(len(cells)) > place[:, None])
            ball = np.flatnonzero(home & (place < len(centres)))
            go[ball, : len(centres)] &= ~met[place[ball]]
            row, to = np.nonzero(go)
            all_of_it = angle[row, to] + high[to] <= reach - SLACK
            kind = np.where(home, np.where(place < len(centres), 0, 1), 2)
            for at in range(0, len(row), 8192):
                r, t, sure = (x[at : at + 8192] for x in (row, to, all_of_it))
                kept = part.take(pa.array(r))
                yield pa.RecordBatch.from_arrays(
                    [kept.column("node"), pa.array(cells[t]), pa.array(np.zeros(len(r), bool), mask=sure), pa.array(kind[r].astype(np.int32)), pa.array(angle[r, t]), kept.column("n"), kept.column("vector")], schema=_NODE
                )

    return run


def _balls_in_range(centres: np.ndarray, radius: np.ndarray, reach: float) -> np.ndarray:
    """Which balls lie wholly in range of which others; the radius of an empty ball is -inf."""
    angle = np.arccos(np.clip(centres @ centres.T, -1, 1))
    met = (angle + radius[:, None] + radius[None] <= reach - SLACK) & np.isfinite(radius)[:, None] & np.isfinite(radius)[None]
    np.fill_diagonal(met, False)
    return met


def _ball_links(first: int, met: np.ndarray, known: dict) -> list[tuple[int, int, int]]:
    """For each ball that lies in range of others: its cell, the vectors of those, and a node that joins all balls so linked."""
    root, row, root2, column = _forest(met)
    to = dict(zip([*row.tolist(), *column.tolist()], [*root.tolist(), *root2.tolist()]))
    out = []
    for i in np.flatnonzero(met.any(axis=1)).tolist():
        others = [known[-(first + j)] for j in np.flatnonzero(met[i]).tolist()]
        out.append((-(first + i), sum(r.links for r in others), known[-(first + to[i])].anchor))
    return out


def _star(frame: DataFrame) -> DataFrame:
    """Links of nodes that are in range of a whole cell: frame has node, links (vectors of the cell) and anchor (one of its nodes)."""
    ends = F.explode(F.array(F.struct(F.lit(-1).cast("long").alias("b"), F.col("links").alias("n")), F.struct(F.col("anchor").alias("b"), F.lit(0).cast("long").alias("n"))))
    return frame.select(F.col("node").alias("a"), ends.alias("x")).select("a", "x.*").filter("a != b")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _drawn(cells: DataFrame, large: dict[int, int], limit: int) -> dict[int, list]:
    """Some home nodes of each cell, the same ones whenever it is run: a small part of a large cell, chosen by hash."""
    spark = cells.sparkSession
    share = [(c, min(PIVOTS, max(2, -(-2 * n // limit))) / n) for c, n in large.items()]
    chosen = cells.filter("home").join(F.broadcast(spark.createDataFrame(share, "cell long, share double")), "cell")
    # twice the share, as a draw may fall short: some 2 * ROUND_PIVOTS rows in all
    rows = chosen.filter(F.pmod(F.xxhash64("node", "cell"), F.lit(1 << 30)) < F.col("share") * 2 * (1 << 30)).select("cell", "node", "vector").collect()
    out: dict[int, list] = {c: [] for c in large}
    for r in sorted(rows, key=lambda r: r.node):
        out[r.cell].append(r.vector)
    return {c: vectors[: 2 * PIVOTS] for c, vectors in out.items() if vectors}


def _partitioned(cells: DataFrame, reach: float, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """Cells of at most `limit` home nodes, but for balls and cells that pivots do not divide; links that sums have found."""
    spark, links = cells.sparkSession, []
    number = (cells.agg(F.max("cell")).first()[0] or 0) + 1
    closed: list[int] = []
    while True:
        sizes = cells.filter("cell > 0").groupBy("cell").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visits"))
        sizes = sizes.filter((F.col("homes") > limit) & ~F.col("cell").isin(closed) if closed else F.col("homes") > limit)
        rows = {r.cell: r for r in sizes.orderBy(F.desc("homes"), "cell").limit(ROUND_PIVOTS // PIVOTS).collect()}
        if not rows:
            return cells, links
        drawn = _drawn(cells, {c: r.homes for c, r in rows.items()}, limit)
        closed += [c for c in rows if c not in drawn]
        if not drawn:
            continue
        pivots = {}
        for c, vectors in drawn.items():
            pivots[c] = (number, _matrix(pa.array(vectors, pa.list_(pa.float64()))))
            number += 2 * len(vectors)
        sent = spark.sparkContext.broadcast(pivots)
        source = cells.filter(F.col("cell").isin(list(pivots))).select(*_NODE.names)
        homes = stored(source.filter("home").mapInArrow(_homes(sent, reach), NODE), "homes")
        # a row for each new cell
        facts = homes.groupBy("cell").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("links"), F.min("node").alias("anchor")).collect()
        known = {r.cell: r for r in facts}
        bounds, pairs = {}, []
        for c, (first, centres) in pivots.items():
            low, high = np.array([(known[x].low, known[x].high) if x in known else (math.inf, -math.inf) for x in _numbers(first, len(centres)).tolist()]).T
            bounds[c] = low, high, _balls_in_range(centres, high[: len(centres)], reach)
            pairs += _ball_links(first, bounds[c][2], known)
        visits = stored(source.mapInArrow(_visits(sent, spark.sparkContext.broadcast(bounds), reach), NODE), "visits")
        visitors = {r.cell: r["count"] for r in visits.filter("not home").groupBy("cell").count().collect()}

        fate, size = [], {r.cell: r.size for r in facts}
        for c, (first, centres) in pivots.items():
            new = [x for x in _numbers(first, len(centres)).tolist() if x in size]
            work = sum(size[x] * (size[x] / 2 * (x > 0) + visitors.get(x, 0)) for x in new)
            divided = 2 * work <= rows[c].homes * (rows[c].homes / 2 + rows[c].visits)
            fate += [(x, x if divided or x < 0 else number) for x in new]
            if not divided:
                if sum(size[x] for x in new if x < 0) < SHARE * rows[c].homes:
                    closed.append(number)
                number += 1
        fates = F.broadcast(spark.createDataFrame(fate, "cell long, to long"))
        whole = F.broadcast(spark.createDataFrame([(r.cell, r.links, r.anchor) for r in facts], "cell long, links long, anchor long"))
        other = F.broadcast(spark.createDataFrame(pairs, "cell long, links long, anchor long"))
        one = F.col("to") == F.col("cell")

        def moved(frame: DataFrame, one: Column = one, fates: DataFrame = fates) -> DataFrame:
            return frame.join(fates, "cell").select("node", F.col("to").alias("cell"), "home", "kind", F.when(one, F.col("angle")).alias("angle"), "n", "vector", one.alias("one"))

        come = moved(visits)
        sure = come.filter("one and home is null")
        # balls; balls in range of whole balls; visitors in range of a whole cell; and that cell's nodes, all in range of such visitors
        links.append(_star(homes.filter("cell < 0").join(whole, "cell").select("node", (F.col("links") - F.col("n")).alias("links"), "anchor")))
        links.append(_star(homes.join(other, "cell").select("node", "links", "anchor")))
        links.append(_star(sure.join(whole, "cell").select("node", "links", "anchor")))
        met = sure.groupBy("cell").agg(F.sum("n").alias("links"), F.min("node").alias("anchor"))  # at most a row a new cell
        links.append(_star(homes.join(F.broadcast(met), "cell").select("node", "links", "anchor")))
        once = come.filter("not one and kind != 1").withColumn("home", F.lit(False)).dropDuplicates(["node", "cell"])
        new = _union([moved(homes), come.filter("one and not home"), once]).drop("one")
        cells = cells.filter(~F.col("cell").isin(list(pivots))).unionByName(stored(new, "cells"))


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spanning forest of a link matrix: root and row, root and column, where a root is a row."""
    rows, columns = linked.any(axis=1), linked.any(axis=0)
    row_root, column_root = np.full(len(rows), -1), np.full(len(columns), -1)
    for start in np.flatnonzero(rows).tolist():
        if not rows[start]:
            continue
        front = np.array([start])
        rows[start] = False
        while len(front):
            left = np.flatnonzero(columns)
            reached = left[linked[np.ix_(front, left)].any(axis=0)]
            columns[reached] = False
            column_root[reached] = start
            over = np.flatnonzero(rows)
            front = over[linked[np.ix_(over, reached)].any(axis=1)]
            rows[front] = False
            row_root[front] = start
    i, j = np.flatnonzero(row_root >= 0), np.flatnonzero(column_root >= 0)
    return row_root[i], i, column_root[j], j


def _in_range(x: np.ndarray, y: np.ndarray, x_angle: np.ndarray, y_angle: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of x and y are in range; both are sorted by the angle to one pivot, which is NaN where there is none."""
    reach, out = math.acos(cosine), np.zeros((len(x), len(y)), bool)
    bounded = not (np.isnan(x_angle).any() or np.isnan(y_angle).any())
    for at in range(0, len(x), 512):
        strip, angle = x[at : at + 512], x_angle[at : at + 512]
        a, b = np.searchsorted(y_angle, [angle[0] - reach - SLACK, angle[-1] + reach + SLACK]) if bounded else (0, len(y))
        out[at : at + 512, a:b] = strip @ y[a:b].T >= cosine
    return out


def _joined(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        keys = ("cell", "i", "j", "side", "angle")
        table = table.sort_by([(k, "ascending") for k in keys])
        cell, i, j = (table.column(c).to_numpy() for c in keys[:3])
        cuts = [0, *(np.flatnonzero((np.diff(cell) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1).tolist(), table.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            unit = table.slice(a, b - a)
            side, node, n, angle = (unit.column(c).to_numpy() for c in ("side", "node", "n", "angle"))
            x, weight = _matrix(unit.column("vector").combine_chunks()), n.astype(np.float64)
            if side[0] == 2:  # a block with itself
                linked = _in_range(x, x, angle, angle, cosine)
                np.fill_diagonal(linked, False)
                left, right, near = node, node, linked @ weight
            else:
                cut = int(np.searchsorted(side, 1))
                linked = _in_range(x[:cut], x[cut:], angle[:cut], angle[cut:], cosine)
                left, right, near = node[:cut], node[cut:], np.concatenate((linked @ weight[cut:], weight[:cut] @ linked))
            root, row, root2, column = _forest(linked)
            some, none = near > 0, np.zeros(len(root) + len(root2), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((node[some], left[root], left[root2]))),
                    pa.array(np.concatenate((np.full(int(some.sum()), -1), left[row], right[column]))),
                    pa.array(np.concatenate((near[some].astype(np.int64), none))),
                ],
                ["a", "b", "n"],
            )

    return run


def vector_links(found: DataFrame, cosine: float = 0.93, cell_limit: int = CELL) -> DataFrame:
    """(a, b, n) for nodes: with b = -1, n of the vectors that node a is linked to, to be summed; else a link of a spanning forest."""
    spark, reach = found.sparkSession, math.acos(cosine)
    sized = found.withColumn("size", F.size("vector"))
    labels = stored(sized.groupBy("label", "size").count().select("label", "size", (F.monotonically_increasing_id() + 1).alias("cell")), "labels")
    first = sized.join(labels, ["label", "size"]).select("node", "cell", F.lit(True).alias("home"), F.lit(0).alias("kind"), F.lit(None).cast("double").alias("angle"), "n", "vector")
    cells, links = _partitioned(stored(first, "cells"), reach, cell_limit)
    blocks = cells.groupBy("cell").agg(
        F.ceil(F.count_if("home") / cell_limit).cast("int").alias("homes"), F.ceil(F.count_if(~F.col("home")) / cell_limit).cast("int").alias("visits")
    ).filter("homes > 0")
    dealt = cells.join(blocks, "cell").withColumn("block", F.expr("cast(if(home, pmod(xxhash64(node), homes), pmod(xxhash64(node), visits)) as int)"))
    # home blocks with themselves (side 2; none in balls), pairs of home blocks, and home blocks (side 0) with visitors' blocks (side 1)
    units = F.expr("""
        if(home,
           concat(if(cell < 0, array(), concat(
                      array(named_struct('i', block, 'j', block, 'side', 2)),
                      transform(filter(sequence(0, homes - 1), k -> k > block), k -> named_struct('i', block, 'j', k, 'side', 0)),
                      transform(filter(sequence(0, homes - 1), k -> k < block), k -> named_struct('i', k, 'j', block, 'side', 1)))),
                  transform(filter(sequence(0, visits), k -> k < visits), k -> named_struct('i', block, 'j', homes + k, 'side', 0))),
           transform(sequence(0, homes - 1), k -> named_struct('i', k, 'j', homes + block, 'side', 1)))
    """)
    spread = dealt.select("cell", "node", F.coalesce("angle", F.lit(float("nan"))).alias("angle"), "n", "vector", F.explode(units).alias("u"))
    spread = spread.select("cell", "u.*", "node", "angle", "n", "vector")
    parts = max(spark.sparkContext.defaultParallelism, -(-cells.count() // (4 * cell_limit)))
    compared = spread.repartition(parts, "cell", "i", "j").mapInArrow(_joined(cosine), LINK)
    return _union([compared, *links])


def vector_groups(vectors: DataFrame, cosine: float = 0.93, cell_limit: int = CELL) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable) and kept of every row of `vectors`."""
    found = nodes(vectors)
    links = stored(vector_links(found, cosine, cell_limit), "links")
    near = links.filter("b = -1").groupBy("a").agg(F.sum("n").alias("near")).withColumnRenamed("a", "node")
    labels = component_labels(links.filter("b >= 0").select("a", "b")).withColumnRenamed("label", "of")
    named = found.join(labels, "node", "left").withColumn("of", F.coalesce("of", "node"))
    smallest = named.groupBy("of").agg(F.min("first").alias("component_id"))
    facts = named.join(smallest, "of").join(near, "node", "left").select(
        "label", "vector", "component_id", (F.coalesce("near", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    component = F.when(F.col("n_links").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return _vectors(vectors).join(facts, ["label", "vector"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
