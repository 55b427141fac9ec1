"""Similarity join of vectors: epsilon grid order on leading principal axes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import components, stored

#: Vectors of a block at most, and its bytes.
BLOCK_ROWS = 1024
BLOCK_BYTES = 4 << 20
#: Children of a node in the tree of sequence intervals.
FAN_OUT = 16
#: Vectors that the principal axes are fitted on at most. They decide what is pruned, not results.
AXIS_SAMPLE = 2_000
#: Axes longer than this are not fitted; their leading components are used.
AXIS_WIDTH = 4_096


def _axes(unit: DataFrame, n_axes: int) -> dict[int, np.ndarray]:
    """Leading principal axes [width, n_axes] by vector width, from a bounded sample."""
    sizes = unit.filter(F.col("width") <= AXIS_WIDTH).groupBy("width").count()
    widths = sizes.orderBy(F.desc("count"), "width").limit(4).collect()
    found = {}
    for width, n in widths:
        share = min(1.0, AXIS_SAMPLE / n)
        rows = unit.filter(F.col("width") == width)
        if share < 1:
            rows = rows.filter(F.pmod(F.xxhash64("vector", F.lit("axes")), F.lit(1 << 30)) < int(share * (1 << 30)))
        sample = [np.frombuffer(r[0]) for r in rows.select("vector").limit(2 * AXIS_SAMPLE).collect()]
        if len(sample) > 1:
            points = np.stack(sample)
            points = points - points.mean(axis=0)
            found[width] = np.linalg.svd(points, full_matrices=False)[2][:n_axes].T.copy()
    return found


def _unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, width int, vector binary): float64 unit vectors of the rows that can link."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, widths = [], []
            for value in batch.column("embedding"):
                x = np.asarray(value.values, np.float64) if value.is_valid and not value.values.null_count else np.zeros(0)
                top = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                if top > 0:
                    x = x / top
                    units.append((x / np.sqrt(x @ x)).tobytes())
                else:
                    units.append(None)
                widths.append(len(x))
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(widths, pa.int32()), pa.array(units, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "width", "vector"])

    label = dict(vectors.dtypes)["label"]
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    return rows.mapInArrow(work, f"vec_id long, label {label}, width int, vector binary").filter("vector IS NOT NULL")


def _blocks(classes: DataFrame, axes: dict[int, np.ndarray], n_axes: int, eps: float) -> DataFrame:
    """Classes sorted in grid order and cut into blocks: (block long, label, width, ids, copies,
    vectors binary, low and high array<double>), low and high being the box of the block."""
    label = dict(classes.dtypes)["label"]
    cells = [f"c{k}" for k in range(n_axes)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = np.zeros((batch.num_rows, n_axes), np.int32)
            widths = np.asarray(batch.column("width"))
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                points = np.stack([np.frombuffer(batch.column("vector")[i].as_buffer()) for i in at.tolist()])
                y = points @ _axis(axes, width, n_axes)
                grid[at] = np.floor(y / eps)
            columns = [*batch.columns, *(pa.array(grid[:, k]) for k in range(n_axes))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *cells])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    placed = classes.mapInArrow(place, fields + "".join(f", {c} int" for c in cells))
    order = ["label", "width", *cells, "id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("label", "width", "id", "copies", "vector")), strict=True)
            for row in rows:
                full = held and len(held) >= max(16, min(BLOCK_ROWS, BLOCK_BYTES // (8 * row[1])))
                if held and (full or held[0][:2] != row[:2]):
                    yield block(part, seq, held, batch.schema.field("label").type)
                    seq, held = seq + 1, []
                held.append(row)
        if held:
            yield block(part, seq, held, batch.schema.field("label").type)

    def block(part: int, seq: int, rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        label, width = rows[0][:2]
        data = b"".join(r[4] for r in rows)
        y = np.frombuffer(data).reshape(len(rows), width) @ _axis(axes, width, n_axes)
        long, double = pa.list_(pa.int64()), pa.list_(pa.float64())
        values = [part, seq, label, width, [r[2] for r in rows], [r[3] for r in rows], data, y.min(axis=0).tolist(), y.max(axis=0).tolist()]
        kinds = [pa.int32(), pa.int64(), kind, pa.int32(), long, long, pa.binary(), double, double]
        names = ["part", "seq", "label", "width", "ids", "copies", "vectors", "low", "high"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    schema = f"part int, seq long, label {label}, width int, ids array<long>, copies array<long>, vectors binary, low array<double>, high array<double>"
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, schema)


def _axis(axes: dict[int, np.ndarray], width: int, n_axes: int) -> np.ndarray:
    own = axes.get(int(width), np.eye(int(width))[:, :n_axes] if width <= AXIS_WIDTH else None)
    if own is None:
        own = np.zeros((int(width), n_axes))
        own[range(n_axes), range(n_axes)] = 1
    return own if own.shape[1] == n_axes else np.pad(own, ((0, 0), (0, n_axes - own.shape[1])))


def _near_pairs(leaves: DataFrame, n_leaves: int, eps: float) -> DataFrame:
    """(a, b), a <= b: blocks of one label and width whose boxes are not farther apart than eps.

    Blocks are numbered in grid order; nodes of the tree above are intervals of FAN_OUT children.
    Starting at the root with itself, pairs of nodes are replaced by the pairs of their children
    that are not provably distant."""
    box = leaves.select("node", "label", "width", "low", "high")
    levels = [
        box.select(
            "node", F.col("label").alias("l0"), F.col("label").alias("l1"), F.col("width").alias("w0"),
            F.col("width").alias("w1"), "low", "high",
        )
    ]
    axes = range(len(leaves.select("low").first()[0]))
    while n_leaves > 1:
        below = levels[-1].withColumn("node", F.expr(f"node div {FAN_OUT}"))
        upper = below.groupBy("node").agg(
            F.min("l0").alias("l0"), F.max("l1").alias("l1"), F.min("w0").alias("w0"), F.max("w1").alias("w1"),
            F.array(*[F.min(F.col("low")[k]) for k in axes]).alias("low"),
            F.array(*[F.max(F.col("high")[k]) for k in axes]).alias("high"),
        )
        levels.append(stored(upper, "nodes"))
        n_leaves = -(-n_leaves // FAN_OUT)
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    far = F.aggregate(
        F.zip_with(F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y)),
        F.lit(0.0),
        lambda total, gap: total + F.pow(F.greatest(gap, F.lit(0.0)), F.lit(2.0)),
    )
    meets = (F.col("l0_a") <= F.col("l1_b")) & (F.col("l0_b") <= F.col("l1_a"))
    meets &= (F.col("w0_a") <= F.col("w1_b")) & (F.col("w0_b") <= F.col("w1_a"))
    for level in reversed(levels[:-1]):
        child = level.withColumn("parent", F.expr(f"node div {FAN_OUT}"))
        one = child.select(*[F.col(c).alias(f"{c}_a") for c in child.columns])
        two = child.select(*[F.col(c).alias(f"{c}_b") for c in child.columns])
        pairs = (
            pairs.join(one, F.col("a") == F.col("parent_a"))
            .join(two, F.col("b") == F.col("parent_b"))
            .filter((F.col("node_a") <= F.col("node_b")) & meets & (far <= eps * eps * (1 + 1e-9)))
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        )
        pairs = stored(pairs, "near-blocks")
    return pairs


def similar_vectors(vectors: DataFrame, threshold: float = 0.93, n_axes: int = 4) -> DataFrame:
    """For vectors (vec_id long, embedding array of numbers, label): one row (vec_id, n_links long,
    component_id long, kept boolean) per row.

    Two vectors are linked if their labels are equal and not null, their widths are equal and the
    cosine in double precision is `threshold` (positive) or more. A vector that is null, empty or
    zero, or has a null or non-finite component, or whose vec_id is null, is linked with nothing:
    n_links 0, component_id its own id, kept. n_links counts the other rows linked directly.
    Other columns are ignored.

    Equal vectors are collapsed first. Vectors are then sorted by the grid cells, of the width of
    the largest linked distance, on the leading principal axes, and cut into blocks; only blocks
    that are not provably distant meet, each pair in a task of its own. A task emits sums of links
    and a spanning forest, never all pairs."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    unit = stored(_unit_vectors(vectors), "unit-vectors")
    usable = unit.filter("vec_id IS NOT NULL AND label IS NOT NULL")
    classes = stored(
        usable.groupBy("label", "width", "vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")),
        "vector-classes",
    )
    everyone = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    blocks = stored(_blocks(classes, _axes(classes, n_axes), n_axes, eps), "blocks")
    counts = blocks.groupBy("part").count().orderBy("part").collect()  # a row per task of the sort
    if not counts:
        return everyone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    starts = np.append(0, np.cumsum([n for _, n in counts]))
    offsets = vectors.sparkSession.createDataFrame(
        [(int(p), int(s)) for (p, _), s in zip(counts, starts[:-1], strict=True)], "part int, start long"
    )
    leaves = stored(
        blocks.join(offsets, "part").withColumn("node", F.col("start") + F.col("seq")).drop("part", "seq", "start"), "leaves"
    )
    pairs = _near_pairs(leaves, int(starts[-1]), eps)
    data = leaves.select("node", "width", "ids", "copies", "vectors")
    one = data.select(F.col("node").alias("a"), "width", *[F.col(c).alias(f"{c}_a") for c in ("ids", "copies", "vectors")])
    two = data.select(F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("ids", "copies", "vectors")])
    met = pairs.join(one, "a").join(two, "b")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = {c: batch.column(k)[i] for k, c in enumerate(batch.schema.names)}
                same = get["a"].as_py() == get["b"].as_py()
                ids = [np.asarray(get[f"ids_{s}"].values) for s in "ab"]
                copies = [np.asarray(get[f"copies_{s}"].values) for s in "ab"]
                x, y = (np.frombuffer(get[f"vectors_{s}"].as_buffer()).reshape(-1, get["width"].as_py()) for s in "ab")
                linked = x @ y.T >= threshold
                if same:
                    np.fill_diagonal(linked, False)
                    a, b = _tree(linked, ids[0], ids[0])
                    found = [(ids[0], linked @ copies[0])]
                else:
                    a, b = _tree(linked, ids[0], ids[1])
                    found = [(ids[0], linked @ copies[1]), (ids[1], linked.T @ copies[0])]
                who = np.concatenate([w[n > 0] for w, n in found])
                links = np.concatenate([n[n > 0] for _, n in found])
                for columns in ((who, np.full(len(who), -1), links), (a, b, np.zeros(len(a)))):
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["a", "b", "links"])

    spread = met.repartition("a", "b")
    found = stored(spread.mapInArrow(link, "a long, b long, links long"), "links")
    links = found.filter("links > 0").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    reached = components(found.filter("links = 0").select("a", "b"))
    by_class = (
        classes.join(links, "id", "left")
        .join(reached, "id", "left")
        .select(
            "label", "width", "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    linked = usable.join(by_class, ["label", "width", "vector"]).select("vec_id", "n_links", "component_id")
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    unusable = _left_over(vectors).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    others = unit.filter(~able).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        linked.unionByName(others)
        .unionByName(unusable)
        .withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id")))
    )


def _left_over(vectors: DataFrame) -> DataFrame:
    """The rows without a unit vector, by the same rule as _unit_vectors."""
    x = F.col("embedding")
    number = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = ~F.exists(x, lambda v: F.abs(v) > 0)
    unusable = x.isNull() | (F.size(x) == 0) | F.coalesce(number, F.lit(False)) | F.coalesce(zero, F.lit(False))
    return vectors.filter(unusable).select(F.col("vec_id").cast("long").alias("vec_id"))


def _tree(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links of a block pair."""
    a, b = [], []
    row_left, column_left = linked.any(axis=1), np.ones(linked.shape[1], bool)
    while row_left.any():
        frontier = np.zeros(len(rows), bool)
        frontier[np.flatnonzero(row_left)[0]] = True
        row_left &= ~frontier
        while frontier.any():
            hit = linked[frontier][:, column_left]
            to = np.flatnonzero(column_left)[hit.any(axis=0)]
            source = np.flatnonzero(frontier)[linked[frontier][:, to].argmax(axis=0)]
            a.extend(rows[source].tolist())
            b.extend(columns[to].tolist())
            column_left[to] = False
            back = np.flatnonzero(row_left & linked[:, to].any(axis=1))
            origin = to[linked[back][:, to].argmax(axis=1)] if len(to) else to[:0]
            a.extend(rows[back].tolist())
            b.extend(columns[origin].tolist())
            frontier = np.zeros(len(rows), bool)
            frontier[back] = True
            row_left &= ~frontier
    return np.array(a, np.int64), np.array(b, np.int64)
