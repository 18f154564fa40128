"""Near-duplicate vectors by cosine: tile products of int8 codes with error bounds.

Equal vectors are one node with a weight.  A node's unit vector u is written as
scale * codes + rest with codes in -127..127, and the length of the rest is its
quantisation error e.  For two nodes the cosine differs from the scaled product
of their codes by at most (1 + e1) * e2 + e1, so a product tells that a pair is
linked, that it is not, or (in a narrow band) that it has to be worked out from
the vectors in doubles.  Products of codes are whole numbers below 2**24, which
a float32 matrix product gives exactly.

Nodes are put in order by their nearest pivot (of a bounded sample) and the angle
to it, and cut into tiles of even size.  Angles are a metric: a pair of tiles or
of their parts whose centres are further apart than both radii and the
threshold's angle holds no link, and one that is as close as the radii allow at
most holds links only, and neither needs a product.  What is left is a product of
every pair of tiles: the work grows with the square of the number of nodes unless
they lie in clusters.  Each pair of tiles is one group of two rows.  A pair emits,
for each node with links in it, their number and one node of its component there,
so rows follow the nodes in tiles with links and never the pairs."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from signalyard.llm.bagminhash import components
from signalyard.session import materialise

THRESHOLD = 0.95
#: Nodes of a tile (at most, but for the spread of a hash), and of a part of one.
TILE, PART = 8192, 512
#: Sampled nodes by which all nodes are ordered.
PIVOTS = 256
_RINGS = 64
_ANGLE = 1e-6  # far above what doubles lose in an angle
_ROUND = 1e-9  # and in a cosine
_PAIRS = 1 << 16

SCHEMA = "vec_id long, n_links long, component_id long, kept boolean"
_TILES = ("dim int, tile long, n int, nodes binary, weights binary, codes binary, scales binary, errors binary, "
          "vectors binary, centre array<double>, radius double")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by their largest component, so that squares
    neither overflow nor vanish."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale and error of each row."""
    scales = np.abs(units).max(1) / 127
    codes = np.rint(units / scales[:, None])
    rest = units - codes * scales[:, None]
    return codes.astype(np.int8), scales, np.sqrt(np.einsum("ij,ij->i", rest, rest)) + _ROUND


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with the same row of ``y`` (unit rows), in doubles."""
    return np.einsum("ij,ij->i", x, y)


def _angle(dots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(dots, -1.0, 1.0))


def _centre(units: np.ndarray) -> tuple[np.ndarray, float]:
    mean = units.mean(0)
    size = math.sqrt(mean @ mean)
    centre = mean / size if size > 1e-9 else units[0]
    return centre, float(_angle(units @ centre).max())


class Tile:
    """Nodes of one tile, with the centre and radius of each part."""

    def __init__(self, nodes, weights, codes, scales, errors, units):
        self.nodes, self.weights, self.scales, self.errors, self.units = nodes, weights, scales, errors, units
        wide = codes.shape[1] * 127 * 127 >= 1 << 24
        self.codes = codes.astype(np.float64 if wide else np.float32)
        self.parts = [slice(i, min(i + PART, len(nodes))) for i in range(0, len(nodes), PART)]
        about = [_centre(units[p]) for p in self.parts]
        self.centres, self.radii = np.array([c for c, _ in about]), [r for _, r in about]


class _Links:
    """Number of linked vectors of each node of one or two tiles, and a component
    label (the place of one of its nodes)."""

    def __init__(self, n: int):
        self.count = np.zeros(n, dtype=np.int64)
        self.label = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            np.minimum.at(self.label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up


def links_between(a: Tile, b: Tile | None, threshold: float = THRESHOLD) -> _Links:
    """Links of the nodes of ``a`` with those of ``b``, or among each other if it
    is None; places are those of ``a``, then those of ``b``."""
    own = b is None
    b = a if own else b
    shift = 0 if own else len(a.nodes)
    out = _Links(len(a.nodes) + (0 if own else len(b.nodes)))
    reach = math.acos(min(1.0, max(-1.0, threshold)))
    gaps = _angle(a.centres @ b.centres.T)
    for p, rows in enumerate(a.parts):
        for q in range(p if own else 0, len(b.parts)):
            columns = b.parts[q]
            radii = a.radii[p] + b.radii[q]
            if gaps[p, q] - radii > reach + _ANGLE:
                continue
            same = own and p == q
            if gaps[p, q] + radii < reach - _ANGLE:
                wa, wb = a.weights[rows], b.weights[columns]
                out.count[rows] += wb.sum() - (wa if same else 0)
                if not same:
                    out.count[shift + columns.start:shift + columns.stop] += wa.sum()
                here = np.concatenate([np.arange(rows.start, rows.stop), np.arange(columns.start, columns.stop) + shift])
                out.join(here, np.full(len(here), here[0]))
                continue
            i, j = _linked(a, rows, b, columns, threshold, same)
            if len(i):
                i, j = i + rows.start, j + columns.start
                out.count += np.bincount(i, b.weights[j], len(out.count)).astype(np.int64)
                out.count += np.bincount(j + shift, a.weights[i], len(out.count)).astype(np.int64)
                out.join(i, j + shift)
    return out


def _linked(a: Tile, rows: slice, b: Tile, columns: slice, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Linked places (i, j) of two parts; i < j within one part."""
    product = a.codes[rows] @ b.codes[columns].T
    sa, sb, ea, eb = a.scales[rows], b.scales[columns], a.errors[rows], b.errors[columns]
    slack = (1 + ea.max()) * eb.max() + ea.max() + _ROUND
    low = threshold - slack  # no pair below it; scales of both signs of the product
    at = np.flatnonzero(product.ravel() >= (low / (sa.max() * sb.max()) if low > 0 else low / (sa.min() * sb.min())))
    i, j = np.divmod(at, product.shape[1])
    if same:
        i, j = i[i < j], j[i < j]
    about = product[i, j].astype(np.float64) * sa[i] * sb[j]
    slack = (1 + ea[i]) * eb[j] + ea[i] + _ROUND
    linked = about - slack >= threshold
    maybe = np.flatnonzero(~linked & (about + slack >= threshold))
    for k in range(0, len(maybe), _PAIRS):
        few = maybe[k:k + _PAIRS]
        linked[few] = cosines(a.units[rows][i[few]], b.units[columns][j[few]]) >= threshold
    return i[linked], j[linked]


def usable(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, vector) of the rows that can have links, vec_id of the others:
    null, empty and zero vectors and those with null or not finite components."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    good = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").withColumn("good", good)
    return rows.filter("good").select("vec_id", x.alias("vector")), rows.filter(~F.col("good")).select("vec_id")


def _doubles(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _ordered(nodes: DataFrame, pivots: int, tile: int) -> DataFrame:
    """node, weight, vector, dim, cell, angle and tile of each node."""
    # at most ``pivots`` rows, of about twice as many that pass the filter in all tasks
    n, some = nodes.count(), nodes
    if n > 2 * pivots:
        some = nodes.filter(F.xxhash64("vector") < F.lit(-(2 ** 63) + (2 ** 64) * 2 * pivots // n))
    sample = some.orderBy(F.xxhash64("vector"), "node").limit(pivots).select("vector").collect()
    of_dim: dict[int, list] = {}
    for r in sample:
        of_dim.setdefault(len(r["vector"]), []).append(r["vector"])
    centres = {d: unit(np.array(v)) for d, v in of_dim.items()}

    def run(batches):
        for batch in batches:
            column = batch.column(2)
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            cell, angle = np.zeros(len(batch), dtype=np.int32), np.zeros(len(batch))
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                if d in centres:
                    dots = unit(_doubles(column.take(pa.array(at))).reshape(len(at), d)) @ centres[d].T
                    cell[at] = dots.argmax(1)
                    angle[at] = _angle(dots.max(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes.astype(np.int32)), pa.array(cell), pa.array(angle)],
                                             names=["node", "weight", "vector", "dim", "cell", "angle"])

    placed = materialise(nodes.select("node", "weight", "vector").mapInArrow(
        run, "node long, weight long, vector array<double>, dim int, cell int, angle double"), "placed")
    ring = F.floor(F.col("angle") / math.pi * _RINGS)
    # at most ``pivots`` x _RINGS rows for each length of vectors
    counts = materialise(placed.groupBy("dim", "cell", ring.alias("ring")).count(), "rings")
    before = Window.partitionBy("dim").orderBy("cell", "ring")
    all_ = F.sum("count").over(Window.partitionBy("dim"))
    starts = counts.select("dim", "cell", "ring", "count", (F.sum("count").over(before) - F.col("count")).alias("before"),
                           all_.alias("all"), F.ceil(all_ / tile).alias("tiles"))
    spread = (F.xxhash64("node").cast("double") / F.lit(2.0 ** 64)) + 0.5
    place = F.floor((F.col("before") + spread * F.col("count")) * F.col("tiles") / F.col("all"))
    return placed.withColumn("ring", ring).join(starts, ["dim", "cell", "ring"]).select(
        "node", "weight", "vector", "dim", "cell", "angle", F.least(place, F.col("tiles") - 1).alias("tile"))


def _packed(ordered: DataFrame) -> DataFrame:
    """One row of _TILES for each tile."""
    schema = pa.schema([("dim", pa.int32()), ("tile", pa.int64()), ("n", pa.int32())] + [(c, pa.binary()) for c in (
        "nodes", "weights", "codes", "scales", "errors", "vectors")] + [("centre", pa.list_(pa.float64())), ("radius", pa.float64())])

    def pack(key, table):
        table = table.sort_by([("cell", "ascending"), ("angle", "ascending"), ("node", "ascending")])
        units = unit(_doubles(table.column("vector").combine_chunks()).reshape(table.num_rows, key[0].as_py()))
        codes, scales, errors = quantise(units)
        centre, radius = _centre(units)
        raw = [table.column(c).to_numpy().astype("<i8") for c in ("node", "weight")] + [codes, scales, errors, units]
        return pa.Table.from_pylist([dict(zip(schema.names, [key[0].as_py(), key[1].as_py(), table.num_rows, *[x.tobytes() for x in raw],
                                                             centre.tolist(), radius]))], schema=schema)
    return ordered.groupBy("dim", "tile").applyInArrow(pack, _TILES)


def _pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """dim, tile, other of the pairs of tiles that may hold links, each pair once
    and each tile about as often on either side."""
    about = tiles.select("dim", "tile", "centre", "radius")
    number = about.groupBy("dim").agg(F.count(F.lit(1)).alias("tiles"))
    step = F.explode(F.sequence(F.lit(0), F.floor(F.col("tiles") / 2))).alias("step")
    # numbers without gaps: an unlucky hash can leave a tile empty
    placed = about.withColumn("place", F.row_number().over(Window.partitionBy("dim").orderBy("tile")) - 1).join(number, "dim")
    left = placed.select("*", step).filter("2 * step < tiles or place < step").withColumn("other_place", F.expr("(place + step) % tiles"))
    right = placed.select("dim", F.col("place").alias("other_place"), F.col("tile").alias("other"),
                          F.col("centre").alias("other_centre"), F.col("radius").alias("other_radius"))
    dot = F.aggregate(F.zip_with("centre", "other_centre", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), dot))) - F.col("radius") - F.col("other_radius")
    return left.join(right, ["dim", "other_place"]).filter(apart <= math.acos(threshold) + _ANGLE).select("dim", "tile", "other")


def _found(tiles: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """node, links, root of each node with links, for each pair of tiles."""
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def read(row: dict) -> Tile:
        n = row["n"]
        ints = [np.frombuffer(row[c], "<i8") for c in ("nodes", "weights")]
        floats = [np.frombuffer(row[c], "<f8") for c in ("scales", "errors")]
        return Tile(*ints, np.frombuffer(row["codes"], np.int8).reshape(n, -1), *floats, np.frombuffer(row["vectors"], "<f8").reshape(n, -1))

    def compare(table):
        rows = sorted(table.to_pylist(), key=lambda r: r["tile"])
        a, b = read(rows[0]), read(rows[1]) if len(rows) > 1 else None
        links = links_between(a, b, threshold)
        nodes = a.nodes if b is None else np.concatenate([a.nodes, b.nodes])
        at = np.flatnonzero(links.count)
        return pa.table([nodes[at], links.count[at], nodes[links.label[at]]], schema=schema)

    sides = pairs.select("dim", "tile", "other", F.explode(F.array_distinct(F.array("tile", "other"))).alias("side"))
    blobs = tiles.drop("centre", "radius").withColumnRenamed("tile", "side")
    both = sides.join(blobs, ["dim", "side"]).select("dim", F.col("tile").alias("first"), "other", F.col("side").alias("tile"), *[
        c for c in blobs.columns if c not in ("dim", "side")])
    return both.groupBy("dim", "first", "other").applyInArrow(compare, "node long, links long, root long")


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, pivots: int = PIVOTS) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of ``embeddings``
    (vec_id, embedding): the other vectors at a cosine of at least ``threshold``
    (above 0), the smallest vec_id that links lead to, and whether that is its own.

    Vectors of different lengths are never linked.  Vectors that are null, empty
    or zero, or hold null or not finite components, link with nothing and are
    their own component.  Repeated rows are vectors of their own, linked with each
    other; a null vec_id counts as larger than any other (a component without
    another id has a null id).  An empty table gives no rows; other columns are
    not read."""
    good, bad = usable(embeddings)
    key = F.xxhash64("vector").alias("key")
    grouped = good.groupBy(key, "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
    nodes = materialise(grouped.select(F.monotonically_increasing_id().alias("node"), "*"), "nodes")
    tiles = materialise(_packed(_ordered(nodes, pivots, tile)), "tiles")
    found = materialise(_found(tiles, materialise(_pairs(tiles, threshold), "tile-pairs"), threshold), "tile-links")
    labels = components(found.filter("node <> root").select(F.col("root").alias("pivot"), F.col("node").alias("member")).distinct()).withColumnsRenamed(
        {"row": "node"})
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    told = materialise(nodes.select("node", "key", "vector", "least", "weight").join(counts, "node", "left").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")), "node-labels")
    ids = told.groupBy("label").agg(F.min("least").alias("component_id"))
    named = told.join(ids, "label").select("key", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    rows = good.select("vec_id", key, "vector").join(named, ["key", "vector"]).select("vec_id", "n_links", "component_id")
    return rows.unionByName(bad.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
