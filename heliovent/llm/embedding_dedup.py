"""Near-duplicate vectors by an exact metric range join.

Vectors of one label (and length) link if their cosine, in double precision, is at least ``least``. On unit vectors that is a
distance of at most r = sqrt(2 - 2 * least), a metric, so:

1. Equal vectors of a label become one with a weight.
2. A label of over ``CELL`` vectors gets pivots, about one for every ``CELL``, at most ``PIVOTS``, chosen by a hash. A vector's home is the
   cell of its nearest pivot. If y has its home with pivot q and is within r of x, whose home is with p, then
   d(x, q) <= d(y, q) + r <= d(y, p) + r <= d(x, p) + 2 r: x is copied to just the cells that satisfy this.
3. Each cell joins its home vectors with all vectors in it, apart from other cells, in tiles of at most about ``TILE`` x ``TILE`` vectors.
   Every link of a vector is seen in its home cell, so links are counted once per vector.

A tile gives a spanning forest of its links, not all pairs. The pivots prune where vectors cluster; where all distances are
alike, as between random vectors, most vectors are copied to all cells of their label, so the number of pivots is kept small.

Vectors that are null, zero, empty or hold null or non-finite components, and those with a null label, link with nothing. A
null vec_id stands for a number after all others. Rows with one vec_id are one node. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.llm.components import components
from heliovent.llm.storage import stored
from heliovent.llm.text import column

CELL, PIVOTS, TILE = 4096, 256, 4096
NO_ID = (1 << 63) - 1
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
_KEY = ["label", "h1", "h2"]


def unit(table: pa.Table) -> np.ndarray:
    """The vectors, of length one, in double precision."""
    vectors = column(table, "vector")
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(reach: float):
    def make(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"rep": pa.array([], pa.int64()), "cell": pa.array([], pa.int32()), "home": pa.array([], pa.bool_())})
        pivots = pivots.sort_by("rep")
        distance = np.sqrt(np.maximum(0, 2 - 2 * unit(rows) @ unit(pivots).T))
        home = distance.argmin(axis=1)
        row, cell = np.nonzero(distance <= distance.min(axis=1, keepdims=True) + reach)
        ids = column(rows, "rep").to_numpy()
        return pa.table({"rep": pa.array(ids[row]), "cell": pa.array(cell, pa.int32()), "home": pa.array(home[row] == cell)})

    return make


def forest(ids: np.ndarray, rows) -> list[tuple[int, int]]:
    """Edges that connect what the rows connect; rows: (node, nodes linked to it), as places in ``ids``."""
    group = np.arange(len(ids))
    edges = []
    for i, linked in rows:
        found = group[linked]
        for g in np.unique(found[found != group[i]]):
            edges.append((int(ids[i]), int(ids[linked[np.argmax(group[linked] == g)]])))
            group[group == g] = group[i]
    return edges


def _join(least: float):
    def make(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([[], [], []], schema=_LINKS)
        x, y = unit(left), unit(right)
        a, b = column(left, "rep").to_numpy(), column(right, "rep").to_numpy()
        weight = column(right, "weight").to_numpy()
        ids = np.unique(np.concatenate([a, b]))
        place_a, place_b = np.searchsorted(ids, a), np.searchsorted(ids, b)
        links = np.zeros(len(a), np.int64)

        def rows():
            for at in range(0, len(a), 256):
                near = x[at : at + 256] @ y.T >= least
                near &= a[at : at + 256, None] != b[None, :]
                links[at : at + 256] = near @ weight
                for i in np.flatnonzero(near.any(axis=1)):
                    yield place_a[at + i], place_b[near[i]]

        edges = np.array(forest(ids, rows()), np.int64).reshape(-1, 2)
        some = links > 0
        n = int(some.sum())
        return pa.table(
            [pa.array(np.r_[edges[:, 0], a[some]]), pa.array([*edges[:, 1].tolist(), *[None] * n], pa.int64()), pa.array([*[None] * len(edges), *links[some].tolist()], pa.int64())],
            schema=_LINKS,
        )

    return make


def _range(n: str) -> F.Column:
    return F.explode(F.expr(f"sequence(0, cast({n} as int) - 1)"))


def join_vectors(frame: DataFrame, least: float = 0.98) -> DataFrame:
    """Link vectors of equal label whose cosine is at least ``least``.

    Returns vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable by links, itself
    included), kept (vec_id is that).
    """
    vector = F.col("embedding").cast("array<double>")
    usable = F.col("label").isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = frame.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"),
        F.when(F.coalesce(usable, F.lit(False)), F.struct("label", F.size("embedding").alias("size"))).alias("label"),
        "embedding",
        F.xxhash64("embedding").alias("h1"),
        F.xxhash64(F.lit(1), "embedding").alias("h2"),
    )
    reps = stored(rows.where("label is not null").groupBy(*_KEY).agg(F.min("vec_id").alias("rep_id"), F.count("*").alias("weight"), F.any_value("embedding").alias("vector")).withColumn("rep", F.monotonically_increasing_id()))  # a number of its own
    pairs = _linked(reps, least)
    links = pairs.where("b is null").groupBy("a").agg(F.sum("n").alias("n")).withColumnsRenamed({"a": "rep"})
    names = reps.select("rep", "rep_id")
    edges = pairs.where("b is not null").select("a", "b").join(names.select(F.col("rep").alias("a"), F.col("rep_id").alias("x")), "a").join(names.select(F.col("rep").alias("b"), F.col("rep_id").alias("y")), "b")
    again = rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1")
    same = rows.join(again, "vec_id", "left_semi").join(reps, _KEY).select(F.col("vec_id").alias("x"), F.col("rep_id").alias("y"))
    found = stored(components(edges.select("x", "y").union(same).toDF("a", "b"))).withColumnsRenamed({"node": "rep_id"})
    known = reps.join(links, "rep", "left").join(found, "rep_id", "left").select(*_KEY, (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep_id").alias("component"))
    own = found.select(F.col("rep_id").alias("vec_id"), F.col("component").alias("own"))
    out = rows.drop("embedding").join(known, _KEY, "left").join(own, "vec_id", "left")
    component = F.coalesce("component", "own", "vec_id")
    return out.select(
        F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.nullif(component, F.lit(NO_ID)).alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


def _linked(reps: DataFrame, least: float) -> DataFrame:
    """Links between distinct vectors: edges (a, b) that connect them, and (a, n) with parts of a's number of links."""
    sizes = reps.groupBy("label").agg(F.count("*").alias("size")).withColumn("pivots", F.least(F.lit(PIVOTS), F.ceil(F.col("size") / CELL)).cast("int"))
    rows = reps.select("rep", "label", "vector", "weight").join(sizes, "label")
    few = rows.where("pivots = 1").select("label", "rep", F.lit(0).alias("cell"), F.lit(True).alias("home"))
    many = rows.where("pivots > 1").withColumn("salt", F.pmod("rep", "pivots").cast("int"))
    chosen = many.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 40)) * F.col("size") < F.lit(float(1 << 40)) * F.col("pivots"))
    # the least hash of each label stands in where chance chooses none
    chosen = chosen.select("label", "rep", "vector", "pivots").union(many.groupBy("label").agg(F.min("rep").alias("rep"), F.min_by("vector", "rep").alias("vector"), F.any_value("pivots").alias("pivots"))).dropDuplicates(["label", "rep"])
    dealt = chosen.select("label", "rep", "vector", _range("pivots").alias("salt")).toDF("label", "rep", "vector", "salt")
    reach = 2 * (2 - 2 * least) ** 0.5 + 1e-9
    placed = many.select("label", "salt", "rep", "vector").groupBy("label", "salt").cogroup(dealt.groupBy("label", "salt")).applyInArrow(_cells(reach), "rep long, cell int, home boolean")
    cells = stored(few.unionByName(placed.join(rows.select("rep", "label"), "rep")))
    tiles = cells.groupBy("label", "cell").agg(F.ceil(F.count_if("home") / TILE).cast("int").alias("homes"), F.ceil(F.count("*") / TILE).cast("int").alias("alls")).where("homes > 0")
    full = cells.join(tiles, ["label", "cell"]).join(rows.select("rep", "vector", "weight"), "rep")
    left = full.where("home").withColumn("i", F.pmod(F.xxhash64("rep"), "homes").cast("int")).withColumn("j", _range("alls"))
    right = full.withColumn("j", F.pmod(F.xxhash64("rep"), "alls").cast("int")).withColumn("i", _range("homes"))
    key = ["label", "cell", "i", "j"]
    right = right.select(*key, "rep", "vector", "weight").toDF(*key, "rep", "vector", "weight")
    joined = left.select(*key, "rep", "vector").groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_join(least), "a long, b long, n long")
    return stored(joined)
