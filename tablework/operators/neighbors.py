"""Exact k nearest neighbours without pairing every row with every row.

Points are grouped around pivots, about as many as the square root of their number and at most a few thousand, and
each group is cut by distance to its pivot into rings of limited size. A query first looks at the ring of its own
group in which it lies, which bounds the distance to its k-th neighbour. The triangle inequality then rules out the
groups and rings that cannot hold a closer point, and the query visits the others only. Queries to one ring are cut
to limited blocks too, so a dense region becomes many tasks, and a task makes the distances of a few queries at a time. Equal feature vectors are searched once, and of many
equal points only the few with the smallest ids can be neighbours, so copies of one point cost no more than one.
Tasks return at most k rows per query, never pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.functions.hashing import hash_number
from tablework.operators.joins import lookup_join
from tablework.operators.position import position_in_group
from tablework.session import pin

# the functions below travel to Python workers by value, so that executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SLACK, _TINY = 1.0 + 1e-9, 1e-12  # keep rounding in the bounds from excluding a tie
#: distances that a task makes at once, of which it needs a dozen arrays
DISTANCES = 1 << 19


def _parts(n_rows: int, n_columns: int) -> Iterator[slice]:
    """Rows in parts whose distances to all columns are not too many at once."""
    step = max(1, DISTANCES // max(1, n_columns))
    return (slice(start, start + step) for start in range(0, n_rows, step))


def _squared(a: np.ndarray, b: np.ndarray, n_numeric: int, mismatch: float) -> np.ndarray:
    """Squared distances, dimensions added in order; categories after the numeric ones add ``mismatch``."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        if j < n_numeric:
            out += (a[:, j, None] - b[None, :, j]) ** 2
        elif mismatch:
            out += mismatch * (a[:, j, None] != b[None, :, j])
    return out


def _smallest(d2: np.ndarray, by_id: np.ndarray, k: int, within: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the k nearest per row, ties by the columns' place ``by_id``, none farther than the row's
    ``within``."""
    k = min(k, d2.shape[1])
    limit = np.partition(d2, k - 1, axis=1)[:, k - 1]
    if within is not None:
        limit = np.minimum(limit, within)
    rows, cols = np.nonzero(d2 <= limit[:, None])
    order = np.lexsort((by_id[cols], d2[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], cols[place < k]


class _Groups:
    """Pivots, and how many points lie how near and far around each of them."""

    def __init__(self, fcols: list[str], n_numeric: int, mismatch: float, centers: np.ndarray):
        self.fcols, self.n_numeric, self.mismatch, self.centers = fcols, n_numeric, mismatch, centers
        self.size = np.zeros(len(centers), dtype=np.int64)
        self.lo, self.hi = np.full(len(centers), np.inf), np.full(len(centers), -np.inf)

    def count(self, stats: pd.DataFrame) -> None:
        cell = stats["_cell"].to_numpy()
        self.size[cell], self.lo[cell], self.hi[cell] = stats["n"], stats["lo"], stats["hi"]

    def squared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _squared(a, b, self.n_numeric, self.mismatch)

    def values(self, pdf: pd.DataFrame) -> np.ndarray:
        return pdf[self.fcols].to_numpy(dtype=float)

    def to_centers(self, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
        """Rows with their distances to all centers, few enough rows at once to keep that matrix small."""
        for pdf in batches:
            for some in _parts(len(pdf), len(self.centers)):
                part = pdf.iloc[some]
                yield part, np.sqrt(self.squared(self.values(part), self.centers))

    def assign(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Add the nearest center and the distance to it."""
        for pdf, d in self.to_centers(batches):
            cell = d.argmin(axis=1)
            yield pdf.assign(_cell=cell.astype("int32"), _to_center=d[np.arange(len(d)), cell])

    def reach(self, batches: Iterator[pd.DataFrame], keep: int) -> Iterator[pd.DataFrame]:
        """Per query, a radius that holds its ``keep`` nearest points and the groups which that radius touches."""
        filled = self.size > 0
        for pdf, d in self.to_centers(batches):
            rows = np.arange(len(d))
            # all points of a group lie within d + hi, so enough groups in that order bound the radius as well
            far = np.where(filled, d + self.hi, np.inf)
            order = np.argsort(far, axis=1)
            enough = np.cumsum(self.size[order], axis=1) >= keep
            general = np.where(enough.any(axis=1), far[rows, order[rows, enough.argmax(axis=1)]], np.inf)
            radius = np.fmin(general, pdf["_kth"].to_numpy(dtype=float))
            possible = np.maximum(d - self.hi, self.lo - d)
            own = pdf["_cell"].to_numpy()
            between = np.sqrt(self.squared(self.centers[own], self.centers))
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (d**2 - (d[rows, own] ** 2)[:, None]) / (2 * between)
            possible = np.fmax(possible, np.where(np.isfinite(plane), plane, 0.0))
            visit = filled & (possible <= radius[:, None] * _SLACK + _TINY)
            yield pdf[["_q", *self.fcols]].assign(
                _radius=radius,
                _cells=[np.flatnonzero(v).astype("int32") for v in visit],
                _away=[x[v] for x, v in zip(d, visit)],
            )


def _rings(placed: DataFrame, largest: int, block_rows: int) -> DataFrame:
    """Points with ``_block``, their ring of at most ``block_rows`` points within their group."""
    if largest <= block_rows:
        return placed.withColumn("_block", F.lit(0))
    ranked = position_in_group(placed, ["_cell"], ["_to_center", "neighbor"], "_place", unique=True)
    ring = F.floor(F.col("_place") / block_rows).cast("int")
    return pin(ranked.withColumn("_block", ring).drop("_place"), "rings")


def nearest(
    queries: DataFrame,
    points: DataFrame,
    *,
    id_col: str,
    features: Sequence[str],
    k: int,
    categorical: Sequence[str] = (),
    mismatch: float = 0.0,
    carry: Sequence[str] = (),
    exclude_self: bool = False,
    max_pivots: int = 4096,
    block_rows: int = 2048,
) -> DataFrame:
    """The ``k`` nearest points of each query: query columns, ``rank`` from 1, ``neighbor``, ``distance``, carried
    point columns prefixed ``n_``. Features and categorical columns are numeric, and a null in one is an error; ids of
    points are unique. ``mismatch`` is the squared distance between two different categories.
    """
    dims = [*features, *categorical]
    keep = k + 1 if exclude_self else k
    fcols = [f"_f{i}" for i in range(len(dims))]

    def vectors() -> list[Column]:
        # + 0.0 makes -0.0 and 0.0 the same vector
        return [
            (F.coalesce(F.col(c).cast("double"), F.raise_error(F.lit(f"{c} is null")).cast("double")) + F.lit(0.0)).alias(f)
            for c, f in zip(dims, fcols)
        ]

    # of equal points only the `keep` smallest ids can ever be chosen
    carried = [F.col(c).alias(f"n_{c}") for c in carry]
    by_id = Window.partitionBy(*fcols).orderBy("neighbor")
    distinct_points = (
        points.select(F.col(id_col).alias("neighbor"), *vectors(), *carried)
        .withColumn("_copy", F.row_number().over(by_id))
        .filter(F.col("_copy") <= keep)
        .drop("_copy")
    )
    candidates = pin(distinct_points, "candidates")
    # at most `max_pivots` rows, spread by hash, reach the driver whatever the table size; a table that fits one
    # block needs no groups
    n_points = candidates.count()
    wanted = 1 if n_points <= block_rows else min(max_pivots, int(n_points**0.5))
    chosen = candidates.select("neighbor", *fcols).orderBy(hash_number("neighbor"), "neighbor").limit(wanted).toPandas()
    if len(chosen) == 0:
        raise ValueError("no points to search")
    groups = _Groups(fcols, len(features), mismatch, np.unique(chosen[fcols].to_numpy(dtype=float), axis=0))

    def with_cells(df: DataFrame) -> DataFrame:
        return df.mapInPandas(groups.assign, schema=f"{_ddl(df)}, _cell int, _to_center double")

    in_cells = pin(with_cells(candidates), "points")
    vectors_asked = queries.select(*vectors()).groupBy(*fcols).agg(F.count("*").alias("_n")).drop("_n")
    asked = pin(with_cells(vectors_asked.withColumn("_q", F.md5(F.concat_ws(":", *fcols)))), "queries")

    # as many rows as pivots
    nearness = [F.min("_to_center").alias("lo"), F.max("_to_center").alias("hi")]
    groups.count(in_cells.groupBy("_cell").agg(F.count("*").alias("n"), *nearness).toPandas())
    placed = _rings(in_cells, groups.size.max(), block_rows)
    # one row per group, with the rings in order
    rings = pin(
        placed.groupBy("_cell", "_block")
        .agg(*nearness)
        .groupBy("_cell")
        .agg(F.array_sort(F.collect_list(F.struct("_block", "lo", "hi"))).alias("_rings")),
        "ring-bounds",
    )
    n_columns = list(candidates.columns)
    out_schema = f"_q string, _d2 double, {_ddl(candidates)}"

    def search(visits: DataFrame, radius: str | None) -> DataFrame:
        """Best ``keep`` points per visit of a query to a ring, in blocks of limited size on both sides."""
        visits = pin(visits, "visits")
        per_ring = visits.groupBy("_cell", "_block").agg(F.count("*").alias("n"))
        shares = per_ring.select("_cell", "_block", F.ceil(F.col("n") / block_rows).cast("int").alias("_shares"))
        left = lookup_join(visits, shares, ["_cell", "_block"], "inner").withColumn(
            "_share", F.pmod(hash_number("_q"), F.col("_shares")).cast("int")
        ).drop("_shares")
        right = placed.join(shares, ["_cell", "_block"]).select(
            *[placed[c] for c in placed.columns], F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias("_share")
        )

        def best(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
            if len(q) == 0 or len(p) == 0:
                return pd.DataFrame(columns=["_q", "_d2", *n_columns])
            asked_at, points_at = groups.values(q), groups.values(p)
            within = (q[radius].to_numpy() * _SLACK) ** 2 + _TINY**2 if radius else None
            by_id = np.empty(len(p), dtype=np.int64)
            by_id[np.argsort(p["neighbor"].to_numpy(), kind="stable")] = np.arange(len(p))
            found = []
            for some in _parts(len(q), len(p)):
                d2 = groups.squared(asked_at[some], points_at)
                rows, cols = _smallest(d2, by_id, keep, None if within is None else within[some])
                found.append((rows + some.start, cols, d2[rows, cols]))
            rows, cols, nearest_d2 = (np.concatenate(x) for x in zip(*found))
            out = p[n_columns].iloc[cols].reset_index(drop=True)
            out.insert(0, "_d2", nearest_d2)
            out.insert(0, "_q", q["_q"].to_numpy()[rows])
            return out

        keys = ["_cell", "_block", "_share"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, schema=out_schema)

    if n_points > block_rows:
        own_ring = F.greatest(F.size(F.filter("_rings", lambda x: x["lo"] <= F.col("_to_center"))) - 1, F.lit(0))
        first = search(lookup_join(asked, rings, ["_cell"], "inner").withColumn("_block", own_ring).drop("_rings"), None)
        bound = first.groupBy("_q").agg(F.count("*").alias("_n"), F.sqrt(F.max("_d2")).alias("_kth")).select(
            "_q", F.when(F.col("_n") >= keep, F.col("_kth")).alias("_kth")
        )
        bounded = pin(asked.join(bound, "_q", "left"), "bounded")
    else:
        bounded = asked.withColumn("_kth", F.lit(None).cast("double"))

    numbers = [f"{f} double" for f in fcols]
    reached = bounded.mapInPandas(
        lambda batches: groups.reach(batches, keep),
        schema=", ".join(["_q string", *numbers, "_radius double", "_cells array<int>", "_away array<double>"]),
    ).select("_q", *fcols, "_radius", F.inline(F.arrays_zip("_cells", "_away")))
    reached = reached.withColumnsRenamed({"_cells": "_cell"})
    limit = F.col("_radius") * _SLACK + _TINY
    touched = F.filter(
        "_rings", lambda x: (x["lo"] - F.col("_away") <= limit) & (F.col("_away") - x["hi"] <= limit)
    )
    visits = lookup_join(reached, rings, ["_cell"], "inner").select(
        "_q", *fcols, "_radius", "_cell", F.explode(F.transform(touched, lambda x: x["_block"])).alias("_block")
    )
    found = search(visits, "_radius")
    best_first = Window.partitionBy("_q").orderBy("_d2", "neighbor")
    top = found.withColumn("_rank", F.row_number().over(best_first)).filter(F.col("_rank") <= keep)
    listed = top.groupBy("_q").agg(
        F.array_sort(
            F.collect_list(F.struct("_rank", "neighbor", F.sqrt("_d2").alias("distance"), *[f"n_{c}" for c in carry]))
        ).alias("_found")
    )
    # back from distinct vectors to rows; each list has at most k + 1 entries
    rows = lookup_join(
        queries.select("*", F.md5(F.concat_ws(":", *vectors())).alias("_q")), pin(listed, "neighbors"), ["_q"], "inner"
    )
    hits = F.col("_found")
    if exclude_self:
        hits = F.filter(hits, lambda h: h["neighbor"] != F.col(id_col))
    return rows.select(
        *queries.columns, F.posexplode(F.slice(hits, 1, k)).alias("_place", "_hit")
    ).select(
        *queries.columns,
        (F.col("_place") + 1).alias("rank"),
        F.col("_hit.neighbor").alias("neighbor"),
        F.col("_hit.distance").alias("distance"),
        *[F.col(f"_hit.n_{c}").alias(f"n_{c}") for c in carry],
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def knn_predict(neighbors: DataFrame, keys: Sequence[str], label: str, name: str = "prediction") -> DataFrame:
    """Mean label of each query's neighbours (``label`` carried by ``nearest``)."""
    return neighbors.groupBy(*keys).agg(F.avg(f"n_{label}").alias(name))
