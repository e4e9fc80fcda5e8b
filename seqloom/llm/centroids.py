"""Exact centroid clustering of integer vectors by Shallot search.

Every vector remembers its nearest and second-nearest centroid, an upper bound of its distance to the nearest and
a lower bound of that to any other. A round first moves the bounds by as much as the centroids moved; vectors
whose upper bound stays below the lower one, or below half the gap from their centroid to its closest neighbour,
keep their centroid without a distance being computed. The others compare the two remembered centroids and scan the
neighbours of the closer one, sorted by their distance from it, inside a ball of radius d(nearest) + d(second), which
shrinks whenever a nearer second is found; a centroid outside of it cannot be nearest or second. Candidates are
compared by squared distances in 64-bit integers, so results and ties (the smaller number) are exact; bounds are doubles
rounded outwards.

On Spark, vectors with their state are one table, written to shared storage after each round. Rounds are narrow maps
over it; new centroids are partial sums per cluster, of which k rows of sums reach the driver (k and the number of
components are parameters). Nothing is grouped or shuffled by cluster, so one cluster may hold nearly all rows.

Defined results: vectors that are null, have another number of components, or a null, infinite or NaN one are left
out; components are floor(64 x), and one beyond +-2^27, whose squared distances would not fit a long, raises an
error; fewer kept vectors than k give as many centroids; equal vectors, and rows with one id, are vectors of their
own (equal hashes are ordered by the vector); a null id hashes as an empty one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from seqloom.llm.shipping import map_arrow
from seqloom.llm.store import REST, pack_rest, settled, store

COMPONENTS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Largest component: 64 squared differences of two such numbers stay below 2^63.
REACH = 1 << 27
_SLACK = 1e-12


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of matching rows, in integers."""
    away = vectors - centroids
    return np.einsum("ij,ij->i", away, away)


class Centroids:
    """One round's centroids: sorted neighbours, half gaps, and how far each has moved since the last round."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None = None):
        self.at = now
        k = len(now)
        gaps = np.sqrt(np.stack([squared(now, np.broadcast_to(c, now.shape)) for c in now]).astype(float))
        np.fill_diagonal(gaps, -1.0)  # a centroid comes before others at its own place
        self.order = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(gaps, self.order, 1) * (1 - _SLACK)
        self.half = self.gaps[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if before is None else np.sqrt(squared(now, before).astype(float)) * (1 + _SLACK)
        self.moved = moved
        self.others = np.array([np.delete(moved, j).max(initial=0.0) for j in range(k)])


class Bounds:
    """What a block of vectors remembers from round to round."""

    def __init__(self, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.near, self.second, self.upper, self.lower = near, second, upper, lower

    @classmethod
    def unknown(cls, n: int, k: int) -> Bounds:
        return cls(np.zeros(n, np.int64), np.full(n, min(1, k - 1), np.int64), np.full(n, np.inf), np.zeros(n))


def search(x: np.ndarray, known: Bounds, centroids: Centroids) -> int:
    """Bring `known` up to this round's centroids; the number of distances computed."""
    near, second = known.near, known.second
    if len(centroids.at) == 1:
        known.upper[:], known.lower[:] = np.inf, np.inf
        return 0
    known.upper = (known.upper + centroids.moved[near]) * (1 + _SLACK)
    moved = centroids.others[near]
    known.lower = np.maximum(known.lower - moved - _SLACK * (known.lower + moved), 0.0)
    bound = np.maximum(known.lower, centroids.half[near])
    rows = np.flatnonzero(known.upper >= bound)
    to_near = squared(x[rows], centroids.at[near[rows]])
    known.upper[rows] = np.sqrt(to_near.astype(float)) * (1 + _SLACK)
    still = known.upper[rows] >= bound[rows]
    computed, rows, best = len(rows), rows[still], to_near[still]

    a, b = near[rows], second[rows]
    v = x[rows]
    next_best = squared(v, centroids.at[b])
    computed += len(rows)
    swap = (next_best < best) | ((next_best == best) & (b < a))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    best, next_best = np.where(swap, next_best, best), np.where(swap, best, next_best)
    start, other, reach = a.copy(), b.copy(), np.sqrt(best.astype(float))
    ball = (reach + np.sqrt(next_best.astype(float))) * (1 + _SLACK)
    active = np.arange(len(rows))
    for rank in range(len(centroids.at) - 1):
        active = active[centroids.gaps[start[active], rank] <= ball[active]]
        if not len(active):
            break
        tried = centroids.order[start[active], rank]
        new = tried != other[active]  # the remembered second has been compared
        at, c = active[new], tried[new]
        d = squared(v[at], centroids.at[c])
        computed += len(at)
        wins = (d < best[at]) | ((d == best[at]) & (c < a[at]))
        runs_up = ~wins & (d < next_best[at])
        w, r = at[wins], at[runs_up]
        b[w], next_best[w] = a[w], best[w]
        a[w], best[w] = c[wins], d[wins]
        b[r], next_best[r] = c[runs_up], d[runs_up]
        ball[at] = (reach[at] + np.sqrt(next_best[at].astype(float))) * (1 + _SLACK)
    near[rows], second[rows] = a, b
    known.upper[rows] = np.sqrt(best.astype(float)) * (1 + _SLACK)
    known.lower[rows] = np.sqrt(next_best.astype(float)) * (1 - _SLACK)
    return computed


_STATE = [("_near", IntegerType()), ("_second", IntegerType()), ("_upper", DoubleType()), ("_lower", DoubleType())]


def assigned(vectors: DataFrame, now: np.ndarray, before: np.ndarray | None, last: bool) -> DataFrame:
    """(__rest, _vector, and the bounds or in the last round _near and _distance) after one search of each vector."""
    fields = [f for f in vectors.schema.fields if f.name in (REST, "_vector")]
    state = [StructField(n, t) for n, t in (_STATE[:1] if last else _STATE)]
    schema = StructType([*fields, *state, *([StructField("_distance", LongType())] if last else [])])
    centroids = Centroids(now, before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column("_vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, now.shape[1])
            if before is None:
                known = Bounds.unknown(n, len(now))
            else:
                known = Bounds(*[np.array(batch.column(c).to_numpy(zero_copy_only=False), t) for c, t in _KINDS])
            search(x, known, centroids)
            near = pa.array(known.near.astype(np.int32))
            if last:
                made = [near, pa.array(squared(x, now[known.near]))]
            else:
                made = [near, pa.array(known.second.astype(np.int32)), pa.array(known.upper), pa.array(known.lower)]
            yield pa.RecordBatch.from_arrays([batch.column(REST), batch.column("_vector"), *made], schema.names)

    return map_arrow(vectors, run, schema)


_KINDS = [("_near", np.int64), ("_second", np.int64), ("_upper", float), ("_lower", float)]


def integer_vectors(vectors: DataFrame, column: str, components: int) -> DataFrame:
    """(__rest, _vector): the rows whose vector is whole and finite, as integers floor(64 x)."""
    fit = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    good = pack_rest(vectors, column).where(F.coalesce((F.size(column) == components) & fit, F.lit(False)))
    scaled = lambda x: F.floor(x.cast("double") * SCALE)
    checked = lambda x: F.when(F.abs(x.cast("double")) <= REACH / SCALE, scaled(x).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component is beyond {REACH // SCALE}: squared distances would not fit a long"))
    )
    return good.select(REST, F.transform(column, checked).alias("_vector"))


def first_centroids(vectors: DataFrame, key: str, k: int, seed: int) -> np.ndarray:
    """The k vectors with the least hash of the seed and their id, in that order."""
    name = F.coalesce(F.col(REST).getField(key).cast("string"), F.lit(""))
    least = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).alias("hash"), "_vector").orderBy("hash", "_vector")
    return np.array([r["_vector"] for r in least.limit(k).collect()], np.int64)


def moved_centroids(state: DataFrame, now: np.ndarray) -> np.ndarray:
    """Each centroid at the exact floor of its vectors' mean; one without vectors stays."""
    sums = [F.sum(F.get("_vector", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(now.shape[1])]
    out = now.copy()
    for row in state.groupBy("_near").agg(F.count("*").alias("n"), *sums).collect():  # one row a centroid
        out[row["_near"]] = [row[f"s{i}"] // row["n"] for i in range(now.shape[1])]
    return out


def cluster(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = CENTROIDS, components: int = COMPONENTS,
    rounds: int = ROUNDS, seed: int = 1,
) -> DataFrame:
    """(__rest, _vector, _near, _distance, _cluster_inertia, _inertia, _centroid) for every kept row of `vectors`.

    `__rest` is a struct of the row's other columns, `_vector` its integers, `_centroid` those of its final centroid.
    """
    return settled(vectors.sparkSession, "clusters", lambda: _cluster(vectors, key, column, k, components, rounds, seed))


def _cluster(vectors: DataFrame, key: str, column: str, k: int, components: int, rounds: int, seed: int) -> DataFrame:
    spark = vectors.sparkSession
    table = integer_vectors(vectors, column, components)
    now, before = first_centroids(table, key, k, seed).reshape(-1, components), None
    facts = "_near int, _cluster_inertia long, _inertia long, _centroid array<int>"
    if not len(now):
        none = table.select("*", F.lit(0).alias("_near"), F.lit(0).cast("long").alias("_distance"))
        return none.join(F.broadcast(spark.createDataFrame([], facts)), "_near").select(*_RESULT)
    for _ in range(rounds):
        table = store(assigned(table, now, before, last=False), "bounds")
        before, now = now, moved_centroids(table, now)
    table = store(assigned(table, now, before, last=True), "assigned")
    inertia = {r["_near"]: r["s"] for r in table.groupBy("_near").agg(F.sum("_distance").alias("s")).collect()}
    rows = [(j, s, sum(inertia.values()), [int(x) for x in now[j]]) for j, s in inertia.items()]
    return table.join(F.broadcast(spark.createDataFrame(rows, facts)), "_near").select(*_RESULT)


_RESULT = (REST, "_vector", "_near", "_distance", "_cluster_inertia", "_inertia", "_centroid")


def _rounds_sql(rounds: int) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT rid, c, (list_inner_product(x, x) - 2 * list_inner_product(x, m) + list_inner_product(m, m))::BIGINT AS d
    FROM v CROSS JOIN c{r}) GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(n.m, c{r}.m) AS m FROM c{r} LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) / n)::DOUBLE ORDER BY i) AS m FROM (
      SELECT a{r}.best.c AS c, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS n
      FROM v JOIN a{r} USING (rid) CROSS JOIN range(1, {COMPONENTS + 1}) AS t(i) GROUP BY ALL) GROUP BY c) AS n USING (c))""")
    return ",\n".join(steps)


SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [floor({SCALE} * e::DOUBLE) FOR e IN embedding] AS x
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e)]) = {COMPONENTS}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), x)::INT - 1 AS c, x AS m
  FROM v QUALIFY c < {CENTROIDS}
), {_rounds_sql(ROUNDS)}
SELECT vec_id, a{ROUNDS}.best.c::INT AS cluster, a{ROUNDS}.best.d AS distance,
       (sum(a{ROUNDS}.best.d) OVER (PARTITION BY a{ROUNDS}.best.c))::BIGINT AS cluster_inertia,
       (sum(a{ROUNDS}.best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string([e::BIGINT::VARCHAR FOR e IN c{ROUNDS}.m], ',')) AS centroid_sha256
FROM v JOIN a{ROUNDS} USING (rid) JOIN c{ROUNDS} ON c{ROUNDS}.c = a{ROUNDS}.best.c
"""
