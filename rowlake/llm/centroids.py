"""Centroid clustering of whole-number vectors by expressions of the JVM alone.

A vector counts if it has exactly ``DIMENSIONS`` components, none null or not
finite; each component becomes floor(``SCALE`` times it). The table of these
is written once in the shared folder, then every round is one pass over it
without Python: ``zip_with`` and ``aggregate`` give the squared distances to
the centroids, which stand in the plan as literal arrays; ``array_min`` of
(distance, number) structs chooses the cluster, ties going to the smaller
number; column sums by cluster give the next centroids. A task hands on one
row per cluster, so a cluster of a third of all vectors costs no more than any
other, and the driver gets ``CLUSTERS`` rows of sums a round, whatever the
table holds. A round that changes no centroid is the last one that can.

Results for odd input: vectors that do not count have no row; repeated rows and
rows without an id are vectors like any other, but a row without an id is a
first centroid only where too few rows have one; fewer vectors than centroids
make each a centroid; no vectors give no rows. Components beyond ``LARGEST``
after scaling are an error, because their distances would not fit a long.
Further columns may have any name.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F

from rowlake.workspace import new_folder

DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
#: 64 squares of differences of numbers up to this fit into a long.
LARGEST = 1 << 27


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: the vectors that count, as arrays of longs."""
    own = vectors.select("vec_id", F.expr("transform(embedding, x -> cast(x as double))").alias("x"))
    counts = f"size(x) = {dimensions} and forall(x, e -> e is not null and not isnan(e) and abs(e) < double('infinity'))"
    scaled = (
        f"transform(x, e -> if(abs({scale} * e) <= {LARGEST}, floor({scale} * e),"
        f" cast(raise_error(concat('a component is too large to cluster: ', e)) as bigint)))"
    )
    return own.where(counts).select("vec_id", F.expr(scaled).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids, in the order of these; equal ids in the order of their vectors."""
    hashed = vectors.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    return [list(r.v) for r in hashed.orderBy(F.col("h").asc_nulls_last(), "v").limit(clusters).select("v").collect()]


def _best(centroids: list[list[int]]) -> str:
    """SQL for the struct of the distance to the nearest centroid and its number."""
    def literal(centroid):
        return "array(" + ", ".join(f"{x}L" for x in centroid) + ")"

    each = (
        f"named_struct('distance', aggregate(zip_with(v, {literal(c)}, (a, b) -> (a - b) * (a - b)), 0L, (s, x) -> s + x),"
        f" 'cluster', {i})"
        for i, c in enumerate(centroids)
    )
    return f"array_min(array({', '.join(each)}))"


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``vec_id, v, cluster, distance`` of every whole vector."""
    best = vectors.withColumn("best", F.expr(_best(centroids)))
    return best.select("vec_id", "v", F.col("best.cluster").alias("cluster"), F.col("best.distance").alias("distance"))


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: the floored means of their vectors; those without vectors stay."""
    dimensions = len(centroids[0])
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dimensions)]
    rows = assigned(vectors, centroids).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    means = {r["cluster"]: [r[f"s{i}"] // r["n"] for i in range(dimensions)] for r in rows}
    return [means.get(i, c) for i, c in enumerate(centroids)]


def cluster(
    vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, clusters: int = CLUSTERS,
    rounds: int = ROUNDS, seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every vector that counts, as a written table, and the final centroids."""
    spark = vectors.sparkSession
    folder = new_folder(spark, "centroids-vectors")
    whole_vectors(vectors, dimensions, scale).write.parquet(folder)
    whole = spark.read.parquet(folder)
    centroids = first_centroids(whole, clusters, seed)
    for _ in range(rounds if centroids else 0):
        before, centroids = centroids, moved(whole, centroids)
        if centroids == before:
            break
    placed = assigned(whole, centroids) if centroids else whole.selectExpr("vec_id", "v", "0 as cluster", "0L as distance")
    folder = new_folder(spark, "centroids-assigned")
    placed.drop("v").write.parquet(folder)
    return spark.read.parquet(folder), centroids


def report(vectors: DataFrame, **options) -> DataFrame:
    """The clusters of all vectors, with the inertia of each and of all, and a digest of the final centroid."""
    placed, centroids = cluster(vectors, **options)
    inertia = {r["cluster"]: r["total"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    of_cluster = [(i, inertia.get(i, 0), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids)]
    known = vectors.sparkSession.createDataFrame(of_cluster, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    # One row per centroid, so it may be broadcast.
    return placed.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), "centroid_sha256"
    )


def oracle_sql(
    dimensions: int = DIMENSIONS, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> str:
    """The same clusters for DuckDB: one joined pass over (vector, place, value) rows per round."""
    parts = [f"""kept as materialized (
  select row_number() over () as r, vec_id, embedding as x from embeddings
  where len(embedding) = {dimensions} and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0),
cells as materialized (
  select r, p, floor({scale} * x[p]::double)::bigint as v from (select r, x, unnest(range(1, {dimensions} + 1)) as p from kept)),
first as (select r, row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as c from kept qualify c < {clusters}),
c0 as materialized (select c, p, v from first join cells using (r))"""]
    for i in range(rounds + 1):
        parts.append(f"""d{i} as materialized (
  select r, c, sum((cells.v - c{i}.v) * (cells.v - c{i}.v))::bigint as d from cells join c{i} using (p) group by r, c),
a{i} as materialized (select r, arg_min(c, (d, c)) as c, min(d) as d from d{i} group by r)""")
        if i < rounds:
            parts.append(f"""m{i} as (
  select a.c, p, sum(v)::bigint as s, count(*) as n from a{i} a join cells using (r) group by a.c, p),
c{i + 1} as materialized (
  select c, p, coalesce((s - ((s % n) + n) % n) // n, v) as v from c{i} left join m{i} using (c, p))""")
    last = rounds
    return "with " + ",\n".join(parts) + f"""
select vec_id, c::int as cluster, d as distance, (sum(d) over (partition by c))::bigint as cluster_inertia,
  (sum(d) over ())::bigint as inertia, h as centroid_sha256
from a{last} join kept using (r) join (select c, sha256(string_agg(v::varchar, ',' order by p)) as h from c{last} group by c) using (c)
"""
