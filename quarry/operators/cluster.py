"""K-means over binary incidence with chosen start centroids, to a stable state.

Centroids are held as integer counts: ``cnt(cluster, feature)`` = members of
the cluster having the feature, ``sz`` = members, ``s2`` = sum of ``cnt^2``.
The mean vector is ``cnt / sz``, so the squared distance of entity ``x``
(``nx`` features) to cluster ``c`` is

    nx - 2 * s1 / sz + s2 / sz^2,   s1 = sum of cnt over the features of x

with exact integer sums. Real-valued vectors (a ``value`` column) use the same
formula with ``cnt`` = sum of member values, ``nx`` = squared norm and ``s1`` =
the dot product of the entity with ``cnt``. Distances are rounded to
``DIGITS`` decimals before they are compared, so that two clusters at the same
distance tie whatever the order of the additions, and a tie goes to the
smaller id.

``assign`` and ``update`` are one pass as joins: the incidence rows meet one
row per feature that holds the counts of up to ``GROUP`` clusters, a 1:1 join,
and an aggregation keyed by entity sums them. More clusters are handled
``GROUP`` at a time with the same formula, and the nearest of the groups' best
wins; no entity x cluster grid and no cross product is built. Two scalars per
cluster (size and sum of squares) travel to the driver per pass. ``kmeans`` runs
such passes only where the centroids are too large to be sent whole; else it
runs those of ``lloyd``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import md5_order_key
from quarry.operators import lloyd
from quarry.operators.incidence import sizes
from quarry.operators.indexing import row_index
from quarry.operators.lloyd import DIGITS, NotStable
from quarry.session import BROADCAST_ROWS, drop_written, scratch_dir, written_table


def init_centroids(entities: DataFrame, k: int, seed: int | None = None,
                   chosen: Sequence[str] | None = None) -> DataFrame:
    """``(cluster, entity)`` for ``k`` start entities; ids follow entity order.

    Either the caller names the entities (``chosen``), or they are the ``k``
    smallest by ``md5(seed:entity)``: a seeded choice that is the same on any
    engine and any partitioning. ``orderBy().limit(k)`` is a per-task top-k.
    """
    e = entities.select("entity").distinct()
    if chosen is not None:
        pick = e.where(F.col("entity").isin(list(chosen)))
    else:
        pick = e.orderBy(md5_order_key("entity", seed), "entity").limit(k)
    # at most k rows reach this window
    return pick.select((F.row_number().over(Window.orderBy("entity")) - 1).cast("int").alias("cluster"),
                       "entity")


def _v(value: str | None):
    return F.col(value).cast("double") if value else F.lit(1).cast("long")


def norms(inc: DataFrame, value: str | None = None, name: str = "nx") -> DataFrame:
    """``(entity, nx)``: squared norm (= number of features for 0/1 vectors)."""
    if value is None:
        return sizes(inc, name)
    return inc.groupBy("entity").agg(F.sum(_v(value) * _v(value)).alias(name))


def initial_state(inc: DataFrame, start: DataFrame, value: str | None = None):
    """Count form of the start centroids: each is one entity (``sz`` = 1).

    Returns ``(cnt, meta)``: the ``(cluster, feature, cnt)`` table and the
    driver-side ``{cluster: (sz, s2)}`` of ``k`` entries.
    """
    cnt = (inc.join(start, "entity")
           .select("cluster", "feature", _v(value).alias("cnt")))
    zero = F.lit(0.0) if value else F.lit(0).cast("long")
    rows = (start.join(norms(inc, value), "entity", "left")
            .select("cluster", F.coalesce("nx", zero).alias("s2")).collect())
    return cnt, {r["cluster"]: (1, r["s2"]) for r in rows}


GROUP = 32   # clusters whose sums one aggregate holds


def wide_counts(cnt: DataFrame, clusters: Sequence[int]) -> DataFrame:
    """One row per feature with a column ``c_<id>`` for each of the clusters."""
    return (cnt.where(F.col("cluster").isin(list(clusters))).groupBy("feature")
            .agg(*[F.sum(F.when(F.col("cluster") == c, F.col("cnt"))).alias(f"c_{c}") for c in clusters]))


def _best_of(inc, nx, cnt, meta, clusters, value, side):
    """``(entity, best)``: the nearest of some clusters as ``struct(dist, cluster)``."""
    dots = (inc.join(side(wide_counts(cnt, clusters)), "feature").groupBy("entity")
            .agg(*[F.sum(F.col(f"c_{c}") * _v(value) if value else F.col(f"c_{c}")).alias(f"s1_{c}") for c in clusters]))
    cands = []
    for c in clusters:
        sz, s2 = (float(x) for x in meta[c])
        s1 = F.coalesce(F.col(f"s1_{c}"), F.lit(0)).cast("double")
        d = F.col("nx").cast("double") - F.lit(2.0) * s1 / F.lit(sz) + F.lit(s2) / (F.lit(sz) * F.lit(sz))
        cands.append(F.struct(F.round(d, DIGITS).alias("dist"), F.lit(c).alias("cluster")))
    best = F.least(*cands) if len(cands) > 1 else cands[0]
    return nx.join(dots, "entity", "left").select("entity", best.alias("best"))


def assign(inc: DataFrame, nx: DataFrame, cnt: DataFrame, meta: dict[int, tuple[int, int]],
           k: int | None = None, value: str | None = None, broadcast_counts: bool = False) -> DataFrame:
    """``(entity, cluster, dist)``: the nearest cluster, ties to the smaller id.

    ``broadcast_counts``: the caller has counted the features and knows that a
    row per feature and group of clusters is small."""
    ids = sorted(meta) if k is None else sorted(meta)[:k]
    side = F.broadcast if broadcast_counts else (lambda df: df)
    best = None
    for at in range(0, len(ids), GROUP):
        part = _best_of(inc, nx, cnt, meta, ids[at:at + GROUP], value, side)
        best = part if best is None else best.unionByName(part)
    if len(ids) > GROUP:
        best = best.groupBy("entity").agg(F.min("best").alias("best"))
    return best.select("entity", F.col("best.cluster").alias("cluster"), F.col("best.dist").alias("dist"))


def cluster_sizes(assignment: DataFrame) -> dict[int, int]:
    """``{cluster: members}`` (at most ``k`` rows reach the driver)."""
    return {r["cluster"]: r["sz"] for r in
            assignment.groupBy("cluster").agg(F.count(F.lit(1)).alias("sz")).collect()}


def update(inc: DataFrame, assignment: DataFrame, old_cnt: DataFrame,
           old_meta: dict[int, tuple[int, int]], checkpoint: bool = False,
           sz: dict[int, int] | None = None, value: str | None = None):
    """New centroid counts from an assignment; an emptied cluster keeps its old centroid.

    Returns ``(cnt, meta)`` like ``initial_state``. Aggregates of at most
    ``k`` rows reach the driver (``sz`` may be passed in when known).
    """
    a = assignment.select("entity", "cluster")
    cnt = (inc.join(a, "entity").groupBy("cluster", "feature")
           .agg(F.sum(_v(value)).alias("cnt")))
    if checkpoint:
        cnt = written_table(cnt, "kmeans-counts")
    if sz is None:
        sz = cluster_sizes(a)
    s2 = {r["cluster"]: r["s2"] for r in
          cnt.groupBy("cluster").agg(F.sum(F.col("cnt") * F.col("cnt")).alias("s2")).collect()}
    meta = {c: (sz[c], s2.get(c) or 0) for c in sz}
    empty = [c for c in old_meta if c not in sz]
    for c in empty:
        meta[c] = old_meta[c]
    if empty:
        cnt = cnt.unionByName(old_cnt.where(F.col("cluster").isin(empty)).select("cluster", "feature", "cnt"))
        if checkpoint:  # or the plan would grow with every pass that keeps an emptied cluster
            cnt = written_table(cnt, "kmeans-counts")
    return cnt, meta


def weights(cnt: DataFrame, meta: dict[int, tuple[int, int]]) -> DataFrame:
    """``(cluster, feature, weight)``: the mean vector in long form."""
    sz = F.create_map(*[x for c, (n, _) in sorted(meta.items()) for x in (F.lit(c), F.lit(n))])
    return cnt.select("cluster", "feature", (F.col("cnt") / F.element_at(sz, F.col("cluster"))).alias("weight"))


def _all_norms(inc: DataFrame, value: str | None, entities: DataFrame | None) -> DataFrame:
    """Norms of the incidence's entities, plus norm 0 for listed entities without features."""
    nx = norms(inc, value)
    if entities is None:
        return nx
    zero = F.lit(0.0) if value else F.lit(0).cast("long")
    return (entities.select("entity").distinct().join(nx, "entity", "left")
            .select("entity", F.coalesce("nx", zero).alias("nx")))


def first_iter(inc: DataFrame, start: DataFrame, value: str | None = None,
               entities: DataFrame | None = None) -> DataFrame:
    """``(centroid, member)``: each entity under its nearest start entity.

    ``entities`` lists entities to place even when they have no feature (an
    all-zero vector).
    """
    k = start.count()
    cnt, meta = initial_state(inc, start, value)
    a = assign(inc, _all_norms(inc, value, entities), cnt, meta, k, value)
    return a.join(start.withColumnRenamed("entity", "centroid"), "cluster").select("centroid",
                                                                                   F.col("entity").alias("member"))


class KMeansResult(NamedTuple):
    assignment: DataFrame   # (entity, cluster, dist)
    passes: int             # assignments after the first
    moved: int              # entities that the last pass moved; 0 when stable


def kmeans(inc: DataFrame, start: DataFrame, max_iter: int | None = None,
           num_partitions: int | None = None, value: str | None = None,
           broadcast_rows: int = BROADCAST_ROWS,
           entities: DataFrame | None = None, written: bool = False) -> KMeansResult:
    """Assign and update until no entity changes cluster.

    Without ``max_iter`` the result is stable. With it, at most so many passes
    run and ``moved`` says whether the last one still moved entities. Should
    the assignments ever return to an earlier one without being stable (equal
    distances beyond the compared digits), ``NotStable`` is raised.
    ``entities`` lists entities to cluster even when they have no feature.

    ``num_partitions`` deals the incidence anew; ``written``: the caller has
    written it. Clusters x features and the entities are counted once.

    * Centroids of at most ``broadcast_rows`` numbers go to every task, and
      passes run over packed vectors with distance bounds (``lloyd``): only
      entities that their bounds leave open are measured, only moved ones
      change the centroids.
    * Above it, a pass joins the incidence with one row per feature (shuffled),
      and with the assignment (broadcast up to ``broadcast_rows`` entities).
      Assignment and counts are written below the shared folder and those of
      the pass before deleted, so the plan stays one pass long and a lost
      executor recomputes at most one pass.
    """
    scratch_dir(inc.sparkSession)
    start = start.checkpoint()
    base = inc.select("entity", "feature", *([value] if value else []))
    if num_partitions:
        base = base.repartition(num_partitions)
    inc_b = base if written and not num_partitions else base.checkpoint()
    nx = _all_norms(inc_b, value, entities).checkpoint()
    n_entities, k = nx.count(), start.count()
    index, n_features = row_index(inc_b.select("feature").distinct(), ["feature"], with_total=True)
    cnt, meta = initial_state(inc_b, start, value)
    if n_features * k <= broadcast_rows and sorted(meta) == list(range(k)):
        return KMeansResult(*lloyd.passes(inc_b, nx, cnt, index, n_features, n_entities, k, max_iter, value))
    return _joined_passes(inc_b, nx, cnt, meta, n_entities, max_iter, value, n_entities <= broadcast_rows)


def _joined_passes(inc_b: DataFrame, nx: DataFrame, cnt: DataFrame, meta: dict, n_entities: int, max_iter: int | None,
                   value: str | None, small_a: bool) -> KMeansResult:
    """Passes whose centroid counts stay a table."""
    a = written_table(assign(inc_b, nx, cnt, meta, None, value), "kmeans-assigned")
    sz = cluster_sizes(a)
    passes, moved, seen = 0, n_entities, set()
    while moved and (max_iter is None or passes < max_iter):
        passes += 1
        before, old = cnt, a
        cnt, meta = update(inc_b, F.broadcast(a) if small_a else a, cnt, meta, checkpoint=True, sz=sz, value=value)
        nxt = written_table(assign(inc_b, nx, cnt, meta, None, value)
                            .join(a.select("entity", F.col("cluster").alias("__old")), "entity")
                            .withColumn("__changed", (F.col("cluster") != F.col("__old")).cast("int"))
                            .drop("__old"), "kmeans-assigned")
        # one k-row aggregate gives the next sizes, the number of moves and a mark of the state
        stats = (nxt.groupBy("cluster").agg(F.count(F.lit(1)).alias("sz"), F.sum("__changed").alias("moved"),
                                            F.sum(F.xxhash64("entity", "cluster").cast("decimal(38,0)")).alias("mark"))
                 .collect())
        drop_written(*(t for t in (before, old) if hasattr(t, "_written_path")))
        sz = {r["cluster"]: r["sz"] for r in stats}
        moved = sum(r["moved"] for r in stats)
        a = nxt.drop("__changed")
        a._written_path = nxt._written_path
        mark = sum(r["mark"] for r in stats)
        if moved and mark in seen:
            raise NotStable(f"{moved} entities still move after {passes} passes, and the state has come up before")
        seen.add(mark)
    return KMeansResult(a, passes, moved)


def classes(assignment: DataFrame) -> DataFrame:
    """``(leader, member)``: each class named by its smallest member."""
    leaders = assignment.groupBy("cluster").agg(F.min("entity").alias("leader"))
    return assignment.join(leaders, "cluster").select("leader", F.col("entity").alias("member"))
