"""Multi-job extraction: every feature x every job box it intersects.

The original tool runs one job (one box) per process.  Here a *table* of jobs
meets a *table* of features in one distributed join.  Spark has no range join,
so the operator picks one of three plans, each behind a size check made on the
small (jobs) side only:

``broadcast``       few boxes (<= ``broadcast_boxes``): the job table is
                    broadcast and every feature is tested against every box
                    (``BroadcastNestedLoopJoin``).  Features are never shuffled.
``grid_broadcast``  many boxes whose grid cells fit a proven bound
                    (<= ``broadcast_cells`` rows and about ``broadcast_bytes``
                    by the schema's row-size estimate): features and boxes are cut into
                    grid cells, the box cells are broadcast and joined by hash
                    on the cell key.  Features are still never shuffled.
``grid``            box cells too many to broadcast: both sides are
                    hash-partitioned on the cell key.  A cell that holds more
                    than 1/``hot_parts`` of one side's rows is split into
                    sub-keys on that side, one for each such share and at
                    least ``salts`` (the other side's rows of the cell
                    replicated), so a hot spot of features or of boxes never
                    lands in a single task.

In both grid plans the boxes of the coarsest levels, as many as are few (<= ``broadcast_boxes``, and
within ``broadcast_bytes``), don't go to cells: they are broadcast and tested against every feature, as in
``broadcast``, so that a hundred continental boxes beside many small ones don't copy every feature to the
coarse cells.

Grid details: cells are squares of side ``c * 8**level``, up to the side of the
extent of all job boxes, in the data's own units.  Feature boxes are clipped to
that extent first, which also leaves out features that meet no job.  Each object
sits at the finest level where it covers at most ``max_cells`` cells, so a
continent-sized polygon or box does not explode into millions of rows.  Boxes
with min > max are cut into cells by their ordered corners and then tested as
they are, so they find what the box filter (F1) finds.  A
pair is emitted only once, in the cell that holds the lower-left corner of the
overlap of the two boxes, at the coarser of the two objects' levels
(reference-point duplicate avoidance), so no ``distinct`` is needed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geospan.functions.bbox import bbox_intersects
from geospan.operators.extent import extent
from geospan.session import ensure_checkpoint_dir

LEVEL_FACTOR = 8


@dataclass
class GridSpec:
    sizes: list          # cell side per level, coarsest >= side of the jobs' extent
    max_cells: int

    @property
    def levels(self) -> int:
        return len(self.sizes)


def grid_spec(cell_size: float, max_cells: int = 16, side: float = 360.0) -> GridSpec:
    """Levels from ``cell_size`` to the first that is at least ``side`` (at most 13 levels)."""
    sizes = [max(float(cell_size), side / LEVEL_FACTOR ** 12, 1e-7)]
    while sizes[-1] < side:
        sizes.append(sizes[-1] * LEVEL_FACTOR)
    return GridSpec(sizes, max_cells)


def _span(b: Column, s) -> Column:
    nx = F.floor(b.xmax / s) - F.floor(b.xmin / s) + 1
    ny = F.floor(b.ymax / s) - F.floor(b.ymin / s) + 1
    return nx * ny


def own_level(b: Column, spec: GridSpec) -> Column:
    """Finest level at which the box covers at most ``max_cells`` cells."""
    expr = F.lit(spec.levels - 1)
    for lvl in reversed(range(spec.levels - 1)):
        expr = F.when(_span(b, spec.sizes[lvl]) <= spec.max_cells, F.lit(lvl)).otherwise(expr)
    return expr


def explode_cells(df: DataFrame, b: Column, own: Column, spec: GridSpec,
                  levels: Sequence[int] | None = None) -> DataFrame:
    """One row per grid cell a box covers, at its own level and at every
    coarser level in ``levels`` (all coarser levels when None).

    Built from chained ``explode(sequence(..))`` generators, which stay in
    generated code, rather than nested array lambdas."""
    allowed = set(range(spec.levels)) if levels is None else set(levels)
    lv = F.array_compact(F.array(*[
        F.when((own == lvl) | ((own < lvl) & F.lit(lvl in allowed)), F.lit(lvl))
        for lvl in range(spec.levels)]))
    sizes = F.array(*[F.lit(x) for x in spec.sizes])
    out = df.withColumn("lvl", F.explode(lv))
    s = F.element_at(sizes, F.col("lvl") + 1)
    out = out.withColumn("cx", F.explode(F.sequence(F.floor(b.xmin / s), F.floor(b.xmax / s))))
    return out.withColumn("cy", F.explode(F.sequence(F.floor(b.ymin / s), F.floor(b.ymax / s))))


def _valid_box(b: Column) -> Column:
    return reduce(lambda p, v: p & v.isNotNull() & ~F.isnan(v),
                  (b.xmin, b.ymin, b.xmax, b.ymax), b.isNotNull())


def _ordered(b: Column) -> Column:
    """The box with its corners in order; the same box unless it has min > max."""
    return F.struct(F.least(b.xmin, b.xmax).alias("xmin"), F.least(b.ymin, b.ymax).alias("ymin"),
                    F.greatest(b.xmin, b.xmax).alias("xmax"), F.greatest(b.ymin, b.ymax).alias("ymax"))


def _keep_once(fb: Column, jb: Column, spec: GridSpec) -> Column:
    sizes = F.array(*[F.lit(s) for s in spec.sizes])
    s = F.element_at(sizes, F.col("lvl") + 1)
    rx = F.greatest(fb.xmin, jb.xmin)
    ry = F.greatest(fb.ymin, jb.ymin)
    return ((F.col("lvl") == F.greatest(F.col("_f_lvl"), F.col("_j_lvl")))
            & (F.floor(rx / s) == F.col("cx")) & (F.floor(ry / s) == F.col("cy")))


@dataclass
class BoxStats:
    n: int               # boxes without a NULL or NaN corner
    median_side: float
    extent: tuple        # xmin, ymin, xmax, ymax of all of them
    bytes: int           # of all job rows, as JSON text

    @property
    def side(self) -> float:
        return max(self.extent[2] - self.extent[0], self.extent[3] - self.extent[1])


def box_stats(jobs: DataFrame, job_bbox: str = "job_bbox") -> BoxStats:
    """Number, median side, extent and bytes of the job boxes: one aggregate over the jobs."""
    valid = jobs.where(_valid_box(F.col(job_bbox)))
    b = _ordered(F.col(job_bbox))
    r = valid.agg(F.count(F.lit(1)).alias("n"),
                  F.percentile_approx(F.greatest(b.xmax - b.xmin, b.ymax - b.ymin), 0.5).alias("s"),
                  F.min(b.xmin).alias("x0"), F.min(b.ymin).alias("y0"),
                  F.max(b.xmax).alias("x1"), F.max(b.ymax).alias("y1"),
                  F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")).first()
    if not r["n"]:
        return BoxStats(0, 1.0, (0.0, 0.0, 0.0, 0.0), 0)
    return BoxStats(r["n"], float(r["s"]), (r["x0"], r["y0"], r["x1"], r["y1"]), r["bytes"])


def choose_cell_size(jobs: DataFrame, job_bbox: str = "job_bbox") -> float:
    """Median box side of the job boxes (one small aggregate over the jobs)."""
    return box_stats(jobs, job_bbox).median_side


def _prepare_jobs(jobs: DataFrame, bbox: str) -> DataFrame:
    if bbox != "job_bbox":
        if "job_bbox" in jobs.columns:
            raise ValueError("jobs frame already has a job_bbox column")
        jobs = jobs.withColumnRenamed(bbox, "job_bbox")
    return jobs


def extract_jobs(features: DataFrame, jobs: DataFrame, strategy: str = "auto",
                 feature_bbox: str = "bbox", job_bbox: str = "bbox",
                 cell_size: float | None = None, max_cells: int = 16,
                 broadcast_boxes: int = 64, broadcast_cells: int = 1_000_000,
                 broadcast_bytes: int = 256 << 20,
                 salts: int = 2, hot_parts: int | None = None, coarse: bool = True) -> DataFrame:
    """Feature rows paired with every job whose box they intersect.

    Output: all feature columns, all job columns (the job box as ``job_bbox``).  ``coarse=False`` sends
    boxes of every level to cells.
    """
    jobs = _prepare_jobs(jobs, job_bbox)
    clash = sorted(set(features.columns) & set(jobs.columns))
    if clash:
        raise ValueError(f"features and jobs share column names {clash}; rename one side")
    fb, jb = F.col(feature_bbox), F.col("job_bbox")
    # One aggregate gives the box count and bytes (the broadcast bounds), the
    # median box side (the grid cell size) and the extent (the coarsest level).
    found = box_stats(jobs)
    if strategy == "auto":
        strategy = "broadcast" if found.n <= broadcast_boxes else "grid_auto"
    if strategy == "broadcast" and found.bytes > broadcast_bytes:
        strategy = "grid"
    if strategy == "broadcast" or not found.n:
        return features.where(_valid_box(fb)).join(
            F.broadcast(jobs.where(_valid_box(jb))), bbox_intersects(fb, jb), "inner")

    spec = grid_spec(cell_size or found.median_side, max_cells, found.side)
    x0, y0, x1, y1 = (F.lit(v) for v in found.extent)
    fo, jo = _ordered(fb), _ordered(jb)
    clipped = F.struct(F.greatest(fo.xmin, x0).alias("xmin"), F.greatest(fo.ymin, y0).alias("ymin"),
                       F.least(fo.xmax, x1).alias("xmax"), F.least(fo.ymax, y1).alias("ymax"))
    near = features.where(_valid_box(fb) & (fo.xmin <= x1) & (fo.xmax >= x0) & (fo.ymin <= y1) & (fo.ymax >= y0))
    jlev = jobs.where(_valid_box(jb)).withColumn("_j_box", jo).withColumn("_j_lvl", own_level(F.col("_j_box"), spec))
    # One aggregate gives the levels at which job boxes live (features must also appear there), what they
    # weigh, and the exact number of box cells, the proven bound checked before broadcasting them.
    sizes = F.array(*[F.lit(x) for x in spec.sizes])
    s_own = F.element_at(sizes, F.col("_j_lvl") + 1)
    levels = {r["_j_lvl"]: r for r in jlev.groupBy("_j_lvl").agg(
        F.count(F.lit(1)).alias("n"), F.sum(_span(F.col("_j_box"), s_own)).alias("own_cells"),
        F.sum(F.octet_length(F.to_json(F.struct(*jobs.columns)))).alias("bytes")).collect()}  # 13 levels at most
    few, n, size = [], 0, 0
    for lvl in sorted(levels, reverse=True) if coarse else ():
        n, size = n + levels[lvl]["n"], size + levels[lvl]["bytes"]
        if n > broadcast_boxes or size > broadcast_bytes or len(few) == len(levels) - 1:
            break  # at least the finest level goes to cells
        few.append(lvl)
    if few:
        large = jlev.where(F.col("_j_lvl").isin(few)).drop("_j_box", "_j_lvl")
        jlev = jlev.where(~F.col("_j_lvl").isin(few))
    box_levels = sorted(set(levels) - set(few))
    own_cells, boxes = (sum(levels[v][c] for v in box_levels) for c in ("own_cells", "n"))
    jcells = explode_cells(jlev, F.col("_j_box"), F.col("_j_lvl"), spec)
    fcells = explode_cells(near.withColumn("_f_box", clipped).withColumn("_f_lvl", own_level(F.col("_f_box"), spec)),
                           F.col("_f_box"), F.col("_f_lvl"), spec, box_levels)
    keys = ["lvl", "cx", "cy"]

    if strategy in ("grid_auto", "grid_broadcast"):
        # Exact cells at each box's own level, plus at most ``max_cells``
        # cells per box at every coarser level (cells only grow upwards).
        bound = own_cells + boxes * (spec.levels - 1) * spec.max_cells
        if bound > broadcast_cells:
            bound = jcells.limit(broadcast_cells + 1).count()
        # Rows are bounded above; bytes too, by the mean size of the job rows
        # (a cell adds about 100 bytes), so wide rows do not slip through.
        small = bound <= broadcast_cells and bound * (found.bytes / found.n + 100) <= broadcast_bytes
        strategy = "grid_broadcast" if small else "grid"
    if strategy == "grid_broadcast":
        joined = fcells.join(F.broadcast(jcells), keys, "inner")
    elif strategy == "grid":
        joined = _salted_cell_join(features.sparkSession, fcells, jcells, keys, salts, hot_parts)
    else:
        raise ValueError(f"unknown strategy {strategy}")
    out = joined.where(bbox_intersects(fb, jb) & _keep_once(F.col("_f_box"), F.col("_j_box"), spec))
    out = out.drop(*keys, "_f_lvl", "_j_lvl", "_f_box", "_j_box")
    if few:
        out = out.unionByName(features.where(_valid_box(fb)).join(F.broadcast(large), bbox_intersects(fb, jb), "inner"))
    return out


def _hot_cells(spark, cells: DataFrame, keys: list, hot_parts: int, salts: int) -> dict:
    """Sub-keys of each cell holding more than 1/``hot_parts`` of one side's rows: one for every
    such share, at least ``salts``.

    The per-cell counts (partial-aggregated, one row per distinct cell) are
    checkpointed once; the total and the hot cells are read from that small
    table, so the big side is scanned a single time for this.  At most
    ``hot_parts`` cells can qualify, so the returned list is bounded."""
    counts = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    total = counts.agg(F.sum("_n").alias("t")).first()["t"] or 0
    threshold = max(total // max(hot_parts, 1), 1)
    hot = counts.where(F.col("_n") > threshold).select(*keys, "_n").collect()
    return {tuple(r)[:-1]: max(salts, -(-r["_n"] // threshold)) for r in hot}


def _written(spark, cells: DataFrame) -> DataFrame:
    """``cells`` as Parquet in the shared checkpoint folder, read again; counts then read the key columns alone.  The folder
    stays until the owner of the checkpoint folder clears it.  Types that Parquet can't hold go through a checkpoint."""
    if any(kind in cells.schema.simpleString() for kind in ("void", "interval", "variant")):
        return cells.checkpoint()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cells-{uuid.uuid4().hex}"
    cells.write.parquet(path)
    return spark.read.schema(cells.schema).parquet(path)


def _salted_cell_join(spark, fcells: DataFrame, jcells: DataFrame, keys: list,
                      salts: int, hot_parts: int | None) -> DataFrame:
    """Shuffle join on cell keys with hot cells split on both sides.

    A cell hot in features gets its feature rows spread over sub-keys
    (``_fs``) and its box rows replicated to each; a cell hot in boxes gets the
    mirror treatment (``_bs``).  A cell hot on both sides is split into blocks
    of both.  Each (feature, box) pair of the cell
    meets in exactly one block.  Salts come from a hash of the row's own
    columns, so a retried task deals its rows alike, in whatever order they come; rows that are
    equal throughout share a salt."""
    ensure_checkpoint_dir(spark)
    if hot_parts is None:
        hot_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # built once: the counts and the join read the same written cells, so neither the features nor the cutting is done again
    fcells, jcells = (_written(spark, c) for c in (fcells, jcells))
    hot_f = _hot_cells(spark, fcells, keys, hot_parts, salts)
    hot_b = _hot_cells(spark, jcells, keys, hot_parts, salts)
    rows = [(*k, hot_f.get(k, 1), hot_b.get(k, 1)) for k in sorted({*hot_f, *hot_b})]
    hot = F.broadcast(spark.createDataFrame(rows, "lvl int, cx bigint, cy bigint, _hf bigint, _hb bigint"))

    def spread(n):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(n), F.lit(1)) - 1))

    def own_salt(df, n):
        cols = [f.name for f in df.schema.fields if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))
                and not f.name.startswith("_h")]
        return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.coalesce(F.col(n), F.lit(1)))

    f = (fcells.join(hot, keys, "left")
         .withColumn("_fs", own_salt(fcells, "_hf"))
         .withColumn("_bs", spread("_hb"))
         .drop("_hf", "_hb"))
    j = (jcells.join(hot, keys, "left")
         .withColumn("_bs", own_salt(jcells, "_hb"))
         .withColumn("_fs", spread("_hf"))
         .drop("_hf", "_hb"))
    return f.join(j, keys + ["_fs", "_bs"], "inner").drop("_fs", "_bs")


def job_summary(features: DataFrame, jobs: DataFrame, job_key: str | Sequence[str] = "job_name",
                strategy: str = "auto", **kw) -> DataFrame:
    """J3 (flagship): per job, the number of intersecting features and their
    extent.  Only the feature box is carried into the join (column pruning),
    and the aggregate is partial per task, so a job box that catches a third of
    all features is still combined map-side."""
    keys = [job_key] if isinstance(job_key, str) else list(job_key)
    fbox = kw.pop("feature_bbox", "bbox")
    jbox = kw.pop("job_bbox", "bbox")
    limit = kw.get("broadcast_boxes", 64)
    few = False
    if strategy == "auto":
        few = jobs.limit(limit + 1).count() <= limit
        strategy = "broadcast" if few else "auto"
    slim_f = features.select(F.col(fbox).alias("bbox"))
    slim_j = jobs.select(*keys, F.col(jbox).alias("job_bbox"))
    pairs = extract_jobs(slim_f, slim_j, strategy=strategy, job_bbox="job_bbox", **kw)
    summary = extent(pairs, by=keys)
    # Jobs that catch nothing are reported with a zero count and NULL extent.
    # Both sides hold one row per job; with a proven-small job table the
    # summary is broadcast, otherwise AQE picks the join from runtime sizes.
    right = F.broadcast(summary) if few else summary
    return (jobs.select(*keys).join(right, keys, "left")
            .withColumn("feature_count", F.coalesce(F.col("feature_count"), F.lit(0))))
