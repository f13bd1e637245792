"""Benchmark of the headline geospan queries.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default sf0.1) and
prints one JSON line: total seconds plus per-query medians of 3 runs.  Each
run executes the full plan into Spark's ``noop`` sink (nothing is collected
to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


from geospan.operators.extent import extent  # noqa: E402
from geospan.operators.extract import extract_jobs, job_summary  # noqa: E402
from geospan.operators.filters import bbox_filter  # noqa: E402
from geospan.operators.geometry import decode_geometry  # noqa: E402
from geospan.operators.pages import assemble_linked_pages, assemble_offset_pages  # noqa: E402
from geospan.plans.oracle import FILTER_BOX  # noqa: E402
from geospan.session import build_session  # noqa: E402
from geospan.sinks.export import write_geoparquet  # noqa: E402
from geospan.sources import derived as D  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    times = []
    for _ in range(REPEAT):
        t0 = time.perf_counter()
        run(fn())
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def row_groups_read(path: str, box) -> dict:
    """Row groups of the stored features whose bbox statistics meet the box
    (the ones a pushed-down filter must read) versus all row groups."""
    import glob

    import pyarrow.parquet as pq
    x0, y0, x1, y1 = box
    total = hit = 0
    for f in glob.glob(f"{path}/*.parquet"):
        md = pq.ParquetFile(f).metadata
        names = [md.schema.column(i).path for i in range(md.num_columns)]
        idx = {n: names.index(f"bbox.{n}") for n in ("xmin", "ymin", "xmax", "ymax")}
        for r in range(md.num_row_groups):
            rg = md.row_group(r)
            st = {n: rg.column(i).statistics for n, i in idx.items()}
            total += 1
            if (st["xmin"].min <= x1 and st["xmax"].max >= x0
                    and st["ymin"].min <= y1 and st["ymax"].max >= y0):
                hit += 1
    return {"total": total, "read": hit}


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="geospan-bench-")
    spark = build_session(f"local[{CPUS}]", app_name="geospan-bench",
                          shuffle_partitions=CPUS * 2,
                          extra_conf={"spark.driver.memory": "16g",
                                      "spark.checkpoint.dir": f"{scratch}/ckpt"})
    spark.sparkContext.setLogLevel("ERROR")

    def t(name):
        return D.table(spark, SF_DIR, name)

    fa = lambda: D.polygon_features(t("orders"))
    # Stored features with a bbox column, clustered by grid cell (K2 layout):
    # the input of the pushdown benchmark.  Written once, outside the timings.
    stored = f"{scratch}/features"
    write_geoparquet(D.polygon_features(t("orders")).withColumnRenamed("wkt", "geometry"),
                     stored, partitions=64)
    wkb_path = f"{scratch}/wkb"
    D.wkb_features(t("orders")).write.parquet(wkb_path)
    # Recorded API responses, stored once: the page benchmarks time assembly.
    offset_path, linked_path, starts_path = (f"{scratch}/{n}" for n in ("off", "lnk", "st"))
    D.offset_pages(t("orders")).write.parquet(offset_path)
    lp, ls = D.linked_pages(t("orders"))
    lp.write.parquet(linked_path)
    ls.write.parquet(starts_path)
    props = "struct<o_orderkey:bigint,layer:string>"

    # Untimed warm-up (JIT, Python workers) so that medians are steady state.
    run(job_summary(fa(), D.job_boxes(t("nation")), "job_name"))
    run(decode_geometry(D.balanced(spark.read.parquet(wkb_path)), "geometry"))

    q = {}
    # J3 flagship: per job box (25 boxes), features and extent.
    q["J3_job_summary"] = timed(lambda: job_summary(fa(), D.job_boxes(t("nation")), "job_name"))
    # AG1: extent of all features.
    q["AG1_extent"] = timed(lambda: extent(fa()))
    # box filter on bbox-clustered Parquet (pushdown to row groups).
    q["F1_filter_stored"] = timed(lambda: bbox_filter(spark.read.parquet(stored), FILTER_BOX))
    # J1 vs J2 crossover: box sets of growing size from nation / supplier / customer.
    box_sets = {"25": D.job_boxes(t("nation")).select("job_name", "bbox"),
                "supp": D.many_boxes(t("supplier"), "s_suppkey", "s_"),
                "cust": D.many_boxes(t("customer"), "c_custkey", "c_")}
    for label, boxes in box_sets.items():
        strategies = ["grid_broadcast", "grid"] + (["broadcast"] if label != "cust" else [])
        for s in strategies:
            q[f"J_{label}_{s}"] = timed(
                lambda b=boxes, s=s: extract_jobs(fa().select("o_orderkey", "bbox"), b, strategy=s))
    # WKB envelopes.
    q["G8_wkb_envelopes"] = timed(lambda: decode_geometry(
        D.balanced(spark.read.parquet(wkb_path)), "geometry"))
    # Offset page assembly (pages are built from orders inside the timing).
    q["A7_offset_pages"] = timed(lambda: assemble_offset_pages(
        spark.read.parquet(offset_path), limit=D.PAGE_SIZE, properties_schema=props))
    q["A8_linked_pages"] = timed(lambda: assemble_linked_pages(
        spark.read.parquet(linked_path), spark.read.parquet(starts_path), properties_schema=props))

    q_rg = row_groups_read(stored, FILTER_BOX)
    headline = ["J3_job_summary", "AG1_extent", "F1_filter_stored", "G8_wkb_envelopes",
                "A7_offset_pages", "A8_linked_pages", "J_cust_grid_broadcast"]
    total = round(sum(q[k] for k in headline), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec",
                      "queries": q, "sf": sf, "cpus": CPUS, "repeat": REPEAT,
                      "f1_row_groups": q_rg}))
    spark.stop()


if __name__ == "__main__":
    main()
