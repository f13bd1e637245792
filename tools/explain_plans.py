"""Print the formatted physical plans of the headline queries.

Usage: python tools/explain_plans.py [sf_dir]
Used to review pushdown, join strategy, partial aggregation and codegen.
"""

from __future__ import annotations

import sys
import tempfile

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from geospan.operators.extent import extent  # noqa: E402
from geospan.operators.extract import extract_jobs, job_summary  # noqa: E402
from geospan.operators.filters import bbox_filter  # noqa: E402
from geospan.plans.catalog import QUERIES  # noqa: E402
from geospan.plans.oracle import FILTER_BOX  # noqa: E402
from geospan.session import build_session  # noqa: E402
from geospan.sinks.export import write_geoparquet  # noqa: E402
from geospan.sources import derived as D  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    t = lambda n: D.table(spark, sf, n)
    stored = tempfile.mkdtemp(prefix="geospan-plans-") + "/features"
    write_geoparquet(D.polygon_features(t("orders")).withColumnRenamed("wkt", "geometry"),
                     stored, partitions=8)
    plans = {
        "F1 box filter on stored GeoParquet":
            bbox_filter(spark.read.parquet(stored), FILTER_BOX).select("o_orderkey"),
        "J3 per-job summary (25 boxes)":
            job_summary(D.polygon_features(t("orders")), D.job_boxes(t("nation")), "job_name"),
        "J2 grid with broadcast box cells":
            extract_jobs(D.polygon_features(t("orders")).select("o_orderkey", "bbox"),
                         D.many_boxes(t("customer"), "c_custkey", "c_"), strategy="grid_broadcast"),
        "J2 shuffled grid with salting":
            extract_jobs(D.polygon_features(t("orders")).select("o_orderkey", "bbox"),
                         D.many_boxes(t("customer"), "c_custkey", "c_"), strategy="grid"),
        "AG1 extent": extent(D.polygon_features(t("orders"))),
        "A7 offset pages": QUERIES["offset_pages"](spark, sf),
    }
    for name, df in plans.items():
        print(f"\n===== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
