"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR is the table folder (default /root/testdata/sf0.1), BENCH_CPUS the
number of local cores. Each query runs to a sink that drops its rows, so that
the whole plan is executed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from acreage.session import build_session
from checks import registry

HEADLINES = [
    "exposure_summary", "wide_exposure", "storey_distribution", "impute_group_means", "matrix_product_expected", "subtotal_rows",
    "class_counts_wide", "class_counts_long", "zonal_stats", "dominant_class", "cell_counts_one_pass", "raster_tile_counts",
    "points_in_polygon", "points_in_many_polygons", "polygon_fill", "country_cells", "footprint_tiles", "mollweide_forward",
    "global_order_id", "keep_first_row", "buffer_exclusion", "nearest_ten", "rank_correlation", "regression_metrics",
    "cross_validation_summary", "forest_loss", "percentile_stretch", "change_report", "overlapping_chips", "chip_band_imputation",
    "spatial_folds", "spatial_autocorrelation", "mutual_information", "tile_manifest", "scale_conversion",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
            "spark.sql.codegen.cache.maxEntries": "1000",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    queries["class_labels"](spark, folder).write.format("noop").mode("overwrite").save()  # JVM warm-up
    times: dict[str, float] = {}
    for name in HEADLINES:
        started = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
    total = round(sum(times.values()), 3)
    # Throughput of the two stages that published run times refer to.
    cells = spark.read.parquet(f"{folder}/part.parquet").count()
    pixels = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    rates = {
        "exposure_cells_per_sec": round(cells / times["wide_exposure"], 1),
        "zonal_pixels_per_sec": round(pixels / times["cell_counts_one_pass"], 1),
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"), "rates": rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
