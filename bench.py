"""Times the stages and reports on the driver tables and prints one JSON line.

Every pass starts from the driver tables: the five clean tables and the nine
feature tables are computed and written anew, then the quality, validation and
metric reports run on what was written.  The first pass warms the JVM up; the
reported time of a step is the median of the others (``BENCH_PASSES``, 2 by
default: one warm pass).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from subrev.operators import quality, validate  # noqa: E402
from subrev.plans import catalog  # noqa: E402
from subrev.plans.stages import REPORTS  # noqa: E402
from subrev.session import BUILD_CONF  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
PASSES = int(os.environ.get("BENCH_PASSES", "2"))
EXPRESSIONS = ("parse_numeric", "parse_dates", "dedupe_keep_most_complete", "price_lookup", "cohort_retention_rows",
               "cohort_nrr_curve_rows", "revenue_ledger")


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("subrev-bench")
             .config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config(map=BUILD_CONF).config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def one_pass(spark: SparkSession) -> dict[str, float]:
    data = catalog.Data(spark, SF_DIR)
    took: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        took[name] = time.perf_counter() - start
        print(f"{name} {took[name]:.2f}", file=sys.stderr, flush=True)

    for name in ("churn_events", "support_tickets", "accounts", "subscriptions", "feature_usage"):
        timed(f"clean_{name}", lambda n=name: data.clean[n])
    for name in data.features.NAMES:
        timed(f"feature_{name}", lambda n=name: data.features[n])
    for name, report in REPORTS.items():
        timed(name, lambda r=report: run(r(data.features, catalog.AS_OF)))
    timed("dq_summary", lambda: run(quality.dq_summary(data.landed, data.clean)))
    timed("dq_long", lambda: run(quality.dq_long(data.clean)))
    timed("dq_col_profile", lambda: run(quality.dq_col_profile(data.clean)))
    timed("dq_errors", lambda: run(quality.dq_errors(data.clean)))
    timed("corrections_log", lambda: run(catalog.corrections_log(data)))
    timed("validation_checks", lambda: run(validate.validation_checks(data.features.all(("subscriptions", "accounts")))))
    timed("missingness", lambda: run(validate.missingness(data.features.all(validate.MISSINGNESS_TABLES))))
    timed("deep_validation", lambda: run(catalog.deep_validation(data)))
    for name in EXPRESSIONS:
        timed(name, lambda n=name: run(catalog._QUERIES[n](data)))
    return took


def main() -> None:
    spark = session()
    passes = [one_pass(spark) for _ in range(max(PASSES, 1))]
    warm = passes[1:] or passes
    times = {n: round(statistics.median(p[n] for p in warm), 3) for n in warm[0]}
    print(json.dumps({
        "metric": "total warm time of stages and reports", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(SF_DIR).name.removeprefix("sf"), "spark": spark.version, "cpus": int(CPUS),
        "shuffle_partitions": int(CPUS), "first_pass_sec": round(sum(passes[0].values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
