"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query is run to the end through the no-op sink; written layers are timed as queries of
their own, once, before the queries that read them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import frames, q_aggregates, q_quality  # noqa: E402
from checks.registry import QUERIES  # noqa: E402
from paypanel.session import get_session  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "a01_masse_salariale",
    "a02_effectifs",
    "j01_join_sheets",
    "j02_enrich_codes",
    "i02_impute_salaries",
    "i02_median_cascade_default",
    "w01_locf_forward",
    "w03_winsorize_default",
    "a04_indicators_grade",
    "a04_indicators_grade_sexe",
    "a07_multi_posts_table",
    "a12_group_panels",
    "a24_dashboard_monthly",
    "v2_global",
    "v4_sex_grade",
    "v8_yearly",
    "w08_presence_tenure",
    "q18_amount_flags",
    "q19_jump_flags",
    "f18_unpivot_paycodes",
    "h01_hmac_id",
    "j09_best_suggestions",
]


def main() -> None:
    spark = get_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{SF}/orders.parquet").count()

    times: dict[str, float] = {}

    def timed(name, run) -> None:
        t0 = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - t0, 3)

    layers = {
        "layer_silver": frames.graded,
        "layer_grades": frames.imputed,
        "layer_panel": frames.panel,
        "layer_revenue": q_aggregates.salaried,
        "layer_persons": q_quality.variables,
        "layer_flags": q_quality.flagged,
    }
    for name, build in layers.items():
        timed(name, lambda b=build: b(spark, SF))
    for name in HEADLINE:
        timed(name, lambda n=name: QUERIES[n](spark, SF).write.format("noop").mode("overwrite").save())

    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    import checks.catalog  # noqa: F401

    main()
