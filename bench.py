"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from concordat.plans.catalog import QUERIES
from concordat.session import session

NAMES = ("score_compare", "flow_priorities", "contributions", "consensus_derive", "restated", "differences_long", "coverage_gaps", "census_pairs", "carry_down", "collision_settle", "alias_cascade", "scored_select", "quorum_vote", "match_strength", "dedupe_survivor", "facets", "release_diff", "release_fates", "redirect_closure", "pivot_wide", "token_search", "entity_owner")


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", int(cpus), **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the JVM's code
    took = {}
    for name in NAMES:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
