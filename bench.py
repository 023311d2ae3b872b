"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores.
Every query runs once unmeasured and once measured, into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import time

from wavebook.plans.queries import REGISTRY
from wavebook.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "frequency_distribution",
    "frequency_distribution_with_nulls",
    "frequency_distribution_free_text",
    "wave_trend",
    "item_distribution",
    "frequency_all_variables",
    "trend_all_variables",
    "clean_responses",
    "validate_collect_all",
    "decode_long",
    "decode_long_code_book",
    "read_responses",
    "write_wave",
    "read_questions",
    "flatten_questions",
    "question_violations",
    "name_multi",
    "name_multi_many_surveys",
    "structure_diff",
    "question_metadata",
    "matrix_metadata",
    "find_variables",
    "dictionary_frame",
    "dictionary_sections",
    "join_question_text",
]


def run(spark, name: str) -> float:
    started = time.perf_counter()
    frame = REGISTRY[name](spark, FOLDER)
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name)
        seconds[name] = round(run(spark, name), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
