"""Time the main queries and print one JSON line.

Environment: BENCH_SF_DIR (folder of Parquet tables), BENCH_CPUS (local threads). Every
query writes all its rows to the ``noop`` sink. The input is one small file, so its rows
are dealt out over the cores first; ``as_read`` has the times without that. The first run
of each query starts workers and compiles; the faster of the two runs after it is
reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from wordloom.plans import registered
from wordloom.plans.queries import PARTITIONS

HEADLINE = (
    "top50_words", "word_counts", "cooc_pairs_exact_d4", "cooc_pairs_within_d1",
    "cooc_pairs_within_d4", "cooc_stripes_d4", "cooc_pairs_all_words_d1",
    "stemmed_vocabulary", "document_frequency", "document_frequency_by_line",
    "top100_terms", "term_frequency", "term_frequency_dense", "term_frequency_dense_by_line",
    "tfidf",
    "keyed_term_frequency", "keyed_term_maps",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Starts workers and compiles what all queries share, so that the first is no slower.
    registered()["top100_terms"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds, as_read = {}, {}
    for name in names:
        runs = []
        for partitions in (None, 2 * int(cpus), 2 * int(cpus), 2 * int(cpus)):
            if partitions:
                spark.conf.set(PARTITIONS, str(partitions))
            else:
                spark.conf.unset(PARTITIONS)
            start = time.perf_counter()
            registered()[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        as_read[name], seconds[name] = round(runs[0], 3), round(min(runs[2:]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the main queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "as_read": as_read,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
