"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table directory, ``BENCH_CPUS`` the number of local cores.  Each
query runs once to warm up and then ``BENCH_RUNS`` times; the median counts.  Results go to
the ``noop`` sink, so every row is computed and none is written.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from palimpsest.checks import outputs  # noqa: F401
from palimpsest.checks.queries import QUERIES
from palimpsest.session import session

HEADLINE = (
    "strip_comments_pages",
    "sections",
    "references",
    "templates",
    "ids_all",
    "links_sectioned",
    "identifier_containment",
    "bibliography_sections",
    "bibliography_text",
    "section_name_counts_articles",
    "identifier_appearances_articles",
    "extract_wikilinks",
    "identifier_diffs",
    "identifier_lifespans",
    "revision_report_rows",
    # Whole jobs: captures, XML writing, and reading the documents back.
    "bibliography_document_read_back",
    "identifiers_document_read_back",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
