"""Time the headline queries; prints one JSON line.

Each query runs from the raw table on (documents -> XML -> parser -> operator) and its rows
are fully computed. ``flatten`` has the parser's throughput, ``stored`` the same questions on
tables that were ingested once.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.operators import stats, tree
from lawtree.plans import queries as Q
from lawtree.plans.ingest import ingest
from lawtree.plans.warehouse import Warehouse
from lawtree.scratch import scratch_path
from lawtree.sources import xml

HEADLINE = (
    "count_elems", "count_elems_by_law", "sentences", "plaintext", "leaves", "children", "descendants",
    "citation_labels", "element_lookup", "etype_prune", "law_numbers", "is_reiki", "element_number",
    "kanji_numerals", "tokens", "chars", "string_dictionary", "string_edges", "register_laws",
    "dims_join", "validate_grammar", "validate_duplicates", "validate_num_format",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    cold = timed(lambda: run(Q.count_elems(spark, folder)))
    queries = {name: timed(lambda: run(Q.QUERIES[name](spark, folder))) for name in HEADLINE}

    parsed = xml.parse(Q.corpus(spark, folder))
    n_files = parsed.where("ord = 0").count()
    n_elements = parsed.where("ord > 0").count()
    flatten = timed(lambda: run(xml.elements(parsed)))

    root = scratch_path(spark, "bench")
    options = {"check_municipalities": False, "with_strings": True}
    first = timed(lambda: ingest(spark, Q.corpus(spark, folder), root, "b1", **options))
    second = timed(lambda: ingest(spark, Q.corpus(spark, folder), root, "b2", **options))
    elements, laws = (Warehouse(spark, root).table(t) for t in ("elements", "laws"))
    articles = elements.where(F.col("etype") == "Article")
    stored = {
        "count_elems": timed(lambda: run(stats.count_elems(elements))),
        "plaintext": timed(lambda: run(tree.plaintext(elements))),
        "descendants": timed(lambda: run(tree.descendants(elements.select("law_id", "lineage"), articles))),
        "citation_labels": timed(lambda: run(tree.citation_labels(elements, laws))),
        "leaves": timed(lambda: run(tree.leaves(elements))),
    }
    queries["ingest_first"], queries["ingest_second"] = first, second
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cold_first_query": cold,
                "flatten": {
                    "seconds": flatten,
                    "files_per_second": round(n_files / flatten),
                    "elements_per_second": round(n_elements / flatten),
                },
                "stored": stored,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
