"""Headline requests on both layouts at the size of the published numbers.

The contact lens of ``$BENCH_SF_DIR`` is copied until there are about 500,000
contacts, stored in both layouts, and asked the same requests. Prints one JSON
line; times are medians of the runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from fieldweave.operators import aggregates as A  # noqa: E402
from fieldweave.operators import changes as C  # noqa: E402
from fieldweave.operators.predicates import Filter  # noqa: E402
from fieldweave.operators.sorting import Sort  # noqa: E402
from fieldweave.operators.textsearch import with_lengths  # noqa: E402
from fieldweave.plans.search import search_columns, search_documents, search_eav  # noqa: E402
from fieldweave.plans.spec import SearchSpec  # noqa: E402
from fieldweave.session import build_session  # noqa: E402
from fieldweave.sources import layout  # noqa: E402
from fieldweave.sources import lens as L  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
CONTACTS = int(os.environ.get("BENCH_CONTACTS", "500000"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
CATALOG = L.CONTACT_CATALOG

FILTER = SearchSpec(filters=(Filter("tier__c", "eq", "GOLD"),))
SORT = SearchSpec(sort=(Sort("score__c", "desc"),))
FILTER_SORT = SearchSpec(
    filters=(Filter("tier__c", "eq", "GOLD"), Filter("region__c", "eq", "ASIA")), sort=(Sort("annual_revenue__c", "desc"),)
)
KEYWORD = SearchSpec(search="platinum director")


def folder_bytes(path: str) -> int:
    return sum(
        os.path.getsize(os.path.join(root, name)) for root, _, names in os.walk(path) for name in names
    )


def main() -> None:
    work = tempfile.mkdtemp(prefix="fieldweave-bench-")
    spark = build_session(
        "fieldweave-bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": f"{work}/shared",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(run, runs: int = 1) -> float:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        return statistics.median(times)

    profile = L.profile(spark, SF_DIR)
    copies = max(1, round(CONTACTS / profile.count()))
    wide = profile.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn(
        "id", F.col("id") * copies + F.col("copy")
    )
    paths = {name: f"{work}/{name}" for name in ("wide", "contacts", "values", "documents")}
    wide.drop("copy").repartition(int(CPUS)).write.parquet(paths["wide"])
    stored = spark.read.parquet(paths["wide"])
    base = ["id", "first_name", "last_name", "email", "status", "account_id", "created_at", "updated_at"]
    seconds: dict[str, float] = {}
    stored.select(base).write.parquet(paths["contacts"])
    contacts = spark.read.parquet(paths["contacts"])
    seconds["melt_and_write_values"] = timed(
        lambda: layout.write_values(layout.melt(stored, CATALOG), paths["values"])
    )
    values = spark.read.parquet(paths["values"])
    searched = search_columns(CATALOG)
    seconds["build_and_write_documents"] = timed(
        lambda: layout.write_documents(
            with_lengths(layout.build_documents(contacts, values, CATALOG), searched), paths["documents"]
        )
    )
    documents = spark.read.parquet(paths["documents"])
    changes = C.to_change(L.outbox(spark, SF_DIR))

    def page(result) -> None:
        result.page.collect()

    def answer(result) -> None:
        result.page.collect()
        result.total.collect()

    runs = {
        "eav_list": lambda: page(search_eav(contacts, values, CATALOG, SearchSpec())),
        "eav_filter": lambda: page(search_eav(contacts, values, CATALOG, FILTER)),
        "eav_sort": lambda: page(search_eav(contacts, values, CATALOG, SORT)),
        "eav_filter_sort": lambda: page(search_eav(contacts, values, CATALOG, FILTER_SORT)),
        "eav_filter_sort_total": lambda: answer(search_eav(contacts, values, CATALOG, FILTER_SORT)),
        "eav_group_counts": lambda: A.group_counts_eav(contacts, values, CATALOG, "tier__c").collect(),
        "doc_list": lambda: page(search_documents(documents, CATALOG, SearchSpec())),
        "doc_filter": lambda: page(search_documents(documents, CATALOG, FILTER)),
        "doc_sort": lambda: page(search_documents(documents, CATALOG, SORT)),
        "doc_filter_sort": lambda: page(search_documents(documents, CATALOG, FILTER_SORT)),
        "doc_filter_sort_total": lambda: answer(search_documents(documents, CATALOG, FILTER_SORT)),
        "doc_group_counts": lambda: A.terms(documents, F.col("custom_fields.tier__c")).collect(),
        "doc_keyword_page": lambda: page(search_documents(documents, CATALOG, KEYWORD)),
        "apply_changes": lambda: C.apply_changes(documents, changes, lambda docs: with_lengths(docs, searched))
        .documents.write.format("noop")
        .mode("overwrite")
        .save(),
    }
    for name, run in runs.items():
        run()
        seconds[name] = timed(run, RUNS)
    n_contacts, n_values = contacts.count(), values.count()
    print(
        json.dumps(
            {
                "metric": "headline requests on both layouts, sum of medians",
                "value": round(sum(seconds[n] for n in runs), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "contacts": n_contacts,
                "value_rows": n_values,
                "value_rows_per_sec_eav_filter_sort": round(n_values / seconds["eav_filter_sort"]),
                "bytes": {"eav": folder_bytes(paths["contacts"]) + folder_bytes(paths["values"]), "doc": folder_bytes(paths["documents"])},
                "eav_to_doc_ratio": {
                    kind: round(seconds[f"eav_{kind}"] / seconds[f"doc_{kind}"], 2)
                    for kind in ("filter", "sort", "filter_sort", "group_counts")
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
