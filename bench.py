"""Headline queries timed end to end; prints one JSON line."""

import json
import os
import sys
import time
from functools import reduce

from pyspark.sql import DataFrame

from kinlink.operators import matching
from kinlink.operators.rules import passing
from kinlink.operators.similar import meetings
from kinlink.plans.settings import PHASES
from kinlink.storage import materialize
from suite import checks
from suite.checks import QUERIES
from suite.compare import session

HEADLINE = [
    "std_street",
    "std_business_name",
    "std_city",
    "record_ids",
    "hierarchy",
    "batches_orders",
    "candidates_zip",
    "phase1",
    "phase2",
    "phase3",
    "phases",
    "name_maps",
    "hash_embed",
]


def phase_counters(spark, sf_dir: str) -> dict[str, int]:
    """Work of phase 1: class pairs in blocks, those the prefilter leaves, those scored that pass a rule, matches."""
    left, right = checks.phase_sides(spark, sf_dir)
    lefts, rights = matching.left_classes(left), matching.right_classes(right)
    rules = list(PHASES[0].rules)
    sizes = [df.groupBy("block").count().withColumnRenamed("count", n) for df, n in ((lefts, "a"), (rights, "b"))]
    in_blocks = sizes[0].join(sizes[1], "block").selectExpr("coalesce(sum(a * b), 0) AS n").first()["n"]
    scored = materialize(matching.fuzzy_candidates(lefts, rights, rules), "bench-scored")
    passing_any = reduce(DataFrame.union, [passing(scored, r).select("left_class", "right_class") for r in rules])
    return {
        "candidate_pairs": in_blocks,
        "streets_met": meetings(
            lefts.selectExpr("block", "left_street AS value"), rights.selectExpr("block", "street AS value"), 80, ["block"]
        ).count(),
        "scored": scored.count(),
        "passing": passing_any.distinct().count(),
        "matches": matching.fuzzy_match(left, right, rules).count(),
    }


def phase3_counters(spark, sf_dir: str) -> dict[str, float]:
    """Work of phase 3: pairs of distinct streets that meet in a tile, products of them computed, the share skipped, and
    pairs of rows whose names are compared. A task that is run again counts twice."""
    left, right = checks._inputs(spark, sf_dir, PHASES[2])
    counters = {name: spark.sparkContext.accumulator(0) for name in ("pairs", "streets", "names")}
    found = matching.vector_candidates(
        matching.left_classes(left), matching.right_classes(right), list(PHASES[2].rules), counters=counters
    )
    passed = found.count()
    counts = {name: counter.value for name, counter in counters.items()}
    return counts | {"skipped": round(1 - counts["streets"] / max(counts["pairs"], 1), 3), "passing": passed}


def top_one_counters(spark, sf_dir: str) -> dict[str, dict[str, float]]:
    """Of the pairs that meet in the tiles of a top-one search, how many are scored. A task that is run again counts twice."""
    report = {}
    for name in ("best_choice", "name_maps"):
        counters = {k: spark.sparkContext.accumulator(0) for k in ("pairs", "scored")}
        getattr(checks, name)(spark, sf_dir, counters).write.format("noop").mode("overwrite").save()
        counts = {k: c.value for k, c in counters.items()}
        report[name] = counts | {"share": round(counts["scored"] / max(counts["pairs"], 1), 4)}
    return report


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    times, rows = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        checks.forget()  # nothing is answered from an earlier query's stored tables
        start = time.time()
        result = QUERIES[name](spark, sf_dir)
        rows[name] = result.count() if name in ("phases", "candidates_zip") else None
        if rows[name] is None:
            result.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    report = {
        "metric": "total seconds of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": {n: r for n, r in rows.items() if r is not None},
        "phase1_counts": phase_counters(spark, sf_dir),
        "phase3_counts": phase3_counters(spark, sf_dir),
        "top_one_counts": top_one_counters(spark, sf_dir),
        "sf": sf_dir.rstrip("/").rsplit("/sf", 1)[-1],
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
