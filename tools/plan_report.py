"""Write PLANS.md: the physical plan shape of every registered query, with its scale note.

    python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sheaf.plans.registry import queries  # noqa: E402
from sheaf.session import get_session  # noqa: E402

# Why each plan holds at 100 TB (reviewed by hand against the plan printed next to it).
NOTES = {
    "word_count": "explode + partial count per task, one shuffle on the word; a hot word ships one row per task",
    "word_count_raw": "same as word_count, with two generators (lines, then pieces); no per-line reference back to the whole text",
    "word_count_sorted": "word_count, then a range exchange on the (unique) word: the sort spreads over all reducers",
    "word_count_hashed": "word_count in hash parts on the word, each sorted locally (no global sort)",
    "key_lookup": "the key reaches both scans; one customer's rows are aggregated",
    "orders_until_epoch": "status and the bound on the stored time pushed to the scan; one partial count per task",
    "fundamentals_sorted": "row-wise extract, then a range-partitioned sort on the symbol",
    "csv_quoted_scan": "row-wise parse, no shuffle; the parser runs once per line (inline generator)",
    "market_cap_parse": "row-wise, no shuffle",
    "sector_rollup": "partial sum/count per task, shuffle of (sector, partials) only",
    "sector_rollup_truncated": "as sector_rollup",
    "sector_rollup_substring": "as sector_rollup, under the other filter rule",
    "sector_tickers": "range exchange on (sector, ticker): a large sector spreads over many tasks; no collect",
    "sector_report": "as sector_rollup; the ticker list is in sector_tickers",
    "sector_ticker_text": "range exchange on (sector, ticker), stored once; offsets run inside the sort's partitions; only chunks of bounded bytes are gathered",
    "sector_files": "the rollup and the range sort read one stored table; files are published by one rename",
    "top_lists": "one join; both lists through one window whose group limit keeps ten rows a list and task before the exchange",
    "loyalty_load": "orders dealt into statements of bounded size, joined to customer; the parse is row-wise",
    "loyalty_table": "as loyalty_load, written as one partition a load; the count is partial per task",
    "third_order": "as loyalty_load",
    "orders_until_dated": "written partitioned by month (rebalanced by size); the bound prunes partitions and is pushed to the files left",
    "rendered_rows": "customers counted per nation before the join; nation joined by size-checked broadcast",
    "csv_naive_scan": "row-wise, no shuffle",
    "fundamentals_extract": "row-wise, no shuffle",
    "fundamentals_quality": "one aggregate pass, partial per task, one row to the final task",
    "listing_join": "orders aggregated per customer (already partitioned on the key); customer broadcast only below the threshold, else sort-merge, both sides exchanged on the parsed symbol",
    "listing_join_count": "as listing_join, then a global count of partials",
    "listing_growth": "as listing_join, row-wise arithmetic after it",
    "top_growth": "as listing_join, then per-task top-10 and a merge (TakeOrderedAndProject), no full sort",
    "top_dividend": "as top_growth",
    "like_and_equals_filter": "filters pushed to the parquet scan",
    "zero_value_filter": "filter pushed to the parquet scan",
    "count_rows": "partial count per task",
    "count_distinct_concat": "distinct values pre-aggregated per task before the shuffle",
    "group_count_ranked": "customers counted per nation key before the join, so the join sees one row per key",
    "top3_quantity": "partial sums per part, then per-task top-3 and a merge",
    "top3_quantity_named": "line items summed per part before the join; the second aggregate reuses the join's partitioning",
    "orders_until_date_lexical": "status filter pushed to the scan; partial count",
    "orders_until_date": "status and the bound on the stored time pushed to the scan; partial count",
    "orders_on_date": "as above, with two bounds",
    "revenue_semi_join": "left-semi join on the order key: broadcast of order keys below the threshold, else sort-merge with AQE skew split",
    "revenue_decimal": "as revenue_semi_join",
    "revenue_semi_join_sql": "the SQL text plans the same left-semi join as revenue_semi_join",
    "revenue_formatted": "as revenue_semi_join",
    "date_parts": "partial count per (year, month, day)",
    "ratings_scan": "row-wise parse, no shuffle",
    "ratings_count": "row-wise parse, partial count",
    "map_lookup": "orders aggregated per customer into fixed-width values, then joined to customer; no collect",
    "array_index": "as map_lookup",
    "struct_field": "as map_lookup",
    "rename_column": "a projection; no data rewritten",
}


# Plan nodes that are not operators of their own: stage wrappers and data movement.
NOT_OPERATORS = {
    "AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage",
    "TableCacheQueryStage", "Exchange", "BroadcastExchange", "AQEShuffleRead", "ReusedExchange",
}


def note(name: str) -> str:
    if name in NOTES:
        return NOTES[name]
    if name.endswith("_sql"):
        return f"SQL text of `{name.removesuffix('_sql')}`; same plan shape (joins pre-aggregate in a subquery)"
    return ""


def outside_codegen(final_plan: str) -> str:
    """Operators of the final adaptive plan that run outside whole-stage codegen."""
    names = set()
    for line in final_plan.splitlines():
        body = line.lstrip(" :+-")
        if not body or body.startswith("==") or body.startswith("*("):
            continue
        match = re.match(r"[A-Za-z]+", body)
        if match and match.group(0) not in NOT_OPERATORS:
            names.add(match.group(0))
    return ", ".join(sorted(names)) or "none"


def summary(plan: str) -> dict[str, str]:
    scans = re.findall(
        r"FileScan parquet \[[^\]]*\].*?Location: InMemoryFileIndex\([^)]*\)\[file:[^\]]*/(\w+)\.parquet\]"
        r".*?PushedFilters: \[(.*?)\]?, ReadSchema: (struct<[^>]*>)",
        plan,
    )
    exchanges = ["broadcast" if b else kind for b, kind in re.findall(r"(Broadcast)?Exchange (\w+)\(", plan)]
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)[^\n]*?(Inner|LeftSemi|LeftOuter|LeftAnti|FullOuter|RightOuter)", plan)
    return {
        "scans": "; ".join(f"{t} {rs}" + (f" pushed [{pf}]" if pf else "") for t, pf, rs in scans),
        "exchanges": ", ".join(exchanges) or "none",
        "joins": ", ".join(f"{a} {b}" for a, b in joins) or "none",
        "partial_agg": "yes" if "partial_" in plan else "no",
        "top_k": "yes" if "TakeOrderedAndProject" in plan else "no",
        "generate": "yes" if "Generate " in plan else "no",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    run_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16)
    out = [
        "# PLANS",
        "",
        f"Physical plan shape of every registered query (initial adaptive plan, `{sf_dir}`, generated by",
        "`tools/plan_report.py`). Broadcast joins appear where the measured side is under",
        "`spark.sql.autoBroadcastJoinThreshold`; above it the same query plans a sort-merge join",
        "(see `tests/test_plans.py`). \"Outside codegen\" lists the operators of the final",
        f"adaptive plan after a run on `{run_dir}` that are not inside a whole-stage codegen span",
        "(exchanges and stage wrappers left out). The parquet `FileScan` is a columnar source that",
        "feeds the first codegen span; `Union` and the top-k merge (`TakeOrderedAndProject`) have no",
        "codegen form; the two remaining cases are per-key steps with lambda functions (a word's",
        "reduce part, a customer's status map) that run once per distinct key.",
        "",
        "| Query | Scans (ReadSchema, pushed filters) | Exchanges | Joins | Partial agg | Top-k | Generator | Outside codegen | At 100 TB |",
        "| --- | --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name, q in queries().items():
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        ran = q(spark, run_dir)
        ran.collect()
        final = ran._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        out.append(
            f"| `{name}` | {s['scans'] or '—'} | {s['exchanges']} | {s['joins']} | {s['partial_agg']} | "
            f"{s['top_k']} | {s['generate']} | {outside_codegen(final)} | {note(name)} |"
        )
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
