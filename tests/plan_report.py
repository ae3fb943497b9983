"""Write PLANS.md: the executed physical plan of every registered query over
materialised stand-in tables, summarised (shuffles, broadcasts, join kinds,
scans with pushed filters).

    python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tokoledger import catalog  # noqa: E402
from tokoledger.plans.checks import plan_text, scale_problems  # noqa: E402
from tokoledger.session import local_session  # noqa: E402
from tokoledger.sources.tables import from_parquet, from_testdata, materialize  # noqa: E402

BIG = ("invoice_master", "invoice_detail_activity", "invoice_detail", "point_redeem", "log_validasi_redeem")


SCALE_NOTES = """
## At 100 TB

Large: invoice lines (`invoice_detail*`), invoices (`invoice_master`), redemptions and their channel tables,
the redemption log. Per outlet (millions of rows): target tables, outlet lists, masters, users. Small
(broadcast after a proven row bound): activities, categories, SKU targets, products, gift catalogue.

| operators | what is shuffled | hot outlet (a third of all rows) |
|---|---|---|
| O1-O5 activity | lines cut to the programme's period window at the scan, one shuffle by outlet for the outlet-list join, partial aggregation after it; O2-O5 work on aggregates | inner join, lines on the streamed side: AQE splits the hot partition (`test_skew.py`) |
| O6-O8, O10 basepack lines | lines cut to the target window; O8 sums per (outlet, basepack, day) before the range join; O10's DISTINCT is the reference's own dedupe of the lines | inner range joins with the sales side streamed, totals left-joined back |
| O7, O11 period sales | invoices summed per (outlet, timestamp), the reference's rounding grain, then an inner equi + range join | split by AQE (`test_skew.py`) |
| O9, O12 summaries | only target-sized data: injection / feedback invoices reduced to distinct attributes with counts; GROUP BY / SUM on the target side; no shuffle over the expanded output | per-outlet rows are few |
| O13 balance | one ledger (union of channels), one join of redemptions with the stacked channel tables on redeem_no (unique key), one aggregation per (outlet, year); cut to the requested pairs by a broadcast semi-join when the request batch is bounded | aggregation combines map-side |
| O14-O16 report | aggregates per user / outlet before the joins; address = `max(struct)` aggregate, not a window | map-side combine |
| O17-O18 views | no shuffle (broadcast product names) | - |
| O19-O22 redemption | small request side; the log is filtered against the broadcast requests and max-aggregated map-side | requests of one outlet: one per round (sequential semantics of the reference) |
"""


def summarise(df) -> dict:
    df.write.format("noop").mode("overwrite").save()          # final adaptive plan
    text = plan_text(df, "formatted")
    tree = text.split("\n\n")[0]
    nodes = re.findall(r"([A-Z][A-Za-z]+(?: [A-Z][A-Za-z]+)*) \(\d+\)", tree)
    joins = sorted({n for n in nodes if n.endswith("Join") or "Join " in n})
    join_kinds = sorted(set(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) (\w+)", tree)))
    scans = []
    for block in re.split(r"\n(?=\(\d+\) )", text):
        if not block.split("\n")[0].strip().endswith("Scan parquet"):
            continue
        loc = re.search(r"Location: .*?/([\w]+)\]", block)
        pushed = re.search(r"PushedFilters: \[(.*)\]", block)
        name = loc.group(1) if loc else "?"
        if name in BIG:
            scans.append(f"{name}: {pushed.group(1) if pushed and pushed.group(1) else 'no filter'}")
    return {
        "shuffles": tree.count("Exchange (") - tree.count("BroadcastExchange ("),
        "broadcasts": tree.count("BroadcastExchange ("),
        "joins": ", ".join(f"{a} {b}" for a, b in join_kinds) or "-",
        "skew": "yes" if "skew=true" in text or "isSkewJoin=true" in text else "",
        "scans": "; ".join(sorted(set(scans))) or "-",
        "problems": ", ".join(scale_problems(df)) or "none",
        "unused": joins,
    }


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    root = tempfile.mkdtemp(prefix="tokoledger-plans-")
    materialize(from_testdata(spark, sf_dir), root)
    spark.catalog.clearCache()
    tables = from_parquet(spark, root)
    print(f"# PLANS\n\nExecuted (adaptive, final) physical plans of the registered queries over the stand-in "
          f"tables of `{sf_dir}` written as Parquet, `local[*]`, 16 shuffle partitions. Generated by "
          f"`tests/plan_report.py`. Shuffles = non-broadcast exchanges; scans list the pushed filters of the "
          f"large tables.\n")
    print(SCALE_NOTES)
    print("| query | shuffles | broadcasts | joins | large-table scans (pushed filters) | unscalable operators |")
    print("|---|---|---|---|---|---|")
    for name, build in catalog.builders().items():
        s = summarise(build(tables))
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['scans']} | {s['problems']} |")


if __name__ == "__main__":
    main(sys.argv)
