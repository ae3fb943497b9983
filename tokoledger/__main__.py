"""Command line: the reference's procedures as batch jobs.

    python -m tokoledger growth-basepack  --tables /data/tables --sink /shared/out
    python -m tokoledger activity-quarter --tables /data/tables --sink /shared/out --quarter Q3 --year 2025
    python -m tokoledger daily-report     --tables /data/tables --sink /shared/out --year 2025
    python -m tokoledger invoice-lines    --tables /data/tables --sink /shared/out --year 2025 --month 7 --outlet T1 --invoice I1
    python -m tokoledger invoice-headers  --tables /data/tables --sink /shared/out --year 2025 --month 7 --outlet T1
    python -m tokoledger redeem           --tables /data/tables --sink /shared/out --requests /data/requests \
                                          [--ledger-years 2018-2025] [--round N]

``--tables`` is a folder with one Parquet dataset per reference table, or
``catalog:<database>``. ``--sink`` defaults to a folder under the session's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from . import params as P
from .plans import batches
from .session import configure
from .sources.sinks import ParquetSink, default_sink
from .sources.tables import BALANCE, from_spec


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tokoledger")
    ap.add_argument("job", choices=["growth-basepack", "activity-quarter", "daily-report", "invoice-lines", "invoice-headers", "redeem"])
    ap.add_argument("--tables", required=True)
    ap.add_argument("--balance-tables", help="redeem: second database with gifts, users and ledger (default: --tables)")
    ap.add_argument("--outlet", help="invoice-lines, invoice-headers: outlet")
    ap.add_argument("--invoice", help="invoice-lines: invoice number")
    ap.add_argument("--month", type=int, help="invoice-lines, invoice-headers: month of --year")
    ap.add_argument("--sink")
    ap.add_argument("--from-date", type=dt.date.fromisoformat, default=P.SALES_FROM)
    ap.add_argument("--detail-from", type=dt.date.fromisoformat, default=P.BASEPACK_DETAIL_FROM)
    ap.add_argument("--quarter", default=P.QUARTER)
    ap.add_argument("--year", default=P.PROGRAM_YEAR)
    ap.add_argument("--requests", help="Parquet folder of redemption requests")
    ap.add_argument("--round", type=int, help="round id, only to repeat a failed redemption batch")
    ap.add_argument("--ledger-years", default=f"{min(P.LEDGER_YEARS)}-{max(P.LEDGER_YEARS)}",
                    help="years whose balance comes from the ledger, e.g. 2018-2025")
    ap.add_argument("--redeem-type", help="redeem_type of the detail rows (default: NULL)")
    ap.add_argument("--cooldown-minutes", type=int, default=P.COOLDOWN_MINUTES)
    args = ap.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"tokoledger-{args.job}").getOrCreate())
    tables = from_spec(spark, args.tables)
    if args.balance_tables:
        tables = tables.with_source(BALANCE, from_spec(spark, args.balance_tables))
    sink = ParquetSink(spark, args.sink) if args.sink else default_sink(spark)
    now = dt.datetime.now().replace(microsecond=0)
    if args.job == "growth-basepack":
        batches.run_growth_basepack(tables, sink, P.SalesParams(
            from_date=args.from_date, detail_from=args.detail_from, as_of=now))
    elif args.job == "activity-quarter":
        batches.run_activity_quarter(tables, sink, P.ActivityParams(quarter=args.quarter, year=str(args.year)))
    elif args.job == "daily-report":
        sink.overwrite("daily_report", batches.daily_report(tables, P.ReportParams(year=int(args.year), as_of=now)))
    elif args.job in ("invoice-lines", "invoice-headers"):
        look = P.InvoiceViewParams(year=int(args.year), month=args.month, outlet_id=args.outlet, invoice_no=args.invoice, as_of=now)
        view = batches.invoice_lines if args.job == "invoice-lines" else batches.invoice_headers
        sink.overwrite(args.job.replace("-", "_"), view(tables, look))
    else:
        if not args.requests:
            ap.error("redeem needs --requests")
        requests = spark.read.parquet(args.requests)
        lo, _, hi = args.ledger_years.partition("-")
        years = tuple(range(int(lo), int(hi or lo) + 1))
        rp = P.RedeemParams(cooldown_minutes=args.cooldown_minutes, redeem_type=args.redeem_type, points=P.PointParams(ledger_years=years))
        round_id = sink.next_round() if args.round is None else args.round
        print(f"redemption batch: round {round_id} (--round {round_id} repeats it)")
        batches.run_redemption_batch(tables, sink, requests, round_id, rp)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
