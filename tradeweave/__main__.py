"""Command line: ``python -m tradeweave <job> --root <warehouse> ...``."""

from __future__ import annotations

import argparse
import datetime as dt

from tradeweave import schemas as S
from tradeweave.functions.scalar import day_number
from tradeweave.plans import summaries
from tradeweave.plans.detailed import daily_detailed_report
from tradeweave.plans.load import cleanup, load_feeds
from tradeweave.session import build_session
from tradeweave.sources.tables import Warehouse


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tradeweave")
    p.add_argument("job", choices=["load", "detail", "daily", "weekly", "monthly", "cleanup"])
    p.add_argument("--root", required=True, help="folder of the stored tables")
    p.add_argument("--scratch", help="folder all machines share, for intermediate tables; under the root by default")
    p.add_argument("--out", help="folder for reports")
    p.add_argument("--instructions", help="instruction CSV (load)")
    p.add_argument("--rates", help="folder of the rate files (load)")
    p.add_argument("--prices", help="folder of the price files (load)")
    p.add_argument("--rejects", help="folder for malformed instruction records; without it they stop the load")
    p.add_argument("--day", type=int, nargs="+", help="settlement dates, yyyymmdd (detail, daily)")
    p.add_argument("--start", type=int)
    p.add_argument("--end", type=int)
    p.add_argument("--today", type=int, default=day_number(dt.date.today()))
    p.add_argument("--keep", type=int, default=S.RETENTION_DAYS, help="days kept (cleanup)")
    p.add_argument("--manual", action="store_true")
    p.add_argument("--duplicates", action="store_true", help="let duplicate rates, prices and names multiply rows instead of stopping (detail)")
    p.add_argument("--rounds", type=int, default=S.MAX_ROUNDS, help="turnarounds after which linking stops with an error (detail)")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = build_session()
    if a.scratch or not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", a.scratch or f"{a.root.rstrip('/')}/_scratch")
    house = Warehouse(spark, a.root)
    if a.job == "load":
        print(load_feeds(house, a.instructions, a.rates, a.prices, a.today, a.rejects))
    elif a.job == "detail":
        daily_detailed_report(house, a.day, a.out, a.manual, strict=not a.duplicates, max_rounds=a.rounds)
    elif a.job == "daily":
        for day in a.day:
            print(summaries.daily_summary_report(house, day, a.out, a.manual))
    elif a.job == "cleanup":
        print(cleanup(house, a.today, a.keep))
    else:
        report = {"weekly": summaries.weekly_summary_report, "monthly": summaries.monthly_summary_report}[a.job]
        print(report(house, a.start, a.end, a.out, a.manual))


if __name__ == "__main__":
    main()
