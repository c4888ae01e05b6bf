"""Fold closed days of the warehouse's keyed tables: a batch job beside the streams.

    python -m martlane.streaming.folding --warehouse hdfs:///shop/warehouse --days 2024-01-15
    python -m martlane.streaming.folding --warehouse hdfs:///shop/warehouse --retire

The first rewrites the days of the day-split tables and the whole of the tables
that are not split, every key resolved once, and points readers to them; the
second, some time later, removes the batch folders that they replace
(``sources.tables``).
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from martlane.sources.tables import ONE_PART, AppendTable
from martlane.streaming import runners
from martlane.streaming.apps import FIRST_SEEN, TABLES

OPEN = {"dau": runners.dau_table, "orders": runners.order_table, "first_orders": runners.order_table,
        "alerts": runners.alert_table, "users": runners.user_table, "sales": runners.sale_table}


def warehouse_tables(spark: SparkSession, warehouse: str) -> dict[str, AppendTable]:
    """Every keyed table that the streaming jobs keep below ``warehouse``."""
    wh = warehouse.rstrip("/")
    tables = {job: open_(spark, f"{wh}/{TABLES[job]}") for job, open_ in OPEN.items()}
    return tables | {"first_order_users": runners.first_order_table(spark, f"{wh}/first_order_users"),
                     FIRST_SEEN: runners.first_seen_table(spark, f"{wh}/{FIRST_SEEN}")}


def fold_days(spark: SparkSession, warehouse: str, days: Sequence[str]) -> dict[str, int]:
    """Fold ``days`` of every table, and the tables that are not split; table -> rows."""
    return {name: t.fold(days if t.partition_col else [ONE_PART])
            for name, t in warehouse_tables(spark, warehouse).items()}


def main(argv=None) -> None:
    from martlane.session import get_spark

    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--days", default="", type=lambda s: [d for d in s.split(",") if d])
    p.add_argument("--retire", action="store_true")
    args = p.parse_args(argv)
    spark = get_spark(master=None)
    if args.days:
        print(fold_days(spark, args.warehouse, args.days))
    if args.retire:
        for t in warehouse_tables(spark, args.warehouse).values():
            t.retire()


if __name__ == "__main__":
    main()
