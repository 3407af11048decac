"""Build the warehouse from a folder of source files and print the five reports.

    spark-submit starmart/__main__.py FILES WAREHOUSE
    python -m starmart FILES WAREHOUSE
"""

from __future__ import annotations

import argparse

from starmart.plans.warehouse import DIVERT, FAIL, build_warehouse
from starmart.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="starmart", description=__doc__.splitlines()[0])
    parser.add_argument("files", help="folder with Categories.csv, Customers.csv, ...")
    parser.add_argument("warehouse", help="shared folder for the staging and datamart tables")
    parser.add_argument("--rows", type=int, default=20, help="rows of each report to print")
    parser.add_argument(
        "--refused", choices=(FAIL, DIVERT), default=FAIL, help="rows that break a table's contract: fail, or put them aside"
    )
    parser.add_argument("--check-lines", action="store_true", help="check the key of the order lines too")
    parser.add_argument("--dense-keys", action="store_true", help="fact keys without holes (writes the fact twice)")
    parser.add_argument("--remove-old", action="store_true", help="delete replaced versions and scratch copies")
    parser.add_argument("--by-year", action="store_true", help="a folder for each year of the fact")
    parser.add_argument("--buckets", type=int, default=0, help="bucket orders and their lines by order id")
    options = parser.parse_args()
    spark = build_session()
    reports = build_warehouse(
        spark,
        options.files,
        options.warehouse,
        refused=options.refused,
        check_lines=options.check_lines,
        dense_keys=options.dense_keys,
        remove_old=options.remove_old,
        by_year=options.by_year,
        buckets=options.buckets,
    )
    for name, report in reports.items():
        print(name)
        report.show(options.rows, truncate=False)


if __name__ == "__main__":
    main()
