"""Bring a lake up to date from its landed Bronze documents: Silver, checks, Gold."""

from __future__ import annotations

import argparse
import logging
import sys

from wattlake.plans.medallion import rebuild_all, run
from wattlake.session import build_session
from wattlake.sources.zones import load_zones

log = logging.getLogger("wattlake")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="wattlake", description=__doc__)
    parser.add_argument("lake", help="root folder of the lake")
    parser.add_argument("zones", help="JSON file with the zone names")
    parser.add_argument("--layout", choices=["files", "lines"], default="files")
    parser.add_argument(
        "--rebuild", action="store_true", help="recompute Silver from all of Bronze"
    )
    options = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = build_session()
    job = rebuild_all if options.rebuild else run
    report = job(spark, options.lake, load_zones(spark, options.zones), layout=options.layout)
    for table, count in report.files_loaded.items():
        log.info("silver/%s: %d Bronze files loaded", table, count)
    for message in report.warnings:
        log.warning(message)
    for message in report.errors:
        log.error(message)
    return 0 if report.succeeded else 1


if __name__ == "__main__":
    sys.exit(main())
