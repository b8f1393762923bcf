"""Run the bronze -> silver -> gold chain as a long-lived streaming job.

    python -m assetflow.streaming --root <shared folder> --assets <parquet metadata> \
        [--trigger "1 minute"] [--max-files N] [--window "1 hour"] [--watermark "6 hours"] [--cores N] [--archive <folder>] [--evolve]

Reading files land in ``<root>/landing``; tables and checkpoints live under
``<root>``. Every stage restarts from its checkpoint after a failure.
"""

from __future__ import annotations

import argparse

from .. import config
from ..session import build_session, scale_settings
from .medallion import Medallion


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--root", required=True)
    ap.add_argument("--assets", required=True, help="parquet table: country, manufacturer, asset_id, region")
    ap.add_argument("--trigger", default="1 minute")
    ap.add_argument("--max-files", type=int, default=None)
    ap.add_argument("--window", default=config.WINDOW)
    ap.add_argument("--watermark", default=config.WATERMARK)
    ap.add_argument("--state-partitions", type=int, default=None)
    ap.add_argument("--cores", type=int, default=None, help="cores of the cluster: settings for a large one, state in RocksDB")
    ap.add_argument("--archive", default=None, help="folder that consumed landing files are moved to")
    ap.add_argument("--evolve", action="store_true", help="take columns that are not declared")
    a = ap.parse_args()
    spark = build_session(app="assetflow-streams", extra=scale_settings(a.cores) if a.cores else None)
    m = Medallion(spark, a.root, assets=lambda: spark.read.parquet(a.assets), length=a.window,
                  watermark=a.watermark, max_files=a.max_files, state_partitions=a.state_partitions,
                  archive=a.archive, evolve=a.evolve)
    m.start(trigger={"processingTime": a.trigger})
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
