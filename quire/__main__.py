"""Command line: run, list, doctor, sweep, files, daemon."""

from __future__ import annotations

import argparse
import logging
import sys
import time

from pyspark.sql import SparkSession

from quire.config import Options
from quire.plans.pipeline import Pipeline, doctor
from quire.plans.snapshots import Store
from quire.sources import wiki


def parsed(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="quire", description=__doc__)
    p.add_argument("command", choices=["run", "list", "doctor", "sweep", "files", "daemon"])
    p.add_argument("--root", default="store", help="folder of the published tables, shared by driver and executors")
    p.add_argument("--folder", help="folder of the documents")
    p.add_argument("--config", help="YAML file of options, read anew for each run of the daemon")
    p.add_argument("--steps", default="process,store,graph")
    p.add_argument("--reset", action="store_true", help="forget what is published; all is built again")
    p.add_argument("--full", action="store_true", help="build unchanged documents too")
    p.add_argument("--urls", default="", help="comma-separated addresses to list as entries")
    p.add_argument("--out", help="folder for the chunk files")
    p.add_argument("--every", type=float, default=120, help="minutes between two runs of the daemon")
    p.add_argument("--times", type=int, default=0, help="runs of the daemon, 0 for no end")
    p.add_argument("--tries", type=int, default=3, help="tries of a run that breaks off")
    p.add_argument("--pause", type=float, default=60, help="seconds between two tries")
    return p.parse_args(argv)


def attempt(spark: SparkSession, a: argparse.Namespace) -> int:
    """A run with its options as they are now; tried again if it breaks off."""
    log = logging.getLogger("quire")
    for left in range(max(1, a.tries) - 1, -1, -1):
        try:
            options = Options.load(a.config, **({"force_rebuild": True} if a.full or a.reset else {}))
            Pipeline(spark, a.root, options).run(steps=a.steps.split(","), folder=a.folder, reset=a.reset)
        except ValueError:
            raise
        except Exception:
            log.exception("the run broke off, %d tries left", left)
            if left:
                time.sleep(a.pause)
        else:
            return 0
    return 2


def main(argv: list[str] | None = None) -> int:
    a = parsed(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    if a.command == "doctor":
        found = doctor(a.root)
        print("\n".join(found) or "ok")
        return int(any(x.startswith("fatal") for x in found))
    if a.command == "sweep":
        print(Store(a.root).sweep())
        return 0
    spark = SparkSession.builder.appName("quire").getOrCreate()
    if a.command == "list":
        wiki.entries(wiki.url_list(spark.createDataFrame([(a.urls,)], "urls string"), "urls"), "url").show(10_000, truncate=False)
        return 0
    if a.command == "files":
        Pipeline(spark, a.root, Options.load(a.config)).write_files(a.out)
        return 0
    said = attempt(spark, a)
    done = 1
    while a.command == "daemon" and (not a.times or done < a.times):
        time.sleep(a.every * 60)
        said, done = attempt(spark, a), done + 1
    return said


if __name__ == "__main__":
    sys.exit(main())
