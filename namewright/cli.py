"""Command line: one subcommand per stage, over a project folder.

    python -m namewright.cli --root DIR [--settings FILE] STAGE [STAGE ...]
"""

from __future__ import annotations

import argparse
import logging
import sys

from namewright.config import Settings, load_settings


def main(arguments: list[str] | None = None) -> int:
    from namewright.operators.stages import STAGES, Store

    parser = argparse.ArgumentParser(prog="namewright")
    parser.add_argument("--root", required=True, help="project folder (a URI on a cluster)")
    parser.add_argument("--settings", help="JSON or YAML file of overrides")
    parser.add_argument("stages", nargs="+", choices=[*STAGES, "all"])
    options = parser.parse_args(arguments)
    from pyspark.errors import PySparkException
    from pyspark.sql import SparkSession

    try:
        settings = load_settings(options.settings) if options.settings else Settings()
        store = Store(SparkSession.builder.appName("namewright").getOrCreate(), options.root, settings)
        for name in STAGES if options.stages == ["all"] else options.stages:
            print(name, STAGES[name](store), flush=True)
    except (OSError, ValueError, RuntimeError, PySparkException) as error:
        logging.error("%s", error)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
