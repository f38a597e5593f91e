"""What the jobs' command lines share: options, settings from a small JSON file, a session, a log."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from spotloom.session import DEFAULTS  # noqa: E402
from spotloom.sources import store  # noqa: E402


def settings(defaults: dict, given: dict | None) -> dict:
    """The defaults with what is given; an unknown name is an error."""
    if unknown := sorted(set(given or {}) - set(defaults)):
        raise ValueError(f"unknown settings: {unknown}; known: {sorted(defaults)}")
    return {**defaults, **(given or {})}


def start(name: str) -> SparkSession:
    """A session as spark-submit or the environment describes it, with this library's defaults."""
    b = SparkSession.builder.appName(name)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    return b.getOrCreate()


def main(name: str, run: Callable[..., dict], *paths: str, argv: list[str] | None = None) -> dict:
    """Run a job: ``paths`` are its options, all needed; ``--config`` names a JSON file."""
    parser = argparse.ArgumentParser(prog=name, description=run.__doc__)
    for p in paths:
        parser.add_argument(f"--{p}", required=True)
    parser.add_argument("--config", help="a JSON file of settings")
    args = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = start(name)
    try:
        given = store.read_json(args["config"]) if args["config"] else None
        told = run(spark, *(args[p] for p in paths), config=given)
        print(json.dumps(told, sort_keys=True))
        return told
    finally:
        spark.stop()
