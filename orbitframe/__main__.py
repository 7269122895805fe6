"""Command line: registered queries, and the three lifecycles over tables in folders.

    python -m orbitframe query NAME INPUT OUTPUT [--mode MODE]
    python -m orbitframe retile ROI TILES OPTICAL RADAR OUTPUT --width W --height H [--patch-size 500]
    python -m orbitframe embed RETILED OUTPUT --weights FILE [--config FILE ...] [--least N] [--seed N]
    python -m orbitframe stitch PATCHES VECTORS OUTPUT --left X --top Y --step S --width W --height H

Inputs and outputs are Parquet folders. retile and embed leave out what OUTPUT already holds and print how far they are.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession, functions as F


def parser() -> argparse.ArgumentParser:
    from orbitframe.plans import registry

    out = argparse.ArgumentParser(prog="orbitframe", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = out.add_subparsers(dest="command", required=True)
    query = commands.add_parser("query")
    query.add_argument("name", choices=sorted(registry.QUERIES))
    query.add_argument("input", help="folder of the tables")
    query.add_argument("output", help="folder of the result")
    query.add_argument("--mode", choices=("error", "overwrite", "ignore"), default="error")
    retile = commands.add_parser("retile")
    for name in ("roi", "tiles", "optical", "radar", "output"):
        retile.add_argument(name)
    retile.add_argument("--width", type=int, required=True)
    retile.add_argument("--height", type=int, required=True)
    retile.add_argument("--patch-size", type=int, default=500)
    embed = commands.add_parser("embed")
    for name in ("retiled", "output", "--weights"):
        embed.add_argument(name, **({"required": True} if name.startswith("--") else {}))
    embed.add_argument("--config", nargs="*", default=[], help="JSON files of sizes; later ones win")
    embed.add_argument("--facts", help="JSON file: s2 and s1, each the means and the deviations of the bands")
    embed.add_argument("--least", type=int, default=0)
    embed.add_argument("--seed", type=int, default=0)
    embed.add_argument("--saved-names", action="store_true", help="the weights stand under a saved model's names")
    stitch = commands.add_parser("stitch")
    for name in ("patches", "vectors", "output"):
        stitch.add_argument(name)
    for name in ("--left", "--top", "--step"):
        stitch.add_argument(name, type=float, required=True)
    for name in ("--width", "--height"):
        stitch.add_argument(name, type=int, required=True)
    return out


def main(arguments: list[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"orbitframe {given.command}").getOrCreate()
    {"query": query, "retile": retile, "embed": embed, "stitch": stitch}[given.command](spark, given)


def query(spark: SparkSession, given) -> None:
    from orbitframe.plans import registry

    registry.QUERIES[given.name](spark, given.input).write.mode(given.mode).parquet(given.output)


def told(states: DataFrame, began: float) -> None:
    from orbitframe.plans import lifecycle

    for row in lifecycle.progress(states, time.time() - began).collect():
        print(", ".join(f"{k} {v}" for k, v in row.asDict().items()))


def retile(spark: SparkSession, given) -> None:
    from orbitframe.operators import grid
    from orbitframe.plans import lifecycle

    began, read = time.time(), spark.read.parquet
    roi, done = read(given.roi), lifecycle._table(spark, f"{given.output}/optical")
    left, right = lifecycle.retile(spark, roi, read(given.tiles), read(given.optical), read(given.radar), given.width, given.height, given.patch_size, done=done)
    right.write.mode("append").partitionBy("patch_id").parquet(f"{given.output}/radar")
    left.write.mode("append").partitionBy("patch_id").parquet(f"{given.output}/optical")  # last: it marks a patch as done
    wanted = grid.patches_with_data(grid.patch_grid(spark, given.width, given.height, given.patch_size), roi, given.patch_size)
    told(lifecycle.status(wanted, read(f"{given.output}/optical").withColumn("patch_id", F.col("patch_id").cast("string"))), began)


def embed(spark: SparkSession, given) -> None:
    import json

    from orbitframe.operators import network
    from orbitframe.plans import lifecycle

    began, read = time.time(), spark.read.parquet
    config = network.Config.load(*given.config)
    weights = network.load_weights(given.weights, config if given.saved_names else None)
    facts = {"s2": ([0.0] * config.optical_bands, [1.0] * config.optical_bands), "s1": ([0.0] * config.radar_bands, [1.0] * config.radar_bands)}
    if given.facts:
        with open(given.facts, encoding="utf-8") as file:
            facts |= json.load(file)
    series = [read(f"{given.retiled}/{name}").withColumn("patch_id", F.col("patch_id").cast("string")) for name in ("optical", "radar")]

    def make(pending: DataFrame) -> DataFrame:
        left, right = (s.join(pending, "patch_id", "left_semi") for s in series)
        return lifecycle.embed(left, right, weights, config, facts["s2"], facts["s1"], given.least, given.seed, failures=True)

    told(lifecycle.run_stage(spark, series[0].select("patch_id").distinct(), make, given.output), began)


def stitch(spark: SparkSession, given) -> None:
    from orbitframe.operators import grid

    target = {"left": given.left, "top": given.top, "a": given.step, "e": -given.step, "width": given.width, "height": given.height}
    grid.stitch_crop(spark.read.parquet(given.patches), spark.read.parquet(given.vectors), target).write.mode("overwrite").parquet(given.output)


if __name__ == "__main__":
    main()
