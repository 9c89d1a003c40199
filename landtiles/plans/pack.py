"""Job: bring a folder of tiles into one table, in passes that can be cut short and run again.

A ledger beside the table tells what is done. Its rows are manifests (``pass`` is -1, ``size`` their names), each with
the names that no manifest before it has, and passes over ranges of a manifest (``size`` ranges from number ``pass``). A pass writes its own partition of the table, in place
of whatever a run that was killed left there, and is entered in the ledger when its files are committed. Readers see
the partitions of entered passes only, so no tile is seen twice or half. One job packs a table at a time.
"""

import argparse
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landtiles.session import job_session
from landtiles.sinks.ledger import enter, manifest_path, read_ledger
from landtiles.sources.manifest import manifest_ranges, names_in, read_manifest, write_manifest

RANGES_PER_PASS = 256  # a million names


def pack(
    spark: SparkSession,
    root: str,
    table: str,
    classes: list[str] | None,
    names: DataFrame | None = None,
    ranges_per_pass: int = RANGES_PER_PASS,
) -> DataFrame:
    """Add the tiles of the class folders that match a pattern, or of a flat folder, that the table does not have.

    ``names`` (column ``name``) takes the place of a listing. Work that an earlier run left undone comes first.
    Returns the ledger.
    """
    labelled = classes is not None
    finish(spark, table, ranges_per_pass)
    given = names
    if given is None:
        lists = [names_in(spark, root, labelled, classes=c) for c in classes] if labelled else [names_in(spark, root, False)]
        given = reduce(DataFrame.union, lists)
    ledger = read_ledger(spark, table)
    numbers = sorted(r.manifest for r in ledger.where("pass = -1 and size > 0").collect())
    for number in numbers:
        given = given.join(spark.read.parquet(manifest_path(table, number)), "name", "left_anti")
    number = max(numbers, default=-1) + 1
    write_manifest(given, manifest_path(table, number))
    count = spark.read.schema("name string").parquet(manifest_path(table, number)).count()
    if count:
        enter(spark, table, number, -1, root, labelled, count, None, None)
        finish(spark, table, ranges_per_pass)
    return read_ledger(spark, table)


def finish(spark: SparkSession, table: str, ranges_per_pass: int = RANGES_PER_PASS) -> None:
    """Run the passes of all manifests that the ledger does not have.

    A pass is named by its first range, so a run with other pass sizes does the ranges that are left.
    """
    rows = read_ledger(spark, table).collect()
    for entry in sorted((r for r in rows if r["pass"] == -1), key=lambda r: r.manifest):
        place = manifest_path(table, entry.manifest)
        ranges = len(manifest_ranges(place))
        done = sorted(r["pass"] for r in rows if r.manifest == entry.manifest and r["pass"] >= 0)
        ends = {r["pass"]: r.size for r in rows if r.manifest == entry.manifest and r["pass"] >= 0}
        first = 0
        while first < ranges:
            if first in ends:
                first += ends[first]
                continue
            last = min([ranges, first + ranges_per_pass, *(d for d in done if d > first)])
            _pass(spark, table, entry, place, first, last)
            first = last


def _pass(spark: SparkSession, table: str, entry, place: str, first: int, last: int) -> None:
    seen = Observation()
    tiles = read_manifest(spark, place, entry.root, entry.labelled, first=first, last=last, invalid=True)
    readable = F.col("image.height") >= 0
    tiles = tiles.observe(
        seen, F.count_if(readable).alias("n_tiles"), F.count_if(~readable).alias("n_unreadable")
    )
    placed = tiles.where(readable).withColumns({"manifest": F.lit(entry.manifest), "pass": F.lit(first)})
    (
        placed.write.partitionBy("manifest", "pass")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(table)
    )
    counts = seen.get
    enter(spark, table, entry.manifest, first, entry.root, entry.labelled, last - first, counts["n_tiles"], counts["n_unreadable"])


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tiles-root", required=True, help="folder of tiles")
    parser.add_argument("--table", required=True, help="table to add the tiles to")
    parser.add_argument("--classes", nargs="+", help="patterns of class folders; none if flat")
    parser.add_argument("--tile-index", help="CSV whose file names stand in place of a listing")
    args = parser.parse_args(argv)
    spark = job_session("pack")
    names = None
    if args.tile_index:
        from landtiles.sources.tables import read_tile_index

        names = read_tile_index(spark, args.tile_index).select("name")
        if args.classes:
            raise ValueError("a tile index names the tiles of a flat folder")
    pack(spark, args.tiles_root, args.table, args.classes, names).where("pass >= 0").show(truncate=False)


if __name__ == "__main__":
    main()
