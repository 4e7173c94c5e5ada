"""Merging the small files of a stream's archive, beside the running stream.

``ingest.start_archive`` writes ``batch=N/dt=D/lang=L`` folders, a few files for
every micro-batch. Merging a date writes its rows of the micro-batches so far to a
new folder and renames that to ``merged/dt=D/upto=N``. The rename is the whole swap:
readers that use ``read_archive`` take of each date the merged folder with the
largest ``upto`` and the micro-batches after it. What it replaces can then be
deleted, at once or later.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from burstline.sources import layout

MERGED = "merged"


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Values of the ``prefix=value`` folders in a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return [n.removeprefix(f"{prefix}=") for n in names if n.startswith(f"{prefix}=")]


def _parts(spark: SparkSession, path: str) -> dict[str, tuple[int, list[int]]]:
    """Of each date, up to which micro-batch it is merged (-1: not), and the later ones."""
    later: dict[str, list[int]] = defaultdict(list)
    for batch in _folders(spark, path, "batch"):
        for dt in _folders(spark, f"{path}/batch={batch}", "dt"):
            later[dt].append(int(batch))
    merged = {
        dt: max(map(int, _folders(spark, f"{path}/{MERGED}/dt={dt}", "upto")))
        for dt in _folders(spark, f"{path}/{MERGED}", "dt")
    }
    return {
        dt: (merged.get(dt, -1), sorted(b for b in later[dt] if b > merged.get(dt, -1)))
        for dt in {*later, *merged}
    }


def _read(spark: SparkSession, path: str, parts: dict[str, tuple[int, list[int]]]) -> DataFrame | None:
    own = [f"{path}/{MERGED}/dt={dt}/upto={upto}" for dt, (upto, _) in parts.items() if upto >= 0]
    new = [f"{path}/batch={b}/dt={dt}" for dt, (_, batches) in parts.items() for b in batches]
    found = None
    for base, folders, extra in ((f"{path}/{MERGED}", own, "upto"), (path, new, "batch")):
        if folders:
            df = spark.read.option("basePath", base).parquet(*folders).drop(extra)
            found = df if found is None else found.unionByName(df)
    return found


def read_archive(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DataFrame | None:
    """The archived posts, each once; of some ``dates`` only, if given. None without any."""
    path = path.rstrip("/")
    parts = _parts(spark, path)
    return _read(spark, path, {dt: p for dt, p in parts.items() if dates is None or dt in dates})


def merge_dates(
    spark: SparkSession, path: str, dates: Sequence[str] | None = None, least: int = 2,
    clean: bool = True,
) -> list[str]:
    """Merge the dates that have ``least`` micro-batches or more; returns them.

    One date after the other is read, rebalanced by language into files of a good
    size, and swapped in. ``clean`` deletes what was replaced; leave it off while
    readers that started before may still need it.
    """
    path = path.rstrip("/")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    done = []
    for dt, (upto, batches) in sorted(_parts(spark, path).items()):
        if (dates is not None and dt not in dates) or len(batches) + (upto >= 0) < least or not batches:
            continue
        aside = f"{path}/_merging/dt={dt}/upto={batches[-1]}"
        rows = _read(spark, path, {dt: (upto, batches)}).drop("dt")
        layout.write_partitioned(rows, aside, by=("lang",))
        target = hadoop(f"{path}/{MERGED}/dt={dt}/upto={batches[-1]}")
        fs.mkdirs(target.getParent())
        if not fs.rename(hadoop(aside), target):
            raise OSError(f"could not move {aside} to {target}")
        if clean:
            if upto >= 0:
                layout.remove(spark, f"{path}/{MERGED}/dt={dt}/upto={upto}")
            for b in batches:
                layout.remove(spark, f"{path}/batch={b}/dt={dt}")
        done.append(dt)
    return done
