"""Job 4: standardise a monitor file for the portal (one lazy projection, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from areacube.operators.relabel import (clean_field_labels, compose_district, monitor_prefix, pad_district,
                                        prefix_columns)
from areacube.plans.batch import FAILED, BatchError, Entry, run_batch
from areacube.sinks.cube import write_relabelled
from areacube.sources.labelled import read_labelled


def relabel(df: DataFrame, prefix: str, district: str = "NOG_Wijk2020",
            municipality: str = "Gemeentecode", district_part: str = "Wijkcode") -> DataFrame:
    """LBL7, LBL8 (adult monitor only), LBL5, PRJ6, in the reference's order."""
    df = pad_district(df, district)
    if prefix == "VO":
        df = compose_district(df, municipality, district_part)
    df = clean_field_labels(df)
    return prefix_columns(df, prefix)


def relabel_batch(spark, paths, prefix: str | None = None, manifest: str | None = None) -> list[Entry]:
    """SRC6 + SNK4: the same standardisation for every chosen dataset, with a report.

    Each dataset has its own schema, so each is its own lazy projection and
    write (one Spark job per file, no shuffle), several at a time; the prefix comes
    from the folder name unless given.  A dataset that fails does not stop the
    others; with a manifest folder, a second start skips what is finished.
    """
    def one(path: str) -> str:
        folder, _, name = path.rpartition("/")
        data, _ = read_labelled(spark, path)
        return write_relabelled(relabel(data, prefix or monitor_prefix(folder)), folder or ".", name)
    return run_batch(spark, paths, one, manifest, {"prefix": prefix})


def relabel_files(spark, paths, prefix: str | None = None, manifest: str | None = None) -> list[str]:
    """``relabel_batch`` as the list of written copies; raises after the last dataset if any failed."""
    entries = relabel_batch(spark, paths, prefix, manifest)
    if any(e.status == FAILED for e in entries):
        raise BatchError(entries)
    return [e.output for e in entries]
