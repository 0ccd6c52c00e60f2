"""A batch of datasets with a manifest (SRC6).

``run_batch`` applies one function to every dataset of a list.  The datasets
are submitted side by side from a few driver threads (each is a Spark job of
its own; the threads only wait), so a small dataset's job fills the executors
that a large one leaves idle.  A dataset that fails is reported with its error
and the others go on.  Each finished dataset gets an entry in the manifest
folder, written after its output; a batch started again skips datasets whose
entry matches what lies in the source now and whose output is complete, and
does the others again.

A dataset named twice is done once; an empty list gives an empty report.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Datasets submitted at the same time.
AT_ONCE = 4

DONE, SKIPPED, FAILED = "done", "skipped", "failed"


@dataclass(frozen=True)
class Entry:
    """What became of one dataset: its output (NULL if it failed) and the error (NULL if it did not)."""
    path: str
    status: str
    output: str | None = None
    error: str | None = None


class BatchError(RuntimeError):
    """Some datasets failed; ``entries`` holds the whole report."""

    def __init__(self, entries: Sequence[Entry]):
        self.entries = list(entries)
        bad = [e for e in self.entries if e.status == FAILED]
        super().__init__(f"{len(bad)} of {len(self.entries)} datasets failed: "
                         + "; ".join(f"{e.path}: {e.error}" for e in bad))


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path, by Spark's own classes."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def fingerprint(spark: SparkSession, path: str) -> str:
    """Names, lengths and times of the files below a dataset (its metadata only, no data is read)."""
    fs, at = _at(spark, path)
    files = fs.listFiles(at, True)
    seen = []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()}\t{f.getLen()}\t{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def _entry_file(manifest: str, path: str) -> str:
    return f"{manifest.rstrip('/')}/{hashlib.sha256(path.encode()).hexdigest()[:32]}.json"


def _read_entry(spark: SparkSession, manifest: str, path: str) -> dict | None:
    name = _entry_file(manifest, path)
    fs, at = _at(spark, name)
    if not fs.exists(at):
        return None
    return json.loads(spark.read.text(name, wholetext=True).collect()[0][0])                # one row


def _write_entry(spark: SparkSession, manifest: str, path: str, more: dict) -> None:
    """The entry appears whole or not at all: written beside, then renamed."""
    final = _entry_file(manifest, path)
    fs, draft = _at(spark, final + ".draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"path": path, **more}, indent=1).encode()))
    out.close()
    end = _at(spark, final)[1]
    fs.delete(end, False)
    if not fs.rename(draft, end):
        raise OSError(f"cannot publish {final}")


def run_batch(spark: SparkSession, paths: Sequence[str], work: Callable[[str], str], manifest: str | None = None,
              parameters: dict | None = None, at_once: int = AT_ONCE) -> list[Entry]:
    """Apply ``work`` (dataset path -> output path) to every dataset; one entry each, in the order given.

    ``manifest`` is a folder that the batch may use alone; without it nothing is
    skipped.  ``parameters`` are part of an entry: a dataset done with others is done again.
    """
    paths = list(dict.fromkeys(p.rstrip("/") for p in paths))        # a URI keeps its scheme and authority
    wanted = json.loads(json.dumps(parameters or {}))

    def one(path: str) -> Entry:
        try:
            state = {"source": fingerprint(spark, path), "parameters": wanted}
            known = _read_entry(spark, manifest, path) if manifest else None
            if known and all(known[k] == v for k, v in state.items()):
                fs, success = _at(spark, f"{known['output']}/_SUCCESS")
                if fs.exists(success):
                    return Entry(path, SKIPPED, known["output"])
            output = work(path)
            if manifest:
                _write_entry(spark, manifest, path, {**state, "output": output})
            return Entry(path, DONE, output)
        except Exception as e:                                       # reported, and raised by the caller if it wants
            return Entry(path, FAILED, None, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}")

    if not paths:
        return []
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(paths)))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(one), paths))


def report(spark: SparkSession, entries: Sequence[Entry]):
    """The entries as a table (path, status, output, error)."""
    return spark.createDataFrame([tuple(asdict(e).values()) for e in entries],
                                 "path string, status string, output string, error string")
