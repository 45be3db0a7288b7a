"""A pointer to the live folders of a stored dataset, switched in one step.

Writers put new data into folders of their own and then ``commit`` a small JSON
text that names what is live. The text is version n + 1 and is created only if
nobody else has created it, so of two writers that started from version n one
gets ``ConcurrentChange`` and starts over; readers see version n or n + 1 and
never a mixture. Nothing is renamed or overwritten.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from strata.sinks.swap import ConcurrentChange, _fs, delete_path, path_exists, read_text

VERSIONS = "_versions"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, f"{path.rstrip('/')}/{VERSIONS}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _text_of(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{VERSIONS}/{version}.json"


def latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest version; (0, {}) if there is none."""
    for n in reversed(_numbers(spark, path)):
        try:
            return n, json.loads(read_text(spark, _text_of(path, n)))
        except ValueError:  # still being written: not committed yet
            continue
    return 0, {}


def commit(spark: SparkSession, path: str, base: int, content: dict) -> int:
    """Make ``content`` the version after ``base``."""
    fs, p = _fs(spark, _text_of(path, base + 1))
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise ConcurrentChange(f"{path}: version {base + 1} was committed by another writer") from e
        raise
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    return base + 1


def forget(spark: SparkSession, path: str, keep: int, folders) -> list[str]:
    """Delete versions older than the newest ``keep`` and the folders that only they name.

    ``folders(content)`` lists the folders (below ``path``) that a version names.
    """
    numbers = _numbers(spark, path)
    old, new = numbers[:-keep], numbers[-keep:]
    live = {f for n in new for f in folders(json.loads(read_text(spark, _text_of(path, n))))}
    gone = {f for n in old for f in folders(json.loads(read_text(spark, _text_of(path, n))))} - live
    for f in sorted(gone):
        if path_exists(spark, f"{path.rstrip('/')}/{f}"):
            delete_path(spark, f"{path.rstrip('/')}/{f}")
    for n in old:
        delete_path(spark, _text_of(path, n))
    return sorted(gone)
