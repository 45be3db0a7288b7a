"""Replace a stored folder, or some of its partitions, by renaming staged data into place.

Steps of a rewrite, all next to the target on the same storage:

1. ``observe`` notes what the folders hold (file names, lengths, times),
   before the frame that the new data comes from is made;
2. the new data is written to ``<path>._staging/data``;
3. a manifest is written: which folders will be replaced or removed, and what
   each of them held in step 1;
4. each folder is moved away, compared with step 1 once more, and the staged
   one renamed into its place;
5. the staging folder is removed.

A folder that has changed since step 1 holds rows that the new data may lack:
the rewrite ends with ``ConcurrentChange``, that folder stays as it is, and the
caller starts over. (A rewrite of several folders may then have replaced some
of them; each by itself is whole.)

``finish_swap`` runs first in every rewrite. Staging without a manifest was
never complete and is thrown away. With a manifest an interrupted swap is
completed, but only for folders that still hold what the manifest says, or that
are missing because the swap had moved them. So a left-over from any earlier
run can neither replace newer data nor lose it. Between two renames a reader
can find a folder missing; run one rewrite of a table at a time (appends
meanwhile do no harm).

MARKS is a small file inside a folder that moves with it: which batches of an
ingest its rows already contain. A rewrite carries it over.

The file-system calls use Hadoop's API through the classic session's JVM
handle, here and nowhere else.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isDirectory())


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {source} to {target}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (without hidden ones)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if "=" in n or not n.startswith(("_", ".")))


def listing(spark: SparkSession, path: str) -> list[str] | None:
    """name:length:time of every file under ``path``; None if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        s = it.next()
        found.append(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}")
    return sorted(found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def staging_path(path: str) -> str:
    return path.rstrip("/") + "._staging"


def _at(path: str, name: str) -> str:
    return f"{path}/{name}" if name else path


MARKS = "_epochs"
#: File-system calls that wait for storage side by side.
CALLS_AT_ONCE = 16


class ConcurrentChange(RuntimeError):
    """Another writer changed a folder while its replacement was computed; nothing of it was lost: start over."""


def observe(spark: SparkSession, path: str, names: Iterable[str] | None = None) -> dict[str, list[str] | None]:
    """What ``path``, or the folders ``names`` in it, hold now. Take it before reading them."""
    path = path.rstrip("/")
    names = [""] if names is None else list(names)
    return dict(zip(names, _each(lambda n: listing(spark, _at(path, n)), names), strict=True))


def finish_swap(spark: SparkSession, path: str) -> list[str]:
    """Complete or throw away what an interrupted replacement of ``path`` left behind.

    Returns the folders that were left alone because they are no longer what
    the manifest says (already replaced, or changed by another writer).
    """
    path = path.rstrip("/")
    stage = staging_path(path)
    if not path_exists(spark, stage):
        return []
    manifest, left = f"{stage}/manifest", []
    if path_exists(spark, manifest):
        held = json.loads(read_text(spark, manifest))

        def moved(name: str) -> bool:
            as_noted = listing(spark, _at(path, name)) in (held[name], None)
            return as_noted and _move_in(spark, path, stage, name, held[name])

        left = [n or path for n, ok in zip(held, _each(moved, held), strict=True) if not ok]
    delete_path(spark, stage)
    return left


def _move_in(spark: SparkSession, path: str, stage: str, name: str, held: list[str] | None) -> bool:
    """Put one staged folder in its place; False if the target isn't what it was."""
    target, fresh, old = _at(path, name), _at(f"{stage}/data", name), _at(f"{stage}/old", name)
    if path_exists(spark, target):
        rename_path(spark, target, old)
        if listing(spark, old) != held:
            rename_path(spark, old, target)
            return False
    if path_exists(spark, fresh):
        rename_path(spark, fresh, target)
    return True


def _each(fn: Callable, items: Iterable) -> list:
    """Results in order; the calls wait for storage, so many go at once."""
    items = list(items)
    if len(items) < 2:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(CALLS_AT_ONCE) as pool:
        return list(pool.map(fn, items))


def _check_unchanged(spark: SparkSession, path: str, held: dict[str, list[str] | None]) -> None:
    now = observe(spark, path, held)
    changed = [n or path for n, files in held.items() if now[n] != files]
    if changed:
        raise ConcurrentChange(f"{path}: changed while its replacement was computed: {', '.join(changed[:5])}")


def replace(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    names: Iterable[str] | None = None,
    seen: dict[str, list[str] | None] | None = None,
) -> None:
    """Replace ``path`` by what ``write(folder)`` stores in a new folder; ``write`` may read ``path``.

    With ``names``, only those partition folders (directly under ``path``) are
    replaced, or removed if nothing was written for them. Partition folders
    beyond them are added and must not exist yet. Call ``finish_swap`` and
    ``observe`` before making the frame that ``write`` stores, and pass what was
    observed as ``seen``; without it the folders are observed here, which is
    right for data that doesn't come from them. Raises ``ConcurrentChange``.
    """
    path = path.rstrip("/")
    stage = staging_path(path)
    delete_path(spark, stage)
    held = dict(seen) if seen is not None else observe(spark, path, names)
    write(f"{stage}/data")
    if "" not in held:
        held |= {n: None for n in child_names(spark, f"{stage}/data") if n not in held}
    try:
        _check_unchanged(spark, path, held)
    except ConcurrentChange:
        delete_path(spark, stage)
        raise
    for n in (n for n, files in held.items() if any(f.startswith(f"{MARKS}:") for f in files or ())):
        marks, staged = f"{_at(path, n)}/{MARKS}", _at(f"{stage}/data", n)
        if path_exists(spark, staged) and not path_exists(spark, f"{staged}/{MARKS}"):
            write_text(spark, f"{staged}/{MARKS}", read_text(spark, marks))
    write_text(spark, f"{stage}/manifest", json.dumps(held))
    changed = finish_swap(spark, path)
    if changed:
        raise ConcurrentChange(f"{path}: changed while its replacement was moved in: {', '.join(changed[:5])}")


def partition_levels(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition columns of a stored table, from its folders."""
    levels, at = [], path.rstrip("/")
    while True:
        folders = [n for n in child_names(spark, at) if "=" in n]
        if not folders:
            return levels
        levels.append(folders[0].partition("=")[0])
        at = f"{at}/{folders[0]}"


def partition_folders(spark: SparkSession, path: str, column: str) -> dict[str | None, str]:
    """Folder of each value (as text) of the first partition column."""
    found: dict[str | None, str] = {}
    for name in child_names(spark, path):
        key, _, value = name.partition("=")
        if key == column:
            found[None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value)] = name
    return found
