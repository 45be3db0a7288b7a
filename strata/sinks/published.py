"""Tables that are replaced in one step: every version a folder of its own, a view as the pointer.

``publish`` writes the new version next to the old ones and then replaces the
persistent view ``name``, one statement of the catalog. A query that started on
the old version goes on reading its files; one that starts later reads the new
ones; there is no moment without a table. The data may come from the table
itself, may have another schema and any partitioning. ``forget_published``
removes versions that no reader needs any more.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from strata.sinks.versions import commit, forget, latest


def publish(spark: SparkSession, df: DataFrame, name: str, root: str, partition_by: str | Iterable[str] | None = None) -> DataFrame:
    """Make ``df`` the content of ``name``; its versions live below ``root``. Returns the published frame.

    Raises ``ConcurrentChange`` if another version was published while this one
    was written; the view then shows the other one.
    """
    root = root.rstrip("/")
    base, _ = latest(spark, root)
    folder = f"v{base + 1}"
    by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{root}/{folder}")
    commit(spark, root, base, {"folder": folder})
    point(spark, name, root)
    return spark.table(name)


def point(spark: SparkSession, name: str, root: str) -> None:
    """Let the view ``name`` show the newest version below ``root`` (also repairs a publish that broke off)."""
    version, content = latest(spark, root)
    if not version:
        raise FileNotFoundError(root)
    location = f"{root.rstrip('/')}/{content['folder']}".replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{location}`")


def forget_published(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` versions."""
    return forget(spark, root.rstrip("/"), keep, lambda content: [content["folder"]])
