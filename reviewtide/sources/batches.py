"""Tables that grow by one folder per batch, folded into few larger tables.

``fold`` rewrites the finished batches into one table and names it in a new version of the
table's manifest. Readers take the newest version, so they see a batch either in its folder or in
the table. ``FANOUT`` tables of one level are merged into one of the next: a row is rewritten
once per level, and there are never more tables than ``FANOUT`` times the number of levels, which grows
with the logarithm of the number of folds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from reviewtide.plans.storage import list_paths, path_exists, read_file, remove_path, write_file

#: Tables of one level that are merged into one.
FANOUT = 8
#: Hidden from Spark's listing by their first letter.
_MANIFESTS = "_manifests"
_TABLE = "_folded/table-"
#: Columns that say which batch a row came with.
BATCH = "run string, batch_id string"


def batch_folder(path: str, run: int | str, batch_id: int | str) -> str:
    """The folder that one batch of one run owns. Batch numbers alone repeat in other runs."""
    return f"{path}/run={run}/batch_id={batch_id}"


@dataclass
class Manifest:
    """A version: its tables as (name, level), the settled batches of each run, and what it no longer needs.

    Settled batches are kept as ranges of numbers and as names.
    """

    version: int = 0
    tables: list[list] = field(default_factory=list)
    settled: dict[str, list] = field(default_factory=dict)
    unused: list[str] = field(default_factory=list)

    def has(self, run: int | str, batch_id: int | str) -> bool:
        """Whether a batch has been folded."""
        known = self.settled.get(str(run), [])
        number = _number(str(batch_id))
        if number is None:
            return str(batch_id) in known
        return any(low <= number <= high for low, high in (k for k in known if isinstance(k, list)))


def _number(batch_id: str) -> int | None:
    return int(batch_id) if batch_id.isdecimal() and str(int(batch_id)) == batch_id else None


def _settle(known: list, batch_ids: list[str]) -> list:
    """``known`` with further batches, neighbouring numbers as one range."""
    named = {k for k in known if isinstance(k, str)} | {b for b in batch_ids if _number(b) is None}
    given = [[n, n] for b in batch_ids if (n := _number(b)) is not None]
    ranges: list[list[int]] = []
    for low, high in sorted([k for k in known if isinstance(k, list)] + given):
        if ranges and low <= ranges[-1][1] + 1:
            ranges[-1][1] = max(high, ranges[-1][1])
        else:
            ranges.append([low, high])
    return ranges + sorted(named)


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest version; an empty one where nothing has been folded."""
    found = list_paths(spark, f"{path}/{_MANIFESTS}/*.json")
    if not found:
        return Manifest()
    return Manifest(**json.loads(read_file(spark, max(found))))


def _batches(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(run, batch_id) of every batch folder."""
    folders = list_paths(spark, f"{path}/run=*/batch_id=*")
    return [tuple(part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:]) for folder in folders]


def _tables(spark: SparkSession, path: str, names: list[str], schema: str) -> DataFrame | None:
    """Rows of folded tables; their partition folders count from each table on."""
    rows = None
    for name in names:
        part = spark.read.schema(f"{schema}, {BATCH}").parquet(f"{path}/{name}")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _folders(spark: SparkSession, path: str, batches: list[tuple[str, str]], schema: str) -> DataFrame:
    folders = [batch_folder(path, *batch) for batch in batches]
    return spark.read.schema(f"{schema}, {BATCH}").option("basePath", path).parquet(*folders)


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every row with the given fields and ``run`` and ``batch_id``, folded or not."""
    current = manifest(spark, path)
    if not current.version:
        return spark.read.schema(f"{schema}, {BATCH}").parquet(path)
    rows = _tables(spark, path, [name for name, _ in current.tables], schema)
    if fresh := [batch for batch in _batches(spark, path) if not current.has(*batch)]:
        rows = rows.unionByName(_folders(spark, path, fresh, schema))
    return rows


def settled(spark: SparkSession, path: str, run: int | str, batch_id: int | str) -> bool:
    """Whether a batch has been folded, so that its rows are stored whatever becomes of its folder."""
    return manifest(spark, path).has(run, batch_id)


def fold(
    spark: SparkSession,
    path: str,
    schema: str,
    write: Callable[[DataFrame, str], None],
    combine: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Manifest:
    """Fold the finished batches into a table, merge tables where ``FANOUT`` are of one level.

    ``write`` writes rows with their ``run`` and ``batch_id`` to a folder; ``combine`` may keep fewer rows.
    A batch is finished when its folder holds Spark's success marker; others stay as they are. The new version
    is one renamed file. Until it is there nothing has changed, and a fold that fails leaves only
    a folder that no version names. Folders and tables that a version no longer needs are deleted by
    the fold after it, so a query that began before a fold still finds its files. Folds of one
    table, and a repeat of one of its batches, must follow each other.
    """
    old = manifest(spark, path)
    for name in old.unused:
        remove_path(spark, f"{path}/{name}")
    done = [
        batch for batch in _batches(spark, path)
        if not old.has(*batch) and path_exists(spark, f"{batch_folder(path, *batch)}/_SUCCESS")
    ]
    if not done:
        return old

    def put(rows: DataFrame, level: int) -> list:
        name = f"{_TABLE}{uuid.uuid4().hex}"
        write(combine(rows), f"{path}/{name}")
        return [name, level]

    tables = [*old.tables, put(_folders(spark, path, done, schema), 0)]
    unused = [batch_folder("", *batch)[1:] for batch in done]
    level = 0
    while len(full := [name for name, of in tables if of == level]) >= FANOUT:
        merged = put(_tables(spark, path, full, schema), level + 1)
        tables = [table for table in tables if table[1] != level] + [merged]
        unused += full
        level += 1
    known = dict(old.settled)
    for run in {run for run, _ in done}:
        known[run] = _settle(known.get(run, []), [b for r, b in done if r == run])
    new = Manifest(old.version + 1, tables, known, unused)
    write_file(spark, f"{path}/{_MANIFESTS}/{new.version:012d}.json", json.dumps(vars(new)))
    return new
