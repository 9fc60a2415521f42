"""Many small loads of a table merged into a file set for each day, behind a manifest.

A load is a partition of its own (`tables.load`), so a table that is loaded every half minute gains thousands of
partitions a day. `compact` rewrites all loads that are complete, together with what was merged before of
the days they touch, as one load `merged-N`, and then commits version N of the manifest. Readers go through
`current`: they see the loads up to the newest version's marks through its merged loads, and later loads as
they are, so they switch with the one file of the manifest and never see a row twice or not at all.

The manifest marks for each run the highest batch that is merged. A merged batch that is run again
therefore stays unseen. `clean` removes what no reader of the newest version needs. One compaction at a time: a
second one that commits the same version fails and changes nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

from flowsight.sinks.tables import DATE_COLUMN, LOAD_COLUMN, MERGED, laid_out, with_clause

_ROWS = "kind string, name string, upto bigint, day string"
_NUMBERED = re.compile(r"(.+)-([0-9]+)")


@dataclass
class Manifest:
    """Version, the merged load that holds each day ('' in tables without days), the marks of runs."""

    version: int = 0
    days: dict[str, list[str]] = field(default_factory=dict)
    marks: dict[str, int | None] = field(default_factory=dict)

    def covers(self, load_id: str) -> bool:
        run, batch = _run_of(load_id)
        if run not in self.marks:
            return False
        mark = self.marks[run]
        return batch is None or mark is not None and batch <= mark


def _run_of(load_id: str) -> tuple[str, int | None]:
    """(run, batch) of a numbered load, (name, None) of any other."""
    found = _NUMBERED.fullmatch(load_id)
    return (f"{found[1]}-", int(found[2])) if found else (load_id, None)


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def read_manifest(spark: SparkSession, table: str) -> Manifest:
    """The newest version; an empty one for a table that was never compacted."""
    path = f"{location(spark, table)}/_manifest"
    try:
        rows = spark.read.schema(f"{_ROWS}, version int").json(path).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return Manifest()
    newest = Manifest(max((r["version"] for r in rows), default=0))
    for r in rows:
        if r["version"] == newest.version and r["kind"] == "day":
            newest.days.setdefault(r["day"], []).append(r["name"])
        elif r["version"] == newest.version and r["kind"] == "mark":
            newest.marks[r["name"]] = r["upto"]
    return newest


def _commit(spark: SparkSession, table: str, made: Manifest) -> None:
    rows = [("day", name, None, day) for day, names in made.days.items() for name in names]
    rows += [("mark", run, upto, None) for run, upto in made.marks.items()]
    path = f"{location(spark, table)}/_manifest/version={made.version}"
    spark.createDataFrame(rows, _ROWS).coalesce(1).write.json(path)  # fails where the version is there


def _partitions(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """(load, day) of every partition, '' for the day in tables without."""
    found = []
    for (text,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        parts = dict(p.split("=", 1) for p in text.split("/"))
        found.append((parts[LOAD_COLUMN], parts.get(DATE_COLUMN, "")))
    return found


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in sorted(values))


def _seen(made: Manifest) -> str:
    """The partitions a reader of this version sees, as a condition on partition columns."""
    merged: dict[str, list[str]] = {}
    for day, names in made.days.items():
        for name in names:
            merged.setdefault(name, []).append(day)
    held = [
        f"({LOAD_COLUMN} = '{name}'" + ("" if days == [""] else f" AND CAST({DATE_COLUMN} AS STRING) IN ({_quoted(days)})") + ")"
        for name, days in merged.items()
    ]
    run, batch = (f"regexp_extract({LOAD_COLUMN}, '^(.+-)([0-9]+)$', {i})" for i in (1, 2))
    gone = [
        f"{LOAD_COLUMN} = '{r}'" if upto is None else f"({run} = '{r}' AND CAST({batch} AS BIGINT) <= {upto})"
        for r, upto in made.marks.items()
    ]
    is_merged = f"{LOAD_COLUMN} LIKE '{MERGED}%'"
    later = f"(NOT {is_merged} AND NOT coalesce({' OR '.join(gone) or 'false'}, false))"
    return " OR ".join([later, *held])


def current(spark: SparkSession, table: str, where: Column | str = "true") -> DataFrame:
    """The rows of the table (of those with `where`), each once, whatever is merged by now."""
    return spark.table(table).where(where).where(_seen(read_manifest(spark, table)))


def compact(
    spark: SparkSession, table: str, shards: int | None = None, cluster_by: list[str] | None = None
) -> str | None:
    """Merges all loads not merged yet; returns the name of the merged load, None if there was nothing to do.

    Runs the queries. If it stops half-way, readers see what they saw before, and the next try
    writes the same load over.
    """
    made = read_manifest(spark, table)
    open_ = [(load, day) for load, day in _partitions(spark, table) if not load.startswith(MERGED) and not made.covers(load)]
    if not open_:
        return None
    dated = DATE_COLUMN in spark.table(table).columns
    name, days = f"{MERGED}{made.version + 1}", sorted({day for _, day in open_})
    wanted = f"{LOAD_COLUMN} IN ({_quoted(list({load for load, _ in open_}))})"
    if dated:
        older = [f"({LOAD_COLUMN} = '{n}' AND CAST({DATE_COLUMN} AS STRING) = '{d}')" for d in days for n in made.days.get(d, [])]
        wanted = " OR ".join([wanted, *older])
    path = f"{location(spark, table)}/{LOAD_COLUMN}={name}"
    rows = laid_out(spark.table(table).where(wanted).drop(LOAD_COLUMN), shards, cluster_by)
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(DATE_COLUMN) if dated else writer).parquet(path)
    specs = [with_clause(name, day) for day in (days if dated else [""])]
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({s})" for s in specs))
    spark.catalog.refreshTable(table)

    new = Manifest(made.version + 1, dict(made.days), dict(made.marks))
    for day in days:
        new.days[day] = [name] if dated else [*made.days.get(day, []), name]
    for run, batch in {_run_of(load) for load, _ in open_}:
        new.marks[run] = None if batch is None else max(batch, new.marks.get(run) or 0)
    _commit(spark, table, new)
    return name


def clean(spark: SparkSession, table: str) -> int:
    """Removes the partitions and manifest versions that readers of the newest version do not see.

    Only for times at which no reader of an older version is left. Returns the number of partitions.
    """
    made, root = read_manifest(spark, table), location(spark, table)
    gone = [
        (load, day)
        for load, day in _partitions(spark, table)
        if (load not in made.days.get(day, []) if load.startswith(MERGED) else made.covers(load))
    ]
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    store = path_of(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({with_clause(*g)})" for g in gone))
    for load, day in gone:
        store.delete(path_of(f"{root}/{LOAD_COLUMN}={load}" + (f"/{DATE_COLUMN}={day}" if day else "")), True)
    for version in range(1, made.version):
        store.delete(path_of(f"{root}/_manifest/version={version}"), True)
    spark.catalog.refreshTable(table)
    return len(gone)
