"""Tables of the layers: naming, existence, reading, writing with row counts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from crmflow.operators.rows import upsert as upsert_rows
from crmflow.operators.skew import null_safe_match
from crmflow.storage import materialize, scratch_path

# The layers and their default databases.
LAYERS = {"bronze": "bronze", "silver": "silver", "gold": "gold"}


def add_lineage(
    df: DataFrame,
    source: str | Column,
    ingested_at: datetime | Column | None = None,
    ingested_on: date | Column | None = None,
) -> DataFrame:
    """Adds ``_source_file``, ``_ingestion_timestamp`` and ``_ingestion_date`` (default: now)."""
    return df.withColumns(
        {
            "_source_file": F.lit(source) if isinstance(source, str) else source,
            "_ingestion_timestamp": F.current_timestamp() if ingested_at is None else F.lit(ingested_at),
            "_ingestion_date": F.current_date() if ingested_on is None else F.lit(ingested_on),
        }
    )


#: Properties of a table's view: the version it shows, and older ones of which it shows a part.
_VERSION = "crmflow.version"
_OLDER = "crmflow.older"
#: Versions that a table may be spread over before an upsert writes it as one again.
MAX_OLDER = 8


class LayerTables:
    """Catalog tables grouped by layer, stored as Parquet.

    ``databases`` maps a layer to its database, which may carry a catalog
    (``catalog.silver``). ``location`` puts the databases created here below a folder.

    A table's name is a view of one of its versions. Overwriting writes a new version beside
    the present one and then turns the view to it, in one call to the catalog. Until then, and
    for ever if the write fails, readers see the old rows; a table may therefore be built from
    its own content. ``keep_versions`` older versions stay, for queries that still read them.
    An upsert writes only the partitions it touches: the name then shows these from the new
    version and all others from the versions before.
    """

    def __init__(
        self,
        spark: SparkSession,
        databases: dict[str, str] | None = None,
        location: str | None = None,
        keep_versions: int = 1,
    ):
        self.spark = spark
        self.databases = dict(databases or LAYERS)
        self.location = location
        self.keep_versions = keep_versions

    def full_name(self, table: str, layer: str) -> str:
        if layer not in self.databases:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.databases[layer]}.{table}"

    def create(self, layer: str) -> None:
        database = self.full_name("", layer).rstrip(".")
        where = f" LOCATION '{self.location}/{database}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")

    def exists(self, table: str, layer: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(table, layer))

    def read(self, table: str, layer: str) -> DataFrame:
        return self.spark.table(self.full_name(table, layer))

    def read_if_exists(self, table: str, layer: str) -> DataFrame | None:
        return self.read(table, layer) if self.exists(table, layer) else None

    def version(self, table: str, layer: str) -> str | None:
        """The table that the name shows now, without its database; None if there is none."""
        return self._property(table, layer, _VERSION)

    def shown(self, table: str, layer: str) -> list[str]:
        """All versions of which the name shows rows, the newest first."""
        newest = self.version(table, layer)
        older = self._property(table, layer, _OLDER) if newest else None
        return [newest, *(older.split(",") if older else [])] if newest else []

    def _property(self, table: str, layer: str, key: str) -> str | None:
        if not self.exists(table, layer):
            return None
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.full_name(table, layer)}")
        found = shown.where(F.col("key") == key).collect()
        return found[0]["value"] if found else None

    def versions(self, table: str, layer: str) -> list[str]:
        """All stored versions of a table, oldest first."""
        database = self.full_name("", layer).rstrip(".")
        found = self.spark.sql(f"SHOW TABLES IN {database} LIKE '{table.lower()}__v*'").collect()
        return sorted(row["tableName"] for row in found)

    def write(
        self,
        df: DataFrame,
        table: str,
        layer: str,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
        observed: Sequence[Column] = (),
        hidden: Sequence[str] = (),
        one_partition: bool = False,
    ) -> int | dict[str, int]:
        """Overwrite or append, and return the rows written, counted during the write.

        An append may bring new columns (older rows read as NULL) or lack some; a
        changed type is an error. With ``observed`` aggregates, their values come back
        together with the count (``rows``); they may use ``hidden`` columns, which are not stored.
        ``one_partition`` says that all rows have the same partition values: they are written
        where they are read, without a shuffle.
        """
        if mode not in ("overwrite", "append"):
            raise ValueError(f"write mode must be overwrite or append, not {mode!r}")
        self._adopt(table, layer)
        shown = self.shown(table, layer)
        present = shown[0] if shown else None
        if mode == "append" and present is not None:
            target = self.full_name(present, layer)
            df = self._evolve(df, table, layer, target, hidden)
        else:
            target = self._next_version(table, layer)
        is_new = mode == "overwrite" or present is None
        found = self._store(df, target, partition_by, observed, hidden, is_new, one_partition)
        if is_new:
            self._show(table, layer, target)
            self._drop_old(table, layer, shown)
        return found if observed else found["rows"]

    def _next_version(self, table: str, layer: str) -> str:
        # Names in order of their time, so that the oldest can be told.
        last = self.versions(table, layer)[-1:]
        number = int(last[0].rsplit("__v", 1)[1].split("_")[0]) + 1 if last else 1
        return self.full_name(f"{table.lower()}__v{number:08d}_{uuid.uuid4().hex[:8]}", layer)

    def _store(
        self,
        df: DataFrame,
        target: str,
        partition_by: Sequence[str],
        observed: Sequence[Column],
        hidden: Sequence[str],
        is_new: bool,
        one_partition: bool = False,
    ) -> dict[str, int]:
        if partition_by and not one_partition:
            # Files per partition value: adaptive execution splits a large one and merges small ones.
            df = df.hint("rebalance", *partition_by)
        # Counted in the writing stage itself, where a repeated task counts once.
        observation = Observation()
        counted = df.observe(observation, F.count(F.lit(1)).alias("rows"), *observed).drop(*hidden)
        try:
            counted.write.format("parquet").mode("append").partitionBy(*partition_by).saveAsTable(target)
        except Exception:
            if is_new:
                self.spark.sql(f"DROP TABLE IF EXISTS {target}")
            raise
        return observation.get

    def upsert(
        self,
        changes: DataFrame,
        table: str,
        layer: str,
        keys: Sequence[str],
        version: str,
        partition_by: Sequence[str],
        deleted: str | None = None,
    ) -> int:
        """Latest row per key of the table and the changes; only partitions with such keys are written.

        On equal versions the change wins. With ``deleted``, a boolean column of the changes, a
        winning change that is marked removes its row; the mark itself is not kept, so an older
        change that arrives later counts again. NULL keys equal each other. A row whose
        partition changes leaves the old one. Returns the rows written. Files of all other
        partitions stay as they are, and readers see the old table until all is written.
        """
        self._adopt(table, layer)
        shown = self.shown(table, layer)
        removed = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
        if not shown:
            latest = upsert_rows(changes.limit(0), changes, keys, version)
            return self.write(latest.where(~removed).drop(*([deleted] if deleted else [])), table, layer, partition_by=partition_by)
        current = self.read(table, layer)
        columns = current.schema.fields
        changed = materialize(
            changes.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns], removed.alias("_deleted")),
            "changes",
        )
        wanted = changed.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
        match = null_safe_match(current, wanted, [(k, f"_key_{k}") for k in keys])
        touched = (
            current.join(wanted, match, "left_semi").select(*partition_by)
            .unionAll(changed.where("NOT _deleted").select(*partition_by))
            .distinct()
            .collect()  # at most one row per partition
        )
        if not touched:
            return 0
        inside = self._one_of(touched, {f.name: f.dataType.simpleString() for f in columns}, partition_by)
        before = current.where(inside).withColumn("_deleted", F.lit(False))
        rows = upsert_rows(before, changed, keys, version).where("NOT _deleted").drop("_deleted")
        if len(shown) > MAX_OLDER:
            everything = current.where(f"NOT ({inside})").unionByName(rows)
            self.write(everything, table, layer, partition_by=partition_by)
            return rows.count()
        target = self._next_version(table, layer)
        found = self._store(rows, target, partition_by, (), (), True)
        self._show(table, layer, target, inside, shown)
        self._drop_old(table, layer, shown)
        return found["rows"]

    @staticmethod
    def _one_of(touched: Sequence[Row], types: dict[str, str], partition_by: Sequence[str]) -> str:
        """SQL that holds for the rows of the given partitions."""

        def literal(value, kind: str) -> str:
            if value is None:
                return f"CAST(NULL AS {kind})"
            text = str(value).replace("\\", "\\\\").replace("'", "\\'")
            return f"CAST('{text}' AS {kind})"

        each = [
            " AND ".join(f"`{name}` <=> {literal(row[name], types[name])}" for name in partition_by) for row in touched
        ]
        return " OR ".join(f"({one})" for one in sorted(each))

    def _show(
        self, table: str, layer: str, target: str, replaced: str | None = None, older: Sequence[str] = ()
    ) -> None:
        """Turn the name to a version; with ``replaced``, keep showing all that this does not hold for."""
        name = self.full_name(table, layer)
        body = f"SELECT * FROM {target}"
        if replaced is not None:
            described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
            present = described.where("col_name = 'View Text'").first()["data_type"]
            columns = ", ".join(f"`{c}`" for c in self.read(table, layer).columns)
            body = f"SELECT {columns} FROM ({present}) WHERE NOT ({replaced}) UNION ALL SELECT {columns} FROM {target}"
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_VERSION}' = '{target.rsplit('.', 1)[1]}', "
            f"'{_OLDER}' = '{','.join(older)}') AS {body}"
        )

    def _adopt(self, table: str, layer: str) -> None:
        """Make a plain table of that name its own first version."""
        if self.exists(table, layer) and self.version(table, layer) is None:
            first = self.full_name(f"{table.lower()}__v{0:08d}_adopted", layer)
            self.spark.sql(f"ALTER TABLE {self.full_name(table, layer)} RENAME TO {first}")
            self._show(table, layer, first)

    def _drop_old(self, table: str, layer: str, before: Sequence[str]) -> None:
        """Drop versions that neither the name nor, with ``keep_versions``, the state before shows."""
        shown = self.shown(table, layer)
        kept = {*shown, *(before if self.keep_versions else ())}
        older = [v for v in self.versions(table, layer) if v < shown[0] and v not in kept]
        for version in older[: max(0, len(older) - max(0, self.keep_versions - 1))]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.full_name(version, layer)}")

    def drop(self, table: str, layer: str) -> None:
        """Remove a table with all its versions."""
        self.spark.sql(f"DROP VIEW IF EXISTS {self.full_name(table, layer)}")
        for version in self.versions(table, layer):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.full_name(version, layer)}")

    def _evolve(self, df: DataFrame, table: str, layer: str, target: str, hidden: Sequence[str]) -> DataFrame:
        present = {f.name: f.dataType for f in self.spark.table(target).schema.fields}
        new = []
        for field in df.drop(*hidden).schema.fields:
            if field.name not in present:
                new.append(f"`{field.name}` {field.dataType.simpleString()}")
            elif field.dataType != present[field.name]:
                raise TypeError(
                    f"{target}.{field.name} is {present[field.name].simpleString()}, "
                    f"cannot append {field.dataType.simpleString()}"
                )
        if new and len(self.shown(table, layer)) > 1:
            raise TypeError(f"{target} shares its rows with older versions: overwrite it before adding columns")
        if new:
            self.spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({', '.join(new)})")
            self._show(table, layer, target)
        columns = self.spark.table(target).schema.fields
        return df.select(
            *[
                F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in columns
            ],
            *hidden,
        )


def write_output(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Write files, replacing or extending what is there, optionally by partition value."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.format(format).mode(mode).options(**options).partitionBy(*partition_by).save(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose files differ in columns: a column a file lacks is NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows for.

    The rows are stored first, since they usually come from the same folder.
    """
    stored = materialize(df, "replace")
    (
        stored.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def export_csv(df: DataFrame, label: str) -> str:
    """Write CSV with a header into a fresh folder of the shared folder and return its path."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("header", True).csv(path)
    return path
