"""Where the tables of the bronze, silver and gold layers live.

``CatalogLayers`` keeps them as catalog tables (``gold.FactSales`` can be
queried with SQL), ``PathLayers`` as Parquet folders under one root.

A load never touches what readers see. Every table is written to a folder of its own, and a layer's log says which
folder is a table's present one. ``commit`` appends one file to the log, by a job of one task, and so puts any number
of staged tables in place at once: a load that dies before leaves all old tables as they
were, one that dies after is complete. The folder before the present one stays for whoever still reads it, older ones go.
In a catalog the tables are then pointed at their folders; if that is cut off, ``recover`` (or the next
``create``) does it from the log. One process loads a layer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from threading import RLock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orestrata.fixed_values import LAYERS
from orestrata.sources.files import remove, remove_if_empty

_LOG = "_log"
_LOG_COLUMNS = "version bigint, table_name string, folder string, schema string, parted array<string>"


@dataclass(frozen=True)
class Staged:
    """A table's rows in a folder which nobody reads yet."""

    layer: str
    table: str
    folder: str
    schema: T.StructType
    parted: tuple[str, ...] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.folder)


class PathLayers:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: dict[str, dict[str, Staged]] = {}
        self._lock = RLock()

    def layer_root(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def create(self) -> list[str]:
        """Folders come into being with their first table."""
        return [self.layer_root(layer) for layer in LAYERS]

    # --- writing ---------------------------------------------------------------

    def new_folder(self, layer: str, table: str) -> str:
        return f"{self.layer_root(layer)}/{table}/load-{uuid.uuid4().hex}"

    def stage(
        self, df: DataFrame, layer: str, table: str, partition_by: Iterable[str] = ()
    ) -> Staged:
        """Write a table where nobody reads it."""
        parted = tuple(partition_by)
        folder = self.new_folder(layer, table)
        df.write.partitionBy(*parted).parquet(folder)
        columns = [f for f in df.schema.fields if f.name not in parted] + [df.schema[c] for c in parted]
        return Staged(layer, table, folder, T.StructType(columns), parted)

    def commit(self, staged: Sequence[Staged]) -> dict[str, DataFrame]:
        """Put staged tables of one layer in the place of the present ones, all at once."""
        layer = staged[0].layer
        with self._lock:
            past = self._logged(layer)
            version = 1 + max((row.version for row in past), default=0)
            rows = [
                (version, each.table, each.folder, each.schema.json(), list(each.parted)) for each in staged
            ]
            self.spark.createDataFrame(rows, _LOG_COLUMNS).coalesce(1).write.mode("append").parquet(
                f"{self.layer_root(layer)}/{_LOG}"
            )
            self._known.pop(layer, None)
            self._point(staged)
            self._drop_older({each.table for each in staged}, past)
        return {each.table: self.read(layer, each.table) for each in staged}

    def discard(self, staged: Iterable[Staged]) -> None:
        """Remove what was staged but is not wanted."""
        for each in staged:
            self.discard_folder(each.layer, each.table, each.folder)

    def discard_folder(self, layer: str, table: str, folder: str) -> None:
        remove(self.spark, folder)
        for parent in (f"{self.layer_root(layer)}/{table}", self.layer_root(layer)):
            remove_if_empty(self.spark, parent)

    def write(
        self, df: DataFrame, layer: str, table: str, partition_by: Iterable[str] = ()
    ) -> DataFrame:
        """Replace one table."""
        return self.commit([self.stage(df, layer, table, partition_by)])[table]

    def _point(self, staged: Iterable[Staged]) -> None:
        """The log is all there is to it."""

    def _drop_older(self, tables: set[str], past: list) -> None:
        folders: dict[str, list[str]] = {}
        for row in sorted(past, key=lambda row: row.version):
            folders.setdefault(row.table_name, []).append(row.folder)
        for table in tables & folders.keys():
            for folder in folders[table][:-1]:
                remove(self.spark, folder)

    # --- reading ---------------------------------------------------------------

    def _logged(self, layer: str) -> list:
        try:
            return self.spark.read.schema(_LOG_COLUMNS).parquet(f"{self.layer_root(layer)}/{_LOG}").collect()
        except AnalysisException:  # nothing was ever committed
            return []

    def present(self, layer: str) -> dict[str, Staged]:
        """The tables of a layer as this object first saw them, or last replaced them."""
        with self._lock:
            if layer not in self._known:
                self._known[layer] = {
                    row.table_name: Staged(
                        layer,
                        row.table_name,
                        row.folder,
                        T.StructType.fromJson(json.loads(row.schema)),
                        tuple(row.parted),
                    )
                    for row in sorted(self._logged(layer), key=lambda row: row.version)
                }
            return self._known[layer]

    def refresh(self) -> None:
        """See what others have committed since."""
        with self._lock:
            self._known.clear()

    def path(self, layer: str, table: str) -> str:
        """The folder of a table's present rows."""
        return self.present(layer)[table].folder

    def read(self, layer: str, table: str) -> DataFrame:
        found = self.present(layer).get(table)
        if found is None:
            raise LookupError(f"there is no table {table} in the layer {layer}")
        return found.read(self.spark)


class CatalogLayers(PathLayers):
    def __init__(self, spark: SparkSession, location: str | None = None, prefix: str = ""):
        super().__init__(spark, location or "")
        self.location = location
        self.prefix = prefix

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def layer_root(self, layer: str) -> str:
        if self.location:
            return f"{self.location}/{self.database(layer)}"
        return self.spark.catalog.getDatabase(self.database(layer)).locationUri.rstrip("/")

    def create(self) -> list[str]:
        """Create the databases which do not exist yet, and finish what a load left undone."""
        for layer in LAYERS:
            statement = f"CREATE DATABASE IF NOT EXISTS `{self.database(layer)}`"
            if self.location:
                statement += f" LOCATION '{self.layer_root(layer)}'"
            self.spark.sql(statement)
        self.recover()
        return [self.database(layer) for layer in LAYERS]

    def recover(self) -> list[str]:
        """Point every table at the folder the log names; returns those which were not."""
        moved = []
        for layer in LAYERS:
            for each in self.present(layer).values():
                name = self._name(layer, each.table)
                if not self.spark.catalog.tableExists(name) or self._folder(name) != _plain(each.folder):
                    self._point([each])
                    moved.append(f"{self.database(layer)}.{each.table}")
        return moved

    def _name(self, layer: str, table: str) -> str:
        return f"`{self.database(layer)}`.`{table}`"

    def _folder(self, name: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
        return _plain(described.data_type)

    def _point(self, staged: Iterable[Staged]) -> None:
        """One statement per table, unless its columns have changed."""
        for each in staged:
            name = self._name(each.layer, each.table)
            if self.spark.catalog.tableExists(name):
                same = self.spark.table(name).schema.simpleString() == each.schema.simpleString()
                if same and not each.parted:
                    self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{each.folder}'")
                    self.spark.catalog.refreshTable(name)
                    continue
                self.spark.sql(f"DROP TABLE {name}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in each.schema.fields)
            by = ", ".join(f"`{column}`" for column in each.parted)
            parted = f" PARTITIONED BY ({by})" if by else ""
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parted} LOCATION '{each.folder}'")
            if by:
                self.spark.sql(f"MSCK REPAIR TABLE {name}")

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self._name(layer, table))


def _plain(folder: str) -> str:
    """A folder without the scheme of local files, which the catalog adds."""
    return folder.removeprefix("file:").rstrip("/").replace("///", "/")


Layers = CatalogLayers | PathLayers
