"""The stored survey: ``<survey>_results``, partitioned by wave, and ``<survey>_metadata``."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavebook.operators.clean import add_wave, quoted
from wavebook.schemas import WAVE_COLUMN


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class TableMissing(LookupError):
    """A survey was asked for that has not been loaded."""


@dataclass(frozen=True)
class SurveyTables:
    """The two tables of one survey.

    ``location`` is a folder for the tables' files; without it the session's warehouse
    is used.
    """

    spark: SparkSession
    survey_id: str
    location: str | None = None

    def __post_init__(self) -> None:
        if not re.fullmatch(r"\w+", self.survey_id):
            raise ValueError(f"not usable in a table name: {self.survey_id!r}")

    @property
    def results_name(self) -> str:
        return f"{self.survey_id}_results"

    @property
    def metadata_name(self) -> str:
        return f"{self.survey_id}_metadata"

    def exists(self) -> bool:
        """A survey exists once its metadata does; that table is written last."""
        return self.spark.catalog.tableExists(self.metadata_name)

    def results(self) -> DataFrame:
        return self._table(self.results_name)

    def metadata(self) -> DataFrame:
        return self._table(self.metadata_name)

    def _table(self, name: str) -> DataFrame:
        if not self.spark.catalog.tableExists(name):
            raise TableMissing(f"table {name} does not exist; load a wave first")
        return self.spark.table(name)

    def _options(self, name: str) -> dict[str, str]:
        return {"path": f"{self.location}/{name}"} if self.location else {}

    def next_wave(self) -> int:
        """0 for a new survey, 1 for tables without rows, else the last wave plus one.

        The waves are taken from the catalog and only the last one is looked into, for a
        single row, however many files the survey has.
        """
        if not self.exists():
            return 0
        results = self.results()
        columns = self.spark.catalog.listColumns(self.results_name)
        if not any(column.isPartition for column in columns):
            return next_wave(results).first().next_wave
        listed = self.spark.sql(f"show partitions {self.results_name}").collect()
        waves = (row.partition.partition("=")[2] for row in listed)
        for wave in sorted((int(w) for w in waves if w.isdigit()), reverse=True):
            if not results.where(F.col(WAVE_COLUMN) == wave).isEmpty():
                return wave + 1
        return 1

    def write_backfill(self, results: DataFrame, metadata: DataFrame) -> None:
        """Create a survey from several waves at once, each in its ``load_counter``.

        One pass over the results writes all partitions; the metadata comes last.
        """
        if self.exists():
            raise ValueError(f"survey {self.survey_id} already exists")
        (
            results.write.format("parquet")
            .mode("errorifexists")
            .partitionBy(WAVE_COLUMN)
            .options(**self._options(self.results_name))
            .saveAsTable(self.results_name)
        )
        self._write_metadata(metadata)

    def _write_metadata(self, metadata: DataFrame) -> None:
        (
            metadata.write.format("parquet")
            .mode("errorifexists")
            .options(**self._options(self.metadata_name))
            .saveAsTable(self.metadata_name)
        )

    def write_wave(
        self, results: DataFrame, wave: int, metadata: DataFrame | None = None
    ) -> None:
        """Write one wave; the first one also creates both tables.

        A later wave replaces its own partition only, so a load that was cut short can
        be run again. The metadata is written once and never again.
        """
        if wave == 0:
            if metadata is None:
                raise ValueError("the first wave needs metadata")
            if self.exists():
                raise ValueError(f"survey {self.survey_id} already exists")
            self._create_results(add_wave(results, wave), results)
            self._write_metadata(metadata)
            return
        self._replace_partition(results, wave)

    # ------------------------------------------------------------ staged waves

    def stage_wave(self, results: DataFrame, wave: int) -> DataFrame:
        """Write a wave where its partition will be, and read it back; the table does not show it.

        What an interrupted load has left there is replaced.
        """
        if self.spark.catalog.tableExists(self.results_name):
            self._require_stored_columns(results)
        folder = self._wave_folder(wave)
        results.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(results.schema).parquet(folder)

    def accept_wave(self, staged: DataFrame, wave: int, metadata: DataFrame | None = None) -> None:
        """Make a staged wave part of the table; the first one also creates both tables."""
        if not self.spark.catalog.tableExists(self.results_name):
            columns = ", ".join(
                f"{quote(field.name)} {field.dataType.simpleString()}" for field in staged.schema.fields
            )
            self.spark.sql(
                f"create table {self.results_name} ({columns}, {WAVE_COLUMN} bigint) using parquet "
                f"partitioned by ({WAVE_COLUMN}) location '{self._results_folder()}'"
            )
        self.spark.sql(
            f"alter table {self.results_name} add if not exists partition ({WAVE_COLUMN} = {int(wave)})"
        )
        self.spark.catalog.refreshTable(self.results_name)
        if wave == 0:
            self._write_metadata(metadata)

    def discard_wave(self, wave: int) -> None:
        """Remove a staged wave that is not to be part of the table."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._wave_folder(wave))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _results_folder(self) -> str:
        if self.location:
            return f"{self.location}/{self.results_name}"
        if self.spark.catalog.tableExists(self.results_name):
            rows = self.spark.sql(f"describe formatted {self.results_name}").collect()
            return next(row.data_type for row in rows if row.col_name == "Location")
        return f"{self.spark.conf.get('spark.sql.warehouse.dir')}/{self.results_name}"

    def _wave_folder(self, wave: int) -> str:
        return f"{self._results_folder()}/{WAVE_COLUMN}={int(wave)}"

    def _require_stored_columns(self, results: DataFrame) -> list[str]:
        columns = [name for name in self.results().columns if name != WAVE_COLUMN]
        differing = sorted(set(columns) ^ set(results.columns))
        if differing:
            raise ValueError(f"columns differ from the stored ones: {', '.join(differing)}")
        return columns

    def _create_results(self, stamped: DataFrame, results: DataFrame) -> None:
        """Create the results table, or fill the one an interrupted first load left."""
        if self.spark.catalog.tableExists(self.results_name):
            self._replace_partition(results, 0)
            return
        (
            stamped.write.format("parquet")
            .mode("errorifexists")
            .partitionBy(WAVE_COLUMN)
            .options(**self._options(self.results_name))
            .saveAsTable(self.results_name)
        )

    def _replace_partition(self, results: DataFrame, wave: int) -> None:
        """Overwrite exactly one wave; naming the partition leaves all others alone."""
        columns = self._require_stored_columns(results)
        self.spark.sql(
            f"insert overwrite table {self.results_name} partition ({WAVE_COLUMN} = {int(wave)}) "
            "select * from {rows}",
            rows=results.select([quoted(name) for name in columns]),
        )


def max_wave(results: DataFrame) -> DataFrame:
    return results.agg(F.max(WAVE_COLUMN).cast("bigint").alias("max_counter"))


def next_wave(results: DataFrame) -> DataFrame:
    """The wave to load next, from the waves present; reads the partition column only."""
    return results.agg(
        F.coalesce(F.max(WAVE_COLUMN) + 1, F.lit(1)).cast("bigint").alias("next_wave")
    )


def read_table(spark: SparkSession, sql: str, **args) -> DataFrame:
    """Any SQL over the stored tables, with values passed apart from the text."""
    return spark.sql(sql, args=args or None)
