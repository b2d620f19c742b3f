"""The curated table and its partitions in Spark's catalog, through SQL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

from sievelake.batch import Batch, Lake
from sievelake.profiles import TRIPS, Profile
from sievelake.sinks.files import qualified


def create_table(spark: SparkSession, table: str, location: str, profile: Profile = TRIPS) -> None:
    """External table over a curated root; partitions show once they are registered."""
    spark.sql(
        f"CREATE EXTERNAL TABLE IF NOT EXISTS {table} ({profile.curated_ddl}, year INT, month INT) "
        f"USING parquet PARTITIONED BY (year, month) LOCATION '{_quoted(location)}'"
    )


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _spec(batch: Batch) -> str:
    return f"PARTITION (year={int(batch.year)}, month={int(batch.month)})"


def partition_values(batch: Batch) -> list[str]:
    return [str(batch.year), batch.month_string]


def expected_location(spark: SparkSession, lake: Lake, batch: Batch) -> str:
    return qualified(spark, lake.curated(batch))


#: One lake for all batches, or the lake, at its version, of each batch.
Lakes = Lake | Mapping[Batch, Lake]


def _wanted(spark: SparkSession, lakes: Lakes, batches: Iterable[Batch]) -> dict[Batch, str]:
    return {b: expected_location(spark, lakes if isinstance(lakes, Lake) else lakes[b], b) for b in batches}


def listed_partitions(spark: SparkSession, table: str) -> dict[tuple[int, int], list[tuple[tuple[str, str], str]]]:
    """Every partition the catalog holds, by (year, month): its values as spelled there, and its location.

    One listing for all. Values are compared as numbers: `MSCK REPAIR TABLE` spells months as the folders do, with
    a leading zero, and then one month may be registered twice.
    """
    state = spark._jsparkSession.sessionState()
    name = state.sqlParser().parseTableIdentifier(table)
    held = state.catalog().listPartitions(name, spark._jvm.scala.Option.empty())
    found: dict[tuple[int, int], list[tuple[tuple[str, str], str]]] = {}
    for i in range(held.size()):
        partition = held.apply(i)
        values = (partition.spec().apply("year"), partition.spec().apply("month"))
        place = qualified(spark, _path_of(spark, partition.location()))
        found.setdefault((int(values[0]), int(values[1])), []).append((values, place))
    return found


def _path_of(spark: SparkSession, uri) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(uri).toString()


def registered_location(spark: SparkSession, table: str, batch: Batch) -> str | None:
    """Where the catalog says the partition lies; None when it is not registered."""
    held = listed_partitions(spark, table).get((batch.year, batch.month))
    return held[0][1] if held else None


def partition_exists(spark: SparkSession, table: str, batch: Batch) -> bool:
    return registered_location(spark, table, batch) is not None


def partition_is_correct(spark: SparkSession, table: str, lake: Lake, batch: Batch) -> bool:
    """Registered once, at its place."""
    return batch in correct_partitions(spark, table, lake, [batch])


def correct_partitions(spark: SparkSession, table: str, lake: Lakes, batches: Iterable[Batch]) -> set[Batch]:
    held = listed_partitions(spark, table)
    return {
        batch
        for batch, place in _wanted(spark, lake, batches).items()
        if [found for _, found in held.get((batch.year, batch.month), [])] == [place]
    }


def register_partition(spark: SparkSession, table: str, lake: Lake, batch: Batch) -> bool:
    """Register or repair one partition. False when it was right already."""
    return register_partitions(spark, table, lake, [batch])[batch]


def register_partitions(
    spark: SparkSession, table: str, lake: Lakes, batches: Iterable[Batch]
) -> dict[Batch, bool]:
    """Register or repair partitions.

    A month that is registered once, at its place, is right however it is spelled. One that is registered once elsewhere
    is pointed to its place by a single statement, so that readers find the one place or the other. All others lose
    what is registered for them and are added by a single statement.
    """
    batches = list(batches)
    held, wanted = listed_partitions(spark, table), _wanted(spark, lake, batches)
    changed, surplus, missing, moved = {}, [], [], []
    for batch in batches:
        entries = held.get((batch.year, batch.month), [])
        changed[batch] = [place for _, place in entries] != [wanted[batch]]
        if changed[batch]:
            if [values for values, _ in entries] == [(str(batch.year), str(batch.month))]:
                moved.append(batch)
            else:
                surplus += [values for values, _ in entries]
                missing.append(batch)
    for batch in moved:
        spark.sql(f"ALTER TABLE {table} {_spec(batch)} SET LOCATION '{_quoted(wanted[batch])}'")
    if surplus:
        drop_as_spelled(spark, table, surplus)
    if missing:
        specs = " ".join(f"{_spec(batch)} LOCATION '{_quoted(wanted[batch])}'" for batch in missing)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(table)
    return changed


def drop_as_spelled(spark: SparkSession, table: str, values: list[tuple[str, str]]) -> None:
    """Drop partitions by the text of their values, which Spark would else read as numbers."""
    setting = "spark.sql.legacy.skipTypeValidationOnAlterPartition"
    usual = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        specs = ", ".join(f"PARTITION (year='{year}', month='{month}')" for year, month in values)
        spark.sql(f"ALTER TABLE {table} DROP {specs}")
    finally:
        spark.conf.set(setting, usual)


def partition_status(created: bool | None) -> str:
    """DISABLED without a catalog, else CREATED or EXISTS."""
    if created is None:
        return "DISABLED"
    return "CREATED" if created else "EXISTS"
