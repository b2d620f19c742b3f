from sievelake.batch import Batch, Lake, under
from sievelake.functions import addresses

AUGUST = Batch("yellow_taxi", "yellow_tripdata", 2025, 8)


def test_names_and_paths():
    assert AUGUST.month_string == "08"
    assert AUGUST.period == "2025-08"
    assert AUGUST.batch_id == "yellow_taxi_2025_08"
    assert AUGUST.source_file == "yellow_tripdata_2025-08.parquet"
    assert AUGUST.schema_version == "1.0"
    assert AUGUST.input_path == "data/raw/yellow_taxi/yellow_tripdata_2025-08.parquet"
    assert AUGUST.curated_output == "data/curated/yellow_taxi/2025-08"
    assert AUGUST.quarantine_output == "data/quarantine/yellow_taxi/2025-08"
    assert AUGUST.metrics_output == "data/metrics/yellow_taxi/2025-08"


def test_published_layout():
    lake = Lake("s3a://bucket/")
    assert lake.curated_prefix(AUGUST) == "curated/yellow_taxi/year=2025/month=08"
    assert lake.curated(AUGUST) == "s3a://bucket/curated/yellow_taxi/year=2025/month=08"
    assert lake.quarantine(AUGUST) == "s3a://bucket/quarantine/yellow_taxi/2025-08"
    assert lake.metrics(AUGUST) == "s3a://bucket/metrics/quality/yellow_taxi/2025-08"


def test_roots():
    assert under("", AUGUST.input_path) == AUGUST.input_path
    assert under("hdfs://name/work/", AUGUST.input_path) == f"hdfs://name/work/{AUGUST.input_path}"


def test_columns_agree_with_batches(spark):
    batches = [Batch("d", "p", year, month) for year in (1999, 2025) for month in (1, 9, 10, 12)]
    df = spark.createDataFrame([(b.year, b.month) for b in batches], "year INT, month INT")
    found = df.select(
        addresses.month_string(df.month), addresses.period(df.year, df.month),
        addresses.batch_id("d", df.year, df.month), addresses.source_file("p", df.year, df.month),
        addresses.curated_prefix("d", df.year, df.month),
    ).collect()
    assert [tuple(row) for row in found] == [
        (b.month_string, b.period, b.batch_id, b.source_file, Lake("").curated_prefix(b)) for b in batches
    ]
