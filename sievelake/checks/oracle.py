"""SQL for the registered queries, as DuckDB runs it on the same tables."""

from __future__ import annotations

from sievelake.checks.adapter import DATASET, PREFIX, trip_expressions
from sievelake.checks.queries import EXPECTED_BATCHES, KEYS

_T = "SELECT {} FROM lineitem".format(
    ", ".join(
        f'{text} AS "{name}"'
        for name, text in trip_expressions(lambda seconds: f"l_shipdate + to_seconds({seconds})")
    )
)
# Source and table names of the columns, and the rules of each severity in their order.
_RENAMES = (
    "VendorID vendor_id, tpep_pickup_datetime pickup_datetime, tpep_dropoff_datetime dropoff_datetime, "
    "passenger_count passenger_count, trip_distance trip_distance, RatecodeID rate_code_id, "
    "store_and_fwd_flag store_and_forward_flag, PULocationID pickup_location_id, DOLocationID dropoff_location_id, "
    "payment_type payment_type, fare_amount fare_amount, extra extra, mta_tax mta_tax, tip_amount tip_amount, "
    "tolls_amount tolls_amount, improvement_surcharge improvement_surcharge, total_amount total_amount, "
    "congestion_surcharge congestion_surcharge, Airport_fee airport_fee, cbd_congestion_fee cbd_congestion_fee"
)
_QUARANTINE = (
    "MISSING_PICKUP_DATETIME MISSING_DROPOFF_DATETIME INVALID_TIME_RANGE NEGATIVE_TRIP_DISTANCE "
    "MISSING_PICKUP_LOCATION MISSING_DROPOFF_LOCATION"
)
_WARNING = "ZERO_TRIP_DISTANCE NEGATIVE_FARE_AMOUNT NEGATIVE_TOTAL_AMOUNT TRIP_OVER_24_HOURS"
_RENAMED = ", ".join('"{}" AS {}'.format(*pair.split()) for pair in _RENAMES.split(", "))

# The rules in DuckDB's dialect, written out on their own.
_FIRES = {
    "MISSING_PICKUP_DATETIME": "pickup_datetime IS NULL",
    "MISSING_DROPOFF_DATETIME": "dropoff_datetime IS NULL",
    "INVALID_TIME_RANGE": "dropoff_datetime < pickup_datetime",
    "NEGATIVE_TRIP_DISTANCE": "trip_distance < 0",
    "MISSING_PICKUP_LOCATION": "pickup_location_id IS NULL",
    "MISSING_DROPOFF_LOCATION": "dropoff_location_id IS NULL",
    "ZERO_TRIP_DISTANCE": "trip_distance = 0",
    "NEGATIVE_FARE_AMOUNT": "fare_amount < 0",
    "NEGATIVE_TOTAL_AMOUNT": "total_amount < 0",
    "TRIP_OVER_24_HOURS": "epoch_ms(dropoff_datetime)//1000 - epoch_ms(pickup_datetime)//1000 > 86400",
}


def _codes(codes: str) -> str:
    cases = [f"CASE WHEN {_FIRES[code]} THEN '{code}' END" for code in codes.split()]
    return f"concat_ws('|', {', '.join(cases)})"


_WITH = f"""
WITH t AS ({_T}),
n AS (SELECT {_RENAMED}, year, month FROM t),
r AS (SELECT *, {_codes(_QUARANTINE)} AS quarantine_reasons, {_codes(_WARNING)} AS warning_reasons FROM n),
c AS (SELECT *,
  CASE WHEN quarantine_reasons <> '' THEN 'QUARANTINE'
       WHEN warning_reasons <> '' THEN 'WARNING' ELSE 'VALID' END AS validation_status,
  '{DATASET}_' || CAST(year AS VARCHAR) || '_' || lpad(CAST(month AS VARCHAR), 2, '0') AS batch_id,
  CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period FROM r)
"""
_KEYS = ", ".join(KEYS)

_COUNTS = """CAST(COUNT(*) AS BIGINT) AS total_records,
  CAST(SUM(CASE WHEN validation_status = 'VALID' THEN 1 ELSE 0 END) AS BIGINT) AS valid_records,
  CAST(SUM(CASE WHEN validation_status = 'WARNING' THEN 1 ELSE 0 END) AS BIGINT) AS warning_records,
  CAST(SUM(CASE WHEN validation_status = 'QUARANTINE' THEN 1 ELSE 0 END) AS BIGINT) AS quarantined_records"""
_RATES = """ROUND((valid_records + warning_records) / total_records * 100, 4) AS quality_pass_rate,
  ROUND(quarantined_records / total_records * 100, 4) AS quarantine_rate"""
_METRICS = f"{_WITH} SELECT *, {_RATES} FROM (SELECT {_COUNTS} FROM c)"

_BY_MONTH = f"m AS (SELECT year, month, {_COUNTS} FROM c GROUP BY year, month)"

_RUNS = f"""{_WITH},
g AS (SELECT year, month, batch_id, rate_code_id AS attempt, {_COUNTS}
      FROM c GROUP BY year, month, batch_id, rate_code_id),
k AS (SELECT *, (year * 12 + month + attempt) % 7 AS kind FROM g),
runs AS (SELECT
  'run_' || year || '_' || month || '_' || attempt AS run_id, batch_id, attempt,
  sha256(batch_id || ':' || CAST(attempt % 3 AS VARCHAR)) AS source_checksum,
  CASE WHEN kind IN (0, 4) THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  CASE WHEN kind IN (0, 1, 3) THEN 'SUCCESS'
       WHEN kind IN (2, 4) THEN 'SKIPPED_ALREADY_PROCESSED' END AS processing_status,
  CASE WHEN kind IN (0, 4) THEN 'MATCH' WHEN kind = 1 THEN 'MISMATCH'
       WHEN kind = 2 THEN 'FAILED' ELSE 'NOT_RUN' END AS reconciliation_status,
  CASE WHEN kind IN (1, 4) THEN 'BACKFILLED' WHEN kind <> 6 THEN 'EXISTS' END AS publish_status,
  CASE WHEN attempt % 2 = 0 THEN 'CREATED' ELSE 'EXISTS' END AS partition_status,
  CASE WHEN kind <> 4 THEN total_records END AS rows_read,
  CASE WHEN kind <> 4 THEN valid_records END AS valid_records,
  CASE WHEN kind <> 4 THEN warning_records END AS warning_records,
  CASE WHEN kind <> 4 THEN quarantined_records END AS quarantined_records FROM k),
done AS (SELECT *, status = 'SUCCESS' OR
  COALESCE(processing_status IN ('SUCCESS', 'SKIPPED_ALREADY_PROCESSED')
           AND reconciliation_status IN ('MISMATCH', 'FAILED'), FALSE) AS completed FROM runs),
b AS (SELECT DISTINCT batch_id, sha256(batch_id || ':2') AS source_checksum FROM c)
"""
_DONE = "SELECT 1 FROM done WHERE completed AND done.batch_id = b.batch_id AND done.source_checksum = b.source_checksum"


def _history(damaged: str = "TRUE") -> str:
    return f"""{_WITH},
h AS (SELECT period AS month, total_records + CASE WHEN {damaged} AND month = 5 THEN 1 ELSE 0 END AS source_records,
  valid_records + CASE WHEN {damaged} AND month = 6 THEN 1 ELSE 0 END AS valid_records, warning_records,
  CASE WHEN {damaged} AND month = 7 THEN -1 ELSE quarantined_records END AS quarantined_records,
  good AS curated_records, CASE WHEN {damaged} AND month = 3 THEN 0 ELSE good END AS athena_records
  FROM (SELECT year, month, period, {_COUNTS}, COUNT(*) FILTER (WHERE quarantine_reasons = '') AS good
        FROM c GROUP BY year, month, period) WHERE NOT ({damaged} AND year = 1996 AND month = 8))
"""


def _invariants(damaged: str) -> str:
    return f"""SELECT * FROM ({_history(damaged)}
        SELECT {damaged} AS damaged, 'source_is_curated_plus_quarantined' AS check_name,
          BOOL_AND(source_records = curated_records + quarantined_records) AS passed FROM h
        UNION ALL SELECT {damaged}, 'curated_is_valid_plus_warning',
          BOOL_AND(curated_records = valid_records + warning_records) FROM h
        UNION ALL SELECT {damaged}, 'published_is_curated', BOOL_AND(athena_records = curated_records) FROM h
        UNION ALL SELECT {damaged}, 'counts_not_negative', BOOL_AND(source_records >= 0 AND curated_records >= 0
          AND valid_records >= 0 AND warning_records >= 0 AND quarantined_records >= 0
          AND athena_records >= 0) FROM h
        UNION ALL SELECT {damaged}, 'expected_batch_count', COUNT(*) = {EXPECTED_BATCHES} FROM h)"""


def _series(processing: str, published: str, partition: str, replaced: str = "FALSE") -> str:
    """`replaced` names the month of which only the rows of vendor 1 are left, processed anew."""
    new = "CASE WHEN replaced THEN '{}' ELSE '{}' END"
    return f"""{_WITH}, s AS (SELECT batch_id, {replaced} AS replaced, {_COUNTS} FROM c
        WHERE NOT ({replaced}) OR vendor_id = 1 GROUP BY batch_id, {replaced})
        SELECT batch_id, 'SUCCESS' AS status, {new.format("SUCCESS", processing)} AS processing_status,
          {new.format("SUCCESS", published)} AS s3_publish_status, '{partition}' AS glue_partition_status,
          'MATCH' AS reconciliation_status, total_records AS rows_read, valid_records, warning_records,
          quarantined_records, valid_records + warning_records AS expected_records,
          valid_records + warning_records AS athena_records, CAST(0 AS BIGINT) AS difference FROM s"""


_SPOILED = "(year = 1998 AND month = 10)"
_REFUSED = "(year = 1995 AND month = 5)", "(year = 1996 AND month = 6)", _SPOILED, "(year = 1997 AND month = 8)"


def _series_with_failures() -> str:
    broken, text, spoiled, absent = _REFUSED
    failed = " OR ".join(_REFUSED)

    def unless(value: str) -> str:
        return f"CASE WHEN NOT failed THEN {value} END"

    return f"""{_WITH}, s AS (SELECT batch_id, year, month, ({failed}) AS failed, {_COUNTS} FROM c GROUP BY batch_id, year, month)
        SELECT batch_id, CASE WHEN failed THEN 'FAILED' ELSE 'SUCCESS' END AS status, {unless("'SUCCESS'")} AS processing_status,
          CASE WHEN failed THEN 'FAILED' ELSE 'SUCCESS' END AS s3_publish_status,
          CASE WHEN failed THEN 'FAILED' ELSE 'CREATED' END AS glue_partition_status,
          CASE WHEN failed THEN 'NOT_RUN' ELSE 'MATCH' END AS reconciliation_status,
          {unless("total_records")} AS rows_read, {unless("valid_records")} AS valid_records,
          {unless("warning_records")} AS warning_records, {unless("quarantined_records")} AS quarantined_records,
          {unless("valid_records + warning_records")} AS expected_records,
          {unless("valid_records + warning_records")} AS athena_records, {unless("CAST(0 AS BIGINT)")} AS difference,
          CASE WHEN {absent} THEN 'FileNotFoundError' WHEN failed THEN 'ValueError' END AS error_type,
          CASE WHEN {broken} THEN 'missing required columns' WHEN {text} THEN 'columns whose type does not fit the table''s'
            WHEN {spoiled} THEN 'unreadable source' WHEN {absent} THEN 'no such input' END AS reason FROM s"""


_CLASSIFIED = f"{_KEYS}, quarantine_reasons, warning_reasons, validation_status"

ORACLES: dict[str, str] = {
    "batch_summary": f"""{_WITH}, {_BY_MONTH}
        SELECT year, month, 'CREATED' AS partition_status, total_records, valid_records, warning_records,
          quarantined_records, {_RATES},
          '{DATASET}_' || year || '_' || lpad(CAST(month AS VARCHAR), 2, '0') AS batch_id,
          valid_records + warning_records AS expected_records,
          (SELECT COUNT(*) FROM c WHERE c.year = m.year AND c.month = m.month
             AND validation_status <> 'QUARANTINE') AS published_records,
          CAST(0 AS BIGINT) AS difference, 'MATCH' AS reconciliation_status FROM m""",
    "normalize_columns": f"{_WITH} SELECT * FROM n",
    "canonical_types": f"{_WITH} SELECT vendor_id, rate_code_id, trip_distance, pickup_location_id FROM n",
    **{
        f"rule_{code.lower()}": f"{_WITH} SELECT {_KEYS} FROM n WHERE {predicate}"
        for code, predicate in _FIRES.items()
    },
    "reason_arrays": f"{_WITH} SELECT {_KEYS}, quarantine_reasons, warning_reasons FROM r",
    "classify_status": f"{_WITH} SELECT {_CLASSIFIED} FROM c",
    "lineage_columns": f"""{_WITH} SELECT {_KEYS}, '{PREFIX}_' || period || '.parquet' AS source_file,
        batch_id, '1.0' AS schema_version FROM c""",
    "curated_rows": f"{_WITH} SELECT {_CLASSIFIED} FROM c WHERE validation_status IN ('VALID', 'WARNING')",
    "quarantine_rows": f"{_WITH} SELECT {_CLASSIFIED} FROM c WHERE validation_status = 'QUARANTINE'",
    "written_metrics": _METRICS,
    "single_run": f"{_WITH} SELECT *, {_RATES}, TRUE AS second_run_skipped FROM (SELECT {_COUNTS} FROM c)",
    "published_quarantine": f"""{_WITH} SELECT {_KEYS.removesuffix(", year, month")}, batch_id, quarantine_reasons,
        warning_reasons FROM c WHERE validation_status = 'QUARANTINE'""",
    "published_metrics": f"{_WITH} SELECT *, {_RATES} FROM (SELECT period, {_COUNTS} FROM c GROUP BY period)",
    "total_rows": f"{_WITH} SELECT COUNT(*) AS total_records FROM c",
    "status_counts": f'{_WITH} SELECT validation_status, COUNT(*) AS "count" FROM c GROUP BY validation_status',
    "quality_metrics": _METRICS,
    "quality_metrics_by_batch": f"""{_WITH} SELECT *, {_RATES}
        FROM (SELECT batch_id, {_COUNTS} FROM c GROUP BY batch_id)""",
    "batch_counts": f"""{_WITH} SELECT batch_id, total_records AS rows_read, valid_records, warning_records,
        quarantined_records FROM (SELECT batch_id, {_COUNTS} FROM c GROUP BY batch_id)""",
    "batch_addresses": f"""{_WITH} SELECT DISTINCT lpad(CAST(month AS VARCHAR), 2, '0') AS month_string, period,
        batch_id, '{PREFIX}_' || period || '.parquet' AS source_file,
        'curated/{DATASET}/year=' || year || '/month=' || lpad(CAST(month AS VARCHAR), 2, '0')
          AS curated_prefix FROM c""",
    "processed_runs": f"{_RUNS} SELECT run_id, status, completed FROM done",
    "pending_batches": f"{_RUNS} SELECT batch_id, source_checksum FROM b WHERE NOT EXISTS ({_DONE})",
    "skipped_batches": f"{_RUNS} SELECT batch_id, source_checksum FROM b WHERE EXISTS ({_DONE})",
    "folded_skips": f"{_RUNS} SELECT batch_id, source_checksum FROM b WHERE EXISTS ({_DONE})",
    **dict.fromkeys(("latest_processed_counts", "folded_counts"), f"""{_RUNS}
        -- Attempt 1 has no completion time and so comes first; later attempts complete later.
        SELECT batch_id, source_checksum, rows_read, valid_records, warning_records, quarantined_records
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY batch_id, source_checksum
                                           ORDER BY attempt DESC) AS newest
              FROM done WHERE completed AND valid_records IS NOT NULL AND warning_records IS NOT NULL)
        WHERE newest = 1"""),
    "recorded_reruns": f"""{_RUNS} SELECT run_id FROM runs WHERE publish_status = 'BACKFILLED'
        OR partition_status = 'CREATED' OR reconciliation_status = 'MATCH'""",
    "published_rows": f"""{_WITH} SELECT {_KEYS}, batch_id, validation_status FROM c
        WHERE validation_status <> 'QUARANTINE'""",
    "partition_counts": f"""{_WITH} SELECT year, month, COUNT(*) AS published_records FROM c
        WHERE validation_status <> 'QUARANTINE' GROUP BY year, month""",
    "reconcile_batches": f"""{_WITH}, {_BY_MONTH},
        e AS (SELECT year, month, CASE WHEN month = 1 THEN total_records
                ELSE valid_records + warning_records END AS expected FROM m WHERE month <> 2),
        p AS (SELECT year, month, COUNT(*) AS published FROM c
              WHERE validation_status <> 'QUARANTINE' AND month <> 3 GROUP BY year, month)
        SELECT year, month, COALESCE(expected, 0) AS expected_records,
          COALESCE(published, 0) AS published_records,
          COALESCE(published, 0) - COALESCE(expected, 0) AS difference,
          CASE WHEN COALESCE(published, 0) = COALESCE(expected, 0) THEN 'MATCH' ELSE 'MISMATCH' END
            AS reconciliation_status
        FROM e FULL JOIN p USING (year, month)""",
    "reconcile_content": f"""{_WITH}, k AS (SELECT year, month, COUNT(*) AS n, COUNT(*) FILTER (WHERE vendor_id = 1) AS first,
          COUNT(*) FILTER (WHERE vendor_id <> 1) AS rest FROM c WHERE validation_status <> 'QUARANTINE' GROUP BY year, month)
        SELECT year, month, n AS expected_records,
          CASE WHEN month = 6 THEN 0 WHEN month = 4 AND rest = 0 THEN 0 ELSE n END AS published_records,
          CASE WHEN month = 6 OR (month = 4 AND rest = 0) THEN 'COUNT_MISMATCH'
               WHEN month = 3 OR (month = 4 AND first > 0) THEN 'CONTENT_MISMATCH' ELSE 'MATCH' END AS reconciliation_status FROM k""",
    "reconciliation_outcomes": f"""{_RUNS} SELECT run_id,
        CASE WHEN publish_status IS NULL OR status <> 'SUCCESS' THEN 'DISABLED'
             WHEN reconciliation_status = 'FAILED' THEN 'FAILED'
             ELSE reconciliation_status END AS reconciliation_status FROM runs""",
    "partition_repair": f"""{_WITH} SELECT DISTINCT year, month,
        CASE WHEN month IN (1, 2, 3) THEN 'CREATED' ELSE 'EXISTS' END AS partition_status, TRUE AS correct,
        COUNT(*) FILTER (WHERE validation_status <> 'QUARANTINE') OVER (PARTITION BY year, month)
          AS published_records FROM c""",
    "schema_drift": f"""{_WITH} SELECT DISTINCT batch_id,
        CASE WHEN {_REFUSED[0]} THEN 'PULocationID' ELSE '' END AS missing,
        CASE WHEN month IN (1, 7) THEN 'cbd_congestion_fee' WHEN {_REFUSED[0]} THEN 'tolls_amount' ELSE '' END AS absent,
        CASE WHEN month = 4 THEN 'driver_note' ELSE '' END AS added,
        CASE WHEN month = 2 THEN 'airport_fee' ELSE '' END AS respelled,
        CASE WHEN {_SPOILED} THEN '' ELSE 'dropoff_datetime TIMESTAMP_NTZ, ' || CASE WHEN month = 3 THEN 'passenger_count INT, '
          ELSE '' END || 'pickup_datetime TIMESTAMP_NTZ' END AS widened,
        CASE WHEN {_REFUSED[1]} THEN 'trip_distance STRING' ELSE '' END AS unfit, '' AS doubled,
        CASE WHEN {_SPOILED} THEN 'ArrowInvalid' ELSE '' END AS unreadable,
        NOT ({" OR ".join(_REFUSED[:3])}) AS accepted FROM c""",
    "series_with_failures": _series_with_failures(),
    "series_first_run": _series("SUCCESS", "SUCCESS", "CREATED"),
    "series_rerun": _series("SKIPPED_ALREADY_PROCESSED", "EXISTS", "EXISTS"),
    "series_changed_source": _series("SKIPPED_ALREADY_PROCESSED", "EXISTS", "EXISTS", "year = 1995 AND month = 3"),
    "publication_state": f"""{_WITH} SELECT DISTINCT batch_id, TRUE AS raw_present, month <> 2 AS raw_matches,
        TRUE AS curated_complete, month <> 1 AS quarantine_complete, TRUE AS metrics_complete,
        month NOT IN (1, 2) AS published,
        CASE month WHEN 1 THEN 'BACKFILLED' WHEN 2 THEN 'BACKFILLED' WHEN 4 THEN 'DISABLED' WHEN 5 THEN 'SUCCESS'
          ELSE 'EXISTS' END AS action FROM c""",
    "batch_totals": f"""{_history()} SELECT CAST(SUM(source_records) AS BIGINT) AS total_source_records,
        CAST(SUM(curated_records) AS BIGINT) AS total_curated_records,
        CAST(SUM(valid_records) AS BIGINT) AS total_valid_records,
        CAST(SUM(warning_records) AS BIGINT) AS total_warning_records,
        CAST(SUM(quarantined_records) AS BIGINT) AS total_quarantined_records,
        CAST(SUM(curated_records) AS DOUBLE) / CAST(SUM(source_records) AS DOUBLE) * 100
          AS overall_pass_rate FROM h""",
    "batch_pass_rates": f"""{_history()} SELECT *,
        ROUND(curated_records / source_records * 100, 4) AS quality_pass_rate,
        curated_records - athena_records AS reconciliation_difference FROM h""",
    "invariants": f"{_invariants('FALSE')} UNION ALL {_invariants('TRUE')}",
    "manifest_changes": f"""{_WITH}, f AS (SELECT month, 'year=' || year || '/month=' || month AS folder,
          batch_id || ':' || COUNT(*) || chr(10) AS line FROM c GROUP BY year, month, batch_id)
        SELECT folder, CASE month WHEN 1 THEN 'removed' WHEN 2 THEN 'changed' ELSE 'same' END AS change,
          month IN (2, 4) AS hashed, sha256(CASE WHEN month = 2 THEN 'other' ELSE line END) AS sha256 FROM f
        UNION ALL SELECT folder, 'added', TRUE, sha256('more') FROM f WHERE month = 3""",
    "source_manifest": f"""{_WITH} SELECT 'year=' || year || '/month=' || month AS folder,
        CAST(length(line) AS BIGINT) AS size_bytes, sha256(line) AS sha256
        FROM (SELECT year, month, batch_id || ':' || COUNT(*) || chr(10) AS line FROM c GROUP BY year, month, batch_id)""",
    # A month's rows make one file, and each output has its marker.
    "publication_summary_counts": f"""{_WITH} SELECT batch_id,
        CAST(1 + MAX(CASE WHEN quarantine_reasons = '' THEN 1 ELSE 0 END) AS BIGINT) AS curated_object_count,
        CAST(CASE WHEN month = 2 THEN 0 ELSE 1 + MAX(CASE WHEN quarantine_reasons <> '' THEN 1 ELSE 0 END) END AS BIGINT)
          AS quarantine_object_count,
        CAST(CASE WHEN month = 3 THEN 1 ELSE 2 END AS BIGINT) AS quality_object_count,
        MAX(CASE WHEN quarantine_reasons = '' THEN 1 ELSE 0 END) = 1 AS has_curated_data, month NOT IN (2, 3) AS complete
        FROM c GROUP BY batch_id, month""",
    "published_objects": f"""{_WITH}, d AS (SELECT DISTINCT year, month, period,
          COUNT(*) FILTER (WHERE quarantine_reasons = '') OVER (PARTITION BY year, month) > 0 AS good,
          COUNT(*) FILTER (WHERE quarantine_reasons <> '') OVER (PARTITION BY year, month) > 0 AS bad FROM c)
        SELECT 'curated/{DATASET}/year=' || year || '/month=' || lpad(CAST(month AS VARCHAR), 2, '0') AS directory,
          good AS has_data, TRUE AS has_marker, TRUE AS has_objects FROM d
        UNION ALL SELECT 'quarantine/{DATASET}/' || period, bad, TRUE, TRUE FROM d
        UNION ALL SELECT 'metrics/quality/{DATASET}/' || period, TRUE, TRUE, TRUE FROM d""",
}
