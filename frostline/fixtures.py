"""Telemetry and surrogate-score tables derived from the `events` table.

The same text runs in Spark and in DuckDB, so queries and their SQL checks start
from equal rows. Every event becomes one reading.
"""

from pyspark.sql import DataFrame, SparkSession

TELEMETRY_SQL = """
WITH b AS (
  SELECT event_id, ts, value,
         CASE user_id % 3 WHEN 0 THEN 'Frozen Food' WHEN 1 THEN 'Dairy' ELSE 'Produce' END AS cargo_type,
         CASE user_id % 3 WHEN 0 THEN -18e0 WHEN 1 THEN 2e0 ELSE 4e0 END AS sp,
         CASE WHEN event_type = 'error' AND event_id % 2 = 0
              THEN CAST((event_id * 10007) % 121 AS DOUBLE) / 10e0
              ELSE CAST((event_id * 10007) % 151 AS DOUBLE) / 100e0 - 25e-2 END AS dev,
         CASE WHEN event_type = 'error' AND event_id % 3 = 0
              THEN CAST(250 + (event_id * 7919) % 451 AS DOUBLE) / 1000e0
              ELSE CAST(700 + (event_id * 7919) % 301 AS DOUBLE) / 1000e0 END AS seal,
         CAST(200 + (event_id * 6151) % 251 AS DOUBLE) / 10e0 AS amb,
         CAST(529 + (event_id * 4099) % 2930 AS DOUBLE) AS watts
  FROM {events}),
c AS (SELECT b.*, 10e0 + 5e0 * dev + 40e0 * (1e0 - seal) + value / 50e0 AS risk FROM b)
SELECT concat('COLD_CNT_', CASE WHEN event_id < 1000000 THEN lpad(CAST(event_id AS STRING), 6, '0')
                                ELSE CAST(event_id AS STRING) END) AS Container_ID,
       ts AS Event_Time,
       cargo_type AS Cargo_Type,
       amb AS Ambient_External_Temp_C,
       sp AS Internal_Set_Point_C,
       sp + dev AS Actual_Internal_Temp_C,
       watts AS HVAC_Power_Consumption_Watts,
       seal AS Seal_Integrity_Index,
       CASE WHEN risk > 100e0 THEN 100e0 WHEN risk < 0e0 THEN 0e0 ELSE risk END AS Forecasted_4Hr_Spoilage_Risk_Pct,
       CASE WHEN dev >= 6e0 AND seal < 6e-1 AND amb >= 38e0 THEN 'EMERGENCY'
            WHEN dev >= 2e0 AND seal < 8e-1 THEN 'WARNING_Request_HVAC_Remote_Reset'
            ELSE 'SAFE_Maintain_Course' END AS Logistics_Action_Recommendation
FROM c
"""

SCORED_SQL = """
WITH d AS (
  SELECT t.*, CAST(substr(Container_ID, 10) AS BIGINT) AS n FROM {telemetry} t),
e AS (
  SELECT d.*, CAST((n * 2741) % 1001 AS DOUBLE) / 1000e0 AS u,
         Forecasted_4Hr_Spoilage_Risk_Pct + CAST((n * 3571) % 1001 AS DOUBLE) / 100e0 - 5e0 AS p FROM d),
f AS (
  SELECT e.*, CASE WHEN Logistics_Action_Recommendation = 'WARNING_Request_HVAC_Remote_Reset'
                   THEN 3e-1 + 7e-1 * u ELSE 4e-1 * u END AS pw FROM e)
SELECT Container_ID, Cargo_Type, Ambient_External_Temp_C, Internal_Set_Point_C, Actual_Internal_Temp_C,
       HVAC_Power_Consumption_Watts, Seal_Integrity_Index, Forecasted_4Hr_Spoilage_Risk_Pct,
       Logistics_Action_Recommendation,
       CASE WHEN p > 100e0 THEN 100e0 WHEN p < 0e0 THEN 0e0 ELSE p END AS Predicted_Spoilage_Risk_Pct,
       (1e0 - pw) * 1e-1 AS Probability_EMERGENCY,
       (1e0 - pw) * 9e-1 AS Probability_SAFE_Maintain_Course,
       pw AS Probability_WARNING_Request_HVAC_Remote_Reset
FROM f
"""

# Readings with gaps and out-of-range values, for the contract operators.
FAULTY_SQL = """
SELECT Container_ID, Cargo_Type, Internal_Set_Point_C, Logistics_Action_Recommendation,
       CASE WHEN Ambient_External_Temp_C > 44e0 THEN Ambient_External_Temp_C + 40e0
            ELSE Ambient_External_Temp_C END AS Ambient_External_Temp_C,
       CASE WHEN Actual_Internal_Temp_C > 10e0 THEN NULL ELSE Actual_Internal_Temp_C END AS Actual_Internal_Temp_C,
       CASE WHEN HVAC_Power_Consumption_Watts < 600e0 THEN 500e0 - HVAC_Power_Consumption_Watts
            ELSE HVAC_Power_Consumption_Watts END AS HVAC_Power_Consumption_Watts,
       CASE WHEN Seal_Integrity_Index > 99e-2 THEN Seal_Integrity_Index + 5e-1
            WHEN Seal_Integrity_Index < 3e-1 THEN NULL ELSE Seal_Integrity_Index END AS Seal_Integrity_Index,
       CASE WHEN Forecasted_4Hr_Spoilage_Risk_Pct > 60e0 THEN NULL
            ELSE Forecasted_4Hr_Spoilage_Risk_Pct END AS Forecasted_4Hr_Spoilage_Risk_Pct
FROM {telemetry}
"""


def events_to_telemetry(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Readings from an `events` frame, batch or streaming."""
    return spark.sql(TELEMETRY_SQL, events=events)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_telemetry(spark, spark.read.parquet(f"{sf_dir}/events.parquet"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCORED_SQL, telemetry=telemetry(spark, sf_dir))


def faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FAULTY_SQL, telemetry=telemetry(spark, sf_dir))


def oracle_views(*names: str) -> str:
    """The named views as CTEs, for DuckDB."""
    text = {
        "telemetry": TELEMETRY_SQL.format(events="events"),
        "scored": SCORED_SQL.format(telemetry="telemetry"),
        "faulty": FAULTY_SQL.format(telemetry="telemetry"),
    }
    wanted = ["telemetry", *(n for n in names if n != "telemetry")]
    return "WITH " + ",\n".join(f"{n} AS ({text[n]})" for n in wanted)
