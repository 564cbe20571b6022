"""Fixed schemas of the data model (raw readings, processed meter table,
weather, feature rows, inference rows, scores, labels, alerts)."""

from pyspark.sql import types as T

S, D, I = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_COLUMNS = ["timestamp_str", "meter_id", "apartment_id", "building_id",
               "energy_kwh", "room_temp_c", "setpoint_temp_c", "hot_water_litres"]
RAW = _struct(("timestamp_str", S), ("meter_id", S), ("apartment_id", S), ("building_id", S),
              ("energy_kwh", D), ("room_temp_c", D), ("setpoint_temp_c", D), ("hot_water_litres", D))

METER_COLUMNS = ["event_ts", "meter_id", "apartment_id", "building_id",
                 "energy_kwh", "room_temp_c", "setpoint_temp_c", "hot_water_litres",
                 "year", "month", "day"]
PARTITION_COLUMNS = ["year", "month", "day"]
METER = _struct(("event_ts", T.TimestampType()), ("meter_id", S), ("apartment_id", S), ("building_id", S),
                ("energy_kwh", D), ("room_temp_c", D), ("setpoint_temp_c", D), ("hot_water_litres", D),
                ("year", I), ("month", I), ("day", I))

WEATHER_COLUMNS = ["hdd", "avg_temp_c"]

FEATURE_COLUMNS = ["apartment_record_id", "event_time", "event_date", "building_id",
                   "daily_energy_kwh", "avg_temp_diff", "daily_water_l", "hdd", "avg_temp_c",
                   "energy_lag_1d", "energy_roll_avg_7d", "temp_diff_lag_1d"]
FEATURE = _struct(("apartment_record_id", S), ("event_time", T.TimestampType()), ("event_date", T.DateType()),
                  ("building_id", S), ("daily_energy_kwh", D), ("avg_temp_diff", D), ("daily_water_l", D),
                  ("hdd", D), ("avg_temp_c", D), ("energy_lag_1d", D), ("energy_roll_avg_7d", D),
                  ("temp_diff_lag_1d", D))

ID_COLUMNS = ["apartment_id", "building_id", "event_date"]
INFER_COLUMNS = ID_COLUMNS + ["daily_energy_kwh", "avg_temp_diff", "hdd", "avg_temp_c",
                              "energy_lag_1d", "energy_roll_avg_7d", "temp_diff_lag_1d"]
INFER = _struct(("apartment_id", S), ("building_id", S), ("event_date", T.DateType()),
                *[(c, D) for c in INFER_COLUMNS[3:]])

# Model features used when none are given (6 columns; temp_diff_lag_1d is not one).
MODEL_FEATURES = ["daily_energy_kwh", "avg_temp_diff", "hdd", "avg_temp_c",
                  "energy_lag_1d", "energy_roll_avg_7d"]

SCORE_COLUMNS = ["apartment_id", "building_id", "event_date", "anomaly_score_combined"]

LABEL = _struct(("apartment_record_id", S), ("event_date", T.DateType()), ("is_anomaly", I))

ALERT_COLUMNS = ["AlertID", "ApartmentID", "EventDate", "BuildingID", "AnomalyScore",
                 "Threshold", "AlertTimestamp", "Status", "S3SourceFile"]
ALERT_DECIMAL = T.DecimalType(38, 18)
