"""Declared schemas of every table that is read from files."""

from __future__ import annotations

from pyspark.sql import types as T

from . import constants as K


def _fields(names, kind):
    return [T.StructField(n, kind) for n in names]


_TIME = [
    T.StructField("time_s", T.LongType()),
    T.StructField("time_h", T.DoubleType()),
    T.StructField("label", T.StringType()),
    T.StructField("time_to_failure_s", T.DoubleType()),
]
_EVENT = [T.StructField("event_type", T.StringType())]
_GAP = [T.StructField("flow_gap_m3s", T.DoubleType())]

PUMP_SERIES = T.StructType(_fields(K.PUMP_SIGNALS, T.DoubleType()) + _TIME + _EVENT + _GAP)
MOTOR_SERIES = T.StructType(_fields(K.MOTOR_SIGNALS, T.DoubleType()) + _TIME + _EVENT)

_SCENARIO_ID = [T.StructField("scenario_id", T.IntegerType())]
PUMP_SCENARIO = T.StructType(_fields(K.PUMP_SIGNALS, T.DoubleType()) + _TIME + _SCENARIO_ID + _GAP)
MOTOR_SCENARIO = T.StructType(_fields(K.MOTOR_SIGNALS, T.DoubleType()) + _TIME + _SCENARIO_ID)

SCENARIOS = T.StructType(
    [
        T.StructField("scenario_id", T.IntegerType()),
        T.StructField("scenario", T.StringType()),
        T.StructField("group", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("faulty", T.BooleanType()),
        T.StructField("description", T.StringType()),
    ]
)
SCENARIOS_LONG = T.StructType(
    SCENARIOS.fields[:5]
    + _fields(["duration_days", "decoy_freq_per_day"], T.DoubleType())
    + SCENARIOS.fields[5:]
)

_MANIFEST = [
    T.StructField("device_id", T.StringType()),
    T.StructField("seed", T.LongType()),
    T.StructField("duration_days", T.DoubleType()),
    T.StructField("failure_type", T.StringType()),
    T.StructField("failure_start_day", T.DoubleType()),
    T.StructField("failure_severity", T.DoubleType()),
    T.StructField("ambient_var_K", T.DoubleType()),
    T.StructField("duty_cycle_var", T.DoubleType()),
    T.StructField("decoy_freq_per_day", T.DoubleType()),
    T.StructField("decoy_types", T.StringType()),
    T.StructField("noise_scale", T.DoubleType()),
    T.StructField("v_offset", T.DoubleType()),
]
_STATUS = [
    T.StructField("status", T.StringType()),
    T.StructField("num_rows", T.LongType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("generation_time_s", T.DoubleType()),
]
PUMP_MANIFEST = T.StructType(_MANIFEST + _fields(["p_offset"], T.DoubleType()) + _STATUS)
MOTOR_MANIFEST = T.StructType(_MANIFEST + _STATUS)
RESULTS = T.StructType([_MANIFEST[0], *_STATUS[1:], _STATUS[0]])

CONFIG = T.StructType(
    [
        T.StructField("num_devices", T.LongType()),
        T.StructField("duration_days", T.DoubleType()),
        T.StructField("save_freq_s", T.LongType()),
        T.StructField("max_workers", T.LongType()),
        T.StructField("base_seed", T.LongType()),
        T.StructField("output_dir", T.StringType()),
        T.StructField("healthy_fraction", T.DoubleType()),
        T.StructField("bearing_fraction", T.DoubleType()),
        T.StructField("impeller_fraction", T.DoubleType()),
        T.StructField("radial_fraction", T.DoubleType()),
        T.StructField("winding_fraction", T.DoubleType()),
        T.StructField("demag_fraction", T.DoubleType()),
    ]
)
