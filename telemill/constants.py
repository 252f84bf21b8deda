"""Fixed values of the data model: they must hold for results to be right."""

# --- fixed values: sampling and labels -------------------------------------
SAVE_FREQ_S = 60
HORIZON_S = 6 * 3600
CHANGE_AT_S = 2 * 3600
PRE_FAILURE_S = 3600
CYCLE_S = 3600
STARTUP_CYCLES = 4
NO_FAILURE_TTF = -1.0

LABELS = ["NORMAL", "PRE_FAILURE", "FAILURE"]

# --- fixed values: pump ----------------------------------------------------
PUMP_V_NOM = 471.2389
PUMP_V_HIGH = 571.2389
PUMP_T_AMBIENT = 290.0
PUMP_P_DISCHARGE = 928654.0
PUMP_P_DISCHARGE_HIGH = 1200000.0
PUMP_P_SUCTION = 239179.0
PUMP_SYNC_RATIO = 0.8
PUMP_HIGHLOAD_GAIN = 0.15

PUMP_SIGNALS = [
    "shaft_speed_rads",
    "flow_out_m3s",
    "thrust_bearing_K",
    "radial_bearing_K",
    "fluid_temp_K",
    "flow_in_m3s",
    "pump_speed_rads",
    "impeller_area_A",
    "r_thrust",
    "r_radial",
]
PUMP_NOISE_SD = {
    "shaft_speed_rads": 0.3,
    "flow_out_m3s": 5e-5,
    "thrust_bearing_K": 0.2,
    "radial_bearing_K": 0.2,
    "fluid_temp_K": 0.1,
    "flow_in_m3s": 5e-5,
    "pump_speed_rads": 0.3,
    "impeller_area_A": 0.0,
    "r_thrust": 0.0,
    "r_radial": 0.0,
}
PUMP_SPEEDS = ["shaft_speed_rads", "pump_speed_rads"]
PUMP_FLOWS = ["flow_out_m3s", "flow_in_m3s"]
PUMP_TEMPS = ["thrust_bearing_K", "radial_bearing_K", "fluid_temp_K"]
PUMP_STATES = ["impeller_area_A", "r_thrust", "r_radial"]
PUMP_FAILURES = ["bearing", "impeller", "radial"]
PUMP_DECOYS = ["highload_step", "highload_ramp", "bp_step", "bp_ramp"]
PUMP_DRIFT_SD = 0.001

# --- fixed values: motor ---------------------------------------------------
MOTOR_V_NOM = 23.0
MOTOR_DUTY_NOM = 1.0
MOTOR_SIGNALS = [
    "rotational_velocity_rads",
    "current_rms_A",
    "torque_load_Nm",
    "mechanical_power_W",
    "electrical_power_W",
    "resistance_ohm",
    "friction_coeff",
    "backemf_constant",
]
MOTOR_NOISE_SD = {
    "rotational_velocity_rads": 0.3,
    "current_rms_A": 0.005,
    "torque_load_Nm": 5e-6,
    "mechanical_power_W": 0.005,
    "electrical_power_W": 0.01,
    "resistance_ohm": 0.0,
    "friction_coeff": 0.0,
    "backemf_constant": 0.0,
}
MOTOR_RESPONSES = MOTOR_SIGNALS[:5]
MOTOR_PARAMS = MOTOR_SIGNALS[5:]
MOTOR_FAILURES = ["winding", "bearing", "demag"]
MOTOR_DECOYS = [
    "load_step",
    "load_ramp",
    "voltage_sag_step",
    "voltage_sag_ramp",
    "duty_step",
    "duty_ramp",
]
MOTOR_DRIFT_SD_LONG = 0.0003
MOTOR_DRIFT_SD_SHORT = 0.0005
# failure -> (parameter column, healthy value, value at failure)
MOTOR_WEAR = {
    "winding": ("resistance_ohm", 0.081, 0.30),
    "bearing": ("friction_coeff", 0.0, 0.0015),
    "demag": ("backemf_constant", 0.0265, 0.012),
}
# input axis -> (healthy value, value at full decoy strength)
MOTOR_INPUTS = {
    "load": (1.0, 2.5),
    "voltage": (23.0, 23.0 * 0.75),
    "duty": (1.0, 0.60),
}
MOTOR_DECOY_AXIS = {
    "load_step": "load",
    "load_ramp": "load",
    "voltage_sag_step": "voltage",
    "voltage_sag_ramp": "voltage",
    "duty_step": "duty",
    "duty_ramp": "duty",
}
MOTOR_FAIL_SPEED_FRACTION = 0.40
LUT_POINTS = 15
PROP_TORQUE = 5.42e-7 * 1.225 * 0.381**5

# --- fixed values: events --------------------------------------------------
DOWNTIME_S = 6 * 3600
RESTART_S = 4 * 3600
COOLING_TAU_S = 2 * 3600
BLEND_ROWS = 30
RAMP_ROWS_MAX = 30
STEP_ROWS = 5
RAMP_SHARE = 0.6

# --- fixed values: fleet defaults ------------------------------------------
FLEET_DEVICES = 6000
FLEET_DAYS = 365.0
FLEET_SEED = 12345
HEALTHY_FRACTION = 0.4
FAILURE_FRACTION = 0.2
