"""Column lists, schemas and thresholds.

Fixed values that must equal the analysed project's configuration are listed
together below, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: detection thresholds (object region of interest, labels) ---
VELOCITY_X_MAX = 200
VELOCITY_Y_MAX = 200
VELOCITY_Z_MAX = 200
VELOCITY_X_MIN = -1
POSITION_Y_MIN = -5
POSITION_Y_MAX = 5
POSITION_X_MAX = 40
LANE_CHANGE_SPEED_MIN = 30
BRAKE_PEDAL_MIN = 15
BRAKE_SPEED_MIN = 30
TURNING_STEERING_MIN = 0.4
TURNING_SPEED_MIN = 60
CONGESTION_COUNT_MIN = 4
CONGESTION_AVG_V_MAX = 15
CONGESTION_EGO_V_MAX = 15

# --- fixed values: label codes, in priority order (later wins) ---
STATUS_NONE = 0
STATUS_LANE_CHANGE = 1
STATUS_EMERGENCY_BRAKE = 2
STATUS_TURNING = 3
STATUS_CONGESTION = 4

# --- fixed values: the 29 object columns that form the object dedup key ---
OBJECT_COLUMNS = [
    "ptp_time", "MessageNumber", "ReferenceType", "TrackingID", "ExistConf",
    "LifeTime", "MeasurementState", "Length", "Width", "Height", "PositionX",
    "PositionY", "PositionZ", "Roll", "Pitch", "Yaw", "VelocityX", "VelocityY",
    "VelocityZ", "AccelerationX", "AccelerationY", "AccelerationZ",
    "ReferencePoint", "MovementState", "ClassificationProbability", "ObjType",
    "ObjVehicleClassification", "recording_id", "vehicle",
]

# --- fixed values: the 13 status columns kept from the vehicle stream ---
STATUS_COLUMNS = [
    "ptp_time_rounded", "recording_id", "vehicle", "BrakePedalPosition",
    "BrakeSwitch", "BrakeLight_rqst", "LateralAcceleration",
    "LongitudinalAcceleration", "VehicleDirSAE_VehSpeed",
    "WheelBasedVehicleSpeed", "LaneChangeStatus", "YawRate",
    "SteeringWheelAngle",
]

# --- fixed values: yaw-return scan variants (min rows, max rows, lo, hi) ---
# The jump after an accepted match is 41 rows in every variant.
SCAN_JUMP = 41
SCAN_EQUAL_TOL = 0.001
SCAN_BASIC = (40, 70, 0.015, 0.1)
SCAN_PIPELINE_A = (30, 70, 0.015, 0.1)
SCAN_PIPELINE_B = (40, 80, 0.013, 0.2)
SCAN_LONG = (100, 150, 0.015, None)
SCAN_HEADING = (45, 80, 0.01, 0.02)
# Window half width around the middle of a match, seconds; ego padding, seconds.
WINDOW_HALF_WIDTH = 6.0
EGO_PAD_SECONDS = 10.0

# --- fixed values: geometry ---
CROSS_BUFFER_VALIDATE = 0.1
CROSS_BUFFER_ANY = 0.5
POSITION_JUMP = 20.0
HEADING_LAG = 5
STRAIGHT_R2_MIN = 0.97
STRAIGHT_SHARE_MIN = 0.6
STRAIGHT_R2_MIN_OLD = 0.94
STRAIGHT_SHARE_MIN_OLD = 0.5

# --- fixed values: road-type tags that count as highway ---
HIGHWAY_ROAD_TAGS = [
    "[Road, Type, Primary highway]",
    "[Road, Type, Secondary highway]",
    "[Road, Type, Motorway]",
]

# --- fixed values: tag paging and metadata constants ---
TAG_PAGE_SIZE = 5000
TEST_ACTIVITY = "JPT4"
DATE_TEXT_FORMAT = "yyyy/MM/dd_HH:mm:ss"


@dataclass(frozen=True)
class Thresholds:
    velocity_x_max: float = VELOCITY_X_MAX
    velocity_y_max: float = VELOCITY_Y_MAX
    velocity_z_max: float = VELOCITY_Z_MAX
    velocity_x_min: float = VELOCITY_X_MIN
    position_y_min: float = POSITION_Y_MIN
    position_y_max: float = POSITION_Y_MAX
    position_x_max: float = POSITION_X_MAX
    lane_change_speed_min: float = LANE_CHANGE_SPEED_MIN
    brake_pedal_min: float = BRAKE_PEDAL_MIN
    brake_speed_min: float = BRAKE_SPEED_MIN
    turning_steering_min: float = TURNING_STEERING_MIN
    turning_speed_min: float = TURNING_SPEED_MIN
    congestion_count_min: int = CONGESTION_COUNT_MIN
    congestion_avg_v_max: float = CONGESTION_AVG_V_MAX
    congestion_ego_v_max: float = CONGESTION_EGO_V_MAX


@dataclass(frozen=True)
class ScanParams:
    """One variant of the yaw-return scan."""
    minimum: int
    maximum: int
    lo: float
    hi: float | None
    tol: float = SCAN_EQUAL_TOL
    jump: int = SCAN_JUMP

    @classmethod
    def of(cls, spec: tuple) -> "ScanParams":
        return cls(*spec)


INTERVAL_SCHEMA = T.StructType([
    T.StructField("recording_id", T.StringType()),
    T.StructField("start_time", T.DoubleType()),
    T.StructField("end_time", T.DoubleType()),
])

LINE_SCHEMA = T.StructType([
    T.StructField("recording_id", T.StringType()),
    T.StructField("ptp_time", T.DoubleType()),
    T.StructField("TrackingID", T.LongType()),
    T.StructField("BoundaryLineX", T.ArrayType(T.DoubleType())),
    T.StructField("BoundaryLineY", T.ArrayType(T.DoubleType())),
])

METADATA_COLUMNS = [
    "recording_id", "annotation_filename", "test_function", "test_activity",
    "scenario", "side", "target_type", "target_speed", "target_distance",
    "pass/fail", "start_recording", "stop_recording", "full_annotation",
]
