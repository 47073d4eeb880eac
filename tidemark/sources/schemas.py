"""The event contract and its table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, NTZ = T.StringType(), T.TimestampNTZType()
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _schema(required: str, kinds: dict[str, T.DataType], optional: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(c, kinds.get(c, TEXT), c in optional) for c in required.split()])


EVENTS = _schema(
    "insert_id event_type user_id device_id client_event_time server_received_time server_upload_time event_properties",
    {"client_event_time": NTZ, "server_received_time": NTZ, "server_upload_time": NTZ},
)
DIM_USER = _schema("user_id tz cohort_id signup_date valid_from valid_to", {"signup_date": T.DateType(), "valid_from": NTZ, "valid_to": NTZ}, ("valid_to",))
SEND_SCHEDULE = _schema(
    "user_id send_hour_local send_minute_local cohort_hour_local tz confidence model_version computed_as_of written_at",
    {"send_hour_local": T.IntegerType(), "send_minute_local": T.IntegerType(), "cohort_hour_local": T.IntegerType(), "confidence": T.DoubleType(), "computed_as_of": NTZ, "written_at": NTZ},
)
TRUTH_USERS = _schema("user_id cohort_id reachable_center_local_hour reachable_width_hours", {"reachable_center_local_hour": T.DoubleType(), "reachable_width_hours": T.DoubleType()})
TRUTH_PROMPTS = _schema("prompt_id user_id cause local_send_hour", {"local_send_hour": T.DoubleType()})

# Fixed values of the contract: the property keys of each event type.
PROPERTY_KEYS = {
    "prompt_sent": ("prompt_id", "cohort_id", "window_minutes"),
    "prompt_delivered": ("prompt_id",),
    "prompt_opened": ("prompt_id",),
    "capture_started": ("prompt_id",),
    "upload_started": ("prompt_id", "attempt", "error_code"),
    "upload_failed": ("prompt_id", "attempt", "error_code"),
    "upload_completed": ("prompt_id", "attempt", "error_code"),
    "response_recorded": ("prompt_id", "response_id"),
    "app_opened": (),
}
PROPERTIES = ("prompt_id", "cohort_id", "window_minutes", "attempt", "error_code", "response_id")
