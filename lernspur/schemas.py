"""Input schemas, keys and vocabularies."""

from pyspark.sql import types as T

# --- fixed values: words and column names of the event log and of the output tables ---
ACTION_EVENTS = ("mathStep", "mathMistake", "hideHint", "showHint")
STATE_EVENTS = ("mathStep", "undo", "redo", "mathMistake")
NO_PATH_EVENTS = ("visitTask", "visitGameScreen", "showHint", "hideHint", "mathMistake")
NO_PATH_RESET_REASONS = ("retryButton", "autoReset")
MISSING_NODE = "missing_node"
MISSING_ACTION = "missing_action"
MISSING_WEIGHT = 10000
STEP_WEIGHT = 1
LONGEST_GAP_SECONDS = 300
BUNDLE_FILES = {
    "roster": "roster-metadata.json",
    "study": "study-metadata.json",
    "task": "task-metadata.ndjson",
    "event_logs": "event-logs.ndjson",
    "attempt_data": "attempt-data.ndjson",
}
STUDY_INFO_FILE = "study_info.txt"

STUDENT = "studentSessionId"
K2 = [STUDENT, "taskNumber"]
K3 = K2 + ["attemptHlc"]
K4 = K3 + ["visitId"]
# Timestamp ties keep the order of the input file, carried by ``seq``.
EVENT_ORDER = ["timestamp", "seq"]

EVENT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "studentRef", "studentSessionId", "sessionId")]
    + [T.StructField(n, T.IntegerType()) for n in ("taskNumber", "attemptNumber")]
    + [T.StructField(n, T.StringType()) for n in (
        "attemptHlc", "visitId", "timestamp", "eventType", "actionId", "actionName",
        "oldState", "newState")]
    + [T.StructField(n, T.IntegerType()) for n in ("steps", "stars")]
    + [
        T.StructField("mistake", T.StringType()),
        T.StructField("wasSolved", T.BooleanType()),
        T.StructField("reason", T.StringType()),
        T.StructField("dx", T.DoubleType()),
        T.StructField("dy", T.DoubleType()),
        T.StructField("dropClosestToSelf", T.BooleanType()),
    ]
)

# Type of each event column once loaded; the timestamp text has been parsed.
EVENT_TYPES_BY_COLUMN = {
    f.name: (T.TimestampType() if f.name == "timestamp" else f.dataType) for f in EVENT_SCHEMA
}

TASK_SCHEMA = T.StructType(
    [T.StructField("taskNumber", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in (
        "startState", "goalState", "sessionId", "sessionCreatedAt",
        "sessionCode", "taskId", "chapterId", "hintDelta")]
)
TASK_SESSION_COLUMNS = (
    "sessionCode", "taskId", "chapterId", "sessionId", "sessionCreatedAt", "hintDelta",
)
# -----------------------------------------------------------------------------------
