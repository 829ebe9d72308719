"""Control-table schemas, column defaults and run states."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values. Results are only right when these stay as they are.
# --------------------------------------------------------------------------
YES, NO = "Y", "N"
NEVER_SYNCED = "1970-01-01 00:00:00"

STATES_RUNNING = ["STARTING", "RUNNING", "STOPPING"]
STATE_UNKNOWN = "UNKNOWN"
STATES_TERMINAL = ["SUCCEEDED", "FAILED", "TIMEOUT"]

CREATE_DEFAULTS = {
    "command_name": "glueetl",
    "python_version": "3",
    "max_concurrent_runs": 10,
    "max_retries": 0,
    "timeout_minutes": 180,
}
UPDATE_DEFAULTS = {
    "command_name": "glueetl",
    "max_concurrent_runs": 3,
    "max_retries": 1,
    "timeout_minutes": 180,
}
# An update of a job does not carry these, so the listed value stays.
UPDATE_KEEPS = ["glue_version", "python_version"]

# Typed fields of the JSON column jobs.job_param.
PARAM_TYPES = {
    "script_location": "string",
    "glue_version": "string",
    "max_capacity": "double",
    "command_name": "string",
    "max_concurrent_runs": "int",
    "max_retries": "int",
    "timeout_minutes": "int",
}

RUN_ARGUMENT_KEYS = {
    "--job-instance": "job_instance",
    "--tables": "tables",
    "--incr-from": "incr_from",
    "--incr-to": "incr_to",
    "--job-context": "context",
}

END_MARK = "done!"
RETENTION_SECONDS = 43200

QUEUE_NAME_TEMPLATE = "{job_name}_{job_instance}.fifo"
LOAD_PATH_TEMPLATE = "s3://{bucket}/data/{table_name}/parquet/"
# --------------------------------------------------------------------------

JOB_KEY = ["job_name"]
INSTANCE_KEY = ["job_name", "job_instance"]
DETAIL_KEY = ["job_name", "job_instance", "table_name"]

JOBS = T.StructType(
    [
        T.StructField("job_name", T.StringType(), False),
        T.StructField("job_description", T.StringType()),
        T.StructField("job_param", T.StringType(), False),
        T.StructField("created_timestamp", T.TimestampType(), False),
        T.StructField("modified_timestamp", T.TimestampType(), False),
        T.StructField("last_sync_timestamp", T.TimestampType(), False),
        T.StructField("is_run_sync", T.StringType()),
        T.StructField("is_active", T.StringType()),
    ]
)
JOB_INSTANCES = T.StructType(
    [
        T.StructField("job_name", T.StringType(), False),
        T.StructField("job_instance", T.IntegerType(), False),
        T.StructField("job_run_id", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
JOB_DETAILS = T.StructType(
    [
        T.StructField("job_name", T.StringType(), False),
        T.StructField("job_instance", T.IntegerType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("created_timestamp", T.TimestampType(), False),
        T.StructField("last_run_timestamp", T.TimestampType()),
        T.StructField("is_active", T.StringType()),
    ]
)

# What the three tables must hold; operators.checks reports what does not.
PRIMARY_KEYS = {"jobs": JOB_KEY, "job_instances": INSTANCE_KEY, "job_details": DETAIL_KEY}
FOREIGN_KEYS = [
    ("job_instances", "jobs", JOB_KEY),
    ("job_details", "job_instances", INSTANCE_KEY),
]
NOT_NULL = {
    "jobs": [*JOB_KEY, "job_param", "created_timestamp", "modified_timestamp", "last_sync_timestamp"],
    "job_instances": INSTANCE_KEY,
    "job_details": [*DETAIL_KEY, "created_timestamp"],
}
MAX_LENGTHS = {
    "jobs": {"job_name": 50, "job_description": 100, "is_run_sync": 1, "is_active": 1},
    "job_instances": {"job_name": 50, "status": 10},
    "job_details": {"job_name": 50, "is_active": 1},
}

COLUMN_DEFAULTS = {
    "jobs": {
        "created_timestamp": "current_timestamp()",
        "modified_timestamp": "current_timestamp()",
        "last_sync_timestamp": f"timestamp '{NEVER_SYNCED}'",
        "is_run_sync": f"'{NO}'",
        "is_active": f"'{NO}'",
    },
    "job_instances": {},
    "job_details": {"created_timestamp": "current_timestamp()", "is_active": f"'{NO}'"},
}
TABLES = {"jobs": JOBS, "job_instances": JOB_INSTANCES, "job_details": JOB_DETAILS}
