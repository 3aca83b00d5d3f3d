"""Business-process marts: process with open task, employees, incidents, steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import fixed_values as fv
from ledgerloom.functions.rules import keep_if, value_map
from ledgerloom.functions.times import mixed_timestamp
from ledgerloom.operators.joins import at_latest_completed, left_join_by_parts
from ledgerloom.operators.ordering import order_output
from ledgerloom.operators.unions import union_all

PROCESS = [
    "application_num",
    "start_dtime",
    "process_name",
    "proc_inst_id_",
    "proc_def_id_",
    "end_dtime",
    "init_username",
    "state",
]
PERSON = [
    "employeenumber",
    "fullname",
    "position_code",
    "position_name",
    "specialization_code",
    "specialization_name",
    "department_code",
    "department_name",
]
BRANCH = ["branch_code", "branch_name"]
OPEN_TASK = ["task_name", "due_dtime", "create_dtime", "curr_username"]
STEP = ["step_id", "activity_inst_id", "all_step", "date_start_t", "date_end_t", "user_state"]


def completed_state(tasks: DataFrame) -> DataFrame:
    """Step reached at the latest completed end time of each process, ties kept.

    End times hold epoch milliseconds or ISO text; they are parsed before the
    maximum is taken.
    """
    timed = tasks.withColumn("_end", mixed_timestamp(F.col("date_end_t")))
    completed = (
        (F.col("completed") == "true")
        & F.col("all_step").isNotNull()
        & F.col("application_num").isNotNull()
    )
    latest = at_latest_completed(timed, "proc_def_id_", "_end", completed, ["all_step"])
    return latest.select(
        F.col("proc_def_id_").alias("_proc"), F.col("all_step").alias("completed_state")
    ).distinct()


def _people(employees: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    return employees.select(
        F.col("username").alias(f"_{prefix}"),
        *[F.col(name).alias(f"{prefix}_{name}") for name in columns],
    ).distinct()


def _with_performer(df: DataFrame, employees: DataFrame) -> DataFrame:
    curr = _people(employees, "curr", PERSON)
    return df.join(curr, F.col("curr_username") == F.col("_curr"), "left").drop("_curr")


def incident_lookup(incidents: DataFrame, executions: DataFrame) -> DataFrame:
    """Incident message and time per root process."""
    return (
        incidents.join(executions, incidents["proc_inst_id_"] == executions["id_"])
        .select(
            F.col("root_proc_inst_id_").alias("_root"),
            "incident_msg_",
            F.col("incident_timestamp_").alias("error_dtime"),
        )
        .distinct()
    )


def _process_rows(
    tasks: DataFrame,
    processes: DataFrame,
    employees: DataFrame,
    incidents: DataFrame,
    executions: DataFrame,
    steps: DataFrame | None,
    step_keys: DataFrame | None = None,
) -> DataFrame:
    """Processes with steps, open tasks and lookups, plus open tasks without a process.

    Each side is de-duplicated before it is joined, so the joined rows are
    distinct as they come and the wide result needs no grouping. Employees,
    incidents and states are looked up while a process and an open task are one
    row each; tasks and steps, which multiply the rows, come last and by the same
    key, so the rows that they make are not moved again. Steps are the longest
    table; joining them by parts lets a process with very many steps be split.
    """
    open_tasks = (
        tasks.where((F.col("completed") == "false") & F.col("application_num").isNotNull())
        .select(
            F.col("proc_def_id_").alias("_task_proc"),
            F.col("all_step").alias("task_name"),
            "due_dtime",
            "create_dtime",
            F.col("user_state").alias("curr_username"),
        )
        .distinct()
    )
    shown = PROCESS if steps is not None else [c for c in PROCESS if c != "proc_def_id_"]
    base = processes.select(*shown).distinct()
    states = completed_state(tasks)
    finished = F.col("state") == "true"
    base = (
        base.join(
            _people(employees, "init", PERSON + BRANCH),
            F.col("init_username") == F.col("_init"),
            "left",
        )
        .join(
            incident_lookup(incidents, executions), F.col("proc_inst_id_") == F.col("_root"), "left"
        )
        .join(states, (F.col("proc_inst_id_") == F.col("_proc")) & finished, "left")
        .drop("_init", "_root", "_proc")
    )
    performed = _with_performer(open_tasks, employees)
    if steps is not None:
        known = left_join_by_parts(
            base, steps, "proc_inst_id_", "_step_proc", right_keys=step_keys, beside=(performed, "_task_proc")
        ).drop("_step_proc", "_task_proc")
    else:
        open_keys = tasks.where((F.col("completed") == "false") & F.col("application_num").isNotNull())
        open_keys = open_keys.select(F.col("proc_def_id_").alias("_task_proc"))
        known = left_join_by_parts(base, performed, "proc_inst_id_", "_task_proc", right_keys=open_keys).drop("_task_proc")
    instances = processes.select(F.col("proc_inst_id_").alias("_id")).distinct()
    orphans = open_tasks.join(instances, F.col("_task_proc") == F.col("_id"), "left_anti")
    alone = _with_performer(orphans.select(*OPEN_TASK).distinct(), employees)
    filled = [
        F.col(f.name) if f.name in alone.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in known.schema.fields
    ]
    return union_all([known, alone.select(*filled)])


def _shown(with_definition: bool) -> list[str | Column]:
    state = F.coalesce(value_map(F.col("state"), fv.PROCESS_STATES), F.col("state"))
    definition = ["proc_def_id_"] if with_definition else []
    return [
        "application_num",
        "start_dtime",
        "process_name",
        "proc_inst_id_",
        *definition,
        "task_name",
        "due_dtime",
        "create_dtime",
        "end_dtime",
        "curr_employeenumber",
        "curr_username",
        *[f"curr_{name}" for name in PERSON[1:]],
        "init_employeenumber",
        "init_username",
        *[f"init_{name}" for name in PERSON[1:] + BRANCH],
        state.alias("state"),
    ]


def process_flow(
    tasks: DataFrame,
    processes: DataFrame,
    employees: DataFrame,
    incidents: DataFrame,
    executions: DataFrame,
) -> DataFrame:
    """One row per process and open task. Reports sort it (``newest_first``);
    a stored table has no order, and sorting would compute the joins twice."""
    rows = _process_rows(tasks, processes, employees, incidents, executions, None)
    return rows.select(
        *_shown(False),
        keep_if(F.col("state") == "true", F.col("completed_state")).alias("completed_state"),
        "incident_msg_",
        "error_dtime",
    )


def newest_first(rows: DataFrame) -> DataFrame:
    return order_output(rows, [("start_dtime", "desc")])


def process_steps(
    tasks: DataFrame,
    processes: DataFrame,
    employees: DataFrame,
    incidents: DataFrame,
    executions: DataFrame,
) -> DataFrame:
    """The same with one row per step of the process."""
    steps = (
        tasks.where(F.col("proc_def_id_").isNotNull())
        .select(
            F.col("proc_def_id_").alias("_step_proc"),
            "step_id",
            "activity_inst_id",
            "all_step",
            F.col("create_dtime").alias("date_start_t"),
            mixed_timestamp(F.col("date_end_t")).alias("date_end_t"),
            "user_state",
        )
        .distinct()
    )
    step_keys = tasks.select(F.col("proc_def_id_").alias("_step_proc"))
    rows = _process_rows(tasks, processes, employees, incidents, executions, steps, step_keys)
    return rows.select(
        *_shown(True),
        *STEP,
        keep_if(F.col("state") == "true", F.col("completed_state")).alias("completed_state"),
        "incident_msg_",
        "error_dtime",
    )
