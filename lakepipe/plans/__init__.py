"""Whole jobs (query plans expressed with the DataFrame API) and the job base class."""

from .job import BatchJob, Destination, RunContext
from .runlog import RunStatus, append_run_record

__all__ = ["BatchJob", "Destination", "RunContext", "RunStatus", "append_run_record"]
