"""Ledger batch jobs as Spark DataFrame plans: read, check, deduplicate, derive, gate, write, report."""

from tallybook.plans.job import Job
from tallybook.plans.jobs import annual_statements, daily_transactions, monthly_interest
from tallybook.plans.run import JobResult, run_all, run_job
from tallybook.session import get_session, shared_folder

__all__ = [
    "Job",
    "JobResult",
    "annual_statements",
    "daily_transactions",
    "get_session",
    "monthly_interest",
    "run_all",
    "run_job",
    "shared_folder",
]
