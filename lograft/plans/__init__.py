"""Job plans (source -> parse -> filter -> route) and the registered queries."""

from lograft.plans.jobs import SnapshotTable, document_job, jobs_from_properties, relational_job, snapshot_job, start_job

__all__ = ["document_job", "relational_job", "snapshot_job", "SnapshotTable", "jobs_from_properties", "start_job"]
