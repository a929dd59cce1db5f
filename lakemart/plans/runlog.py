"""Run ledger and audit rows, kept as append-only tables."""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from lakemart.operators.quality import DataQualityError, summary_text
from lakemart.plans.store import TableStore

log = logging.getLogger(__name__)

RUN_LOG = "run_log"
RUN_LOG_SCHEMA = """
    run_id string, table_name string, source string, endpoint string, params string,
    started_at timestamp, finished_at timestamp, duration_seconds double, status string,
    error string, files_processed bigint, files_written bigint, files_skipped bigint,
    records_read bigint, records_written bigint, rejected_records bigint
"""

# Audit table, its columns and outcomes.
AUDIT_TABLE = "TB_AUDITORIA_GOLD"
AUDIT_SCHEMA = """
    ID_EXECUCAO string, NME_TABELA string, DT_INICIO timestamp, DT_FIM timestamp,
    QTD_SEGUNDOS_DURACAO double, QTD_LIDOS bigint, QTD_PROCESSADOS bigint,
    QTD_INSERIDOS_ATUALIZADOS bigint, DESC_DQ_RESULTADO string, DESC_STATUS string
"""
SUCCESS, DQ_FAILED, KEY_FAILED, FAILED = "SUCESSO", "FALHA_DQ", "FALHA_DQ_PK", "FALHA"


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _append_quietly(store: TableStore, table: str, schema: str, row: dict) -> None:
    """A ledger that cannot be written never changes the outcome of the run."""
    try:
        store.append(store.spark.createDataFrame([row], schema).coalesce(1), table)
    except Exception as problem:
        log.warning("ledger row for %s not written: %s", table, problem)


def run_logged(store: TableStore, table: str, job, run_ts: dt.datetime, params=None, endpoint=None,
               source=None, empty_fails: bool = False, clock=utc_now):
    """Run ``job(run)`` and append its ledger row; returns (job result, row).

    ``job`` fills the counts of ``run``. A failure is recorded, then raised again;
    with ``empty_fails`` a job that returns nothing is a failure too.
    """
    counts = ("files_processed", "files_written", "files_skipped",
              "records_read", "records_written", "rejected_records")
    run = {"run_id": uuid.uuid4().hex[:12], "table_name": table, "source": source,
           "endpoint": endpoint or table, "params": json.dumps(params or {}),
           "started_at": run_ts, "error": None} | dict.fromkeys(counts, 0)
    began = clock()
    try:
        result = job(run)
        if result is None and empty_fails:
            raise ValueError(f"{table}: nothing was written, the input holds no data")
        run["status"] = "SUCCESS"
        return result, run
    except Exception as problem:
        run |= {"status": "FAILED", "error": str(problem)}
        raise
    finally:
        seconds = round((clock() - began).total_seconds(), 1)
        run |= {"finished_at": run_ts + dt.timedelta(seconds=seconds), "duration_seconds": seconds}
        _append_quietly(store, RUN_LOG, RUN_LOG_SCHEMA, run)


@dataclass
class Audit:
    """What one run reports; ``saving()`` marks the part where keys are checked."""

    table: str
    read: int = 0
    processed: int = 0
    results: dict[str, int] = field(default_factory=dict)
    status: str = SUCCESS
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))

    @contextmanager
    def saving(self):
        try:
            yield
        except RuntimeError:
            self.status = KEY_FAILED
            raise

    def row(self, started: dt.datetime, finished: dt.datetime) -> dict:
        stored = self.processed if self.status in (SUCCESS, DQ_FAILED) else 0
        return {
            "ID_EXECUCAO": self.run_id, "NME_TABELA": self.table, "DT_INICIO": started,
            "DT_FIM": finished, "QTD_SEGUNDOS_DURACAO": (finished - started).total_seconds(),
            "QTD_LIDOS": self.read, "QTD_PROCESSADOS": self.processed,
            "QTD_INSERIDOS_ATUALIZADOS": stored,
            "DESC_DQ_RESULTADO": summary_text(self.results), "DESC_STATUS": self.status,
        }


@contextmanager
def audit_run(store: TableStore, table: str, clock=utc_now):
    """One audit row per run whatever its outcome; the exception goes on."""
    audit, started = Audit(table), clock()
    try:
        yield audit
    except DataQualityError as problem:
        audit.status = DQ_FAILED
        audit.results |= problem.results
        raise
    except Exception:
        if audit.status == SUCCESS:
            audit.status = FAILED
        raise
    finally:
        # Quietly, so that a run's own exception is the one that is seen.
        _append_quietly(store, AUDIT_TABLE, AUDIT_SCHEMA, audit.row(started, clock()))
