"""Where intermediate tables go, and how long the shuffle files behind them stay."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
# By session: threads inside `freed_shuffles`, and the setting outside.
_inside: dict[str, tuple[int, str | None]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the session names in `spark.checkpoint.dir`.

    A cluster session that names none is an error. A local one, where driver and tasks are one process, gets a folder
    of its own, the same for its lifetime, below the one in `TALLYHOUSE_SCRATCH` or else the temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or _OWN.get(spark.sparkContext.applicationId)
    if shared is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _OWN[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="tallyhouse-", dir=os.environ.get("TALLYHOUSE_SCRATCH"))
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run inside leave no shuffle files: they go as each query ends.

    Else they stay until the driver happens to collect its garbage, so the shuffles of all steps of a job add up on the
    executors' disks. The setting is put back at the end; threads of one session share it.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        count, outside = _inside.get(session) or (0, spark.conf.get(_FREED, None))
        _inside[session] = count + 1, outside
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _lock:
            count, outside = _inside[session]
            if count > 1:
                _inside[session] = count - 1, outside
            else:
                del _inside[session]
                spark.conf.unset(_FREED) if outside is None else spark.conf.set(_FREED, outside)
