"""Session settings and the shared scratch location."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from typing import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_LOCAL_SCRATCH: dict[str, str] = {}
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: The JVM never compiles methods above this size: let Spark split such projections instead.
COMPILED_BYTES = "8000"


def build_session(app_name: str = "riskframe", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings the package relies on.

    Only semantics-bearing settings are forced (UTC, AQE). Sizing such as the
    number of shuffle partitions belongs to the cluster and is passed in ``conf``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        _METHOD_LIMIT: COMPILED_BYTES,
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """What runs inside has methods that the JVM compiles, in sessions that :func:`build_session` did not make as well."""
    before = spark.conf.get(_METHOD_LIMIT, None)
    spark.conf.set(_METHOD_LIMIT, COMPILED_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(_METHOD_LIMIT) if before is None else spark.conf.set(_METHOD_LIMIT, before)


def active_session(spark: SparkSession | None = None) -> SparkSession:
    """Return ``spark`` or the active session; fail clearly when there is none."""
    session = spark or SparkSession.getActiveSession()
    if session is None:
        raise RuntimeError("no active SparkSession; pass spark= explicitly")
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only when that is unset (local
    tests) a temporary folder of this machine stands in for it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="riskframe-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a reliable folder if the cluster set none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small driver-side result as a table, handed over as Arrow.

    The JVM keeps it as a local relation: no Python workers to read it, and its true size is
    known to the optimizer.
    """
    struct = T.StructType.fromDDL(schema)
    fields = to_arrow_schema(struct)
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(list(values), type=field.type) for values, field in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), struct)
