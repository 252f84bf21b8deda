"""Session helpers: the shared work folder and tables written to it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
#: Paths of the tables that the innermost ``scratch`` owns.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)
#: Paths that outlive the scope that owns them.
_KEPT: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may do without the setting; it then gets a
    temporary folder of its own, which goes when Python ends. On a cluster a
    ``file:`` folder has to be one that all machines mount.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="telemill-")
        atexit.register(shutil.rmtree, _LOCAL_DIRS[app], ignore_errors=True)
    return _LOCAL_DIRS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder wherever Hadoop reaches it; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage, survives executor loss, and gives the planner true file sizes,
    so whether the table is broadcast is decided on its checked size
    (``spark.sql.autoBroadcastJoinThreshold``) with a shuffle join beyond it. Inside
    ``scratch`` the table goes when the scope ends.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Own the tables that ``materialize`` stores in this scope, and delete them at its end.

    The tables go also when the scope ends by an error. What the scope returns must not
    read them any more: it is stored elsewhere, or stored and named by ``keep``.
    """
    owned: list[str] = []
    token = _OWNED.set(owned)
    try:
        yield
    finally:
        _OWNED.reset(token)
        outer = _OWNED.get()
        for path in owned:
            if path not in _KEPT:
                delete(spark, path)
            elif outer is not None:
                _KEPT.discard(path)
                outer.append(path)


def keep(df: DataFrame) -> DataFrame:
    """Hand a table stored by ``materialize`` on to the scope outside this one, if there is one."""
    _KEPT.add(df._stored_at)
    return df


def release(*tables: DataFrame | None) -> None:
    """Delete tables stored by ``materialize`` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path is not None:
            delete(df.sparkSession, path)
            owned = _OWNED.get()
            if owned is not None and path in owned:
                owned.remove(path)


def use_compiled_code(spark: SparkSession) -> None:
    """Keep very wide stages out of methods the JVM will not compile.

    HotSpot leaves methods over 8,000 bytes of code to its interpreter. With the
    limit set, Spark falls back to per-operator code for such stages, which is
    split into small methods. It holds for the whole session, so builds don't set it;
    call this before large builds. A value set by the user stays.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, "8000")
