"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def build_session(
    app: str = "starmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the settings the jobs rely on; a cluster's own settings win where none is given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    """Whether the session says that it is local; one that says nothing may belong to a remote cluster."""
    master = spark.conf.get("spark.master", None)
    return bool(master) and master.startswith("local") and not master.startswith("local-cluster")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it gets a temporary folder, one per application.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="starmart-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other job uses."""
    path = f"{scratch_root(spark)}/starmart/{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.conf.get("spark.app.id", "local"), []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """The scratch paths that this application was given so far."""
    return list(_MADE.get(spark.conf.get("spark.app.id", "local"), []))


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders, such as scratch copies or old versions of tables that nobody reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def check_warehouse_place(spark: SparkSession, location: str | None) -> None:
    """Refuse to put tables into a folder of one machine of a cluster."""
    if location or _is_local(spark):
        return
    default = spark.conf.get("spark.sql.warehouse.dir", "")
    if not default or default.startswith(("file:", "/")) or ":" not in default:
        raise RuntimeError("give a location for the tables, or set spark.sql.warehouse.dir to a shared folder")
