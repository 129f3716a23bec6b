"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

import starloom


def build_session(app: str = "starloom", master: str = "local[8]", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "8g"))
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folders of local applications whose session names none: a core setting cannot be set once the context runs.
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under the checkpoint folder the cluster names.

    Without that setting a local session gets a temporary folder; a cluster
    session fails, since no executor could read another machine's folder.
    """
    application = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folders.setdefault(application, "") or tempfile.mkdtemp(prefix="starloom-")
        _own_folders[application] = base
    return f"{base.rstrip('/')}/starloom/{application}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def ship_code(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, once per application."""
    if getattr(spark.sparkContext, "_starloom_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(starloom.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-code-"), "starloom_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.join("starloom", os.path.relpath(file, top)))
    spark.sparkContext.addPyFile(path)
    spark.sparkContext._starloom_shipped = True
