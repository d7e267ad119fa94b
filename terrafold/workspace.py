"""What a session needs: the package on its executors, and a shared folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from terrafold.sources.filesystem import resolve

_ROOTS: dict[str, str] = {}
_ATTACHED: set[str] = set()


def attach(spark: SparkSession) -> None:
    """Send this package to the executors, once an application.

    The archive lies in the shared folder and Spark's own file distribution carries it.
    """
    app = spark.sparkContext.applicationId
    if app in _ATTACHED:
        return
    package = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    uri = f"{shared_folder(spark)}/terrafold.zip"
    system, path = resolve(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(uri)
    _ATTACHED.add(app)


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor sees, private to this application.

    ``spark.checkpoint.dir`` names it. Only a local session may go without:
    there the driver's own temporary folder is shared by construction.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if base is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            base = tempfile.mkdtemp(prefix="terrafold-")
        _ROOTS[app] = f"{base.rstrip('/')}/terrafold-{uuid.uuid4().hex[:12]}"
    return _ROOTS[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and scan them back.

    What is used several times is computed once, a lost executor costs no more
    than the scan, and the optimizer learns the real size.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["stored_at"] = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``stored`` wrote for this very DataFrame; nothing may read it any more."""
    path = df.__dict__.pop("stored_at", None)
    if path is not None:
        system, root = resolve(path)
        system.delete_dir(root)
