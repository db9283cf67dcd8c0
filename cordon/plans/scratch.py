"""Where intermediate tables are written.

Always under the session's ``spark.checkpoint.dir`` (a folder every executor
can reach on a cluster).  Only a single-machine session (master ``local``) may
leave it unset, as tests do: a private temporary folder is then chosen and
registered as the context's checkpoint folder.  On a cluster an unset property
is an error, since a machine-local folder would lose rows.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_KEY = "spark.checkpoint.dir"
_ROOTS: dict[str, str] = {}
_LOCK = threading.Lock()


def checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    app = sc.applicationId
    with _LOCK:
        root = _ROOTS.get(app)
        if root is None:
            root = (sc.getConf().get(_KEY, None) or "").strip()
            if not root:
                if not re.match(r"local(\[|$)", sc.master):
                    raise ValueError(f"set {_KEY} to a folder that all executors share")
                root = tempfile.mkdtemp(prefix="cordon-ckpt-")
            root = root.rstrip("/")
            sc.setCheckpointDir(root)
            _ROOTS[app] = root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one written table."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark)}/cordon/{app}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what this application has written under the checkpoint folder
    (call it when no frame that reads those tables is needed any more)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{checkpoint_root(spark)}/cordon/{spark.sparkContext.applicationId}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
