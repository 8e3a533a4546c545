"""Where queries write."""

from __future__ import annotations

import tempfile
import uuid


def scratch(spark) -> str:
    """A new folder in the one that all executors share; a local one only where Spark runs in one process (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not (spark.sparkContext.master + "[").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = base or tempfile.mkdtemp(prefix="sheetforge-")
    return f"{base.rstrip('/')}/plans-{uuid.uuid4().hex}"
