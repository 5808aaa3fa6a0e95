"""The folder that driver and executors share, for files that an audit makes."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new place below spark.checkpoint.dir; where that is unset, only a local session has a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("spark.checkpoint.dir is unset: files that executors read need a folder that all of them share")
        root = f"file://{spark._jvm.System.getProperty('java.io.tmpdir')}/fiscora-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_file(uri: str, data: bytes) -> str:
    """Write bytes at a URI, with its folders; returns the URI."""
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(uri)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    with store.open_output_stream(place) as out:
        out.write(data)
    return uri
