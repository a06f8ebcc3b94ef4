"""One namespace over folders in any stores: Hadoop's client-side mount table.

Nothing is copied and no service runs: ``viewfs://<name>/raw`` is another name for the folder that ``raw`` is linked to.
Tables can so be moved between stores without a change in the jobs that read them.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme and authority of the store that it lies in."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(folder).toString()


def mount(spark: SparkSession, links: Mapping[str, str], name: str | None = None) -> str:
    """The base URI of a namespace in which each key of ``links`` is the folder it names.

    The table belongs to the session's settings, which travel with every scan and write. A name stays bound to its
    links, so each call has a new one unless told otherwise.
    """
    name = name or f"m{uuid.uuid4().hex}"
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    for key, path in links.items():
        settings.set(f"fs.viewfs.mounttable.{name}.link./{key.strip('/')}", qualified(spark, path))
    return f"viewfs://{name}"
