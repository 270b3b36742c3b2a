"""Files that say that something is done: whole or not there, and never replaced."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def commit_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file aside and rename it to ``path``; False if that name is taken.

    A job that dies in between leaves a hidden file that no reader sees. Renaming is one step
    in stores such as HDFS; on object stores use a committer-aware file system.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    aside, file = (jvm.org.apache.hadoop.fs.Path(p) for p in (os.path.join(os.path.dirname(path), f"_{uuid.uuid4().hex}"), path))
    system = file.getFileSystem(conf)
    out = system.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs.Options, "Rename")
    never = spark.sparkContext._gateway.new_array(rename, 1)
    never[0] = rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(file.toUri(), conf).rename(aside, file, never)
    except Py4JJavaError as problem:
        system.delete(aside, False)
        if not system.exists(file):
            raise problem
        return False
    return True
