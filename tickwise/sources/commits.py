"""Commit records: small files that exist completely or not at all, and are written once.

A record is written beside its place and then moved there; the move fails if the place is taken, so of
several writers one wins and the others see that they lost. Tables use records as their log: data files
belong to a table only through a record that names them.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, record: dict) -> bool:
    """Writes ``record`` as JSON at ``path``; False if something is there already."""
    jvm, place, fs = _file_system(spark, path)
    aside = f".{place.getName()}.{uuid.uuid4().hex}"
    body = (json.dumps(record, sort_keys=True) + "\n").encode()
    fs.mkdirs(place.getParent())
    if fs.getScheme() == "file":        # a hard link is the atomic form of "move if absent" here
        final = place.toUri().getPath()
        temporary = os.path.join(os.path.dirname(final), aside)
        with open(temporary, "wb") as f:
            f.write(body)
        try:
            os.link(temporary, final)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(temporary)
    temporary = jvm.org.apache.hadoop.fs.Path(place.getParent(), aside)
    out = fs.create(temporary, False)
    out.write(bytearray(body))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(place), options)
        return True
    except Py4JJavaError as e:
        fs.delete(temporary, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the records in a folder, in order (an empty list if there is none yet)."""
    jvm, place, fs = _file_system(spark, folder)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if not s.getPath().getName().startswith("."))


def exists(spark: SparkSession, path: str) -> bool:
    _, place, fs = _file_system(spark, path)
    return fs.exists(place)


def read(spark: SparkSession, path: str) -> dict:
    """One record."""
    return json.loads(spark.read.text(path).first()[0])
