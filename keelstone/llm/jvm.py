"""Java classes of this subpackage in Spark's own JVMs: Janino, which Spark brings for its generated code, compiles them on the driver; executors get them as a jar."""

from __future__ import annotations

import hashlib
import uuid
import zipfile
from importlib.resources import files
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_loaders: dict[tuple[str, str], object] = {}


def reachable(spark: SparkSession) -> bool:
    """Whether the session has a JVM at hand; by Spark Connect it has none."""
    return getattr(spark, "_jsparkSession", None) is not None


def loader(spark: SparkSession, name: str):
    """A class loader with the classes of name.java, which stands beside this file; the jar is added once for each application."""
    source = files(__package__).joinpath(f"{name}.java").read_text()
    sc = spark.sparkContext
    key = sc.applicationId, hashlib.sha256(source.encode()).hexdigest()
    if key not in _loaders:
        compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(spark._jsparkSession.getClass().getClassLoader())
        compiler.cook(source)
        jar = Path(sc._temp_dir, f"{name}-{uuid.uuid4().hex}.jar")
        with zipfile.ZipFile(jar, "w") as out:
            for k, code in dict(compiler.getBytecodes()).items():
                out.writestr(k.replace(".", "/") + ".class", bytes(code))
        sc._jsc.addJar(jar.as_uri())
        _loaders[key] = compiler.getClassLoader()
    return _loaders[key]


def new(spark: SparkSession, name: str, inner: str):
    """An object of the nested class inner of name.java."""
    return loader(spark, name).loadClass(f"keelstone.{name}${inner}").newInstance()


def map_partitions(df: DataFrame, function, schema: str) -> DataFrame:
    """What function, a MapPartitionsFunction of rows, makes of each partition, in its order."""
    jvm = df.sparkSession.sparkContext._jvm
    encoder = jvm.org.apache.spark.sql.Encoders.row(jvm.org.apache.spark.sql.types.StructType.fromDDL(schema))
    return DataFrame(df._jdf.mapPartitions(function, encoder), df.sparkSession)
