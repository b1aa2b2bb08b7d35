"""Geometry that needs a geometry library: Java functions over the one that Spark ships, registered as SQL functions.

The source is compiled once for each driver and the jar is handed to the session, which ships it to executors.
"""

from __future__ import annotations

import os
import pkgutil
import shutil
import subprocess
import tempfile
import zipfile
from functools import lru_cache
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: SQL name, Java class, return type.
FUNCTIONS = (
    ("ST_MakePoint", "Point", "binary"),
    ("geo_line", "Line", "binary"),
    ("geo_polygon", "RingPolygon", "binary"),
    ("geo_multipolygon", "Multi", "binary"),
    ("ST_Area", "Area", "double"),
    ("ST_Length", "Length", "double"),
    ("ST_GeometryType", "Type", "string"),
    ("ST_IsValid", "Valid", "boolean"),
    ("ST_IsSimple", "Simple", "boolean"),
    ("ST_IsEmpty", "Empty", "boolean"),
    ("geo_bounds", "Bounds", "array<double>"),
    ("geo_repair", "Repair", "binary"),
    ("ST_SimplifyPreserveTopology", "Simplify", "binary"),
    ("ST_Buffer", "Buffer", "binary"),
    ("ST_Intersects", "Intersects", "boolean"),
    ("ST_Contains", "Contains", "boolean"),
    ("ST_Intersection", "Intersection", "binary"),
    ("geo_union", "Union", "binary"),
    ("geo_linemerge", "Merge", "array<binary>"),
    ("geo_from_wkt", "FromWkt", "binary"),
    ("ST_AsText", "ToWkt", "string"),
    ("geo_clip", "Clip", "array<binary>"),
    ("geo_cells", "Cells", "array<binary>"),
    ("geo_hits", "Hits", "array<int>"),
)


def class_path(spark: SparkSession) -> str:
    """The class path of the running JVM, which has Spark's jars however Spark was installed (also as a zip)."""
    system = spark.sparkContext._jvm.java.lang.System
    parts = [p for p in system.getProperty("java.class.path").split(os.pathsep) if p]
    for home in (os.environ.get("SPARK_HOME"), system.getenv("SPARK_HOME")):
        if home:
            parts.append(f"{home}/jars/*")
    return os.pathsep.join(dict.fromkeys(parts))


def compile_java(spark: SparkSession, source: Path, classes: Path) -> None:
    """Compile with the compiler of the driver's own JVM, or with javac where that JVM has none."""
    args = ["-nowarn", "-cp", class_path(spark), "-d", str(classes), str(source)]
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    try:
        compiler = jvm.java.lang.Class.forName("com.sun.tools.javac.Main")
    except Py4JJavaError:
        compiler = None
    if compiler is not None:
        argv = gateway.new_array(jvm.java.lang.String, len(args))
        for i, a in enumerate(args):
            argv[i] = a
        errors = jvm.java.io.StringWriter()
        failed, message = jvm.com.sun.tools.javac.Main.compile(argv, jvm.java.io.PrintWriter(errors)), errors.toString()
    else:
        home = os.environ.get("JAVA_HOME") or jvm.java.lang.System.getProperty("java.home")
        javac = shutil.which("javac") or shutil.which("javac", path=f"{home}/bin")
        if not javac:
            raise RuntimeError("geometry functions need a Java compiler (a JDK) on the driver")
        done = subprocess.run([javac, *args], capture_output=True, text=True)
        failed, message = done.returncode, done.stderr
    if failed:
        raise RuntimeError(f"geometry functions do not compile:\n{message}")


@lru_cache(maxsize=1)
def jar_path(spark: SparkSession) -> str:
    """Compile the Java source to a jar in a temporary folder of the driver."""
    source = Path(__file__).with_name("java") / "tagloom" / "Geo.java"
    out = Path(tempfile.mkdtemp(prefix="tagloom-geo-"))
    text = pkgutil.get_data(__package__, "java/tagloom/Geo.java")  # also from a zip
    if not source.exists():
        source = out / "Geo.java"
        source.write_bytes(text)
    (out / "classes").mkdir()
    compile_java(spark, source, out / "classes")
    jar = out / "tagloom-geo.jar"
    with zipfile.ZipFile(jar, "w") as z:
        for f in sorted((out / "classes").rglob("*.class")):
            z.write(f, f.relative_to(out / "classes"))
    return str(jar)


def register(spark: SparkSession) -> SparkSession:
    """Make the functions known to the session; does nothing the second time."""
    if not spark.catalog.functionExists("geo_line"):
        spark.sql(f"ADD JAR '{jar_path(spark)}'")
        for name, cls, kind in FUNCTIONS:
            spark.udf.registerJavaFunction(name, f"tagloom.Geo${cls}", kind)
    return spark


def call(name: str, *cols: Column) -> Column:
    return F.call_function(name, *cols)


def st_x(name: str):
    return lambda *cols: call(name, *cols)


line, polygon, multipolygon, repair = (st_x(n) for n in ("geo_line", "geo_polygon", "geo_multipolygon", "geo_repair"))
area, size, bounds, kind = (st_x(n) for n in ("ST_Area", "ST_Length", "geo_bounds", "ST_GeometryType"))


def point(x: Column, y: Column) -> Column:
    return call("ST_MakePoint", x, y)


def generalize(geometry: Column, tolerance: float, validated: bool) -> Column:
    """Simplified with the tolerance to six decimals; a validated geometry is cleaned by a zero-width buffer."""
    out = call("ST_SimplifyPreserveTopology", geometry, F.lit(float(f"{tolerance:f}")))
    return call("ST_Buffer", out, F.lit(0.0)) if validated else out
