"""Result writers.

* ``write_delimited``: ``sep``-separated text (``\\t`` for key/value output,
  ``,`` for comma output), replacing an existing target by default. Values
  are written as they are: no quoting, no escaping.
* ``write_text``: one pre-formatted text column per line.

Writes go through Spark's file commit protocol, so a lost executor's task is
re-run and only committed output becomes visible.

Replacing is safe: new output is written to a folder beside the target and
takes its place by renaming once it is complete, so a write that fails leaves
the old result readable. A driver that dies between the two renames leaves it
under the name of :func:`previous_path`, and the next write puts it back.

``single_file=True`` gives one part file without sending all rows through one
task: tasks write their parts in parallel, and the parts are joined in order
when the output is committed, by the file system where it can
(``FileSystem.concat``), else by copying their bytes through a fixed buffer.
"""

from __future__ import annotations

import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COPY_BUFFER = 1 << 20


def delimited_line(columns: list[str], sep: str, null_value: str = "") -> Column:
    """The columns as text, joined by ``sep``; nothing is quoted or escaped, NULL is ``null_value``."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(null_value)) for c in columns])


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "\t",
    mode: str = "overwrite",
    single_file: bool = False,
    null_value: str = "",
) -> None:
    _write(df.select(delimited_line(df.columns, sep, null_value).alias("line")), path, mode, single_file)


def write_text(df: DataFrame, path: str, column: str = "line", mode: str = "overwrite", single_file: bool = False) -> None:
    _write(df.select(column), path, mode, single_file)


def _write(lines: DataFrame, path: str, mode: str, single_file: bool) -> None:
    spark = lines.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if mode == "overwrite":
        _restore(fs, target)
    elif not single_file or (mode == "ignore" and fs.exists(target)):
        lines.write.mode(mode).text(path)
        return
    elif mode != "append" and fs.exists(target):
        raise FileExistsError(path)
    staged = _beside(target, f"staged-{uuid.uuid4().hex}")
    try:
        lines.write.text(staged.toString())
        if single_file:
            _join_parts(spark, fs, staged)
        if mode == "append":
            _move_parts(fs, staged, target)
        else:
            _replace(fs, staged, target)
    finally:
        fs.delete(staged, True)


def _child(folder, name: str):
    return folder.suffix(f"/{name}")


def _beside(target, kind: str):
    """A hidden folder next to the target, on the same file system."""
    return _child(target.getParent(), f"_{target.getName()}.{kind}")


def previous_path(path: str) -> str:
    """Where the old output waits while the new one takes its place."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{name}.previous"


def _restore(fs, target) -> None:
    """Puts back the old output of a replacement that never finished; drops what a finished one left."""
    previous = _beside(target, "previous")
    if fs.exists(previous):
        if fs.exists(target):
            fs.delete(previous, True)
        else:
            _rename(fs, previous, target)


def _replace(fs, staged, target) -> None:
    previous = _beside(target, "previous")
    if fs.exists(target):
        _rename(fs, target, previous)
    try:
        _rename(fs, staged, target)
    except Exception:
        if fs.exists(previous):
            _rename(fs, previous, target)
        raise
    fs.delete(previous, True)


def _rename(fs, old, new) -> None:
    if not fs.rename(old, new):
        raise OSError(f"cannot rename {old.toString()} to {new.toString()}")


def _parts(fs, folder) -> list:
    """The folder's part files in the order of their tasks, which is the order of the rows."""
    found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    return sorted(found, key=lambda p: p.getName())


def _move_parts(fs, staged, target) -> None:
    fs.mkdirs(target)
    for part in _parts(fs, staged):  # names hold the id of their write
        _rename(fs, part, _child(target, part.getName()))


def _join_parts(spark: SparkSession, fs, folder) -> None:
    """Makes the part files of a folder one, the first."""
    parts = _parts(fs, folder)
    if not parts:
        fs.create(_child(folder, f"part-00000-{uuid.uuid4().hex}.txt")).close()
    if len(parts) < 2:
        return
    jvm = spark._jvm
    rest = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
    for k, part in enumerate(parts[1:]):
        rest[k] = part
    try:
        fs.concat(parts[0], rest)
        return
    except UnsupportedOperationException:
        pass
    joined = _child(folder, "joined")
    out = fs.create(joined, True)
    try:
        for part in parts:
            stream = fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, COPY_BUFFER, False)
            finally:
                stream.close()
    finally:
        out.close()
    for part in parts:
        fs.delete(part, False)
    _rename(fs, joined, parts[0])


def read_delimited(spark, path: str, schema: str, sep: str = "\t", null_value: str = "") -> DataFrame:
    """Reads what :func:`write_delimited` wrote, for values that hold neither ``sep`` nor a line break."""
    fields = T._parse_datatype_string(schema).fields
    parts = F.split(F.col("value"), "[" + ("\\" + sep if sep in "\\]^-[" else sep) + "]", -1)
    columns = [F.nullif(F.get(parts, k), F.lit(null_value)).try_cast(f.dataType).alias(f.name) for k, f in enumerate(fields)]
    return spark.read.text(path).select(*columns)
