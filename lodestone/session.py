"""Session helpers: a configured session for tests/bench, the shared work
folder, and thin Hadoop FileSystem calls for directory renames and deletes.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS, S3, ABFS …); without it a cluster session is refused. Only in local mode,
where driver and executors are one process, do we set a folder of our own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "lodestone", extra: dict | None = None) -> SparkSession:
    """A session with this library's defaults. Master and shuffle partitions
    are the submit command's, unless given here (tests, bench)."""
    b = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if master:
        conf["spark.master"] = master
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; sets one only in local mode, if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="lodestone-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/lodestone/{label}-{uuid.uuid4().hex[:12]}"


# -- Hadoop FileSystem (metadata operations only; data never passes here) --

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def rename_path(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    if not fs.rename(s, d):
        raise OSError(f"rename {src} -> {dst} failed")


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def data_files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(folder below ``path``, file name) of the data files under ``path``;
    names that begin with a dot or underscore are no data."""
    fs, p = _fs(spark, path)
    found: list[tuple[str, str]] = []

    def walk(at, below: str) -> None:
        for s in fs.listStatus(at):
            name = str(s.getPath().getName())
            if name[0] in "._":
                continue
            if s.isDirectory():
                walk(s.getPath(), f"{below}{name}/")
            else:
                found.append((below, name))

    if fs.exists(p):
        walk(p, "")
    return found


def file_of_uri(spark: SparkSession, uri: str) -> str:
    """The path behind a URI such as ``_metadata.file_path`` gives (escapes undone)."""
    return str(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString())


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """A small file of metadata, complete under its name or not there: it is
    written beside it and renamed. An existing one is replaced, or refused."""
    beside = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    fs, p = _fs(spark, beside)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _, target = _fs(spark, path)
    if fs.exists(target):
        if not overwrite:
            fs.delete(p, False)
            raise FileExistsError(path)
        fs.delete(target, False)
    rename_path(spark, beside, path)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of metadata replaced in one step: readers find the old text
    or the new one, never none. The local file system replaces one file in a step,
    not the checksum file beside it too, so there it is written without one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    beside = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    fs, dst = _fs(spark, path)
    src = jvm.org.apache.hadoop.fs.Path(beside)
    if str(fs.getUri().getScheme()) == "file":
        raw = jvm.org.apache.hadoop.fs.FileSystem.getLocal(conf).getRaw()
        out = raw.create(src, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        # that of the text before, which would not fit the new one
        raw.delete(jvm.org.apache.hadoop.fs.Path(dst.getParent(), f".{dst.getName()}.crc"), False)
        if not raw.rename(src, dst):
            raise OSError(f"rename {beside} -> {path} failed")
        return
    write_text(spark, beside, text)
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), conf) \
        if src.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)
    context.rename(src, dst, over)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p) if s.isDirectory())


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["get_session", "ensure_checkpoint_dir", "work_dir", "path_exists",
           "rename_path", "delete_path", "data_files", "make_dirs", "list_dirs", "local_path", "file_of_uri",
           "write_text", "replace_text", "read_text"]
