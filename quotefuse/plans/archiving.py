"""Byte-exact archive of files (K10): raw payloads, processed snapshots and logs.

The driver lists the files, tasks copy them: each file is streamed in chunks to a
draft beside its target, read back, compared by size and SHA-256, and moved into
place, so a retried task or a lost executor leaves whole files only. Every file
has an outcome (bytes, checksum, error); an unreadable file is an error and stops
no other. Files that a later archive of the same day does not have are removed,
so a day holds what its last archive held.

Tasks open paths with pyarrow's file systems (local or mounted folders, s3, gs,
hdfs where libhdfs is installed).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotefuse.session import scratch_path

CHUNK = 4 << 20
OUTCOME = "source string, cible string, octets long, sha256 string, erreur string"


def hadoop_fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - listings and removals only
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001


def listed(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(path, path below ``folder``) of all files; markers and drafts (names in _ or .) are not data."""
    fs, p = hadoop_fs(spark, folder)
    if not fs.exists(p):
        return []
    base, out, found = fs.getFileStatus(p).getPath().toString().rstrip("/"), [], fs.listFiles(p, True)
    while found.hasNext():
        path = found.next().getPath().toString()
        below = path[len(base):].lstrip("/") or path.rpartition("/")[2]
        if not any(part[:1] in "_." for part in below.split("/")):
            out.append((path, below))
    return sorted(out)


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path)


def _digest(fs: pafs.FileSystem, path: str) -> tuple[int, str]:
    size, seen = 0, hashlib.sha256()
    with fs.open_input_stream(path) as src:
        while part := src.read(CHUNK):
            seen.update(part)
            size += len(part)
    return size, seen.hexdigest()


def copy_file(source: str, target: str) -> tuple[int, str]:
    """Copies one file through a draft; its bytes and checksum, read back from the copy."""
    (src_fs, src), (dst_fs, dst) = _opened(source), _opened(target)
    dst_fs.create_dir(dst.rpartition("/")[0], recursive=True)
    draft = f"{dst.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    size, seen = 0, hashlib.sha256()
    try:
        with src_fs.open_input_stream(src) as inp, dst_fs.open_output_stream(draft) as out:
            while part := inp.read(CHUNK):
                seen.update(part)
                size += len(part)
                out.write(part)
        if _digest(dst_fs, draft) != (size, seen.hexdigest()):
            raise OSError("the copy differs from its source")
        dst_fs.move(draft, dst)
    except BaseException:
        if dst_fs.get_file_info(draft).type != pafs.FileType.NotFound:
            dst_fs.delete_file(draft)
        raise
    return size, seen.hexdigest()


def copy_files(spark: SparkSession, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """One row per (source, target) with its outcome, stored before it is returned."""
    pairs = list(pairs)

    def run(batches):
        for b in batches:
            rows = []
            for source, target in zip(b.column("source").to_pylist(), b.column("cible").to_pylist()):
                try:
                    rows.append((*copy_file(source, target), None))
                except (OSError, pa.ArrowException) as e:
                    rows.append((None, None, f"{type(e).__name__}: {e}"[:500]))
            size, seen, error = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("source"), b.column("cible"), pa.array(size, pa.int64()), pa.array(seen, pa.string()), pa.array(error, pa.string())],
                ["source", "cible", "octets", "sha256", "erreur"])

    tasks = max(1, min(len(pairs), 4 * spark.sparkContext.defaultParallelism))
    path = scratch_path(spark, "archive-outcome")
    (spark.createDataFrame(pairs, "source string, cible string").repartition(tasks)
     .mapInArrow(run, OUTCOME).write.parquet(path))
    return spark.read.schema(OUTCOME).parquet(path)


def mirror(spark: SparkSession, folders: Iterable[tuple[str, str]], target: str, required: Iterable[str] = ()) -> DataFrame:
    """Copies ``folders`` (folder, name below ``target``) and removes files of an earlier
    archive that are not among them. A folder of ``required`` without files is an error row."""
    folders, required = list(folders), set(required)
    pairs, missing = [], []
    for folder, name in folders:
        found = listed(spark, folder)
        pairs += [(path, f"{target}/{name}/{below}") for path, below in found]
        if not found and folder in required:
            missing.append((folder, f"{target}/{name}", None, None, "absent"))
    kept = {t for _, t in pairs}
    for _, name in folders:
        for path, below in listed(spark, f"{target}/{name}"):
            if f"{target}/{name}/{below}" not in kept:
                fs, p = hadoop_fs(spark, path)
                fs.delete(p, False)
    return copy_files(spark, pairs).unionByName(spark.createDataFrame(missing, OUTCOME))


def counts(outcome: DataFrame) -> dict[str, int]:
    """nb_ok, nb_erreurs and octets of an archive step."""
    row = outcome.agg(F.count_if(F.col("erreur").isNull()).alias("nb_ok"), F.count_if(F.col("erreur").isNotNull()).alias("nb_erreurs"),
                      F.coalesce(F.sum("octets"), F.lit(0)).alias("octets")).first()
    return row.asDict()
