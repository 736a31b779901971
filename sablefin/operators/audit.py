"""Tamper-evident audit chain, manifests, and stable sinks.

A chain is sequential by definition, but little of it needs to be. Numbering, canonical texts and writing are parallel;
what is left, one hash a record, runs on executors a segment at a time, and only the last hash of a segment is handed
on to the next. Verifying is parallel: each row recomputes its own content hash and compares its previous hash with the
row before.
"""

from __future__ import annotations

import ctypes
import hashlib
import json
import math
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from pathlib import Path
from typing import Any
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sablefin.operators.ordering import numbered
from sablefin.session import settled_path, ship

#: Records that one task links, and lines of a file.
SEGMENT = 250_000
GENESIS = "0" * 64
FIELDS = ("sequence", "event_type", "rule_version", "subject_id", "occurred_at", "decision", "input_snapshot", "scoring_breakdown", "previous_hash")
SCHEMA = (
    "sequence bigint, event_type string, rule_version string, subject_id string, occurred_at string, decision string, "
    "input_snapshot string, scoring_breakdown string, previous_hash string, content_hash string"
)


class ChainError(ValueError):
    """The audit chain doesn't hold."""


def _plain(v: Any, digits: int) -> Any:
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, digits)
    if isinstance(v, dict):
        return {str(k): _plain(x, digits) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [_plain(x, digits) for x in v]
    return v


def canonical(v: Any, digits: int = 8) -> str:
    """JSON with sorted keys, no spaces, floats rounded: one text for one value."""
    return json.dumps(_plain(v, digits), sort_keys=True, separators=(",", ":"))


def content_hash(record: dict[str, Any]) -> str:
    """sha256 over the canonical record; snapshots are held as canonical JSON text."""
    body = {k: record[k] for k in FIELDS}
    for k in ("input_snapshot", "scoring_breakdown"):
        body[k] = json.loads(body[k]) if isinstance(body[k], str) else body[k]
    return hashlib.sha256(canonical(body).encode()).hexdigest()


def chain(events: Iterable[dict[str, Any]], start: int = 0, previous: str = GENESIS) -> Iterator[dict[str, Any]]:
    """Records with sequence, previous and content hash, appended to a chain that ended at ``previous``."""
    for n, e in enumerate(events, start):
        r = {**e, "sequence": n, "previous_hash": previous}
        for k in ("input_snapshot", "scoring_breakdown"):
            r[k] = canonical(r.get(k) or {})
        r["content_hash"] = previous = content_hash(r)
        yield r


def _halves(r: dict[str, Any]) -> tuple[str, str]:
    """What stands before and after the previous hash in the canonical text of a record: keys are sorted, so it splits there."""
    before, after = {}, {}
    for k in FIELDS:
        if k != "previous_hash":
            (before if k < "previous_hash" else after)[k] = json.loads(r[k]) if k in ("input_snapshot", "scoring_breakdown") else r[k]
    return canonical(before)[:-1] + ',"previous_hash":"', '",' + canonical(after)[1:]


_PREPARED = "sequence bigint, event_type string, rule_version string, subject_id string, occurred_at string, decision string, input_snapshot string, scoring_breakdown string, _head string, _tail string"


def build(alerts: DataFrame, order: list[str], version: str, kind: str, start: int = 0, previous: str = GENESIS, segment: int = SEGMENT) -> DataFrame:
    """``alerts``(subject_id, occurred_at, decision, snapshot, breakdown: JSON text) as chained records (SCHEMA), in ``order``, which is total.

    They continue a chain of ``start`` records whose last hash is ``previous``. No record goes through the driver: it sees the number of
    segments and one hash for each. Null snapshots and breakdowns are empty objects.
    """
    spark = alerts.sparkSession
    ship(spark)
    cols = [c.split()[0] for c in _PREPARED.split(", ")]

    def prepare(batches):
        for b in batches:
            out: dict[str, list] = {c: [] for c in cols}
            for r in b.to_pylist():
                r = {**r, "event_type": kind, "rule_version": version}
                for k, raw in (("input_snapshot", "snapshot"), ("scoring_breakdown", "breakdown")):
                    r[k] = canonical(json.loads(r[raw] or "{}") or {})
                r["_head"], r["_tail"] = _halves(r)
                for c in cols:
                    out[c].append(r[c])
            yield pa.RecordBatch.from_arrays([pa.array(out[c], pa.int64() if c == "sequence" else pa.string()) for c in cols], names=cols)

    rows = numbered(alerts, list(order), "sequence", start).select("sequence", *(F.col(c).cast("string").alias(c) for c in ("subject_id", "occurred_at", "decision", "snapshot", "breakdown")))
    place = F.floor((F.col("sequence") - start) / segment).cast("int")
    source, target = (settled_path(spark, f"audit-{n}") for n in ("prepared", "records"))
    rows.mapInArrow(prepare, _PREPARED).withColumn("_segment", place).write.partitionBy("_segment").parquet(source, compression="zstd")
    last = spark.read.schema(_PREPARED + ", _segment int").parquet(source).agg(F.max("_segment")).first()[0]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    if last is None:
        return spark.createDataFrame([], SCHEMA)
    for k in range(last + 1):

        def link(batches, previous=previous):
            for b in batches:
                before, own = [], []
                for head, tail in zip(b.column("_head").to_pylist(), b.column("_tail").to_pylist(), strict=True):
                    before.append(previous)
                    previous = hashlib.sha256((head + previous + tail).encode()).hexdigest()
                    own.append(previous)
                made = {"previous_hash": pa.array(before, pa.string()), "content_hash": pa.array(own, pa.string())}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else b.column(c) for c in names], names=names)

        some = spark.read.schema(_PREPARED).parquet(f"{source}/_segment={k}")
        # one task links a segment, of bounded size; its rows are slim and the sort spills
        some.repartition(1).sortWithinPartitions("sequence").mapInArrow(link, SCHEMA).write.parquet(f"{target}/{k:09d}", compression="zstd")
        previous = spark.read.schema(SCHEMA).parquet(f"{target}/{k:09d}").agg(F.max_by("content_hash", "sequence")).first()[0]
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(target)


def end(records: DataFrame) -> tuple[int, str]:
    """(records, last hash): where the next chain goes on."""
    n, last = records.agg(F.max("sequence") + 1, F.max_by("content_hash", "sequence")).first()
    return n or 0, last or GENESIS


@F.pandas_udf(T.StringType())
def _rehash(rows: pd.DataFrame) -> pd.Series:
    return pd.Series([content_hash({k: (int(v) if k == "sequence" else v) for k, v in r.items()}) for r in rows.to_dict("records")], dtype=object)


def breaks(records: DataFrame, slice_rows: int = 100_000) -> DataFrame:
    """(sequence, problem): what doesn't hold, by sequence, previous hash or content. Empty: the chain holds.

    Neighbours meet by an equi-join on the sequence, so no task sees the whole chain; a gap shows
    as a record whose predecessor is missing.
    """
    before = records.select((F.col("sequence") + 1).alias("_next"), F.col("content_hash").alias("_before"))
    d = records.join(before, F.col("sequence") == F.col("_next"), "left")
    d = d.withColumn("_own", _rehash(F.struct(*FIELDS)))
    first = F.col("sequence") == 0
    problem = (
        F.when(~first & F.col("_before").isNull(), "sequence")
        .when(F.col("previous_hash") != F.when(first, GENESIS).otherwise(F.col("_before")), "previous_hash")
        .when(F.col("content_hash") != F.col("_own"), "content_hash")
    )
    return d.select("sequence", problem.alias("problem")).where("problem is not null")


def verify(records: DataFrame) -> int:
    """Number of records; raises ChainError at the first break or repeated sequence."""
    bad = breaks(records).orderBy("sequence").first()
    if bad:
        raise ChainError(f"record {bad['sequence']}: {bad['problem']} doesn't hold")
    n, d = records.agg(F.count(F.lit(1)), F.countDistinct("sequence")).first()
    if n != d:
        raise ChainError("a sequence number is used twice")
    return n


def summary(records: DataFrame) -> DataFrame:
    return records.groupBy("event_type", "decision").agg(F.count(F.lit(1)).alias("records"))


def write_jsonl(records: DataFrame, folder: str, lines: int = SEGMENT) -> int:
    """Canonical JSON lines, sorted by sequence, in files of ``lines`` records named by their place; executors write them.

    Equal records give equal names and bytes. Returns the number of records.
    """
    spark = records.sparkSession
    ship(spark)

    def text(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("_file"), pa.array([canonical({k: v for k, v in r.items() if k != "_file"}) for r in b.to_pylist()], pa.string())], names=["_file", "value"])

    placed = records.withColumn("_file", F.format_string("%09d", F.floor(F.col("sequence") / lines).cast("long")))
    dealt = placed.repartition("_file").sortWithinPartitions("_file", "sequence")
    dealt.mapInArrow(text, "_file string, value string").write.partitionBy("_file").text(folder)
    _flatten(spark, folder, "_file=", ".jsonl")
    return spark.read.text(folder).count()


def _flatten(spark: SparkSession, folder: str, prefix: str, suffix: str) -> None:
    """Move each partition's one file up, named by the partition. File names only; their content isn't touched."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for sub in fs.listStatus(path(folder)):
        if sub.isDirectory() and sub.getPath().getName().startswith(prefix):
            name = sub.getPath().getName()[len(prefix) :]
            own = [f.getPath() for f in fs.listStatus(sub.getPath()) if not f.getPath().getName().startswith((".", "_"))]
            if len(own) != 1 or not fs.rename(own[0], path(f"{folder}/{name}{suffix}")):
                raise OSError(f"{len(own)} files in {sub.getPath()}")
            fs.delete(sub.getPath(), True)


def read_jsonl(spark, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)


def run_id(seed: int, versions: list[str]) -> str:
    return hashlib.sha256("|".join([str(seed), *sorted(versions)]).encode()).hexdigest()[:16]


def write_csv(df: DataFrame, path: Path, order: list[str], digits: int = 6) -> int:
    """One stable CSV of a small result: sorted, LF, floats with ``digits`` decimals; streamed row by row."""
    n, cols = 0, df.columns
    cell = lambda v: "" if v is None else f"{v:.{digits}f}" if isinstance(v, float) else str(v)
    quote = lambda s: '"' + s.replace('"', '""') + '"' if any(c in s for c in ',"\n') else s
    with path.open("w", encoding="utf-8", newline="\n") as f:
        f.write(",".join(cols) + "\n")
        for r in df.orderBy(*order).toLocalIterator():
            f.write(",".join(quote(cell(r[c])) for c in cols) + "\n")
            n += 1
    return n


def write_json(value: Any, path: Path) -> None:
    path.write_text(json.dumps(_plain(value, 6), sort_keys=True, indent=2) + "\n", encoding="utf-8", newline="\n")


def sha256_file(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def manifest(folder: Path, volatile: tuple[str, ...] = ()) -> dict[str, str]:
    """name -> sha256 of every file below ``folder`` that isn't ``volatile``; for a few small files of this machine.

    Hidden files and marks of Spark's writers don't count, as in ``manifest_of``.
    """
    seen = lambda p: p.is_file() and p.name not in volatile and not p.name.startswith((".", "_"))
    return {str(p.relative_to(folder)): sha256_file(p) for p in sorted(folder.rglob("*")) if seen(p)}


def diff_manifests(a: dict[str, str], b: dict[str, str]) -> dict[str, list[str]]:
    both = a.keys() & b.keys()
    return {"only_left": sorted(a.keys() - b.keys()), "only_right": sorted(b.keys() - a.keys()), "differ": sorted(k for k in both if a[k] != b[k])}


@cache
def _openssl() -> ctypes.CDLL | None:
    """The OpenSSL that hashlib is linked to, whose SHA-256 keeps its state in plain memory; None if it can't be reached."""
    try:
        import _hashlib

        lib = ctypes.CDLL(_hashlib.__file__)
        lib.SHA256_Update.argtypes = (ctypes.c_char_p, ctypes.c_char_p, ctypes.c_size_t)
        return lib if lib.SHA256_Init and lib.SHA256_Final else None
    except (ImportError, AttributeError, OSError):
        return None


class Sha256:
    """SHA-256 whose state can be handed on, from task to task: ``state`` is SHA256_CTX, plain numbers without pointers."""

    SIZE = 112

    def __init__(self, state: bytes | None = None) -> None:
        self._ctx = ctypes.create_string_buffer(state or b"", self.SIZE)
        if state is None:
            _openssl().SHA256_Init(self._ctx)

    @property
    def state(self) -> bytes:
        return self._ctx.raw

    def update(self, data: bytes) -> None:
        _openssl().SHA256_Update(self._ctx, data, len(data))

    def hexdigest(self) -> str:
        out, copy = ctypes.create_string_buffer(32), ctypes.create_string_buffer(self.state, self.SIZE)
        _openssl().SHA256_Final(out, copy)
        return out.raw.hex()


#: Bytes of a file that a task hashes whole. Larger files are hashed by parts.
WHOLE = 128 << 20
_BOM = [0xEF, 0xBB, 0xBF]


def _no_glob(path: str) -> str:
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def _hash_by_parts(spark: SparkSession, path: str, size: int) -> str:
    """SHA-256 of a file, a task for each part that Spark reads of it (``spark.sql.files.maxPartitionBytes``), one after another.

    Each goes on from the state that the one before it left. Lines are what Spark reads of any file by parts, bytes as they are; what they
    don't show, a mark at the start and a separator at the end, is looked up. The hashed bytes are to be as many as the file has.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    f = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        marked = [f.read() for _ in _BOM] == _BOM
        f.seek(size - 1)
        ended = f.read() == ord("\n")
    finally:
        f.close()
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(_no_glob(path)).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_block_start").alias("at"))
    sha = Sha256()
    if marked:
        sha.update(bytes(_BOM))
    state, done, begun, last = sha.state, len(_BOM) if marked else 0, False, -1
    for k in range(lines.rdd.getNumPartitions()):

        def run(batches, state=state, begun=begun):
            sha, n, at = Sha256(state), 0, None
            for b in batches:
                # a separator stands before each line but the first
                data = b"\n".join([b""] * begun + b.column(0).to_pylist())
                if b.num_rows:
                    sha.update(data)
                    n, begun, at = n + len(data), True, b.column(1)[0].as_py()
            if at is not None:
                yield pa.RecordBatch.from_pylist([{"state": sha.state, "n": n, "at": at}])

        # a line longer than a part leaves the parts it runs through without a row
        for r in spark.sparkContext.runJob(lines.mapInArrow(run, "state binary, n bigint, at bigint").rdd, list, [k]):
            if r["at"] <= last:
                raise OSError(f"{path}: parts aren't in order")
            state, done, begun, last = bytes(r["state"]), done + r["n"], True, r["at"]
    sha = Sha256(state)
    if ended:
        sha.update(b"\n")
    if done + ended != size:
        raise OSError(f"{path}: {done + ended} of {size} bytes were read")
    return sha.hexdigest()


def manifest_of(spark: SparkSession, folder: str, volatile: tuple[str, ...] = ()) -> DataFrame:
    """(name, bytes, sha256) of every file below ``folder``, of any file system Spark reads, hashed by executors, a file a row.

    ``name`` is relative to the folder. Files named in ``volatile``, hidden ones and marks of Spark's writers are left out. Files of more
    than ``WHOLE`` bytes are hashed by parts, files side by side, the parts of one in turn; the driver sees a hash for each of them. Files named as
    compressed, which Spark doesn't read by parts, are read whole by their task and can't exceed 2 GB. No files give no rows.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark._jsc.hadoopConfiguration()
    root = path.getFileSystem(conf).makeQualified(path).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    # paths differ in the slashes after their scheme; from there on they begin with the folder's own path
    skip = len(re.sub("^[^:/]*:/*", "", root)) + 1
    inside = lambda p: F.substring(F.regexp_replace(p, "^[^:/]*:/*", ""), skip + 1, 1 << 30)
    rows = lambda df: df.select(inside(F.col("path")).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    # contents aren't read where only sizes are asked for
    large = [(r["path"], r["length"]) for r in files.where(F.col("length") > WHOLE).select("path", "length").collect()] if _openssl() else []
    if large:
        ship(spark)
        hashed = rows(files.where(F.col("length") <= WHOLE))
        packed = [p for p, _ in large if codecs.getCodec(spark._jvm.org.apache.hadoop.fs.Path(p)) is not None]
        if packed:
            hashed = hashed.unionAll(rows(spark.read.format("binaryFile").load([_no_glob(p) for p in packed])))
        parted = [(p, n) for p, n in large if p not in packed and p.rsplit("/", 1)[-1] not in volatile]
        with ThreadPoolExecutor(max(1, min(len(parted), spark.sparkContext.defaultParallelism))) as pool:
            made = list(pool.map(lambda x: (*x, _hash_by_parts(spark, *x)), parted))
        if made:
            hashed = hashed.unionAll(spark.createDataFrame(made, "path string, bytes bigint, sha256 string").select(inside(F.col("path")).alias("name"), "bytes", "sha256"))
    else:
        hashed = rows(files)
    # the scan leaves empty files out; their names are known from the listing
    listed = spark.createDataFrame([(unquote(p),) for p in files.inputFiles()], "path string").select(inside(F.col("path")).alias("name"))
    got = listed.join(hashed, "name", "left").select("name", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("sha256"))
    return got.where(~F.element_at(F.split("name", "/"), -1).isin(*volatile)) if volatile else got


def compare_manifests(a: DataFrame, b: DataFrame) -> DataFrame:
    """(name, state, left_sha256, right_sha256): 'only_left', 'only_right' or 'differs' of two manifests; files that agree are left out."""
    left, right = a.select("name", F.col("sha256").alias("left_sha256")), b.select("name", F.col("sha256").alias("right_sha256"))
    both = left.join(right, "name", "full_outer")
    state = F.when(F.col("right_sha256").isNull(), "only_left").when(F.col("left_sha256").isNull(), "only_right").when(F.col("left_sha256") != F.col("right_sha256"), "differs")
    return both.select("name", state.alias("state"), "left_sha256", "right_sha256").where("state is not null")
