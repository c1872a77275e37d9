"""Many tiny files consolidated into few well-sized ones, every record once.

Steps: freeze a manifest of the files there are now; first-fit decreasing by size into bins of
`target_bytes`; parse every line once and write it down with its bin; rewrite the bins, in waves of at
most WAVE_BINS so that no job has more shuffle partitions than that; compare, bin by bin, the count and a
checksum of the content of what was parsed with what is read back; commit by renaming one small file onto
a name that was claimed exclusively. Readers follow the newest commit, so they see the old state or the
new one and never a part.

A record is a complete JSON object on a line of its own with the id key of its table. The newest
writing of an id wins (written_at, then file_id, then a hash of the text, so ties are settled); equal content
under different ids stays. Null, empty and broken payloads hold no record. Files larger than the
target get a bin of their own. An empty table commits an empty result.

Claims are atomic where the file system creates a file only if there is none: HDFS and local file systems; on
an object store the store has to support conditional writes. A claim whose writer died is taken over after an hour.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pavelens.session import Scratch

# The key that names a record, by table.
RECORD_KEY = {"Substance": "substance_id", "Strassenzustand": "area_id"}
#: Most files that one task packs; a pack of more files is cut by a hash, each part with one part-filled bin.
FILES_PER_PACK = 200_000
#: Bins that one job rewrites, and bins that one of its tasks takes at least, if there are more than cores.
WAVE_BINS, BINS_PER_TASK = 16_384, 4
#: Files up to which the plan (60 bytes a file) is broadcast to the parsing; beyond it the two are joined by a shuffle.
BROADCAST_FILES = 200_000
#: Seconds after which a claim without a commit counts as abandoned.
CLAIM_SECONDS = 3_600


def first_fit_decreasing(sizes: list[int], target: int) -> list[int]:
    """Bin number of each size. A tree of the free space finds the first bin that fits in log time."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    width = 1
    while width < max(1, len(sizes)):
        width *= 2
    free = [target] * (2 * width)
    out = [0] * len(sizes)
    for i in order:
        need, at = min(sizes[i], target), 1
        while at < width:
            at = 2 * at if free[2 * at] >= need else 2 * at + 1
        out[i] = at - width
        free[at] -= need
        while at > 1:
            at //= 2
            free[at] = max(free[2 * at], free[2 * at + 1])
    return out


def manifest_from_directory(spark: SparkSession, path: str, table_name: str, glob: str = "*") -> DataFrame:
    """The files below a directory in the shape that compact() takes. n_bytes is what the file system says."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.xxhash64("path").alias("file_id"), F.lit(table_name).alias("table_name"), F.col("path").alias("file_path"),
        F.col("modificationTime").alias("written_at"), F.col("length").alias("n_bytes"), F.decode("content", "utf-8").alias("payload"),
    )


def pack_files(manifest: DataFrame, target_bytes: int, files_per_pack: int = FILES_PER_PACK) -> DataFrame:
    """manifest(file_id, table_name, size) with bin string."""
    counted = manifest.groupBy("table_name").agg(F.count(F.lit(1)).alias("files"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("files") / files_per_pack)).cast("int")
    keyed = manifest.join(counted.select("table_name", parts.alias("parts")), "table_name")
    keyed = keyed.withColumn("part", F.pmod(F.xxhash64("file_id"), F.col("parts")).cast("int")).select("table_name", "part", "file_id", "size")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("file_id", kind="stable")
        bins = first_fit_decreasing(pdf["size"].tolist(), target_bytes)
        return pd.DataFrame({"table_name": pdf["table_name"], "file_id": pdf["file_id"], "bin": [f"{p:04d}-{b:06d}" for p, b in zip(pdf["part"], bins)]})

    return keyed.groupBy("table_name", "part").applyInPandas(pack, "table_name string, file_id bigint, bin string")


def records(files: DataFrame, keys: dict[str, str] = RECORD_KEY) -> DataFrame:
    """One row per complete JSON line with an id: the files' columns but payload, record_id bigint, line string."""
    keep = [F.col(f"`{c}`") for c in files.columns if c != "payload"]
    lines = files.select(*keep, F.explode(F.split("payload", r"\n")).alias("line")).withColumn("line", F.btrim("line", F.lit("\r\t ")))
    parsed = lines.filter(F.col("line").startswith("{") & F.col("line").endswith("}")).withColumn("_v", F.try_parse_json("line"))
    key = F.lit(None).cast("bigint")
    for name, k in keys.items():
        key = F.when(F.col("table_name") == name, F.try_variant_get("_v", f"$.{k}", "bigint")).otherwise(key)
    return parsed.withColumn("record_id", key).filter(F.col("record_id").isNotNull()).drop("_v")


@dataclass
class Compaction:
    data: DataFrame
    version: int
    files_in: int
    files_out: int
    n_records: int
    checksum: int


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, target: str) -> list[int]:
    fs, p = _fs(spark, f"{target}/_commits")
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(p) if s.getPath().getName().endswith(".json") and s.getPath().getName()[0].isdigit())


def _claim(spark: SparkSession, path: str) -> bool:
    """Create the file if there is none; whether this writer did."""
    fs, p = _fs(spark, path)
    if fs.getUri().getScheme() != "file":
        return bool(fs.createNewFile(p))
    try:
        os.close(os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        return True
    except FileExistsError:
        return False


def _commit(spark: SparkSession, target: str, entry: dict) -> int:
    """Claim the next version, write it under a hidden name and rename it; the claim lets one writer win."""
    version = (versions(spark, target) or [0])[-1] + 1
    fs, folder = _fs(spark, f"{target}/_commits")
    fs.mkdirs(folder)
    claim = f"{target}/_commits/{version:012d}.claim"
    _, p = _fs(spark, claim)
    if not _claim(spark, claim):
        old = fs.exists(p) and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 > CLAIM_SECONDS
        if not (old and fs.delete(p, False) and _claim(spark, claim)):
            raise RuntimeError(f"version {version} was committed by another writer")
    _, hidden = _fs(spark, f"{target}/_commits/.{uuid.uuid4().hex}")
    _, final = _fs(spark, f"{target}/_commits/{version:012d}.json")
    try:
        out = fs.create(hidden, False)
        out.write(bytearray(json.dumps(entry | {"version": version}).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(hidden, final):
            raise RuntimeError(f"version {version} was committed by another writer")
    finally:
        fs.delete(hidden, False)
        fs.delete(p, False)
    return version


def read_compacted(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The records of a committed version, the newest if none is named."""
    have = versions(spark, target)
    if not have:
        raise FileNotFoundError(f"nothing is committed in {target}")
    entry = json.loads(spark.read.text(f"{target}/_commits/{version or have[-1]:012d}.json", wholetext=True).first()[0])
    return spark.read.schema(_DATA).parquet(f"{target}/{entry['data']}")


_DATA = "record_id bigint, line string, written_at timestamp, file_id bigint, table_name string, bin string"


def _sums(df: DataFrame, content: Column) -> DataFrame:
    """(table_name, bin, n, x): records of each bin and a checksum of their keys and content."""
    return df.groupBy("table_name", "bin").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("table_name", "record_id", content)).alias("x"))


def compact(files: DataFrame, target: str, target_bytes: int = 128 << 20, keys: dict[str, str] = RECORD_KEY, wave_bins: int = WAVE_BINS) -> Compaction:
    """files(file_id, table_name, written_at, payload, …) rewritten into target, a folder all executors share.

    The caller keeps the tiny files until the commit; a failed or lost run leaves no commit behind.
    """
    scratch = Scratch(files.sparkSession, "compaction")
    try:
        return _compact(files, target, target_bytes, keys, wave_bins, scratch)
    finally:
        scratch.drop()


def _compact(files: DataFrame, target: str, target_bytes: int, keys: dict[str, str], wave_bins: int, scratch: Scratch) -> Compaction:
    spark = files.sparkSession
    never = F.lit("0001-01-01").cast("timestamp")  # stands for null while writings are compared
    slim = files.select("file_id", "table_name", F.coalesce("written_at", never).alias("written_at"), "payload")
    # the frozen manifest: what arrives later isn't in it; sizes are measured, not the writers' claims
    size = F.coalesce(F.octet_length("payload"), F.lit(0)).cast("bigint")
    manifest = scratch.keep(slim.groupBy("table_name", "file_id").agg(F.max(size).alias("size"), F.count(F.lit(1)).alias("rows")), "manifest")
    bins = scratch.keep(pack_files(manifest, target_bytes), "bins")
    n_files, n_bins = bins.count(), bins.select("table_name", "bin").distinct().count()
    waves = max(1, -(-n_bins // wave_bins))
    wave = F.pmod(F.xxhash64("table_name", "bin"), F.lit(waves)).cast("int").alias("wave")
    plan = bins.select("table_name", "file_id", "bin", wave)
    plan = F.broadcast(plan) if n_files <= BROADCAST_FILES else plan
    # parsed once: from here on a line has its key, its bin and a hash of its text
    lines = records(slim.join(plan, ["table_name", "file_id"]), keys).withColumn("hash", F.xxhash64("line"))
    lines.write.partitionBy("wave").option("compression", "zstd").parquet(scratch.path("lines"))
    lines = spark.read.schema(lines.schema).parquet(scratch.path("lines"))
    # which writing of a record wins is settled on keys and hashes alone
    newest = F.max(F.struct("written_at", "file_id", "hash", "bin", "wave")).alias("w")
    winners = scratch.keep(lines.groupBy("table_name", "record_id").agg(newest).select("table_name", "record_id", "w.*"), "winners")
    source = scratch.keep(_sums(winners, F.col("hash")), "source")
    staged = f"data/{uuid.uuid4().hex}"
    at, of = ["table_name", "bin"], ["table_name", "bin", "record_id"]
    # a bin's winners and lines come together by one shuffle of the lines; of equal lines of a winner the first stays
    wins = F.max(F.when(F.col("line").isNull(), F.struct("written_at", "file_id", "hash"))).over(W.partitionBy(*of))
    first = F.row_number().over(W.partitionBy(*of).orderBy(F.col("_mine").desc(), F.col("line").desc()))
    for k in range(waves):
        here = F.col("wave") == k
        both = lines.filter(here).select(*of, "written_at", "file_id", "hash", "line")
        both = both.union(winners.filter(here).select(*of, "written_at", "file_id", "hash", F.lit(None).cast("string")))
        few = -(-n_bins // waves)
        tasks = max(1, min(few, max(4 * spark.sparkContext.defaultParallelism, few // BINS_PER_TASK)))
        mine = F.col("line").isNotNull() & (F.struct("written_at", "file_id", "hash") == F.col("_wins"))
        placed = both.repartition(tasks, *at).withColumn("_wins", wins).withColumn("_mine", mine).withColumn("_first", first).filter("_mine and _first = 1")
        placed = placed.select("record_id", "line", F.when(F.col("written_at") > never, F.col("written_at")).alias("written_at"), "file_id", *at)
        placed.write.mode("append").partitionBy(*at).option("compression", "zstd").parquet(f"{target}/{staged}")
    written = spark.read.schema(_DATA).parquet(f"{target}/{staged}")
    result = _sums(written, F.xxhash64("line"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("n", "x")]
    other = result.select(*[F.col(c).alias(f"_{c}") for c in ("table_name", "bin", "n", "x")])
    check = source.join(other, (F.col("table_name") == F.col("_table_name")) & (F.col("bin") == F.col("_bin")), "full")
    total = check.agg(F.count_if(~(same[0] & same[1])).alias("bad"), F.count(F.lit(1)).alias("bins"), F.sum("n").alias("n"), F.bit_xor("x").alias("x")).first()
    if total["bad"]:
        raise RuntimeError(f"source and rewritten files differ in {total['bad']} of {total['bins']} bins; nothing is committed")
    files_in = manifest.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    entry = {"data": staged, "files_in": files_in, "bins": total["bins"], "records": total["n"] or 0, "checksum": total["x"] or 0}
    version = _commit(spark, target, entry)
    return Compaction(read_compacted(spark, target, version), version, files_in, total["bins"], entry["records"], entry["checksum"])


def file_plan(files: DataFrame, target_bytes: int = 128 << 20) -> DataFrame:
    """(table_name, bin, n_files, n_bytes) of the first-fit-decreasing plan for the files."""
    sized = files.select("table_name", "file_id", F.coalesce(F.octet_length("payload"), F.lit(0)).cast("bigint").alias("size")).groupBy("table_name", "file_id").agg(F.max("size").alias("size"))
    bins = pack_files(sized, target_bytes)
    return sized.join(bins, ["table_name", "file_id"]).groupBy("table_name", "bin").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes"))

