"""WARC replicas and their fixity audit by Merkle trees.

Pages are written as compressed WARC files (a gzip member per record); a
manifest lists every record's place.  To
audit two replicas, each is hashed where it lies: records are the leaves, and
each node hashes the ordered offset range of up to 16 nodes below it, first
within a file, then over files, up to one root.  The bytes of a file after its
last record are a leaf too, with the file's true length, and files that the
manifest does not know, in either replica, are files of the tree.  So equal roots
mean equal replicas, byte for byte and file for file; otherwise only children of
differing nodes are looked at, level by level, down to what differs."""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from signalyard.llm.common import cut
from signalyard.llm.files import WholeFile, open_store, uri

#: Children of a node.
FANOUT = 16

_MANIFEST = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("file", T.LongType()),
                          T.StructField("nth", T.LongType()), T.StructField("offset", T.LongType()),
                          T.StructField("length", T.LongType())])


_NAME = "part-%05d.warc.gz"
#: Bytes read at a time of what is no record.
_READ = 8 * 1024 * 1024


def file_path(replica: str, file: int) -> str:
    return f"{uri(replica)}/{_NAME % file}"


def record(url: str, html: str, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One resource record, as a gzip member; the same page always gives the same bytes."""
    body = html.encode("utf-8", "surrogatepass")
    address = url.replace("\r", "%0D").replace("\n", "%0A")
    name = uuid.UUID(bytes=hashlib.sha256(address.encode("utf-8", "surrogatepass") + b"\0" + body).digest()[:16])
    head = (f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{name}>\r\nWARC-Date: {date}\r\n"
            f"WARC-Target-URI: {address}\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n")
    return gzip.compress(head.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n", compresslevel=6, mtime=0)


def write_replica(pages: DataFrame, replica: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files under ``replica``, a
    folder that the executors share; returns the manifest: page_id, file, nth
    (in the file), offset, length.

    Each task writes what it reads, in the order of the table, as one file (its
    size is that of a partition: ``spark.sql.files.maxPartitionBytes`` bounds it
    for tables), so pages are not shuffled.  A null html or url is empty, a null
    page_id stays null, repeated rows are records of their own."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), *[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("url", "html")])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        out, at, nth = WholeFile(file_path(replica, file)), 0, 0
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                raw = record(url, html)
                out.write(raw)
                rows.append((page_id, file, nth, at, len(raw)))
                at, nth = at + len(raw), nth + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=_MANIFEST.names)
        out.close()

    return cut(pages.mapInArrow(write, _MANIFEST))


def copy_replica(manifest: DataFrame, replica: str, copy: str, damage: int = 0) -> None:
    """Copy the manifest's records, file by file.  ``damage`` n > 0 changes the
    last byte of those whose crc32(page_id as text) is divisible by n: a copy to
    test an audit with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, out, n = None, None, None, 0
        for batch in batches:
            for page_id, file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("page_id", "file", "offset", "length"))):
                if file != name:
                    if out:
                        out.close()
                    fs, path = open_store(file_path(replica, file))
                    name, source, out = file, fs.open_input_file(path), WholeFile(file_path(copy, file))
                raw = source.read_at(length, offset)
                if damage and zlib.crc32(str(page_id).encode()) % damage == 0:
                    raw = raw[:-1] + bytes([raw[-1] ^ 1])
                out.write(raw)
                n += 1
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["records"])

    _by_file(manifest).mapInArrow(run, "records long").agg(F.sum("records")).collect()


def _by_file(manifest: DataFrame) -> DataFrame:
    """The manifest with a file's records in one partition, in their order."""
    files = manifest.agg(F.coalesce(F.max("file"), F.lit(0)) + 1).first()[0]
    return manifest.repartitionById(files, F.col("file").cast("int")).sortWithinPartitions("file", "offset")


def listing(spark: SparkSession, replica: str) -> DataFrame:
    """(name) of the files under ``replica``, by one task: a row a file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                fs, path = open_store(uri(folder))
                found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True, recursive=True))
                names = [f.path[len(path):].strip("/") for f in found if f.type == pafs.FileType.File]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])

    return spark.createDataFrame([(replica,)], "folder string").repartition(1).mapInArrow(run, "name string")


def ranges(manifest: DataFrame, *replicas: str) -> DataFrame:
    """All that the replicas are made of: file, nth, offset, length, name (below
    the replica's folder).  First the manifest's records; then for each of its
    files what follows the last record; and each file that only a replica has, as
    a whole, under a number of its own.  A null length is up to the file's end."""
    spark = manifest.sparkSession
    name = F.format_string(_NAME, "file")
    own = manifest.select("file", "nth", "offset", "length", name.alias("name"))
    files = own.groupBy("file", "name").agg((F.max("nth") + 1).alias("nth"), F.max(F.col("offset") + F.col("length")).alias("offset"))
    rest = files.select("file", "nth", "offset", F.lit(None).cast("long").alias("length"), "name")
    there = listing(spark, replicas[0])
    for r in replicas[1:]:
        there = there.unionByName(listing(spark, r))
    # files that the manifest does not know are few, or the manifest is the wrong one; a row each
    more = there.distinct().join(files, "name", "left_anti")
    after = files.agg(F.coalesce(F.max("file"), F.lit(-1))).first()[0]
    number = F.lit(after) + F.row_number().over(Window.orderBy("name"))
    extra = more.select(number.cast("long").alias("file"), F.lit(0).cast("long").alias("nth"), F.lit(0).cast("long").alias("offset"),
                        F.lit(None).cast("long").alias("length"), "name")
    return cut(own.unionByName(rest).unionByName(extra))


def _hash_rest(source, offset: int, size: int) -> str:
    """Of a file's true length and its bytes from ``offset`` on."""
    digest = hashlib.sha256(f"{size}:".encode())
    while offset < size:
        raw = source.read_at(min(_READ, size - offset), offset)
        digest.update(raw)
        offset += len(raw)
    return digest.hexdigest()


def range_hashes(places: DataFrame, replica: str) -> DataFrame:
    """file, nth, offset, end, hash of each range of ``places`` (of ``ranges``) as
    its bytes lie in ``replica``; a record that a file does not have in full is
    hashed as what is left of it, and the rest of a file that is not there as
    that.  ``end`` is that of the manifest, and 0 for a rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, size = None, None, 0
        for batch in batches:
            hashes, ends = [], []
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("name", "offset", "length"))):
                if path != name:
                    fs, at = open_store(f"{uri(replica)}/{path}")
                    there = fs.get_file_info(at)
                    name, source, size = path, fs.open_input_file(at) if there.is_file else None, there.size or 0
                if length is None:
                    hashes.append(_hash_rest(source, min(offset, size), size) if source else "no file")
                    ends.append(0)
                    continue
                raw = source.read_at(max(0, min(length, size - offset)), min(offset, size)) if source else b""
                hashes.append(hashlib.sha256(raw).hexdigest())
                ends.append(offset + length)
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("nth"), batch.column("offset"), pa.array(ends, pa.int64()),
                                              pa.array(hashes, pa.string())], names=["file", "nth", "offset", "end", "hash"])

    return _by_file(places).mapInArrow(run, "file long, nth long, offset long, end long, hash string")


def _parent(level: int, file_levels: int) -> tuple:
    """Columns of a node's parent: nodes of a file are joined until it has one,
    then files are."""
    if level < file_levels:
        return F.col("file"), F.expr(f"node div {FANOUT}")
    return F.expr(f"file div {FANOUT}"), F.col("node")


def tree(hashes: DataFrame) -> tuple[list[DataFrame], int]:
    """(levels from the leaves to the root, levels within files).  A level has
    file, node, offset, end, hash; a node's hash is of its children's ranges and
    hashes, in order."""
    level = cut(hashes.select("file", F.col("nth").alias("node"), "offset", "end", "hash"))
    top = level.agg(F.max("node"), F.max("file")).first()
    most, files = top[0] or 0, top[1] or 0
    file_levels = 0
    while FANOUT ** file_levels <= most:
        file_levels += 1
    all_levels = file_levels
    while FANOUT ** (all_levels - file_levels) <= files:
        all_levels += 1
    levels = [level]
    for k in range(all_levels):
        file, node = _parent(k, file_levels)
        child = F.struct("file", "node", "offset", "end", "hash")
        # at most FANOUT children each
        grouped = level.groupBy(file.alias("file"), node.alias("node")).agg(F.array_sort(F.collect_list(child)).alias("children"))
        said = F.concat_ws(";", F.transform("children", lambda c: F.concat_ws(",", c["offset"], c["end"], c["hash"])))
        level = cut(grouped.select("file", "node", F.element_at("children", 1)["offset"].alias("offset"),
                                   F.element_at("children", -1)["end"].alias("end"), F.sha2(said, 256).alias("hash")))
        levels.append(level)
    return levels, file_levels


def root(levels: list[DataFrame]) -> str | None:
    """The root's hash; None for no records."""
    top = levels[-1].first()
    return top.hash if top else None


def differing(a: tuple[list[DataFrame], int], b: tuple[list[DataFrame], int]) -> DataFrame:
    """file, nth, hash_a, hash_b of the ranges that differ between two trees of
    the same ranges, by descending from the roots into differing nodes alone."""
    (ours, file_levels), (theirs, _) = a, b
    suspects = None
    for k in range(len(ours) - 1, -1, -1):
        nodes = ours[k]
        if suspects is not None:
            file, node = _parent(k, file_levels)
            nodes = nodes.withColumn("up_file", file).withColumn("up_node", node).join(
                suspects.select(F.col("file").alias("up_file"), F.col("node").alias("up_node")), ["up_file", "up_node"], "left_semi")
        other = theirs[k].select("file", "node", F.col("hash").alias("hash_b"))
        suspects = cut(nodes.select("file", "node", F.col("hash").alias("hash_a")).join(other, ["file", "node"])
                       .filter("hash_a <> hash_b"))
        if suspects.isEmpty():
            break
    return suspects.withColumnRenamed("node", "nth")


def audit(manifest: DataFrame, first: str, second: str) -> tuple[DataFrame, DataFrame]:
    """Records and other findings.

    ``manifest`` with sha256 (of the record in the first replica), other_sha256
    (in the second, where it differs), same, and rest_same: nothing else in its
    file differs.  And name, offset, sha256, other_sha256 of the differing ranges
    that are no record: what follows a file's last record, and files that the
    manifest does not know ("no file" where a replica has none)."""
    places = ranges(manifest, first, second)
    ours, theirs = tree(range_hashes(places, first)), tree(range_hashes(places, second))
    found = cut(differing(ours, theirs))
    leaves = ours[0][0].select("file", F.col("node").alias("nth"), F.col("hash").alias("sha256"))
    rest = places.filter("length is null").select("file", "nth", "name", "offset").join(found, ["file", "nth"])
    others = rest.select("name", "offset", F.col("hash_a").alias("sha256"), F.col("hash_b").alias("other_sha256"))
    records = (manifest.join(leaves, ["file", "nth"]).join(found.select("file", "nth", F.col("hash_b").alias("other_sha256")), ["file", "nth"], "left")
               .withColumn("same", F.col("other_sha256").isNull())
               .join(rest.select("file", F.lit(False).alias("rest_same")), "file", "left").withColumn("rest_same", F.coalesce("rest_same", F.lit(True))))
    return records, others


def audited_copy(pages: DataFrame, folder: str, damage: int = 97) -> DataFrame:
    """page_id, length, sha256, other_sha256, same, rest_same of every page's
    record: a replica is written and copied, with damaged records, and the two are
    compared.  An empty table gives no rows; other columns are not read."""
    manifest = write_replica(pages, f"{folder}/a")
    copy_replica(manifest, f"{folder}/a", f"{folder}/b", damage)
    records, _ = audit(manifest, f"{folder}/a", f"{folder}/b")
    return records.select("page_id", "length", "sha256", "other_sha256", "same", "rest_same")
