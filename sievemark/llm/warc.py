"""WARC archives: a deterministic sharded writer, and a reader.

Writing. Shards are ranges of page_id whose number and bounds follow from the ids and payload sizes alone; in a shard, records are sorted and appended to
an archive file, each as a gzip member of its own, until the file reaches the roll size in compressed bytes. Headers are made
anew from the row, with digests of block and payload; dates are a parameter. Of records with equal payloads of LEAST_PAYLOAD
bytes or more, that with the smallest page_id is the response and the others are revisits that refer to it.

Commit. A task writes under a temporary name of its own attempt and reports it. When all have, a second step renames what was
reported to its final name (again, if it is run again, without harm), and the manifest is written last. Readers take the
files that the manifest names, so that lost or repeated tasks leave no trace but temporary files, which the commit removes.

Defined results. Null html is an empty payload. Null page_id: written without the page header, spread over the shards,
always a response, and read back as null. Rows that repeat page_id and payload have the same type; a page_id with several
payloads is as many records. Control characters in a url are percent-encoded; a null url has no target header. An empty
table gives a manifest without files. Other columns are not read.

At scale: payloads are shuffled once, to their shard; which records are revisits is settled on ids and digests alone. Shards
hold about SHARD_BYTES; ranges of ids that hold more are counted again, finer, down to single ids, and an id that exceeds a
shard by itself is dealt over several by digest. Records stream through writer and reader one at a time. Files go through
pyarrow's file systems (file, hdfs, s3 and s3a, gs, abfs), which have to be open to every executor.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.sources.files import file_system

from .common import process_slots, written

LEAST_PAYLOAD = 100
ROLL_BYTES, DATE = 64 << 20, "2024-01-01T00:00:00Z"
#: Payload bytes that a shard aims at; smaller tables are dealt over FEW_SHARDS shards as long as these hold LEAST_BYTES. Bits by which a heavy range of ids is refined, and ranges a shard of evenly spread ids.
SHARD_BYTES, FEW_SHARDS, LEAST_BYTES, FINER, CELLS = 256 << 20, 64, 4 << 20, 5, 64
MANIFEST = "file string, temporary string, shard long, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public namespace for URLs


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record, before compression."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def opening(name: str, date: str) -> bytes:
    """The warcinfo record that a file begins with."""
    body = b"software: sievemark\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, name)}>", f"WARC-Date: {date}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class _Roll:
    """Appends compressed records to files of one shard under temporary names."""

    def __init__(self, out_dir: str, attempt: str, shard: int, part: int, roll_bytes: int, date: str):
        self.fs, self.root = file_system(out_dir)
        self.attempt, self.shard, self.part, self.roll_bytes, self.date = attempt, shard, part, roll_bytes, date
        self.number, self.stream, self.done = 0, None, []

    def add(self, data: bytes) -> None:
        packed = gzip.compress(data, 6, mtime=0)
        if self.stream is not None and self.size + len(packed) > self.roll_bytes:
            self.close()
        if self.stream is None:
            self.name = f"shard-{self.shard:06d}{f'.{self.part:04d}' if self.part else ''}-{self.number:05d}.warc.gz"
            self.temporary = f"_temporary/{self.attempt}-{self.name}"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.stream = self.fs.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self.size, self.records, self.digest = 0, 0, hashlib.sha256()
            self._put(gzip.compress(opening(self.name, self.date), 6, mtime=0))
        self._put(packed)
        self.records += 1

    def _put(self, packed: bytes) -> None:
        self.stream.write(packed)
        self.digest.update(packed)
        self.size += len(packed)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append((self.name, self.temporary, self.shard, self.records, self.size, self.digest.hexdigest()))
            self.number, self.stream = self.number + 1, None


def shard_count(total_bytes: int) -> int:
    return max(1, -(-total_bytes // SHARD_BYTES), min(FEW_SHARDS, total_bytes // LEAST_BYTES))


def shard_bounds(pages: DataFrame, shards: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Ascending page_ids at which a new shard begins, and (page_id, parts) of the ids that are too heavy for one. pages: page_id, payload_bytes.

    Ids are counted by their upper bits; ranges that hold more than a shard's share, of which there are no more than shards, are
    counted again by more bits, down to single ids."""
    known = pages.where(F.col("page_id").isNotNull()).select("page_id", (F.col("payload_bytes") + 512).alias("size"))
    low, high, total = known.agg(F.min("page_id"), F.max("page_id"), F.sum("size")).first()
    if not total or shards < 2:
        return [], []
    aim = -(-total // shards)
    shift = max(0, ((high - low) // (shards * CELLS)).bit_length())
    cells, heavy = [], []
    while True:
        last = shift == 0
        found = known.groupBy(F.shiftright("page_id", shift).alias("cell")).agg(F.sum("size").alias("size")).collect()
        over = [r["cell"] for r in found if r["size"] > aim]
        cells += [(r["cell"] << shift, r["size"]) for r in found if last or r["size"] <= aim]
        if last:
            heavy = [(r["cell"], -(-r["size"] // aim)) for r in found if r["size"] > aim]
        if last or not over:
            break
        wanted = pages.sparkSession.createDataFrame([(c,) for c in over], "heavy long")
        known = known.join(F.broadcast(wanted), F.shiftright(known["page_id"], shift) == wanted["heavy"]).select("page_id", "size")
        shift = max(0, shift - FINER)
    cells.sort()
    bounds, held = [], 0
    for start, size in cells:
        if held and held + size > aim:
            bounds.append(start)
            held = 0
        held += size
    return bounds, heavy


def _at_or_below(bounds: list[int], value: Column) -> Column:
    """How many of the ascending bounds lie at or below the value, searched in two steps."""
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    group = F.size(F.filter(F.lit([g[0] for g in groups]).cast("array<bigint>"), lambda b: b <= value))
    inside = F.get(F.array(*(F.lit(g).cast("array<bigint>") for g in groups)), group - 1)
    return F.when(group == 0, 0).otherwise((group - 1) * step + F.size(F.filter(inside, lambda b: b <= value)))


def revisits(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, digest, refers_to of the records that are revisits. pages: page_id, digest, payload_bytes."""
    large = pages.where((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
    first = written(large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").select("digest", "refers_to"), "first")
    return large.select("page_id", "digest").join(first, "digest").where("page_id != refers_to").dropDuplicates(["page_id", "digest"])


def write_archives(pages: DataFrame, out_dir: str, shards: int | None = None, roll_bytes: int = ROLL_BYTES, date: str = DATE) -> DataFrame:
    """Writes page_id, url, html as archives under out_dir and returns the manifest."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).select("*", F.sha2("payload", 256).alias("digest"))
    narrow = written(rows.select("page_id", "digest", F.octet_length("payload").cast("long").alias("payload_bytes")), "digests")
    shards = shards or shard_count(narrow.agg(F.sum("payload_bytes")).first()[0] or 0)
    bounds, heavy = shard_bounds(narrow, shards)
    spread = F.conv(F.substring("digest", 1, 12), 16, 10).cast("long")
    number = F.when(F.col("page_id").isNull(), F.pmod(spread, F.lit(len(bounds) + 1))).otherwise(_at_or_below(bounds, F.col("page_id")) if bounds else F.lit(0)).cast("long")
    # an id heavier than a shard: by the range that the digest lies in
    parts = F.lit(0)
    for page_id, n in heavy:
        parts = F.when(F.col("page_id") == page_id, F.shiftright(spread * n, 48)).otherwise(parts)
    none = F.lit(None)
    both = rows.select("page_id", "digest", F.lit(1).alias("kind"), "url", "payload", none.cast("long").alias("refers_to")).unionByName(
        revisits(narrow).select("page_id", "digest", F.lit(0).alias("kind"), none.cast("string").alias("url"), none.cast("binary").alias("payload"), F.col("refers_to"))
    )
    tasks = len(bounds) + 1 + sum(n for _, n in heavy)
    dealt = both.withColumn("shard", number).withColumn("part", parts.cast("long")).repartitionByRange(tasks, "shard", "part").sortWithinPartitions("shard", "part", "page_id", "digest", "kind", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, roll, said, files = uuid.uuid4().hex, None, None, []
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, digest, kind, url, payload, refers_to, shard, part = (batch.column(j)[i].as_py() for j in range(8))
                if kind == 0:
                    said = (page_id, digest, refers_to)
                    continue
                if roll is None or (roll.shard, roll.part) != (shard, part):
                    if roll is not None:
                        roll.close()
                        files += roll.done
                    roll = _Roll(out_dir, attempt, shard, part, roll_bytes, date)
                roll.add(record(page_id, url, payload, digest, said[2] if said and said[:2] == (page_id, digest) else None, date))
        if roll is not None:
            roll.close()
            files += roll.done
        yield _batch(files)

    return commit(written(dealt.mapInArrow(write, MANIFEST), "files"), out_dir)


def _batch(files: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([f[j] for f in files], kinds[j]) for j in range(6)], ["file", "temporary", "shard", "records", "bytes", "sha256"])


def _digest(fs: pafs.FileSystem, path: str) -> str:
    digest = hashlib.sha256()
    with fs.open_input_stream(path, compression=None) as stream:
        while data := stream.read(1 << 20):
            digest.update(data)
    return digest.hexdigest()


def commit(files: DataFrame, out_dir: str) -> DataFrame:
    """Renames reported files to their final names, then writes the manifest."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(out_dir)
        for batch in batches:
            for row in batch.to_pylist():
                final = fs.get_file_info(f"{root}/{row['file']}")
                if final.type == pafs.FileType.NotFound:
                    fs.move(f"{root}/{row['temporary']}", f"{root}/{row['file']}")
                elif final.size != row["bytes"] or _digest(fs, f"{root}/{row['file']}") != row["sha256"]:
                    raise ValueError(f"{row['file']} is there with other contents")
            yield batch

    spark = files.sparkSession
    files.mapInArrow(rename, MANIFEST).write.json(f"{out_dir}/manifest")
    fs, root = file_system(out_dir)
    if fs.get_file_info(f"{root}/_temporary").type == pafs.FileType.Directory:
        fs.delete_dir(f"{root}/_temporary")
    return spark.read.schema(MANIFEST).json(f"{out_dir}/manifest")


def members(stream) -> Iterator[bytes]:
    """The uncompressed records of an archive, one at a time."""
    unpack, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(1 << 20)
        if not data:
            if parts:
                raise ValueError("the archive ends within a record")
            return
        parts.append(unpack.decompress(data))
        rest = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def read_archives(spark: SparkSession, out_dir: str, payloads: bool = False) -> DataFrame:
    """The records of all archives that the manifest names, digests verified; the payload too if asked for (null for revisits)."""
    schema = RECORD + ", payload binary" * payloads
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kinds[j]) for j in range(len(names))], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(out_dir)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in members(stream):
                        headers, block = parse(data)
                        if headers["warc-type"] == "warcinfo":
                            continue
                        if headers["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                            raise ValueError(f"{name}: a block differs from its digest")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size, digest = int(re.search(rb"Content-Length: (\d+)", http)[1]), headers["warc-payload-digest"].removeprefix("sha256:")
                        response = headers["warc-type"] == "response"
                        if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{name}: a payload differs from its digest")
                        page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page")
                        rows.append((int(page) if page else None, headers.get("warc-target-uri"), size, digest, headers["warc-type"], int(refers) if refers else None, *[payload if response else None] * payloads))
                        if len(rows) >= (64 if payloads else 4096):
                            yield pack(rows)
                            rows = []
                if rows:
                    yield pack(rows)

    files = spark.read.schema(MANIFEST).json(f"{out_dir}/manifest").select("file")
    return files.repartition(process_slots(spark), "file").mapInArrow(read, schema)
