"""WARC archives with dictionary-compressed records.

Each archive is one task's pages in order of their id. Its first frame is a
skippable Zstandard frame that embeds a dictionary trained on the archive's own
first records; every record follows as a frame of its own, compressed with that
dictionary, so a reader needs nothing but the file and can start at any record.
Of records with equal payloads the one with the smallest id is a response,
the others are revisits that name it and carry no payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm._common import opened, publish, small_batches
from corvane.runtime import parts_for, scratch, settle

#: Skippable frame that holds a dictionary (fixed values, from the published format).
SKIPPABLE = 0x184D2A5D
#: Dictionary size, and the most records and bytes that it is trained on.
DICT_BYTES, TRAIN_RECORDS, TRAIN_BYTES = 65_536, 400, 4_000_000
#: Bytes of stored input for each archive.
TASK_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(key) -> str:
    """A name-based id, the same in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{key}')}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(key, url: str | None, payload: bytes, refers_to, kind: str) -> bytes:
    """One WARC/1.1 record. A revisit has no payload; its length and digest are those of the full one."""
    body = payload if kind == "response" else b""
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(key)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {clean}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", f"X-Payload-Length: {len(payload)}",
    ]
    if key is not None:
        head.append(f"X-Page-ID: {key}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, rest[:n]


class ArchiveWriter:
    """Holds records until the dictionary can be trained, then writes each as it comes."""

    def __init__(self, sink, level: int = 6):
        self.sink, self.level, self.held, self.bytes, self.packer = sink, level, [], 0, None

    def add(self, record: bytes) -> None:
        if self.packer is not None:
            self.sink.write(self.packer.compress(record))
            return
        self.held.append(record)
        self.bytes += len(record)
        if len(self.held) >= TRAIN_RECORDS or self.bytes >= TRAIN_BYTES:
            self._start()

    def _start(self) -> None:
        import zstandard

        try:
            made = zstandard.train_dictionary(DICT_BYTES, self.held, level=self.level)
        except zstandard.ZstdError:  # too few or too small records: their own bytes serve as the dictionary
            made = zstandard.ZstdCompressionDict((b"".join(self.held) or b"WARC/1.1")[:DICT_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own = made.as_bytes()
        self.sink.write(struct.pack("<II", SKIPPABLE, len(own)) + own)
        self.packer = zstandard.ZstdCompressor(level=self.level, dict_data=made, write_content_size=True, write_checksum=True)
        held, self.held = self.held, []
        for r in held:
            self.add(r)

    def close(self) -> None:
        if self.packer is None:
            self._start()
        self.sink.close()


def read_archive(source):
    """Yield (fields, payload) of each record, in file order."""
    import zstandard

    magic, n = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    own = source.read(n)
    trained = own[:4] == struct.pack("<I", 0xEC30A437)
    made = zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
    unpack, held, ended = zstandard.ZstdDecompressor(dict_data=made), b"", False
    while True:
        one, out, begun = unpack.decompressobj(), [], False
        while not one.eof:
            if not held:
                held = source.read(1 << 20)
                if not held:
                    ended = True
                    break
            begun = True
            out.append(one.decompress(held))
            held = one.unused_data if one.eof else b""
        if ended:
            if begun:
                raise ValueError("the archive ends inside a record")
            return
        yield parse_record(b"".join(out))


def _bytes(text):
    return F.coalesce(F.encode(text, "UTF-8"), F.lit(b"").cast("binary"))


def plan_revisits(pages: DataFrame, html: str = "html", key: str = "page_id", least: int = 0) -> DataFrame:
    """Rows (k, d, refers_to): the digest of each keyed page whose payload occurs more than once, and the response's key.

    Only digests and keys are shuffled, and they are counted before the shuffle.
    """
    d = pages.select(F.col(key).alias("k"), F.sha1(_bytes(F.col(html))).alias("d"), F.octet_length(_bytes(F.col(html))).alias("n"))
    d = d.where(F.col("n") >= least)
    first = d.groupBy("d").agg(F.min("k").alias("refers_to"), F.count("*").alias("c")).where("c > 1 and refers_to is not null").drop("c")
    return d.select("k", "d").where("k is not null").join(first, "d").where("k <> refers_to").distinct()


def write_archives(pages: DataFrame, path: str | None = None, html: str = "html", url: str = "url", key: str = "page_id", least: int = 0) -> DataFrame:
    """Write all pages; rows (file, records), one for each archive.

    A null html is an empty payload. Payloads under ``least`` bytes are always
    responses. Rows that repeat a key and payload: the first written is as the
    others of that key, later ones are revisits of it. Rows without a key are
    responses. An empty table writes no archive.
    """
    import pyarrow as pa

    spark = pages.sparkSession
    root = path or scratch(spark, "warc")
    small_batches(spark)
    pages = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(html).alias("h"))
    again = plan_revisits(pages, "h", "k", least)

    def run(batches):
        from pyspark import TaskContext

        name, mark, writer, n, last = f"{root}/part-{TaskContext.get().partitionId():06d}.warc.zst", uuid.uuid4().hex, None, 0, None
        for b in batches:
            for k, u, h, refers in zip(*(b.column(i).to_pylist() for i in range(4))):
                if writer is None:
                    writer = ArchiveWriter(opened(f"{name}.{mark}", "wb"))
                payload = (h or "").encode("utf-8", "surrogatepass")
                if last is None or last[0] != k:
                    last = (k, set())
                if refers is None and k is not None and len(payload) >= least:
                    own = hashlib.sha1(payload).digest()
                    if own in last[1]:
                        refers = k
                    last[1].add(own)
                writer.add(make_record(k, u, payload, refers, "response" if refers is None else "revisit"))
                n += 1
        if writer is None:
            return
        writer.close()
        publish(f"{name}.{mark}", name)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "records"])

    # one row for each key (a key repeats only with another payload), so the join is on unique keys
    again = again.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("d", "refers_to"))).alias("known"))
    n = parts_for(pages, TASK_BYTES)
    rows = pages.repartition(n, "k").join(again, "k", "left")
    refers = F.when(F.col("known").isNotNull(), F.try_element_at("known", F.sha1(_bytes(F.col("h")))))
    return settle(rows.select("k", "u", "h", refers.alias("refers_to")).sortWithinPartitions("k").mapInArrow(run, "file string, records long"))


def read_archives(files: DataFrame, key_type: str = "long") -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, refers_to, url), read from the archives.

    A response's length and digest are taken from its payload and held against
    its header; a revisit's are those that its header states. Null keys come back
    as null, null payloads as empty ones, a null address as an empty one. Records
    come in the order of their file, one row each, repeated ones too. No files
    give no rows; an archive that ends inside a record is an error.
    """
    import pyarrow as pa

    def run(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                rows = []
                with opened(name, "rb") as f:
                    for fields, payload in read_archive(f):
                        stated, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                        if kind == "response" and digest(payload) != stated:
                            raise ValueError("a payload does not match its digest")
                        rows.append((fields.get("X-Page-ID"), len(payload) if kind == "response" else int(fields["X-Payload-Length"]), stated, kind, fields.get("X-Refers-To-Page-ID"), fields["WARC-Target-URI"]))
                        if len(rows) >= 5000:
                            yield table(rows)
                            rows = []
                if rows:
                    yield table(rows)

    def table(rows):
        cols = list(zip(*rows))
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    n = max(1, files.count())
    got = files.select("file").repartition(n).mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string")
    return got.withColumns({"page_id": F.col("page_id").cast(key_type), "refers_to": F.col("refers_to").cast(key_type)})
