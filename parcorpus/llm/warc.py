"""Operator 12: WARC archives, written with revisit records and read by byte ranges.

**Writing.** A record is a gzip member of its own. Of records with equal
payloads (SHA-1) that with the smallest id is a ``response``; the others are
``revisit`` records, which refer to it and hold no payload. The rows are written
once with a number and their digest; payloads that occur once never move, the
others (told apart by a blocked Bloom filter over the digests that repeat) go
through a salted join. Spark's text sink writes the archives, so that its
committer keeps a killed task from leaving half a file and any store will do:
a row is a run of members without its last byte, which is 0, and 0 is the line
separator. (The last byte of a member is the top byte of its length; where that
is not 0, an empty member follows, which readers pass over.)

**Reading.** The archives are split into byte ranges. Each task scans its range
for the gzip magic (it is the line separator of Spark's text source, whose
splits own the lines that start inside and read them to their end), and
validates a candidate by inflating it: a member that begins with a WARC header
is a record, and one that has not ended at the next magic goes on behind it, as
the magic stood in its data by chance. So a record belongs to the range in which
it starts. If its last candidate is cut by a chance magic that opens the next
range, that range finds pieces that are no members; these few pieces are joined
to the open record by their place in the file.

Defined results: a null payload is empty; a null id is written as none and comes
after all others. Repeated rows are records of their own, of which one is the
response. A null address is left out. Empty and very long payloads are records
like others; a task holds one record at a time beside its batch. An empty table
gives an archive without records. A member that ends early has the status
``truncated``, one whose payload does not match its digest ``corrupt``; the
reader passes over what is no member. An archive that holds a gzipped archive
as a payload, uncompressed, can show at the start of a range records of the
inner one: the outer record is then reported as ``truncated``. Only the named
columns are read; others may have any name. An archive needs an extension that
Hadoop does not take for a compressed text (not ``.gz``), as the sink gives it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import deque
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcorpus.llm.common import discard, in_slices, ship_by_value, written
from parcorpus.llm.urlfilter import bloom_blocks, log2_blocks, with_maybe

#: Fixed values of the two formats.
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Copies of a repeated digest in the join that tells its first record.
SALTS = 16
#: Compressed bytes of a row of the sink, about.
CHUNK = 1 << 20

READ = ("path string, block long, seq long, status string, type string, record_id string, refers_to string, "
        "target_uri string, declared_digest string, payload_digest string, payload_bytes long, payload binary")


def member(data: bytes) -> bytes:
    """``data`` as a gzip member, the same bytes whenever it is made."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def sink_row(members: list[bytes]) -> bytes:
    """Members as a row of the text sink: without the last byte, a 0 that the line separator puts back."""
    row = b"".join(members)
    return (row if row[-1] == 0 else row + member(b""))[:-1]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def record_name(own, row: int) -> str:
    return f"<urn:record:{'' if own is None else quote(str(own), safe='')}:{row}>"


def own_id(name: str | None) -> str | None:
    """The id in the name of a record that :func:`write_archive` wrote."""
    found = re.fullmatch("<urn:record:([^:]*):[0-9]+>", name or "")
    return unquote(found[1]) if found and found[1] else None


def _http(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def write_archive(rows: DataFrame, path: str, id_col: str, uri: str, payload: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record per row of ``rows`` below ``path``, one archive per task, each with a ``warcinfo`` record."""
    spool = written(rows.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(uri).alias("_uri"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("_payload")
    ).withColumn("_digest", F.unhex(F.sha1("_payload"))), "spool")
    first = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    repeated = spool.groupBy(F.col("_digest").alias("_d")).agg(F.min(first).alias("_first"), F.count(F.lit(1)).alias("_n")).where(
        "_n > 1").select("_d", "_first.id", "_first.row")
    repeated = written(repeated, "repeated")
    log2 = log2_blocks(repeated.count())
    flagged = with_maybe(spool, "_digest", bloom_blocks(repeated, "_d", log2), log2=log2)
    alone = flagged.where("not _maybe").select(*spool.columns, F.lit(None).cast(repeated.schema["id"].dataType).alias("id"),
                                               F.lit(None).cast("long").alias("row"))
    salted = flagged.where("_maybe").withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)))
    copies = repeated.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_s"))
    looked = salted.join(copies, (F.col("_digest") == F.col("_d")) & (F.col("_salt") == F.col("_s")), "left").select(
        *spool.columns, "id", "row")
    later = F.col("row").isNotNull() & (F.col("row") != F.col("_row"))
    ready = alone.unionByName(looked).select(
        "_row", F.col("_id").cast("string").alias("_id"), "_uri", "_digest", F.length("_payload").cast("long").alias("_bytes"),
        F.when(later, F.lit(None)).otherwise(F.col("_payload")).alias("_payload"),
        F.col("id").cast("string").alias("id"), F.when(later, F.col("row")).alias("row"))

    def run(batches):
        import pyarrow as pa

        info = record("warcinfo", {"WARC-Record-ID": "<urn:record-set:pages>", "WARC-Date": date,
                                   "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")
        held, size = [], 0
        for batch in batches:
            for part in in_slices(batch, "_payload"):
                done = []
                for r in part.to_pylist():
                    head = _http(r["_bytes"])
                    fields = {"WARC-Record-ID": record_name(r["_id"], r["_row"]), "WARC-Date": date,
                              "WARC-Target-URI": None if r["_uri"] is None else re.sub(
                                  "[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", r["_uri"]),
                              "WARC-Payload-Digest": "sha1:" + base64.b32encode(r["_digest"]).decode(),
                              "Content-Type": "application/http; msgtype=response"}
                    if r["row"] is None:
                        made = record("response", fields, head + r["_payload"])
                    else:
                        made = record("revisit", fields | {"WARC-Refers-To": record_name(r["id"], r["row"]),
                                                           "WARC-Profile": PROFILE}, head)
                    if info:
                        held, info = [member(info)], None
                    held.append(member(made))
                    size += len(held[-1])
                    if size >= CHUNK:
                        done.append(sink_row(held))
                        held, size = [], 0
                if done:
                    yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], ["value"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([sink_row(held)], pa.binary())], ["value"])

    ready.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)
    discard(spool, repeated)


def headers(lines: bytes) -> dict[str, str]:
    """The named fields of a header, names in lower case."""
    found = {}
    for line in lines.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        found.setdefault(name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace"))
    return found


def decoded(data: bytes, status: str, keep: bool) -> dict:
    """The columns of READ, from ``status`` on, of an inflated record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = headers(head)
    kind = fields.get("warc-type")
    size = fields.get("content-length", "")
    block = rest[:int(size)] if size.isdigit() else rest
    declared = fields.get("warc-payload-digest", "").partition(":")[2] or None
    out = {"status": status, "type": kind, "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"),
           "target_uri": fields.get("warc-target-uri"), "declared_digest": declared, "payload_digest": None,
           "payload_bytes": None, "payload": None}
    if "application/http" in fields.get("content-type", ""):
        http, _, body = block.partition(b"\r\n\r\n")
        if kind == "revisit":  # the payload stands in another record; the answer's header tells its length
            length = headers(http).get("content-length", "")
            out |= {"payload_digest": declared, "payload_bytes": int(length) if length.isdigit() else None}
        else:
            out |= {"payload_digest": digest(body), "payload_bytes": len(body), "payload": body if keep else None}
            if status == "ok" and declared not in (None, out["payload_digest"]):
                out["status"] = "corrupt"
    return out


class Members:
    """Puts the pieces between two magics together to the records that they are of."""

    def __init__(self):
        self._reset()

    def _reset(self) -> None:
        self.z, self.start, self.pieces, self.out = zlib.decompressobj(31), b"", [], []

    def _take(self, at: int, piece: bytes) -> str:
        self.pieces.append((at, piece))
        try:
            tail, got = piece, b""
            if len(self.start) < 5:
                got = self.z.decompress(piece, 5 - len(self.start))
                self.start += got
                if not b"WARC/".startswith(self.start):
                    return "loose"
                tail = self.z.unconsumed_tail
            self.out.append(got + self.z.decompress(tail))
        except zlib.error:
            return "truncated" if self.out and self.out[0].startswith(b"WARC/") else "loose"
        if self.z.eof:
            return "ok" if self.start in (b"", b"WARC/") else "loose"
        return "open"

    def feed(self, at: int, piece: bytes):
        """Yield (at, status, data) for what the piece brings to an end.

        Pieces are tried together until the member ends. If they turn out not to be one, the
        first is let go alone, as what it is, and the others are tried anew."""
        queue = deque([(at, piece)])
        while queue:
            state = self._take(*queue.popleft())
            if state == "open":
                continue
            first, others = self.pieces[0], self.pieces[1:]
            if state == "ok":
                if self.start:
                    yield first[0], state, b"".join(self.out)
            else:
                yield first[0], state, self.out[0] if state == "truncated" else first[1]
                queue.extendleft(reversed(others))
            self._reset()

    def finish(self):
        """Yield what is open at the end of all pieces."""
        while self.pieces:
            (at, piece), others, data = self.pieces[0], self.pieces[1:], b"".join(self.out[:1])
            cut = data.startswith(b"WARC/")
            yield at, "truncated" if cut else "loose", data if cut else piece
            self._reset()
            for other in others:
                yield from self.feed(*other)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row (READ) per record of the archives below ``path``; without ``payload`` that column stays null.

    The parsed records are written once, so that the few loose pieces can be found without inflating all again."""
    pieces = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"))
    names = [f.split()[0] for f in READ.split(", ")]

    def as_arrow(pa):
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in READ.split(", ")])

    def row(where, block, at, status, data):
        out = dict.fromkeys(names) | {"path": where, "block": block, "seq": at, "status": status}
        return out | (decoded(data, status, payload) if status in ("ok", "truncated") else {"payload": data})

    def scan(batches):
        import pyarrow as pa

        here, seq, members, done, size = (None, None), 0, Members(), [], 0
        for batch in batches:
            for part in in_slices(batch, "value"):
                for where, block, value in zip(*(part.column(c).to_pylist() for c in ("path", "block", "value"))):
                    if (where, block) != here:
                        done += [row(*here, at, "loose", open_) for at, open_ in members.pieces]
                        here, seq, members = (where, block), 0, Members()
                    seq += 1
                    if block == 0 and seq == 1:
                        continue  # what stands before the first magic of the file
                    for x in members.feed(seq, MAGIC + value):
                        done.append(row(*here, *x))
                        size += len(x[2])
                    if len(done) >= 4096 or size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(done, as_arrow(pa))
                        done, size = [], 0
        done += [row(*here, at, "loose", open_) for at, open_ in members.pieces]
        if done:
            yield pa.RecordBatch.from_pylist(done, as_arrow(pa))

    found = written(pieces.mapInArrow(scan, READ), "records")

    def joined(pieces):
        """The records that the loose pieces of one file make: those open at the end of a range go on in the next."""
        import pyarrow as pa

        out, members, last = [], Members(), None
        for r in sorted(pieces.to_pylist(), key=lambda r: (r["block"], r["seq"])):
            at = r["block"], r["seq"]
            if at[1] > 1 and last != (at[0], at[1] - 1):
                out.extend(members.finish())
            out.extend(members.feed(at, r["payload"]))
            last = at
        out.extend(members.finish())
        path = pieces.column("path")[0].as_py() if pieces.num_rows else None
        return pa.Table.from_pylist([row(path, *at, status, data) for at, status, data in out if status != "loose"], as_arrow(pa))

    loose = found.where("status = 'loose'")
    return found.where("status <> 'loose'").unionByName(loose.groupBy("path").applyInArrow(joined, READ))


ship_by_value(__name__)
