"""BAM files as a Spark data source, to read and to write.

``read_bam(spark, path)`` cuts files into byte ranges.  A range owns the records that start in its compressed blocks;
where a range begins in the middle of a record, the first position from which a chain of well-formed records
follows is taken.  Where a file has an index beside it (``x.bam.bai`` or ``x.bai``) and the query asks for places, by the option
``regions`` or by filters on ``rname`` and ``pos``, which are pushed to the source, only the stretches of the file that the index
names are read.

Paths are local, or URIs of any file system that Arrow resolves (``file``, ``hdfs``, ``viewfs``, ``s3``, ``gs``).
"""

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, WriterCommitMessage,
)

from isoquilt.sources.bam_index import Builder, Index, bin_of, merged

SCHEMA = "read_name string, flag int, rname string, pos bigint, mapq int, cigar string, seq string"
# Letter codes of the file format, operations that move along the reference, the last block of every file.
BASES = "=ACMGRSVTWYHKDBN"
OPS = "MIDNSHP=X"
ALONG = "MDN=X"
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BLOCK_MAX = 1 << 16
#: Bytes asked from the store at once, and bytes of content in a block that is written.
READ = 1 << 18
FULL = 65280


def file_system(path: str):
    """(Arrow file system, path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(path))


class Range(InputPartition):
    """Byte range of a file without use of an index."""

    def __init__(self, path, low, high):
        self.path, self.low, self.high = path, low, high


class Stretches(InputPartition):
    """Pairs of virtual offsets of a file between which the wanted records lie."""

    def __init__(self, path, places):
        self.path, self.places = path, places


def block_at(data: bytes, at: int):
    """Size of the compressed block starting at ``at``, or None."""
    if data[at : at + 4] != b"\x1f\x8b\x08\x04" or data[at + 12 : at + 16] != b"BC\x02\x00":
        return None
    return struct.unpack_from("<H", data, at + 16)[0] + 1


def blocks(handle, low: int):
    """(file offset, content) of the blocks from the first one at or after ``low``."""
    handle.seek(low)
    held = handle.read(2 * BLOCK_MAX)
    shift = 0
    while shift < len(held) and block_at(held, shift) is None:
        shift += 1
    at, held = low + shift, held[shift:]
    while True:
        while len(held) < BLOCK_MAX and (more := handle.read(READ)):
            held += more
        if not held:
            return
        size = block_at(held, 0) if len(held) >= 18 else None
        if size is None or size > len(held):
            raise ValueError(f"damaged or cut-off block at byte {at}")
        yield at, zlib.decompress(held[18 : size - 8], -15)
        at, held = at + size, held[size:]


def records_between(handle, low: int, high: int) -> Iterator[bytes]:
    """The records that start at virtual offsets ``low`` .. ``high`` - 1; ``low`` is the start of one."""
    data, at, marks = bytearray(), low & 0xFFFF, []
    for offset, content in blocks(handle, low >> 16):
        if offset << 16 >= high and at >= len(data):
            return
        marks.append((len(data), offset))
        data += content
        while at + 4 <= len(data):
            size = struct.unpack_from("<i", data, at)[0]
            if at + 4 + size > len(data):
                break
            while len(marks) > 1 and marks[1][0] <= at:
                marks.pop(0)
            if marks[0][1] << 16 | at - marks[0][0] >= high:
                return
            yield bytes(data[at : at + 4 + size])
            at += 4 + size
        while len(marks) > 1 and marks[1][0] <= at:
            marks.pop(0)
        done = marks[0][0]
        del data[:done]
        at, marks = at - done, [(p - done, o) for p, o in marks]


def header(handle):
    """Reference names and the number of content bytes before the first record."""
    _, references, at = full_header(handle)
    return [name for name, _ in references], at


def full_header(handle):
    """Header text, references (name, length), and the number of content bytes before the first record."""
    data = b""
    for _, content in blocks(handle, 0):
        data += content
        try:
            text = struct.unpack_from("<i", data, 4)[0]
            at = 8 + text
            count = struct.unpack_from("<i", data, at)[0]
            lines = data[8:at].rstrip(b"\0").decode()
            at += 4
            names = []
            for _ in range(count):
                size = struct.unpack_from("<i", data, at)[0]
                names.append((data[at + 4 : at + 3 + size].decode(), struct.unpack_from("<i", data, at + 4 + size)[0]))
                at += 8 + size
            if at <= len(data):
                return lines, names, at
        except struct.error:
            continue
    raise ValueError("no BAM header")


def well_formed(data: bytes, at: int, refs: int) -> bool:
    if at + 36 > len(data):
        return False
    size, ref, pos = struct.unpack_from("<iii", data, at)
    name_len, mapq, _, n_op, flag, n_base, ref2, pos2 = struct.unpack_from("<BBHHHiii", data, at + 12)
    body = 32 + name_len + 4 * n_op + (n_base + 1) // 2 + n_base if n_base >= 0 else -1
    if not (32 < size < 1 << 28 and -1 <= ref < refs and -1 <= ref2 < refs and pos >= -1 and pos2 >= -1):
        return False
    if name_len < 2 or body < 0 or body > size:
        return False
    name = data[at + 36 : at + 36 + name_len]
    return len(name) < name_len or (name[-1] == 0 and all(33 <= c <= 126 for c in name[:-1]))


def first_record(data: bytes, refs: int, chain: int = 4) -> int | None:
    """First offset from which up to ``chain`` well-formed records follow."""
    for at in range(len(data) - 36):
        here, seen = at, 0
        while seen < chain and here + 36 <= len(data) and well_formed(data, here, refs):
            here += 4 + struct.unpack_from("<i", data, here)[0]
            seen += 1
        if seen == chain or (seen > 0 and here + 36 > len(data)):
            return at
    return None


def decode(data: bytes, at: int, size: int, names: list):
    """One record as a row."""
    ref, pos, name_len, mapq, _, n_op, flag, n_base = struct.unpack_from("<iiBBHHHi", data, at + 4)
    here = at + 36
    name = data[here : here + name_len - 1].decode()
    here += name_len
    ops = struct.unpack_from(f"<{n_op}I", data, here)
    here += 4 * n_op
    packed = data[here : here + (n_base + 1) // 2]
    letters = "".join(BASES[b >> 4] + BASES[b & 15] for b in packed)[:n_base]
    cigar = "".join(f"{o >> 4}{OPS[o & 15]}" for o in ops) or "*"
    return name, flag, names[ref] if ref >= 0 else None, pos, mapq, cigar, letters


def end_of(record: bytes) -> tuple[int, int, int]:
    """(reference, first place, place after the last) of a record."""
    ref, pos, name_len, _, _, n_op = struct.unpack_from("<iiBBHH", record, 4)
    ops = struct.unpack_from(f"<{n_op}I", record, 36 + name_len)
    return ref, pos, pos + max(1, sum(o >> 4 for o in ops if OPS[o & 15] in ALONG))


def parse_regions(text: str | None) -> list:
    """``chr1:101-200,chr2`` as (name, first place from 0, place after the last)."""
    out = []
    for part in (text or "").split(","):
        name, _, places = part.strip().partition(":")
        low, _, high = places.replace("_", "").partition("-")
        if name:
            out.append((name, int(low or 1) - 1, int(high) if high else 1 << 29))
    return out


class BamReader(DataSourceReader):
    """Options: ``splitBytes``; ``regions``: only records that overlap one; ``raw``: adds the column ``record``."""

    def __init__(self, options):
        self.path = options["path"]
        self.split = int(options.get("splitBytes", 64 << 20))
        self.regions = parse_regions(options.get("regions"))
        self.raw = options.get("raw", "false").lower() == "true"
        self.names: set | None = None
        self.low, self.high = 0, 1 << 29

    def pushFilters(self, filters):  # noqa: N802
        """Filters on ``rname`` and ``pos`` bound what is read; Spark still evaluates every filter."""
        for f in filters:
            column = ".".join(f.attribute) if hasattr(f, "attribute") else None
            if column == "rname" and isinstance(f, (EqualTo, In)):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.names = values if self.names is None else self.names & values
            if column == "pos" and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            if column == "pos" and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self.high = min(self.high, f.value + 1 - isinstance(f, LessThan))
            yield f

    def _files(self):
        from pyarrow import fs

        store, path = file_system(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.type == fs.FileType.File:
            return store, [info]
        found = [x for x in store.get_file_info(fs.FileSelector(path)) if x.type == fs.FileType.File and x.path.endswith(".bam")]
        return store, sorted(found, key=lambda x: x.path)

    def _wanted(self) -> list:
        """Regions to read: those of the option within the pushed bounds."""
        names = self.names if self.names is not None else {name for name, _, _ in self.regions}
        if not self.regions:
            return [(name, self.low, self.high) for name in sorted(x for x in names if x is not None)]
        # a record may start before a region that it overlaps, so the pushed bounds do not narrow that region's start
        return [(n, low, min(high, self.high)) for n, low, high in self.regions if n in names]

    def _stretches(self, store, path: str) -> list | None:
        """Parts of one file by its index; None where there is none."""
        for name in (path + ".bai", path.removesuffix(".bam") + ".bai"):
            if store.get_file_info(name).is_file:
                with store.open_input_file(name) as handle:
                    index = Index(handle.read())
                break
        else:
            return None
        with store.open_input_file(path) as handle:
            refs = {name: k for k, name in enumerate(header(handle)[0])}
        pieces = []
        for ref in sorted({refs[n] for n, _, _ in self._wanted() if n in refs}):
            found = [x for n, low, high in self._wanted() if refs.get(n) == ref for x in index.chunks(ref, low, high)]
            pieces += [p for stretch in merged(found) for p in index.pieces(ref, stretch, self.split)]
        # small ones share a task
        out, size = [], self.split
        for low, high in pieces:
            if size >= self.split:
                out.append(Stretches(path, []))
                size = 0
            out[-1].places.append((low, high))
            # its last block is read too, of a size that the index does not tell
            size += (high >> 16) - (low >> 16) + BLOCK_MAX // 4
        return out

    def partitions(self):
        store, files = self._files()
        out = []
        for info in files:
            parts = self._stretches(store, info.path) if self.regions or self.names is not None else None
            if parts is None:
                parts = [Range(info.path, low, min(info.size, low + self.split)) for low in range(0, info.size, self.split)]
            out += parts
        # a source needs one part at least
        return out or [Stretches("", [])]

    def read(self, part):
        if not part.path:
            return
        with file_system(self.path)[0].open_input_file(part.path) as handle:
            names, skip = header(handle)
            inside = {}
            for name, low, high in self.regions:
                inside.setdefault(names.index(name) if name in names else None, []).append((low, high))
            if isinstance(part, Stretches):
                found = chain.from_iterable(records_between(handle, low, high) for low, high in part.places)
            else:
                found = self._owned(handle, part, names, skip)
            for record in found:
                if inside:
                    ref, begin, end = end_of(record)
                    if not any(begin < high and end > low for low, high in inside.get(ref, [])):
                        continue
                row = decode(record, 0, len(record) - 4, names)
                yield (*row, record) if self.raw else row

    def _owned(self, handle, part, names, skip) -> Iterator[bytes]:
        """The records that start in the blocks of a byte range."""
        with handle:
            stream = blocks(handle, part.low)
            data, owned, synced = bytearray(), 0, part.low == 0
            at = skip if synced else 0
            over = False
            for offset, content in stream:
                if offset >= part.high:
                    over = True
                if over and synced and at >= owned:
                    return
                if over and not synced:
                    return
                data += content
                if not over:
                    owned = len(data)
                if not synced:
                    # look far enough ahead to judge a chain of records
                    if len(data) < 4 * BLOCK_MAX and offset < part.high - 1 and len(content):
                        guess = first_record(data, len(names)) if len(data) >= BLOCK_MAX else None
                    else:
                        guess = first_record(data, len(names))
                    if guess is None:
                        continue
                    at, synced = guess, True
                at, rows = self._drain(data, at, owned)
                yield from rows
                if at > BLOCK_MAX and at <= len(data):
                    del data[:at]
                    owned, at = max(0, owned - at), 0
            if not synced and data:
                guess = first_record(data, len(names))
                at = guess if guess is not None else len(data)
            _, rows = self._drain(data, at, owned)
            yield from rows

    @staticmethod
    def _drain(data, at, owned):
        rows = []
        while at < owned and at + 4 <= len(data):
            size = struct.unpack_from("<i", data, at)[0]
            if at + 4 + size > len(data):
                break
            rows.append(bytes(data[at : at + 4 + size]))
            at += 4 + size
        return at, rows


def encode(row, refs: dict) -> bytes:
    """A row as a record without qualities."""
    seq, name = row["seq"] or "", row["read_name"].encode() + b"\0"
    ops, count = [], ""
    for c in row["cigar"] if row["cigar"] not in (None, "*") else "":
        if c.isdigit():
            count += c
        else:
            ops.append(int(count) << 4 | OPS.index(c))
            count = ""
    codes = [BASES.index(c) if c in BASES else 15 for c in seq] + [0] * (len(seq) % 2)
    packed = bytes(x << 4 | y for x, y in zip(codes[::2], codes[1::2]))
    pos = -1 if row["pos"] is None else row["pos"]
    end = pos + max(1, sum(o >> 4 for o in ops if OPS[o & 15] in ALONG))
    ref = -1 if row["rname"] is None else refs[row["rname"]]
    head = struct.pack(
        "<iiBBHHHiiii", ref, pos, len(name), row["mapq"], bin_of(max(pos, 0), max(end, 1)), len(ops), row["flag"], len(seq), -1, -1, 0
    )
    body = head + name + struct.pack(f"<{len(ops)}I", *ops) + packed + b"\xff" * len(seq)
    return struct.pack("<i", len(body)) + body


class BlockWriter:
    """Content as compressed blocks; ``place`` is the virtual offset of the next byte."""

    def __init__(self, out):
        self.out, self.held, self.offset = out, bytearray(), 0

    @property
    def place(self) -> int:
        return self.offset << 16 | len(self.held)

    def write(self, content: bytes, whole: bool = False) -> None:
        # records of up to a block's size are not cut
        if whole and self.held and len(self.held) + len(content) > FULL:
            self.flush()
        self.held += content
        while len(self.held) >= FULL:
            self.flush()

    def flush(self) -> None:
        part = bytes(self.held[:FULL])
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(part) + packer.flush()
        head = struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
        self.out.write(head + body + struct.pack("<II", zlib.crc32(part), len(part)))
        self.offset += len(head) + len(body) + 8
        del self.held[:FULL]

    def close(self) -> None:
        while self.held:
            self.flush()
        self.out.write(LAST_BLOCK)


class Written(WriterCommitMessage):
    def __init__(self, files):
        self.files = files


class BamWriter(DataSourceWriter):
    """Each task writes one file, with its index if ``index`` is set; files show in the folder when the job commits."""

    def __init__(self, options, overwrite):
        self.path, self.overwrite = options["path"], overwrite
        self.header = options.get("header", "")
        self.references = json.loads(options["references"])
        self.index = options.get("index", "false").lower() == "true"
        self.hidden = f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator):
        store, folder = file_system(self.path)
        hidden, name = f"{folder}/{self.hidden}", f"part-{uuid.uuid4().hex}.bam"
        refs = {n: k for k, (n, _) in enumerate(self.references)}
        built, files = Builder(len(refs)), []
        store.create_dir(hidden)
        with store.open_output_stream(f"{hidden}/{name}") as out:
            blocks_of = BlockWriter(out)
            text = self.header.encode()
            listed = b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in self.references)
            blocks_of.write(b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(refs)) + listed)
            if blocks_of.held:
                blocks_of.flush()
            for row in iterator:
                record = row["record"] if "record" in row else None
                record = encode(row, refs) if record is None else bytes(record)
                if len(blocks_of.held) + len(record) > FULL and blocks_of.held:
                    blocks_of.flush()
                low = blocks_of.place
                blocks_of.write(record)
                if self.index:
                    built.add(*end_of(record), low, blocks_of.place)
            blocks_of.close()
        files.append(name)
        if self.index:
            with store.open_output_stream(f"{hidden}/{name}.bai") as out:
                out.write(built.data())
            files.append(f"{name}.bai")
        return Written(files)

    def commit(self, messages):
        from pyarrow import fs

        store, folder = file_system(self.path)
        if self.overwrite:
            for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if info.type == fs.FileType.File and info.path.endswith((".bam", ".bai")):
                    store.delete_file(info.path)
        for name in [name for message in messages if message for name in message.files]:
            store.move(f"{folder}/{self.hidden}/{name}", f"{folder}/{name}")
        self._clear(store, folder)

    def abort(self, messages):
        self._clear(*file_system(self.path))

    def _clear(self, store, folder):
        if store.get_file_info(f"{folder}/{self.hidden}").type.name == "Directory":
            store.delete_dir(f"{folder}/{self.hidden}")


class BamSource(DataSource):
    @classmethod
    def name(cls):
        return "bam"

    def schema(self):
        return SCHEMA + ", record binary" if self.options.get("raw", "false").lower() == "true" else SCHEMA

    def reader(self, schema):
        return BamReader(self.options)

    def writer(self, schema, overwrite):
        return BamWriter(self.options, overwrite)


def read_bam(spark, path: str, **options):
    """Alignment records of one BAM file or a folder of them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").options(**options).load(path)


def bam_header(path: str) -> tuple[str, list]:
    """Header text and references (name, length) of the first file at ``path``."""
    store, files = BamReader({"path": path})._files()
    with store.open_input_file(files[0].path) as handle:
        text, references, _ = full_header(handle)
    return text, references


def write_bam(df, path: str, references: list, header: str = "", index: bool = False, mode: str = "overwrite") -> None:
    """Rows as BAM files, one a partition; the column ``record``, where there is one, is written as it is.

    ``references`` are (name, length).  With ``index`` the rows of every partition must be sorted by the references'
    order and position.
    """
    df.sparkSession.dataSource.register(BamSource)
    options = {"references": json.dumps(references), "header": header, "index": str(index).lower()}
    df.write.format("bam").options(**options).mode(mode).save(path)
