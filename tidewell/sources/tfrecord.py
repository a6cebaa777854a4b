"""TFRecord files of feature records, as a Python data source and as output.

A file is a chain of frames (length, checksum, payload, checksum) without an index. The checksum of
the length lets a task that starts inside a file find the next frame, so a large file is read by byte ranges.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.operators.features import RECORD
from tidewell.session import settled

SPLIT_BYTES = 64 << 20
# Records that are written at a time.
WRITE_ROWS = 1024


def _checksums():
    """Masked CRC-32C (reflected polynomial) of many pieces of a buffer at once. A function built in here travels to the executors by value."""
    import numpy as np

    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1).astype(np.uint32)
    block, lengthened = 1024, []

    def fed(crc, byte):
        return table[(crc ^ byte) & 0xFF] ^ (crc >> 8)

    # Two bytes and two more zero bytes after them: four bytes are taken by two look-ups.
    pair = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(2):
        pair = fed(pair, 0)
    early = fed(fed(pair, 0), 0)

    def states(data, starts, sizes, crc):
        """States after each piece; pieces are at most `block` long."""
        order = np.argsort(-sizes, kind="stable")
        at, left, crc = starts[order], sizes[order], crc[order]
        padded = np.concatenate([data, np.zeros(4, np.uint8)])
        four = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
        whole = left // 4
        for i in range(int(whole[0]) if len(whole) else 0):
            n = int(np.searchsorted(-whole, -i, "left"))
            mixed = crc[:n] ^ four[at[:n] + 4 * i]
            crc[:n] = early[mixed & 0xFFFF] ^ pair[mixed >> 16]
        at = at + 4 * whole
        for i in range(3):
            some = left % 4 > i
            crc[some] = fed(crc[some], padded[at[some] + i])
        out = np.empty_like(crc)
        out[order] = crc
        return out

    def masked(data, starts, sizes):
        starts, sizes = np.asarray(starts, np.int64), np.asarray(sizes, np.int64)
        # Long pieces are taken in blocks side by side. The first one has what is left, so the others are whole.
        more = np.maximum(0, (sizes - 1) // block)
        first = sizes - more * block
        crc = states(data, starts, first, np.full(len(starts), 0xFFFFFFFF, np.uint32))
        long = np.flatnonzero(more)
        if len(long):
            if not lengthened:
                # What a block of zeros makes of each byte of a state.
                given = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
                zero = np.zeros(len(given), np.int64)
                after = states(np.zeros(block, np.uint8), zero, zero + block, given)
                lengthened.extend(after.reshape(4, 256).tolist())
            a, b, c, d = lengthened
            for i in long.tolist():
                places = starts[i] + first[i] + block * np.arange(more[i])
                own = int(crc[i])
                for found in states(data, places, np.full(len(places), block), np.zeros(len(places), np.uint32)).tolist():
                    own = a[own & 0xFF] ^ b[own >> 8 & 0xFF] ^ c[own >> 16 & 0xFF] ^ d[own >> 24] ^ found
                crc[i] = own
        crc ^= np.uint32(0xFFFFFFFF)
        return (crc >> np.uint32(15) | crc << np.uint32(17)) + np.uint32(0xA282EAD8)

    return masked, table


def _source():
    """The data source class. It is built in here so that it travels to the executors by value."""
    import struct

    import numpy as np
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    masked, wide_table = _checksums()

    def varint(buf, at):
        value = shift = 0
        while True:
            byte = buf[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value, at
            shift += 7

    def fields(buf):
        """(number, value) of each protobuf field; nested messages stay bytes."""
        at, end, found = 0, len(buf), []
        while at < end:
            tag = buf[at]
            at += 1
            if tag > 127:
                tag, at = varint(buf, at - 1)
            kind = tag & 7
            if kind == 2:
                size = buf[at]
                at += 1
                if size > 127:
                    size, at = varint(buf, at - 1)
                value, at = buf[at : at + size], at + size
            elif kind == 0:
                value, at = varint(buf, at)
            elif kind == 5:
                value, at = buf[at : at + 4], at + 4
            elif kind == 1:
                value, at = buf[at : at + 8], at + 8
            else:
                raise ValueError(f"unexpected wire type {kind}")
            found.append((tag >> 3, value))
        return found

    def signed(value):
        return value - (1 << 64) if value >> 63 else value

    def ints(buf):
        out = []
        for _, value in fields(buf):
            if isinstance(value, int):
                out.append(signed(value))
                continue
            out += unpacked(value)
        return out

    def unpacked(buf):
        """All varints of a packed list: one by one in a short list, else at once, seven bits a byte, the last byte of each below 128."""
        if len(buf) < 64:
            at, found = 0, []
            while at < len(buf):
                value, at = varint(buf, at)
                found.append(signed(value & 0xFFFFFFFFFFFFFFFF))
            return found
        data = np.frombuffer(buf, np.uint8)
        if not len(data):
            return []
        first = np.concatenate([[0], np.flatnonzero(data < 128)[:-1] + 1])
        place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))
        bits = (data & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64)
        return np.bitwise_or.reduceat(bits, first).view(np.int64).tolist()

    def floats(buf):
        packed = b"".join(value for _, value in fields(buf))
        return list(struct.unpack(f"<{len(packed) // 4}f", packed))

    def feature(buf):
        """Field (1 bytes, 2 floats, 3 ints) and its values."""
        for number, value in fields(buf):
            if number == 1:
                return 1, [v for _, v in fields(value)]
            if number == 2:
                return 2, floats(value)
            if number == 3:
                return 3, ints(value)
        return None

    def example(payload):
        record = {}
        for number, features in fields(payload):
            if number != 1:
                continue
            for _, entry in fields(features):
                parts = dict(fields(entry))
                value = feature(parts.get(2, b""))
                if value is not None:
                    record[parts.get(1, b"").decode("utf-8")] = value
        return record

    def filesystem(path):
        from pyarrow import fs

        if "://" in path or path.startswith("file:"):
            return fs.FileSystem.from_uri(path)
        return fs.LocalFileSystem(), path

    def stored(buf, places):
        return sum(buf[places + i].astype(np.uint32) << np.uint32(8 * i) for i in range(4))

    def next_frame(stream, begin, end, total):
        """Offset of the first frame that starts in begin..end, found by the checksums of its length."""
        step = 1 << 20
        for at in range(begin, end, step):
            n = min(step, end - at)
            data = np.frombuffer(stream.read_at(min(n + 11, total - at), at), np.uint8)
            n = min(n, len(data) - 11)
            if n <= 0:
                return None
            crc = np.full(n, 0xFFFFFFFF, np.uint32)
            for i in range(8):
                crc = wide_table[(crc ^ data[i : i + n]) & 0xFF] ^ (crc >> np.uint32(8))
            crc ^= np.uint32(0xFFFFFFFF)
            crc = (crc >> np.uint32(15) | crc << np.uint32(17)) + np.uint32(0xA282EAD8)
            found = sum(data[8 + i : 8 + i + n].astype(np.uint32) << np.uint32(8 * i) for i in range(4))
            for hit in np.flatnonzero(crc == found).tolist():
                size = int.from_bytes(data[hit : hit + 8].tobytes(), "little")
                if at + hit + size + 16 <= total:
                    return at + hit
        return None

    # Bytes that are read at a time.
    READ = 4 << 20

    class Range(InputPartition):
        def __init__(self, path, begin, end, total):
            self.path, self.begin, self.end, self.total = path, begin, end, total

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.path = options["path"]
            self.limit = int(options["limit"]) if options.get("limit") else None
            self.verify = str(options.get("verify", "false")).lower() == "true"
            self.count = str(options.get("count", "false")).lower() == "true"
            self.split = int(options.get("splitbytes") or options.get("splitBytes"))

        def partitions(self):
            from pyarrow import fs

            system, path = filesystem(self.path)
            info = system.get_file_info(path)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(self.path)
            if info.is_file:
                found = [(self.path, info.size)]
            else:
                files = system.get_file_info(fs.FileSelector(path, recursive=True))
                prefix = self.path.split("://", 1)[0] + "://" if "://" in self.path else ""
                found = sorted((prefix + f.path, f.size) for f in files if f.is_file and f.base_name[:1] not in "._")
            step = self.split if self.limit is None else 1 << 62
            return [Range(name, begin, min(begin + step, size), size) for name, size in found for begin in range(0, max(size, 1), step)]

        def blocks(self, part):
            """Bytes with the places and sizes of the payloads in them, of the frames that start in a range; the header after the last one is checked too.

            Files are read some megabytes at a time. Where frames are only counted, the bytes of large ones are not read.
            """
            system, name = filesystem(part.path)
            with system.open_input_file(name) as stream:
                at = 0 if not part.begin else next_frame(stream, part.begin, part.end, part.total)
                wanted, rest = READ, self.limit
                while at is not None and at < part.total and rest != 0:
                    data = stream.read_at(min(wanted, part.total - at), at)
                    wanted, place, heads, sizes, cut, last = READ, 0, [], [], False, False
                    while at + place < part.total and len(sizes) != rest:
                        if place + 12 > len(data):
                            if at + place + 12 > part.total:
                                self.checked(part, data, heads)
                                raise ValueError(f"{part.path}: damaged record length")
                            break
                        (size,) = struct.unpack_from("<Q", data, place)
                        heads.append(place)
                        last, cut = at + place >= part.end, at + place + size + 16 > part.total
                        if last or cut:
                            break
                        if place + size + 16 > len(data) and not self.count:
                            # Read again from here on; a frame that alone is larger is read by its size.
                            heads.pop()
                            wanted = max(READ, size + 16)
                            break
                        sizes.append(size)
                        place += size + 16
                    self.checked(part, data, heads)
                    if not heads and wanted > READ:
                        self.checked(part, data, [0])
                    if cut and not last:
                        raise ValueError(f"{part.path}: file ends inside a record")
                    if sizes:
                        yield data, heads[: len(sizes)], sizes
                    if last:
                        return
                    at, rest = at + place, None if rest is None else rest - len(sizes)

        def checked(self, part, data, heads):
            if heads:
                buf, heads = np.frombuffer(data, np.uint8), np.array(heads, np.int64)
                if (masked(buf, heads, np.full(len(heads), 8)) != stored(buf, heads + 8)).any():
                    raise ValueError(f"{part.path}: damaged record length")

        def payloads(self, part):
            for data, heads, sizes in self.blocks(part):
                if self.verify:
                    buf, starts, long = np.frombuffer(data, np.uint8), np.array(heads, np.int64) + 12, np.array(sizes, np.int64)
                    if (masked(buf, starts, long) != stored(buf, starts + long)).any():
                        raise ValueError(f"{part.path}: damaged record")
                for head, size in zip(heads, sizes, strict=True):
                    yield data[head + 12 : head + 12 + size]

        def read(self, partition):
            import itertools

            import pyarrow as pa

            inner = {1: pa.binary(), 2: pa.float32(), 3: pa.int64()}
            names = {1: ("bytes_list", "bytes"), 2: ("float_list", "floats"), 3: ("int64_list", "ints")}
            feature_type = pa.struct([("kind", pa.string()), *[(names[i][1], pa.list_(inner[i])) for i in inner]])
            columns = pa.schema([
                ("file", pa.string()), ("begin", pa.int64()), ("index", pa.int64()), ("record", pa.map_(pa.string(), feature_type))])
            if self.count:
                n = sum(len(sizes) for _, _, sizes in self.blocks(partition))
                yield pa.RecordBatch.from_arrays([
                    pa.array([partition.path]), pa.array([partition.begin]), pa.array([n]), pa.array([None], columns.field("record").type)], schema=columns)
                return

            def records(rows):
                """The map column, put together from flat lists."""
                found = [example(p) for p in rows]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                values = [v for record in found for v in record.values()]
                kinds = np.array([k for k, _ in values], np.int8)
                lists = []
                for i, kind in inner.items():
                    own = [v if k == i else () for k, v in values]
                    offsets = pa.array(np.cumsum([0, *map(len, own)]), pa.int32())
                    lists.append(pa.ListArray.from_arrays(offsets, pa.array(list(itertools.chain.from_iterable(own)), kind), mask=pa.array(kinds != i)))
                told = pa.array([names[k][0] for k, _ in values], pa.string())
                items = pa.StructArray.from_arrays([told, *lists], fields=list(feature_type))
                return pa.MapArray.from_arrays(pa.array(ends), pa.array([n for record in found for n in record], pa.string()), items)

            payloads, n = self.payloads(partition), 0
            while rows := list(itertools.islice(payloads, 1024)):
                yield pa.RecordBatch.from_arrays([
                    pa.array([partition.path] * len(rows), pa.string()),
                    pa.array([partition.begin] * len(rows), pa.int64()),
                    pa.array(range(n, n + len(rows)), pa.int64()),
                    records(rows),
                ], schema=columns)
                n += len(rows)

    class TFRecordSource(DataSource):
        @classmethod
        def name(cls):
            return "tfrecord_examples"

        def schema(self):
            return f"file string, begin bigint, index bigint, record {RECORD}"

        def reader(self, schema):
            return Reader(self.options)

    return TFRecordSource


def read_tfrecord(
    spark: SparkSession, path: str, limit: int | None = None, verify: bool = False, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Records of one file or of all files in a folder, with their file and place in it.

    Files above `split_bytes` are read in ranges; the place of a record is its place in the range plus the records of earlier
    ranges, which are counted first, by their headers alone. `limit` keeps the first records in file order, and each task
    stops reading there. `verify` also checks the payload checksums; the length checksums are always checked.
    """
    spark.dataSource.register(_source())
    reader = spark.read.format("tfrecord_examples").option("verify", str(verify).lower()).option("splitBytes", str(split_bytes))
    if limit is not None:
        return reader.option("limit", str(limit)).load(path).drop("begin").orderBy("file", "index").limit(limit)
    counts = settled(reader.option("count", "true").load(path).select("file", "begin", F.col("index").alias("n")), "frame-counts")
    found = spark.read.format("tfrecord_examples").option("verify", str(verify).lower()).option("splitBytes", str(split_bytes)).load(path)
    if counts.where("begin > 0").isEmpty():
        return found.drop("begin")
    # A file has as many rows as ranges, of tens of megabytes each.
    earlier = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("file").alias("f"), F.col("begin").alias("b"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    joined = found.join(settled(starts, "frame-starts"), (F.col("file") == F.col("f")) & (F.col("begin") == F.col("b")))
    return joined.select("file", (F.col("index") + F.col("start")).alias("index"), "record")


_BYTES = [bytes([i]) for i in range(128)]


def _varint(n: int) -> bytes:
    if 0 <= n < 128:
        return _BYTES[n]
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _message(number: int, data: bytes) -> bytes:
    return _BYTES[number << 3 | 2] + _varint(len(data)) + data


@lru_cache(1024)
def _name(name: str) -> bytes:
    return _message(1, name.encode())


def _example(entries: list[tuple[str, str, list, list, list]]) -> bytes:
    """A record out of the name, the kind and the three lists of its features."""
    out = []
    for name, kind, texts, reals, wholes in sorted(entries, key=lambda e: e[0]):
        if kind == "bytes_list":
            inner = _message(1, b"".join([_message(1, v) for v in texts or []]))
        elif kind == "float_list":
            inner = _message(2, _message(1, struct.pack(f"<{len(reals)}f", *reals)) if reals else b"")
        else:
            inner = _message(3, _message(1, b"".join(map(_varint, wholes))) if wholes else b"")
        out.append(_message(1, _name(name) + _message(2, inner)))
    return _message(1, b"".join(out))


def _payloads(records: pa.MapArray) -> list[bytes]:
    """Lists of plain values are taken out of Arrow, not records as nested objects."""
    if records.null_count:
        raise ValueError("a record is null")
    ends = records.offsets.to_pylist()
    # The entries of a slice: Arrow gives those of the whole batch.
    first, n = ends[0], ends[-1] - ends[0]
    items = [records.keys.slice(first, n).to_pylist(), *[field.to_pylist() for field in records.items.slice(first, n).flatten()]]
    entries = list(zip(*items, strict=True))
    return [_example(entries[a - first : b - first]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _frames(payloads: list[bytes], masked: Callable) -> bytes:
    sizes = np.array([len(p) for p in payloads], np.int64)
    starts = np.cumsum(sizes) - sizes
    heads = sizes.astype("<u8").tobytes()
    at = 8 * np.arange(len(sizes))
    head_crcs = masked(np.frombuffer(heads, np.uint8), at, np.full(len(at), 8)).astype("<u4").tobytes()
    crcs = masked(np.frombuffer(b"".join(payloads), np.uint8), starts, sizes).astype("<u4").tobytes()
    return b"".join([part for i, p in enumerate(payloads) for part in (heads[8 * i : 8 * i + 8], head_crcs[4 * i : 4 * i + 4], p, crcs[4 * i : 4 * i + 4])])


def _written(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
    system.create_dir(place, recursive=True)
    (masked, _), n, name = _checksums(), 0, f"part-{uuid.uuid4().hex}.tfrecord"
    draft = posixpath.join(place, f"_{name}")
    with system.open_output_stream(draft) as out:
        for batch in batches:
            for begin in range(0, len(batch), WRITE_ROWS):
                payloads = _payloads(batch["record"].slice(begin, WRITE_ROWS))
                out.write(_frames(payloads, masked))
                n += len(payloads)
    yield pa.RecordBatch.from_arrays([pa.array([draft]), pa.array([posixpath.join(place, name)]), pa.array([n])], names=["draft", "file", "rows"])


def _named(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    system, _ = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
    for batch in batches:
        for draft, name in zip(batch["draft"].to_pylist(), batch["file"].to_pylist(), strict=True):
            if system.get_file_info(draft).is_file:
                system.move(draft, name)
        yield batch.select(["file", "rows"])


def write_tfrecord(records: DataFrame, folder: str) -> DataFrame:
    """Writes the `record` column as one file per task, and returns `file` and `rows` of each.

    Tasks write drafts; only the drafts of tasks that succeeded get their names, so a task that ran twice leaves one file.
    """
    drafts = settled(records.select("record").mapInArrow(partial(_written, folder=folder), "draft string, file string, rows bigint"), "drafts")
    return settled(drafts.mapInArrow(partial(_named, folder=folder), "file string, rows bigint"), "files")
