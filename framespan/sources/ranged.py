"""Facts about files that are too large for a row: digests, image tags and video properties, by ranged reads inside tasks.

A table of paths is dealt over tasks; each task opens its files one after the other and reads the parts it needs, so memory
does not depend on a file's size.  Paths are opened with Arrow's file systems (local or mounted folders, s3, gs, hdfs); a
file that cannot be opened or read gives an error text and no facts."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from framespan.sources.shared import fresh_folder

#: bytes read at a time
BLOCK = 8 << 20
#: bytes of one tag's value, and of one box of a video's index, that are read; more is an error of the file
VALUE, INDEX = 16 << 20, 64 << 20
_ERRORS = (OSError, ValueError, KeyError, struct.error, IndexError)


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path inside it."""
    found = re.match(r"([A-Za-z][\w+.-]*):(//[^/]*)?(/.*)$", path, re.S)
    if not found or found[1] == "file":
        return fs.LocalFileSystem(), found[3] if found else path
    system, root = fs.FileSystem.from_uri(f"{found[1]}:{found[2] or '//'}/")
    return system, f"{root.rstrip('/')}{found[3]}"


def open_file(path: str) -> pa.NativeFile:
    system, inside = located(path)
    return system.open_input_file(inside)


def exactly(source: pa.NativeFile, at: int, n: int) -> bytes:
    source.seek(at)
    data = source.read(n)
    if len(data) < n:
        raise ValueError("truncated")
    return data


def facts(files: DataFrame, work: Callable[[pa.NativeFile, str], dict], schema: str) -> DataFrame:
    """path, the facts work(file, path) gives, and error; files (path) are dealt over the shuffle partitions by their path."""
    names = [part.split()[0] for part in schema.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    kinds = [types[part.split()[1]] for part in schema.split(", ")]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path in batch.column(0).to_pylist():  # a row leaves when its file is read
                row: dict = {}
                try:
                    with open_file(path) as source:
                        row, error = work(source, path), None
                except _ERRORS as failure:
                    error = str(failure) or type(failure).__name__
                values = [path, *(row.get(n) for n in names), error]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [pa.string(), *kinds, pa.string()], strict=True)], names=["path", *names, "error"])

    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").distinct().repartition(parts, "path").mapInArrow(batches, f"path string, {schema}, error string")


def walk_files(spark: SparkSession, root: str) -> DataFrame:
    """path and length of all files below a folder, hidden and empty ones too, which Spark's own listing leaves out.

    Folders are listed in tasks, one level of the tree after the other; a level's names are a table in the shared folder."""

    def listed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path in batch.column(0).to_pylist():
                system, inside = located(path)
                head = path[: len(path) - len(inside)] if path.endswith(inside) else path.split(":")[0] + "://"
                found = system.get_file_info(fs.FileSelector(inside))
                columns = [[head + f.path for f in found], [f.size for f in found], [f.type == fs.FileType.Directory for f in found]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, (pa.string(), pa.int64(), pa.bool_()), strict=True)], names=["path", "length", "inner"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level, levels = spark.createDataFrame([(root.rstrip("/"),)], "path string"), []
    while True:
        folder = fresh_folder(spark, "listing")
        level.repartition(parts, "path").mapInArrow(listed, "path string, length long, inner boolean").write.parquet(folder)
        levels.append(spark.read.parquet(folder))
        level = levels[-1].where("inner").select("path")
        if not level.limit(1).count():
            return reduce(DataFrame.unionByName, levels).where("NOT inner").select("path", "length")


def digests(files: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """path, length, digest (SHA-256, hex) and error of files (path), a block in memory at a time."""

    def work(source: pa.NativeFile, _: str) -> dict:
        digest, length = hashlib.sha256(), 0
        while data := source.read(block):
            digest.update(data)
            length += len(data)
        return {"length": length, "digest": digest.hexdigest()}

    return facts(files, work, "length long, digest string")


# fixed values of TIFF: field types (format and bytes) and the tags read
KINDS = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 6: ("b", 1), 7: ("s", 1), 8: ("h", 2), 9: ("i", 4), 10: ("ii", 8), 11: ("f", 4), 12: ("d", 8), 13: ("I", 4), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
TAGS = {256: "width", 257: "height", 258: "bits", 271: "make", 272: "model", 277: "samples", 339: "format", 700: "xmp"}
SAMPLE_FORMATS = {1: "uint", 2: "int", 3: "float"}


def directories(source: pa.NativeFile) -> Iterator[tuple[str, dict[int, tuple[int, int, bytes]]]]:
    """The directories of a TIFF in the order of their chain: byte order, and tag -> (type, count, the field's bytes).

    Both byte orders, classic and big files; pixels are not read.  A chain that comes back to a directory is an error."""
    head = exactly(source, 0, 8)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack(order + "H", head[2:4])[0] if order else None
    if version == 42:
        count, entry, offset, at = "H", 12, "I", struct.unpack(order + "I", head[4:])[0]
    elif version == 43:
        count, entry, offset, at = "Q", 20, "Q", struct.unpack(order + "Q", exactly(source, 8, 8))[0]
    else:
        raise ValueError("not a TIFF")
    seen: set[int] = set()
    while at:
        if at in seen:
            raise ValueError("directories in a circle")
        seen.add(at)
        wide = struct.calcsize(order + count)
        n = struct.unpack(order + count, exactly(source, at, wide))[0]
        if n * entry > VALUE:
            raise ValueError("a directory too large")
        body = exactly(source, at + wide, n * entry + struct.calcsize(offset))
        fields = {}
        for k in range(n):
            tag, kind, length = struct.unpack_from(order + "HH" + offset, body, k * entry)
            fields[tag] = kind, length, body[k * entry + 4 + struct.calcsize(offset) : (k + 1) * entry]
        yield order, fields
        at = struct.unpack_from(order + offset, body, n * entry)[0]


def value(source: pa.NativeFile, order: str, field: tuple[int, int, bytes]) -> tuple | bytes:
    """A field's numbers, or its bytes for texts; read from its place where it does not fit into the field."""
    kind, n, held = field
    form, size = KINDS[kind]
    if n * size > VALUE:
        raise ValueError("a value too large")
    if n * size > len(held):
        held = exactly(source, struct.unpack(order + {4: "I", 8: "Q"}[len(held)], held)[0], n * size)
    return bytes(held[:n]) if form == "s" else struct.unpack_from(order + form * n, held)


def page_tags(files: DataFrame) -> DataFrame:
    """page_count and, of the first page, height, width, dtype, bits, samples, make, model and xmp of TIFF files (path)."""

    def work(source: pa.NativeFile, _: str) -> dict:
        row: dict = {"page_count": 0}
        for order, fields in directories(source):
            row["page_count"] += 1
            if row["page_count"] == 1:
                found = {name: value(source, order, fields[tag]) for tag, name in TAGS.items() if tag in fields}
                texts = {n: (v if isinstance(v, bytes) else bytes(v)).split(b"\0")[0 if n != "xmp" else slice(None)] for n, v in found.items() if n in ("make", "model", "xmp")}
                texts = {n: (b"\0".join(v) if isinstance(v, list) else v).decode("utf-8", "replace").strip("\0") for n, v in texts.items()}
                bits, samples = found.get("bits", (1,)), found.get("samples", (1,))[0]
                kind = SAMPLE_FORMATS.get(found.get("format", (1,))[0], "other")
                row |= texts | {"height": found["height"][0], "width": found["width"][0], "bits": bits[0], "samples": samples, "dtype": f"{kind}{bits[0]}" if len(set(bits)) == 1 else "mixed"}
        return row

    return facts(files, work, "page_count int, height int, width int, dtype string, bits int, samples int, make string, model string, xmp string")


def boxes(source: pa.NativeFile, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Type, first byte of the body and end of the boxes between two places of an MP4 file; bodies are not read."""
    while start + 8 <= end:
        size, kind = struct.unpack(">I4s", exactly(source, start, 8))
        body = start + 8
        if size == 1:
            size, body = struct.unpack(">Q", exactly(source, start + 8, 8))[0], start + 16
        stop = end if size == 0 else start + size
        if stop < body or stop > end:
            raise ValueError(f"box {kind.decode('latin-1')} is cut off")
        yield kind, body, stop
        start = stop


def inner(source: pa.NativeFile, start: int, end: int, *kinds: bytes) -> tuple[int, int]:
    """The body of the first box of a path of box types."""
    for kind in kinds:
        found = next(((a, b) for k, a, b in boxes(source, start, end) if k == kind), None)
        if found is None:
            raise ValueError(f"no box {kind.decode()}")
        start, end = found
    return start, end


def video_properties(files: DataFrame) -> DataFrame:
    """fps, frame_count, width, height and duration_s of the first picture track of MP4 files (path).

    The index may stand before or behind the data.  Frames and their times are those of the table of durations; the rate is
    their mean."""

    def work(source: pa.NativeFile, _: str) -> dict:
        start, end = inner(source, 0, source.size(), b"moov")
        for kind, a, b in boxes(source, start, end):
            if kind != b"trak":
                continue
            handler = inner(source, a, b, b"mdia", b"hdlr")[0]
            if exactly(source, handler + 8, 4) != b"vide":
                continue
            clock = inner(source, a, b, b"mdia", b"mdhd")[0]
            wide = exactly(source, clock, 1)[0] == 1
            scale = struct.unpack(">I", exactly(source, clock + (20 if wide else 12), 4))[0]
            table = inner(source, a, b, b"mdia", b"minf", b"stbl")
            entry = inner(source, *table, b"stsd")[0] + 8
            width, height = struct.unpack(">HH", exactly(source, entry + 32, 4))
            times = inner(source, *table, b"stts")[0]
            n = struct.unpack(">I", exactly(source, times + 4, 4))[0]
            if n * 8 > INDEX:
                raise ValueError("a table of durations too large")
            pairs = struct.unpack(f">{2 * n}I", exactly(source, times + 8, 8 * n))
            frames, ticks = sum(pairs[::2]), sum(c * d for c, d in zip(pairs[::2], pairs[1::2], strict=True))
            if not frames or not ticks or not scale:
                raise ValueError("no frames")
            return {"fps": frames * scale / ticks, "frame_count": frames, "width": width, "height": height, "duration_s": ticks / scale}
        raise ValueError("no picture track")

    return facts(files, work, "fps double, frame_count long, width int, height int, duration_s double")
