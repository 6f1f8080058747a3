"""Real files: tags and properties by ranged reads, layouts and compressions, digests, masks and sorted lists."""

import glob
import hashlib
import os
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framespan.operators import masks, releases
from framespan.sources import codecs, files, ranged, sinks


def lzw(data):
    """Codes of the longest known texts, widened one code early."""
    table, width, out, text = {bytes([k]): k for k in range(256)}, 9, "", b""
    out += format(256, "09b")
    size = 258
    for byte in data:
        longer = text + bytes([byte])
        if longer in table:
            text = longer
            continue
        out += format(table[text], f"0{width}b")
        table[longer], size, text = size, size + 1, bytes([byte])
        if size == 1 << width and width < 12:
            width += 1
        elif size == 4094:
            out += format(256, f"0{width}b")
            table, size, width = {bytes([k]): k for k in range(256)}, 258, 9
    out += format(table[text], f"0{width}b") if text else ""
    size += 1
    width += size == 1 << width and width < 12
    out += format(257, f"0{width}b")
    return int(out + "0" * (-len(out) % 8), 2).to_bytes((len(out) + 7) // 8, "big")


def runs(data):
    out, k = b"", 0
    while k < len(data):
        n = 1
        while k + n < len(data) and n < 128 and data[k + n] == data[k]:
            n += 1
        if n > 2:
            out += bytes([257 - n]) + data[k : k + 1]
            k += n
        else:
            out += bytes([n - 1]) + data[k : k + n]
            k += n
    return out


PACK = {1: lambda d: d, 5: lzw, 8: zlib.compress, 32773: runs}


def make_tiff(image, *, order="<", compression=1, predictor=1, rows=None, tile=None, samples=1, big=False, extra=(), pages=1, last=0):
    h, w = image.shape
    image = np.repeat(image[:, :, None], samples, 2).astype(order + "u2")
    image[:, :, 1:] = 9
    rows = rows or h
    parts = []
    if tile:
        th, tw = tile
        padded = np.zeros((-(-h // th) * th, -(-w // tw) * tw, samples), order + "u2")
        padded[:h, :w] = image
        parts = [padded[y : y + th, x : x + tw] for y in range(0, h, th) for x in range(0, w, tw)]
    else:
        parts = [image[y : y + rows] for y in range(0, h, rows)]
    if predictor == 2:
        parts = [np.concatenate([p[:, :1], np.diff(p.astype(np.int64), axis=1).astype(np.uint16)], 1).astype(order + "u2") for p in parts]
    packed = [PACK[compression](p.tobytes()) for p in parts]
    head = 16 if big else 8
    offsets = [head + sum(map(len, packed[:k])) for k in range(len(packed))]
    body = b"".join(packed)
    fields = [(256, 4, [w]), (257, 4, [h]), (258, 3, [16] * samples), (259, 3, [compression]), (277, 3, [samples]), (317, 3, [predictor])]
    fields += [(322, 4, [tile[1]]), (323, 4, [tile[0]]), (324, 4, offsets), (325, 4, list(map(len, packed)))] if tile else [(273, 4, offsets), (278, 4, [rows]), (279, 4, list(map(len, packed)))]
    fields += list(extra)
    field, count, wide = ("Q", "Q", 8) if big else ("I", "H", 4)
    entries = b""
    for tag, kind, values in sorted(fields):
        data = values if isinstance(values, bytes) else struct.pack(f"{order}{len(values)}{ {3: 'H', 4: 'I'}[kind]}", *values)
        n = len(values)
        if len(data) > wide:
            at = head + len(body)
            body += data + b"\0" * (len(data) % 2)
            data = struct.pack(order + field, at)
        entries += struct.pack(order + "HH" + field, tag, kind, n) + data.ljust(wide, b"\0")
    start = head + len(body)
    length = struct.calcsize(order + count) + len(entries) + wide
    for k in range(pages):
        following = start + length * (k + 1) if k + 1 < pages else last and start
        body += struct.pack(order + count, len(fields)) + entries + struct.pack(order + field, following)
    mark = {"<": b"II", ">": b"MM"}[order]
    return mark + (struct.pack(order + "HHHQ", 43, 8, 0, start) if big else struct.pack(order + "HI", 42, start)) + body


def picture(h=23, w=37):
    rnd = np.random.default_rng(h * w)
    image = rnd.integers(0, 1 << 16, (h, w))
    image[3:15, 2:30] = 8829
    return image


LAYOUTS = [dict(order=o, compression=c, predictor=p, **layout) for o in "<>" for c in PACK for p in (1, 2) for layout in ({}, {"rows": 5}, {"tile": (16, 16)}, {"samples": 3, "big": True, "rows": 7})]


def test_every_layout_gives_equal_pixels(spark):
    image = picture()
    rows = spark.createDataFrame([(str(k), make_tiff(image, **layout)) for k, layout in enumerate(LAYOUTS)], "path string, content binary")
    found = files.decode_thermal(rows).collect()
    assert [r.error for r in found] == [None] * len(LAYOUTS)
    assert all((r.height, r.width) == image.shape and r.dn == image.ravel().tolist() for r in found)


def test_long_tables_and_damaged_files(spark):
    image = picture(120, 160)  # the table of codes fills and starts anew
    assert codecs.read_tiff(make_tiff(image, compression=5))[2].tolist() == image.ravel().tolist()
    whole = [make_tiff(picture(), compression=c, tile=t) for c in PACK for t in (None, (16, 16))]
    rnd = random.Random(8)
    broken = [d[: rnd.randrange(len(d))] for d in whole for _ in range(4)] + [b"", b"II*\0", make_tiff(picture(), pages=2), make_tiff(picture(), extra=[(284, 3, [2])], samples=2), make_tiff(picture()).replace(struct.pack("<HHIH", 259, 3, 1, 1), struct.pack("<HHIH", 259, 3, 1, 7))]
    found = files.decode_thermal(spark.createDataFrame([(str(k), d) for k, d in enumerate(broken)], "path string, content binary")).collect()
    assert len(found) == len(broken) and all(r.error and r.dn is None for r in found)


def test_page_tags(spark, tmp_path):
    xmp = b'<x:xmpmeta xmlns:F="u"><F:TlinearGain>0.04</F:TlinearGain><F:IsNormalized> 1 </F:IsNormalized></x:xmpmeta>' + b" " * 3000
    extra = [(271, 2, b"FLIR\0"), (272, 2, b"Vue Pro R 640 13mm\0"), (700, 1, xmp)]
    image = np.full((512, 640), 8000)
    made = {
        "good": make_tiff(image, extra=extra), "big": make_tiff(image, extra=extra, big=True, order=">"), "packed": make_tiff(image, extra=extra, compression=8, tile=(64, 64)),
        "small": make_tiff(picture(), extra=extra), "two": make_tiff(image, extra=extra, pages=2), "bare": make_tiff(image), "rgb": make_tiff(image, extra=extra, samples=3),
        "other": make_tiff(image, extra=[(271, 2, b"X\0"), (272, 2, b"Y\0"), (700, 1, xmp.replace(b"0.04", b"0.4"))]), "signed": make_tiff(image, extra=[*extra, (339, 3, [2])]),
        "circle": make_tiff(image, extra=extra, pages=2, last=1), "text": b"no image", "cut": make_tiff(image, extra=extra)[:-40], "empty": b"",
    }
    for name, data in made.items():
        (tmp_path / f"{name} x.tiff").write_bytes(data)
    found = {r.path.rsplit("/", 1)[1][:-7]: r for r in releases.page_issues(ranged.page_tags(ranged.walk_files(spark, str(tmp_path)))).collect()}
    issues = {n: r.issues for n, r in found.items() if r.error is None}
    assert issues == {
        "good": [], "big": [], "packed": [], "small": ["height", "width"], "two": ["page_count"], "bare": ["make", "model", "xmp"],
        "rgb": ["samples"], "other": ["make", "model", "gain"], "signed": ["dtype"],
    }
    assert (found["good"].page_count, found["good"].dtype, found["good"].xmp) == (1, "uint16", xmp.decode())
    assert {n for n, r in found.items() if r.error} == {"circle", "text", "cut", "empty"}


def test_tags_are_read_without_pixels(tmp_path):
    read = []

    class Counted:
        def __init__(self, source):
            self.source = source

        def seek(self, at):
            self.source.seek(at)

        def read(self, n):
            read.append(n)
            return self.source.read(n)

    path = tmp_path / "a.tiff"
    path.write_bytes(make_tiff(np.zeros((512, 640), int), extra=[(700, 1, b"x" * 500)]))
    with ranged.open_file(str(path)) as source:
        for order, fields in ranged.directories(Counted(source)):
            assert bytes(ranged.value(Counted(source), order, fields[700])) == b"x" * 500
    assert sum(read) < 1500 < path.stat().st_size


def box(kind, *bodies, wide=False):
    body = b"".join(bodies)
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body if wide else struct.pack(">I4s", len(body) + 8, kind) + body


def track(kind, times, *, scale=30000, size=(3840, 2160), long=False):
    header = struct.pack(">B3x", long) + (struct.pack(">QQIQ", 0, 0, scale, 1) if long else struct.pack(">IIII", 0, 0, scale, 1)) + bytes(4)
    entry = box(b"avc1", bytes(24), struct.pack(">HH", *size), bytes(50))
    table = box(b"stbl", box(b"stsd", bytes(4), struct.pack(">I", 1), entry), box(b"stts", bytes(4), struct.pack(">I", len(times)), *[struct.pack(">II", *t) for t in times]))
    return box(b"trak", box(b"tkhd", bytes(84)), box(b"mdia", box(b"mdhd", header), box(b"hdlr", bytes(8), kind, bytes(13)), box(b"minf", box(b"vmhd", bytes(12)), table)))


def test_video_properties(spark, tmp_path):
    brand, data = box(b"ftyp", b"isom", bytes(12)), box(b"mdat", bytes(100_000))
    moov = box(b"moov", box(b"mvhd", bytes(100)), track(b"soun", [(9, 1024)]), track(b"vide", [(16_875, 1000)]))
    made = {
        "before": brand + moov + data, "after": brand + data + moov, "wide": brand + box(b"mdat", bytes(50), wide=True) + moov, "open": brand + moov + struct.pack(">I4s", 0, b"mdat") + bytes(9),
        "uneven": brand + box(b"moov", track(b"vide", [(10, 1000), (20, 1001)], size=(640, 480), long=True)), "sound": brand + box(b"moov", track(b"soun", [(9, 1)])),
        "none": brand + data, "cut": (brand + data + moov)[:-300], "empty": b"", "still": brand + box(b"moov", track(b"vide", [])),
    }
    for name, content in made.items():
        (tmp_path / f"{name}.mp4").write_bytes(content)
    found = {os.path.basename(r.path)[:-4]: r for r in ranged.video_properties(ranged.walk_files(spark, f"file://{tmp_path}")).collect()}
    for name in ("before", "after", "wide", "open"):
        r = found[name]
        assert (r.fps, r.frame_count, r.width, r.height, r.duration_s, r.error) == (30.0, 16_875, 3840, 2160, 562.5, None)
    r = found["uneven"]
    assert (r.fps, r.frame_count, r.width, r.height) == (pytest.approx(30 * 30000 / (10_000 + 20_020)), 30, 640, 480)
    assert {n for n, r in found.items() if r.error} == {"sound", "none", "cut", "still"} | {"empty"}
    rows = spark.createDataFrame([("a", 30.0, 16_875, 3840, 2160)], "sequence_id string, fps double, frame_count long, width int, height int")
    kept = ranged.video_properties(files.list_files(spark, str(tmp_path), "after.mp4")).withColumn("sequence_id", F.lit("a"))
    expected = rows.select("sequence_id", F.col("frame_count").alias("expected"))
    assert releases.video_issues(kept, expected).first().issues == []


def test_digests_are_read_in_blocks(spark, tmp_path):
    contents = {"empty": b"", "a": b"a", "exact": bytes(range(256)) * 64, "long": random.Random(1).randbytes(300_001)}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    listing = ranged.walk_files(spark, str(tmp_path)).select("path").union(spark.createDataFrame([(f"{tmp_path}/gone",)], "path string"))
    found = {os.path.basename(r.path): r for r in ranged.digests(listing, block=1 << 12).collect()}
    assert {n: (r.length, r.digest) for n, r in found.items() if not r.error} == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items()}
    assert found["gone"].error and found["gone"].digest is None


def listed(folder):
    return b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{folder}/part-*"))).decode()


def test_lists_are_sorted_over_all_files(spark, tmp_path):
    rnd = random.Random(2)
    root = tmp_path / "payload"
    names = [f"{rnd.choice('abzé_')}/{rnd.randrange(10**6)}{rnd.choice(['', ' x', '漢', '.txt'])}" for _ in range(300)]
    contents = {n: n.encode() * rnd.randrange(4) for n in names}
    for name, data in {**contents, "checksums.sha256": b"no", ".cache/a": b"no", "a/.DS_Store": b"no"}.items():
        os.makedirs((root / name).parent, exist_ok=True)
        (root / name).write_bytes(data)
    digest = lambda d: hashlib.sha256(d).hexdigest()
    whole = lambda entries: "".join(f"{digest(d)}  {n}\n" for n, d in sorted(entries.items(), key=lambda e: e[0].encode()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, also of a short list
    old, new = f"file://{tmp_path}/old", f"file://{tmp_path}/new"
    sinks.write_checksums(releases.hashed_files(spark, str(root)), old)
    assert listed(tmp_path / "old") == whole(contents)
    assert len(glob.glob(f"{tmp_path}/old/part-*")) > 1
    changed = {n: b"changed" for n in names[::7]} | {"new/file": b"new"}
    for name, data in {**changed, names[1]: b"not chosen"}.items():
        os.makedirs((root / name).parent, exist_ok=True)
        (root / name).write_bytes(data)
    chosen = spark.createDataFrame([(n,) for n in [*changed, "not there"]], "path string")
    releases.refresh_checksum_list(spark, str(root), old, chosen, new)
    expected = {**contents, **changed}
    assert listed(tmp_path / "new") == whole(expected)
    os.remove(root / names[2])
    wrong = {r.path: r.state for r in releases.verified_files(spark, str(root), files.checksum_lines(spark.read.text(new))).collect()}
    assert wrong == {names[1]: "changed", names[2]: "missing"}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def thermal(tmp_path, name, image, **layout):
    folder = tmp_path / name
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "thermal.tiff").write_bytes(make_tiff(image, **layout))
    return folder / "mask_80c.png"


def test_masks_are_created_preserved_and_in_conflict(spark, tmp_path):
    images = {f"s/{k:02}": picture(20 + k, 30) for k in range(9)}
    images["s/00"][:] = 0
    paths = {n: thermal(tmp_path, n, image, compression=[1, 5, 8][k % 3]) for k, (n, image) in enumerate(images.items())}
    right = {n: codecs.write_palette_png((image >= 8829).astype(np.uint8), masks.PALETTE) for n, image in images.items()}
    for name in ("s/01", "s/02"):
        paths[name].write_bytes(right[name])
    before = paths["s/01"].stat().st_mtime_ns
    report = masks.build_masks(spark, str(tmp_path), contract=False)
    states = {r.path.split("/s/")[1][:2]: r.state for r in report.collect()}
    assert states == {n[2:]: "preserved" if n in ("s/01", "s/02") else "created" for n in images} and all(r.valid for r in report.collect())
    assert {n: p.read_bytes() for n, p in paths.items()} == right and paths["s/01"].stat().st_mtime_ns == before
    total = sum(i.size for i in images.values())
    assert tuple(masks.mask_report(report).first()) == (9, 7, 2, sum(int((i >= 8829).sum()) for i in images.values()), total, 1)
    assert glob.glob(f"{tmp_path}/**/.*.tmp", recursive=True) == []
    # every kind of conflict, and nothing is written
    flipped = (images["s/03"] < 8829).astype(np.uint8)
    wrong = {"s/03": codecs.write_palette_png(flipped, masks.PALETTE), "s/04": codecs.write_palette_png(flipped, masks.PALETTE), "s/05": codecs.write_palette_png((images["s/05"] >= 8829).astype(np.uint8), masks.PALETTE[::-1]), "s/06": right["s/06"][:-9], "s/07": b""}
    for name, data in wrong.items():
        paths[name].write_bytes(data)
    paths["s/08"].unlink()
    thermal(tmp_path, "s/09", picture())
    (tmp_path / "s/09/thermal.tiff").write_bytes(b"II*\0")
    found = {r.path.split("/s/")[1][:2]: r for r in masks.build_masks(spark, str(tmp_path), contract=False).collect()}
    assert {n: r.state for n, r in found.items()} == {"00": "preserved", "01": "preserved", "02": "preserved", **dict.fromkeys(("03", "04", "05", "06", "07"), "conflicting"), "08": "created", "09": "unreadable"}
    assert all(r.error for r in found.values() if r.state in ("conflicting", "unreadable"))
    assert not paths["s/08"].exists() and not found["08"].valid


def test_the_page_contract_stops_a_build(spark, tmp_path):
    mask = thermal(tmp_path, "a", picture())
    row = masks.build_masks(spark, str(tmp_path)).first()
    assert (row.state, row.valid) == ("unreadable", False) and row.error.startswith("page: height, width") and not mask.exists()


def test_a_repeated_or_killed_write_leaves_one_file(tmp_path, monkeypatch):
    path = f"file://{tmp_path}/a/mask.png"
    sinks.put_file(path, b"one")
    sinks.put_file(path, b"one")
    assert os.listdir(tmp_path / "a") == ["mask.png"] and (tmp_path / "a/mask.png").read_bytes() == b"one"

    class Killed:
        """A store in which the write ends before the rename."""

        def __init__(self, system):
            self.system = system

        def move(self, *_):
            assert len(os.listdir(tmp_path / "a")) == 2
            raise OSError("killed")

        def __getattr__(self, name):
            return getattr(self.system, name)

    system, place = sinks.located(path)
    monkeypatch.setattr(sinks, "located", lambda _: (Killed(system), place))
    with pytest.raises(OSError, match="killed"):
        sinks.put_file(path, b"two")
    assert (tmp_path / "a/mask.png").read_bytes() == b"one"
    assert os.listdir(tmp_path / "a") == ["mask.png"]


@pytest.mark.parametrize("depth", [1, 2, 4, 8])
@pytest.mark.parametrize("kind", [0, 1, 2, 3, 4])
def test_png_filters(depth, kind):
    rnd = np.random.default_rng(depth * 10 + kind)
    cells = rnd.integers(0, 1 << depth, (11, 13), dtype=np.uint8)
    bits = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - depth :].reshape(11, -1)
    lines = np.packbits(bits, axis=1).astype(int)
    raw, above = b"", [0] * lines.shape[1]
    for line in lines.tolist():
        row = []
        for x, cell in enumerate(line):
            left, corner, up = (line[x - 1] if x else 0), (above[x - 1] if x else 0), above[x]
            p = left + up - corner
            near = left if abs(p - left) <= abs(p - up) and abs(p - left) <= abs(p - corner) else up if abs(p - up) <= abs(p - corner) else corner
            row.append((cell - [0, left, up, (left + up) // 2, near][kind]) % 256)
        raw += bytes([kind, *row])
        above = line
    data = codecs.PNG_HEAD + codecs._chunk(b"IHDR", struct.pack(">IIBBBBB", 13, 11, depth, 3, 0, 0, 0)) + codecs._chunk(b"PLTE", masks.PALETTE) + codecs._chunk(b"IDAT", zlib.compress(raw)) + codecs._chunk(b"IEND", b"")
    found, palette = codecs.read_index_png(data)
    assert (found == cells).all() and palette == masks.PALETTE
