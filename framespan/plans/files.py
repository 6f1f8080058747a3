"""Queries of real files: tags, digests, masks and sorted lists of files that Spark makes from the test tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framespan import constants as C
from framespan.operators import masks as M
from framespan.operators import releases as R
from framespan.plans.registry import query
from framespan.sources import files as S
from framespan.sources import ranged, sinks
from framespan.sources.shared import fresh_folder

#: folders that the files of one query are dealt over
FOLDERS = 256


def _number(value: Column, size: int) -> Column:
    """A whole number as bytes, the least first."""
    digits = F.lpad(F.hex(value.cast("long")), 2 * size, "0")
    return F.unhex(F.concat(*[F.substring(digits, 2 * (size - k) - 1, 2) for k in range(size)]))


def tiff(dn: Column, width: Column, height: Column, *, make: Column | None = None, xmp: Column | None = None, pages: Column | None = None) -> Column:
    """The bytes of a 16-bit TIFF of the cells dn: header, pixels, texts, and one directory or a chain of equal ones."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    pixels = F.unhex(F.array_join(F.transform(dn, lambda x: F.concat(F.substring(F.lpad(F.hex(x), 4, "0"), 3, 2), F.substring(F.lpad(F.hex(x), 4, "0"), 1, 2))), ""))
    texts = [(271, 2, make), (272, 2, F.lit(C.MODEL) if make is not None else None), (700, 1, xmp)]
    texts = [(tag, kind, F.rpad(F.coalesce(t, F.lit("")), 64, " ").cast("binary")) for tag, kind, t in texts if t is not None]
    size = 2 * F.size(dn)
    fields = [(256, 4, width), (257, 4, height), (258, 3, 16), (259, 3, 1), (273, 4, 8), (277, 3, 1), (279, 4, size)]
    entry = lambda tag, kind, n, c: F.concat(_number(F.lit(tag), 2), _number(F.lit(kind), 2), _number(F.lit(n), 4), _number(lit(c), 4))
    body = [entry(tag, kind, 1, c) for tag, kind, c in fields] + [entry(tag, kind, 64, 8 + size + 64 * k) for k, (tag, kind, _) in enumerate(texts)]
    start, length = 8 + size + 64 * len(texts), 2 + 12 * len(body) + 4
    n = lit(1) if pages is None else pages
    chain = F.transform(F.sequence(F.lit(1), n), lambda k: F.hex(F.concat(_number(F.lit(len(body)), 2), *body, _number(F.when(k < n, start + length * k).otherwise(0), 4))))
    return F.concat(F.lit(b"II*\x00"), _number(start, 4), pixels, *[t for *_, t in texts], F.unhex(F.array_join(chain, "")))


@query("src_page_tags", """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END::INT AS page_count, 3 AS height, (doc_id % 4 + 1)::INT AS width, 'uint16' AS dtype, CASE WHEN doc_id % 3 = 0 THEN 'OTHER' ELSE 'FLIR' END AS make,
array_to_string(list_filter(['height', 'width', CASE WHEN doc_id % 5 = 0 THEN 'page_count' END, CASE WHEN doc_id % 3 = 0 THEN 'make' END, CASE WHEN n_chars % 2 = 0 THEN 'gain' END, 'normalized'], lambda x: x IS NOT NULL), ',') AS issues FROM documents""")
def page_tags(v):
    """A file a document; of each the tags are read by ranges and judged, pixels are not.

    Files are dealt over folders, which tasks list, so that neither the driver nor a task holds all their names."""
    k = F.col("doc_id")
    xmp = F.concat(F.lit("<F:TlinearGain>"), F.when(F.col("n_chars") % 2 == 0, "0.4").otherwise("0.04"), F.lit("</F:TlinearGain>"))
    width = (k % 4 + 1).cast("int")
    content = tiff(F.array_repeat(F.lit(8000), 3 * width), width, F.lit(3), make=F.when(k % 3 == 0, "OTHER").otherwise(C.MAKE), xmp=xmp, pages=F.when(k % 5 == 0, 2).otherwise(1))
    folder = fresh_folder(v.spark, "tags")
    inner = F.pmod(F.xxhash64(k), F.lit(FOLDERS)).cast("string")
    sinks.write_files(v.documents.select(F.concat_ws("/", F.lit(folder), inner, F.concat(k.cast("string"), F.lit(".tiff"))).alias("path"), content.alias("content"))).count()
    made = ranged.walk_files(v.spark, folder).where(F.col("path").endswith(".tiff"))
    tags = ranged.page_tags(made).withColumns({"make": F.rtrim("make"), "model": F.rtrim("model")})
    own = F.regexp_extract("path", r"(\d+)\.tiff$", 1).cast("long").alias("doc_id")
    return R.page_issues(tags).select(own, "page_count", "height", "width", "dtype", "make", F.array_join("issues", ",").alias("issues"))


_BUNDLES = "b AS (SELECT source || '/' || CAST(doc_id // 20 AS VARCHAR) || '.txt' AS path, string_agg(text, chr(10) ORDER BY doc_id) AS text FROM documents GROUP BY 1)"


def _contents(v):
    """name and text of files of twenty documents each."""
    name = F.concat_ws("/", "source", F.concat(F.floor(F.col("doc_id") / 20).cast("string"), F.lit(".txt")))
    return v.documents.groupBy(name.alias("name")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda t: t["text"]), "\n").alias("text"))


def _bundles(v, folder):
    """Files of twenty documents each, and one that no list may name; their paths below the folder."""
    rows = _contents(v).select(F.concat(F.lit(f"{folder}/"), "name").alias("path"), F.col("text").cast("binary").alias("content"))
    skipped = v.spark.createDataFrame([(f"{folder}/.cache/x.txt", b"x"), (f"{folder}/a/.DS_Store", b"x")], "path string, content binary")
    sinks.write_files(rows.union(skipped)).count()
    return R.hashed_files(v.spark, folder)


@query("sink_checksum_list", f"WITH {_BUNDLES} SELECT sha256(text) AS digest, path FROM b")
def checksum_list(v):
    """Digests of real files block by block, written as one list sorted over all files, and read again."""
    folder, lists = fresh_folder(v.spark, "payload"), fresh_folder(v.spark, "list")
    sinks.write_checksums(_bundles(v, folder), lists)
    return S.checksum_lines(v.spark.read.text(lists))


@query("inc_checksum_files", f"WITH {_BUNDLES} SELECT CASE WHEN len(path) % 2 = 0 THEN sha256(text || '!') ELSE sha256(text) END AS digest, path FROM b UNION ALL SELECT sha256('new'), 'z/' || source FROM (SELECT DISTINCT source FROM documents)")
def checksum_files(v):
    """A sorted list in which the entries of changed and new files are made anew; the other files are not read.

    Changed files are written from the table and not from themselves, so that a task that runs again writes the same."""
    folder, old, new = (fresh_folder(v.spark, n) for n in ("payload", "list", "list"))
    sinks.write_checksums(_bundles(v, folder), old)
    listed = S.checksum_lines(v.spark.read.text(old))
    changed = listed.where(F.length("path") % 2 == 0).select("path")
    again = _contents(v).where(F.length("name") % 2 == 0).select(F.concat(F.lit(f"{folder}/"), "name").alias("path"), F.concat("text", F.lit("!")).cast("binary").alias("content"))
    added = v.documents.select("source").distinct().select(F.concat(F.lit(f"{folder}/z/"), "source").alias("path"), F.lit(b"new").alias("content"))
    sinks.write_files(again.unionByName(added)).count()
    chosen = changed.union(added.select(R.below(F.col("path"), folder)))
    R.refresh_checksum_list(v.spark, folder, old, chosen, new)
    return S.checksum_lines(v.spark.read.text(new))


_MASK = "m AS (SELECT vec_id, CAST(len(list_filter(map, lambda x: x * 30 + 6000 >= 8829)) AS BIGINT) AS hot, CAST(len(list_filter(map, lambda x: x * 30 + 6000 + 90 >= 8829)) AS BIGINT) AS hotter FROM fx_maps)"


@query("inc_mask_build", f"""WITH {_MASK} SELECT 1 AS run, vec_id, 'created' AS state, hot AS positive, true AS valid FROM m WHERE vec_id % 3 = 0
UNION ALL SELECT 2, vec_id, CASE WHEN vec_id % 3 = 0 THEN 'preserved' ELSE 'created' END, hot, true FROM m WHERE vec_id % 5 <> 0 OR vec_id % 3 = 0
UNION ALL SELECT 3, vec_id, CASE WHEN vec_id % 5 = 0 AND vec_id % 3 <> 0 THEN 'created' WHEN vec_id % 7 = 0 AND hotter <> hot THEN 'conflicting' ELSE 'preserved' END, CASE WHEN vec_id % 7 = 0 THEN hotter ELSE hot END, NOT (vec_id % 5 = 0 AND vec_id % 3 <> 0 OR vec_id % 7 = 0 AND hotter <> hot) FROM m""")
def mask_build(v):
    """Three builds of one folder: of a third of the images; with more of them; and with all, of which every seventh has
    changed since, so that nothing is written."""
    folder = fresh_folder(v.spark, "aligned")
    n = F.col("vec_id")

    def images(rows, more=0):
        dn = F.transform("map", lambda x: x * 30 + 6000 + more)
        sinks.write_files(rows.select(F.concat(F.lit(f"{folder}/"), n.cast("string"), F.lit("/thermal.tiff")).alias("path"), tiff(dn, F.lit(8), F.lit(8)).alias("content"))).count()

    def built(run):
        report = M.build_masks(v.spark, folder, contract=False)
        own = F.regexp_extract("path", r"(\d+)/thermal\.tiff$", 1).cast("long").alias("vec_id")
        kept = fresh_folder(v.spark, "report")
        report.select(F.lit(run).alias("run"), own, "state", "positive", "valid").write.parquet(kept)
        return v.spark.read.parquet(kept)

    maps = v.fx_maps
    images(maps.where(n % 3 == 0))
    first = built(1)
    images(maps.where((n % 3 != 0) & (n % 5 != 0)))
    second = built(2)
    images(maps.where((n % 5 == 0) & (n % 3 != 0) & (n % 7 != 0)))
    images(maps.where(n % 7 == 0), 90)
    return first.union(second).union(built(3))
