"""Containers, parts and metadata as frames; K1-K7: sinks."""

from __future__ import annotations

import io
import posixpath
import re
import struct
import zipfile
from collections.abc import Iterator
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.folding import ordered_fold

_PARTS = "path string, part_no int, part string, source string, markup string"


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """Containers of any kind as ``path, content``; unpacking proprietary ones happens before ingestion."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _spine(book: zipfile.ZipFile) -> tuple[str, list[str]]:
    root = ElementTree.fromstring(book.read("META-INF/container.xml"))
    opf = next(e.attrib["full-path"] for e in root.iter() if e.tag.endswith("rootfile"))
    package = ElementTree.fromstring(book.read(opf))
    base = posixpath.dirname(opf)
    where = {e.attrib["id"]: posixpath.normpath(posixpath.join(base, unquote(e.attrib["href"]))) for e in package.iter() if e.tag.endswith("}item")}
    return opf, [where[e.attrib["idref"]] for e in package.iter() if e.tag.endswith("itemref") and e.attrib["idref"] in where]


def _parts_of(content: bytes) -> list[tuple[int, str, str, str]]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        _, spine = _spine(book)
        names = {source: f"part{k:04d}.xhtml" for k, source in enumerate(spine)}
        out = []
        for k, source in enumerate(spine):
            markup = book.read(source).decode("utf-8", "replace")

            def to_part(m: re.Match, here: str = source) -> str:
                target, _, fragment = m[2].partition("#")
                full = posixpath.normpath(posixpath.join(posixpath.dirname(here), unquote(target))) if target else here
                return m[1] + names.get(full, target) + ("#" + fragment if fragment else "") + m[3] if full in names else m[0]

            out.append((k, names[source], source, re.sub(r"""(\bhref\s*=\s*["'])([^"':]*)(["'])""", to_part, markup)))
        return out


def unpack_epub(files: DataFrame) -> DataFrame:
    """The parts of EPUB files (path, content) in order of their spine, with links between parts rewritten."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield pd.DataFrame([(path, *row) for row in _parts_of(bytes(content))], columns=["path", "part_no", "part", "source", "markup"])

    return files.select("path", "content").mapInPandas(run, _PARTS)


def epub_pictures(files: DataFrame) -> DataFrame:
    """The pictures of EPUB files, as their package lists them: ``path, item_no, target, content``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as book:
                    opf, held = _spine(book)[0], set(book.namelist())
                    listed = [e.attrib for e in ElementTree.fromstring(book.read(opf)).iter() if e.tag.endswith("}item") and e.attrib.get("media-type", "").startswith("image/")]
                    for k, item in enumerate(listed):  # a picture at a time
                        target = posixpath.normpath(posixpath.join(posixpath.dirname(opf), unquote(item["href"])))
                        yield pd.DataFrame([(path, k, target, book.read(target) if target in held else None)], columns=["path", "item_no", "target", "content"])

    return files.select("path", "content").mapInPandas(run, "path string, item_no int, target string, content binary")


def picture_names(pictures: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, item_no, target, name``: pictures of a book in one folder, under their own names.

    ``pictures``: keys, item_no, target.  Where a name is taken, the first free
    of ``1_name``, ``2_name``, ... is given; a fold over a book's pictures in
    order, which holds their names.
    """

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        taken: set[str] = set()
        tried: dict[str, int] = {}
        for item_no, target in rows:
            own = name = posixpath.basename(target)
            while name in taken:
                tried[own] = tried.get(own, 0) + 1
                name = f"{tried[own]}_{own}"
            taken.add(name)
            yield item_no, target, name

    return ordered_fold(pictures.select(*keys, F.col("item_no").cast("long").alias("item_no"), "target"), keys, ["item_no", "target"], [], "item_no long, target string, name string", fold)


_PICTURE = re.compile(r"<(?:img|image)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.I)
_SOURCE = re.compile(r"""(\s(?:src|xlink:href|href)\s*=\s*)("[^"]*"|'[^']*')""", re.I)


def _target(here: str, said: str) -> str:
    return posixpath.normpath(posixpath.join(posixpath.dirname(here), unquote(said)))


def picture_references(parts: DataFrame, keys: list[str], part: str = "part_no") -> DataFrame:
    """``keys, part, said, target`` of the distinct pictures that each part (keys, part, source, markup) shows."""
    given = parts.select(*keys, part, "source", "markup")
    schema = T.StructType([*[given.schema[c] for c in (*keys, part)], T.StructField("said", T.StringType()), T.StructField("target", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, (here, markup) in enumerate(zip(batch.column("source").to_pylist(), batch.column("markup").to_pylist())):
                said = dict.fromkeys(m[2][1:-1] for tag in _PICTURE.finditer(markup or "") for m in _SOURCE.finditer(tag[0]))
                rows += [i] * len(said)
                found += [(x, _target(here or "", x)) for x in said]
            of = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(of) for c in (*keys, part)], *(pa.array([x[k] for x in found], pa.string()) for k in (0, 1))], schema.fieldNames())

    return given.mapInArrow(run, schema)


def with_pictures(parts: DataFrame, names: DataFrame, keys: list[str], part: str = "part_no", folder: str = "Images/") -> DataFrame:
    """Parts whose pictures are those in ``folder``, by the names that all parts of a book share.

    A join on book and target gives each part its own renames; pictures that
    the book does not list stay as they are.
    """
    renamed = picture_references(parts, keys, part).join(names.select(*keys, "target", "name"), [*keys, "target"])
    own = renamed.groupBy(*keys, part).agg(F.map_from_entries(F.collect_set(F.struct("said", "name"))).alias("__names"))
    joined, columns = parts.join(own, [*keys, part], "left"), parts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for markup, named in zip(batch.column("markup").to_pylist(), batch.column("__names").to_pylist()):
                new = dict(named or [])
                put = lambda m, new=new: m[1] + m[2][0] + (folder + new[m[2][1:-1]] if m[2][1:-1] in new else m[2][1:-1]) + m[2][0]
                made.append(_PICTURE.sub(lambda tag, put=put: _SOURCE.sub(put, tag[0]), markup) if new else markup)
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string()) if c == "markup" else batch.column(c) for c in columns], columns)

    return joined.select(*columns, "__names").mapInArrow(run, parts.schema)


def metadata(files: DataFrame) -> DataFrame:
    """Dublin Core elements of the package file: ``path, key, value``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as book:
                    package = ElementTree.fromstring(book.read(_spine(book)[0]))
                rows = [(path, e.tag.rpartition("}")[2], (e.text or "").strip()) for e in package.iter() if "purl.org/dc/" in e.tag]
                yield pd.DataFrame(rows, columns=["path", "key", "value"])

    return files.select("path", "content").mapInPandas(run, "path string, key string, value string")


def list_parts(files: DataFrame) -> DataFrame:
    """Files of parts in order of their paths, a number each within its folder."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    w = Window.partitionBy(folder).orderBy("path")
    return files.filter(F.col("path").rlike("part[0-9]*\\.xhtml$")).withColumn("part_no", F.row_number().over(w))


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """S3: part files as whole texts: ``path, markup``."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("markup"))


def linear_text(items: DataFrame) -> DataFrame:
    """The linear text of each part: raised runs as ^{}, pictures as a mark, items joined by breaks."""
    run = lambda r: F.when(r["i"].isNotNull(), F.lit("⟦img⟧")).when(r["s"] == 1, F.concat(F.lit("^{"), r["t"], F.lit("}"))).otherwise(r["t"])
    text = F.array_join(F.transform("runs", run), "")
    return items.groupBy("part").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("item_no", text.alias("t")))), lambda x: x["t"]), "\n").alias("text"))


def _image(content: bytes) -> tuple[str, int, int]:
    if content[:8] == b"\x89PNG\r\n\x1a\n":
        return ("png", *struct.unpack(">II", content[16:24]))
    if content[:6] in (b"GIF87a", b"GIF89a"):
        return ("gif", *struct.unpack("<HH", content[6:10]))
    if content[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(content) and content[at] == 0xFF:
            if 0xC0 <= content[at + 1] <= 0xCF and content[at + 1] not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", content[at + 5 : at + 9])
                return "jpeg", width, height
            at += 2 + int.from_bytes(content[at + 2 : at + 4], "big")
    return "", 0, 0


def image_info(files: DataFrame) -> DataFrame:
    """``path, format, width, height, small`` (up to 100 high)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, *_image(bytes(c))) for p, c in zip(batch["path"], batch["content"])]
            yield pd.DataFrame(rows, columns=["path", "format", "width", "height"])

    return files.select("path", "content").mapInPandas(run, "path string, format string, width int, height int").withColumn("small", F.col("height").between(1, 100))


# sinks ----------------------------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str) -> None:
    """K3."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    """K4: one folder for each value of ``partition``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition) if partition else writer).json(path)


def markdown_table(df: DataFrame, order: list[str], most: int = 1000) -> str:
    """K5: a report of up to ``most`` rows as a Markdown table; a last row tells how many more there are."""
    rows = df.orderBy(*order).limit(most).collect()
    more = df.count() - most if len(rows) == most else 0
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    head = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    last = [f"| … {more} more |" + " |" * (len(df.columns) - 1)] if more else []
    return "\n".join(head + ["| " + " | ".join(map(cell, r)) + " |" for r in rows] + last) + "\n"


def chunked(lines: DataFrame, keys: list[str], order: str, text: str, size: int = 14000) -> DataFrame:
    """K6: ``chunk``: a new one begins after the running size exceeds ``size``."""
    from ..operators.sequence import flush_groups

    sized = lines.withColumn("__n", (F.length(text) + 1).cast("long"))
    groups = flush_groups(sized, keys, order, "__n", size + 1)
    return lines.join(groups.withColumnRenamed("grp", "chunk"), [*keys, order])


def content_key(columns: list[str]):
    """K7: the address of a row's content."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def stale(modules: DataFrame, cache: DataFrame) -> DataFrame:
    """K7: modules whose content is not in the cache."""
    return modules.join(cache.select("content_key").distinct(), "content_key", "left_anti")
