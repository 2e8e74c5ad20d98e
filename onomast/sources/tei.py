"""TEI documents as a stream of element rows, and plain lines of files."""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settle import settle

# Elements that define entities, that name them, and that mention them.
DEFINITIONS = frozenset("person place org event bibl object".split())
NAMES = frozenset("persName placeName orgName label title objectName name".split())
MENTIONS = frozenset("persName placeName orgName rs date name term object bibl material title objectName".split())
XML_ID = "{http://www.w3.org/XML/1998/namespace}id"
SUFFIX = "_reconciled.tei.xml"
EVENT = "doc string, path string, pass int, elem_idx int, kind string, tag string, ner_id string, form string"


def local(tag: object) -> str:
    """S6."""
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def text_of(el: ElementTree.Element) -> str:
    """F5. All text inside an element, white space collapsed."""
    return " ".join("".join(el.itertext()).split())


def element_events(content: bytes) -> Iterator[tuple[int, int, str, str, str, str]]:
    """S2-S5. (pass, element, kind, tag, id, form) of definitions, then mentions; one error row if the file does not parse."""
    try:
        root = ElementTree.fromstring(content)
    except ElementTree.ParseError as e:
        yield 0, 0, "error", "", "", str(e)
        return
    for i, el in enumerate(root.iter()):
        if local(el.tag) in DEFINITIONS and (ident := el.get(XML_ID)):
            named = next((c for c in el if local(c.tag) in NAMES), None)
            yield 0, i, "def", local(el.tag), ident, text_of(named) if named is not None else ""
    for i, el in enumerate(root.iter()):
        if local(el.tag) in MENTIONS and (ident := (el.get("ref") or "").lstrip("#")):
            yield 1, i, "mention", local(el.tag), ident, text_of(el)


def read_corpus(spark: SparkSession, glob: str) -> DataFrame:
    """S1-S7. Events of all files of a glob, with `seq`, the order in which they are met. A file that does not parse gives one
    row of kind 'error'. Raises if the glob matches nothing.

    Files are numbered by a sort of their paths, which stay with the tasks; contents are parsed where they are read.
    """
    try:
        found = spark.read.format("binaryFile").load(glob)
    except AnalysisException as e:
        raise FileNotFoundError(f"no file matches {glob}") from e
    # documents in the order of their paths: a range sort of paths alone, numbered by partition
    at = F.monotonically_increasing_id()
    order = settle(found.select("path").distinct().orderBy("path").select("path", at.alias("file_idx")))
    if order.isEmpty():
        raise FileNotFoundError(f"no file matches {glob}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "path", "pass", "elem_idx", "kind", "tag", "ner_id", "form"]
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc = path.rpartition("/")[2].removesuffix(SUFFIX)
                rows = [(doc, path, *e) for e in element_events(content)]
                if rows:
                    cols = list(zip(*rows, strict=True))
                    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), *[pa.string()] * 4]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    got = found.select("path", "content").mapInArrow(run, EVENT).join(order, "path")
    # the number of a partition of paths stands above 33 bits: 17 bits for it, 20 for a path's place in it, 1 for the pass, 25 for the element
    place = F.shiftright("file_idx", 33) * F.lit(1 << 20) + F.col("file_idx").bitwiseAND(F.lit((1 << 20) - 1))
    return got.withColumn("seq", place * F.lit(1 << 26) + F.col("pass") * F.lit(1 << 25) + F.col("elem_idx"))


def events_of(corpus: DataFrame) -> DataFrame:
    """What extraction takes: the events without error rows."""
    return corpus.where("kind <> 'error'").select("doc", "kind", "ner_id", "form", "seq")


def read_lines(spark: SparkSession, glob: str) -> DataFrame:
    """S17. file, line_no, line: lines of whole files, each with its own line ending, so that joining them restores the file."""
    text = spark.read.format("binaryFile").load(glob).select(F.col("path").alias("file"), F.decode("content", "UTF-8").alias("text"))
    return text.select("file", F.posexplode(F.split("text", r"(?<=\n)")).alias("line_no", "line")).where("line <> ''")


def register_elements(spark: SparkSession, glob: str) -> DataFrame:
    """S18. path, kind, form: each xml:id of the files, or the error that stopped parsing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows = [(path, "id", i) for el in ElementTree.fromstring(content).iter() if (i := el.get(XML_ID))]
                except ElementTree.ParseError as e:
                    rows = [(path, "error", str(e))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["path", "kind", "form"])

    return spark.read.format("binaryFile").load(glob).select("path", "content").mapInArrow(run, "path string, kind string, form string")
