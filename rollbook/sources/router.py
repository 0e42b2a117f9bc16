"""Pick a source from a descriptor or a path."""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from rollbook.operators.cells import cells_pivot, cells_select
from rollbook.scratch import hadoop_file
from rollbook.sources.readers import read_parquet
from rollbook.sources.tables import read_table

# The descriptor's field names and the one dbType that means a catalog table.
HIVE = "Hive"
# Fixed value: the longest path of HDFS, which no store that Spark reads goes beyond.
PATH_LENGTH = 8000
#: Bytes that are read at once.
PIECE_BYTES = 4096
#: Characters of a word, number or escape that may be cut short by the end of a piece.
UNSETTLED = 16


@dataclass(frozen=True)
class SourceDescriptor:
    """The JSON object that names a source; absent fields are None."""

    nodeId: int | None = None
    datasetId: str | None = None
    ip: str | None = None
    port: int | None = None
    dbName: str | None = None
    tableName: str | None = None
    dbType: str | None = None


def parse_descriptor(text: str) -> SourceDescriptor | None:
    """The descriptor in ``text``, or None where it is not a JSON object."""
    try:
        found = json.loads(text)
    except ValueError:
        return None
    if not isinstance(found, dict):
        return None
    return SourceDescriptor(**{f.name: found.get(f.name) for f in fields(SourceDescriptor)})


def load_source(
    spark: SparkSession,
    source: str,
    columns: str | Sequence[str] | None = None,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Load the source that ``source`` names.

    A JSON object is a descriptor, any other text a Parquet path. A descriptor
    whose ``dbType`` is exactly ``Hive`` loads ``columns`` of its table, or the
    catalog report where no columns are given. Any other ``dbType`` stands for a
    wide-column store: give its cells as a DataFrame, and the columns as
    ``fam:col1:col2,fam2:col3`` or ``*``.
    """
    descriptor = parse_descriptor(source)
    if descriptor is None:
        return read_parquet(spark, source)
    if descriptor.dbType == HIVE:
        if columns and not (descriptor.dbName and descriptor.tableName):
            raise ValueError("the descriptor needs a dbName and a tableName to load columns")
        return read_table(spark, descriptor.dbName, descriptor.tableName, columns)
    if cells is None:
        raise ValueError(
            f"dbType {descriptor.dbType!r} is not {HIVE!r}: pass the store's cells as a DataFrame"
        )
    if not columns:
        raise ValueError("a wide-column source needs columns: 'fam:col1:col2,fam2:col3' or '*'")
    request = columns if isinstance(columns, str) else ",".join(columns)
    return cells_pivot(cells) if request == "*" else cells_select(cells, request)


def _lines(spark: SparkSession, path: str) -> Iterator[str]:
    """Text of a file, piece by piece, without its line ends. Nothing is read ahead."""
    file_system, location = hadoop_file(spark, path)
    stream = file_system.open(location)
    decode = codecs.getincrementaldecoder("utf-8")("replace").decode
    try:
        while piece := bytes(stream.readNBytes(PIECE_BYTES)):
            yield decode(piece).replace("\r", "").replace("\n", "")
        yield decode(b"", True)
    finally:
        stream.close()


def _may_go_on(text: str) -> bool:
    """Whether ``text`` may be the beginning of a JSON object; a whole one may be followed by blanks."""
    try:
        _, end = json.JSONDecoder().raw_decode(text)
    except json.JSONDecodeError as wrong:
        # The parser stops where it lacks text, or at the start of a string without an end.
        rest = text[wrong.pos :].strip()
        return wrong.msg.startswith("Unterminated string") or len(rest) < UNSETTLED
    return not text[end:].strip()


def named_source(pieces: Iterator[str], where: str) -> str:
    """The descriptor or path that ``pieces`` of text make up.

    Reading ends as soon as the text can be neither: when what begins with ``{`` is no JSON
    object, or goes on after one, and when anything else is longer than a path can be. The
    text is looked at whenever it has doubled, so that a whole one costs no more than twice
    its length to check.
    """
    text, checked = "", 0
    for piece in pieces:
        text += piece
        is_object = text.lstrip().startswith("{")
        if is_object and len(text) >= 2 * checked:
            checked = len(text)
            if not _may_go_on(text.lstrip()):
                raise ValueError(f"{where} holds neither a source descriptor nor a path")
        if not is_object and len(text.strip()) > PATH_LENGTH:
            raise ValueError(f"{where} holds neither a source descriptor nor a path")
    if text.lstrip().startswith("{") and parse_descriptor(text) is None:
        raise ValueError(f"{where} holds neither a source descriptor nor a path")
    return text


def source_text(spark: SparkSession, path: str) -> str:
    """What :func:`load_source` should be given for ``path``.

    A folder or a Parquet file stands for itself. By the caller's word any other
    file holds the descriptor (or the path) in its lines. It is read on the driver, and
    only until it can be neither, so that a file given by mistake costs nothing.
    """
    if path.endswith(".parquet"):
        return path
    file_system, location = hadoop_file(spark, path)
    if file_system.getFileStatus(location).isDirectory():
        return path
    return named_source(_lines(spark, path), path)
