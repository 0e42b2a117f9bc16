"""Sparse cells of a wide-column store as tables.

``cells`` is a DataFrame ``row_key string, family string, qualifier string,
ts bigint, value string``. Of several versions of a cell the one with the
largest ``ts`` is the newest, of those the one with the largest ``value``; null
comes before everything, and equal rows are one version. Family and qualifier
may be null, in all four operators; a column's name then has nothing in that place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.scratch import written

CELL_KEY = ["row_key", "family", "qualifier"]

# Parts that the versions of a cell are dealt to, so that a hot one is not one task's.
LOTS = 16

Pair = tuple[str | None, str | None]


def parse_columns(request: str) -> list[tuple[str, str]]:
    """(family, qualifier) pairs of a request ``fam:col1:col2,fam2:col3``."""
    pairs = []
    for part in request.split(","):
        family, *qualifiers = part.split(":")
        if not family or not all(qualifiers) or not qualifiers:
            raise ValueError(f"{part!r} in {request!r} is not of the form fam:col1:col2")
        pairs += [(family, qualifier) for qualifier in qualifiers]
    return list(dict.fromkeys(pairs))


def _wanted(columns: Sequence[Pair]) -> Column:
    by_family: dict[str | None, list[str | None]] = {}
    for family, qualifier in columns:
        by_family.setdefault(family, []).append(qualifier)
    wanted = F.lit(False)
    for family, qualifiers in by_family.items():
        own = F.col("family").isNull() if family is None else F.col("family") == family
        named = F.col("qualifier").isin([q for q in qualifiers if q is not None])
        if None in qualifiers:
            named |= F.col("qualifier").isNull()
        wanted |= own & named
    return wanted


def _version() -> Column:
    return F.struct("ts", "value")


def _names(columns: Sequence[Pair]) -> list[str]:
    """``family:qualifier`` of each, told apart also by those who ignore case.

    Where two names meet, the later one gets ``#2``, ``#3`` and so on.
    """
    taken: set[str] = set()
    names = []
    for column in columns:
        plain = name = ":".join(part or "" for part in column)
        number = 1
        while name.lower() in taken:
            number += 1
            name = f"{plain}#{number}"
        taken.add(name.lower())
        names.append(name)
    return names


def _table(cells: DataFrame, columns: Sequence[Pair]) -> DataFrame:
    """One row per row key with a column ``family:qualifier`` for each of ``columns``.

    Cells go down to one version each, then they are gathered by row. The first step
    leaves a hot row at most one cell per column, so what the second gathers is
    bounded by the number of columns. The gathered cells are in order of their columns;
    the gaps between them are filled with nulls in one pass, so that each output column
    is read off by its place, however many there are.
    """
    # A row per output column, so as bounded as the output's schema.
    positions = cells.sparkSession.createDataFrame(
        [(family, qualifier, i) for i, (family, qualifier) in enumerate(columns)],
        "of_family string, of_qualifier string, position int",
    )
    newest = (
        cells.groupBy(*CELL_KEY)
        .agg(F.max(_version())["value"].alias("value"))
        .join(
            F.broadcast(positions),
            F.col("family").eqNullSafe(F.col("of_family"))
            & F.col("qualifier").eqNullSafe(F.col("of_qualifier")),
        )
        .select("row_key", "position", "value")
    )
    # Cells of a row are in different tasks now; gathering them before the
    # shuffle would find nothing to combine.
    rows = (
        newest.repartition("row_key")
        .groupBy("row_key")
        .agg(F.array_sort(F.collect_list(F.struct("position", "value"))).alias("cells"))
    )
    none = F.lit(None).cast("string")
    before = F.concat(F.array(F.lit(-1)), F.transform("cells", lambda cell: cell["position"]))
    filled = F.zip_with(
        "cells", F.slice(before, 1, F.size("cells")),
        lambda cell, last: F.concat(
            F.array_repeat(none, cell["position"] - last - 1), F.array(cell["value"])
        ),
    )
    rows = rows.select("row_key", F.flatten(filled).alias("row"))
    return rows.select(
        "row_key", *[F.get("row", F.lit(i)).alias(name) for i, name in enumerate(_names(columns))]
    )


def cells_select(cells: DataFrame, request: str | Sequence[Pair]) -> DataFrame:
    """The requested columns as a table of strings, a row per row key that has any.

    ``request`` is ``fam:col1:col2,fam2:col3``, or a list of (family, qualifier)
    pairs, which may hold ``:``, ``,`` and None. Columns are ``row_key`` and
    ``family:qualifier`` in the order requested; a missing cell is null. Where two such
    names are the same but for case, the later one ends in ``#2`` and so on, as most sinks
    hold only one of them.
    """
    columns = parse_columns(request) if isinstance(request, str) else list(dict.fromkeys(request))
    if not columns:
        raise ValueError("no columns requested")
    return _table(cells.filter(_wanted(columns)), columns)


def cell_columns(cells: DataFrame) -> DataFrame:
    """``family, columns``: the qualifiers of each family in order, joined with ``:``.

    Qualifiers that hold ``:`` themselves cannot be told apart in the joined text.
    """
    qualifiers = F.sort_array(F.collect_list(F.coalesce("qualifier", F.lit(""))))
    return (
        cells.select("family", "qualifier")
        .distinct()
        .groupBy("family")
        .agg(F.concat_ws(":", qualifiers).alias("columns"))
    )


def cells_pivot(cells: DataFrame) -> DataFrame:
    """All columns of all rows as a table of strings, as :func:`cells_select`.

    The column names are read first, in a job of their own, and come to the driver:
    they are the names of the table's own schema, which a driver has to hold anyway.
    Where the names are known, ``cells_select`` saves that job.
    """
    found = cells.select("family", "qualifier").distinct().collect()
    columns = sorted(
        ((row["family"], row["qualifier"]) for row in found),
        key=lambda pair: [(part is not None, part or "") for part in pair],
    )
    return _table(cells, columns) if columns else cells.select("row_key").distinct()


def _same(other: dict[str, str]) -> Column:
    same = F.lit(True)
    for name, their in other.items():
        same &= F.col(name).eqNullSafe(F.col(their))
    return same


def _few(rows: DataFrame) -> bool:
    """Whether ``rows``, measured in a job, take no more than Spark's limit for broadcasting.

    Spark itself goes by estimates, which take the size of files for that of their rows in
    memory, and an exploded row for one. So what may be large is not left to it.
    """
    limit = rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if limit < 0:
        return False
    size = F.lit(8).cast("bigint")
    for name in rows.columns:
        size += 16 + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return (rows.agg(F.sum(size)).first()[0] or 0) <= limit


def _newest_of_targets(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """The newest version of each target cell that there is, written to be read back.

    Few targets are broadcast. Many meet the versions in lots, so that a hot cell is no
    single task's; what they hit is reduced to one for each task before it crosses.
    """
    theirs = {name: f"_target_{name}" for name in CELL_KEY}
    keys = targets.select(*[F.col(name).alias(their) for name, their in theirs.items()]).distinct()
    versions = cells.select(*CELL_KEY, "ts", "value")
    if _few(keys):
        hit = versions.join(F.broadcast(keys), _same(theirs), "left_semi")
    else:
        lots = F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1)))
        dealt = versions.withColumn(
            "_lot", F.pmod(F.xxhash64("ts", "value"), F.lit(LOTS)).cast("int")
        )
        keys = keys.withColumn("_target_lot", lots).hint("merge")
        hit = dealt.join(keys, _same(theirs | {"_lot": "_target_lot"}), "left_semi")
    newest = hit.groupBy(*CELL_KEY).agg(F.max(_version()).alias("newest"))
    return written(newest.select(*CELL_KEY, "newest.ts", "newest.value"), "newest_cells")


def cells_drop(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """Cells without the newest version of each target cell.

    ``targets`` has ``row_key, family, qualifier``; older versions stay. A job of its own
    finds the newest versions of the targets, one row for each. The result then reads
    ``cells`` once and leaves out what equals one of those rows. Either table is broadcast
    where its rows are measured at no more than ``spark.sql.autoBroadcastJoinThreshold``, so
    that with few targets no cell is shuffled. Otherwise cells are shuffled, dealt to 16 lots
    to find the newest, and by cell and version to leave them out, so that a hot cell is no
    single task's. Measuring reads the keys of ``targets`` once more.
    """
    newest = _newest_of_targets(cells, targets)
    mark = "_newest_"
    while any(name.lower().startswith(mark) for name in cells.columns):
        mark = "_" + mark
    same = _same({name: mark + name for name in newest.columns})
    newest = F.broadcast(newest) if _few(newest) else newest.hint("merge")
    return cells.join(newest.toDF(*[mark + name for name in newest.columns]), same, "left_anti")
