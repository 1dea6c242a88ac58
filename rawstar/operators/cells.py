"""Positional CSV: routing, sentinel and header lines, cells, pivot, direct mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.functions import text
from rawstar.schemas import CSV_SOURCES, CsvSource


def route(
    df: DataFrame,
    file_name: str | None = None,
    pattern: str | None = None,
    column: str = "source_name",
) -> DataFrame:
    """Lines of one source, chosen by exact name or by LIKE pattern."""
    if file_name is not None:
        df = df.filter(F.col(column) == file_name)
    if pattern is not None:
        df = df.filter(F.col(column).like(pattern))
    return df


def prune(df: DataFrame, source: CsvSource) -> DataFrame:
    """Only the partitions that may hold lines of a known source, where lines are stored by route."""
    name = next((k for k, s in CSV_SOURCES.items() if s is source), None)
    if name is None or "route" not in df.columns:
        return df
    return df.filter(F.col("route").contains(f".{name}."))


def drop_sentinels(
    df: DataFrame,
    raw: str = "raw_content",
    prefixes: tuple[str, ...] = ("----- START OF FILE%", "----- END OF FILE%"),
    header_rows: tuple[int, ...] = (),
    row_number: str = "file_row_number",
) -> DataFrame:
    """Drop envelope lines, blank (NULL) lines and header rows."""
    keep = text.none_ilike(raw, *prefixes)
    for n in header_rows:
        keep = keep & (F.col(row_number) != n)
    return df.filter(keep)


def cells_of(raw: Column | str, delimiter: str = ",") -> Column:
    """The line as an array of raw cells; not quote-aware, trailing empty cells are kept."""
    line = F.col(raw) if isinstance(raw, str) else raw
    plain = len(delimiter) == 1 and delimiter not in ".$|()[{^?*+\\"  # needs no pattern for each line
    return F.split(line, delimiter if plain else "\\Q" + delimiter + "\\E", -1)


def split_cells(df: DataFrame, raw: str = "raw_content", delimiter: str = ",") -> DataFrame:
    """One row per cell: (key = 'colN', value) beside the other columns of the line."""
    others = [c for c in df.columns if c != raw]
    exploded = df.filter(F.col(raw).isNotNull()).select(
        *others, F.posexplode(cells_of(raw, delimiter)).alias("_pos", "_cell")
    )
    return exploded.select(
        F.concat(F.lit("col"), (F.col("_pos") + 1).cast("string")).alias("key"),
        text.cell_value("_cell").alias("value"),
        *others,
    )


def pivot_cells(df: DataFrame, positions: dict[str, int], keys: list[str]) -> DataFrame:
    """Cells back to one row per `keys`: the largest value of each wanted 'colN'.

    `positional_map` gives the same rows from the line itself without a shuffle; this one is for
    data that only exists as cells. The partial aggregate runs before the shuffle.
    """
    picks = [
        F.max(F.when(F.col("key") == f"col{n}", F.col("value"))).alias(name)
        for name, n in positions.items()
    ]
    return df.groupBy(*keys).agg(*picks)


def positional_map(
    df: DataFrame,
    positions: dict[str, int],
    raw: str = "raw_content",
    delimiter: str = ",",
) -> DataFrame:
    """Name the cells of each line by position; a short line gives NULLs."""
    others = [c for c in df.columns if c != raw]
    arr = df.select(*others, cells_of(raw, delimiter).alias("_cells"))
    named = [
        text.cell_value(F.get("_cells", F.lit(n - 1))).alias(name) for name, n in positions.items()
    ]
    return arr.select(*others, *named)


def quoted_map(
    df: DataFrame, positions: dict[str, int], raw: str = "raw_content", delimiter: str = ","
) -> DataFrame:
    """`positional_map` for sources whose cells may hold the delimiter inside quotes."""
    width = max(positions.values())
    schema = ", ".join(f"c{i} string" for i in range(1, width + 1))
    others = [c for c in df.columns if c != raw]
    parsed = df.select(*others, F.from_csv(raw, schema, {"sep": delimiter}).alias("_row"))
    return parsed.select(
        *others, *[text.cell_value(f"_row.c{n}").alias(name) for name, n in positions.items()]
    )


def read_source(lines: DataFrame, source: CsvSource, quoted: bool = False) -> DataFrame:
    """Rows of one CSV source: route, drop envelope and header lines, name the cells."""
    kept = drop_sentinels(
        route(prune(lines, source), source.file_name, source.pattern),
        prefixes=source.sentinels,
        header_rows=source.header_rows,
    ).select("file_name", "file_row_number", "raw_content")
    return (quoted_map if quoted else positional_map)(kept, source.positions)
