"""Cut raw lines of XML and JSON files into records, and parse them.

Every file, whatever its size, takes the same road: its lines are folded into chunks of bounded size
and cut into records there (one XML transaction, one element of the JSON transaction array). No
document has to fit a task. What is not a sound record is set aside with its text: a record that does
not parse, the pieces of one that is never closed, unbalanced markup between records, brackets that a
file leaves open. `on_bad` says whether such a row spoils its record ("record") or its whole file
("document").

What a chunk means depends on what comes before it: does it start inside a comment, and in which
brackets? Each chunk says, in one scan, what it makes of every state it may start in, in a few bytes.
Those summaries are put together along the file, and each chunk is then cut with the state it does
start in. Scans are linear in the chunk, whatever it holds.

`rebuild_xml` and `rebuild_json` give each file as one text instead, for those who want that.

Lines carry file_name, file_row_number and a text column.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from rawstar.functions import text
from rawstar.operators.dedup import keep_latest
from rawstar.schemas import XML_TRANSACTION_DDL
from rawstar.sources.lake import Staging

if TYPE_CHECKING:
    import pyarrow as pa

CHUNK_ROWS = 10_000
#: Summaries of chunks, a few bytes each, are broadcast up to this number, so that no text is moved for them.
BROADCAST_CHUNKS = 1_000_000
#: Rows of a stored row group, which is what a reader may hold at once: rows that are a chunk of text each, and
#: rows that are a record or, where markup is broken, up to a chunk.
CHUNK_GROUP, PIECE_GROUP = 32, 256
#: Longer records are set aside piece by piece: they are more likely unclosed than meant.
MAX_RECORD_CHUNKS = 64
XML_DOCUMENT_DDL = f"Transaction array<struct<{XML_TRANSACTION_DDL}>>, _corrupt string"
XML_RECORD_DDL = f"{XML_TRANSACTION_DDL}, _corrupt string"
#: An opening tag that is not closed at once.
_OPENING = r"<[^!?/>][^>]*+(?<!/)>"
XML_TOP_FIELDS = ("TransactionID", "Order", "Items", "Payment")

#: Signs put into texts while they are cut. XML and JSON allow none of them; they are dropped from both.
_START, _END, _STOP = "\x03", "\x04", "\x01"

#: Writes a relation once and reads it back, where several steps read it. It may be given the rows of a row group.
Stage = Callable[..., DataFrame]


def _listagg(content: str, order: list[str], separator: str) -> Column:
    quoted = separator.replace("\\", "\\\\").replace("\n", "\\n").replace("'", "\\'")
    return F.expr(f"listagg({content}, '{quoted}') WITHIN GROUP (ORDER BY {', '.join(order)})")


def ordered_concat(
    df: DataFrame, keys: list[str], content: str, order: list[str], separator: str = ""
) -> DataFrame:
    """`content` joined per key in `order`; NULL pieces are skipped."""
    return df.groupBy(*keys).agg(_listagg(content, order, separator).alias(content))


def _runs(separator: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows whose numbers follow each other under the same keys, as one; NULL texts are skipped.

    The columns are the keys, the row number and the text. A run ends with its batch.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            *keys, number, content = batch.columns
            same = pc.equal(pc.subtract(number.slice(1), number.slice(0, n - 1)), 1)
            for key in keys:
                same = pc.and_(same, pc.equal(key.slice(1), key.slice(0, n - 1)))
            starts = np.ones(n, bool)
            starts[1:] = ~pc.fill_null(same, False).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(starts)
            there = np.concatenate([[0], np.cumsum(content.is_valid().to_numpy(zero_copy_only=False))])
            ends = there[np.append(at, n)]
            texts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), content.drop_null())
            joined = pc.binary_join(texts, separator)
            joined = pc.if_else(pa.array(np.diff(ends) > 0), joined, pa.scalar(None, joined.type))
            columns = [c.take(pa.array(at)) for c in (*keys, number)]
            yield pa.RecordBatch.from_arrays([*columns, joined], names=batch.schema.names)

    return run


def concat_lines(lines: DataFrame, keys: list[str], content: str, separator: str) -> DataFrame:
    """The lines of each key as one text, in row order; NULL lines are skipped.

    Lines mostly come as they stand in their file. Those that follow each other are joined where they
    are, before any shuffle or sort, so that both see a row per run and not one per line. Where they come
    in another order, runs are short, down to one line. Lines that share a row number have no order.
    """
    placed = lines.select(*keys, F.col("file_row_number").cast("bigint"), F.col(content).cast("string"))
    runs = placed.mapInArrow(_runs(separator), placed.schema)
    return ordered_concat(runs.repartition(*keys), keys, content, ["file_row_number"], separator)


# --- chunks -----------------------------------------------------------------------------------
#
# The lines of a file are folded into chunks of consecutive lines, each one row of bounded size.
# What a chunk needs to know about the chunks before it (inside a comment? how deep? how many
# records so far?) comes from one small summary row per chunk. Records that lie inside one chunk
# are done there; only the parts of a record that runs over a chunk border are put together.


def chunk_documents(
    lines: DataFrame, content: str, separator: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(file_name, chunk, content): consecutive lines as one text; `chunk` grows along the file.

    Ingested lines bring a `chunk` bounded in bytes; other lines are cut by row number.
    """
    if "chunk" not in lines.columns:
        lines = lines.withColumn("chunk", F.expr(f"(file_row_number - 1) div {chunk_rows}"))
    # Stated here, the key filters are the same for every reader of the chunks, so that all of
    # them share one shuffle.
    placed = lines.filter("file_name IS NOT NULL AND chunk IS NOT NULL")
    return concat_lines(
        placed.select("file_name", "chunk", "file_row_number", content),
        ["file_name", "chunk"],
        content,
        separator,
    ).filter(F.col(content).isNotNull())


def _beside(chunks: DataFrame, summaries: DataFrame, stage: Stage, how: str = "inner") -> DataFrame:
    """Chunks, or their pieces, with the summary of each chunk.

    The text stays where it is while there are at most BROADCAST_CHUNKS summaries. Beyond that both sides
    meet by hash, and the text is still not sorted.
    """
    small = stage(summaries)
    few = small.count() <= BROADCAST_CHUNKS
    small = F.broadcast(small) if few else small.hint("shuffle_hash")
    return chunks.join(small, ["file_name", "chunk"], how)


def _forget(stage: Stage, *frames: DataFrame) -> None:
    """Empty tables of a stage that nothing reads any more."""
    if isinstance(stage, Staging):
        stage.release(*frames)


def _worked_out(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with one more column. Filters on it come after it, where otherwise each would work it out again."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def _before() -> WindowSpec:
    """All earlier chunks of the file; runs over summary rows only."""
    return (
        Window.partitionBy("file_name").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )


def join_pieces(pieces: DataFrame, content: str, stage: Stage) -> DataFrame:
    """(file_name, record_no, closed, content) of every record.

    `pieces` has, per chunk, piece 0 (what comes before the first record start, perhaps the end of
    an earlier record) and pieces 1.. that each start a record; `closes` tells that the record ends
    in the piece. A closed record is one row. Of a record that is never closed, or that runs over more
    than MAX_RECORD_CHUNKS chunks, each piece is a row of its own, so that no row outgrows those. `rest`, where pieces have it, is what follows the record in its
    piece; unbalanced markup there, or before a record, comes out as rows without a number.
    """
    starts = F.col("piece") > 0
    last = F.max(F.struct("piece", "closes"))
    event = F.when((last["piece"] > 0) | last["closes"], ~last["closes"])
    per_chunk = pieces.groupBy("file_name", "chunk").agg(
        last["piece"].alias("_starts"), event.alias("_open")
    )
    mark = F.when(F.col("_open").isNotNull(), F.struct("chunk", F.col("_open").alias("open")))
    carried = per_chunk.select(
        "file_name",
        "chunk",
        F.coalesce(F.sum("_starts").over(_before()), F.lit(0)).alias("_done"),
        F.coalesce(F.max(mark).over(_before())["open"], F.lit(False)).alias("_inside"),
    )
    placed = _beside(pieces, carried, stage).withColumn(
        "record_no", (F.col("_done") + F.col("piece")).cast("bigint")
    )
    inside = starts | F.col("_inside")
    keys = ["file_name", "record_no"]
    ours = placed.filter(inside).withColumn("_whole", starts & F.col("closes"))
    # few rows: only what crosses a chunk border
    parts = stage(ours.filter("NOT _whole").select(*keys, "chunk", "closes", content), PIECE_GROUP)
    sound = (
        parts.groupBy(*keys)
        .agg(F.max("closes").alias("_closed"), F.count("*").alias("_parts"))
        .filter(F.col("_closed") & (F.col("_parts") <= MAX_RECORD_CHUNKS))
        .select(*keys)
    )
    joined = ordered_concat(parts.join(sound, keys, "left_semi"), keys, content, ["chunk"])
    broken = parts.join(sound, keys, "left_anti").filter(F.col(content).isNotNull())
    yes, no = F.lit(True).alias("closed"), F.lit(False).alias("closed")
    out = (
        ours.filter("_whole")
        .select(*keys, yes, content)
        .unionByName(joined.select(*keys, yes, content))
        .unionByName(broken.select(*keys, no, content))
    )
    if "rest" not in pieces.columns:
        return out
    between = placed.select(
        *keys,
        F.when(inside, F.col("rest"))
        .otherwise(F.concat(F.col(content), F.coalesce("rest", F.lit(""))))
        .alias(content),
    ).filter(F.col(content).contains("<"))
    between = stage(between, PIECE_GROUP)
    net = F.regexp_count(content, F.lit(_OPENING)) - F.regexp_count(content, F.lit("</"))
    faulty = between.groupBy(*keys).agg(F.sum(net).alias("_net")).filter("_net <> 0").select(*keys)
    stray = between.join(faulty, keys, "left_semi")
    none = F.lit(None).cast("bigint").alias("record_no")
    return out.unionByName(stray.select("file_name", none, no, content))


# --- XML --------------------------------------------------------------------------------------


def rebuild_xml(lines: DataFrame, content: str = "raw_content", root: str = "SalesData") -> DataFrame:
    """(file_name, content): each file as one document under a fresh root."""
    cleaned = lines.select(
        "file_name", "file_row_number", text.strip_dashed(content).alias(content)
    )
    whole = concat_lines(cleaned, ["file_name"], content, "")
    return whole.select(
        "file_name", text.wrap_root(text.strip_root(content, root), root).alias(content)
    )


def _xml_tail(content: Column | str) -> Column:
    """What a chunk may leave unfinished: a tag, or a comment mark."""
    text_ = F.col(content) if isinstance(content, str) else content
    behind = F.substring_index(text_, "<", -1)
    open_tag = (F.length(behind) < F.length(text_)) & ~behind.contains(">")
    return (
        F.when(open_tag, F.concat(F.lit("<"), behind))
        .when(text_.endswith("--"), "--")
        .when(text_.endswith("-"), "-")
        .otherwise("")
    )


def _ends_in_comment(content: Column) -> Column:
    """Whether the last comment mark opens a comment; NULL without a mark.

    Tails behind the last marks are compared, not searched for. `<!-->` and `<!--->` hold no closing mark:
    one that closes lies three signs or more behind the one that opens.
    """
    n = F.length(content)
    behind_open = F.length(F.substring_index(content, "<!--", -1))
    behind_close = F.length(F.substring_index(content, "-->", -1))
    return F.when((behind_open < n) | (behind_close < n), behind_open < behind_close + 3)


def xml_chunk_states(chunks: DataFrame, content: str) -> DataFrame:
    """(file_name, chunk, head, cut, inside) from one row per chunk; no text is moved.

    `head` is the tag or mark that the chunk before leaves unfinished, `cut` how many signs this chunk
    leaves to the next, `inside` whether the text starts in a comment. A single tag is taken to be
    shorter than a chunk.
    """
    body = F.substr(content, F.lit(1), F.length(content) - F.length("_tail"))
    small = chunks.withColumn("_tail", _xml_tail(content)).select(
        "file_name",
        "chunk",
        "_tail",
        F.substring(body, 1, 3).alias("_first"),
        _ends_in_comment(body).alias("_own"),
    )
    along = Window.partitionBy("file_name").orderBy("chunk")
    moved = small.select(
        "file_name",
        "chunk",
        "_own",
        "_first",
        F.coalesce(F.lag("_tail").over(along), F.lit("")).alias("head"),
        F.when(F.lead("chunk").over(along).isNotNull(), F.length("_tail")).otherwise(0).alias("cut"),
    )
    # a mark may also lie over the border
    mark = F.coalesce("_own", _ends_in_comment(F.concat("head", "_first")))
    inside = F.last("_mark", ignorenulls=True).over(_before())
    return moved.withColumn("_mark", mark).select(
        "file_name", "chunk", "head", "cut", F.coalesce(inside, F.lit(False)).alias("inside")
    )


def without_xml_comments(content: Column, inside: Column) -> Column:
    """Text outside comments; `inside` says whether it starts in one."""
    closed_at = F.instr(content, "-->")
    rest = F.when(
        inside, F.when(closed_at > 0, F.substr(content, closed_at + F.lit(3)))
    ).otherwise(content)
    return F.regexp_replace(rest, r"(?s)<!--.*?(?:-->|\z)", "")


def _marked(df: DataFrame, content: str, tag: str) -> DataFrame:
    """The text with a sign before every opening `<tag>`, whatever follows the name."""
    opening = f"<{tag}"

    def mark(out: Column, after: str) -> Column:
        return F.replace(out, F.lit(opening + after), F.lit(_START + opening + after))

    raw = F.col(content)
    bare = F.when(raw.contains(_START), F.replace(raw, F.lit(_START), F.lit(""))).otherwise(raw)
    others = (" ", "\t", "\r", "\n", "/")  # a search for them costs less than a replacement
    some = reduce(Column.__or__, [F.col("_bare").contains(opening + after) for after in others])
    usual = mark(F.col("_bare"), ">")
    marked = F.when(some, reduce(mark, others, usual)).otherwise(usual)
    out = F.col("_marked")
    cut = F.substr(out, F.lit(1), F.length(out) - len(opening))
    last = F.when(out.endswith(opening), F.concat(cut, F.lit(_START + opening))).otherwise(out)
    known = _worked_out(_worked_out(df, "_bare", bare), "_marked", marked)
    return known.withColumn(content, last).drop("_bare", "_marked")


def cut_xml_records(
    lines: DataFrame,
    content: str = "raw_content",
    root: str = "SalesData",
    tag: str = "Transaction",
    chunk_rows: int = CHUNK_ROWS,
    stage: Stage | None = None,
) -> DataFrame:
    """(file_name, record_no, closed, content): the `<tag>` elements outside comments.

    `record_no` counts opening tags, so it is the position of the element in its file. Sound markup
    between elements is dropped.
    """
    stage = stage or Staging(lines.sparkSession)
    cleaned = lines.withColumn(content, text.strip_dashed(content))
    chunks = stage(chunk_documents(cleaned, content, "", chunk_rows), CHUNK_GROUP)
    own = F.substr(content, F.lit(1), F.length(content) - F.col("cut"))
    placed = _beside(chunks, xml_chunk_states(chunks, content), stage)
    outside = without_xml_comments(F.concat("head", own), F.col("inside"))
    plain = (
        _worked_out(placed, "_outside", outside)
        .select("file_name", "chunk", F.col("_outside").alias(content))
        .filter(F.col(content).isNotNull())
    )
    end = f"</{tag}>"
    spaced = F.when(
        F.col(content).contains(f"</{tag} "), F.regexp_replace(content, rf"</{tag}\s+>", end)
    ).otherwise(F.col(content))
    plain = plain.withColumn(content, spaced).withColumn(content, text.strip_root(content, root))
    pieces_of = F.split(content, _START, -1)
    cut = _marked(plain, content, tag).select(
        "file_name", "chunk", F.posexplode_outer(pieces_of).alias("piece", content)
    )
    closes = F.col(content).contains(end)
    pieces = cut.select(
        "file_name",
        "chunk",
        "piece",
        closes.alias("closes"),
        F.when(closes, F.concat(F.substring_index(content, end, 1), F.lit(end)))
        .otherwise(F.col(content))
        .alias(content),
        F.when(closes, F.substr(content, F.instr(content, end) + len(end))).alias("rest"),
    )
    pieces = stage(pieces, PIECE_GROUP)
    _forget(stage, chunks)
    return join_pieces(pieces, content, stage)


def _xml_options(strict: bool) -> dict[str, str]:
    if strict:
        return {"mode": "FAILFAST"}
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def parse_xml_documents(
    docs: DataFrame, content: str = "raw_content", strict: bool = False
) -> DataFrame:
    """Documents with `doc`; `doc._corrupt` holds the text of one that does not parse."""
    doc = F.from_xml(content, XML_DOCUMENT_DDL, _xml_options(strict))
    return _worked_out(docs, "doc", doc).select("file_name", "doc")


def xml_document_elements(
    lines: DataFrame, content: str = "raw_content", strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """As `xml_elements`, from whole documents; for files that a task can hold."""
    docs = parse_xml_documents(rebuild_xml(lines, content), content, strict)
    parsed = docs.select(
        "file_name",
        F.col("doc._corrupt").alias("bad"),
        F.posexplode_outer("doc.Transaction").alias("_pos", "t"),
    ).select("file_name", (F.col("_pos") + 1).cast("bigint").alias("record_no"), "t", "bad")
    return _good_and_bad(parsed)


def xml_elements(
    lines: DataFrame,
    content: str = "raw_content",
    strict: bool = False,
    chunk_rows: int = CHUNK_ROWS,
    on_bad: str = "record",
    stage: Stage | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(elements, set aside).

    elements: file_name, record_no, t (the transaction). Set aside: file_name, record_no, content;
    record_no is NULL for what is not part of a record. With a `stage`, both results come from one
    parse; without, what several steps read is written to the shared folder all the same.
    """
    whole = F.when(F.col("closed"), F.col(content))
    cutting = Staging(lines.sparkSession)
    records = _worked_out(
        cut_xml_records(lines, content, chunk_rows=chunk_rows, stage=cutting),
        "rec",
        F.from_xml(whole, XML_RECORD_DDL, _xml_options(strict)),
    )
    fields = [F.col(f"rec.{f}").alias(f) for f in XML_TOP_FIELDS]
    sound = F.col("closed") & F.col("rec._corrupt").isNull()
    parsed = records.select(
        "file_name",
        "record_no",
        F.when(sound, F.struct(*fields)).alias("t"),
        F.when(~F.col("closed"), F.col(content)).otherwise(F.col("rec._corrupt")).alias("bad"),
    )
    return _good_and_bad(_settled(parsed, stage, cutting), on_bad)


def _settled(parsed: DataFrame, stage: Stage | None, cutting: Staging) -> DataFrame:
    """With a stage, what was written to cut the records is emptied as soon as they are parsed."""
    if stage is None:
        return parsed
    parsed = stage(parsed)
    cutting.release()
    return parsed


def _good_and_bad(parsed: DataFrame, on_bad: str = "record") -> tuple[DataFrame, DataFrame]:
    """Parsed transactions, and the text of what is set aside."""
    if on_bad not in ("record", "document"):
        raise ValueError(f"on_bad is 'record' or 'document', not {on_bad!r}")
    good = parsed.filter("t IS NOT NULL AND bad IS NULL").drop("bad")
    bad = parsed.filter("bad IS NOT NULL").select(
        "file_name", "record_no", F.col("bad").alias("content")
    )
    if on_bad == "document":
        good = good.join(bad.select("file_name").distinct(), "file_name", "left_anti")
    return good, bad


# --- JSON -------------------------------------------------------------------------------------


def dedup_lines(
    lines: DataFrame, content: str = "raw_content", within: tuple[str, ...] = ()
) -> DataFrame:
    """One copy of a line per (file, row, text), the newest load first.

    `within` names columns that follow from the row number. Lines that lie together by them, or by file,
    are ranked where they lie; tasks then sort no more than that.
    """
    keys = ["file_name", *within, "file_row_number", content]
    return keep_latest(lines, keys, [F.col("load_dt").desc_nulls_first()])


def rebuild_json(lines: DataFrame, content: str = "raw_content") -> DataFrame:
    """(file_name, content): each file as one document without envelope, comments, semicolons."""
    whole = concat_lines(
        lines.select("file_name", "file_row_number", content), ["file_name"], content, "\n"
    )
    doc = text.strip_json_comments(text.strip_dash_lines(content))
    return whole.select("file_name", text.strip_semicolons(doc).alias(content))


#: Text that a chunk is given at its end. Outside comments it stays, inside one only _STOP does.
_SENTINEL = "\n*/" + _STOP

# Segments of a text: at most one opening bracket, at its start, and one closing, at its end. Possessive
# repeats: no backtracking, and no recursion on long strings.
_JSON_STRING = r'"(?:\\.|[^"\\\n])*+"'
_SEGMENT = rf'[{{\[]?+(?:{_JSON_STRING}|[^"{{}}\[\]]++|")*+[}}\]]?+'
# Code of a segment by its opening bracket (none, brace, square), its closing one, and what it opens: an
# element, a member's value, the wanted member's value.
#   . text   } ] closes   e A opens an element   o a opens a member   W M opens the wanted member
#   E N a whole element   n b a whole member   x X y Y closes with the wrong kind
_CODES = "..." "}}}" "]]]" "eoW" "Enn" "xXX" "AaM" "yYY" "Nbb"
_REDUCE_ROUNDS = 8


def _sentinel_kept(out: Column) -> Column:
    """Whether a text with comments removed, sentinel included, ended outside comments."""
    return out.endswith(_SENTINEL[1:])


def _without_sentinel(out: Column) -> Column:
    added = F.when(_sentinel_kept(out), len(_SENTINEL)).otherwise(len(_STOP))
    return F.substr(out, F.lit(1), F.length(out) - added)


def _stripped(content: Column) -> Column:
    """Text without comments, for text that starts outside them; the sentinel says how it ended."""
    return text.strip_json_comments(F.concat(content, F.lit(_SENTINEL)))


# The rest is SQL text: lambdas in lambdas are built in one call that way.


def _segments(plain: str) -> Column:
    return F.regexp_extract_all(text.strip_semicolons(plain), F.lit(_SEGMENT), F.lit(0))


def _codes(segments: str, key: str) -> Column:
    """One sign per segment, by its brackets and by what stands before it."""
    wanted = rf'"{re.escape(key)}"\s*:\s*$'
    return F.expr(rf"""
        array_join(transform({segments}, (s, i) -> CASE WHEN s = '' THEN '.' ELSE substring('{_CODES}',
          1 + 9 * instr('{{[', substring(s, 1, 1)) + 3 * instr('}}]', substring(s, -1, 1)) + CASE
            WHEN substring(s, 1, 1) NOT IN ('{{', '[') OR i = 0 THEN 0
            WHEN get({segments}, i - 1) RLIKE r'{wanted}' THEN 2
            WHEN get({segments}, i - 1) RLIKE r':\s*$' THEN 1 ELSE 0 END, 1) END), '')
    """)


def _reduced(codes: str) -> Column:
    """What the brackets of a text do to those around it, in short: sound pairs are left out.

    A whole element is E: it ends an unclosed object before it. That happens once however many follow.
    """
    out = f"regexp_replace({codes}, '[.nbN]', '')"
    for mixed, pair in (("x", "e]"), ("X", "o]"), ("y", "A}"), ("Y", "a}")):
        out = f"replace({out}, '{mixed}', '{pair}')"
    for _ in range(_REDUCE_ROUNDS):
        out = rf"regexp_replace(regexp_replace({out}, r'[oW]\}}|[aAM]E?+\]', ''), r'(?:e\}}|E)++', 'E')"
    return F.expr(out)


# The stack of open brackets is a text of { and [, with < and ( for the wanted member's value. An element
# cannot start in an object: objects above the nearest array are given up. A closing bracket closes the
# nearest open one of its kind, with all above it; a stray one is left out.
_FOUND = r"""
    CASE WHEN c IN ('e', 'E', 'x') AND st RLIKE r'^.+[\[(][{<]+$' THEN regexp_extract(st, r'^(.*[\[(])[{<]+$')
      ELSE st END
"""
_CLOSE_OBJECT = r"""
    CASE WHEN right({st}, 1) IN ('{{', '<') THEN left({st}, length({st}) - 1)
      WHEN {st} RLIKE r'^..+[{{<][\[(]+$' THEN regexp_extract({st}, r'^(.*)[{{<][\[(]+$') ELSE {st} END
"""
_CLOSE_ARRAY = r"""
    CASE WHEN right({st}, 1) IN ('[', '(') THEN left({st}, length({st}) - 1)
      WHEN {st} RLIKE r'[\[(][{{<]+$' THEN regexp_extract({st}, r'^(.*)[\[(][{{<]+$') ELSE {st} END
"""
#: The stack behind a segment with code `c`, from the one that its bracket is put on.
_AFTER = f"""
    CASE WHEN c IN ('E', 'n', 'b', 'N') THEN found
      WHEN c = '}}' THEN {_CLOSE_OBJECT.format(st="found")}
      WHEN c = ']' THEN {_CLOSE_ARRAY.format(st="found")}
      WHEN c IN ('x', 'X') THEN {_CLOSE_ARRAY.format(st="(found || '{')")}
      WHEN c IN ('y', 'Y') THEN {_CLOSE_OBJECT.format(st="(found || '[')")}
      ELSE found || CASE WHEN c IN ('e', 'o') THEN '{{' WHEN c IN ('a', 'A') THEN '['
        WHEN c = 'W' THEN if(length(found) = 1, '<', '{{') ELSE if(length(found) = 1, '(', '[') END
    END
"""


def _signs(codes: str) -> str:
    return f"filter(split({codes}, ''), x -> x <> '')"


def _stack_after(stack: str, reduced: str) -> str:
    """The stack behind a text of reduced codes."""
    return f"""
        aggregate({_signs(reduced)}, {stack},
          (st, c) -> transform(array({_FOUND}), found -> {_AFTER})[0])
    """


def _flags(stack: str, codes: str) -> Column:
    """One sign per segment: s starts a record, z ends it, S does both, i is inside one, o is not."""
    wanted, inside = r"RLIKE r'^[{\[][<(]$'", r"RLIKE r'^[{\[][<(].'"
    ends = f"c NOT IN ('e', 'o', 'a', 'A', 'W', 'M') AND after {wanted}"
    flag = f"""
        CASE WHEN c NOT IN ('}}', ']') AND found {wanted} THEN if({ends}, 'S', 's')
          WHEN found {inside} THEN if({ends}, 'z', 'i') ELSE 'o' END
    """
    return F.expr(f"""
        aggregate({_signs(codes)}, struct({stack} AS st, '' AS flags),
          (acc, c) -> CASE WHEN c = '.' THEN
              struct(acc.st AS st, acc.flags || if(acc.st {inside}, 'i', 'o') AS flags)
            ELSE transform(transform(array(acc.st), st -> {_FOUND}), found ->
              transform(array({_AFTER}), after -> struct(after AS st, acc.flags || {flag} AS flags))[0])[0]
            END,
          acc -> acc.flags)
    """)


def json_comment_states(chunks: DataFrame) -> DataFrame:
    """(file_name, chunk, inside): whether a chunk starts in a comment.

    `from_plain` and `from_inside` say how a chunk ends for either start. A chunk that ends the same way
    for both settles the state; one that keeps it changes nothing; one that swaps it is counted.
    """
    swaps = F.when(F.col("from_plain") & ~F.col("from_inside"), 1).otherwise(0)
    up_to = _before().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = chunks.select("file_name", "chunk", "from_plain", "from_inside", swaps.alias("_swap"))
    counted = counted.withColumn("_swaps", F.sum("_swap").over(up_to))
    settled = F.when(
        F.col("from_plain") == F.col("from_inside"), F.struct(F.col("from_plain").alias("to"), "_swaps")
    )
    known = F.last(settled, ignorenulls=True).over(_before())
    swapped = F.coalesce(F.lag("_swaps").over(Window.partitionBy("file_name").orderBy("chunk")), F.lit(0))
    odd = (swapped - F.coalesce(known["_swaps"], F.lit(0))) % 2 == 1
    inside = F.coalesce(known["to"], F.lit(False)) != odd
    return counted.select("file_name", "chunk", inside.alias("inside"))


def json_chunk_stacks(summaries: DataFrame) -> DataFrame:
    """(file_name, chunk, stack): the brackets that are open where a chunk starts.

    `summaries` has (file_name, chunk, reduced), a few bytes per chunk. One more row per file, without
    a chunk, has the brackets that are open at its end.
    """

    fold = f"""
        aggregate(_all, struct('' AS stack, CAST(array() AS array<struct<chunk:bigint,stack:string>>) AS out),
          (acc, x) -> struct({_stack_after("acc.stack", "x.reduced")} AS stack,
            concat(acc.out, array(struct(x.chunk AS chunk, acc.stack AS stack))) AS out))
    """
    none = F.struct(F.lit(None).cast("bigint").alias("chunk"), F.col("_end.stack").alias("stack"))
    return (
        summaries.groupBy("file_name")
        .agg(F.array_sort(F.collect_list(F.struct("chunk", "reduced"))).alias("_all"))
        .select("file_name", F.expr(fold).alias("_end"))
        .select("file_name", F.inline(F.concat("_end.out", F.array(none))))
    )


def cut_json_records(
    lines: DataFrame,
    content: str = "raw_content",
    key: str = "transactions",
    chunk_rows: int = CHUNK_ROWS,
    stage: Stage | None = None,
) -> DataFrame:
    """(file_name, record_no, closed, content): the elements of the root-level member `key`.

    Brackets outside strings and comments are followed by kind. A record that lacks a bracket ends at
    the next element or at a closing bracket of another kind, and the one after it is whole again. One
    that breaks off inside an array of its own takes the elements after it for its own, up to a closing
    bracket that does not fit. Brackets that a file leaves open are told by a row without a number.
    """
    stage = stage or Staging(lines.sparkSession)
    undashed = lines.withColumn(
        content, F.when(~F.col(content).startswith("--"), F.col(content)).otherwise("")
    )
    marks = _START + _END + _STOP
    folded = chunk_documents(undashed, content, "\n", chunk_rows).withColumn(
        content,
        F.when(F.col(content).rlike(f"[{marks}]"), F.translate(content, marks, "")).otherwise(
            F.col(content)
        ),
    )

    # One scan for the usual case of a chunk that starts outside comments. One that may start inside
    # keeps what would then be left of it. Where the first `*/` closes a comment of the chunk itself,
    # both starts have the same end.
    closed_at = F.instr(content, "*/")
    head = F.substr(content, F.lit(1), closed_at - 1)
    own = ~_sentinel_kept(_stripped(head))
    rest = F.substr(content, closed_at + F.lit(2))
    scanned = (
        folded.withColumn("_out", _stripped(F.col(content)))
        .withColumn("from_plain", ~_sentinel_kept(F.col("_out")))
        .withColumn("_plain", _without_sentinel(F.col("_out")))
        .withColumn("rest", F.when(closed_at > 0, rest))
        .withColumn(
            "from_inside",
            F.when(closed_at == 0, True)
            .when(own, F.col("from_plain"))
            .otherwise(~_sentinel_kept(_stripped(F.col("rest")))),
        )
        .withColumn("segments", _segments("_plain"))
        .withColumn("codes", _codes("segments", key))
    )
    ends = (
        F.when(F.col("_plain").rlike(rf'"{re.escape(key)}"\s*:\s*$'), "wanted")
        .when(F.col("_plain").rlike(r":\s*$"), "member")
        .when(F.col("_plain").rlike(r"\S"), "other")
    )
    scanned = stage(
        scanned.select(
            "file_name", "chunk", "from_plain", "from_inside", "rest", "segments", "codes",
            ends.alias("ends"), F.right("_plain", F.lit(200)).alias("tail"),
        ),
        CHUNK_GROUP,
    )
    known = _beside(scanned, json_comment_states(scanned), stage)
    again = (
        known.filter("inside")
        .withColumn("_plain", F.coalesce(_without_sentinel(_stripped(F.col("rest"))), F.lit("")))
        .withColumn("segments", _segments("_plain"))
        .withColumn("codes", _codes("segments", key))
        .select("file_name", "chunk", "segments", "codes", ends.alias("ends"), F.right("_plain", F.lit(200)).alias("tail"))
    )
    settled = known.filter("NOT inside").select(*again.columns).unionByName(again)

    # A bracket that opens a chunk is of the kind that the text before the chunk says.
    before = F.last("ends", ignorenulls=True).over(_before())
    first = F.regexp_extract("codes", r"^(\.*)(.)", 2)
    lead = F.regexp_extract("codes", r"^(\.*)(.)", 1)
    blank = F.coalesce(F.get("segments", F.length(lead) - 1).rlike(r"\S"), F.lit(False))
    preceding = settled.select("file_name", "chunk", before.alias("_before"))
    opens = first.isin("e", "E", "x", "A", "N", "y") & ~blank
    rest_codes = F.substr("codes", F.lit(2) + F.length(lead))
    turned = (
        F.when(F.col("_before") == "member", F.translate(first, "eExANy", "onXabY"))
        .when(F.col("_before") == "wanted", F.translate(first, "eExANy", "WnXMbY"))
        .otherwise(first)
    )
    codes = F.when(opens, F.concat(lead, turned, rest_codes)).otherwise(F.col("codes"))
    placed = _beside(settled, preceding, stage).withColumn("codes", codes)
    stacks = stage(
        json_chunk_stacks(placed.select("file_name", "chunk", _reduced("codes").alias("reduced")))
    )

    flagged = _beside(
        placed.select("file_name", "chunk", "segments", "codes"), stacks.filter("chunk IS NOT NULL"), stage
    ).withColumn("_flags", F.split(_flags("stack", "codes"), ""))

    marked = f"""
        array_join(transform(segments, (s, i) -> CASE get(_flags, i) WHEN 'i' THEN s WHEN 'o' THEN ''
          WHEN 's' THEN '{_START}' || s WHEN 'z' THEN s || '{_END}'
          WHEN 'S' THEN '{_START}' || s || '{_END}' ELSE '' END), '')
    """
    cut = flagged.select(
        "file_name",
        "chunk",
        F.posexplode(
            F.split(F.expr(marked), _START, -1)
        ).alias("piece", content),
    ).filter(F.col(content) != "")
    closes = F.col(content).endswith(_END)
    pieces = cut.select(
        "file_name",
        "chunk",
        "piece",
        closes.alias("closes"),
        F.when(closes, F.substr(content, F.lit(1), F.length(content) - 1))
        .otherwise(F.col(content))
        .alias(content),
    )
    pieces = stage(pieces, PIECE_GROUP)
    tails = stage(placed.groupBy("file_name").agg(F.max_by("tail", "chunk").alias("tail")))
    _forget(stage, scanned)
    records = join_pieces(pieces, content, stage)
    open_ = stacks.filter("chunk IS NULL AND stack <> ''").select("file_name", "stack")
    # unless a piece of the file is set aside anyway
    open_ = open_.join(
        records.filter("NOT closed").select("file_name").distinct(), "file_name", "left_anti"
    )
    said = F.concat(F.lit("brackets left open: "), F.translate("stack", "<(", "{["), F.lit(" after "), "tail")
    return records.unionByName(
        open_.join(tails, "file_name").select(
            "file_name",
            F.lit(None).cast("bigint").alias("record_no"),
            F.lit(False).alias("closed"),
            said.alias(content),
        )
    )


def variant_members(v: Column | str, path: str) -> Column:
    """Elements of an array, or values of an object, at a JSON path; NULL for anything else."""
    return F.coalesce(
        F.try_variant_get(v, path, "array<variant>"),
        F.map_values(F.try_variant_get(v, path, "map<string,variant>")),
    )


def json_document_elements(
    lines: DataFrame, content: str = "raw_content"
) -> tuple[DataFrame, DataFrame]:
    """As `json_elements`, from whole documents; for files that a task can hold."""
    whole = rebuild_json(dedup_lines(lines.repartition("file_name"), content), content)
    docs = _worked_out(whole, "doc", F.try_parse_json(content))
    parsed = docs.select(
        "file_name",
        F.when(F.col("doc").isNull(), F.col(content)).alias("bad"),
        F.posexplode_outer(variant_members("doc", "$.transactions")).alias("_pos", "t"),
    ).select("file_name", (F.col("_pos") + 1).cast("bigint").alias("record_no"), "t", "bad")
    return _good_and_bad(parsed)


def json_elements(
    lines: DataFrame,
    content: str = "raw_content",
    chunk_rows: int = CHUNK_ROWS,
    on_bad: str = "record",
    dedup: bool = True,
    stage: Stage | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(elements, set aside), as `xml_elements`; here t is a variant.

    Lines that are known to be there once each need no `dedup`.
    """
    unique = lines
    if dedup and "chunk" in lines.columns:
        unique = dedup_lines(lines, content)
    elif dedup:
        # copies of a line share its chunk
        number = F.expr(f"(file_row_number - 1) div {chunk_rows}")
        placed = lines.withColumn("chunk", number).repartition("file_name", "chunk")
        unique = dedup_lines(placed, content, ("chunk",))
    cutting = Staging(lines.sparkSession)
    records = cut_json_records(unique, content, chunk_rows=chunk_rows, stage=cutting)
    parsed = _worked_out(records, "t", F.when(F.col("closed"), F.try_parse_json(content))).select(
        "file_name", "record_no", "t", F.when(F.col("t").isNull(), F.col(content)).alias("bad")
    )
    return _good_and_bad(_settled(parsed, stage, cutting), on_bad)
