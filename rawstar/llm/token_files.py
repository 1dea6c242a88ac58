"""Token ids of whole texts in compressed binary files, and back.

Texts are encoded with a tokenizer, each document's ids are ended by a given id, and the ids of a
range of documents become one file. Ranges are sorted, so the files in order hold all documents by
ascending id (rows with equal ids by a digest of their text, null ids first).

A file is

    head     "RSID", version (u16), 0 (u16), vocabulary size (u32), ids per block (u32), blocks per
             group (u32)
    blocks   number of ids (u32), bytes (u32), crc32 of the ids as u32 (u32), payload of the coder
    index    zlib of: ids per document (i64), document ids (i64), null marks (u8), block offsets (i64),
             shares of the vocabulary's ids in each group of blocks (u32)
    tail     index offset (u64), index bytes (u64), documents (u64), blocks (u64), ids (u64),
             crc32 of the index (u32), "DISR"

with all numbers little-endian. Every block but the last holds the same number of ids, so a reader
finds any document without decoding what comes before it. Blocks are coded on their own (see
`range_coder`), those of a group with the same shares, and checked when they are read; a damaged block
or index raises `DamagedFile`.

Tasks write the files straight to the shared folder; the driver sees none of them. A task that is run
again writes a file of another name, and only files that the stored list names are read. A task holds
one group of blocks (4 million ids), 8 megabytes of text with their ids, or a single long text's ids,
and what its encoder remembers.

Texts are cut into words at blanks, and each distinct word of some megabytes of text is encoded once:
the tokenizer cuts at white space and joins nothing over it. A word in ASCII and Latin-1 letters is cut
into runs of lower-case letters, digits and other characters, as the tokenizer's own steps before its
model cut it; the model encodes a run once, which is looked up after that. Other words, and all words
where a tokenizer has other steps, go through it whole, also once. What was encoded is kept, words in
an Arrow table, runs in a dictionary, both bounded. Strings of special tokens in a text are ordinary
text.

Results for odd input: a null or empty text has the end id alone. Rows that repeat are documents each.
Long texts are encoded in pieces cut at blanks; a word of any length is whole. Other columns of the
input are not read. An empty table gives no file and an empty result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rawstar.llm import range_coder
from rawstar.llm.base import shared_dir, stage, text_rows

END_ID = 1
HEAD = struct.Struct("<4sHHIII")
BLOCK = struct.Struct("<III")
TAIL = struct.Struct("<QQQQQI4s")
MAGIC, END_MAGIC, VERSION = b"RSID", b"DISR", 2

PIECE = 1 << 20
#: Bytes of texts whose words are looked up together.
TOGETHER = 1 << 23
#: Bounds of what an encoder remembers: runs, and ids of them.
WORDS, WORD_IDS = 1 << 19, 1 << 22
#: The same for the table of words.
SEEN, SEEN_IDS = 1 << 20, 1 << 22
#: Ids that one batch of a reader's rows holds about.
ROWS_IDS = 1 << 21

FILE_DDL = "file_no int, path string, n_docs long, n_ids long, n_bytes long"
FILE_TYPES = {
    "file_no": pa.int32(),
    "path": pa.string(),
    "n_docs": pa.int64(),
    "n_ids": pa.int64(),
    "n_bytes": pa.int64(),
}


class DamagedFile(ValueError):
    """Bytes of a token file do not agree with their checksum."""


# --- texts to ids --------------------------------------------------------------------------------


#: The steps before a tokenizer's model that `WordEncoder` takes by itself for words of `PLAIN`.
STEPS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {
                    "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
                },
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "truncation": None,
    "padding": None,
}
#: Words of ASCII without white space and letters that NFC leaves alone and lower-casing maps to one.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
#: The runs of such words in lower case, and the line ends between words.
RUNS = re.compile("\n|'(?:[stmd]|re|ve|ll)|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+")
#: Stands for a line end among ids, whose highest byte is never set.
LINE_END = b"\xff" * 4


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def joined(ids: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words `at` in turn, and the places where they start, with the end."""
    starts = np.cumsum(lengths) - lengths
    n = lengths.take(at)
    upto = np.concatenate([[0], np.cumsum(n)])
    places = np.repeat(starts.take(at) - upto[:-1], n) + np.arange(upto[-1])
    return ids.take(places), upto


class WordEncoder:
    """Ids of texts by their words; words seen before are looked up."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size()
        says = json.loads(self.tokenizer.to_str())
        self.by_runs = all(says[k] == v for k, v in STEPS.items()) and all(
            t["special"] for t in says["added_tokens"]
        )
        self.model = self.tokenizer.model
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {c: spell(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.known: dict[str, bytes] = {}
        self._forget()
        self._see(pa.array([], pa.large_string()), np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64))

    def _forget(self) -> None:
        """Begin a generation of known runs and words. It holds half of what may be remembered; what is
        met again lives on."""
        self.before, self.known, self.n_ids = self.known, {"\n": LINE_END}, 0

    def _learn(self, new: list[str], encode) -> None:
        """Make known what is not, from the generation before or with `encode`."""
        old = self.before
        ids = {w: old[w] for w in new if w in old}
        unseen = [w for w in new if w not in ids]
        ids |= zip(unseen, encode(unseen))
        self.known |= ids
        self.n_ids += sum(map(len, ids.values())) // 4

    def _runs(self, runs: list[str]) -> Iterator[bytes]:
        ids: list[int] = []
        upto = [0]
        for r in runs:
            spelt = r if r.isascii() else r.translate(self.spelling)
            ids += [t.id for t in self.model.tokenize(spelt)]
            upto.append(4 * len(ids))
        raw = packed(ids)
        return (raw[a:b] for a, b in pairwise(upto))

    def _whole(self, words: list[str]) -> Iterator[bytes]:
        for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False):
            yield packed(e.ids)

    def _plain(self, words: list[str]) -> list[bytes]:
        runs = RUNS.findall("\n".join(words).lower())
        self._learn(list(set(runs).difference(self.known)), self._runs)
        return b"".join(map(self.known.__getitem__, runs)).split(LINE_END)

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words as little-endian unsigned 32-bit integers."""
        found = list(map(self.known.get, words))
        rest = [w for w, ids in zip(words, found) if ids is None]
        plain = list(filter(PLAIN.fullmatch, rest)) if self.by_runs else []
        ids = dict(zip(plain, self._plain(plain)))
        if len(plain) < len(rest):
            other = [w for w in rest if w not in ids]
            self._learn(other, self._whole)
            ids |= ((w, self.known[w]) for w in other)
        fresh = map(ids.__getitem__, rest)
        return [next(fresh) if x is None else x for x in found]

    def _see(self, words: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.seen, self.seen_ids, self.seen_lengths = words, ids, lengths

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words one after the other and how many each has; which of these the given ones are.

        Words of the table are found in it, unless the given ones are few beside it; new ones join it.
        A full table is left with the given words.
        """
        few = 4 * len(words) < len(self.seen)
        if few:
            at = np.full(len(words), -1)
        else:
            found = pc.index_in(words, value_set=self.seen)
            at = found.fill_null(-1).to_numpy().astype(np.int64)
        new = words.filter(pa.array(at < 0))
        ids_of = self.words(new.to_numpy(zero_copy_only=False).tolist())
        n_new = np.fromiter(map(len, ids_of), dtype=np.int64, count=len(ids_of)) // 4
        ids = np.concatenate([self.seen_ids, np.frombuffer(b"".join(ids_of), dtype="<u4")])
        lengths = np.concatenate([self.seen_lengths, n_new])
        at[at < 0] = len(self.seen) + np.arange(len(new))
        if not few:
            seen = pa.concat_arrays([self.seen, new])
            if len(seen) <= SEEN and len(ids) <= SEEN_IDS:
                self._see(seen, ids, lengths)
            else:
                self._see(words, joined(ids, lengths, at)[0], lengths.take(at))
        return ids, lengths, at

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the places where texts start, with their end.

        Distinct words are looked up once.
        """
        if len(self.known) > WORDS // 2 or self.n_ids > WORD_IDS // 2:
            self._forget()
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        ids, lengths, at = self.distinct(words.dictionary.cast(pa.large_string()))
        out, upto = joined(ids, lengths, at.take(words.indices.to_numpy()))
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        return out, upto[np.concatenate([[0], np.cumsum(sizes)])]

    def documents(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; texts are taken together up to `TOGETHER` bytes, longer ones in pieces."""
        size = pc.binary_length(texts).to_numpy()
        upto = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < len(texts):
            before = int(upto[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(upto, before + TOGETHER, side="right")))
            if size[at] > PIECE:
                parts = [self.texts(pa.array([p], pa.large_string())) for p in pieces(texts[at].as_py())]
                yield np.concatenate([ids for ids, _ in parts])
                at += 1
                continue
            long = np.flatnonzero(size[at:to] > PIECE)
            to = at + int(long[0]) if len(long) else to
            ids, places = self.texts(texts[at:to])
            for start, end in pairwise(places.tolist()):
                yield ids[start:end]
            at = to

    def document(self, text: str) -> np.ndarray:
        return next(self.documents(pa.array([text], pa.large_string())))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One per Python worker: the words of one task are known to the next."""
    return WordEncoder(path)


def pieces(text: str, chars: int = PIECE) -> Iterator[str]:
    """The text cut at blanks, which are dropped; a piece is longer only where no blank comes."""
    at = 0
    while at <= len(text):
        to = text.find(" ", at + chars)
        to = len(text) if to < 0 else to
        yield text[at:to]
        at = to + 1


# --- files ---------------------------------------------------------------------------------------


def _open(path: str):
    """File system and path within it, for local paths and the stores that Arrow knows."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path)


class FileWriter:
    """Writes documents one after the other; `close` returns numbers of documents, ids and bytes."""

    def __init__(self, path: str, size: int, block_ids: int = range_coder.BLOCK_IDS):
        system, inside = _open(path)
        system.create_dir(inside.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(inside)
        self.size, self.block_ids, self.group = size, block_ids, range_coder.LANES
        self.out.write(HEAD.pack(MAGIC, VERSION, 0, size, block_ids, self.group))
        self.at = HEAD.size
        self.docs: list[tuple[int | None, int]] = []
        self.offsets: list[int] = []
        self.shares: list[np.ndarray] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.group * self.block_ids:
            self._flush()

    def _flush(self, all_: bool = False) -> None:
        """Write waiting ids: whole groups of full blocks, or all."""
        ids = np.concatenate([*self.waiting, np.zeros(0, dtype=np.uint32)])
        step = self.group * self.block_ids
        n = len(ids) if all_ else len(ids) // step * step
        for at in range(0, n, step):
            self._write(ids[at : min(at + step, n)])
        self.waiting = [ids[n:].copy()]
        self.n_waiting = len(ids) - n
        self.n_ids += n

    def _write(self, ids: np.ndarray) -> None:
        shares = range_coder.shares_of(range_coder.count_ids(ids, self.size))
        self.shares.append(shares)
        blocks = [ids[i : i + self.block_ids] for i in range(0, len(ids), self.block_ids)]
        payloads = range_coder.encode_blocks(blocks, self.size, shares)
        for block, payload in zip(blocks, payloads):
            check = zlib.crc32(block.astype("<u4").tobytes())
            self.offsets.append(self.at)
            self.out.write(BLOCK.pack(len(block), len(payload), check) + payload)
            self.at += BLOCK.size + len(payload)

    def close(self) -> tuple[int, int, int]:
        if self.n_waiting:
            self._flush(all_=True)
        n = np.array([k for _, k in self.docs], dtype="<i8")
        ids = np.array([i or 0 for i, _ in self.docs], dtype="<i8")
        null = np.array([i is None for i, _ in self.docs], dtype="u1")
        offsets = np.array(self.offsets, dtype="<i8")
        index = zlib.compress(b"".join(a.tobytes() for a in (n, ids, null, offsets, *self.shares)))
        self.out.write(index)
        counts = (len(self.docs), len(self.offsets), self.n_ids)
        self.out.write(TAIL.pack(self.at, len(index), *counts, zlib.crc32(index), END_MAGIC))
        self.out.close()
        return len(self.docs), self.n_ids, self.at + len(index) + TAIL.size


class FileReader:
    """A token file: `doc_ids` (None for null) and `n_tokens` of its documents, and their ids."""

    def __init__(self, path: str):
        system, inside = _open(path)
        self.path, self.file = path, system.open_input_file(inside)
        size = self.file.size()
        magic, version, _, *sizes = HEAD.unpack(self._read(0, HEAD.size))
        self.size, self.block_ids, self.group = sizes
        at, length, n, n_blocks, self.n_ids, check, end = TAIL.unpack(
            self._read(size - TAIL.size, TAIL.size)
        )
        if (magic, version, end) != (MAGIC, VERSION, END_MAGIC):
            raise DamagedFile(f"{path}: no token file of version {VERSION}")
        packed = self._read(at, length)
        if zlib.crc32(packed) != check:
            raise DamagedFile(f"{path}: index")
        index = zlib.decompress(packed)
        self.n_tokens = np.frombuffer(index, "<i8", n)
        ids = np.frombuffer(index, "<i8", n, 8 * n)
        null = np.frombuffer(index, "u1", n, 16 * n)
        self.doc_ids = [None if x else i for i, x in zip(ids.tolist(), null.tolist())]
        self.offsets = np.append(np.frombuffer(index, "<i8", n_blocks, 17 * n), at)
        self.shares = np.frombuffer(index, "<u4", offset=17 * n + 8 * n_blocks).reshape(-1, self.size)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first to last - 1."""
        start = int(self.offsets[first])
        raw = self._read(start, int(self.offsets[last]) - start)
        payloads, counts, checks = [], [], []
        for at in (self.offsets[first:last] - start).tolist():
            n, length, check = BLOCK.unpack_from(raw, at)
            payloads.append(raw[at + BLOCK.size : at + BLOCK.size + length])
            counts.append(n)
            checks.append(check)
        found: list[np.ndarray] = []
        while len(found) < len(payloads):
            at = len(found)
            group, inside = divmod(first + at, self.group)
            to = at + self.group - inside
            shares = self.shares[group]
            found += range_coder.decode_blocks(payloads[at:to], counts[at:to], self.size, shares)
        for k, (ids, check) in enumerate(zip(found, checks), start=first):
            if zlib.crc32(ids.astype("<u4").tobytes()) != check:
                raise DamagedFile(f"{self.path}: block {k}")
        return np.concatenate([*found, np.zeros(0, dtype="<u4")])

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from the start-th of the file on; reads only the blocks that hold them."""
        if n <= 0:
            return np.zeros(0, dtype="<u4")
        first, last = start // self.block_ids, -(-(start + n) // self.block_ids)
        skip = start - first * self.block_ids
        return self.blocks(first, last)[skip : skip + n]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, ids of the file before it, ids; a group of blocks is held at a time."""
        n_blocks = len(self.offsets) - 1
        parts = [np.zeros(0, dtype="<u4")]
        have = read = start = 0
        for doc_id, n in zip(self.doc_ids, self.n_tokens.tolist()):
            while have < n:
                upto = min(read + self.group, n_blocks)
                got = self.blocks(read, upto)
                parts, read, have = [*parts, got], upto, have + len(got)
            all_ = np.concatenate(parts) if len(parts) != 1 else parts[0]
            yield doc_id, start, all_[:n]
            parts, have, start = [all_[n:]], have - n, start + n


# --- Spark jobs ----------------------------------------------------------------------------------


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    block_ids: int = range_coder.BLOCK_IDS,
) -> DataFrame:
    """file_no, path, n_docs, n_ids, n_bytes, start: the files written, in the order of their ids.

    `start` is the number of ids in all files before. The list is stored in the shared folder.
    """
    where = tokenizer or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        words, out = encoder(where), None
        end = np.array([end_id], dtype="<u4")
        for b in batches:
            for doc_id, ids in zip(b["doc_id"].to_pylist(), words.documents(b["text"])):
                if out is None:
                    out = FileWriter(path, max(words.size, end_id + 1), block_ids)
                out.add(doc_id, np.concatenate([ids, end]))
        if out is not None:
            row = (task.partitionId(), path, *out.close())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, FILE_TYPES.values())], names=[*FILE_TYPES]
            )

    # The last column deals rows that repeat an id and its text to several ranges as well.
    keyed = text_rows(docs).select(
        "doc_id", "text", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("row")
    )
    order = ["doc_id", "mark", "row"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    files = stage(ranged.select("doc_id", "text").mapInArrow(run, FILE_DDL), "token-files")
    return with_starts(files)


def with_starts(files: DataFrame, group: int = 1000) -> DataFrame:
    """`files` with the number of ids in all files before; sums run over groups of files first."""
    dealt = files.withColumn("_group", F.expr(f"file_no div {group}"))
    up_to = Window.rowsBetween(Window.unboundedPreceding, -1)
    groups = dealt.groupBy("_group").agg(F.sum("n_ids").alias("_n"))
    before = groups.select(
        "_group", F.coalesce(F.sum("_n").over(up_to.orderBy("_group")), F.lit(0)).alias("_before")
    )
    inside = F.coalesce(
        F.sum("n_ids").over(up_to.partitionBy("_group").orderBy("file_no")), F.lit(0)
    )
    return (
        dealt.withColumn("_inside", inside)
        .join(before, "_group")
        .select(*files.columns, (F.col("_before") + F.col("_inside")).alias("start"))
    )


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (binary, u32 little-endian): the documents of the listed files."""
    ddl = "doc_id long, start long, n_tokens long, ids binary"

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids"])
        return out.astype({"doc_id": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, base in zip(b["path"], b["start"]):
                rows, held = [], 0
                for doc_id, at, ids in FileReader(path).documents():
                    rows.append((doc_id, int(base) + at, len(ids), ids.astype("<u4").tobytes()))
                    held += len(ids)
                    if held >= ROWS_IDS:
                        yield frame(rows)
                        rows, held = [], 0
                if rows:
                    yield frame(rows)

    n = max(1, files.count())
    # one file a task
    return files.repartitionByRange(n, "file_no").select("path", "start").mapInPandas(run, ddl)


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the documents' ids to files in the session's shared folder and read them back."""
    spark: SparkSession = docs.sparkSession
    return read_files(write_files(docs, shared_dir(spark, "ids"), **options))
