"""Token ids in binary files: patched frame-of-reference blocks with an index.

A file holds the ids of consecutive documents.  Its layout, all numbers little-endian:

    magic ``CTF1`` | documents, ids, blocks: 3 uint64 | document table | block starts | blocks
    document table: ids int64, flags uint8 (1: the document has no id), id counts uint64, one array each
    block starts: blocks + 1 uint64, offsets from the first block
    block: minimum uint32 | width uint8 | exceptions uint8 | packed remainders | exception places uint8 | exception values uint32

A block holds ``BLOCK`` ids, the last of a file the rest.  The width is the least in which ``KEEP`` of its remainders fit; the
others lie in the exception list, and zero bits stand in their place.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark.llm.ranks import before
from clinspark.llm.store import new_folder, stored
from clinspark.llm.workers import map_arrow, map_pandas

MAGIC = b"CTF1"
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
BLOCK = 128
KEEP = 0.9
#: A file is closed after the document with which it reaches so many ids.
FILE_IDS = 2_000_000
#: Offsets of up to so many files are broadcast; more are joined by shuffle.
BROADCAST_FILES = 100_000
#: Bytes of text that are encoded at a time.
SLICE_BYTES = 4 << 20
#: New words after which a worker begins to forget.
CACHE = 450_000


# ---------------------------------------------------------------- file format


def _pack_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All full blocks of ``ids`` (n x BLOCK); the bytes and the length of each block."""
    low = ids.min(axis=1)
    rest = ids - low[:, None]
    # the value at the percentile of each block decides its width
    wide = np.partition(rest, int(np.ceil(KEEP * ids.shape[1])) - 1, axis=1)[:, int(np.ceil(KEEP * ids.shape[1])) - 1]
    width = np.ceil(np.log2(wide.astype(np.float64) + 1)).astype(np.int64)
    over = rest >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    exceptions = over.sum(axis=1)
    packed_bytes = (width * ids.shape[1] + 7) // 8
    sizes = 6 + packed_bytes + 5 * exceptions
    starts = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(int(starts[-1]), np.uint8)
    at = starts[:-1]
    for j in range(4):
        out[at + j] = (low >> np.uint64(8 * j)).astype(np.uint8)
    out[at + 4] = width
    out[at + 5] = exceptions
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            values = np.where(over[rows], 0, rest[rows]).astype("<u4")
            bits = np.unpackbits(values.view(np.uint8).reshape(len(rows), -1, 4), axis=2, bitorder="little")[:, :, :w]
            packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
            out[(at[rows, None] + 6 + np.arange(packed.shape[1])).ravel()] = packed.ravel()
    if exceptions.any():
        row, place = np.nonzero(over)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        base = at[row] + 6 + packed_bytes[row]
        out[base + nth] = place
        for j in range(4):
            out[base + exceptions[row] + 4 * nth + j] = (rest[row, place] >> np.uint64(8 * j)).astype(np.uint8)
    return out.tobytes(), sizes


def encode_file(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a file with ``ids``, those of its documents one after the other."""
    full = len(ids) // BLOCK * BLOCK
    ids = ids.astype(np.uint64)
    parts, sizes = [], []
    for a in range(0, full, BLOCK * 2048):
        data, size = _pack_blocks(ids[a : min(a + BLOCK * 2048, full)].reshape(-1, BLOCK))
        parts.append(data)
        sizes.append(size)
    if full < len(ids):
        data, size = _pack_blocks(ids[full:].reshape(1, -1))
        parts.append(data)
        sizes.append(size)
    starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.array([0])
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    missing = np.array([d is None for d in doc_ids], np.uint8)
    head = MAGIC + struct.pack("<3Q", len(doc_ids), len(ids), len(starts) - 1)
    return b"".join([head, numbers.tobytes(), missing.tobytes(), counts.astype("<u8").tobytes(), starts.astype("<u8").tobytes(), *parts])


def _unpack_blocks(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The ids (n x ``length``) of the blocks that begin at ``starts``."""
    low = sum(data[starts + j].astype(np.uint64) << np.uint64(8 * j) for j in range(4))
    width, exceptions = data[starts + 4].astype(np.int64), data[starts + 5].astype(np.int64)
    packed_bytes = (width * length + 7) // 8
    rest = np.zeros((len(starts), length), np.uint64)
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            raw = data[starts[rows, None] + 6 + np.arange((w * length + 7) // 8)]
            bits = np.unpackbits(raw, axis=1, bitorder="little")[:, : w * length].reshape(len(rows), length, w)
            wide = np.zeros((len(rows), length, 32), np.uint8)
            wide[:, :, :w] = bits
            rest[rows] = np.packbits(wide, axis=2, bitorder="little").view("<u4")[:, :, 0]
    if exceptions.any():
        row = np.repeat(np.arange(len(starts)), exceptions)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        base = starts[row] + 6 + packed_bytes[row]
        value = sum(data[base + exceptions[row] + 4 * nth + j].astype(np.uint64) << np.uint64(8 * j) for j in range(4))
        rest[row, data[base + nth]] = value
    return rest + low[:, None]


def decode_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """``(doc_ids, counts, ids)`` of a file's bytes."""
    if data[:4] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_ids, n_blocks = struct.unpack_from("<3Q", data, 4)
    at = 28
    numbers = np.frombuffer(data, "<i8", n_docs, at)
    missing = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
    counts = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
    starts = np.frombuffer(data, "<u8", n_blocks + 1, at + 17 * n_docs).astype(np.int64)
    octets = np.frombuffer(data, np.uint8, offset=at + 17 * n_docs + 8 * (n_blocks + 1))
    full, rest = divmod(n_ids, BLOCK)
    ids = np.empty(n_ids, np.uint32)
    for a in range(0, full, 2048):
        b = min(a + 2048, full)
        ids[a * BLOCK : b * BLOCK] = _unpack_blocks(octets, starts[a:b], BLOCK).ravel()
    if rest:
        ids[full * BLOCK :] = _unpack_blocks(octets, starts[full : full + 1], rest).ravel()
    return [None if m else int(x) for x, m in zip(numbers, missing, strict=True)], counts, ids


# ---------------------------------------------------------------- tokens


class WordEncoder:
    """Token ids of texts, as little-endian bytes, by a tokenizer that never joins what white space separates.

    The ids of a text are those of its words, so a word is encoded once and remembered.  An all-letter word is looked up in lower case and
    without a comma or full stop behind it: the tokenizer lowers letters and splits them from other signs.  That holds for letters
    below U+0130, which stay single letters when normalised and lowered.  New words of that kind are encoded many at a time, as one text,
    and told apart by the tokens that end a word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for lower-case words of letters, which need neither normalising nor the pattern that splits words
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            (whole,) = self.letters.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(whole.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):
                out += self._plain(some)
                continue
            data, bounds = ids.tobytes(), [0, *(4 * cuts).tolist()]
            out += [data[x:y] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        return out

    def _add(self, words: list[str]) -> None:
        """Makes ``words`` known."""
        known, older = self.known, self.older
        stems, other = {}, []
        for word in words:
            if word in older:
                known[word] = older[word]
            elif max(word) < "\u0130" and (stem := word[:-1] if word[-1] in ",." else word).isalpha():
                stems[word] = stem.lower()
            else:
                other.append(word)
        new = [s for s in set(stems.values()) if s not in known]
        for s in new:
            if s in older:
                known[s] = older[s]
        new = [s for s in new if s not in known]
        known.update(zip(new, self._letters(new), strict=True))
        known.update(zip(other, self._plain(other), strict=True))
        signs = {sign: self._plain([sign])[0] for sign in ",."} if stems else {}
        for word, stem in stems.items():
            if word != stem:
                known[word] = known[stem] + signs.get(word[-1], b"")

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text, and all ids one after the other.

        Arrow cuts the texts at ASCII white space and numbers their distinct words, so that only those are looked up, and the ids of all
        places are gathered at once.  Words of the last two spells are remembered, a spell being ``CACHE`` new words."""
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        lists = pc.ascii_split_whitespace(texts)
        places = lists.flatten().dictionary_encode()
        words = places.dictionary.to_pylist()
        self.known.setdefault("", b"")
        if missing := [w for w in words if w not in self.known]:
            self._add(missing)
        coded = [self.known[w] for w in words]
        sizes = np.fromiter((len(d) // 4 for d in coded), np.int64, len(coded))
        table, starts = np.frombuffer(b"".join(coded), "<u4"), np.cumsum(sizes) - sizes
        which = places.indices.to_numpy()
        ends = np.concatenate(([0], np.cumsum(sizes[which])))
        # a place's ids lie in the table from its word's start on
        shift = np.repeat(starts[which] - ends[:-1], sizes[which])
        ids = table[shift + np.arange(ends[-1])]
        bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))
        return np.diff(ends[bounds]), ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian bytes."""
        counts, ids = self.encode_all(pa.array(texts, pa.string()))
        return [x.astype("<u4").tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, file_ids: int = FILE_IDS) -> None:
    """Writes the ids of every text, each followed by ``end_id``, to files in ``folder`` in ascending order of id.

    Documents are dealt to tasks by ranges of their id.  Files are named by task, number in the task and number of ids, and
    sort as the documents do.  A task that runs again, because
    an executor was lost or was slow, writes the same files; each appears under its name only when whole."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranged = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        system, root = pafs.FileSystem.from_uri(folder)
        encoder = _encoder(tokenizer)
        made, numbers, chunks, counts, held = 0, [], [], [], 0

        def close() -> None:
            nonlocal made, numbers, chunks, counts, held
            system.create_dir(root, recursive=True)
            name = f"{root}/{part:06d}-{made:06d}-{held}.tokens"
            with system.open_output_stream(f"{name}.{attempt}.writing") as sink:
                sink.write(encode_file(numbers, np.array(counts), np.concatenate(chunks)))
            system.move(f"{name}.{attempt}.writing", name)
            made, numbers, chunks, counts, held = made + 1, [], [], [], 0

        for batch in batches:
            column = batch.column("text")
            sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                # as many texts as fit, one at least
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, side="right")))
                lengths, flat = encoder.encode_all(column.slice(at, upto - at))
                flat = np.insert(flat, np.cumsum(lengths), end_id)
                lengths = lengths + 1
                ids_of = batch.column("id").slice(at, upto - at).to_pylist()
                total = np.cumsum(lengths)
                begin, done = 0, 0
                while begin < len(lengths):
                    # up to the text with which the file is full
                    last = int(np.searchsorted(total, done + file_ids - held))
                    stop = min(last + 1, len(lengths))
                    chunks.append(flat[done : total[stop - 1]])
                    numbers += ids_of[begin:stop]
                    counts += lengths[begin:stop].tolist()
                    held += int(total[stop - 1]) - done
                    begin, done = stop, int(total[stop - 1])
                    if held >= file_ids:
                        close()
                at = upto
        if numbers:
            close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([made], pa.int32())})

    map_arrow(ranged, work, "files int").agg(F.sum("files")).collect()


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, ids)`` of every document in the files of ``folder``; ``start`` counts the ids of all
    documents before it.  ``ids`` is left out on request; it is most of what the workers send."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    part = lambda i: F.regexp_extract("path", "([0-9]+)-([0-9]+)-([0-9]+)[.]tokens$", i).cast("long")
    # names alone give the offsets; the contents are not read for them, and with few enough files never shuffled
    listed = files.select("path", part(1).alias("part"), part(2).alias("nth"), part(3).alias("n"), F.lit(0).alias("all"))
    offsets = stored(before(listed, "all", "part", ["nth"], F.col("n"), "offset").select(F.col("path").alias("_path"), "offset"), "file-offsets")
    if offsets.count() <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    named = files.select("path", "content").join(offsets, F.col("path") == F.col("_path"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, offset in zip(batch["content"], batch["offset"], strict=True):
                numbers, counts, ids = decode_file(data)
                ids = ids.astype("<u4")
                ends = np.cumsum(counts)
                begins = ends - counts
                cut = [ids[a:b] for a, b in zip(begins, ends, strict=True)]
                for at in range(0, len(cut), 1000):
                    some = slice(at, at + 1000)
                    made = pd.DataFrame({
                        "doc_id": pd.array(numbers[some], dtype="Int64"), "start": begins[some] + offset, "n_tokens": counts[some],
                        "ids_crc32": [zlib.crc32(x.tobytes()) for x in cut[some]],
                    })
                    yield made.assign(ids=[x.astype(np.int64) for x in cut[some]]) if with_ids else made

    return map_pandas(named.select("content", "offset"), work, SCHEMA + (", ids array<long>" if with_ids else ""))


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, file_ids: int = FILE_IDS, with_ids: bool = True) -> DataFrame:
    """Writes the token files of ``docs`` to a new folder among the shared ones, or to ``folder``, and returns what they hold.

    Null and empty texts have the end id alone.  Documents without an id come first; those that repeat one follow each
    other in the order of their texts.  No documents give no files, and an empty result.  Other columns are not read."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    write_token_files(docs, folder, tokenizer, id_col, text_col, end_id, file_ids)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SCHEMA + (", ids array<long>" if with_ids else ""))
    return read_token_files(spark, folder, with_ids)
