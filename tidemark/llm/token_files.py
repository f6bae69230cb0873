"""Token files: ids packed in the fewest bits, in blocks with offsets, with random access.

A file holds, in this order: packed blocks of ``BLOCK`` ids each (the last may be shorter), the byte
offset of each block, the start of each document in ids, the documents' keys, and a footer of fixed size that
names the places. An id takes ``bits`` bits, least significant first; each block starts at a byte.

Documents lie in ascending order of their keys, over all files: rows are split by ranges of the
key, one file to a range. A small table of the files, written last, gives each file's first id.

Defined cases: a null text has the end id only; rows with a null key come first; repeated rows
all stay, equal keys ordered by text; an empty table gives no files and no rows; other columns are
not read.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tasks import Upload, map_batches, open_store, slices
from tidemark.workspace import run_dir, shared_table

BLOCK = 4096
MAGIC = b"TMIDS\x01"
#: magic, bits, has null keys, block size, ids, documents, and the places of the three tables
FOOTER = struct.Struct("<6sBBIQQQQQ")
#: Entries of a worker's table of words.
MEMO_WORDS = 500_000
#: Characters of the texts that are put together by arrays at a time, and rows that a task takes at once.
TOGETHER, ROWS = 1 << 23, 2048


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, least significant bit first."""
    if bits == 16 and (not len(ids) or int(ids.max()) >> bits == 0):
        return ids.astype("<u2").tobytes()
    planes = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    if planes[:, bits:].any():
        raise ValueError(f"an id needs more than {bits} bits")
    return np.packbits(planes[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits == 16:
        return np.frombuffer(data, "<u2", count).astype("<u4")
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = planes.reshape(count, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class TokenFileWriter:
    """Appends documents; holds at most one block of ids and the tables."""

    def __init__(self, upload: Upload, bits: int, block: int = BLOCK):
        self.upload, self.bits, self.block = upload, bits, block
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = 0
        self.blocks, self.starts, self.keys, self.nulls = [], [], [], []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.starts.append(self.ids)
        self.keys.append(0 if key is None else key)
        self.nulls.append(key is None)
        self.waiting.append(ids)
        self.ids += len(ids)
        self.held += len(ids)
        if self.held >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        if not self.held:
            return
        ids = np.concatenate(self.waiting)
        whole = len(ids) if last else len(ids) - len(ids) % self.block
        for k in range(0, whole, self.block):
            self.blocks.append(self.upload.size)
            self.upload.write(pack(ids[k : k + self.block], self.bits))
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> str:
        self._flush(True)
        places = []
        for table, kind in ((self.blocks, "<u8"), (self.starts, "<u8"), (self.keys, "<i8")):
            places.append(self.upload.size)
            self.upload.write(np.array(table, kind).tobytes())
        self.upload.write(np.packbits(np.array(self.nulls, bool)).tobytes())
        self.upload.write(FOOTER.pack(MAGIC, self.bits, any(self.nulls), self.block, self.ids, len(self.keys), *places))
        return self.upload.commit()


class TokenFile:
    """Reads a token file: tables at once, ids by the block."""

    def __init__(self, uri: str):
        store, path = open_store(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        if size < FOOTER.size:
            raise ValueError(f"{uri}: too short for a token file")
        magic, self.bits, nulls, self.block, self.ids, self.documents, *places = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        blocks = -(-self.ids // self.block)
        mask = -(-self.documents // 8)
        if magic != MAGIC or not places[0] + 8 * blocks == places[1] or not places[1] + 8 * self.documents == places[2] or places[2] + 8 * self.documents + mask + FOOTER.size != size:
            raise ValueError(f"{uri}: not a token file, or cut short")
        self.end = places[0]
        read = lambda place, count, kind: np.frombuffer(self.file.read_at(8 * count, place), kind)
        self.offsets, self.starts, keys = read(places[0], blocks, "<u8"), read(places[1], self.documents, "<u8"), read(places[2], self.documents, "<i8")
        missing = np.unpackbits(np.frombuffer(self.file.read_at(mask, places[2] + 8 * self.documents), np.uint8), count=self.documents)
        self.keys = [None if m else k for k, m in zip(keys.tolist(), missing.tolist())] if nulls else keys.tolist()

    def read(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start``, reading only the blocks that hold them."""
        if start < 0 or count < 0 or start + count > self.ids:
            raise IndexError("outside the file")
        if not count:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (start + count - 1) // self.block
        begin = int(self.offsets[first])
        end = int(self.offsets[last + 1]) if last + 1 < len(self.offsets) else self.end
        data = self.file.read_at(end - begin, begin)
        stop = min((last + 1) * self.block, self.ids)
        if self.block * self.bits % 8 == 0:
            ids = unpack(data, stop - first * self.block, self.bits)
        else:
            cuts = [int(o) - begin for o in self.offsets[first : last + 1]] + [end - begin]
            ids = np.concatenate([unpack(data[a:b], min(self.block, self.ids - (first + k) * self.block), self.bits) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))])
        return ids[start - first * self.block :][:count]

    def document(self, index: int) -> np.ndarray:
        end = int(self.starts[index + 1]) if index + 1 < self.documents else self.ids
        return self.read(int(self.starts[index]), end - int(self.starts[index]))


class WordwiseTokenizer:
    """The ``tokenizers`` library behind a table of the pieces that it has encoded.

    A byte-level tokenizer splits at a single space or line break between two other characters, whatever stands around.
    So the ids of a text are those of its first word and of each later one with its space or break. Texts in
    which white space meets white space, or an end, are encoded as they are.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.size = self.tokenizer.get_vocab_size()
        self.spaced = np.zeros(self.size, bool)
        for name, token in self.tokenizer.get_vocab().items():
            self.spaced[token] = name.startswith("Ġ")
        #: Ids of pieces: a word stands for itself after a space, a word with a line break in front for both.
        self.memo: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}
        self.marks = {mark: self._ids(mark).tobytes() for mark in ",."}
        self.breaks = self._ids("\n")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _together(self, pieces: list[str], text: str, begins) -> None:
        """Encode pieces in one call, if each has just one id that begins it; ``text`` is that of all of them."""
        ids = self._ids(text)
        starts = np.flatnonzero(begins(ids))
        if len(starts) == len(pieces):
            cuts, data = (4 * starts).tolist(), ids.tobytes()
            self.memo.update(zip(pieces, map(data.__getitem__, map(slice, cuts, [*cuts[1:], len(data)]))))

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces. Those with further white space, or nothing but it, are left out.

        A comma or full stop after letters is an id of its own, so that such words need no look at the library.
        """
        marked = {w: w[:-1] for w in pieces if w[-1:] in (",", ".") and w[:-1].lstrip("\n").isalpha()}
        wanted = pieces.difference(marked).union(marked.values()).difference(self.memo)
        plain = [w for w in wanted if w.split() == [w]]
        lines = [w for w in wanted if w[:1] == "\n" and w.split() == [w[1:]]]
        if plain:
            self._together(plain, " " + " ".join(plain), lambda ids: self.spaced[ids])
        if lines and len(self.breaks) == 1:
            self._together(lines, "".join(lines), lambda ids: ids == self.breaks[0])
        for word in [w for w in (*plain, *lines) if w not in self.memo]:
            self.memo[word] = self._ids(word if word[0] == "\n" else " " + word).tobytes()
        for word, stem in marked.items():
            if stem in self.memo:
                self.memo[word] = self.memo[stem] + self.marks[word[-1]]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. Different pieces are looked up once for all texts, and the ids put together by arrays."""
        result: list = [None] * len(texts)
        plain = [k for k, t in enumerate(texts) if t and not (self.special is not None and self.special.search(t))]
        start, size = 0, 0
        for stop, k in enumerate(plain, 1):
            size += len(texts[k])
            if size >= TOGETHER or stop == len(plain):
                some, start, size = plain[start:stop], stop, 0
                for at, ids in zip(some, self._by_pieces([texts[at] for at in some])):
                    result[at] = ids
        return [self._ids(t or "") if ids is None else ids for t, ids in zip(texts, result)]

    def _by_pieces(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of the texts whose pieces are all known or learnt; None for others."""
        if len(self.memo) + len(self.firsts) >= MEMO_WORDS:
            self.memo.clear()
            self.firsts.clear()
        lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        coded = lists.flatten().dictionary_encode()
        pieces, places = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        bounds = np.append(lists.offsets.to_numpy()[:-1], len(places))
        known = list(map(self.memo.get, pieces))
        missing = {p for p, ids in zip(pieces, known) if ids is None}
        if missing:
            self._learn(missing)
            known = [self.memo.get(p) if ids is None else ids for p, ids in zip(pieces, known)]
        # A text's first piece has no space before it: entries of their own, behind the others.
        begins, first_of = np.unique(places[bounds[:-1]], return_inverse=True)
        words = [pieces[k] for k in begins.tolist()]
        new = [w for w in words if w.split() == [w] and w not in self.firsts]
        if new:
            for word, code in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                self.firsts[word] = np.array(code.ids, "<u4").tobytes()
        places[bounds[:-1]] = len(pieces) + first_of
        known += map(self.firsts.get, words)
        unknown = np.fromiter((ids is None for ids in known), bool, len(known))
        length = np.fromiter((len(ids) // 4 if ids else 0 for ids in known), np.int64, len(known))
        table = np.frombuffer(b"".join(filter(None, known)), "<u4")
        start = np.cumsum(length) - length
        each = length[places]
        ends = np.cumsum(each)
        ids = table[np.repeat(start[places] - ends + each, each) + np.arange(ends[-1])]
        lost = np.add.reduceat(unknown[places], bounds[:-1], dtype=np.int64) > 0
        cuts = np.append(0, ends)[bounds]
        return [None if gone else ids[a:b] for gone, a, b in zip(lost.tolist(), cuts.tolist(), cuts[1:].tolist())]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordwiseTokenizer:
    return WordwiseTokenizer(path)


def write_token_files(df: DataFrame, path: str, folder: str, key: str = "doc_id", text: str = "text", end_id: int = 0, block: int = BLOCK) -> DataFrame:
    """Encode every text, append ``end_id``, and write token files in ascending order of ``key`` (an integer).

    Returns the table of files: ``part``, ``file``, ``documents``, ``ids`` and ``base``, the number of ids in
    the files before. It is also written to ``folder``/index.
    """
    spark = df.sparkSession

    def written(batches):
        tokenizer = _tokenizer(path)
        bits, part, writer = bits_for(tokenizer.size), TaskContext.get().partitionId(), None
        for batch in slices(batches, ROWS):
            if writer is None:
                writer = TokenFileWriter(Upload(folder, f"part-{part:06d}.ids"), bits, block)
            for key, ids in zip(batch.column(0).to_pylist(), tokenizer.encode(batch.column(1).to_pylist())):
                writer.add(key, np.append(ids, np.uint32(end_id)))
        if writer is not None:
            name = writer.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "documents": len(writer.keys), "ids": writer.ids}], schema)

    schema = pa.schema([("part", pa.int64()), ("file", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("value"))
    ordered = rows.repartitionByRange(parts, F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "value")
    files = shared_table(map_batches(ordered, written, "part bigint, file string, documents bigint, ids bigint"), "token-files")
    # One row for each file, so the window is small however large the texts are.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    files.write.mode("overwrite").parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read_token_files(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Every document of the files: ``key``, ``start`` over all files, ``n_tokens`` and ``ids`` (unsigned 32 bits)."""

    def read(batches):
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source = TokenFile(file)
                bounds = np.append(source.starts, np.uint64(source.ids)).astype(np.int64)
                for first in range(0, source.documents, 256):
                    last = min(first + 256, source.documents)
                    own = bounds[first : last + 1]
                    data = source.read(int(own[0]), int(own[-1] - own[0])).tobytes()
                    cuts = (4 * (own - own[0])).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(source.keys[first:last], pa.int64()),
                            pa.array(own[:-1] + base, pa.int64()),
                            pa.array(np.diff(own), pa.int64()),
                            pa.array([data[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        ],
                        ["key", "start", "n_tokens", "ids"],
                    )

    files = spark.read.parquet(f"{folder}/index")
    count = max(1, files.agg(F.max("part")).first()[0] or 0) + 1
    placed = files.repartitionById(count, F.col("part").cast("int")).select("file", "base")
    return map_batches(placed, read, "key bigint, start bigint, n_tokens bigint, ids binary").withColumnRenamed("key", key)


def token_file_folder(spark: SparkSession) -> str:
    return run_dir(spark, "token-files")
