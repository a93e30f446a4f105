"""Token-ID files (operator 4): independent zstandard frames with a seek table.

One task writes one file of consecutive documents::

    token frame*  index frame  seek table

A token frame holds the ids of whole documents (unsigned 32-bit, little-endian)
up to about ``frame_tokens``; a longer document has a frame of its own.  The
index frame holds three int64 columns, one entry per document: id, number of
ids, and the frame that holds them.  The seek table is the trailing skippable
frame of the zstandard seekable format: compressed size, plain size and the low
32 bits of XXH64 (seed 0) of the plain bytes for every frame, then the frame
count, a descriptor with the checksum flag, and the magic number.  A reader
fetches the table, then the index, then only the frames it needs, and checks
each frame it decompresses.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, file_bytes, shared_dir, store, text_or_empty

# Fixed values of the zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

#: Runs and odd words kept by a worker, twice at most.
MEMO_ENTRIES = 300_000
RUNS_AT_ONCE = 2048
CHARS_AT_ONCE = 1 << 20
#: Pieces that equal rows may be spread over.
SPREAD = 1024


class FrameWriter:
    """Frames into a byte sink, the seek table at ``close``."""

    def __init__(self, sink, level: int = 3):
        self.sink, self.entries = sink, []
        self.pack = zstandard.ZstdCompressor(level=level, write_content_size=True)

    def add(self, plain: bytes) -> int:
        data = self.pack.compress(plain)
        self.sink.write(data)
        self.entries.append((len(data), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        return len(self.entries) - 1

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *e) for e in self.entries)
        tail = struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body) + len(tail)) + body + tail)


class FrameReader:
    """Random access to the frames of a seekable file object."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a seekable zstandard file with checksums")
        source.seek(size - 9 - 12 * count)
        table = np.frombuffer(source.read(12 * count), "<u4").reshape(count, 3).astype(np.int64)
        self.sizes, self.plain, self.sums = table.T
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.unpack = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.sizes)

    def frame(self, k: int) -> bytes:
        self.source.seek(int(self.starts[k]))
        plain = self.unpack.decompress(self.source.read(int(self.sizes[k])), max_output_size=int(self.plain[k]) or 1)
        if len(plain) != self.plain[k] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return plain

    def index(self) -> np.ndarray:
        """Rows id, number of ids, frame."""
        return np.frombuffer(self.frame(len(self) - 1), "<i8").reshape(3, -1).T

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int, int, bytes]]:
        """(document id, number of ids, ids) of the wanted documents, in file
        order; frames without one are not read."""
        for k, group in itertools.groupby(self.index().tolist(), key=lambda r: r[2]):
            group, plain, at = list(group), None, 0
            for doc, n, _ in group:
                if wanted is None or doc in wanted:
                    plain = self.frame(k) if plain is None else plain
                    yield doc, n, plain[4 * at:4 * (at + n)]
                at += n


class WordEncoder:
    """The tokenizers library with a bounded memo of runs.

    The vocabulary's pre-tokenizer never joins across white space and cuts a
    word of plain characters into runs of letters, single digits and runs of
    signs, so the ids of plain words are those of their runs in a row.  Words
    with any other character, an apostrophe or the string of a special token
    are given to the library as they are.  New runs go to the library many at a
    time, joined by spaces; the word ends among the ids cut the result.
    """

    # where no odd word is left, a byte from 0x80 on belongs to a small accented letter
    RUN = re.compile(rb"[a-z\x80-\xff]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
    SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_buffer(data)
        suffix = self.lib.model.end_of_word_suffix
        vocab = self.lib.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            for t, i in vocab.items():
                self.ends[i] = t.endswith(suffix)
        special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        if any(c.isspace() for t in special for c in t):
            raise ValueError("a special token with white space would join words")
        # the first byte of a character that is not plain, or a special token, with the rest of its word
        first = b"".join({t.lower().encode()[:1] for t in special})
        tails = [rb"(?<=%s)%s" % (re.escape(t[:1]), re.escape(t[1:])) for t in (x.lower().encode() for x in special)]
        self.odd = re.compile(rb"['\x00-\x1f\x7f\xc2-\xff" + re.escape(first) + rb"](?:" + b"|".join(
            [rb"(?<=['\x00-\x1f\x7f\xc2\xc4-\xff])", rb"(?<=\xc3)(?![\xa0-\xb6\xb8-\xbf])", *tails]) + rb")[^ ]*")
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, runs: list[bytes], odd: list[bytes]) -> None:
        for lo in range(0, len(runs), RUNS_AT_ONCE):
            part = runs[lo:lo + RUNS_AT_ONCE]
            raw = self._whole([b" ".join(part).decode()])[0]
            stops = (4 * np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 4).tolist()
            if len(stops) == len(part):
                self.memo.update(zip(part, [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)], strict=True))
            else:  # not one word end each: ask for each alone
                odd = odd + part
        self.memo.update(zip(odd, self._whole([w.decode("utf-8", "surrogatepass") for w in odd]), strict=True))

    def _cut(self, text: bytes, odd: set[bytes]) -> list[bytes]:
        """Plain runs and odd words in order; the odd words also go to ``odd``."""
        flat = text.translate(self.SPACES).lower()
        out, at = [], 0
        for m in self.odd.finditer(flat):
            start = flat.rfind(b" ", at, m.start()) + 1 or at
            out += self.RUN.findall(flat, at, start)
            out.append(text[start:m.end()])
            odd.add(out[-1])
            at = m.end()
        return out + self.RUN.findall(flat, at) if out else self.RUN.findall(flat)

    def encode(self, texts: Iterable[str], end: bytes) -> Iterator[bytes]:
        """Ids of each text with the end id, about ``CHARS_AT_ONCE`` characters at a time."""
        group: list[str] = []
        chars = 0
        for t in texts:
            if group and chars + len(t) > CHARS_AT_ONCE:
                yield from self._encode_group(group, end)
                group, chars = [], 0
            group.append(t)
            chars += len(t)
        yield from self._encode_group(group, end)

    def _encode_group(self, texts: list[str], end: bytes) -> list[bytes]:
        if len(self.memo) > MEMO_ENTRIES:  # what is not met again while the next one fills is forgotten
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        odd: set[bytes] = set()
        cut = [self._cut(t.encode("utf-8", "surrogatepass"), odd) for t in texts]
        new = set().union(*cut).difference(memo)
        known = [r for r in new if r in older]
        memo.update(zip(known, [older[r] for r in known], strict=True))
        new.difference_update(known)
        self._learn(list(new - odd), list(new & odd))
        get = memo.__getitem__
        return [b"".join(map(get, c)) + end for c in cut]


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(key: int, data) -> WordEncoder:
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(data.value)
    return _ENCODERS[key]


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder that executors share."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


MANIFEST = pa.schema([("file", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()),
                      ("n_tokens", pa.int64()), ("order_key", pa.int32())])


def write_token_files(docs: DataFrame, tokenizer_file: str, folder: str | None = None, end_id: int = 2,
                      id_col: str = "doc_id", text_col: str = "text", frame_tokens: int = 1 << 16) -> DataFrame:
    """Encode the documents, write the files and return their manifest
    (file, n_docs, n_tokens, start): ``start`` counts the ids before the file.

    Documents are range-partitioned and sorted by id (NULL ids first, written
    as the smallest int64) and, under one id, by a hash of the text, so reruns
    agree; equal rows are spread by their place in the input, so an id or a row
    that holds a third of the table goes to several files.  NULL and empty texts
    give the end id alone; texts of any length are encoded whole; repeated rows
    stay repeated; columns other than the two named are not read.  Strings of
    special tokens in a text get their ids, as the library gives them.  Each
    task writes a file under a name of its own and reports it; a task that is
    run again writes another file, and only reported files are ever read.  An
    empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    data = spark.sparkContext.broadcast(file_bytes(tokenizer_file))
    key, folder = hash(tokenizer_file), folder or shared_dir(spark, "token-files")
    low = -(1 << 63)
    end = int(end_id).to_bytes(4, "little")
    ordered = (docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(low)).alias("id"),
                           text_or_empty(text_col).alias("text"))
               .withColumns({"mark": F.xxhash64("text"), "place": F.monotonically_increasing_id() % SPREAD})
               .repartitionByRange("id", "mark", "place").sortWithinPartitions("id", "mark", "place", "text").drop("mark", "place")
               .withColumn("part", F.spark_partition_id()))

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = out = name = first = None
        rows: list[tuple[int, int, int]] = []
        held: list[bytes] = []
        held_n = total = part_no = 0

        def flush() -> None:
            nonlocal held, held_n
            if held:
                out.add(b"".join(held))
                held, held_n = [], 0

        for b in parts:
            if b.num_rows == 0:
                continue
            if out is None:
                fs, root = open_store(folder)
                fs.create_dir(root, recursive=True)
                part_no = b.column("part")[0].as_py()
                name = f"tokens-{part_no:06d}-{uuid.uuid4().hex}.zst"
                sink = fs.open_output_stream(f"{root}/{name}", compression=None)
                out = FrameWriter(sink)
                first = b.column("id")[0].as_py()
            for doc, ids in zip(b.column("id").to_pylist(),
                                _encoder(key, data).encode(b.column("text").to_pylist(), end), strict=True):
                n = len(ids) // 4
                if held_n and held_n + n > frame_tokens:
                    flush()
                rows.append((doc, n, len(out.entries)))
                held.append(ids)
                held_n += n
                total += n
        if out is not None:
            flush()
            out.add(np.array(rows, "<i8").T.tobytes())
            out.close()
            sink.close()
            yield from batches(MANIFEST, iter([(name, first, len(rows), total, part_no)]))

    files = store(ordered.mapInArrow(write, "file string, first_id long, n_docs long, n_tokens long, order_key int"),
                  "token-manifest")
    # one row per file, so the files of the whole corpus can be put in one order
    before = Window.orderBy("first_id", "order_key").rowsBetween(Window.unboundedPreceding, -1)
    return files.select(F.concat(F.lit(folder.rstrip("/") + "/"), "file").alias("file"), "n_docs", "n_tokens",
                        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))


DOCUMENT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read_token_files(manifest: DataFrame, wanted: set[int] | None = None, digest: bool = False) -> DataFrame:
    """The documents of the files: doc_id (NULL for the smallest int64), start
    (ids of all documents before it), n_tokens, and ``ids`` (little-endian
    unsigned 32-bit), or their crc32 as ``ids_crc32`` with ``digest``.

    One file is read by one task, frame by frame, and every frame read is held
    against its checksum; ``wanted`` reads only the frames of these documents
    (an id that occurs often gives all its documents).  A document of any length
    is one frame and one row; columns of the manifest other than file and start
    are not read; an empty manifest gives an empty result.
    """
    low = -(1 << 63)
    schema = pa.schema([*list(DOCUMENT)[:3], ("ids_crc32", pa.int64())]) if digest else DOCUMENT
    last = "ids_crc32 long" if digest else "ids binary"

    def load(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in parts:
                for path, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), strict=True):
                    fs, at = open_store(path)
                    with fs.open_input_file(at) as source:
                        reader = FrameReader(source, source.size())
                        sizes = reader.index()
                        starts = dict(zip(range(len(sizes)), (np.cumsum(sizes[:, 1]) - sizes[:, 1] + start).tolist(),
                                          strict=True))
                        order = (k for k, r in enumerate(sizes[:, 0].tolist()) if wanted is None or r in wanted)
                        for k, (doc, n, ids) in zip(order, reader.documents(wanted), strict=True):
                            yield (None if doc == low else doc, starts[k], n, zlib.crc32(ids) if digest else ids)
        yield from batches(schema, rows(), 2048)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return manifest.select("file", "start").repartition(n, "file").mapInArrow(
        load, f"doc_id long, start long, n_tokens long, {last}")
