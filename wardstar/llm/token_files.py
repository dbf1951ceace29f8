"""Token ids as flat unsigned integer files with 64-bit document offsets.

A run folder holds, per range partition of the document id and, for equal ids,
of the first 256 characters of the text and then of the row's place:

* ``part-NNNNN.ids``   the ids of its documents one after another, unsigned
  little-endian, 16 bits if the vocabulary fits, else 32;
* ``part-NNNNN.off``   n + 1 unsigned 64-bit offsets into that file, in ids;
* ``part-NNNNN.docs``  the document ids as an Arrow IPC file (any type, null
  allowed);

and ``manifest``, a Parquet table with one row per part. Parts are ascending
in the document id, so the start of a part in the whole corpus is the prefix
sum of the counts before it.

Files are written under a temporary name and renamed, and their names depend
only on the partition, so a repeated or speculative task replaces a file by an
equal one. Reading maps files of a mounted file system into memory; files of
other stores are read through ``pyarrow.fs``.

Defined cases: a null text is empty, a document without ids still gets its end
id; documents with equal ids are ordered by the first 256 characters of their
text and, inside a part, by all of it; null document ids come first; texts may be
of any length; an empty table gives an empty manifest. Only the id and the text are
stored, other columns are not read.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.session import scratch_path

from .common import bound_batches, quoted, slices
from .pieces import PieceTable

# A worker forgets its encoded pieces beyond this many.
CACHE_PIECES = 500_000
# Characters of text cut into pieces at a time.
SLICE_CHARS = 3 << 20
# Pieces given to the library as one text.
JOINED = 2_000
# Characters of the text by which equal ids are ranged.
RANGE_CHARS = 256
# White space other than blanks and line ends; runs of those two.
OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
RUNS = ("  ", " \n", "\n ", "\n\n")
_ENCODERS: dict[tuple, "ChunkEncoder"] = {}


class ChunkEncoder:
    """Byte-level BPE ids of whole texts by the tokenizers library.

    A pre-token never reaches over the step from a non-space to a space, nor
    from a letter to a comma or full stop. Texts are cut before single blanks
    and line ends, and equal pieces are encoded once: a piece without its last
    comma or full stop is looked up again, and only new words go to the
    library, many as one text; its ids are dealt back by their byte lengths. A
    text with a special token's string or with other white space is given to
    the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level tokenizer without a normalizer is expected")
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.specials = [a["content"] for a in spec.get("added_tokens", [])]
        top = max([*spec["model"]["vocab"].values(), *(a["id"] for a in spec["added_tokens"])])
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        # a byte-level token has one character per byte
        self.n_bytes = np.zeros(top + 1, np.int64)
        for token, i in spec["model"]["vocab"].items():
            self.n_bytes[i] = len(token)
        self.marks = {m: self._ids([m])[0] for m in ",."}
        self.words = PieceTable(self._learn_words, self.dtype, CACHE_PIECES)
        self.table = PieceTable(self._learn, self.dtype, CACHE_PIECES)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new pieces: those of the word, then of a mark after a letter."""
        if len(self.words) > self.words.limit:
            self.words.clear()
        marks = [self.marks.get(p[-1], ()) if p[-2:-1].isalpha() else () for p in pieces]
        ids, sizes = self.words.lookup([p[:-1] if m else p for p, m in zip(pieces, marks)], len(pieces))
        extra = np.fromiter(map(len, marks), np.int64, len(marks))
        ends = np.repeat(np.cumsum(sizes), extra)
        flat = np.insert(ids, ends, [i for m in marks for i in m])
        return flat, sizes + extra

    def _learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words begin with a line end or get the blank they stand after, so
        that put side by side they don't touch."""
        flat, sizes = [], []
        for lo in range(0, len(words), JOINED):
            part = [w if w[0] == "\n" else " " + w for w in words[lo:lo + JOINED]]
            ids = np.asarray(self._ids(["".join(part)])[0], np.int64)
            ends = np.searchsorted(np.cumsum(self.n_bytes[ids]),
                                   np.cumsum([len(w.encode("utf-8")) for w in part]), "right")
            flat.append(ids)
            sizes.append(np.diff(ends, prepend=0))
        return np.concatenate(flat), np.concatenate(sizes)

    def _pieces(self, text: str) -> list[str] | None:
        """The pieces of a text, or None if it must be encoded whole. A piece is
        a word after a blank, without it, or a word with the line end before
        it. A text's first word, which has neither, is one after a line end;
        ``encode`` takes that line end off again."""
        if text[0] in " \n" or text[-1] in " \n" or OTHER_SPACE(text) or any(
                x in text for x in RUNS) or any(x in text for x in self.specials):
            return None
        return ("\n" + text).replace("\n", " \n").split(" ")[1:]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut = [self._pieces(t) if t else [] for t in texts]
        whole = iter(self._ids([t for t, p in zip(texts, cut) if p is None]))
        found = self.table.encode([p or [] for p in cut])
        return [np.asarray(next(whole), self.dtype) if p is None else f[1:]
                for p, f in zip(cut, found)]


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this worker, kept between its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def _map(fs: pafs.FileSystem, path: str) -> pa.NativeFile:
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.memory_map(path)
    return fs.open_input_file(path)


MANIFEST = T.StructType([
    T.StructField("part", T.IntegerType(), False), T.StructField("path", T.StringType(), False),
    T.StructField("id_bits", T.IntegerType(), False),
    T.StructField("n_docs", T.LongType(), False), T.StructField("n_tokens", T.LongType(), False)])


def write_token_files(df: DataFrame, tokenizer: str, end_id: int | None = 0,
                      id_col: str = "doc_id", text_col: str = "text",
                      folder: str | None = None) -> str:
    """Encode every text, write the files, return the run folder.

    ``folder`` must be shared by the executors; by default a new one below
    ``spark.checkpoint.dir``. ``tokenizer`` is a file that every machine has.
    """
    spark = df.sparkSession
    folder = (folder or scratch_path(spark, "token-files")).rstrip("/")
    src = df.select(F.col(quoted(id_col)).alias("id"),
                    F.col(quoted(text_col)).cast("string").alias("text"))
    bound_batches(spark)
    # by the text too, so that a repeated id spreads over parts; a prefix has the
    # same order and bounds what the sample of the ranges takes to the driver. Rows
    # that are equal in both spread by their place, a number of its own for each
    ranged = src.withColumn("place", F.monotonically_increasing_id()) \
        .repartitionByRange("id", F.substring("text", 1, RANGE_CHARS), "place") \
        .sortWithinPartitions("id", "text").select("id", "text")

    def write(batches):
        from pyspark import TaskContext
        enc = encoder(tokenizer)
        end = b"" if end_id is None else np.asarray([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        part = TaskContext.get().partitionId()
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        final = posixpath.join(base, f"part-{part:05d}")
        temp = f"{final}.{uuid.uuid4().hex}.tmp"
        lengths, docs = [], []
        ids_out = None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            docs.append(batch.column(0))
            for lo, hi in slices(texts, SLICE_CHARS):
                if ids_out is None:
                    ids_out = fs.open_output_stream(temp + ".ids")
                for raw in enc.encode(texts[lo:hi]):
                    ids_out.write(raw.tobytes())
                    ids_out.write(end)
                    lengths.append(len(raw) + len(end) // width)
        if ids_out is None:
            return
        ids_out.close()
        offsets = np.zeros(len(lengths) + 1, "<u8")
        np.cumsum(lengths, out=offsets[1:])
        with fs.open_output_stream(temp + ".off") as f:
            f.write(offsets.tobytes())
        with fs.open_output_stream(temp + ".docs") as f, \
                pa.ipc.new_file(f, pa.schema([("id", docs[0].type)])) as w:
            for d in docs:
                w.write_batch(pa.RecordBatch.from_arrays([d], names=["id"]))
        for kind in (".ids", ".off", ".docs"):
            fs.move(temp + kind, final + kind)
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "path": f"{folder}/part-{part:05d}", "id_bits": 8 * width,
              "n_docs": len(lengths), "n_tokens": int(offsets[-1])}],
            schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("id_bits", pa.int32()),
                              ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    ranged.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return folder


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part with ``base``, the ids of all parts before it. The
    window runs over one small row per part, not over documents."""
    m = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return m.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, id_type: T.DataType = T.LongType(),
                     with_ids: bool = True) -> DataFrame:
    """Documents read back: doc_id, start, n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers) and, if asked for, ids."""
    manifest = read_manifest(spark, folder)
    n_parts = max(1, spark.read.parquet(f"{folder}/manifest").count())
    out = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("start", T.LongType(), False),
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("ids_crc32", T.LongType(), False)]
        + ([T.StructField("ids", T.ArrayType(T.LongType(), False))] if with_ids else []))

    def read(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(out)
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = file_system(row["path"])
                with _map(fs, path + ".ids") as f_ids, _map(fs, path + ".off") as f_off, \
                        _map(fs, path + ".docs") as f_docs:
                    off = np.frombuffer(f_off.read_buffer(), "<u8").astype(np.int64)
                    ids = np.frombuffer(f_ids.read_buffer(), f"<u{row['id_bits'] // 8}")
                    docs, at = pa.ipc.open_file(f_docs), 0
                    for i in range(docs.num_record_batches):
                        ids_of = docs.get_batch(i).column(0)
                        o = off[at:at + len(ids_of) + 1]
                        for lo, hi in _even(o):
                            cut = [ids[o[k]:o[k + 1]] for k in range(lo, hi)]
                            cols = [ids_of.slice(lo, hi - lo).cast(schema.field(0).type),
                                    pa.array(row["base"] + o[lo:hi]), pa.array(np.diff(o[lo:hi + 1])),
                                    pa.array([zlib.crc32(c.astype("<u4").tobytes()) for c in cut],
                                             pa.int64())]
                            if with_ids:
                                cols.append(pa.array([c.astype(np.int64) for c in cut],
                                                     schema.field(4).type))
                            yield pa.RecordBatch.from_arrays(cols, schema=schema)
                        at += len(ids_of)
    return manifest.repartitionByRange(n_parts, "part").mapInArrow(read, out)


def _even(offsets: np.ndarray, limit: int = 1 << 21):
    """Row ranges of about ``limit`` ids."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit)))
        hi = min(hi, len(offsets) - 1)
        yield lo, hi
        lo = hi
