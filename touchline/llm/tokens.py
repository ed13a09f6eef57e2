"""Token ids of whole texts by a public tokenizer, and flat files of them.

The encoder gives exactly what the tokenizer gives for the whole text. Both tokenizers
used here cut a text before a single blank or line end between two other characters,
whatever stands around it, so such pieces are encoded once and remembered; a text with
runs of white space is given to the tokenizer whole. The memory of pieces is bounded.

The file format: shards of unsigned integers (``.ids``, little-endian, as narrow as the
vocabulary allows) in ascending document order, each with its 64-bit document offsets
(``.idx``, counted over all shards, one more than documents) and document ids
(``.doc``, with ``.null`` marking null ids). Shards are read by memory map where the
folder is a local one. A shard's base is the prefix sum of the sizes before it.
A task writes its shard under a name of its own and reports it when complete; a task that
is lost leaves an unlisted file, so running tasks again is safe.

Null texts count as empty, an empty text is the end id alone; null ids come first; rows
with the same id are documents of their own, in an order by a hash of the text; an empty
table gives no rows and no shards.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from touchline.llm.text import bytes_of, runs, whole_text
from touchline.session import fresh_dir

REMEMBERED = 400_000  # pieces that a worker keeps between its tasks, and as many of those used before them


def _plain(piece: str) -> bool:
    """Whether a piece, but for a line break it may begin with, is one word without white space."""
    word = piece[1:] if piece[:1] == "\n" else piece
    return word.split() == [word]


def _odd(pieces: list[str]) -> set[str]:
    """Those of the pieces that are not plain; as a rule there are none."""
    line = (" " + " ".join(pieces)).replace(" \n", " ")[1:]
    words = line.split()
    if len(words) == len(pieces) and " ".join(words) == line:
        return set()
    return {p for p in pieces if not _plain(p)}


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _packed(ids: list[int] | np.ndarray) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


class Encoder:
    """Whole texts to little-endian unsigned 32-bit ids, followed by an end id."""

    def __init__(self, path: str, end: int):
        self.tokenizer = _tokenizer(path)
        self.end = _packed([end])
        self.known: dict[str, bytes] = {}  # a piece as it stands after a blank, or with its line break
        self.older: dict[str, bytes] = {}  # the pieces known before those; one that is used again is known again
        self.first: dict[str, bytes] = {}  # a piece as it stands at the beginning
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of text behind an id
        for token, i in vocabulary.items():
            self.size[i] = len(token.removesuffix("</w>"))
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.size[i] = len(token.content.encode())

    def _whole(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_packed(e.ids) for e in made]

    def _learn(self, words: list[str]) -> None:
        """Encode new pieces as one text and part its ids by the bytes they stand for."""
        pieces = [w if w[0] == "\n" else " " + w for w in words]
        joined = "".join(pieces)
        if self.tokenizer.normalizer:  # here white space is dropped
            plain = self.tokenizer.normalizer.normalize_str(joined).split(" ")[1:]
        else:
            plain = pieces
        ids = np.asarray(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        reached = np.cumsum(self.size[ids])
        ends = np.cumsum([len(x.encode()) for x in plain])
        cuts = np.searchsorted(reached, ends) + 1
        if len(plain) == len(pieces) and cuts[-1] == len(ids) and (reached[cuts - 1] == ends).all():
            raw, cuts = ids.tobytes(), (cuts * 4).tolist()
            self.known.update((p, raw[i:j]) for p, i, j in zip(words, [0, *cuts], cuts))
        else:
            self.known.update(zip(words, self._whole(pieces)))

    def _unknown(self, parts: list[list[str]]) -> set[str]:
        """The pieces, but the texts' first ones, that are not known."""
        new = set().union(*(p[1:] for p in parts)).difference(self.known)
        again = new.intersection(self.older)
        self.known.update((p, self.older[p]) for p in again)
        return new - again

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Texts of words parted by one blank or line break each are put
        together from pieces encoded once; all others are encoded whole."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        if len(self.first) > REMEMBERED:
            self.first.clear()
        parts = [text.replace("\n", " \n").split(" ") for text in texts]
        new = self._unknown(parts)
        odd = _odd(list(new))
        if odd:
            joined = [i for i, p in enumerate(parts) if _plain(p[0]) and odd.isdisjoint(p[1:])]
            new = self._unknown([parts[i] for i in joined])
        else:
            joined = [i for i, p in enumerate(parts) if p[0] in self.first or _plain(p[0])]
        if new:
            self._learn(list(new))
        begin = list({parts[i][0] for i in joined}.difference(self.first))
        there = set(joined)
        whole = [i for i in range(len(texts)) if i not in there]
        if begin or whole:
            made = self._whole([*begin, *(texts[i] for i in whole)])
            self.first.update(zip(begin, made))
        out: list[bytes] = [b""] * len(texts)
        for i, raw in zip(whole, made[len(begin) :] if whole else ()):
            out[i] = raw + self.end
        of = self.known.__getitem__
        for i in joined:
            words = parts[i]
            out[i] = b"".join([self.first[words[0]], *map(of, words[1:]), self.end])
        return out


@lru_cache(maxsize=2)
def encoder(path: str, end: int) -> Encoder:
    """The encoder of this process: tasks that a worker runs one after another share its pieces."""
    return Encoder(path, end)


def vocabulary_size(path: str) -> int:
    return _tokenizer(path).get_vocab_size(with_added_tokens=True)


def texts(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[tuple[int, list[str]]]:
    """The texts of a batch, a bounded number of bytes at a time, with their first row."""
    _, at = bytes_of(batch.column(column))
    for first, last in runs(at, most):
        yield first, batch.column(column).slice(first, last - first).to_pylist()


def open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder, local or remote."""
    return arrow_fs.FileSystem.from_uri(uri) if urlparse(uri).scheme else (arrow_fs.LocalFileSystem(), uri)


def read_flat(folder: str, name: str, dtype: str) -> np.ndarray:
    """A flat file as an array, memory-mapped if the folder is local."""
    files, path = open_folder(folder)
    if isinstance(files, arrow_fs.LocalFileSystem):
        empty = os.path.getsize(f"{path}/{name}") == 0
        return np.zeros(0, dtype) if empty else np.memmap(f"{path}/{name}", dtype, "r")
    with files.open_input_stream(f"{path}/{name}") as f:
        return np.frombuffer(f.read(), dtype)


def _shard_writer(folder: str, tokenizer: str, end: int, width: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        encode, name = encoder(tokenizer, end), uuid.uuid4().hex
        lengths, ids, first = [], [], None
        with files.open_output_stream(f"{path}/{name}.ids") as out:
            for batch in batches:
                if first is None and batch.num_rows:
                    first = batch.column(2)[0].as_py()
                ids.append(batch.column(0))
                for _, some in texts(batch, 1):
                    for raw in encode.many(some):
                        made = np.frombuffer(raw, "<u4")
                        lengths.append(len(made))
                        out.write(made.astype(width).tobytes())
        if not lengths:
            files.delete_file(f"{path}/{name}.ids")
            return
        with files.open_output_stream(f"{path}/{name}.len") as out:
            out.write(np.array(lengths, "<i8").tobytes())
        doc = pa.chunked_array(ids)
        with files.open_output_stream(f"{path}/{name}.doc") as out:
            out.write(doc.fill_null(0).to_numpy().astype("<i8").tobytes())
        with files.open_output_stream(f"{path}/{name}.null") as out:
            out.write(doc.is_null().to_numpy().astype("u1").tobytes())
        row = [[first], [name], [len(lengths)], [sum(lengths)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            ["part", "name", "documents", "ids"],
        )

    return write


def _index_writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        for batch in batches:
            for name, base in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist()):
                sizes = read_flat(folder, f"{name}.len", "<i8")
                offsets = np.concatenate(([base], base + np.cumsum(sizes)))
                with files.open_output_stream(f"{path}/{name}.idx") as out:
                    out.write(offsets.astype("<i8").tobytes())
            yield batch

    return write


def _dealt(shards: DataFrame) -> DataFrame:
    """Rows that each stand for a file, over many tasks. A given number is not merged for being small."""
    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(n, "part")


MANIFEST = "part int, name string, documents long, ids long"


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the shards of ``docs`` into a shared folder; return their manifest.

    One row per shard in document order: part, name, documents, ids, base (ids before it).
    """
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)
    width = "<u2" if max(vocabulary_size(tokenizer), end + 1) <= 1 << 16 else "<u4"
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), whole_text(text).alias("text"))
    # The hash of the text spreads rows that share one id over several parts.
    ranged = rows.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ranged.sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ordered.withColumn("part", F.spark_partition_id())
    shards = ordered.mapInArrow(_shard_writer(folder, tokenizer, end, width), MANIFEST)
    shards.write.parquet(f"{folder}/manifest")
    shards = docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row per shard: the prefix sum is over the parts, not the documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    based = _dealt(based.withColumn("width", F.lit(width)))
    based.mapInArrow(_index_writer(folder), based.schema).write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(based.schema).parquet(f"{folder}/index")


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, width in zip(batch.column("name").to_pylist(), batch.column("width").to_pylist()):
                ids = read_flat(folder, f"{name}.ids", width)
                at = read_flat(folder, f"{name}.idx", "<i8")
                doc = read_flat(folder, f"{name}.doc", "<i8")
                null = read_flat(folder, f"{name}.null", "u1") > 0
                crc = [
                    zlib.crc32(ids[at[i] - at[0] : at[i + 1] - at[0]].astype("<u4").tobytes())
                    for i in range(len(doc))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(doc), pa.int64(), mask=null),
                        pa.array(at[:-1]),
                        pa.array(np.diff(at)),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return read


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document of the shards: doc_id, start, n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return _dealt(manifest).mapInArrow(_reader(folder), schema)


def token_folder(spark: SparkSession) -> str:
    return fresh_dir(spark, "tokens")
