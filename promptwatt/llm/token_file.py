"""Token-ID output (operator 7): Arrow files of equal-length sequences and masks.

Documents are dealt to shards by ranges of doc_id and sorted within them; a task
encodes its documents, appends END_ID to each and writes one shard: an Arrow file
(a stream of record batches with a footer) whose batches all hold BATCH_ROWS
sequences, the last one fewer. Columns: `ids`, a fixed-size list of SEQUENCE
unsigned integers (16 bits if the vocabulary allows, else 32), and `mask`, a
fixed-size list of bits that are off after the end of the shard's ids. Batches
are uncompressed, so a reader maps the file and gets row r as views of batch
r // BATCH_ROWS without copying. A second Arrow file holds doc_id, start (within
the shard) and n_tokens of its documents. Files are written under a name of the
attempt and renamed at the end, so a task that runs twice leaves one whole shard.

Texts are encoded by the tokenizers library. Its byte-level pre-tokenizer never
joins a space to what precedes it, so a text cut before single spaces between
other characters encodes piece by piece; the distinct pieces of a slice of texts are
encoded once, those met before are looked up. Texts with a special token, or with
white space next to a cut, go through the library whole.

Defined results: null texts are empty and become a single end id; repeated rows
are documents of their own, in the order of their texts; null doc_ids come first;
an empty table writes no shard and gives an empty result; a very long text is a
slice of its own; extra columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import fresh_path, slices, stored

SEQUENCE = 2048
BATCH_ROWS = 256
END_ID = 2
#: Bytes of pieces that a worker remembers between slices; it starts afresh when it
#: holds more.
HELD_BYTES = 32 << 20
#: Bytes of texts encoded at a time.
SLICE_BYTES = 6 << 20
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class Encoder:
    """Encodes texts to the bytes of little-endian ids of type `kind`."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = "HI"[self.kind.itemsize // 4]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        mark = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self._forget()

    def _forget(self) -> None:
        """Pieces met so far: their names, ids one after the other, numbers of ids."""
        self.names, self.flat, self.sizes = pa.array([], pa.string()), np.zeros(0, self.kind), np.zeros(0, np.int64)

    def _plain(self, piece: str) -> bool:
        return piece != "" and piece.strip() == piece and not ("<|" in piece and any(s in piece for s in self.special))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, each after a space, one after the other, and their numbers.
        Many pieces go through the library as one text, parted by a newline, whose id
        parts their ids again."""
        texts = [" " + "\n ".join(pieces[k:k + 1000]) + "\n" for k in range(0, len(pieces), 1000)]
        ids = np.frombuffer(b"".join(self._whole(texts)), self.kind) if self.mark is not None else np.zeros(0, self.kind)
        ends = np.flatnonzero(ids == self.mark) if self.mark is not None else ids
        if len(ends) != len(pieces):
            each = self._whole([" " + p for p in pieces])
            return np.frombuffer(b"".join(each), self.kind), np.array([len(x) for x in each], np.int64) // self.kind.itemsize
        return ids[ids != self.mark], np.diff(ends, prepend=-1) - 1

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Encodes pieces not met before and remembers them; gives the place of each,
        -1 if a text with it can't be cut."""
        plain = [k for k, p in enumerate(pieces) if self._plain(p)]
        simple = [k for k in plain if "\n" not in pieces[k]]
        lines = [k for k in plain if "\n" in pieces[k]]
        ids, sizes = self._joined([pieces[k] for k in simple])
        more = self._whole([" " + pieces[k] for k in lines])
        names = pa.array([pieces[k] for k in simple + lines], pa.string())
        sizes = np.concatenate([sizes, np.array([len(x) for x in more], np.int64) // self.kind.itemsize])
        place = np.full(len(pieces), -1)
        place[simple + lines] = len(self.sizes) + np.arange(len(sizes))
        self.names = pa.concat_arrays([self.names, names])
        self.flat = np.concatenate([self.flat, ids, np.frombuffer(b"".join(more), self.kind)])
        self.sizes = np.concatenate([self.sizes, sizes])
        return place

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The words of all texts stay in Arrow; only distinct ones not met before
        become Python objects, and the ids of all words are gathered at once."""
        if self.names.nbytes + self.flat.nbytes + self.sizes.nbytes > HELD_BYTES:
            self._forget()
        cut = pc.split_pattern(texts, " ")
        words, bounds = cut.flatten(), cut.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        first = bounds[:-1]
        heads = words.take(pa.array(first)).to_pylist()
        later = np.ones(len(words), bool)
        later[first] = False
        coded = words.filter(pa.array(later)).dictionary_encode()
        found = pc.index_in(coded.dictionary, value_set=self.names)
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = self._learn(coded.dictionary.filter(found.is_null()).to_pylist())
        place = at[coded.indices.to_numpy()]
        odd_piece = place < 0
        lengths = np.where(odd_piece, 0, self.sizes[place] if len(self.sizes) else 0)
        starts = np.cumsum(self.sizes) - self.sizes
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat((starts[place] if len(starts) else place) - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        pieces = bounds - np.arange(len(bounds))  # the words but for the heads
        upto = np.concatenate([[0], ends])[pieces]
        odd = np.diff(np.concatenate([[0], np.cumsum(odd_piece)])[pieces]) > 0
        odd |= (np.diff(bounds) > 1) & ~np.array([self._plain(h) for h in heads])
        out = self._whole(["" if x else h for h, x in zip(heads, odd.tolist())])
        for k, (a, b) in enumerate(zip(upto[:-1].tolist(), upto[1:].tolist())):
            out[k] += ids[a:b].tobytes()
        some = np.flatnonzero(odd).tolist()
        for k, x in zip(some, self._whole(texts.take(pa.array(some, pa.int64())).to_pylist())):
            out[k] = x
        return out


ENCODERS: dict[int, Encoder] = {}


def encoder(tokenizer_json: str) -> Encoder:
    """The worker's encoder, kept between its tasks."""
    key = hash(tokenizer_json)
    if key not in ENCODERS:
        ENCODERS[key] = Encoder(tokenizer_json)
    return ENCODERS[key]


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":" in uri else (pafs.LocalFileSystem(), uri)


class ShardWriter:
    """Writes ids as batches of full sequences and the index of documents."""

    def __init__(self, fs: pafs.FileSystem, path: str, sequence: int, kind: np.dtype):
        self.fs, self.path, self.sequence, self.kind = fs, path, sequence, kind
        self.temp = f"{path}.{uuid.uuid4().hex}"
        self.sinks = [fs.open_output_stream(f"{self.temp}.{kind}") for kind in ("arrow", "index")]
        kinds = [pa.list_(pa.from_numpy_dtype(kind), sequence), pa.list_(pa.bool_(), sequence)]
        self.schema = pa.schema(list(zip(("ids", "mask"), kinds)))
        self.files = [pa.ipc.new_file(s, x) for s, x in zip(self.sinks, (self.schema, INDEX))]
        self.ids, self.held, self.n, self.docs = [], 0, 0, 0

    def add(self, doc_ids: list, encoded: list[bytes]) -> None:
        sizes = np.array([len(x) // self.kind.itemsize + 1 for x in encoded], np.int64)
        ends = np.cumsum(sizes)
        end = np.array([END_ID], self.kind).tobytes()
        self.ids.append(np.frombuffer(end.join([*encoded, b""]), self.kind))
        self.files[1].write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(self.n + ends - sizes), pa.array(sizes)], schema=INDEX))
        self.n += int(ends[-1])
        self.held += int(ends[-1])
        self.docs += len(doc_ids)
        if self.held >= BATCH_ROWS * self.sequence:
            self._write()

    def _write(self, last: bool = False) -> None:
        """Writes full batches; the rest stays unless it is the last."""
        ids, at, size = np.concatenate(self.ids), 0, BATCH_ROWS * self.sequence
        while len(ids) - at >= size or last and at < len(ids):
            part = ids[at:at + size]
            pad = -len(part) % self.sequence
            mask = np.arange(len(part) + pad) < len(part)
            cols = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (np.append(part, np.zeros(pad, self.kind)) if pad else part, mask)]
            self.files[0].write_batch(pa.record_batch(cols, schema=self.schema))
            at += len(part)
        self.ids, self.held = [ids[at:]], len(ids) - at

    def close(self) -> None:
        if self.held:
            self._write(last=True)
        for f in (*self.files, *self.sinks):
            f.close()
        for kind in ("arrow", "index"):
            self.fs.move(f"{self.temp}.{kind}", f"{self.path}.{kind}")


def write_token_files(docs: DataFrame, folder: str, tokenizer_json: str, sequence: int = SEQUENCE) -> DataFrame:
    """Writes docs (doc_id, text) in ascending doc_id order as shards of folder;
    returns the manifest: shard, n_tokens, n_docs."""
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, shard = None, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                fs, path = filesystem(folder)
                writer = ShardWriter(fs, f"{path}/shard-{shard:06d}", sequence, encoder(model.value).kind)
            ids, texts = batch.column("doc_id").to_pylist(), pc.fill_null(batch.column("text"), "")
            for i, j in slices(np.cumsum(pc.binary_length(texts).to_numpy()), 0, SLICE_BYTES):
                writer.add(ids[i:j], encoder(model.value).encode(texts.slice(i, j - i)))
        if writer is not None:
            writer.close()
            yield pa.record_batch({"shard": [shard], "n_tokens": [writer.n], "n_docs": [writer.docs]})

    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(rows.mapInArrow(run, "shard long, n_tokens long, n_docs long"), "token-manifest")


class SequenceFile:
    """Random access to the sequences of one shard, as views of the mapped file."""

    def __init__(self, path: str):
        fs, local = filesystem(f"{path}.arrow")
        self.source = pa.memory_map(local) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(local)
        self.file = pa.ipc.open_file(self.source)

        self.size = self.file.schema.field("ids").type.list_size

    def column(self, batch: int, name: str) -> pa.Array:
        """All values of a batch, flat."""
        col = self.file.get_batch(batch).column(name)
        return col.values.slice(col.offset * self.size, len(col) * self.size)

    def __getitem__(self, row: int) -> tuple[np.ndarray, pa.BooleanArray]:
        ids, mask = (self.column(row // BATCH_ROWS, c).slice(row % BATCH_ROWS * self.size, self.size) for c in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask


def read_index(path: str) -> pa.Table:
    fs, local = filesystem(f"{path}.index")
    with fs.open_input_file(local) as f:
        return pa.ipc.open_file(f).read_all()


def shard_documents(path: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """doc_id, start within the shard and ids of each document of a shard; a
    batch of sequences is mapped at a time."""
    file, index = SequenceFile(path), read_index(path)
    size = BATCH_ROWS * file.size
    at, ids = -1, None
    for doc_id, start, n in zip(*(index[c].to_pylist() for c in ("doc_id", "start", "n_tokens"))):
        parts, k = [], start
        while k < start + n:
            if k // size != at:
                at, ids = k // size, file.column(k // size, "ids").to_numpy(zero_copy_only=True)
            parts.append(ids[k - at * size:start + n - at * size])
            k += len(parts[-1])
        yield doc_id, start, parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and shard
    of each document, from the files."""
    spark, at, rows = manifest.sparkSession, 0, []
    for r in manifest.orderBy("shard").collect():  # a row for each file
        rows.append((r.shard, at))
        at += r.n_tokens
    shards = spark.createDataFrame(rows, "shard long, before long").repartition(max(1, len(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "shard"]
        for batch in batches:
            for shard, before in zip(batch.column("shard").to_pylist(), batch.column("before").to_pylist()):
                out = [(d, before + start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4"))) for d, start, ids in shard_documents(f"{folder}/shard-{shard:06d}")]
                yield pa.record_batch([*(pa.array(c, pa.int64()) for c in zip(*out)), pa.array([shard] * len(out), pa.int64())], names)

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long")


def token_files(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE) -> DataFrame:
    """Writes docs to a fresh folder beside the checkpoints and reads it back."""
    folder = fresh_path(docs.sparkSession, "token-files")
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    return read_token_files(write_token_files(docs, folder, model, sequence), folder)
