"""Token-id files: one zstandard frame per document, a document index and a trailing seek table.

File layout (public zstandard seekable format): independent frames with content checksums, each
a document's ids as little-endian unsigned 32-bit integers; then a skippable frame with the document ids; then
the seek table, a skippable frame with each frame's compressed size, size and checksum (low 32 bits of xxh64).
A reader fetches the tail, then only the byte ranges of the documents it wants.  Any zstandard tool decompresses the
file as a whole.

Scale: documents are dealt to files by ranges of doc_id, so files in order hold documents in ascending order.  A task
streams one file and returns one manifest row; the driver holds one row per file.  Files get
fresh names and only those in the manifest count, so lost or repeated tasks leave nothing behind that is read.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
import sys
import types
import uuid
import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

LEVEL = 3
WORD_TABLE = 1_200_000   # words kept; each is held once
READ_BYTES = 8 << 20
#: bytes of text encoded at a time: by words, whose distinct ones are looked up once, and by whole texts
WORDS_BYTES, TEXTS_BYTES = 4 << 20, 1 << 20
#: fixed values of the zstandard seekable format
SKIPPABLE, SEEK_SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
_TAIL = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")  # ASCII punctuation but the apostrophe
_ALNUM = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
#: words of small letters a-z and those of Latin-1, in UTF-8: normalising leaves them as they are, and each is one piece
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch
MANIFEST = "part int, path string, documents long, tokens long"
NO_ID = -(1 << 63)


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray, pa.DictionaryArray]:
    """Where each text's words begin in the row of all words, that row, and two pieces of each distinct word: core and tail.

    Words are lower-cased where that cannot change their ids.  A special token is written as it is, so words that may hold one
    stay.  So do words with other than ASCII characters: a capital and a mark may have no composed character where the small
    letter has one, and tokenizers compose before they lower-case.  Bytes that are no UTF-8 pass through.  A tail is punctuation
    behind an ASCII letter or digit: no other one is sure to be a letter still when normalised.  Most words have an empty tail.
    """
    listed = pc.ascii_split_whitespace(texts.view(pa.large_string()))  # leaves empty words beside white space: they have no ids
    words = listed.values.dictionary_encode()
    distinct = words.dictionary
    special = pc.match_substring(distinct, "<|")
    distinct = pc.if_else(pc.and_not(pc.string_is_ascii(distinct), special), pc.ascii_lower(distinct), distinct)
    cores = pc.binary_length(pc.ascii_rtrim(distinct, _TAIL.decode())).to_numpy()
    _, offsets, held = distinct.buffers()
    held = held or pa.py_buffer(b"")
    starts, data = np.frombuffer(offsets, np.int64, len(distinct) + 1), np.frombuffer(held, np.uint8)
    tailed = (cores > 0) & ~special.to_numpy(zero_copy_only=False)
    tailed[tailed] = _ALNUM[data[(starts[:-1] + cores)[tailed] - 1]]
    cuts = np.empty(2 * len(distinct) + 1, np.int64)
    cuts[::2], cuts[1::2] = starts, np.where(tailed, starts[:-1] + cores, starts[1:])
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * len(distinct), [None, pa.py_buffer(cuts), held])
    return listed.offsets.to_numpy(), words, pieces.dictionary_encode()


class WordEncoder:
    """Ids of texts, each distinct word encoded once.

    ``by_word`` is only for tokenizers that lower-case, never join characters across ASCII white space, drop it, and end a
    piece between an ASCII letter or digit and ASCII punctuation that runs to the end of a word.  Then a word's ids do not
    depend on its neighbours: new words are encoded many at a time, with a full stop between them to tell them apart.
    A word with punctuation behind it is put together from the two, which the word table holds apart.  Words of small letters
    skip the tokenizer's normaliser and its split by pattern, which leave them whole, if its file states those
    (``word_table_is_exact``); their last tokens tell them apart.  Texts are split and their ids put together by Arrow, so only
    a call's distinct words are Python objects.  The word table is bounded and only saves time.
    """

    def __init__(self, spec: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer, self.by_word, self.table = Tokenizer.from_str(spec), by_word, {}
        if by_word:
            (self.stop,) = self.tokenizer.encode(".", add_special_tokens=False).ids
        self.letters = None
        if by_word and word_table_is_exact(spec):  # the same model behind a split at white space
            self.letters = Tokenizer(self.tokenizer.model)
            self.letters.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            last = [i for token, i in self.letters.get_vocab().items() if token.endswith("</w>")]
            self.last = np.zeros(max(last, default=0) + 1, bool)
            self.last[last] = True

    def _encode(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[bytes] | pa.Array) -> list[bytes]:
        if not self.by_word:
            texts = texts.to_pylist() if isinstance(texts, pa.Array) else texts
            return [x.tobytes() for x in self._encode([t.decode("utf-8", "replace") for t in texts])]
        if len(self.table) > WORD_TABLE:
            self.table = {}
        texts = pa.array(texts, pa.large_binary()) if isinstance(texts, list) else texts.cast(pa.large_binary())
        if not len(texts):
            return []
        offsets, words, pieces = _split(texts)
        keys = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn([w for w in keys if w not in self.table])
        both = pa.array(list(map(self.table.__getitem__, keys)), pa.large_binary()).take(pieces.indices)
        starts = np.frombuffer(both.buffers()[1], np.int64)[::2].copy()  # the ids of a core and of its tail stand together
        distinct = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), both.buffers()[2] or pa.py_buffer(b"")])
        ids = distinct.take(words.indices)
        ends, blob = np.frombuffer(ids.buffers()[1], np.int64)[offsets].tolist(), memoryview(ids.buffers()[2] or b"")
        return [bytes(blob[a:b]) for a, b in pairwise(ends)]

    def _learn_joined(self, words: list[bytes]) -> None:
        """Encodes words without full stops, many at a time."""
        runs = [words[i:i + 128] for i in range(0, len(words), 128)]
        for run, ids in zip(runs, self._encode([b" . ".join(run).decode("utf-8", "replace") for run in runs]), strict=True):
            stops = np.flatnonzero(ids == self.stop)
            blob, starts, ends = ids.tobytes(), [0, *(4 * (stops + 1)).tolist()], [*(4 * stops).tolist(), 4 * len(ids)]
            self.table.update([(w, blob[a:b]) for w, a, b in zip(run, starts, ends, strict=True)])

    def _learn_letters(self, words: list[bytes]) -> None:
        """Encodes words of small letters, many at a time: each is one piece, and only a piece's last token has the suffix."""
        runs = [words[i:i + 256] for i in range(0, len(words), 256)]
        for run, ids in zip(runs, self._encode([b" ".join(run).decode() for run in runs], self.letters), strict=True):
            ends = np.flatnonzero(self.last[ids]) + 1 if len(ids) and ids.max() < len(self.last) else ids[:0]
            if len(ends) != len(run):  # a letter that the vocabulary lacks
                self._learn_joined(run)
                continue
            blob, ends = ids.tobytes(), (4 * ends).tolist()
            self.table.update([(w, blob[a:b]) for w, a, b in zip(run, [0, *ends], ends, strict=False)])

    def _learn(self, new: list[bytes]) -> None:
        letters = [w for w in new if _LETTERS(w)] if self.letters else []
        self._learn_letters(letters)
        rest = set(new).difference(letters)
        joined = [w for w in rest if b"." not in w and b"<|" not in w]
        self._learn_joined(joined)
        single = list(rest.difference(joined))
        found = self._encode([w.decode("utf-8", "replace") for w in single])
        self.table.update((w, x.tobytes()) for w, x in zip(single, found, strict=True))


def worker_encoder(spec: str, by_word: bool) -> WordEncoder:
    """The encoder of this Python worker: kept between tasks, so each task does not learn the same words again."""
    held = sys.modules.setdefault("_parcelwise_encoders", types.ModuleType("_parcelwise_encoders")).__dict__
    name = f"{xxhash.xxh3_128_hexdigest(spec)}{by_word}"
    if name not in held:
        held[name] = WordEncoder(spec, by_word)
    return held[name]


class FrameWriter:
    """Writes one file of documents, in the order given."""

    def __init__(self, sink):
        self.sink, self.compressor = sink, zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.ids, self.entries, self.tokens = [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compressor.compress(ids)
        self.sink.write(frame)
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.tokens += len(ids) // 4

    def close(self) -> None:
        index = np.array(self.ids, "<i8").tobytes()
        self.sink.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        table = np.array(self.entries, "<u4").tobytes()
        self.sink.write(struct.pack("<II", SEEK_SKIPPABLE, len(table) + 9) + table
                        + struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEKABLE))


class FrameReader:
    """Random access to the documents of a file: reads its tail, then only the frames asked for."""

    def __init__(self, file):
        self.file, size = file, file.size()
        count, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("not a seekable token file")
        at = size - 9 - 12 * count
        self.entries = np.frombuffer(file.read_at(12 * count, at), "<u4").reshape(-1, 3).astype(np.int64)
        self.ids = np.frombuffer(file.read_at(8 * count, at - 8 - 8 * count), "<i8")
        self.starts = np.concatenate([[0], np.cumsum(self.entries[:, 0])])

    def read(self, rows: np.ndarray):
        """(row, ids as bytes) of the given rows, ascending; neighbouring frames are fetched together."""
        decompressor = zstandard.ZstdDecompressor()
        rows, i = np.asarray(rows, np.int64), 0
        while i < len(rows):
            j = i + 1
            while j < len(rows) and rows[j] == rows[j - 1] + 1 and self.starts[rows[j] + 1] - self.starts[rows[i]] <= READ_BYTES:
                j += 1
            base = int(self.starts[rows[i]])
            block = self.file.read_at(int(self.starts[rows[j - 1] + 1]) - base, base)
            for r in rows[i:j].tolist():
                ids = decompressor.decompress(block[self.starts[r] - base:self.starts[r + 1] - base])
                if len(ids) != self.entries[r, 1] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != self.entries[r, 2]:
                    raise ValueError(f"frame {r} is damaged")
                yield r, ids
            i = j


def _open(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system, path


def _parts(batch: pa.RecordBatch, size: int):
    """Slices of a batch, each of about ``size`` bytes of text or of one row."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _writer(folder: str, spec, end_id: int, by_word: bool):
    end = struct.pack("<I", end_id)

    def run(batches):
        out = None
        for batch in batches:
            for part in _parts(batch, WORDS_BYTES if by_word else TEXTS_BYTES):
                if out is None:
                    uri = f"{folder}/{uuid.uuid4().hex}.zst"
                    system, path = _open(uri)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    sink = system.open_output_stream(path, compression=None)
                    out, encoder = FrameWriter(sink), worker_encoder(spec.value, by_word)
                gc.disable()  # millions of small values without cycles: searching them for some takes a sixth of the time
                ids = encoder.encode(part.column("text").fill_null(b""))
                gc.enable()
                for doc_id, x in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    out.add(doc_id, x + end)
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "path": uri,
                                               "documents": len(out.ids), "tokens": out.tokens}],
                                             pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()),
                                                        ("tokens", pa.int64())]))
    return run


#: fixed value: the split of words that ``WordEncoder`` follows, as tokenizer files state it
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def word_table_is_exact(spec: str) -> bool:
    """Whether a tokenizer file is of the kind for which words may be encoded apart and kept: it lower-cases, takes white space for
    one space, drops it, and splits words from punctuation as ``WordEncoder`` does.  Any other file is encoded by whole texts.
    """
    found = json.loads(spec)
    normalizer, splitter, model = found.get("normalizer") or {}, found.get("pre_tokenizer") or {}, found.get("model") or {}
    steps = [n.get("type") for n in normalizer.get("normalizers", [])]
    splits = splitter.get("pretokenizers", [])
    return (model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and steps == ["NFC", "Replace", "Lowercase"]
            and normalizer["normalizers"][1].get("pattern") == {"Regex": r"\s+"} and [p.get("type") for p in splits] == ["Split", "ByteLevel"]
            and splits[0].get("pattern") == {"Regex": SPLIT} and splits[0].get("behavior") == "Removed" and splits[0].get("invert") is True
            and splits[1].get("add_prefix_space") is False and splits[1].get("use_regex") is False and not found.get("post_processor"))


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2, by_word: bool | None = None) -> list[dict]:
    """Encode ``docs`` (doc_id, text) with the tokenizer file and write them in ascending doc_id order.

    Returns the manifest: path, documents, tokens and start (ids in earlier files) per file, in order.
    Null text is empty; every document ends with ``end_id``; null ids come first; rows with equal ids stand in an order
    that depends on their texts, and lie in several files where they are many.  ``by_word`` encodes words apart and keeps them; by
    default only for tokenizers whose file allows it (``word_table_is_exact``).  Other columns are ignored; no rows give no files.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    folder = folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    by_word = word_table_is_exact(text) if by_word is None else by_word
    spec = spark.sparkContext.broadcast(text)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")) \
        .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    rows = sorted(ordered.mapInArrow(_writer(folder, spec, end_id, by_word), MANIFEST).collect(), key=lambda r: r.part)
    manifest, start = [], 0
    for r in rows:
        manifest.append({"path": r.path, "documents": r.documents, "tokens": r.tokens, "start": start})
        start += r.tokens
    return manifest


def _read(wanted: list[int] | None):
    def run(batches):
        for batch in batches:
            for uri, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                system, path = _open(uri)
                with system.open_input_file(path) as file:
                    reader = FrameReader(file)
                    sizes = reader.entries[:, 1] // 4
                    starts = start + np.cumsum(sizes) - sizes
                    rows = np.arange(len(sizes)) if wanted is None else np.flatnonzero(np.isin(reader.ids, wanted))
                    held, out = 0, []
                    for r, ids in reader.read(rows):
                        out.append((r, ids))
                        held += len(ids)
                        if held > READ_BYTES:
                            yield _batch(reader, starts, out)
                            held, out = 0, []
                    if out:
                        yield _batch(reader, starts, out)
    return run


def _batch(reader: FrameReader, starts: np.ndarray, out: list) -> pa.RecordBatch:
    ids = [int(reader.ids[r]) for r, _ in out]
    return pa.RecordBatch.from_arrays(
        [pa.array([None if i == NO_ID else i for i in ids], pa.int64()), pa.array([int(starts[r]) for r, _ in out], pa.int64()),
         pa.array([len(x) // 4 for _, x in out], pa.int64()), pa.array([zlib.crc32(x) for _, x in out], pa.int64()),
         pa.array([x for _, x in out], pa.binary())], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def read_tokens(spark: SparkSession, manifest: list[dict], doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (little-endian unsigned 32-bit) read back from the files.

    With ``doc_ids`` only their frames are fetched and decompressed.  A frame that does not match its checksum raises.
    """
    files = spark.createDataFrame([(m["path"], m["start"]) for m in manifest], "path string, start long")
    return files.repartition(max(1, len(manifest))).mapInArrow(
        _read(doc_ids), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
