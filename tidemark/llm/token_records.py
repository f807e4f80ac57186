"""Token ids as length-delimited binary records, with an offset index beside them.

A file is a run of frames: length of the data (unsigned 64 bit), masked checksum of those eight bytes
(unsigned 32 bit), data, masked checksum of the data; all little-endian. The checksum is CRC-32, masked by
rotating right 15 bits and adding a constant, so that data which hold checksums do not look right by
chance. The data are one byte, the width of an id (2 if the vocabulary allows, else 4), and the ids.

Documents are range-partitioned by id and sorted inside partitions; every task streams its documents into
one file of its own, whose name holds the attempt. The index (Parquet, written by Spark, so only of tasks
that succeeded) says for every document where its frame is: a lost or doubled task leaves at most a file
that no index names. Any subset of records can be read in any order by it.

Files go where the folder's URI says, through Arrow's file systems. Texts are encoded by the tokenizers
library: cut before a blank that follows a non-blank, where this kind of pre-tokenizer cuts too, each
distinct piece once per worker. Texts with other blanks before such a cut, or with added tokens in them, are
encoded whole. Equal pieces of a run of texts become one by Arrow's dictionary encoding before they are looked
up, and workers give memory back after each batch. New pieces that are one word of Latin letters go to the
library's model many at a time, in its byte alphabet and without the pre-tokenizer, as no token joins a letter
and a blank behind it.

Defined results: null text is an empty one, which has just the end id; rows that share an id are ordered by
text; an empty table gives an empty index; a frame whose checksums differ raises.
"""
from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small, text_or_empty, trim

#: Fixed values of the mask: a rotation and a constant.
ROTATE, ADD = 15, 0xA282EAD8
#: Pieces that a worker remembers, in two generations: when the newer is full, only the older one goes.
REMEMBERED = 800_000
#: Where Latin letters are the only ones, also between a letter and a mark.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
OTHER_LETTER = re.compile(rf"[^\W\d_{LATIN}]")
OTHER_BLANK = re.compile(r"[^\S \n][ \n]")
#: Of the first 256 code points: other blanks, and what ``OTHER_LETTER`` finds.
NARROW_BLANKS = "".join(c for c in map(chr, range(256)) if c.isspace() and c not in " \n")
NARROW_LETTERS = "".join(c for c in map(chr, range(256)) if OTHER_LETTER.match(c))
#: New pieces that are one word behind one blank follow each other in one text of at most so many.
TOGETHER = 100
#: Texts are cut together, with their equal pieces, up to about so many bytes.
RUN = 1 << 21
WIDTHS = {2: np.dtype("<u2"), 4: np.dtype("<u4")}


def masked(data: bytes) -> bytes:
    crc = zlib.crc32(data)
    crc = (crc >> ROTATE | crc << 32 - ROTATE) & 0xFFFFFFFF
    return ((crc + ADD) & 0xFFFFFFFF).to_bytes(4, "little")


def frame(data: bytes) -> bytes:
    length = len(data).to_bytes(8, "little")
    return b"".join((length, masked(length), data, masked(data)))


def unframe(raw: bytes) -> bytes:
    length = raw[:8]
    if raw[8:12] != masked(length):
        raise ValueError("a record's length does not match its checksum")
    data = raw[12 : 12 + int.from_bytes(length, "little")]
    if raw[12 + len(data) :] != masked(data):
        raise ValueError("a record's data do not match their checksum")
    return data


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, named as a URI or a local path."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def cuts_at_blanks(path: str) -> bool:
    """Whether the file says that texts are cut before blanks and behind words, as ``piece_begins`` supposes; else texts are encoded whole."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before = spec.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("add_prefix_space") is False and before.get("use_regex", True)
    return bool(plain) and spec.get("normalizer") is None and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout")


def byte_alphabet() -> np.ndarray:
    """The code point by which this kind of tokenizer writes each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    points = np.empty(256, "<u4")
    points[shown] = shown
    hidden = np.setdiff1d(np.arange(256), shown)
    points[hidden] = 256 + np.arange(len(hidden))
    return points


def latin_letters(data: np.ndarray) -> np.ndarray:
    """Which bytes of these UTF-8 texts belong to letters of ``LATIN``: one byte, or two of which the first is C3."""
    letter = ((data | 32) - np.uint8(97)) < 26
    first = np.flatnonzero(data == 0xC3)
    first = first[(data[first + 1] != 0x97) & (data[first + 1] != 0xB7)]
    letter[first] = letter[first + 1] = True
    return letter


def piece_begins(data: np.ndarray, sizes: np.ndarray, after_letters: np.ndarray) -> np.ndarray:
    """Where pieces begin in these UTF-8 texts of these sizes, one behind the other: with each text, before a blank
    that follows a non-blank and, in texts marked for it, behind a run of Latin letters."""
    begin = np.zeros(len(data) + 1, bool)
    begin[np.cumsum(sizes) - sizes] = True
    blank = (data == 32) | (data == 10)
    begin[1:-1] |= blank[1:] & ~blank[:-1]
    if after_letters.any():
        letter = latin_letters(data)
        ended = letter[:-1] & ~letter[1:]
        begin[1:-1] |= ended if after_letters.all() else ended & np.repeat(after_letters, sizes)[1:]
    return np.flatnonzero(begin[:-1])


def runs(texts: pa.Array) -> Iterator[list[str]]:
    """Successive texts, each once; all but the first of a run are smaller than ``RUN`` together."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // RUN)) + 1).tolist(), len(texts)]
    return (texts.slice(a, b - a).to_pylist() for a, b in zip(cuts, cuts[1:]))


def joins_no_words(path: str, vocabulary: dict[str, int]) -> bool:
    """Whether the model finds the same tokens in many words of Latin letters, a blank before each, together as in each of them."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    if any(model.get(x) for x in ("ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")):
        return False
    points = byte_alphabet()
    letters = {b for c in map(chr, range(256)) if re.match(f"[{LATIN}]", c) for b in c.encode()}
    space, line, letters = chr(points[32]), chr(points[10]), {chr(points[b]) for b in letters}
    used = letters | {space, line}
    crossing = lambda token: any(a in letters and b in (space, line) or a == line and b in letters for a, b in zip(token, token[1:]))
    return used <= vocabulary.keys() and not any(used.issuperset(t) and crossing(t) for t in vocabulary)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.pieces: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.cuts = cuts_at_blanks(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.lengths = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.lengths[i] = len(token)  # this kind writes a byte as one character
        self.words = None
        if self.cuts and joins_no_words(path, self.tokenizer.get_vocab(with_added_tokens=False)):
            self.words, self.points = Tokenizer(self.tokenizer.model), byte_alphabet()  # the model is shared, not loaded again

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, WIDTHS[self.width]).tobytes() for e in found]

    def _words_alone(self, pieces: list[bytes]) -> np.ndarray:
        """Which pieces are one word of Latin letters behind one blank."""
        sizes, data = np.fromiter(map(len, pieces), np.int64, len(pieces)), np.frombuffer(b"".join(pieces), np.uint8)
        firsts = np.cumsum(sizes) - sizes
        others = np.cumsum(~latin_letters(data))
        blank = (data[firsts] == 32) | (data[firsts] == 10)
        return blank & (sizes > 1) & (others[firsts + sizes - 1] - others[firsts] == 0)

    def _learn(self, missing: list[bytes]) -> dict[bytes, bytes]:
        """Encode pieces in one text, where the library cuts between them anyway, and find their ids by length."""
        learned: dict[bytes, bytes] = {}
        if self.words:
            alone = self._words_alone(missing)
            words, missing = list(compress(missing, alone)), list(compress(missing, ~alone))
            parts = [b"".join(words[at : at + TOGETHER]) for at in range(0, len(words), TOGETHER)]
            shown = [self.points[np.frombuffer(x, np.uint8)].tobytes().decode("utf-32-le") for x in parts]
            # each word begins with its only blank, the least of its bytes
            begins = np.flatnonzero(np.frombuffer(b"".join(parts), np.uint8) <= 32)
            learned |= self._share_out(words, np.append(begins, sum(map(len, parts)))[1:], self.words.encode_batch_fast(shown, add_special_tokens=False))
        safe = [p for p in missing if p[0] in b" \n" and not p.decode()[-1].isspace()]
        rest = [p for p in missing if p[0] not in b" \n" or p.decode()[-1].isspace()]
        learned.update(zip(rest, self._each(list(map(bytes.decode, rest)))))
        if safe:
            ends = np.cumsum(list(map(len, safe)))
            learned |= self._share_out(safe, ends, self.tokenizer.encode_batch_fast([b"".join(safe).decode()], add_special_tokens=False))
        return learned

    def _share_out(self, pieces: list[bytes], ends: np.ndarray, found: list) -> dict[bytes, bytes]:
        """For each of these successive pieces, whose bytes end there, which of the ids are its own."""
        ids = np.array(list(chain.from_iterable(e.ids for e in found)), np.int64)
        last = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
        raw, cuts = ids.astype(WIDTHS[self.width]).tobytes(), [0, *(last * self.width).tolist()]
        return dict(zip(pieces, map(raw.__getitem__, map(slice, cuts, cuts[1:]))))

    def _cut_after_letters(self, text: str) -> bool | None:
        """Whether the text can be cut behind its words, too, or only before blanks; None: not at all."""
        if not self.cuts or any(a in text for a in self.added):
            return None
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            odd = other = True
        else:  # then a look for single characters does
            odd, other = (any(map(text.__contains__, x)) for x in (NARROW_BLANKS, NARROW_LETTERS))
        if odd and OTHER_BLANK.search(text):
            return None
        return not (other and OTHER_LETTER.search(text))

    def _known(self, distinct: list[bytes]) -> list[bytes]:
        """The ids of these pieces; new ones are learned and remembered."""
        found = list(map(self.pieces.get, distinct))
        if missing := list(compress(distinct, map(not_, found))):
            if len(self.pieces) + len(missing) > REMEMBERED // 2:
                self.older, self.pieces, missing = self.pieces, {}, distinct
            old = list(map(self.older.get, missing))
            new = dict(zip(missing, old))
            new |= self._learn(list(compress(missing, map(not_, old))))
            self.pieces |= new
            found = [ids or new[p] for p, ids in zip(distinct, found)]
        return found

    def _encode_cut(self, texts: list[bytes], after_letters: list[bool]) -> list[bytes]:
        """Encode texts that may be cut: equal pieces become one by Arrow's dictionary, and each is looked up once."""
        sizes, data = np.fromiter(map(len, texts), np.int64, len(texts)), b"".join(texts)
        begins = piece_begins(np.frombuffer(data, np.uint8), sizes, np.array(after_letters))
        offsets = np.append(begins, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        found, number = self._known(pieces.dictionary.to_numpy(zero_copy_only=False).tolist()), pieces.indices.to_numpy()
        lengths = np.fromiter(map(len, found), np.int32, len(found)) // self.width  # no more ids than bytes
        firsts = np.cumsum(lengths, dtype=np.int32) - lengths
        many = lengths[number]
        ends = np.append(0, np.cumsum(many)).astype(np.int32)
        at = np.repeat(firsts[number] - ends[:-1], many)
        at += np.arange(len(at), dtype=np.int32)
        ids = np.frombuffer(b"".join(found), WIDTHS[self.width])[at]
        cuts = ends[np.searchsorted(offsets, np.append(0, np.cumsum(sizes)))]
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        after_letters = list(map(self._cut_after_letters, texts))
        cut = [(text.encode(), after) for text, after in zip(texts, after_letters) if after is not None]
        encoded = iter(self._encode_cut(*map(list, zip(*cut))) if cut else ())
        for text, after in zip(texts, after_letters):
            yield self._each([text])[0] if after is None else next(encoded)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_records(docs: DataFrame, folder: str, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = 0) -> DataFrame:
    """Write the records and their index; returns the index.

    Columns: the id, shard (in order of ids), file, record, offset, length (of the frame), before (ids
    earlier in the shard) and n_tokens, the end id counted.
    """
    spark = docs.sparkSession
    ordered = docs.select(F.col(id_column), text_or_empty(text_column).alias("_text"))
    ordered = ordered.repartitionByRange(id_column).sortWithinPartitions(id_column, "_text")
    kind = dict(ordered.dtypes)[id_column]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, of = context.partitionId(), encoder(tokenizer)
        name = f"shard-{shard:06d}-{context.taskAttemptId()}.rec"
        store, root = place(folder)
        head = bytes([of.width])
        end = np.array([end_id], WIDTHS[of.width]).tobytes()
        offset = before = record = 0
        out = None
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/{name}")
            places = []
            for ids in chain.from_iterable(map(of.encode, runs(batch.column(1)))):
                ids += end
                raw = frame(head + ids)
                out.write(raw)
                places.append((record, offset, len(raw), before, len(ids) // of.width))
                record, offset, before = record + 1, offset + len(raw), before + len(ids) // of.width
            n = len(places)
            columns = [pa.array(c, pa.int64()) for c in zip(*places)] if n else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shard] * n, pa.int64()), pa.array([name] * n, pa.string()), *columns],
                [id_column, "shard", "file", "record", "offset", "length", "before", "n_tokens"],
            )
            trim()
        if out is not None:
            out.close()

    schema = f"`{id_column}` {kind}, shard long, file string, record long, offset long, length long, before long, n_tokens long"
    written = ordered.mapInArrow(write, schema)
    written.write.parquet(f"{folder}/index")
    return spark.read.schema(written.schema).parquet(f"{folder}/index")


def with_start(index: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before. One row per shard meets in one place."""
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = small(shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base")))
    return index.join(shards, "shard").withColumn("start", F.col("_base") + F.col("before")).drop("_base")


def read_records(index: DataFrame, folder: str, carry: tuple[str, ...]) -> DataFrame:
    """For any rows of an index: the columns to carry, and ``ids`` read from the files, checksums verified."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in index.select(*carry).dtypes)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = place(folder)
        files: dict[str, pa.NativeFile] = {}
        for batch in batches:
            ids, sizes, at = [], [0], 0
            names, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            for k, (name, offset, length) in enumerate(zip(names, offsets, lengths)):
                if name not in files:
                    for f in files.values():
                        f.close()
                    files = {name: store.open_input_file(f"{root}/{name}")}
                data = unframe(files[name].read_at(length, offset))
                ids.append(np.frombuffer(data, WIDTHS[data[0]], offset=1).astype(np.int32))
                sizes.append(sizes[-1] + len(ids[-1]))
                if sizes[-1] > 4_000_000 or k + 1 == len(names):
                    lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(ids)))
                    part = batch.slice(at, k + 1 - at)
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in carry], lists], [*carry, "ids"])
                    ids, sizes, at = [], [0], k + 1
        for f in files.values():
            f.close()
        trim()

    # an index row is small but its record is not: a task per file, not per so many bytes of the index
    files = max(1, index.select("file").distinct().count())
    dealt = index.repartition(files, "file").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(fetch, f"{kinds}, ids array<int>")


def open_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def ids_crc32(ids: str = "ids"):
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc(lists: pa.Array) -> pa.Array:
        values, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
        return pa.array([zlib.crc32(values[a:b].data) for a, b in zip(offsets, offsets[1:])], pa.int64())

    return crc(F.col(ids))
