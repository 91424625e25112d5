"""Token ids in binary files of patched frame-of-reference blocks.

Documents are dealt out by ranges of their id and sorted inside each range; every task encodes its documents, ends each
with ``end_id`` and writes one file. A file is a sequence of blocks of 4,096 ids that run on across documents:

====================  =====================================================================================
file                  magic, blocks, document ids, their null flags and lengths, block starts, footer
block                 u32 count, u32 base, u8 width, u8 0, u16 exceptions, packed values, exceptions
packed values         id minus base in ``width`` bits each; width holds ``percentile`` of the block's values
exceptions            u16 positions, then u32 ids, of the values that need more bits
block starts          i64 file position of each block, so that a reader can begin at any block
footer                i64 positions of the document section and of the block starts, i64 documents, blocks, ids, magic
====================  =====================================================================================

All numbers are little-endian. A task writes to a name of its own; the manifest, a table written by Spark, names the
files of the tasks that succeeded, so that files of lost or repeated attempts are never read. Files are opened through
the file system of the folder's URI. A document's position over the whole table is the sum of the files before its own,
from one manifest row per file, plus its position inside the file.

Encoding asks the given tokenizer only for pieces of text not met before. Bytes are cut, a segment of texts at a time, where the
tokenizer's own rule always begins a new word (see ``cuts_of``), so that the ids are those of the whole text. Equal pieces of a
segment are found by a hash and compared byte by byte; each distinct one is looked up once, in tables of about ``CACHE``
pieces per worker. A text that contains the text of an added token is encoded whole, and the tokenizer gives that token, as
it does for any caller.

Defined results: a null or empty text is the end id alone; null ids come first; repeated ids are all written, ordered
by a hash of their text; ids must be integers; an empty table writes no file and gives an empty result.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnlake.llm.common import ship_package, staged
from churnlake.llm.textbytes import run_hashes
from churnlake.session import scratch_path

MAGIC = b"PFRBLOCK"
FOOTER = struct.Struct("<5q8s")
BLOCK = struct.Struct("<IIBBH")
BLOCK_IDS = 4096
PERCENTILE = 99
END_ID = 0
CACHE = 600_000
JOINED = 2_000
SEGMENT = 3_000_000
READ_BLOCKS = 256
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
_PLAIN = re.compile(r" \S(?:[^ ]*\S)?")
#: Ends a text in a segment's bytes; no byte of UTF-8.
_STOP = 0xFF


def _before(x: np.ndarray, n: int = 1) -> np.ndarray:
    """The value ``n`` places earlier, False at the start."""
    out = np.zeros_like(x)
    out[n:] = x[:-n]
    return out


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By byte: whether it is a letter or digit, a mark, or part of something other than white space (all of ASCII)."""
    letter, mark, firm = np.zeros(256, bool), np.zeros(256, bool), np.ones(256, bool)
    for code in range(128):
        letter[code] = chr(code).isalnum()
        firm[code] = not chr(code).isspace()
        mark[code] = firm[code] and chr(code).isprintable() and not letter[code]
    firm[_STOP] = False
    return letter, mark, firm


_LETTER, _MARK, _FIRM = _classes()


def cuts_of(data: np.ndarray) -> np.ndarray:
    """Whether a piece begins at a byte of texts that each end in ``_STOP``.

    Cuts are made before white space that follows something else, after a single line feed between others, and before an
    ASCII mark that follows a letter or digit (of ASCII or U+00C0 to U+00FF). The tokenizer's rule for words ends one at each of
    these whatever stands around. Next to white space other than spaces and line feeds nothing is cut.
    """
    letter, firm = _LETTER[data], _FIRM[data]
    if ((data >= 0x80) & (data != _STOP)).any():
        one, two = np.append(data[1:], _STOP), np.append(data[2:], [_STOP, _STOP])
        letter |= _before(data == 0xC3) & (data != 0x97) & (data != 0xB7)
        spaces = (data == 0xC2) & ((one == 0x85) | (one == 0xA0))
        spaces |= (data == 0xE1) & ((one == 0x9A) | (one == 0xA0)) | (data == 0xE3) & (one == 0x80) & (two == 0x80)
        spaces |= (data == 0xE2) & ((one == 0x81) | (one == 0x80) & ((two <= 0x8F) | (two >= 0xA8) & (two <= 0xAF)))
        if spaces.any():
            firm &= ~(spaces | _before(spaces) | _before(spaces, 2))
    line = data == 0x0A
    cut = ((data == 0x20) | line) & _before(firm)
    cut |= firm & _before(line) & _before(firm, 2)
    cut |= _MARK[data] & _before(letter)
    return cut | _before(data == _STOP)


class PieceEncoder:
    """Ids of texts, from a tokenizer that is asked only for pieces not met before.

    Known pieces are in tables of two ages. When the younger one is full it becomes the older one, and the older one goes; a piece that
    is met again moves to the younger table, so that pieces in use stay. New pieces are encoded many in one call, as a text
    that is cut again where a token begins with a space.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        cutter = rules["pre_tokenizer"] or {}
        #: Texts with the text of an added token, such as <|endoftext|>, are not cut.
        self.added = [t["content"] for t in rules.get("added_tokens") or []]
        #: Whether the tokenizer cuts a text into words by the rule that cuts_of knows; if not, whole texts are encoded.
        self.cuts = rules["normalizer"] is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", False) \
            and not cutter.get("add_prefix_space", True)
        size = self.tokenizer.get_vocab_size()
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces, as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if self.cuts and _PLAIN.fullmatch(p)]
        texts = ["".join([pieces[i] for i in plain[k:k + JOINED]]) for k in range(0, len(plain), JOINED)]
        found = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate([np.zeros(0, "<u4"), *found])
        begins = np.flatnonzero(self.spaced[flat])
        if len(begins) != len(plain):
            raise ValueError("the tokenizer does not cut before single spaces")
        data, bounds = flat.tobytes(), (np.append(begins, len(flat)) * 4).tolist()
        for i, a, b in zip(plain, bounds[:-1], bounds[1:]):
            out[i] = data[a:b]
        if len(plain) < len(pieces):
            taken = set(plain)
            others = [i for i in range(len(pieces)) if i not in taken]
            for i, e in zip(others, self.tokenizer.encode_batch_fast([pieces[i] for i in others], add_special_tokens=False)):
                out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    def known(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces, as little-endian 32-bit integers."""
        if len(self.young) > CACHE:
            self.young, self.old = {}, self.young
        found = list(map(self.young.get, pieces))
        lost = [i for i, ids in enumerate(found) if ids is None]
        older = list(map(self.old.get, [pieces[i] for i in lost]))
        unknown = [i for i, ids in zip(lost, older) if ids is None]
        new = iter(self._encode([pieces[i].decode() for i in unknown]))
        for i, ids in zip(lost, older):
            found[i] = self.young[pieces[i]] = next(new) if ids is None else ids
        return found

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and where each text's ids end."""
        raw = b"".join([t + bytes([_STOP]) for t in texts])
        data = np.frombuffer(raw, np.uint8)
        stops = np.flatnonzero(data == _STOP)
        cut = cuts_of(data)
        cut[:1] = True
        starts = np.flatnonzero(cut & (data != _STOP))
        last = np.searchsorted(starts, stops)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        ends = np.minimum(np.append(starts[1:], len(data)), stops[np.searchsorted(stops, starts)])
        _, lead, number = np.unique(run_hashes(data, starts, ends), return_index=True, return_inverse=True)
        lead, number = _separate(data, starts, ends, lead, number)
        found = self.known([raw[a:b] for a, b in zip(starts[lead].tolist(), ends[lead].tolist())])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        counts = sizes[number]
        after = np.cumsum(counts)
        at = np.repeat(begins[number] - (after - counts), counts) + np.arange(after[-1])
        return np.frombuffer(b"".join(found), "<u4")[at], np.append(0, after)[last]


def _separate(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: np.ndarray,
              number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces whose bytes are not those of the piece that leads their number become numbers of their own."""
    sizes = ends - starts
    differs = sizes != sizes[lead][number]
    step = np.where(differs, 0, starts[lead][number] - starts)
    own = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    wrong = np.flatnonzero(data[own] != data[own + np.repeat(step, sizes)])
    differs[np.searchsorted(starts, own[wrong], side="right") - 1] = True
    odd = np.flatnonzero(differs)
    number = number.copy()
    number[odd] = len(lead) + np.arange(len(odd))
    return np.concatenate([lead, odd]), number


@functools.cache
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def segments(text: str, size: int) -> Iterator[str]:
    """Parts of a long text, cut where pieces are cut."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE_CUT.search(text, at + size)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encoded(texts: list[str], path: str, end_id: int = END_ID) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(row, ids, whether they end the row's text), in order; groups of rows share a call, long texts come in parts."""
    held: list[tuple[int, bool]] = []
    parts: list[bytes] = []
    size = 0
    rules = encoder(path)

    def flush():
        ids, ends = rules.ids(parts)
        closed = np.array([last for _, last in held], dtype=bool)
        ids = np.insert(ids, ends[closed], end_id)
        ends = (ends + np.cumsum(closed)).tolist()
        for (row, last), a, b in zip(held, [0, *ends], ends):
            yield row, ids[a:b], last

    for row, text in enumerate(texts):
        if not rules.cuts or any(added in text for added in rules.added):
            if held:
                yield from flush()
                held, parts, size = [], [], 0
            whole = rules.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            yield row, np.array([*whole, end_id], "<u4"), True
            continue
        cut = list(segments(text, SEGMENT))
        for k, part in enumerate(cut):
            held.append((row, k == len(cut) - 1))
            parts.append(part.encode())
            size += len(parts[-1])
            if size >= SEGMENT:
                yield from flush()
                held, parts, size = [], [], 0
    if held:
        yield from flush()


def pack_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    base = int(ids.min())
    rest = ids.astype(np.uint32) - np.uint32(base)
    rank = min(len(rest) - 1, len(rest) * percentile // 100)
    width = int(np.partition(rest, rank)[rank]).bit_length()
    odd = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    low = rest.copy()
    low[odd] = 0
    if width in (8, 16, 32):
        packed = low.astype(f"<u{width // 8}").tobytes()
    elif width:
        bits = np.unpackbits(low.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        packed = np.packbits(bits.reshape(-1), bitorder="little").tobytes()
    else:
        packed = b""
    head = BLOCK.pack(len(ids), base, width, 0, len(odd))
    return head + packed + odd.astype("<u2").tobytes() + ids[odd].astype("<u4").tobytes()


def unpack_block(data: memoryview) -> tuple[np.ndarray, int]:
    """The block's ids and its length in bytes."""
    count, base, width, _, odd = BLOCK.unpack_from(data)
    at = BLOCK.size
    size = (count * width + 7) // 8
    if width in (8, 16, 32):
        rest = np.frombuffer(data, f"<u{width // 8}", count, at).astype(np.uint32)
    elif width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), bitorder="little", count=count * width)
        wide = np.zeros((count, 32), np.uint8)
        wide[:, :width] = bits.reshape(count, width)
        rest = np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1).astype(np.uint32)
    else:
        rest = np.zeros(count, np.uint32)
    ids = rest + np.uint32(base)
    at += size
    ids[np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    return ids, at + 6 * odd


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class BlockWriter:
    """One file; ids are appended in any portions."""

    def __init__(self, stream, percentile: int = PERCENTILE):
        self.stream, self.percentile = stream, percentile
        self.held: list[np.ndarray] = []
        self.waiting = self.total = 0
        self.blocks: list[int] = []
        self.docs: list[tuple[int | None, int]] = []
        self.position = self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.stream.write(data)
        return len(data)

    def append(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        if self.waiting >= BLOCK_IDS * 64:
            self._write_blocks(self.waiting // BLOCK_IDS * BLOCK_IDS)

    def _write_blocks(self, upto: int) -> None:
        ids = np.concatenate(self.held)
        for a in range(0, upto, BLOCK_IDS):
            self.blocks.append(self.position)
            self.position += self._put(pack_block(ids[a:min(upto, a + BLOCK_IDS)], self.percentile))
        self.held, self.waiting = [ids[upto:]], len(ids) - upto

    def end_document(self, doc_id: int | None, size: int) -> None:
        self.docs.append((doc_id, size))

    def close(self) -> int:
        """Bytes written."""
        if self.waiting:
            self._write_blocks(self.waiting)
        section = self.position
        null = np.array([d is None for d, _ in self.docs], np.uint8)
        for data in (np.array([0 if d is None else d for d, _ in self.docs], "<i8"), null,
                     np.array([n for _, n in self.docs], "<i8")):
            self.position += self._put(data.tobytes())
        index = self.position
        self.position += self._put(np.array(self.blocks, "<i8").tobytes())
        self.position += self._put(FOOTER.pack(section, index, len(self.docs), len(self.blocks), self.total, MAGIC))
        return self.position


def read_file(uri: str) -> Iterator[tuple[int | None, int, int, int]]:
    """(doc id, position in the file, ids, crc32 of the ids) of every document of a file, READ_BLOCKS blocks at a time."""
    files, path = _open(uri)
    with files.open_input_file(path) as f:
        size = f.size()
        section, index, n_docs, n_blocks, total, magic = FOOTER.unpack(f.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC or f.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is not a file of token blocks")
        data = f.read_at(17 * n_docs, section)
        doc_ids = np.frombuffer(data, "<i8", n_docs)
        nulls = np.frombuffer(data, np.uint8, n_docs, 8 * n_docs)
        lengths = np.frombuffer(data, "<i8", n_docs, 9 * n_docs)
        starts = np.append(np.frombuffer(f.read_at(8 * n_blocks, index), "<i8"), section)
        ends, doc, crc, done, begin = np.cumsum(lengths), 0, 0, 0, 0
        for k in range(0, n_blocks, READ_BLOCKS):
            last = min(n_blocks, k + READ_BLOCKS)
            view, parts = memoryview(f.read_at(int(starts[last] - starts[k]), int(starts[k]))), []
            for b in range(k, last):
                parts.append(unpack_block(view[int(starts[b] - starts[k]):])[0])
            ids = np.concatenate(parts).astype("<u4")
            at = 0
            while doc < n_docs and at < len(ids):
                stop = min(len(ids), int(ends[doc]) - done)
                crc = zlib.crc32(ids[at:stop].tobytes(), crc)
                at = stop
                if done + at == ends[doc]:
                    yield (None if nulls[doc] else int(doc_ids[doc])), begin, int(lengths[doc]), crc
                    doc, crc, begin = doc + 1, 0, int(ends[doc])
            done += len(ids)
        if done != total or doc != n_docs:
            raise ValueError(f"{uri} is damaged: {done} of {total} ids, {doc} of {n_docs} documents")


def write_blocks(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, percentile: int = PERCENTILE) -> DataFrame:
    """Write the files; the manifest: part, file, n_docs, n_tokens, n_bytes, start. ``folder`` is shared by the cluster."""
    ship_package(docs.sparkSession)
    ready = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = ready.repartitionByRange("id", tie).sortWithinPartitions("id", tie)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, stream, part = None, None, TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.pfr"
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                files, path = _open(folder)
                files.create_dir(path, recursive=True)
                stream = files.open_output_stream(f"{path}/{os.path.basename(name)}")
                writer = BlockWriter(stream, percentile)
            ids = [None if pd.isna(x) else int(x) for x in batch["id"].astype(object)]
            size = 0
            for row, part_ids, last in encoded(batch["text"].tolist(), tokenizer, end_id):
                writer.append(part_ids)
                size += len(part_ids)
                if last:
                    writer.end_document(ids[row], size)
                    size = 0
        if writer is not None:
            n_bytes = writer.close()
            stream.close()
            yield pd.DataFrame({"part": [part], "file": [name], "n_docs": [len(writer.docs)],
                                "n_tokens": [writer.total], "n_bytes": [n_bytes]})

    manifest = staged(ordered.mapInPandas(
        write, "part long, file string, n_docs long, n_tokens long, n_bytes long"), "token-manifest")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_blocks(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start, n_tokens, ids_crc32 of every document, read from the files of a manifest, a file per task."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, start in zip(batch["file"], batch["start"]):
                rows = []
                for row in read_file(file):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield frame(rows, start)
                        rows = []
                yield frame(rows, start)

    def frame(rows: list, start: int) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["id", "start", "n_tokens", "ids_crc32"])
        return out.assign(id=out["id"].astype("Int64"), start=out["start"].astype("int64") + start)

    ship_package(manifest.sparkSession)
    files = max(1, manifest.count())
    dealt = manifest.select("part", "file", "start").repartitionByRange(files, "part")
    found = dealt.mapInPandas(read, "id long, start long, n_tokens long, ids_crc32 long")
    return found.withColumnRenamed("id", id_col)


def token_table(docs: DataFrame, tokenizer: str, folder: str | None = None, **settings) -> DataFrame:
    """Write all documents and read the files back: id, start, n_tokens, ids_crc32."""
    folder = folder or scratch_path(docs.sparkSession, "token-blocks")
    return read_blocks(write_blocks(docs, folder, tokenizer, **settings))
