"""Byte-level BPE with reuse of content-defined chunks.

A rolling hash over the bytes of a text picks chunk ends that depend on the nearby content
only, so passages shared by documents fall into the same chunks. A task encodes a chunk once
and keeps its ids in a dictionary of bounded size. Where two chunks meet, tokens of the whole
text may straddle the cut: the span from the last sure token edge before the cut to the first
one after it is encoded again and replaces both ends. A token edge is sure where a character
other than white space is followed by white space, since no token covers both; if the text
shows no such place, the span grows over further chunks, so the result is always exact.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import read
from quillmill.llm.registry import query

#: How the byte-level tokenizers of this kind split a text before merging (a fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Chunks are about AVERAGE bytes long, LEAST at least and MOST at most (up to a character).
AVERAGE, LEAST, MOST = 1024, 256, 8192
#: Bytes of chunk text that a task keeps encoded.
KEPT_BYTES = 32 << 20

#: A sure token edge; both sides are chosen so narrowly that all Unicode versions agree on them.
EDGE = regex.compile(r"(?<=[\p{L}\p{N}!-~])(?=[ \n])")


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins for bytes in vocabulary files: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ChunkedBpe:
    """Encodes and decodes like the tokenizers library with the same file and no added specials."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        plain = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        fits = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or not fits or not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        special = {t["content"]: t["id"] for t in added}
        to_byte = _byte_of_char()
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        merged = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ids = [spec["model"]["vocab"]["".join(m)] for m in merged]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            raise ValueError(f"{path}: ids don't follow the order of the merges")
        self._bpe = tiktoken.Encoding("chunked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self._special = special
        self._marks = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._bytes = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self._lengths = np.zeros(max(self._bytes) + 1, np.int64)
        for i, b in self._bytes.items():
            self._lengths[i] = len(b)
        mixed = np.random.default_rng(20240501)
        self._gear = mixed.integers(0, 1 << 32, 256, dtype=np.uint32)
        self._kept: OrderedDict[str, np.ndarray] = OrderedDict()
        self._kept_bytes = 0
        self.reused = 0

    def _cuts(self, data: bytes) -> list[int]:
        """Byte offsets of chunk ends, on character edges; a window of 16 bytes decides each."""
        n = len(data)
        if n <= LEAST:
            return [n]
        raw = np.frombuffer(data, np.uint8)
        rolled = self._gear[raw]
        for k in (1, 2, 4, 8):
            shifted = np.zeros_like(rolled)
            shifted[k:] = rolled[:-k]
            rolled = rolled + (shifted << np.uint32(k))
        marks = np.flatnonzero((rolled >> np.uint32(16)) % np.uint32(AVERAGE) == 0) + 1
        ends, last = [], 0
        for m in [*marks.tolist(), n]:
            while m - last > MOST:
                end = last + MOST
                while data[end] & 0xC0 == 0x80:
                    end -= 1
                ends.append(end)
                last = end
            if m == n:
                break
            if m - last >= LEAST and data[m] & 0xC0 != 0x80:
                ends.append(m)
                last = m
        return [*ends, n]

    def _chunk(self, text: str) -> np.ndarray:
        ids = self._kept.get(text)
        if ids is not None:
            self._kept.move_to_end(text)
            self.reused += 1
            return ids
        ids = np.array(self._bpe.encode_ordinary(text), np.uint32)
        self._kept[text] = ids
        self._kept_bytes += 6 * len(text)
        while self._kept_bytes > KEPT_BYTES:
            self._kept_bytes -= 6 * len(self._kept.popitem(last=False)[0])
        return ids

    def _between(self, text: str) -> np.ndarray:
        """The ids of a text without special tokens."""
        data = text.encode()
        ends = self._cuts(data)
        if len(ends) == 1:
            return self._chunk(text)
        chunks = [data[a:b].decode() for a, b in zip([0, *ends], ends)]
        out: list[np.ndarray] = []
        # not settled yet: one chunk's text and ids from some token edge on, or pieces to be encoded anew
        text_left, ids_left, pieces = chunks[0], self._chunk(chunks[0]), []
        for chunk in chunks[1:]:
            before = pieces[-1] if pieces else text_left
            if EDGE.search(before[-1:] + chunk[:1]):  # the cut is a sure edge
                out.append(self._plain("".join(pieces)) if pieces else ids_left)
                text_left, ids_left, pieces = chunk, self._chunk(chunk), []
                continue
            if not pieces:  # settle what lies before the last sure edge
                edge = self._last_edge(text_left)
                if edge:
                    out.append(ids_left[: self._index(ids_left, text_left[:edge])])
                pieces = [text_left[edge:]]
            first = EDGE.search(chunk)
            if first is None:  # the span to be encoded anew grows over this chunk
                pieces.append(chunk)
                continue
            at = first.start()
            out.append(self._plain("".join([*pieces, chunk[:at]])))
            ids = self._chunk(chunk)
            text_left, ids_left, pieces = chunk[at:], ids[self._index(ids, chunk[:at]) :], []
        out.append(self._plain("".join(pieces)) if pieces else ids_left)
        return np.concatenate(out)

    @staticmethod
    def _last_edge(text: str) -> int:
        for begin in (max(0, len(text) - 64), 0):
            edge = 0
            for m in EDGE.finditer(text, begin):
                edge = m.start()
            if edge:
                return edge
        return 0

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self._bpe.encode_ordinary(text), np.uint32)

    def _index(self, ids: np.ndarray, head: str) -> int:
        """How many ids make up ``head``, which ends at a token edge."""
        offset = len(head.encode())
        ends = np.cumsum(self._lengths[ids])
        k = int(np.searchsorted(ends, offset, side="right"))
        if offset and (k == 0 or ends[k - 1] != offset):
            raise AssertionError("a sure edge isn't a token edge")
        return k

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text as unsigned 32-bit integers; a null text is empty."""
        text = text or ""
        if self._marks is None:
            return self._between(text)
        out, last = [], 0
        for m in self._marks.finditer(text):
            out += [self._between(text[last : m.start()]), np.array([self._special[m.group()]], np.uint32)]
            last = m.end()
        out.append(self._between(text[last:]))
        return np.concatenate(out).astype(np.uint32) if len(out) > 1 else out[0]

    def decode(self, ids) -> str:
        """The text of ids, special tokens spelled out; bytes that aren't UTF-8 become U+FFFD."""
        table = self._bytes
        return b"".join([table[i] for i in np.asarray(ids).tolist()]).decode("utf-8", "replace")


_loaded: dict[str, ChunkedBpe] = {}


def bpe(path: str) -> ChunkedBpe:
    """One encoder for each file and Python worker."""
    if path not in _loaded:
        _loaded[path] = ChunkedBpe(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every row, in one narrow stage.

    ``tokenizer`` is the path of the file on every worker (or the bare file name of one that
    the package public_tokenizers brings). Null and empty texts have no ids and decode to ''.
    Repeated rows are kept; other columns aren't read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(_resolved(tokenizer))
        for batch in batches:
            for small in _slices(batch):
                ids = [coder.encode(t) for t in small.column("text").to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                decoded = pa.array([coder.decode(x) for x in ids], pa.string())
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([small.column("id"), lists, decoded], ["id", "ids", "decoded"])

    return rows.mapInArrow(run, f"id {id_type}, ids array<int>, decoded string")


def token_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of what ``encode_documents`` gives, made where
    the ids are, so that they needn't leave the worker."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(_resolved(tokenizer))
        for batch in batches:
            n, shas, decoded = [], [], []
            for t in batch.column("text"):
                ids = coder.encode(t.as_py())
                n.append(len(ids))
                shas.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            columns = [batch.column("id"), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _slices(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of about ``most`` characters, one row at least."""
    sizes = [len(t.as_py() or "") for t in batch.column("text")]
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def _resolved(tokenizer: str) -> str:
    if os.path.sep in tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


TOKENIZER = "byte_bpe_50k.json"


@query("op2_bpe")
def op2_bpe(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(docs, TOKENIZER).withColumnRenamed("id", "doc_id")
