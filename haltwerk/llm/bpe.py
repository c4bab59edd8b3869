"""Byte-level BPE over Arrow batches: ids, digests, offsets and the way back."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import models

from .common import text_of

RANKS = "byte_bpe_50k.tiktoken"
#: Pieces whose ids are kept at once in a worker, and the longest of them.
CACHE, CACHED_CHARS = 300_000, 64
#: Pieces handled at a time; bounds the memory that a very long text takes.
PIECES = 200_000


def byte_characters() -> str:
    """The character that stands for each byte: itself if it is visible Latin-1, else from U+0100 on in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in visible else chr(next(spare)) for b in range(256))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair that makes each longer token, in the order of ranks: the two parts left when only lower ranks may merge."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank))
            if ranks.get(parts[best] + parts[best + 1], rank) >= rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


class ByteBpe:
    """Encoder and decoder for one table of ranks; made once for each task."""

    def __init__(self, ranks: dict[bytes, int], merges: list[tuple[bytes, bytes]], pattern: str):
        characters = byte_characters()
        self._visible = {b: c for b, c in enumerate(characters)}
        spell = lambda token: "".join(self._visible[b] for b in token)
        vocab = {spell(t): r for t, r in ranks.items()}
        self._model = models.BPE(vocab=vocab, merges=[(spell(a), spell(b)) for a, b in merges])
        self._split = regex.compile(pattern)
        self._cache: dict[str, bytes] = {}
        # Decoding reverses the byte table: every id's token, read back character by character.
        back = {c: b for b, c in enumerate(characters)}
        self._token = {i: bytes(back[c] for c in spelt) for spelt, i in vocab.items()}

    def _piece(self, piece: str) -> bytes:
        ids = np.array([t.id for t in self._model.tokenize(piece.encode().decode("latin-1").translate(self._visible))], "<u4").tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self._cache) >= CACHE:
                self._cache.clear()
            self._cache[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; each match of the pattern is encoded on its own."""
        known = self._cache.get
        if len(text) <= PIECES:
            return b"".join([known(p) or self._piece(p) for p in self._split.findall(text)])
        out, found = [], self._split.finditer(text)
        while block := [m.group() for m in islice(found, PIECES)]:
            out.append(b"".join([known(p) or self._piece(p) for p in block]))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the ids; a character that is split over tokens is whole again once they are joined."""
        return b"".join(map(self._token.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, text: str, ids: bytes) -> np.ndarray:
        """(n, 2) code-point spans: of a token that starts or ends inside a character, that character is part."""
        raw = np.frombuffer(text.encode(), np.uint8)
        ends = np.cumsum([len(self._token[i]) for i in np.frombuffer(ids, "<u4").tolist()], dtype=np.int64)
        if not len(ends):
            return np.empty((0, 2), np.int64)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
        return np.stack([character[np.r_[0, ends[:-1]]], character[ends - 1] + 1], axis=1)


def _coder(spark, path: str | None, pattern: str | None):
    """A function that makes the coder in a task. The table of ranks (its size is the vocabulary's) is broadcast."""
    ranks = read_ranks(path or public_tokenizers.path(RANKS))
    sent = spark.sparkContext.broadcast((ranks, merges_of(ranks), pattern or public_tokenizers.PATTERN))
    return lambda: ByteBpe(*sent.value)


def bpe_digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode and decode every whole text of ``docs`` (doc_id, text); one row for each row.

    NULL text counts as empty: no ids, the digest of no bytes. NULL ids and repeated rows are rows like others;
    an empty table gives an empty result; extra columns are ignored. Special tokens are ordinary text. Returns doc_id,
    n_tokens, ids_sha256 (little-endian unsigned 32-bit ids), decoded_sha256 (the decoded bytes), n_bytes (their number).
    """
    make = _coder(docs.sparkSession, path, pattern)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = make()
        for batch in batches:
            out = []
            for text in batch.column(1):
                ids = coder.encode(text.as_py())
                back = coder.decode(ids)
                out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), len(back)))
            columns = zip(*out, strict=True) if out else ((), (), (), ())
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(digests, schema)


def bpe_encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, offsets: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, ids array<int> and, if asked for, starts and ends (code points) of every token."""
    make = _coder(docs.sparkSession, path, pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = make()
        for batch in batches:
            ids, starts, ends = [], [], []
            for text in batch.column(1):
                text = text.as_py()
                found = coder.encode(text)
                ids.append(np.frombuffer(found, "<i4"))
                if offsets:
                    spans = coder.offsets(text, found)
                    starts.append(spans[:, 0])
                    ends.append(spans[:, 1])
            columns = [pa.array(ids, pa.list_(pa.int32()))]
            columns += [pa.array([x.astype(np.int32) for x in c], pa.list_(pa.int32())) for c in (starts, ends)] if offsets else []
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "ids", "starts", "ends"][: len(columns) + 1])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>" + ", starts array<int>, ends array<int>" * offsets
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(encode, schema)


def bpe_decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) back to doc_id and bytes; NULL ids give no bytes. Ids outside the table fail."""
    make = _coder(encoded.sparkSession, path, None)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = make()
        for batch in batches:
            out = [coder.decode(np.array(x.as_py() or [], "<u4").tobytes()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    schema = f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, bytes binary"
    return encoded.select("doc_id", F.col("ids")).mapInArrow(decode, schema)
