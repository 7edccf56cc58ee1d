"""Byte-level BPE with the ``tokenizers`` library over Arrow batches.

A vocabulary is a rank file (base64 token, rank).  Its merges follow from the ranks,
so one string built on the driver, bounded by the vocabulary, holds the tokenizer.
Each match of the split pattern is encoded apart; equal matches are encoded once per
batch of texts and kept in a bounded memo of the worker.
"""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterable
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from .common import Rows, give_back, sha256_hex, sliced, tidied

#: Most split pieces that a worker remembers.
MEMO = 200_000
#: Characters over which the pieces of a text are not held all at once.
LONG = 1 << 19
_loaded: dict[str, "Codec"] = {}


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next above 255."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _halves(token: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """The tokenizer that merges by these ranks: a token's merge is the pair its bytes end in under lower ranks."""
    chars = byte_chars()
    spell = lambda token: "".join(chars[b] for b in token)
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) > 1:
            parts = _halves(token, ranks, rank)
            if len(parts) != 2:
                raise ValueError(f"rank {rank} can't be reached by merges")
            merges.append((spell(parts[0]), spell(parts[1])))
    own = Tokenizer(models.BPE(vocab={spell(t): r for t, r in ranks.items()}, merges=merges))
    own.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return own.to_str()


class Codec:
    """Encodes and decodes texts; ``pattern`` is the split pattern with white space by its Unicode property."""

    def __init__(self, spec: str, pattern: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        back = {c: b for b, c in enumerate(byte_chars())}
        self.bytes_of = {i: bytes(back[c] for c in t) for t, i in self.tokenizer.get_vocab().items()}
        self.memo: dict[str, bytes] = {}

    @staticmethod
    def get(spec: str, pattern: str) -> "Codec":
        key = sha256_hex(f"{spec}\0{pattern}".encode())
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = Codec(spec, pattern)
            give_back()  # what reading the merges took
        return _loaded[key]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """The memo with all these pieces; when full, it keeps what these texts use of it."""
        memo = self.memo
        new = [p for p in pieces if p not in memo]
        if len(memo) + len(new) > MEMO:
            memo = self.memo = {p: memo[p] for p in pieces if p in memo}
        for at in range(0, len(new), 1024):
            part = new[at : at + 1024]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            cuts = np.searchsorted(np.asarray(found.word_ids, np.int64), np.arange(len(part) + 1)) * 4
            packed = np.asarray(found.ids, "<u4").tobytes()
            cuts = cuts.tolist()
            memo.update((p, packed[i:j]) for p, i, j in zip(part, cuts, cuts[1:], strict=False))
        return memo

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.  Of a very long text few pieces are held at a time."""
        if len(texts) == 1 and len(texts[0]) > LONG:
            pieces = (m[0] for m in self.split.finditer(texts[0]))
            return [b"".join(self._joined(part) for part in iter(lambda: list(islice(pieces, 1 << 16)), []))]
        split = [self.split.findall(t) for t in texts]
        memo = self._learn(set(chain.from_iterable(split)))
        return [b"".join([memo[p] for p in pieces]) for pieces in split]

    def _joined(self, pieces: list[str]) -> bytes:
        memo = self._learn(set(pieces))
        return b"".join([memo[p] for p in pieces])

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(x, "<u4").tolist() for x in self.packed(texts)]

    def with_offsets(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """Ids with the first and one past the last character of each; tokens that part a character share it."""
        ids, begin, end = [], [], []
        found = [(m.start(), m[0]) for m in self.split.finditer(text)]
        for part in (found[at : at + 1024] for at in range(0, len(found), 1024)):
            got = self.tokenizer.encode([p for _, p in part], is_pretokenized=True, add_special_tokens=False)
            starts = [part[w][0] for w in got.word_ids]
            ids += got.ids
            begin += [at + a for at, (a, _) in zip(starts, got.offsets, strict=True)]
            end += [at + b for at, (_, b) in zip(starts, got.offsets, strict=True)]
        return ids, begin, end

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_parts(self, ids: Iterable[int]) -> list[str]:
        """The text each id adds; an id that ends inside a character adds nothing until that is whole."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        parts = [reader.decode(self.bytes_of[i]) for i in ids]
        rest = reader.decode(b"", True)
        return [*parts[:-1], parts[-1] + rest] if parts else []


def _texts(column: pa.Array, most: int = 100, size: int = 1 << 18) -> Iterable[list[str]]:
    """The texts in lists of at most ``most`` and of about ``size`` bytes, so that the pieces of few are held at a time;
    a longer text is in a list of its own."""
    at = held = 0
    for i, n in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
        if i > at and (i - at == most or held + n > size):
            yield [t or "" for t in column.slice(at, i - at).to_pylist()]
            at, held = i, 0
        held += n
    if at < len(column):
        yield [t or "" for t in column.slice(at).to_pylist()]


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: the id column as ``row_id``, ``ids``, ``char_begin``, ``char_end``.

    A null text is empty and gives empty lists; repeated rows each give a row; other columns play no part.
    """
    spec = tokenizer_json(read_ranks(ranks_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        codec = Codec.get(spec, pattern)
        for b in sliced(batches, 1000):
            rows = [codec.with_offsets(t) for part in _texts(b.column(1)) for t in part]
            own = [pa.array([r[k] for r in rows], pa.list_(pa.int32())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), *own], ["row_id", "ids", "char_begin", "char_end"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(f"`{id_col}`").alias("row_id"), F.col(f"`{text}`").alias("text")).mapInArrow(tidied(run), f"row_id {kind}, ids array<int>, char_begin array<int>, char_end array<int>")


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", id_col: str = "row_id") -> DataFrame:
    """``row_id``, the decoded ``bytes``, and ``text`` with what is no UTF-8 replaced; null ids decode as none."""
    spec = tokenizer_json(read_ranks(ranks_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        codec = Codec.get(spec, "")
        for b in sliced(batches, 1000):
            raw = [codec.decode(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())], ["row_id", "bytes", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(f"`{id_col}`").alias("row_id"), F.col(f"`{ids}`").alias("ids")).mapInArrow(tidied(run), f"row_id {kind}, bytes binary, text string")


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encodes, decodes the ids, and keeps digests only: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The ids never leave the worker, so the shuffle-free job moves texts in and digests out.
    Null texts are empty: no tokens, and the digests of no bytes.
    """
    spec = tokenizer_json(read_ranks(ranks_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        codec = Codec.get(spec, pattern)
        for b in sliced(batches, 1000):
            n, own, back = [], [], []
            for part in _texts(b.column(1)):
                for packed in codec.packed(part):
                    n.append(len(packed) // 4)
                    own.append(sha256_hex(packed))
                    back.append(sha256_hex(codec.decode(np.frombuffer(packed, "<u4").tolist())))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            give_back()
        del codec
        _loaded.clear()  # what follows in a worker has no use for it

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(tidied(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
