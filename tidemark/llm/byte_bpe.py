"""Byte-level BPE: exact merges in linear time by backtracking over longest matches.

Bytes are mapped to Latin-1 characters, so that one Aho-Corasick automaton over the vocabulary finds
every token of a piece. A token sequence is the merge result if and only if each two neighbours are
compatible, that is, merging their joint bytes gives just these two. So the encoder takes the longest
token at each position, falls back to shorter ones where it is not compatible with the one before, and
steps back over positions known to lead nowhere; no position is tried twice. Compatibility is memoised.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_arrow, slices

#: Half the entries that a worker process remembers, and the longest piece among them, in characters; the results do
#: not depend on either.
MEMO, MEMO_PIECE = 100_000, 64


class _Memo(dict):
    """Computes what it lacks with ``make``; holds up to twice ``limit`` entries, those used last."""

    def __init__(self, make, limit: int = MEMO):
        self.make, self._limit, self._older = make, limit, {}

    def __missing__(self, key):
        value = self._older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self._limit:
            self._older = self.copy()
            self.clear()
        self[key] = value
        return value


class BytePairCodec:
    """Encodes and decodes with ``ranks`` (bytes to id; the id is the merge rank too).

    Every single byte must be a token. ``pattern`` splits a text into pieces that are merged apart.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"The vocabulary lacks the bytes {missing[:5]}.")
        self._ranks = ranks
        self._findall = regex.compile(pattern).findall
        top = max(ranks.values()) + 1
        self._tokens = [b""] * top
        for token, i in ranks.items():
            self._tokens[i] = token
        self._sizes = list(map(len, self._tokens))
        self._bytes = np.frombuffer(b"".join(self._tokens), np.uint8)
        self._size = np.array(self._sizes, np.int64)
        self._start = np.cumsum(self._size) - self._size
        self._halves: dict[int, tuple[int, int]] = {}
        self._trie = ahocorasick.Automaton()
        for token, i in ranks.items():
            parts = self._merge(token, 2)
            if len(parts) == 2 and ranks.get(token) == i:
                if max(parts) >= i:
                    raise ValueError(f"Token {i} ranks before the tokens it is joined from.")
                self._halves[i] = (parts[0], parts[1])
            if len(parts) < 3:  # else no merge ever ends in it
                self._trie.add_word(token.decode("latin-1"), i)
        self._trie.make_automaton()
        self._shorter = _Memo(self._next_shorter, top)
        self._ends = _Memo(lambda i: self._chain(i, 1), top)
        self._begins = _Memo(lambda i: self._chain(i, 0), top)
        self._fits = _Memo(lambda pair: self._compatible(*pair))
        self._known = _Memo(lambda piece: array("i", self.encode_piece(piece.encode())).tobytes())

    def _merge(self, data: bytes, least: int = 1) -> list[int]:
        """The definition: join the neighbours of the lowest rank until none, or ``least`` parts, are left."""
        parts = [bytes([b]) for b in data]
        while len(parts) > least:
            rank, at = min(
                (self._ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
            )
            if rank == 1 << 62:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self._ranks[p] for p in parts]

    def _chain(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """What stands at one end of a token while it is joined, smallest first, and the rank that ends each."""
        chain = [(self._tokens[token], 1 << 62)]
        while token in self._halves:
            chain.append((self._tokens[self._halves[token][side]], token))
            token = self._halves[token][side]
        return chain[::-1]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether nothing is joined across the border while the two are joined, merges taken by rank.

        Of equal ranks the one further left is joined first.
        """
        ends, begins, i, j = self._ends[left], self._begins[right], 0, 0
        while True:
            (a, a_until), (b, b_until) = ends[i], begins[j]
            rank = self._ranks.get(a + b)
            if rank is not None and rank < a_until and rank <= b_until:
                return False
            if a_until <= b_until:
                i += 1
            else:
                j += 1
            if i == len(ends) or j == len(begins):
                return True

    def _next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        text = self._tokens[token].decode("latin-1")
        return next((self._trie.get(text[:n]) for n in range(len(text) - 1, 0, -1) if text[:n] in self._trie), -1)

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self._ranks.get(data)
        if whole is not None:
            return [whole]
        n, at, out = len(data), 0, []
        sizes, fits = self._sizes, self._fits
        longest = [-1] * (n + 1)
        for end, token in self._trie.iter(data.decode("latin-1")):
            longest[end + 1 - sizes[token]] = token  # of the same start, longer ones end later
        dead = bytearray(n + 1)
        token = longest[0]
        while at < n:
            end = at + sizes[token]
            if not dead[end] and (not out or fits[out[-1], token]):
                out.append(token)
                at = end
                token = longest[at]
                continue
            token = self._shorter[token]
            if token < 0:  # nothing fits here after what stands before
                dead[at] = 1
                token = out.pop()
                at -= sizes[token]
        return out

    def encode_raw(self, text: str) -> bytes:
        """The ids as 32-bit integers, one after the other."""
        known = self._known
        return b"".join(known[p] if len(p) <= MEMO_PIECE else known.make(p) for p in self._findall(text))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_raw(text), np.int32).tolist()

    def decode_all(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other."""
        sizes = self._size[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self._bytes[np.repeat(self._start[ids] - ends + sizes, sizes) + np.arange(total)]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where the bytes of each id begin, and where the last end."""
        return np.concatenate([[0], np.cumsum(self._size[ids])])

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_all(np.array(ids, np.int64)).tobytes()


@lru_cache(maxsize=2)
def load_codec(path: str, pattern: str) -> BytePairCodec:
    """One codec per worker process. ``path``: a rank file (base64 token, id) present on every node."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return BytePairCodec({base64.b64decode(a): int(b) for a, b in pairs}, pattern)


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_decoded: bool = False
) -> DataFrame:
    """The columns ``keep`` and ``token_ids`` (array of int) of every whole text; no shuffle.

    ``with_decoded`` adds ``decoded``, the bytes that the ids decode to, in the same pass. NULL and empty
    texts have no ids. Other columns are left out, also ones that are called like the new ones; equal rows
    give equal rows, an empty table an empty one.
    """
    source = df.select(*keep, F.col(text).alias("_text"))
    new = [T.StructField("token_ids", T.ArrayType(T.IntegerType(), False), False)]
    if with_decoded:
        new.append(T.StructField("decoded", T.BinaryType(), False))
    schema = T.StructType([*source.schema.fields[:-1], *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(path, pattern)
        for batch in slices(batches, "_text"):
            raw = [codec.encode_raw(t) if t else b"" for t in batch.column(batch.num_columns - 1).to_pylist()]
            ends = np.cumsum([0, *map(len, raw)]) // 4
            ids = np.frombuffer(b"".join(raw), np.int32)
            columns = [pa.ListArray.from_arrays(ends.astype(np.int32), ids)]
            if with_decoded:
                columns.append(_decoded(codec, ids, ends))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], schema.names)

    return map_arrow(source, run, schema)


def _decoded(codec: BytePairCodec, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of each run of ids between two of ``ends``."""
    data, bounds = codec.decode_all(ids).tobytes(), codec.offsets(ids)[ends].tolist()
    return pa.array([data[a:b] for a, b in zip(bounds, bounds[1:])], pa.binary())


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """All columns and ``decoded`` (binary), the bytes the ids stand for; NULL ids give no bytes."""
    source = df.drop("decoded")
    schema = T.StructType([*source.schema.fields, T.StructField("decoded", T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(path, pattern)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)  # without those of NULL lists
            decoded = _decoded(codec, flat, np.cumsum([0, *sizes]))
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], schema.names)

    return map_arrow(source, run, schema)
