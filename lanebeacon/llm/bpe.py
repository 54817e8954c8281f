"""Byte-level BPE: whole texts to token ids and back.

Texts are cut into pieces by the tokenizer's pattern. A task collects the different pieces
of a block of texts, and those it has not met before go through one replay of
all merges (``merges.Merges``); a text's ids are then put together from its pieces. Nothing is
shuffled, a task holds one block and a bounded table of pieces, and a lost task
starts again from its input.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lanebeacon.llm.common import small_batches, table
from lanebeacon.llm.merges import Merges

# Bytes of texts whose new pieces are merged together, characters from which a text is cut into
# pieces bit by bit, and pieces that a task remembers.
BLOCK_BYTES = 4 << 20
BLOCK_CHARS = 2_000_000
KNOWN_PIECES = 150_000
# Ids whose text or bytes are put together at a time.
SPELLED_IDS = 1 << 16

# Below U+0250 the classes of letters, numbers and blanks can be written out, and then the
# faster of two regular expression engines can be used. U+001C to U+001F are blanks to it alone.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_OTHER_SCRIPT = re.compile("[\u0250-\U0010ffff\x1c-\x1f]")


class Pieces:
    """Cuts texts by a pattern of ``\\p{L}``, ``\\p{N}`` and ``\\s``."""

    def __init__(self, pattern: str):
        unicode_space = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self._any = regex.compile(unicode_space, regex.V0)
        written = pattern
        for name, members in ((r"\p{L}", _LETTERS), (r"\p{N}", _NUMBERS)):
            written = written.replace(f"[{name}]", f"[{members}]")
            written = re.sub(r"(\[\^?[^\]]*)" + re.escape(name), lambda m, x=members: m[1] + x, written)
            written = written.replace(name, f"[{members}]")
        self._latin = re.compile(written)

    def engine(self, text: str):
        latin = (text.isascii() and "\x1c" not in text and "\x1d" not in text and "\x1e" not in text and "\x1f" not in text)
        return self._latin if latin or not _OTHER_SCRIPT.search(text) else self._any

    def of(self, text: str) -> list[str]:
        return self.engine(text).findall(text)

    def parts(self, text: str, size: int) -> Iterator[list[str]]:
        """The pieces of a text, so many at a time."""
        found = (m.group() for m in self.engine(text).finditer(text))
        while part := list(itertools.islice(found, size)):
            yield part


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merges_of(ranks: dict[bytes, int]) -> Merges:
    """A pair merges if its bytes together are a token; the rank of the merge is that token."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left, right] = rank
    return Merges(pairs, np.arange(max(ranks.values()) + 1))


class _Table(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = place = len(self)
        return place


class Encoder:
    """Token ids of texts, as one task makes them. Merges are worked out once, on the driver, if they are given."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, merges: Merges | None = None):
        self._ranks, self._pieces, self._merges = ranks, Pieces(pattern), merges or merges_of(ranks)
        self._first = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self._forget()

    def _forget(self) -> None:
        self._place: dict[str, int] = _Table()
        self._ids = np.zeros(0, np.int32)
        self._starts = np.zeros(0, np.int64)
        self._counts = np.zeros(0, np.int64)

    def _places(self, pieces: list[str]) -> np.ndarray:
        """Places of pieces in the table; new ones get the next places, and their ids later."""
        return np.fromiter(map(self._place.__getitem__, pieces), dtype=np.int32, count=len(pieces))

    def _learn(self) -> None:
        """Ids of the new pieces. A piece that is a token is that token; the others are merged."""
        new = [piece.encode() for piece in itertools.islice(self._place, len(self._counts), None)]
        if not new:
            return
        whole = np.fromiter((self._ranks.get(piece, -1) for piece in new), dtype=np.int32, count=len(new))
        apart = [piece for piece, rank in zip(new, whole.tolist()) if rank < 0]
        first = self._first[np.frombuffer(b"".join(apart), np.uint8)]
        merged, parts = self._merges.replay(first, np.fromiter(map(len, apart), dtype=np.int64, count=len(apart)))
        counts = np.ones(len(new), np.int64)
        counts[whole < 0] = parts
        ids = np.empty(int(counts.sum()), np.int32)
        single = np.repeat(whole >= 0, counts)
        ids[single], ids[~single] = whole[whole >= 0], merged
        self._starts = np.append(self._starts, np.cumsum(counts) - counts + len(self._ids))
        self._counts = np.append(self._counts, counts)
        self._ids = np.append(self._ids, ids)

    def _spelled(self, places: np.ndarray) -> np.ndarray:
        counts = self._counts[places]
        ends = np.cumsum(counts)
        shift = np.repeat(self._starts[places] - (ends - counts), counts)
        return self._ids[shift + np.arange(len(shift))]

    def texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. All texts are cut first, then all new pieces merged together."""
        if len(self._place) > KNOWN_PIECES:
            self._forget()
        found = []
        for text in texts:
            if text and len(text) > BLOCK_CHARS:
                found.append(np.concatenate([self._places(p) for p in self._pieces.parts(text, BLOCK_CHARS // 4)]))
            else:
                found.append(self._places(self._pieces.of(text or "")))
        self._learn()
        return [self._spelled(places) for places in found]


class Decoder:
    """Bytes and digests of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        # The same bytes as the keys of ``ranks``, by id; an id without a token is an error.
        self._tokens = {rank: token for token, rank in ranks.items()}
        self._names = {rank: str(rank) for rank in ranks.values()}

    def spelled(self, ids: np.ndarray) -> Iterator[bytes]:
        for at in range(0, len(ids), SPELLED_IDS):
            yield b"".join(map(self._tokens.__getitem__, ids[at : at + SPELLED_IDS].tolist()))

    def bytes_digest(self, ids: np.ndarray) -> str:
        digest = hashlib.sha256()
        for part in self.spelled(ids):
            digest.update(part)
        return digest.hexdigest()

    def ids_digest(self, ids: np.ndarray) -> str:
        digest = hashlib.sha256()
        for at in range(0, len(ids), SPELLED_IDS):
            numbers = ",".join(map(self._names.__getitem__, ids[at : at + SPELLED_IDS].tolist()))
            digest.update(f",{numbers}".encode() if at else numbers.encode())
        return digest.hexdigest()


def _grouped(batches: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
    """Batches together up to about ``BLOCK_BYTES`` of text."""
    group, size = [], 0
    for batch in batches:
        group.append(batch)
        size += batch.nbytes
        if size >= BLOCK_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _ids_of(encoder: Encoder, batches: Iterator[pa.Array]) -> Iterator[list[np.ndarray]]:
    """Ids of the texts of each batch; the new pieces of several batches are merged together."""
    for group in _grouped(batches):
        found = iter(encoder.texts([text for batch in group for text in batch.to_pylist()]))
        for batch in group:
            yield list(itertools.islice(found, len(batch)))


def _id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.append(0, np.cumsum([len(i) for i in ids])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))


def encode_texts(docs: DataFrame, path: str, pattern: str, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``: the token ids of each whole text as an array of int.

    ``path`` is a file of ranks (a token in base64 and its id per line) that the driver can
    read; tasks get its content. NULL and empty texts have no ids. No special tokens are
    used: their strings are text like any other. Rows and other columns stay as they are.
    """
    given = _vocabulary(docs, path)

    @arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks, merges = given.value
        yield from map(_id_lists, _ids_of(Encoder(ranks, pattern, merges), batches))

    small_batches(docs.sparkSession)
    return docs.withColumn(ids_col, encode(F.col(text_col)))


def round_trip(docs: DataFrame, path: str, pattern: str, *, text_col: str = "text", coded_col: str = "coded") -> DataFrame:
    """``docs`` with ``coded_col``: ids, their number, their digest, and that of the bytes they decode to.

    A struct ``ids, n_tokens, ids_sha256, decoded_sha256``. One worker of a task encodes, and decodes what it has
    encoded; of the bytes only the digest leaves it. Otherwise like ``encode_texts``.
    """
    given = _vocabulary(docs, path)

    @arrow_udf("struct<ids:array<int>,n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks, merges = given.value
        decoder = Decoder(ranks)
        for ids in _ids_of(Encoder(ranks, pattern, merges), batches):
            columns = {
                "ids": _id_lists(ids),
                "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                "ids_sha256": pa.array([decoder.ids_digest(i) for i in ids], pa.string()),
                "decoded_sha256": pa.array([decoder.bytes_digest(i) for i in ids], pa.string()),
            }
            yield pa.StructArray.from_arrays(list(columns.values()), list(columns))

    small_batches(docs.sparkSession)
    return docs.withColumn(coded_col, code(F.col(text_col)))


def _vocabulary(docs: DataFrame, path: str):
    """Ranks, and the merges as sorted arrays, for all tasks."""
    ranks = read_ranks(path)
    return docs.sparkSession.sparkContext.broadcast((ranks, merges_of(ranks)))


def decode_ids(docs: DataFrame, path: str, *, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``docs`` with ``bytes_col``: the bytes that the ids stand for. NULL has none; an unknown id is an error."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    @arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(ranks.value)
        for batch in batches:
            yield pa.array([b"".join(decoder.spelled(ids.values.to_numpy())) if ids.is_valid else b"" for ids in batch], pa.binary())

    small_batches(docs.sparkSession)
    return docs.withColumn(bytes_col, decode(F.col(ids_col)))


def production() -> tuple[str, str]:
    """Path of the ranks and the pattern used by the registered query and the pipeline."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def digests(docs: DataFrame) -> DataFrame:
    """Number of ids, their digest and that of the bytes they decode to, of every row."""
    path, pattern = production()
    coded = round_trip(docs, path, pattern)
    return coded.select("doc_id", "coded.n_tokens", "coded.ids_sha256", "coded.decoded_sha256")


def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded."""
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))
