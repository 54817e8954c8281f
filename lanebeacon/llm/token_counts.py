"""Token counts with a shortcut for words that are one token.

Before any text is read, every string of the vocabulary that can stand for a whole word is put
through the merges; those that come out as one token are proven whole. A piece of text among them counts
1 without further work. Only the other pieces of a block are merged, all
together and each once, and their counts remembered in a bounded table.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lanebeacon.llm.bpe import BLOCK_CHARS, KNOWN_PIECES, Pieces
from lanebeacon.llm.common import small_batches, table
from lanebeacon.llm.merges import Merges

LIMIT = 2048
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes for themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Counter:
    """Token counts of texts, as one task makes them, from the content of a tokenizer file.

    The file has to describe byte letters, an end-of-word suffix, one pattern whose matches
    are the pieces, and a text form of NFC, blanks and lower case.
    """

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        forms = [part["type"] for part in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or forms != ["NFC", "Replace", "Lowercase"] or not split["invert"]:
            raise ValueError("not a tokenizer of this kind")
        self._special = [token["content"] for token in spec["added_tokens"]]
        self._at_special = re.compile("|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) or r"(?!)")
        self._pieces = Pieces(split["pattern"]["Regex"])
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self._inner = np.array([vocab[letter] for letter in letters], dtype=np.int32)
        self._last = np.array([vocab[letter + suffix] for letter in letters], dtype=np.int32)
        merged = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pairs = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(merged)}
        self._merges = Merges(pairs, np.array([vocab[a + b] for a, b in merged]))
        self._whole = self._proven(vocab, suffix, {letter: b for b, letter in enumerate(letters)})
        self._known: dict[str, int] = dict.fromkeys(self._whole, 1)

    def _proven(self, vocab: dict[str, int], suffix: str, byte_of: dict[str, int]) -> list[str]:
        """Words of the vocabulary that are one token when they stand alone."""
        words, spelled = [], []
        for token in vocab:
            if token.endswith(suffix) and token != suffix and token not in self._special:
                try:
                    word = bytes(byte_of[letter] for letter in token[: -len(suffix)])
                    words.append(word.decode())
                    spelled.append(word)
                except (KeyError, UnicodeDecodeError):
                    continue  # part of a character, so never a piece of text
        counts = self._replay(spelled)
        return [word for word, count in zip(words, counts.tolist()) if count == 1]

    @property
    def whole(self) -> list[str]:
        """The words that are proven to be one token."""
        return self._whole

    def _replay(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens of each word when all merges are applied."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        codes = np.frombuffer(b"".join(words), np.uint8)
        tokens, ends = self._inner[codes], np.cumsum(lengths) - 1
        tokens[ends] = self._last[codes[ends]]
        return self._merges.replay(tokens, lengths)[1]

    @staticmethod
    def _form(text: str) -> str:
        text = _SPACES.sub(" ", unicodedata.normalize("NFC", text))
        # Lower case letter by letter: a sigma at the end of a word is like any other.
        return text.replace("Σ", "σ").lower()

    def _count(self, pieces: list[str]) -> list[int]:
        if len(self._known) > KNOWN_PIECES + len(self._whole):
            self._known = dict.fromkeys(self._whole, 1)
        rest = sorted(set(pieces).difference(self._known))
        if rest:
            counts = self._replay([piece.encode() for piece in rest])
            self._known.update(zip(rest, counts.tolist()))
        return list(map(self._known.__getitem__, pieces))

    def texts(self, texts: list[str | None]) -> Iterator[int]:
        """The number of tokens of each text."""
        block: list[tuple[int, list[str]]] = []
        chars = 0

        def done() -> Iterator[int]:
            sums = np.append(0, np.cumsum(self._count([piece for _, pieces in block for piece in pieces]), dtype=np.int64))
            ends = np.cumsum([0, *(len(pieces) for _, pieces in block)])
            for (special, _), n in zip(block, np.diff(sums[ends]).tolist()):
                yield special + n

        for text in texts:
            text = text or ""
            if block and chars + len(text) > BLOCK_CHARS:
                yield from done()
                block, chars = [], 0
            stretches = self._at_special.split(text) if "<|" in text else [text]
            special = len(stretches) - 1
            if len(text) > BLOCK_CHARS:
                parts = (part for s in stretches for part in self._pieces.parts(self._form(s), BLOCK_CHARS // 4))
                yield special + sum(sum(self._count(part)) for part in parts)
            else:
                block.append((special, [piece for s in stretches for piece in self._pieces.of(self._form(s))]))
                chars += len(text)
        if block:
            yield from done()


def count_tokens(docs: DataFrame, path: str, *, text_col: str = "text", count_col: str = "n_tokens") -> DataFrame:
    """``docs`` with ``count_col``, the number of tokens of each whole text.

    ``path`` is a tokenizer file that the driver can read; tasks get its content. NULL and
    empty texts have none. Special strings inside a text count as their one token, none are
    added. Rows and other columns stay as they are.
    """
    with open(path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    @arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(definition.value)
        for batch in batches:
            counts: list[int] = []
            for start in range(0, len(batch), 1024):
                counts.extend(counter.texts(batch.slice(start, 1024).to_pylist()))
            yield pa.array(counts, pa.int64())

    small_batches(docs.sparkSession)
    return docs.withColumn(count_col, count(F.col(text_col)))


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text, and whether the tokens exceed ``LIMIT``."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )
