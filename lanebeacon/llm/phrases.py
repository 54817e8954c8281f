"""Phrases whose words stand together more often than chance, by Rabin-Karp fingerprints.

Texts become blocks of one language: words separated by one blank, pieces by a line feed. Prefix
sums of a polynomial give every n-gram of a block its fingerprint. The fingerprints of single words and pairs are
cut to cells of 32 bits, dealt over buckets by the other bits, and go with a pointer to their block
through one shuffle, which adds up how often each cell occurs. A cell that is frequent goes back to the blocks it came
from, and only there. Each block then reads its text again: occurrences with one fingerprint are compared byte by byte,
and only n-grams in frequent cells become text. A second round does the same for longer n-grams, in what the
first leaves of the blocks: runs of words of which each pair of neighbours is frequent. The counts of phrases are added up
by the text itself, bucket by bucket, so that a collision can cost time but never changes a count.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lanebeacon.llm.common import shuffle_partitions, small_batches, stored, table
from lanebeacon.llm.words import mixed

# Fixed values of the query: words of a phrase, least occurrences, phrases of each language.
MOST_WORDS, LEAST, TOP = 5, 100, 2000
NO_LANG = "und"
# Bytes of text in a block, bytes of text for which one more bucket is made, and bytes compared at a time.
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
COMPARED = 1 << 20

# What ends a piece, and what a byte is: 0 part of a word, 1 blank, 2 end of a piece.
_BORDER = re.compile(rb"[.,;:!?\x0A-\x0D]")
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\v\f\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]
BLANK, END = 0x20, 0x0A

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def canonical(texts: list[bytes]) -> np.ndarray:
    """Bytes of the texts' words in lower case, a blank after each word and a line feed after the last of a piece."""
    content = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    kind = _KIND[content]
    inside = kind == 0
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    starts = np.flatnonzero(inside & np.append(True, ~inside[:-1]))
    borders = np.cumsum(kind == 2, dtype=np.int32)
    last = np.append(borders[starts[1:]] > borders[ends[:-1]], True)[: len(ends)]
    spelled = _LOWER[content]
    spelled[ends + 1] = np.where(last, END, BLANK)
    inside[ends + 1] = True
    return spelled[inside]


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts of whole pieces, which n-grams never leave. A single longer piece is one part."""
    begin = 0
    while len(text) - begin > BLOCK_BYTES:
        border = _BORDER.search(text, begin + BLOCK_BYTES)
        if not border:
            break
        yield text[begin : border.start()]
        begin = border.end()
    yield text[begin:]


def _packed(content: np.ndarray) -> bytes:
    return pa.compress(content.tobytes(), codec="zstd", asbytes=True)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, words, size, content`` of about ``BLOCK_BYTES`` of one language each."""
    waiting: dict[str, list[bytes]] = {}
    sizes: Counter[str] = Counter()

    def flushed(lang: str) -> Iterator[pa.RecordBatch]:
        del sizes[lang]
        content = canonical(waiting.pop(lang))
        if len(content):
            words = int(np.count_nonzero((content == BLANK) | (content == END)))
            yield pa.RecordBatch.from_pydict({"lang": [lang], "words": [words], "size": [len(content)], "content": [_packed(content)]})

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part in _parts(text.as_buffer().to_pybytes()):
                waiting.setdefault(lang, []).append(part)
                sizes[lang] += len(part) + 1
                if sizes[lang] >= BLOCK_BYTES:
                    yield from flushed(lang)
            # Many languages at once: the largest goes first.
            if sizes.total() >= 4 * BLOCK_BYTES:
                yield from flushed(max(sizes, key=sizes.__getitem__))
    for lang in list(waiting):
        yield from flushed(lang)


class _Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))


_POWERS = _Powers()


class Grams:
    """The n-grams of a block: where they stand, and their fingerprints."""

    def __init__(self, content: bytes, lang: str):
        self.content = np.frombuffer(content, dtype=np.uint8)
        # Every word is followed by one separator.
        self.ends = np.flatnonzero((self.content == BLANK) | (self.content == END))
        self.starts = np.append(0, self.ends[:-1] + 1)
        words = np.arange(len(self.ends))
        last = np.flatnonzero(self.content[self.ends] == END)
        #: Words from each one to the last of its piece.
        self.room = last[np.searchsorted(last, words)] - words + 1
        self._salt = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))
        n = len(self.content) + 1
        _POWERS.upto(n)
        self._sums = np.zeros(n, np.uint64)
        np.cumsum((self.content.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: n - 1], out=self._sums[1:])

    def of(self, n: int) -> np.ndarray:
        """First words of all n-grams of ``n`` words."""
        return np.flatnonzero(self.room >= n)

    def prints(self, first: np.ndarray, n: int) -> np.ndarray:
        starts, ends = self.starts[first], self.ends[first + n - 1]
        return mixed((self._sums[ends] - self._sums[starts]) * _POWERS.down[starts] ^ self._salt)

    def counted(self, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """One occurrence of each different n-gram among those at ``first``, and how many there are."""
        prints = self.prints(first, n)
        order = np.argsort(prints, kind="stable")
        first, prints = first[order], prints[order]
        head = np.append(True, prints[1:] != prints[:-1])[: len(first)]
        group = np.cumsum(head) - 1
        wrong = self._differing(first, first[head][group], n)
        counts = np.bincount(group)
        if not wrong.any():
            return first[head], counts
        # Texts that share a fingerprint: the groups they are in are taken apart by text.
        mixed_up = np.isin(group, group[wrong])
        apart: dict[bytes, list[int]] = {}
        for word in first[mixed_up].tolist():
            found = apart.setdefault(self.content[self.starts[word] : self.ends[word + n - 1]].tobytes(), [word, 0])
            found[1] += 1
        clean = np.ones(len(counts), dtype=bool)
        clean[group[wrong]] = False
        one, many = np.array(list(apart.values()), dtype=np.int64).T
        return np.append(first[head][clean], one), np.append(counts[clean], many)

    def _differing(self, first: np.ndarray, model: np.ndarray, n: int) -> np.ndarray:
        """Which n-grams differ in their bytes from the n-gram at ``model``."""
        lengths = self.ends[first + n - 1] - self.starts[first]
        wrong = lengths != self.ends[model + n - 1] - self.starts[model]
        looked = np.flatnonzero(~wrong & (first != model))
        cuts = np.searchsorted(np.cumsum(lengths[looked]), np.arange(0, lengths[looked].sum(), COMPARED))
        for a, b in zip(cuts, [*cuts[1:], len(looked)]):
            rows = looked[a:b]
            if not len(rows):
                continue
            own, other = (self.content[_flat(self.starts[of[rows]], lengths[rows])] for of in (first, model))
            begins = np.cumsum(lengths[rows]) - lengths[rows]
            wrong[rows] = np.add.reduceat(own != other, begins, dtype=np.int64) > 0
        return wrong

    def spelled(self, first: np.ndarray, n: int) -> pa.Array:
        lengths = self.ends[first + n - 1] - self.starts[first]
        offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
        content = self.content[_flat(self.starts[first], lengths)]
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.tobytes()), pa.py_buffer(content.tobytes()))


def _flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of stretches, one stretch after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _cells(prints: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.uint64(buckets)
    return (prints % n).astype(np.int64), ((prints // n) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _sum_cells(blocks: DataFrame, sizes: Sequence[int], buckets: int, least: int) -> DataFrame:
    """``block, bucket, cells``: the cells of each block's n-grams that ``least`` occurrences or more fall in."""
    # A count at the threshold says enough.
    small = np.min_scalar_type(least)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, size, content in zip(*(column.to_pylist() for column in batch.columns)):
                grams = Grams(pa.decompress(content, size, codec="zstd", asbytes=True), lang)
                prints = np.concatenate([grams.prints(grams.of(n), n) for n in sizes])
                prints, counts = np.unique(prints, return_counts=True)
                bucket, cell = _cells(prints, buckets)
                order = np.argsort(bucket, kind="stable")
                bucket, cell, counts = bucket[order], cell[order], np.minimum(counts[order], least).astype(small)
                heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                ends = [*heads[1:].tolist(), len(bucket)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(bucket[heads], pa.int64()),
                        "block": pa.array([block] * len(heads), pa.int64()),
                        "cells": pa.array([cell[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
                        "counts": pa.array([counts[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
                    }
                )

    def summed(rows: pa.Table) -> pa.Table:
        cells = [np.frombuffer(cell, np.uint32) for cell in rows["cells"].to_pylist()]
        counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), small)
        joined = np.concatenate(cells)
        order = np.argsort(joined, kind="stable")
        sorted_cells = joined[order]
        heads = np.flatnonzero(np.append(True, sorted_cells[1:] != sorted_cells[:-1]))
        enough = np.add.reduceat(counts[order], heads, dtype=np.int64) >= least
        kept = np.zeros(len(joined), dtype=bool)
        kept[order] = np.repeat(enough, np.diff(np.append(heads, len(joined))))
        ends = np.cumsum([len(cell) for cell in cells])
        back = [cell[kept[end - len(cell) : end]].tobytes() for cell, end in zip(cells, ends)]
        some = pa.array([bool(b) for b in back])
        out = {"block": rows["block"], "bucket": rows["bucket"], "cells": pa.array(back, pa.binary())}
        return pa.table(out).filter(some)

    cells = blocks.select("block", "lang", "size", "content").mapInArrow(sent, "bucket bigint, block bigint, cells binary, counts binary")
    return cells.groupBy("bucket").applyInArrow(summed, "block bigint, bucket bigint, cells binary")


_COUNTED = "bucket bigint, lang string, phrases array<string>, counts array<bigint>, size bigint, content binary"
_COUNTED_SCHEMA = pa.schema(
    [
        ("bucket", pa.int64()),
        ("lang", pa.string()),
        ("phrases", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
        ("size", pa.int64()),
        ("content", pa.binary()),
    ]
)


def _followed(blocks: DataFrame, frequent: DataFrame, sizes: Sequence[int], buckets: int, go_on: bool) -> DataFrame:
    """``bucket, lang, phrases, counts`` of the n-grams in frequent cells of each block, and ``lang, size, content`` of what is left of it.

    A block has one row for each bucket. After the round of pairs, longer n-grams can only be frequent in what is
    left (``_runs``), which is a block as well; ``go_on`` asks for it.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, size, content, known in zip(*(column.to_pylist() for column in batch.columns)):
                grams = Grams(pa.decompress(content, size, codec="zstd", asbytes=True), lang)
                keys = [(np.int64(k["bucket"]) << 32) | np.frombuffer(k["cells"], np.uint32).astype(np.int64) for k in known]
                keys = np.sort(np.concatenate(keys))
                there, phrases, counts, dealt = None, [], [], []
                for n in sizes:
                    # Both parts without the last and without the first word have to be there.
                    first = grams.of(n)
                    first = first if there is None else first[there[first] & there[first + 1]]
                    bucket, cell = _cells(grams.prints(first, n), buckets)
                    key = (bucket << 32) | cell.astype(np.int64)
                    first = first[keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key]
                    there = np.zeros(len(grams.room) + 1, dtype=bool)
                    there[first] = True
                    if not len(first):
                        break
                    one, many = grams.counted(first, n)
                    phrases.append(grams.spelled(one, n))
                    counts.append(many)
                    dealt.append(_cells(grams.prints(one, n), buckets)[0])
                if phrases:
                    yield _by_bucket(lang, pa.concat_arrays(phrases), np.concatenate(counts), np.concatenate(dealt))
                rest = _runs(grams, there) if go_on else ()
                if len(rest):
                    row = {"lang": lang, "size": len(rest), "content": _packed(rest)}
                    yield pa.RecordBatch.from_pylist([row], schema=_COUNTED_SCHEMA)

    return frequent.join(blocks, "block").select("lang", "size", "content", "known").mapInArrow(counted, _COUNTED)


def _by_bucket(lang: str, phrases: pa.Array, counts: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    offsets = pa.array(np.append(heads, len(bucket)).astype(np.int32))
    columns = [
        pa.array(bucket[heads]),
        pa.array([lang] * len(heads), pa.string()),
        pa.ListArray.from_arrays(offsets, phrases.take(pa.array(order))),
        pa.ListArray.from_arrays(offsets, pa.array(counts[order], pa.int64())),
        pa.nulls(len(heads), pa.int64()),
        pa.nulls(len(heads), pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_COUNTED_SCHEMA)


def _summed(counted: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, occurrences`` of the phrases that occur ``least`` times, added up by their text bucket by bucket."""

    def add(rows: pa.Table) -> pa.Table:
        inside = pc.list_parent_indices(rows["phrases"])
        each = pa.table({"lang": rows["lang"].take(inside), "phrase": pc.list_flatten(rows["phrases"]), "n": pc.list_flatten(rows["counts"])})
        total = each.group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        total = total.filter(pc.greater_equal(total["n_sum"], least))
        return pa.table({"lang": total["lang"], "phrase": total["phrase"], "occurrences": total["n_sum"]})

    return counted.groupBy("bucket").applyInArrow(add, "lang string, phrase string, occurrences bigint")


def _runs(grams: Grams, pair: np.ndarray) -> np.ndarray:
    """The words of a block in runs of three or more in which every pair is frequent; ``pair`` says which words begin one."""
    both = np.flatnonzero(pair[:-1] & pair[1:])
    kept = np.zeros(len(grams.room), dtype=bool)
    for shift in range(3):
        kept[both + shift] = True
    words = np.flatnonzero(kept)
    spelled = grams.content.copy()
    spelled[grams.ends[words]] = np.where(pair[words], BLANK, END)
    return spelled[_flat(grams.starts[words], grams.ends[words] + 1 - grams.starts[words])]


def frequent_phrases(
    docs: DataFrame, *, least: int = LEAST, most_words: int = MOST_WORDS, text_col: str = "text", lang_col: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """``lang, n_words, phrase, occurrences`` of all phrases with ``least`` occurrences, and ``lang, n`` words.

    Words and pieces are those of whole texts; ``NO_LANG`` stands for a NULL language. NULL and empty texts
    and texts without words add nothing, repeated rows count each time. Other columns are not looked at.
    An empty table gives two empty results.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(docs[lang_col], F.lit(NO_LANG)).alias("lang"), docs[text_col].alias("text"))
    cut = rows.where("text is not null and text != ''").mapInArrow(_blocks, "lang string, words bigint, size bigint, content binary")
    # The number of a block is written down with it, so that it is the same whenever the block is read again.
    blocks = stored(cut.withColumn("block", F.monotonically_increasing_id()), "phrase-blocks")
    short, long = range(1, min(2, most_words) + 1), range(3, most_words + 1)
    found = _round(blocks, short, least, bool(long))
    columns = ["bucket", "lang", "phrases", "counts"]
    counted = found.where("bucket is not null").select(*columns)
    if long:
        found = stored(found.withColumn("block", F.monotonically_increasing_id()), "phrase-counts")
        longer = _round(found.where("bucket is null"), long, least, False)
        counted = found.where("bucket is not null").select(*columns).unionByName(longer.select(*columns))
    n_words = F.size(F.split("phrase", " ")).alias("n_words")
    frequent = stored(_summed(counted, least).select("lang", n_words, "phrase", "occurrences"), "phrases")
    return frequent, blocks.groupBy("lang").agg(F.sum("words").alias("n"))


def _round(blocks: DataFrame, sizes: Sequence[int], least: int, go_on: bool) -> DataFrame:
    """Counts of the n-grams of ``sizes`` words, and what is left of the blocks."""
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(shuffle_partitions(blocks.sparkSession), -(-total // BUCKET_BYTES))
    cells = _sum_cells(blocks, sizes, buckets, least).groupBy("block").agg(F.collect_list(F.struct("bucket", "cells")).alias("known"))
    return _followed(blocks.select("block", "lang", "size", "content"), cells, sizes, buckets, go_on)


def _stretch(words: Column, begin: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def collocations(
    docs: DataFrame,
    *,
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of two words or more of each language.

    A phrase is cut in two where that scores lowest, and scores 1000 times how many times as often it occurs as its
    parts would meet by chance, rounded down. A phrase that always stands inside the same longer one is left
    out. All arithmetic is in whole numbers of 38 digits. Ties go by occurrences, then by the phrase's bytes.
    """
    frequent, totals = frequent_phrases(docs, least=least, most_words=most_words, text_col=text_col, lang_col=lang_col)
    words = F.split("phrase", " ")
    phrases = frequent.where("n_words >= 2").select("lang", "phrase", F.col("occurrences").alias("a"), "n_words", words.alias("words"))
    # Phrases inside a longer one that occurs as often.
    begins = F.explode(F.sequence(F.lit(1), F.col("n_words") - 1))
    inner = (
        phrases.where("n_words >= 3")
        .select("lang", "a", "words", "n_words", begins.alias("begin"))
        .select("*", F.explode(F.sequence(F.lit(2), F.least(F.col("n_words") - 1, F.col("n_words") - F.col("begin") + 1))).alias("length"))
        .select("lang", _stretch(F.col("words"), F.col("begin"), F.col("length")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("around"))
    )
    open_ones = phrases.join(inner, ["lang", "phrase"], "left").where("around is null or around < a")
    cuts = open_ones.select("lang", "phrase", "a", "words", F.col("n_words").alias("size"), begins.alias("k")).select(
        "lang",
        "phrase",
        "a",
        "k",
        _stretch(F.col("words"), F.lit(1), F.col("k")).alias("first"),
        _stretch(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    known = frequent.select("lang", F.col("phrase").alias("part"), "occurrences")
    both = (
        cuts.join(known.withColumnsRenamed({"part": "first", "occurrences": "l"}), ["lang", "first"])
        .join(known.withColumnsRenamed({"part": "rest", "occurrences": "r"}), ["lang", "rest"])
        .join(totals, "lang")
    )
    wide = {name: F.col(name).cast("decimal(19,0)") for name in ("a", "l", "r", "n")}
    expected = (F.lit(1000).cast("decimal(4,0)") * wide["a"]).cast("decimal(23,0)") * wide["n"].cast("decimal(15,0)")
    score = F.call_function("div", expected.cast("decimal(38,0)"), (wide["l"] * wide["r"]).cast("decimal(38,0)"))
    best = both.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    scored = best.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    found = collocations(table(spark, sf_dir, "documents").select("lang", "text"))
    return found.withColumn("rank", F.col("rank").cast("bigint"))


OP13_SQL = """
with recursive texts as (
  select coalesce(lang, 'und') as lang, translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
pieces as (select lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') as w from texts),
totals as (select lang, cast(sum(len(w)) as bigint) as n from pieces group by lang),
spots as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces),
grams as (select lang, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) as k, w from spots),
counted as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f from grams group by all having count(*) >= 100),
phrases as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counted where k >= 2),
begins as (select lang, k, a, w, unnest(range(1, k + 1)) as b from phrases where k >= 3),
inner_ones as (select lang, k, a, w, b, unnest(range(2, least(k - 1, k - b + 1) + 1)) as m from begins),
around as (select lang, array_to_string(w[b:b + m - 1], ' ') as phrase, max(a) as around from inner_ones group by all),
open_ones as (
  select p.* from phrases p left join around o on p.lang = o.lang and p.phrase = o.phrase where o.around is null or 100 * o.around < 100 * p.a),
cuts as (select lang, phrase, a, w, k, unnest(range(1, k)) as c from open_ones),
parts as (select lang, phrase, a, c, array_to_string(w[1:c], ' ') as p1, array_to_string(w[c + 1:k], ' ') as p2 from cuts),
scored as (
  select parts.lang, parts.phrase, a, c, x.f as l, y.f as r, n,
         cast((1000 * a::hugeint * n) // (x.f::hugeint * y.f) as bigint) as score
  from parts join counted x on x.lang = parts.lang and x.phrase = p1 join counted y on y.lang = parts.lang and y.phrase = p2
  join totals on totals.lang = parts.lang),
lowest as (select *, row_number() over (partition by lang, phrase order by score, c) as place from scored),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest where place = 1)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000"""
