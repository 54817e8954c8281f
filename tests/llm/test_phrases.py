"""Phrase collocations against plain counting, and on odd tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from lanebeacon.llm import phrases

SCHEMA = "lang string, text string"


def pieces(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def plain(rows, least, top, most=5):
    """The definition, word for word."""
    totals, counts = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + n])) for n in range(1, most + 1) for i in range(len(words) - n + 1))
    found = {}
    for (lang, words), a in counts.items():
        if len(words) >= 2 and a >= least:
            cuts = []
            for k in range(1, len(words)):
                l, r = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            found[lang, words] = (a, l, r, totals[lang], score)
    hidden = set()
    for (lang, words), (a, *_) in found.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                inner = (lang, words[i : i + n])
                if inner in found and a >= found[inner][0]:
                    hidden.add(inner)
    result = []
    for lang in totals:
        own = [(-v[4], -v[0], " ".join(w).encode(), v) for (x, w), v in found.items() if x == lang and (x, w) not in hidden]
        result += [(lang, i, p.decode(), *v) for i, (_, _, p, v) in enumerate(sorted(own)[:top], 1)]
    return sorted(result)


def mined(df, **options):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(row) for row in phrases.collocations(df, **options).select(columns).collect())


def made_up(seed, n):
    chance = random.Random(seed)
    words = ["the", "The", "a", "ünï", "x" * 40, "日本", "b\x85c", "(d)", "of", "one"]
    ends = [" ", " ", " ", "\t", "  ", " \t", ". ", ",", "\n", "\r\n", "\x0b", "\x0c!"]
    text = lambda: "".join(chance.choice(words) + chance.choice(ends) for _ in range(chance.randrange(60)))
    return [(chance.choice(["en", "en", "en", None, "", "und"]), text()) for _ in range(n)]


@pytest.mark.parametrize("least, top", [(3, 2000), (20, 7)])
def test_collocations_equal_plain_counting(spark, monkeypatch, least, top):
    rows = made_up(least, 150)
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 2000)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(5), least=least, top=top) == plain(rows, least, top)


def test_blocks_do_not_change_the_words(monkeypatch):
    rows = made_up(1, 200) + [("en", "long text, " * 500), ("en", "no end " * 500)]
    expected = Counter((lang or "und", tuple(w)) for lang, text in rows for w in pieces(text) if w)
    for size in (10, 1000, 1 << 20):
        monkeypatch.setattr(phrases, "BLOCK_BYTES", size)
        batch = pa.RecordBatch.from_pydict({"lang": [lang or "und" for lang, _ in rows], "text": [text for _, text in rows]})
        found = Counter()
        for block in phrases._blocks(iter([batch])):
            (row,) = block.to_pylist()
            content = pa.decompress(row["content"], row["size"], codec="zstd", asbytes=True)
            lines = content.decode().split("\n")[:-1]
            assert row["words"] == sum(len(line.split(" ")) for line in lines)
            found.update((row["lang"], tuple(line.split(" "))) for line in lines)
        assert found == expected


def test_collisions_are_taken_apart(monkeypatch):
    """With fingerprints of two bits nearly all n-grams collide; counts stay those of the texts."""
    content = phrases.canonical([b"a b a b a c, c a b dd", b"dd a b"])
    plainly = phrases.Grams(content.tobytes(), "en")
    monkeypatch.setattr(phrases, "mixed", lambda x: x & np.uint64(3))
    colliding = phrases.Grams(content.tobytes(), "en")
    for n in (1, 2, 3):
        first = colliding.of(n)
        one, many = colliding.counted(first, n)
        counts = dict(zip(colliding.spelled(one, n).to_pylist(), many.tolist()))
        texts = [" ".join(w[i : i + n]) for w in ("a b a b a c".split(), "c a b dd".split(), "dd a b".split()) for i in range(len(w) - n + 1)]
        assert counts == Counter(texts) and len(one) == len(counts)
    assert plainly.of(5).tolist() == [0, 1]


def test_runs_keep_every_longer_candidate():
    chance = random.Random(5)
    for _ in range(200):
        lines = [[chance.choice("abc") for _ in range(chance.randrange(1, 9))] for _ in range(4)]
        content = "".join(" ".join(line) + "\n" for line in lines).encode()
        grams = phrases.Grams(content, "en")
        n = 2
        there = np.zeros(len(grams.room) + 1, dtype=bool)
        first = grams.of(n)
        there[first[np.array([chance.random() < 0.6 for _ in first], dtype=bool)]] = True
        kept = phrases._runs(grams, there).tobytes().decode().split("\n")[:-1]
        words = [w for line in lines for w in line]
        for m in range(n + 1, 7):
            longer = [i for i in grams.of(m) if there[i : i + m - n + 1].all()]
            expected = Counter(" ".join(words[i : i + m]) for i in longer)
            found = Counter(" ".join(w[i : i + m]) for w in (line.split(" ") for line in kept) for i in range(len(w) - m + 1))
            assert found == expected


def test_scores_beyond_64_bits(spark):
    """The product of counts passes 64 bits; Spark's whole numbers of 38 digits stay exact."""
    row = spark.sql("select cast(1000 as decimal(4,0)) * cast(9000000000000 as decimal(19,0)) as a").first()[0]
    assert int(row) * 10**13 > 2**64
    rows = [("en", "a b")] * 3 + [("en", "a c")] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df, least=2) == plain(rows, 2, 2000)


def test_odd_tables(spark):
    long = "one two three four " * 30_000
    clash = "n bigint, a string, block int, phrase string, rank double, word string, lang2 string"
    rows = [(None, "x y. X Y"), ("en", None), (None, None), ("en", ""), ("en", " \t . "), ("en", long), ("en", long), ("", "x y, x y")]
    df = spark.createDataFrame([(*row, 1, "a", 2, "p", 0.5, "w", "l") for row in rows], f"{SCHEMA}, {clash}")
    assert mined(df, least=2) == plain(rows, 2, 2000)
    assert mined(df.where("1 = 0"), least=2) == []
    assert mined(spark.createDataFrame([("en", None), (None, " ")], SCHEMA)) == []


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    result = phrases.op13_collocations(spark, "/root/testdata/sf0.01")
    expected = duck.execute(phrases.OP13_SQL).fetchall()
    assert sorted(map(tuple, result.collect())) == sorted(expected) and expected
    types = dict(result.dtypes)
    assert {types[c] for c in ("rank", "a", "l", "r", "n", "score")} == {"bigint"}
