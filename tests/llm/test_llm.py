"""The operators of the training-data subpackage against plain Python, and on odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as contract
import corpus_pipeline
from lanebeacon.llm import (
    bpe,
    components,
    fingerprints,
    jaccard,
    merges,
    mixing,
    neighbours,
    quality,
    registry,
    secrets,
    sharding,
    token_counts,
    urls,
    words,
)

public_tokenizers = pytest.importorskip("public_tokenizers")
SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Names that the operators use inside; tables that have them too must not confuse them.
CLASHES = "node bigint, score double, k string, n bigint, copies string, shard int, ids string, secrets string, sketch string, row string, unit string, _text string, component_id string, size string, decoded string"
CLASH_VALUES = (1, 0.5, "k", 2, "c", 3, "i", "s", "x", "r", "u", "t", "p", "z", "d")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {row["doc_id"]: row["text"] or "" for row in documents.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in every column, empty and long texts, repeated rows, shared ids, clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "one two three four five six seven", "s1"),
        (1, "one two three four five six seven", "s1"),
        (2, "One TWO three four five six seven", None),
        (3, "", "s1"),
        (4, None, "s2"),
        (None, "one two three four five six seven", "s2"),
        (None, None, None),
        (5, long, "s2"),
        (6, long + " end", "s2"),
        (7, "a", "s1"),
        (7, "b  \t\n", "s1"),
        (8, "ünïcödé 日本語 🙂 \x85 x", "s3"),
    ]
    schema = f"doc_id bigint, text string, source string, lang string, n_chars bigint, {CLASHES}"
    return spark.createDataFrame([(*row, None, None, *CLASH_VALUES) for row in rows], schema)


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.where("1 = 0")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(text, width):
    w = plain_words(text)
    if len(w) >= width:
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
    return {tuple(w)} if w else set()


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def test_registry_and_stages():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in registry.queries()) == list(range(1, 14))
    assert set(registry.queries()) | {"pipeline"} <= set(contract.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixing", "encode"]


# 1: sharding


def check_shards(sharded, docs, shards, tolerance):
    rows = sharded.collect()
    given = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == given
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    bytes_ = Counter()
    for r in rows:
        bytes_[r["shard"]] += r["size"]
    if tolerance:
        mean = sum(bytes_.values()) / shards
        assert max(bytes_.values()) <= mean * (1 + tolerance) and min(bytes_[s] for s in range(shards)) >= mean * (1 - tolerance)
    return rows


def test_shards_are_even_and_groups_stay_together(documents):
    rows = check_shards(sharding.shard_documents(documents, 8), documents, 8, 0.05)
    places = defaultdict(set)
    for r in rows:
        places[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(len(p) == 1 for p in places.values())
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sharding.shard_documents(documents, 8).collect()))


def test_a_group_larger_than_a_shard_is_cut(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same text again', concat('text ', id)) as text")
    check_shards(sharding.shard_documents(docs, 8), docs, 8, 0.05)
    same = spark.range(2000).selectExpr("id as doc_id", "'x' as text")
    check_shards(sharding.shard_documents(same, 4), same, 4, 0.05)


def test_sharding_of_odd_tables(odd, nothing):
    check_shards(sharding.shard_documents(odd, 4), odd, 4, None)
    assert sharding.shard_documents(nothing).count() == 0


def test_packing_goes_to_the_highest_dot_product():
    residual = np.array([[1.0, 0.2, 1.0], [0.5, 1.0, 1.0]])
    assert list(sharding.pack(np.array([[0.4, 0.0, 0.0], [0.0, 0.3, 0.0]]), residual)) == [0, 1]


def test_query_of_sharding(spark, documents):
    result = contract.queries()["op1_sharding"](spark, SF_DIR)
    assert result.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    check_shards(result, documents, 16, 0.06)


# 2: byte-level BPE


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    path, pattern = bpe.production()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def odd_strings(seed, n):
    chance = random.Random(seed)
    fixed = ["", "a" * 5000, " " * 300 + "x", "====" * 50, "x\x1cy\x1d z", "  a b\r\n\r\n  c", "it's we'll I'M 12½ ²", "<|endoftext|>", "é́ß" * 20, "ΑΣ ΣΑΣ İI", "ab" * 700]
    return fixed + ["".join(chance.choice("ab aA1\n\t.é世🙂'sתΣİ́<|") for _ in range(chance.randrange(60))) for _ in range(n)]


def test_encoding_equals_the_library(reference, texts, monkeypatch):
    path, pattern = bpe.production()
    some = [*odd_strings(1, 800), *list(texts.values())[:60]]
    for block, known in ((2_000_000, 400_000), (700, 50)):
        monkeypatch.setattr(bpe, "BLOCK_CHARS", block)
        monkeypatch.setattr(bpe, "KNOWN_PIECES", known)
        encoder = bpe.Encoder(bpe.read_ranks(path), pattern)
        got = [ids.tolist() for at in range(0, len(some) + 1, 100) for ids in encoder.texts([*some, None][at : at + 100])]
        assert got == [reference.encode_ordinary(text) for text in some] + [[]]


def test_merges_that_make_an_earlier_one_possible():
    # a+b comes last, but ab+c before it: going through all a+b at once would differ.
    pairs = {(0, 1): 9, (3, 2): 1, (2, 3): 0}
    token_of = np.arange(10)
    token_of[9], token_of[1], token_of[0] = 3, 4, 5
    engine = merges.Merges(pairs, token_of)
    words_ = [[0, 1, 2, 0, 1], [0, 1], [2], [0, 1, 2]]
    out, counts = engine.replay(np.concatenate(words_), np.array([len(w) for w in words_]))
    assert [list(p) for p in np.split(out, np.cumsum(counts)[:-1])] == [engine.merge_one(w) for w in words_]


def test_replay_equals_one_by_one():
    chance = random.Random(3)
    pairs = {}
    for rank in range(40):
        pairs.setdefault((chance.randrange(20), chance.randrange(20)), rank)
    engine = merges.Merges(pairs, np.array([chance.randrange(20) for _ in range(40)]))
    words_ = [[chance.randrange(20)] for _ in range(50)]
    assert engine.replay(np.concatenate(words_), np.ones(50, np.int64))[1].tolist() == [1] * 50


def test_round_trip_and_digests(spark, odd, nothing, reference):
    path, pattern = bpe.production()
    coded = bpe.decode_ids(bpe.encode_texts(odd.drop("ids", "decoded"), path, pattern), path)
    for row in coded.collect():
        assert bytes(row["decoded"]).decode() == (row["text"] or "")
        assert row["ids"] == reference.encode_ordinary(row["text"] or "")
    assert bpe.encode_texts(nothing, path, pattern).count() == 0
    query = contract.queries()["op2_byte_bpe"](spark, SF_DIR)
    by_id = {r["doc_id"]: r for r in query.collect()}
    for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        ids = reference.encode_ordinary(row["text"])
        assert by_id[row["doc_id"]]["n_tokens"] == len(ids)
        assert by_id[row["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert by_id[row["doc_id"]]["decoded_sha256"] == hashlib.sha256(row["text"].encode()).hexdigest()


# 3: nearest neighbours


def test_neighbours_against_brute_force(spark):
    found = contract.queries()["op3_neighbours"](spark, SF_DIR).collect()
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == {i for i in ids if i % 50 == 0}
    hits = 0
    for q, answer in got.items():
        cosines = neighbours.exact_cosines(vectors, vectors[ids == q][0])
        best = [i for i in np.lexsort((ids, -cosines)) if ids[i] != q][:5]
        hits += len({ids[i] for i in best} & {v for v, _ in answer})
        for v, score in answer:
            assert math.isclose(score, cosines[ids == v][0], abs_tol=1e-12)
        assert answer == sorted(answer, key=lambda x: (-x[1], x[0])) and len(answer) == 5
    assert hits >= 0.9 * 5 * len(got)


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.0, 0.0]), (6, None), (7, [None, 1.0]), (8, []), (None, [1.0, 0.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (50, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, rank int, id string")
    found = neighbours.nearest_neighbours(table, F.col("vec_id") % 50 == 0)
    assert [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in found.orderBy("query_id", "rank").collect()] == [
        (0, 1, 1, 1.0),
        (0, 2, 9, 1.0),
        (0, 3, 2, 0.0),
    ]
    assert neighbours.nearest_neighbours(table.where("1 = 0"), F.lit(True)).count() == 0


def test_neighbours_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "CHUNK", 2)
    vectors = np.random.default_rng(5).standard_normal((600, 12))
    table = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    found = neighbours.nearest_neighbours(table, F.col("vec_id") % 60 == 0).collect()
    hits = 0
    for q in range(0, 600, 60):
        cosines = neighbours.exact_cosines(vectors, vectors[q])
        cosines[q] = -2
        hits += len(set(np.argsort(-cosines)[:5].tolist()) & {r["vec_id"] for r in found if r["query_id"] == q})
    assert len(found) == 50 and hits >= 45


# 4: quality


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    scored = {r["doc_id"]: r for r in contract.queries()["op4_quality"](spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(scored) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for d, r in scored.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(labels[d], r["predicted"]) for d, r in scored.items() if r["held_out"] and d in labels]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.learn_quality(docs, labels), quality.learn_quality(docs, turned)
    assert np.array_equal(one.weights, two.weights) and one.cut == two.cut


def test_quality_of_odd_tables(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1)], "doc_id bigint, quality int")
    ranking = quality.learn_quality(odd, labels)
    scored = quality.score_quality(odd.drop("score"), ranking)
    assert {r["score"] for r in scored.collect()} == {0.5} and scored.count() == odd.count()
    assert quality.score_quality(nothing, quality.learn_quality(nothing, labels.where("1 = 0"))).count() == 0


def test_text_counts_do_not_depend_on_blocks(texts, monkeypatch):
    some = [*list(texts.values())[:30], "", None, "a a a b", "ü" * 700 + " x x"]
    whole = quality.text_counts(pa.array(some))
    assert whole[-2].tolist()[-2:] == [4.0, 2.0] and whole[-4].sum() == 0
    monkeypatch.setattr(quality, "BLOCK_BYTES", 100)
    monkeypatch.setattr(words, "BLOCK_BYTES", 100)
    assert np.array_equal(whole, quality.text_counts(pa.array(some)))
    assert np.array_equal(whole[5:], quality.text_counts(pa.array(some).slice(5)))


# 5: secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def secret_texts():
    chance = random.Random(7)
    pieces = ["token=", "Password: '", "api_key = \"", "apikey:", "secret", "AKIA", "0123456789abcdef", "deadbeef", "ABCDEFGH12", " ", "🙂", "é", "\n", "=", ":", "xyz.w-_", "passwd='abcdefghijkl'"]
    return ["".join(chance.choice(pieces) for _ in range(chance.randrange(25))) for _ in range(400)]


def test_known_shapes_equal_plain_search(spark, texts):
    some = [*secret_texts(), *texts.values(), "token=secret: abcdefghijklmnop", "0" * 16 + " " + "f" * 15, ""]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "doc_id bigint, text string").repartition(8)
    found = {r["doc_id"]: r["spans"] for r in table.select("doc_id", secrets.base_spans(F.col("text")).alias("spans")).collect()}
    for i, text in enumerate(some):
        assert [tuple(s) for s in found[i]] == plain_secrets(text)


def test_many_matches_are_placed(spark):
    text = " ".join(f"{i:016x}" for i in range(2000))
    table = spark.createDataFrame([(text,)], "text string")
    assert [tuple(s) for s in table.select(secrets.base_spans(F.col("text"))).first()[0]] == plain_secrets(text)


def test_random_strings_are_told_from_words(spark):
    chance = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(chance.choice(letters) for _ in range(chance.choice([24, 32, 44, 64]))) for _ in range(300)]
    keys = [k for k in keys if re.search("[0-9]", k)]
    names = [f"section-{i}-of-the-report-{'about-' * (i % 4)}things" for i in range(300)]
    table = spark.createDataFrame([(i, f"see {s} here") for i, s in enumerate(keys + names)], "doc_id bigint, text string")
    found = secrets.secret_spans(table).select("doc_id", F.size(F.filter("secrets", lambda s: s["kind"] == 3)).alias("n")).collect()
    claimed = {r["doc_id"] for r in found if r["n"]}
    true = {i for i in claimed if i < len(keys)}
    assert len(true) >= 0.85 * len(keys) and len(claimed - true) <= 0.1 * max(len(claimed), 1)


def test_p_values_of_random_strings_are_spread_evenly(spark):
    chance = random.Random(12)
    strings = ["".join(chance.choice("0123456789abcdef") for _ in range(40)) for _ in range(600)]
    table = spark.createDataFrame([(s,) for s in strings], "v string").repartition(8)
    ps = sorted(r[0] for r in table.select(secrets.randomness(F.col("v"))).collect())
    assert abs(ps[len(ps) // 2] - 0.5) < 0.15 and ps[int(0.05 * len(ps))] > 0.003


def random_keys(seed, n, length, letters="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"):
    chance = random.Random(seed)
    return ["".join(chance.choice(letters) for _ in range(length)) for _ in range(n)]


def claims(spark, strings):
    table = spark.createDataFrame([(i, f"see {s} here") for i, s in enumerate(strings)], "doc_id bigint, text string").repartition(8)
    return {r["doc_id"] for r in secrets.secret_spans(table).where(F.exists("secrets", lambda s: s["kind"] == 3)).collect()}


@pytest.mark.parametrize("p", [0.33, 0.47, 0.9])
def test_copies_of_a_string_do_not_set_the_level(spark, p):
    keys = random_keys(21, 600, 44)
    names = [f"section-{i}-of-the-report-about-those-and-other-things"[:44] for i in range(300)]
    table = spark.createDataFrame([(s,) for s in keys], "v string").repartition(8)
    of_key = dict(table.select("v", secrets.randomness(F.col("v"))).collect())
    repeated = min(keys, key=lambda k: abs(of_key[k] - p))
    claimed = claims(spark, [*keys, *names, *[repeated] * 5000])
    assert sum(i < 600 for i in claimed) >= 560 and sum(600 <= i < 900 for i in claimed) <= 30
    assert sum(i >= 900 for i in claimed) == 5000
    assert claimed == {*claims(spark, [*keys, *names]), *range(900, 5900)}


def test_random_strings_without_digits_are_claimed(spark):
    keys = [k for k in random_keys(24, 6000, 24) if not re.search("[0-9]", k)] + random_keys(25, 150, 40, "abcdefghijklmnopqrstuvwxyz") + random_keys(26, 150, 32, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    names = [f"section-{'abcdefghij'[i % 10]}-of-the-report-{'about-' * (i % 4)}things" for i in range(300)]
    claimed = claims(spark, [*keys, *names])
    assert sum(i < len(keys) for i in claimed) >= 0.85 * len(keys) and sum(i >= len(keys) for i in claimed) <= 0.1 * len(claimed)


def test_bands_with_few_strings_are_decided(spark):
    keys = random_keys(22, 400, 44)
    few = random_keys(23, 40, 90)
    table = spark.createDataFrame([(s,) for s in few], "v string")
    low = min((r for r in table.select("v", secrets.randomness(F.col("v")).alias("p")).collect() if r["p"] > 0.2), key=lambda r: r["p"])
    assert low["p"] < 0.5 and 400 in claims(spark, [*keys, low["v"]])
    assert secrets._level([0] * 100) == 2.0 == secrets._level([9] * 50 + [0] * 50)


def test_masking_and_odd_tables(spark, odd, nothing):
    assert secrets.secret_spans(nothing.drop("secrets")).count() == 0
    found = secrets.secret_spans(odd.drop("secrets"))
    assert found.columns == [*odd.drop("secrets").columns, "secrets"]
    assert all(not r["secrets"] for r in found.collect())
    table = spark.createDataFrame([("é token = 'abcdefabcdefabcdef0' 🙂 x",), ("clean",), (None,)], "text string")
    masked = secrets.secret_spans(table).select(secrets.masked(F.col("text"), F.col("secrets")).alias("m"))
    assert [r["m"] for r in masked.collect()] == ["é [SECRET]' 🙂 x", "clean", None]


def test_query_of_secrets(spark, texts):
    for r in contract.queries()["op5_secrets"](spark, SF_DIR).collect():
        spans = plain_secrets(texts[r["doc_id"]])
        said = ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in spans) for i in range(3)]


# 6: token counts


def test_counts_equal_the_library(texts, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    some = [*odd_strings(2, 800), "a<|endoftext|>b <|startoftext|><|x", *list(texts.values())[:80]]
    expected = [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]
    counter = token_counts.Counter(Path(path).read_text(encoding="utf-8"))
    assert list(counter.texts([*some, None])) == [*expected, 0]
    monkeypatch.setattr(token_counts, "BLOCK_CHARS", 500)
    monkeypatch.setattr(token_counts, "KNOWN_PIECES", 40)
    assert list(counter.texts(some)) == expected
    assert all(len(library.encode(w, add_special_tokens=False).ids) == 1 for w in counter.whole[::50])


def test_query_of_token_counts(spark, odd, nothing, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for r in contract.queries()["op6_token_counts"](spark, SF_DIR).collect():
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 2048)
    for r in token_counts.count_tokens(odd, path).collect():
        assert r["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids)
    assert token_counts.count_tokens(nothing, path).count() == 0


# 7: Jaccard join


def plain_components(rows, width, num, den):
    """Component of each row by comparing all pairs; rows are (id, text)."""
    sets = [grams(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and (top(i) not in smallest or d < smallest[top(i)]):
            smallest[top(i)] = d
    return [(d, len(sets[i]), smallest.get(top(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def edited(seed, n, lengths, vocabulary=60):
    """Groups of texts that differ in a few words each, so that many pairs lie near the threshold."""
    chance = random.Random(seed)
    rows = []
    while len(rows) < n:
        base = [f"w{chance.randrange(vocabulary)}" for _ in range(chance.choice(lengths))]
        for _ in range(chance.randrange(1, 7)):
            copy = list(base)
            for _ in range(chance.choice([0, 0, 1, 1, 2, 3])):
                if copy and chance.random() < 0.5:
                    copy[chance.randrange(len(copy))] = f"w{chance.randrange(vocabulary)}"
                else:
                    copy.insert(chance.randrange(len(copy) + 1), f"w{chance.randrange(vocabulary)}")
            rows.append((len(rows) + 1, " ".join(copy)))
    return rows


@pytest.mark.parametrize("seed, lengths, like", [(1, [1, 2, 3, 5, 8, 12, 20], (1, 80, 100)), (2, [20, 40, 60, 90], (4, 85, 100)), (3, [10, 15, 30, 200], (2, 80, 100))])
def test_components_equal_all_pairs(spark, seed, lengths, like):
    rows = edited(seed, 260, lengths, vocabulary=12 if like[0] == 1 else 60)
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = jaccard.link_documents(table, jaccard.Similarity(*like))
    assert sorted(rows_of(found)) == sorted(plain_components(rows, *like))


def test_pigeonhole_finds_every_close_pair():
    """Signatures alone, over single n-grams, on sets of all sizes whose distance is just allowed."""
    chance = np.random.default_rng(9)
    for like in (jaccard.Similarity(1, 85, 100), jaccard.Similarity(1, 80, 100)):
        for size in [*range(1, 60), 75, 100, 140, 200, 333, 500, 900]:
            larger = chance.integers(1, 1 << 62, size, dtype=np.int64).astype(np.uint64)
            for added in range(3):
                # The smaller set loses some elements and gains as many others as the threshold lets it.
                lost, gained = 0, added
                while like.den * (size - lost - 1) >= like.num * (size + gained):
                    lost += 1
                if size - lost < 1 or size - lost + gained > size or like.den * (size - lost) < like.num * (size + gained):
                    continue
                smaller = np.concatenate([larger[: size - lost], chance.integers(1, 1 << 62, gained, dtype=np.int64).astype(np.uint64)])
                sets = np.concatenate([larger, smaller])
                owners = np.repeat([0, 1], [size, len(smaller)])
                order = np.lexsort((sets, owners))
                sets, owners = sets[order], owners[order]
                sizes, nodes = jaccard.node_of(sets, owners, 2)
                buckets = defaultdict(list)
                for s, node, info in jaccard.signatures(sets, owners, sizes, nodes, like):
                    for a, b, c in zip(s.tolist(), node.tolist(), info.tolist()):
                        buckets[a].append((b, c & 3))
                met = any(x[0] != y[0] and (x[1] | y[1]) == 3 for b in buckets.values() for x in b for y in b)
                assert met or nodes[0] == nodes[1], (like, size, lost, gained)


def test_group_of_copies_costs_its_members(spark):
    base = " ".join(f"v{i}" for i in range(80))
    table = spark.range(600).selectExpr("id as doc_id", f"if(id % 2 = 0, '{base}', concat('{base} x', id)) as text")
    found = jaccard.link_documents(table, jaccard.Similarity(5, 80, 100)).collect()
    assert {r["component_id"] for r in found} == {0} and len(found) == 600


def test_joins_of_odd_tables(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    expected = plain_components(rows, 5, 80, 100)
    found = rows_of(jaccard.link_documents(odd))
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert jaccard.link_documents(nothing).count() == 0 and jaccard.keep_one(nothing).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(((r["doc_id"], (r["text"] or "")[:3]) for r in kept.collect()), key=repr) == sorted(
        [(1, "one"), (3, ""), (4, ""), (None, ""), (5, "wor"), (7, "a"), (7, "b  "), (8, "ünï")], key=repr
    )


def test_components(spark):
    chance = random.Random(4)
    links = [(chance.randrange(300), chance.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(70)]
    parent = {n: n for pair in links for n in pair}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    found = dict(rows_of(components.components(spark.createDataFrame(links, "a bigint, b bigint"))))
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: top(n) for n in linked}


def test_query_of_joins(spark, texts):
    rows = sorted(texts.items())
    assert sorted(rows_of(contract.queries()["op7_jaccard_join"](spark, SF_DIR))) == plain_components(rows, 4, 85, 100)


# 8: URLs


def plain_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match("[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    fits = [r for r in urls.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return (best[1] + best[2], best[0]) if best else (None, None)


def test_hosts_paths_and_rules(spark):
    some = ["http://A.Example.NET/en/x?y#z", "https://net", "https://net/", "x://a.org?/fr/", "a://b://c.org/fr/q", "no scheme", "", None, "://", "http://notexample.com/de/", "http://example.com/de", "HTTP://ÀB.ORG/fr/#", "http://h\n.net/a\nb?c"]
    judged = urls.judge_urls(spark.createDataFrame([(i, u, 1, "r") for i, u in enumerate(some)], "page_id bigint, url string, score int, rule string"))
    for r in judged.collect():
        host, path = plain_url(some[r["page_id"]])
        rule, verdict = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert judged.count() == len(some)
    assert urls.judge_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_models_tell_hosts_apart(spark):
    rows = [f"http://good{i}.site.org/fr/story{i}" for i in range(60)] + [f"http://casino{i}.win.net/bet{i}" for i in range(60)]
    new = ["http://good99.site.org/en/story1", "http://casino99.win.com/bet7"]
    judged = urls.judge_urls(spark.createDataFrame(list(enumerate(rows + new)), "page_id bigint, url string"))
    assert {r["page_id"]: r["verdict"] for r in judged.where("page_id >= 120").collect()} == {120: "allow", 121: "block"}


def test_model_equals_plain_smoothing(spark):
    rows = [("^^^ab$", 2, 0), ("^^^ac$", 1, 1), ("^^^b$", 0, 3)]
    model = dict(rows_of(urls.char_model(spark.createDataFrame(rows, "spelled string, allowed bigint, blocked bigint"))))
    grams_ = Counter(), Counter()
    for text, a, b in rows:
        for i in range(len(text) - 3):
            for c, n in zip(grams_, (a, b)):
                c[text[i : i + 4]] += n

    def p(c, gram):
        if not gram:
            return Fraction(1, len(urls.ALPHABET))
        n = len(gram)
        same = Counter()
        for g, k in c.items():
            if g[4 - n : 3] == gram[:-1]:
                same[g[3]] += k
        kinds = sum(v > 0 for v in same.values())
        total = sum(same.values())
        lower = p(c, gram[1:])
        return (same[gram[-1]] + kinds * lower) / (total + kinds) if total + kinds else lower

    for gram, ratio in model.items():
        assert math.isclose(ratio, math.log(p(grams_[0], gram) / p(grams_[1], gram)), abs_tol=1e-9)


def test_model_sees_code_points_and_digits(spark):
    rows = [f"http://пример{i}.org/fr/новости{i}" for i in range(60)] + [f"http://казино{i}.net/ставка{i}" for i in range(60)]
    rows += [f"http://a.org/fr/2{i}2222" for i in range(60)] + [f"http://a.net/7{i}7777" for i in range(60)]
    new = ["http://x.de/новости9", "http://x.de/ставкаа9", "http://x.de/222222", "http://x.de/777777"]
    judged = urls.judge_urls(spark.createDataFrame(list(enumerate(rows + new)), "page_id bigint, url string"))
    last = {r["page_id"]: r for r in judged.where("page_id >= 240").collect()}
    assert len({r["score"] for r in last.values()}) == 4
    assert [last[240 + i]["verdict"] for i in range(4)] == ["allow", "block", "allow", "block"]


def test_models_see_the_whole_url(spark):
    rows = [f"http://a{i}.org/fr/x?q=story{i}" for i in range(60)] + [f"http://a{i}.net/x?q=casino{i}" for i in range(60)]
    new = ["http://b.de/x?q=story7", "http://b.de/x?q=casino7", "story7", "casino7", "http://b.de/x", "http://b.de/x#casino"]
    judged = urls.judge_urls(spark.createDataFrame(list(enumerate(rows + new)), "page_id bigint, url string"))
    last = {r["page_id"] - 120: r for r in judged.where("page_id >= 120").collect()}
    assert len({r["score"] for r in last.values()}) == 6
    assert [last[i]["verdict"] for i in range(4)] == ["allow", "block", "allow", "block"]
    assert (last[2]["host"], last[2]["path"]) == ("", "")


def test_contexts_grow_with_the_table():
    assert [urls._order(n) for n in (0, 4095, 4096, 10**6, 10**12)] == [3, 3, 4, 6, 13]


def test_grams_of_long_urls(spark):
    some = ["", "a", "b" * 300, "".join(map(str, range(400)))]
    table = spark.createDataFrame([(t,) for t in some], "t string").select("t", urls._grams(urls._spelled(F.col("t"), 5), 5))
    for text, grams_ in table.collect():
        whole = "^^^^^" + text + "$"
        assert grams_ == [whole[i : i + 6] for i in range(len(whole) - 5)]


# 9: fingerprints


def test_fingerprints_against_plain_sets(spark, texts):
    order = sorted(texts, reverse=True)
    errors = []
    for r in contract.queries()["op9_fingerprints"](spark, SF_DIR).collect():
        text, following = texts[r["doc_id"]], texts[order[(order.index(r["doc_id"]) + 1) % len(order)]]
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = grams(text, 5), grams(changed, 5), grams(following, 5)
        assert len(r["fingerprint"]) == 16 * min(len(a), fingerprints.K)
        errors += [r["near_edited"] - len(a & b) / len(a | b), r["near_next"] - len(a & c) / len(a | c)]
        if len(a | b) <= fingerprints.K:
            assert abs(errors[-2]) < 1e-9
    assert np.sqrt(np.mean(np.square(errors))) < 0.05 and abs(np.mean(errors)) < 0.01


def test_sketches_merge_and_estimate(spark):
    chance = random.Random(8)
    a = [f"x{chance.randrange(10**6)}" for _ in range(3000)]
    left, right = " ".join(a[:2000]), " ".join(a[1000:])
    table = spark.createDataFrame([(left, right, " ".join(a), "", None)], "l string, r string, whole string, e string, z string")
    s = {c: fingerprints.sketch(F.col(c)) for c in table.columns}
    row = table.select(
        fingerprints.merged(s["l"], s["r"]).alias("merged"),
        s["whole"].alias("at_once"),
        fingerprints.resemblance(s["l"], s["r"]).alias("resemblance"),
        fingerprints.containment(s["l"], s["whole"]).alias("inside"),
        fingerprints.distinct_shingles(s["whole"]).alias("n"),
        fingerprints.resemblance(s["e"], s["z"]).alias("empty"),
        fingerprints.resemblance(s["e"], s["l"]).alias("none"),
        fingerprints.distinct_shingles(s["e"]).alias("zero"),
    ).first()
    assert row["merged"] == row["at_once"] and len(row["at_once"]) == fingerprints.K
    assert abs(row["resemblance"] - 1 / 3) < 0.15 and row["inside"] == 1.0 and abs(row["n"] - 2996) < 900
    assert (row["empty"], row["none"], row["zero"]) == (1.0, 0.0, 0.0)


def test_next_rows_of_odd_tables(spark, odd, nothing):
    rows = rows_of(fingerprints.with_next(odd.select("doc_id", "text"), "doc_id", ["text"]))
    assert len(rows) == odd.count()
    ids = [r[0] for r in rows]
    by_order = sorted(((d is not None, d or 0, t is not None, t or "") for d, t, _ in rows), key=lambda x: (not x[0], -x[1], x[2], x[3]))
    assert Counter(r[2] for r in rows) == Counter(r[1] for r in rows) and ids.count(None) == 2
    first = {(d, t): following for d, t, following in rows}
    assert first[8, "ünïcödé 日本語 🙂 \x85 x"] == "a" and by_order[0][1] == 8
    assert fingerprints.with_next(nothing.select("doc_id", "text"), "doc_id", ["text"]).count() == 0
    single = spark.createDataFrame([(3, "t")], "doc_id bigint, text string")
    assert rows_of(fingerprints.with_next(single, "doc_id", ["text"])) == [(3, "t", "t")]
    assert fingerprints.fingerprint_documents(odd.drop("sketch")).count() == odd.count()


def test_next_rows_over_many_ranges(spark):
    chance = random.Random(1)
    ids = [chance.randrange(-(10**12), 10**12) for _ in range(3000)]
    table = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id bigint, text string").repartition(6)
    order = sorted(ids, reverse=True)
    expected = {i: str(order[(p + 1) % len(order)]) for p, i in enumerate(order)}
    assert {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(table, "doc_id", ["text"]).collect()} == expected


# 10: mixing


def plain_targets(sizes, weights, most):
    """Targets by sharing out again and again; sizes in order of the sources."""
    total, open_, target = Fraction(sum(sizes)), list(range(len(sizes))), {}
    while open_:
        rate = (total - sum(target.values())) / sum(weights[i % len(weights)] for i in open_)
        full = [i for i in open_ if rate * weights[i % len(weights)] > most * sizes[i]]
        if not full:
            target.update({i: rate * weights[i % len(weights)] for i in open_})
            break
        target.update({i: Fraction(most * sizes[i]) for i in full})
        open_ = [i for i in open_ if i not in full]
    return [float(target[i]) for i in range(len(sizes))]


@pytest.mark.parametrize("sizes", [[5, 5, 5], [1, 1000, 3], [0, 10, 20, 4000, 1], [0, 0], [7], [100, 1, 1, 1, 1, 1, 900]])
def test_targets_equal_sharing_by_turns(spark, sizes):
    table = spark.createDataFrame([(f"s{i:02}", float(n), 1) for i, n in enumerate(sizes)], "source string, source_size double, documents bigint")
    found = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    assert [found[k] for k in sorted(found)] == pytest.approx(plain_targets(sizes, mixing.WEIGHTS, 3))


def test_mix_comes_near_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    chance = random.Random(2)
    rows = [(i, "w " * int(chance.lognormvariate(3, 1)), "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    mix = mixing.mix_sources(table).collect()
    assert sorted(map(tuple, mix)) == sorted(map(tuple, mixing.mix_sources(table.repartition(3)).collect()))
    taken, target, largest = Counter(), {}, Counter()
    for r in mix:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert 0 <= r["extra"] <= r["n"] == 1 and r["base"] + r["extra"] <= 3
        taken[r["source"]] += (r["base"] + r["extra"]) * r["size"]
        target[r["source"]] = r["target"]
    # One document of a source is rounded, so the miss is half of it at most.
    assert len(mix) == 3000 and all(abs(taken[s] - t) <= largest[s] / 2 + 1 for s, t in target.items())


def test_expected_copies_are_kept(spark):
    table = spark.range(40).selectExpr("id as doc_id", "repeat('w ', cast(5 + id % 7 as int)) as text", "if(id < 20, 'a', 'b') as source")
    seen = Counter()
    for seed in range(12):
        for r in mixing.mix_sources(table, seed=seed).where("source = 'a'").collect():
            seen[r["doc_id"]] += r["extra"]
            share = r["target"] / r["source_size"] - r["base"]
    assert abs(sum(seen.values()) / (12 * 20) - share) < 0.08 and sum(0 < seen[i] < 12 for i in range(20)) >= 15


def test_mix_of_odd_tables(spark, odd, nothing):
    mix = mixing.mix_sources(odd)
    assert sum(r["n"] for r in mix.collect()) == odd.count()
    copies = mixing.take_copies(odd, mix)
    assert copies.columns == odd.columns
    expected = sum(r["n"] * r["base"] + r["extra"] for r in mix.collect())
    assert copies.count() == expected
    assert mixing.mix_sources(nothing).count() == 0 and mixing.take_copies(nothing, mixing.mix_sources(nothing)).count() == 0
    many = spark.range(500).selectExpr("1 as doc_id", "'a b c' as text", "if(id < 100, 's', 't') as source")
    mix = mixing.mix_sources(many)
    taken = {r["source"]: (r["n"] * r["base"] + r["extra"]) * 3 for r in mix.collect()}
    assert taken == {"s": 501, "t": 999} or abs(taken["s"] - 500) <= 3 and abs(taken["t"] - 1000) <= 3


def test_query_of_mixing(spark, texts):
    rows = contract.queries()["op10_mixing"](spark, SF_DIR).collect()
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    size = {d: len(WORD.findall(t)) for d, t in texts.items()}
    per_source = Counter()
    for d, n in size.items():
        per_source[source[d]] += n
    names = sorted(per_source)
    targets = dict(zip(names, plain_targets([per_source[s] for s in names], mixing.WEIGHTS, 3)))
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], per_source[source[r["doc_id"]]])
        assert r["target"] == pytest.approx(targets[source[r["doc_id"]]]) and r["taken"] <= 3 * r["size"]


# The pipeline


def test_pipeline_stage_by_stage(spark, documents, reference, tmp_path):
    docs, seen = documents, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / f"{i}"))
        after = spark.read.parquet(str(tmp_path / f"{i}"))
        before_rows, rows = docs.collect(), after.collect()
        if name != "encode":
            assert after.dtypes == documents.dtypes
        if name == "quality":
            ranking = quality.learn_quality(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            scores = ranking.scores(quality.text_counts(pa.array([r["text"] for r in before_rows])))
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r, s in zip(before_rows, scores) if s >= 0.5}
        if name == "near_duplicates":
            pairs = [(r["doc_id"], r["text"]) for r in before_rows]
            expected = {c for d, n, c in plain_components(pairs, 5, 80, 100)}
            assert sorted(r["doc_id"] for r in rows) == sorted(expected)
        if name == "secrets":
            assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in before_rows)
            for r in rows:
                assert not plain_secrets(r["text"]) and r["n_chars"] == len(r["text"])
        if name == "mixing":
            mix = mixing.mix_sources(docs).collect()
            assert Counter(r["doc_id"] for r in rows) == Counter({r["doc_id"]: n for r in mix if (n := r["base"] + r["extra"])})
        if name == "encode":
            by_id = {r["doc_id"]: r["text"] for r in before_rows}
            assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in before_rows)
            for r in rows:
                assert r["ids"] == reference.encode_ordinary(by_id[r["doc_id"]])
        seen[name] = len(rows)
        docs = after
    assert seen["quality"] < documents.count() and seen["near_duplicates"] < seen["quality"]


def test_pipeline_of_odd_tables(spark, odd, nothing):
    for table in (odd, nothing):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SF_DIR)
            if name == "encode":
                result.collect()
            else:
                assert result.columns == table.columns
                docs = corpus_pipeline.stored(result, "odd")


def test_pipeline_query(spark):
    result = contract.queries()["pipeline"](spark, SF_DIR)
    assert result.count() > 100 and "ids_sha256" in result.columns
