"""Merkle manifests against plain folding."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lanebeacon.llm import merkle
from lanebeacon.llm.numbering import numbered

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h("".join(parts))


def climb(leaves, arity=8):
    """The last node, and the siblings of each leaf level by level as (before, after)."""
    paths, nodes = [[] for _ in leaves], [(leaf, [i]) for i, leaf in enumerate(leaves)]
    while len(nodes) > 1:
        up = []
        for start in range(0, len(nodes), arity):
            run = nodes[start : start + arity]
            for at, (_, members) in enumerate(run):
                step = ("".join(d for d, _ in run[:at]), "".join(d for d, _ in run[at + 1 :]))
                for member in members:
                    paths[member].append(step)
            up.append((h("".join(d for d, _ in run)), [m for _, members in run for m in members]))
        nodes = up
    return nodes[0][0], paths


def plain(rows, arity=8):
    trees = defaultdict(list)
    for row in rows:
        lower = row[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
        changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        offered = leaf_of((*row[:4], lower)) if changed else leaf_of(row)
        trees[row[2]].append((row[0] is not None, row[0] or 0, leaf_of(row), offered, row))
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    below = {}
    for lang in names:
        trees[lang].sort(key=lambda t: t[:4])
        below[lang] = climb([t[2] for t in trees[lang]], arity)
    root, tops = climb([below[lang][0] for lang in names], arity) if names else ("", [])
    found = []
    for lang, top in zip(names, tops):
        subroot, paths = below[lang]
        for (_, _, leaf, offered, row), path in zip(trees[lang], paths):
            folded = offered
            for before, after in path + top:
                folded = h(before + folded + after)
            proof = h("".join(a + b for a, b in path + top))
            found.append((row[0], leaf, subroot, root, proof, folded, folded == root))
    return sorted(found, key=repr)


def proven(spark, df, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "table", lambda *_: df)
    result = merkle.op12_merkle(spark, "")
    assert result.columns == COLUMNS
    return sorted(map(tuple, result.collect()), key=repr)


def rows_of(n, langs=("en", "de", None, "fr", "")):
    # Most rows are of one language.
    return [(i * 7 % (n or 1), f"s{i % 3}", langs[0] if i % 3 else langs[i % len(langs)], i if i % 4 else None, f"Text {i} Ü ABC" if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize("n, langs", [(300, ("en", "de", None, "fr", "")), (64, ("en",)), (65, ("en",)), (1, ("en",)), (3, ("a", "b", "c")), (150, tuple(f"l{i}" for i in range(70)))])
def test_manifest_equals_plain_folding(spark, tmp_path, monkeypatch, n, langs):
    rows = rows_of(n, langs)
    assert proven(spark, spark.createDataFrame(rows, SCHEMA).repartition(5), tmp_path, monkeypatch) == plain(rows)


@pytest.mark.parametrize("arity", [2, 3])
def test_other_runs(spark, arity):
    rows = rows_of(100)
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), arity=arity)
    got = {(r["doc_id"], r["leaf"].hex()): (r["subroot"].hex(), r["root"].hex()) for r in found.collect()}
    assert got == {(row[0], row[1]): (row[2], row[3]) for row in plain(rows, arity)}
    assert found.where(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_odd_tables(spark, tmp_path, monkeypatch):
    clash = "tree string, idx string, n string, own string, path string, root string, place string, leaf string, part string"
    rows = [(None, None, None, None, None)] * 11 + [(1, "s", "en", 3, "")] * 20 + [(1, "s", "en", 3, None), (2, "-", "-", -1, "Long Ü " * 50_000), (3, "", "", 0, "é🙂")]
    rows += [(5, "a:1", "en", 1, "Abc"), (5, "a", "en", 1, "Abc"), (-7, "x", "日本", None, "X")]
    df = spark.createDataFrame([(*row, *"abcdefghi") for row in rows], f"{SCHEMA}, {clash}").repartition(4)
    assert proven(spark, df, tmp_path, monkeypatch) == plain(rows)
    assert proven(spark, df.where("1 = 0"), tmp_path, monkeypatch) == []


def test_numbers_are_gapless_and_spread(spark):
    """A third of all rows in one group and alike: they are numbered over several ranges."""
    rows = spark.range(6000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id % 50 as string) end as g", "case when id % 3 = 0 then null else id end as v")
    found = numbered(rows.repartition(6), "g", ["v"]).collect()
    groups = defaultdict(list)
    for row in found:
        groups[row["g"]].append((row["idx"], row["v"], row["n"]))
    for members in groups.values():
        members.sort()
        assert [m[0] for m in members] == list(range(len(members))) and {m[2] for m in members} == {len(members)}
        assert [m[1] for m in members] == sorted((m[1] for m in members), key=lambda v: (v is not None, v))
    assert len(groups["hot"]) == 2000 and sum(map(len, groups.values())) == 6000


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    result = merkle.op12_merkle(spark, SF_DIR)
    expected = duck.execute(merkle.OP12_SQL).fetchall()
    assert [d[0] for d in duck.description] == result.columns
    assert sorted(map(tuple, result.collect())) == sorted(expected)
    assert {row[-1] for row in expected} == {True, False}
