"""A Merkle manifest of a dataset: one digest for all rows, and a proof for each.

Leaves are numbered without gaps within their tree, by a sort over ranges of (tree, order) and the ranges' own
counts, so that no tree has to pass through one task. Each level is one equi-join of its nodes with themselves:
a node asks for the computed numbers of its run (an exclusive or where runs are pairs, slot offsets
otherwise), and the nodes of slot zero, who have the whole run then, emit the parents. The roots of
all trees are the leaves of one more tree. On the way down every node's path is its own siblings
and the path of its parent, so a leaf gets its proof by one join with the nodes above it.

Digests travel as 32 bytes; hashed is their lowercase hex text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanebeacon.llm.common import ascii_lower, stored, table
from lanebeacon.llm.numbering import numbered

ARITY = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(raw: Column) -> Column:
    """The 32 bytes of a SHA-256."""
    return F.unhex(F.sha2(raw, 256))


def hex_text(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def encoded_row(values: list[Column]) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value; one after the other."""
    texts = [value.cast("string") for value in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts])


def tree_key(lang: Column) -> Column:
    """A key that is never NULL and sorts like ``lang``, NULL first."""
    return F.coalesce(F.concat(F.lit("+"), lang), F.lit(""))


def _asked(arity: int) -> Column:
    """Numbers of a node's run, its own included."""
    if arity == 2:
        return F.array(F.col("idx"), F.col("idx").bitwiseXOR(F.lit(1).cast("bigint")))
    first = F.col("idx") - F.col("idx") % arity
    return F.transform(F.sequence(F.lit(0), F.lit(arity - 1)), lambda slot: first + slot)


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``tree, idx, n, own, before, after``: of each node its digest and those of its siblings left and right, in a row each.

    ``nodes`` has ``tree, idx, n, own``, ``n`` being the nodes of the tree on this level.
    """
    asks = nodes.select("tree", F.col("idx").alias("asker"), "n", F.explode(F.filter(_asked(arity), lambda i: i < F.col("n"))).alias("idx"))
    answers = asks.join(nodes.select("tree", "idx", "own"), ["tree", "idx"])
    run = F.array_sort(F.collect_list(F.struct("idx", "own")))
    asked = answers.groupBy("tree", "asker", "n").agg(run.alias("run"))

    def joined(keep) -> Column:
        chosen = F.filter("run", keep)
        return F.aggregate(chosen, F.unhex(F.lit("")), lambda acc, node: F.concat(acc, node["own"]))

    me = F.col("asker")
    return asked.select(
        "tree",
        me.alias("idx"),
        "n",
        joined(lambda node: node["idx"] == me).alias("own"),
        joined(lambda node: node["idx"] < me).alias("before"),
        joined(lambda node: node["idx"] > me).alias("after"),
    )


def _levels(most: int, arity: int) -> int:
    levels = 0
    while most > 1:
        most, levels = -(-most // arity), levels + 1
    return levels


def parents(level: DataFrame, arity: int) -> DataFrame:
    """The nodes of slot zero emit their run's parent; the last node of a tree stays as it is."""
    alone = F.col("n") == 1
    folded = digest(hex_text(F.concat("before", "own", "after")))
    return level.where(F.col("idx") % arity == 0).select(
        "tree",
        F.call_function("div", F.col("idx"), F.lit(arity).cast("bigint")).alias("idx"),
        F.call_function("div", F.col("n") + (arity - 1), F.lit(arity).cast("bigint")).alias("n"),
        F.when(alone, F.col("own")).otherwise(folded).alias("own"),
    )


def grow(nodes: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels from the leaves up (with siblings), and the last node of each tree.

    There are as many levels as the largest tree has; smaller trees stay at their last node.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = []
    for number in range(_levels(most, arity)):
        levels.append(stored(with_siblings(nodes, arity), f"merkle-{name}{number}"))
        nodes = parents(levels[-1], arity)
    return levels, nodes.select("tree", "own")


def _step() -> Column:
    """A step of a path, none where the node was the last of its tree."""
    return F.when(F.col("n") > 1, F.array(F.struct("before", "after"))).otherwise(_no_steps())


def _no_steps() -> Column:
    return F.array().cast("array<struct<before:binary,after:binary>>")


def downward(level: DataFrame, upper: DataFrame, arity: int) -> DataFrame:
    """Nodes of a level with what ``upper`` has of their parents: all its columns but ``tree, idx``.

    In ``path`` their own step comes before the parent's.
    """
    carried = [name for name in upper.columns if name not in ("tree", "idx", "path")]
    parent = F.call_function("div", F.col("idx"), F.lit(arity).cast("bigint"))
    rest = upper.select("tree", F.col("idx").alias("up"), F.col("path").alias("rest"), *carried)
    joined = level.withColumn("up", parent).join(rest, ["tree", "up"])
    return joined.withColumn("path", F.concat(_step(), "rest")).drop("up", "rest", "n", "own", "before", "after")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda acc, step: digest(hex_text(F.concat(step["before"], acc, step["after"]))))


def proof_bytes(path: Column) -> Column:
    return F.aggregate(path, F.unhex(F.lit("")), lambda acc, step: F.concat(acc, step["before"], step["after"]))


def manifest(
    docs: DataFrame,
    *,
    columns: tuple[str, ...] = LEAF_COLUMNS,
    tree_col: str = "lang",
    id_col: str = "doc_id",
    arity: int = ARITY,
    offered: Column | None = None,
) -> DataFrame:
    """``doc_id, leaf, subroot, root, path, offered`` of every row, digests as bytes.

    A leaf is the hash of the row's ``columns``. Each value of ``tree_col`` is a tree, NULL too, its leaves
    in order of the id, NULL first, and of the leaf where ids are tied; rows alike in all ``columns`` are leaves of
    their own. The trees' roots, in order of the value, make the tree of ``root``. ``offered`` is a text whose
    hash is put to the proof in place of the leaf (``folded``), by default the row itself. Long texts are
    hashed whole, other columns are not looked at, an empty table has no rows.
    """
    whole = encoded_row([docs[name] for name in columns])
    hashed = docs.select(
        docs[id_col].alias("doc_id"),
        tree_key(docs[tree_col].cast("string")).alias("tree"),
        digest(whole).alias("leaf"),
        (digest(offered) if offered is not None else F.lit(None).cast("binary")).alias("offered"),
    )
    # Texts are read once, for the leaves.
    leaves = numbered(stored(hashed, "merkle-leaves"), "tree", ["doc_id", "leaf", "offered"])
    nodes = stored(leaves, "merkle-numbers")
    levels, subroots = grow(nodes.select("tree", "idx", "n", F.col("leaf").alias("own")), arity, "level")
    subroots = stored(subroots, "merkle-subroots")
    top = numbered(subroots.select(F.lit("all").alias("tree"), F.col("tree").alias("below"), "own"), "tree", ["below"])
    top = stored(top, "merkle-top-numbers")
    top_levels, roots = grow(top.select("tree", "idx", "n", "own"), arity, "top")
    # From the root down: what a node has of all above it, at last the subroots, which are last nodes of their trees.
    upper = roots.select("tree", F.lit(0).cast("bigint").alias("idx"), _no_steps().alias("path"), F.col("own").alias("root"))
    for level in reversed(top_levels):
        upper = downward(level, upper, arity)
    ends = top.select("tree", "idx", "below", F.col("own").alias("subroot")).join(upper, ["tree", "idx"])
    upper = ends.select(F.col("below").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "path", "root", "subroot")
    for level in reversed(levels[1:]):
        upper = downward(level, upper, arity)
    rows = nodes.select("doc_id", "tree", "idx", "leaf", F.coalesce("offered", "leaf").alias("offered"))
    if levels:
        proven = downward(rows.join(levels[0], ["tree", "idx"]), upper, arity)
    else:
        proven = rows.join(upper, ["tree", "idx"])
    return proven.select("doc_id", "leaf", "subroot", "root", "path", "offered")


def op12_merkle(spark, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, a third of them offered with a changed text."""
    docs = table(spark, sf_dir, "documents").select(*LEAF_COLUMNS)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(changed, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    tampered = encoded_row([F.col(name) for name in LEAF_COLUMNS[:-1]] + [text])
    proven = manifest(docs, offered=tampered)
    found = folded(F.col("offered"), F.col("path"))
    return proven.select(
        "doc_id",
        *[hex_text(F.col(name)).alias(name) for name in ("leaf", "subroot", "root")],
        F.sha2(hex_text(proof_bytes(F.col("path"))), 256).alias("proof_sha256"),
        hex_text(found).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


OP12_SQL = """
with recursive rows_ as (
  select row_number() over () as k, doc_id, lang, "text",
         list_reduce(
           list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)),
           lambda crc, b: list_reduce(
             list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
             lambda x, z: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)) as crc,
         coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen("source") || ':' || "source", '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head
  from documents),
changed as (
  select *, case when xor(crc, 4294967295) % 3 = 0
                 then translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else "text" end as other
  from rows_),
leaves as (
  select k, doc_id, lang, sha256(head || coalesce(strlen("text") || ':' || "text", '-')) as leaf,
         sha256(head || coalesce(strlen(other) || ':' || other, '-')) as offered
  from changed),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf, offered) - 1 as i, count(*) over (partition by lang) as n
  from leaves),
nodes as (
  select lang, 0 as lv, i, n, leaf as h from placed
  union all
  select lang, lv + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' order by i)) from nodes where n > 1 group by lang, lv, i // 8, n),
subroots as (
  select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n from nodes where n = 1),
tops as (
  select 0 as lv, i, n, subroot as h from subroots
  union all
  select lv + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' order by i)) from tops where n > 1 group by lv, i // 8, n),
siblings as (
  select p.k, 0 as part, o.lv, o.i, o.h
  from placed p join nodes o on o.lang is not distinct from p.lang and o.n > 1
  where o.i // 8 = p.i // (1::bigint << (3 * o.lv + 3)) and o.i <> p.i // (1::bigint << (3 * o.lv))
  union all
  select p.k, 1, o.lv, o.i, o.h
  from placed p join subroots s on s.lang is not distinct from p.lang join tops o on o.n > 1
  where o.i // 8 = s.i // (1::bigint << (3 * o.lv + 3)) and o.i <> s.i // (1::bigint << (3 * o.lv))),
proofs as (select k, sha256(string_agg(h, '' order by part, lv, i)) as proof from siblings group by k),
climbed as (
  select k, lang, i, 0 as lv, offered as h from placed
  union all
  select c.k, c.lang, c.i // 8, c.lv + 1, sha256(string_agg(case when o.i = c.i then c.h else o.h end, '' order by o.i))
  from climbed c join nodes o on o.lang is not distinct from c.lang and o.lv = c.lv and o.n > 1 and o.i // 8 = c.i // 8
  group by c.k, c.lang, c.i, c.lv),
below as (select k, lang, arg_max(h, lv) as h from climbed group by k, lang),
topped as (
  select b.k, s.i, 0 as lv, b.h from below b join subroots s on s.lang is not distinct from b.lang
  union all
  select c.k, c.i // 8, c.lv + 1, sha256(string_agg(case when o.i = c.i then c.h else o.h end, '' order by o.i))
  from topped c join tops o on o.lv = c.lv and o.n > 1 and o.i // 8 = c.i // 8
  group by c.k, c.i, c.lv),
ends as (select k, arg_max(h, lv) as folded_root from topped group by k)
select doc_id, leaf, subroot, root, coalesce(proof, sha256('')) as proof_sha256, folded_root, folded_root = root as verified
from placed join subroots s on s.lang is not distinct from placed.lang join ends using (k) left join proofs using (k),
     (select h as root from tops where n = 1)"""
