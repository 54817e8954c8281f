"""N-gram Jaccard join by pigeonhole over a partition of the universe.

A document is its set of word n-grams. Two sets with Jaccard similarity of at least a/b differ
in few elements: at most ``H = (r + s)(b - a) / (a + b)`` of sizes r and s. The universe of
n-grams is cut by a hash into segments. If the larger set gives its segments allowances
that add up to more than H (1 for a segment that must agree, 2 for one that may differ in one
element), then any set so close to it keeps within the allowance in some segment. Candidates are
therefore found by equality of signatures: a hash of the elements of one segment, or of all but one
of them.

* The number of segments depends on the size band of the larger set; a set is indexed for its
  own band and for the next where a partner may be in that.
* All segments are indexed; in the lower bands, where segments are few, also with one element
  left out. A set looks only in segments that its allocation chooses: the cheapest
  ones, by how many elements make a signature rare and by how many signatures a deletion costs.
* Empty segments are indexed apart and looked at only if all else does not suffice.

Sets that agree altogether are one node from the start. In each bucket of equal signatures the other
nodes are compared with one of them, its centre, exactly; a bucket in which all are found similar
is settled by that. Where a comparison fails, members of the same centre may still be similar
to one another. Such pairs are found by what their members' differences from the centre have in common
(``_other_pairs``), and compared as well. So a group of copies costs as much as it has
members, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lanebeacon.llm.common import small_batches, stored, table
from lanebeacon.llm.components import components
from lanebeacon.llm.words import mixed, raw_bytes, text_blocks, word_hashes

# The first band ends at this size, each other one GROWTH times further.
FIRST_BAND, GROWTH, BANDS = 6, 1.5, 60
# Segments more than the allowances need: the more, the more have to agree. Small sets have more
# of them, as they are cheap there. Up to WITH_DELETIONS needed segments deletions are indexed.
SPARE, SPARE_IF_SMALL, SMALL = 0.12, 0.5, 64
WITH_DELETIONS = 24
EMPTY_PARTS = 256
# Nodes that a task remembers, so as not to send the rows of copies again.
REMEMBERED = 100_000
# Bits of the bitmap that tells which nodes have candidates: 8 MB, whatever the size of the table.
BITMAP_BITS = 1 << 26
EXACT, PROBE, OWN = 1, 2, 4


@dataclass(frozen=True)
class Similarity:
    """Word n-grams of ``width`` words, similar from ``num / den`` on."""

    width: int = 5
    num: int = 80
    den: int = 100

    def distance(self, total):
        """Largest number of different elements of two similar sets with ``total`` elements together."""
        return total * (self.den - self.num) // (self.den + self.num)

    def bands(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Upper size, number of segments and use of deletions of each band."""
        tops = [FIRST_BAND]
        while len(tops) < BANDS:
            tops.append(int(tops[-1] * GROWTH) if len(tops) > 1 else 2 * FIRST_BAND)
        upper = np.array(tops, dtype=np.int64)
        needed = self.distance(2 * upper) + 1
        spare = np.ceil(needed * np.where(needed <= SMALL, SPARE_IF_SMALL, SPARE)).astype(np.int64) + 1
        segments = needed + np.where(needed > 1, spare, 0)
        return upper, segments, (needed > 1) & (needed <= WITH_DELETIONS)


def gram_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For blocks of texts ``first`` to ``last``: each text's different n-grams as sorted hashes, and its owner.

    A text of fewer words is one n-gram, a text without words has none.
    """
    content, offsets = raw_bytes(texts)
    for first, last in text_blocks(offsets):
        words, counts = word_hashes(content, offsets[first : last + 1])
        starts = np.cumsum(counts) - counts
        n = len(words) - width + 1
        grams = np.zeros(max(n, 0), np.uint64)
        for j in range(width):
            grams = mixed(grams + words[j : j + n] + np.uint64(j + 1)) if n > 0 else grams
        owner = np.repeat(np.arange(last - first), counts)
        whole = owner[: max(n, 0)] == owner[width - 1 :] if n > 0 else np.zeros(0, bool)
        grams, owners = grams[whole], owner[: max(n, 0)][whole]
        short = np.flatnonzero((counts > 0) & (counts < width))
        if short.size:
            single = np.zeros(short.size, np.uint64)
            for j in range(width - 1):
                there = counts[short] > j
                single[there] = mixed(single[there] + words[starts[short[there]] + j] + np.uint64(101 * (j + 1)))
            grams, owners = np.concatenate([grams, single]), np.concatenate([owners, short])
        order = np.lexsort((grams, owners))
        grams, owners = grams[order], owners[order]
        fresh = np.ones(len(grams), dtype=bool)
        fresh[1:] = (grams[1:] != grams[:-1]) | (owners[1:] != owners[:-1])
        yield first, last, grams[fresh], owners[fresh]


def node_of(grams: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of elements and node of each set: a hash that sets have in common only if they agree."""
    sums = np.zeros(n, np.uint64)
    np.add.at(sums, owners, mixed(grams ^ np.uint64(0x5DEECE66D)))
    sizes = np.bincount(owners, minlength=n)
    return sizes, mixed(sums + sizes.astype(np.uint64)).view(np.int64)


def signatures(
    grams: np.ndarray, owners: np.ndarray, sizes: np.ndarray, nodes: np.ndarray, like: Similarity
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``signature, node, info`` rows of the sets.

    ``info`` has the row's roles, and for whole segments of the own band (``OWN``) 8 times the number of
    them that have to agree with any similar set that is not larger: each different element spoils one.
    """
    upper, segments, deletions = like.bands()
    n = len(sizes)
    own = np.searchsorted(upper, sizes)
    reach = sizes * like.den // like.num
    value = mixed(grams ^ np.uint64(0xB5297A4D3F84D5B5))
    for step in range(3):
        band = own + step
        # The band itself, and higher ones in which a similar larger set may be.
        there = (sizes > 0) & ((step == 0) | (upper[np.minimum(band, BANDS) - 1] < reach))
        if not there.any():
            continue
        m = np.where(there, segments[np.minimum(band, BANDS - 1)], 0)
        base = np.cumsum(m) - m
        total = int(m.sum())
        kept = there[owners]
        who, val = owners[kept], value[kept]
        spread = mixed(val + (band[who] + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        cell = base[who] + ((spread * m[who].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, cell, val)
        counts = np.bincount(cell, minlength=total)
        holder = np.repeat(np.arange(n), m)
        place = ((band[holder] << 32) + np.arange(total) - base[holder]).astype(np.uint64)
        place = mixed(place + np.uint64(1))
        signature = mixed(sums + place)
        probes = np.zeros(total, dtype=np.int8)  # 0: none, 1: must agree, 2: may differ in one element
        empty_probe = np.zeros(n, dtype=bool)
        if step == 0:
            probes, empty_probe = _allocate(counts, holder, like.distance(2 * sizes) + 1, deletions[band[holder]], n)
        filled = counts > 0
        role = EXACT + PROBE * (probes > 0)
        if step == 0:
            agree = np.bincount(holder[filled], minlength=n) - like.distance(2 * sizes)
            role = role + OWN + 8 * np.maximum(agree, 0)[holder]
        yield signature[filled], nodes[holder[filled]], role[filled]
        single = deletions[np.minimum(band, BANDS - 1)][who]
        if single.any():
            part, without = cell[single], sums[cell[single]] - val[single]
            rest = counts[part] > 1
            part, without = part[rest], without[rest]
            yield mixed(without + place[part]), nodes[holder[part]], PROBE * (probes[part] == 2)
            # A segment of one element less that one is an empty segment.
            lone = cell[single][~rest]
            yield _empty(place[lone], nodes[holder[lone]], 0), nodes[holder[lone]], np.zeros(len(lone), np.int64)
        vacant = np.flatnonzero(~filled)
        yield _empty(place[vacant], nodes[holder[vacant]], 0), nodes[holder[vacant]], np.full(len(vacant), EXACT)
        asked = vacant[empty_probe[holder[vacant]]]
        for part in range(EMPTY_PARTS) if asked.size else ():
            yield _empty(place[asked], None, part), nodes[holder[asked]], np.full(len(asked), EXACT + PROBE)


def _empty(place: np.ndarray, nodes: np.ndarray | None, part: int) -> np.ndarray:
    """Signature of an empty segment; as many sets have one, they are dealt into parts by their node."""
    parts = np.uint64(part) if nodes is None else nodes.view(np.uint64) % np.uint64(EMPTY_PARTS)
    return mixed(place ^ mixed(parts + np.uint64(0xE0)))


def _allocate(
    counts: np.ndarray, holder: np.ndarray, needed: np.ndarray, deletions: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Allowance of each segment, and which sets have to look at empty segments as well.

    A signature of few elements is likely to be met often, so that is what it costs; a deletion
    costs one signature for each element. The cheapest are taken until a set has what it needs. An allowance of
    2 always costs more than that of 1 in the same segment, so it comes later.
    """
    agree = np.flatnonzero(counts > 0)
    may = np.flatnonzero(deletions & (counts > 1))
    size_a, size_m = counts[agree].astype(float), counts[may].astype(float)
    cost = np.concatenate([1 + 64 * 0.5**size_a, size_m * (1 + 64 * 0.5 ** (size_m - 1))])
    where = np.concatenate([agree, may])
    order = np.lexsort((cost, holder[where]))
    sets = holder[where][order]
    firsts = np.searchsorted(sets, np.arange(n))
    turn = np.arange(len(sets)) - firsts[sets]
    taken = where[order][turn < needed[sets]]
    allowance = np.bincount(taken, minlength=len(counts)).astype(np.int8)
    return allowance, np.bincount(sets, minlength=n) < needed


def gram_nodes(docs: DataFrame, like: Similarity, text_col: str = "text") -> Column:
    """Struct of ``n``, the number of different n-grams, and ``node``; NULL text counts as empty."""

    @arrow_udf("struct<n: bigint, node: bigint>")
    def nodes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            n, node = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for first, last, grams, owners in gram_sets(texts, like.width):
                n[first:last], node[first:last] = node_of(grams, owners, last - first)
            yield pa.StructArray.from_arrays([pa.array(n), pa.array(node)], ["n", "node"])

    return nodes(F.col(text_col))


def _signature_rows(docs: DataFrame, like: Similarity, text_col: str) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for first, last, grams, owners in gram_sets(batch.column(0), like.width):
                sizes, nodes = node_of(grams, owners, last - first)
                # A text that a task meets again is indexed once: copies have the same rows, which mean the same once or often.
                if len(seen) > REMEMBERED:
                    seen.clear()
                again = np.ones(last - first, dtype=bool)
                again[[i for i in np.unique(nodes, return_index=True)[1].tolist() if int(nodes[i]) not in seen]] = False
                seen.update(nodes[~again].tolist())
                keep = ~again[owners]
                sizes = np.where(again, 0, sizes)
                for signature, node, info in signatures(grams[keep], owners[keep], sizes, nodes, like):
                    if len(node):
                        columns = [signature.view(np.int64), node, info.astype(np.int64)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["signature", "node", "info"])

    return docs.select(text_col).mapInArrow(rows, "signature bigint, node bigint, info bigint")


def _set_rows(docs: DataFrame, like: Similarity, text_col: str, wanted: DataFrame) -> DataFrame:
    """``node, grams`` of the nodes in ``wanted``, and of a few others that share their bits in a bitmap."""
    bit = F.pmod("node", F.lit(BITMAP_BITS))
    cells = (
        wanted.select(F.floor(bit / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(64)).cast("int")).alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()
    )
    words = np.zeros(BITMAP_BITS // 64, np.int64)
    words[cells["word"].to_numpy(dtype=np.int64)] = cells["bits"].to_numpy(dtype=np.int64)
    bitmap = docs.sparkSession.sparkContext.broadcast(words)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for first, last, grams, owners in gram_sets(batch.column(0), like.width):
                sizes, nodes = node_of(grams, owners, last - first)
                bits = nodes % BITMAP_BITS
                marked = (bitmap.value[bits // 64] >> (bits % 64)) & 1
                starts = np.cumsum(sizes) - sizes
                chosen = [i for i in np.flatnonzero((marked == 1) & (sizes > 0)).tolist() if int(nodes[i]) not in seen]
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen.update(nodes[chosen].tolist())
                for at in range(0, len(chosen), 256):
                    some = chosen[at : at + 256]
                    sets = pa.array([grams[starts[i] : starts[i] + sizes[i]].view(np.int64) for i in some], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), sets], ["node", "grams"])

    return docs.select(text_col).mapInArrow(rows, "node bigint, grams array<bigint>").dropDuplicates(["node"])


def _compared(pairs: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """``a, b, grams_a, grams_b, size_a, size_b, apart, similar`` of pairs of nodes, by their whole sets."""
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
    both = (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumns({"size_a": F.size("grams_a"), "size_b": F.size("grams_b")})
        .withColumn("common", F.size(F.array_intersect("grams_a", "grams_b")))
    )
    total = (F.col("size_a") + F.col("size_b")).cast("bigint")
    return both.withColumns(
        {
            "apart": (total - 2 * F.col("common")).cast("int"),
            "similar": F.col("common") * F.lit(like.den).cast("bigint") >= (total - F.col("common")) * like.num,
        }
    )


def similar_nodes(docs: DataFrame, like: Similarity, *, text_col: str = "text") -> DataFrame:
    """``node, component`` of every node that is similar to another one."""
    small_batches(docs.sparkSession)
    rows = _signature_rows(docs, like, text_col)
    bucket = Window.partitionBy("signature")
    met = (
        rows.withColumns(
            {
                "members": F.count(F.lit(1)).over(bucket),
                "apart": F.max("node").over(bucket) != F.min("node").over(bucket),
            }
        )
        .where("apart")
        .select("signature", "node", "info", "members")
    )
    met = stored(met, "buckets")
    # A node needs so many of its segments to agree with a partner that is not larger. If fewer
    # of them agree with anyone, it has no such partner and need not look.
    agreeing = F.count_if(F.col("info").bitwiseAND(OWN) > 0) >= F.coalesce(F.max(F.shiftright("info", 3)), F.lit(0))
    # The centre of a bucket is the node that shares most buckets with others, so that a group has few centres.
    each = met.groupBy("node").agg(F.sum("members").alias("shared"), agreeing.alias("asks"))
    stars = (
        met.join(each, "node")
        .withColumn("asks", F.col("asks") & (F.col("info").bitwiseAND(PROBE) > 0))
        .withColumns({"centre": F.max(F.struct("shared", "node")).over(bucket)["node"], "looks": F.max("asks").over(bucket)})
        .where("looks and node != centre")
        .select("signature", F.col("centre").alias("a"), F.col("node").alias("b"), "asks")
    )
    stars = stored(stars, "stars")
    pairs = stars.select("a", "b").distinct()
    sets = stored(_set_rows(docs, like, text_col, pairs.select(F.explode(F.array("a", "b")).alias("node"))), "sets")
    judged = _compared(pairs, sets, like).select("a", "b", "size_a", "size_b", "apart", "similar")
    judged = stored(judged, "judged")
    links = judged.where("similar").select("a", "b")
    found = stored(components(links), "components")
    more = stored(_other_pairs(stars, judged, found, sets, like), "other-pairs")
    late = _compared(more, sets, like).where("similar").select("a", "b")
    late = stored(late, "late-links")
    return found if late.isEmpty() else components(links.unionByName(late))


def _other_pairs(stars: DataFrame, judged: DataFrame, found: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """Pairs ``a, b`` of members of one centre that may be similar although a comparison with the centre failed.

    Only members of buckets in which two of them are in different components and one looks are looked at.
    Let y and z differ from the centre in ``d_y`` and ``d_z`` elements, and o of those be the same. Then
    y and z differ in ``d_y + d_z - 2 o`` elements, so if similar they have ``o >= (d_y + d_z - H) / 2``.

    * Where that is 0 or less they are similar for certain, and so are both to the member with
      the largest slack ``K size - d``: each member outside is paired with that one.
    * Otherwise their differences share an element, and one among the first of both in order of
      rarity: leaving out all but ``o`` of them leaves one that is shared (prefix filter).
    """
    k = (like.den - like.num) / (like.den + like.num)
    part = found.select(F.col("node").alias("b"), "component")
    open_centres = judged.where("not similar").select("a").distinct()
    placed = (
        stars.join(open_centres, "a", "left_semi").join(part, "b", "left").withColumn("component", F.coalesce("component", "b"))
    )
    bucket = Window.partitionBy("signature")
    apart = F.min("component").over(bucket) != F.max("component").over(bucket)
    members = (
        placed.withColumn("open", apart & F.max("asks").over(bucket))
        .where("open")
        .groupBy("a", "b", "component")
        .agg(F.max("asks").alias("asks"))
        .join(judged, ["a", "b"])
        .withColumn("slack", F.col("size_b") * k - F.col("apart"))
    )
    members = stored(members, "open-members")
    widest = members.groupBy("a").agg(F.max(F.struct("slack", F.col("b").alias("node"), "component")).alias("widest"))
    with_widest = (
        members.join(widest, "a")
        .where(F.col("component") != F.col("widest.component"))
        .select(F.col("widest.node").alias("x"), F.col("b").alias("y"))
    )

    # Rows of elements in which members differ from their centre, the rarest first. An element that only
    # one member has cannot be shared, but it counts in the order.
    compared = _compared(members.drop("size_a", "size_b", "apart", "similar"), sets, like)
    grams = F.concat(F.array_except("grams_a", "grams_b"), F.array_except("grams_b", "grams_a"))
    kept = ["a", "b", "component", "asks", "similar", "apart", "size_a", "size_b"]
    ranked = (
        stored(compared.select(*kept, grams.alias("grams")), "differences")
        .select(*kept, F.explode("grams").alias("gram"))
        .withColumn("often", F.count(F.lit(1)).over(Window.partitionBy("a", "gram")))
        .withColumn("place", F.row_number().over(Window.partitionBy("a", "b").orderBy("often", "gram")))
        .where("often > 1")
    )
    with_failed = F.greatest(F.lit(1), F.ceil((F.col("apart") + k * (F.col("size_a") - F.col("size_b"))) / 2 - 1e-9))
    with_close = F.greatest(F.lit(1), F.ceil((F.col("apart") - k * (F.col("size_a") + F.col("size_b"))) / 2 - 1e-9))
    reach = F.when(F.col("similar"), with_failed).otherwise(F.least(with_failed, with_close))
    first = (
        ranked.where(F.col("place") <= F.col("apart") - reach + 1)
        .withColumn("early", F.col("place") <= F.col("apart") - with_failed + 1)
        .select("a", "gram", "b", "component", "asks", "similar", "early", "apart", "place", "size_b")
    )
    first = stored(first, "first-differences")
    one, other = first.alias("one"), first.alias("other")
    # From the first shared element on, there must be as many left as have to be shared.
    left = F.least(F.col("one.apart") - F.col("one.place"), F.col("other.apart") - F.col("other.place")) + 1
    total = F.col("one.size_b") + F.col("other.size_b")
    needed = F.col("one.apart") + F.col("other.apart") - F.floor(total * (like.den - like.num) / (like.den + like.num))
    sharing = one.join(
        other,
        (F.col("one.a") == F.col("other.a"))
        & (F.col("one.gram") == F.col("other.gram"))
        & (F.col("one.b") < F.col("other.b"))
        & (F.col("one.component") != F.col("other.component"))
        & (F.col("one.asks") | F.col("other.asks"))
        & (F.col("one.similar") | F.col("other.similar") | (F.col("one.early") & F.col("other.early")))
        & (2 * left >= needed)
        & (F.least("one.size_b", "other.size_b") * like.den >= F.greatest("one.size_b", "other.size_b") * like.num),
    ).select(F.col("one.b").alias("x"), F.col("other.b").alias("y"))
    every = with_widest.unionByName(sharing)
    return every.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _linked(docs: DataFrame, like: Similarity, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Every row's ``doc_id, n_shingles, node``; and of every node ``component, component_id, first_node``.

    ``first_node`` is the one node of the component whose text stands for it: that of the smallest id.
    """
    small_batches(docs.sparkSession)
    measured = docs.select(F.col(id_col).alias("doc_id"), gram_nodes(docs, like, text_col).alias("set"))
    each = stored(measured.select("doc_id", F.col("set.n").alias("n_shingles"), "set.node"), "gram-nodes")
    nodes = each.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("smallest"))
    found = similar_nodes(docs, like, text_col=text_col)
    labelled = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = labelled.groupBy("component").agg(
        F.min(F.struct(F.col("smallest").isNull().alias("none"), "smallest", "node")).alias("first")
    )
    firsts = firsts.select("component", F.col("first.smallest").alias("component_id"), F.col("first.node").alias("first_node"))
    return each, labelled.select("node", "component").join(firsts, "component")


def link_documents(
    docs: DataFrame, like: Similarity = Similarity(), *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    ``component_id`` is the smallest id that links lead to, the own one included. NULL and
    empty texts have no n-grams and no links. A NULL id is never the smallest; if a component
    has no other, its ``component_id`` is NULL. Rows that share an id count each by their own
    text. An empty table gives no rows. Other columns are not looked at.
    """
    each, of_node = _linked(docs, like, id_col, text_col)
    linked = each.where("n_shingles > 0").join(of_node, "node").select("doc_id", "n_shingles", "component_id")
    alone = each.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def keep_one(docs: DataFrame, like: Similarity = Similarity(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, with all its columns as they are.

    Texts without words are linked with nothing, so all of them stay.
    """
    each, of_node = _linked(docs, like, id_col, text_col)
    rows = docs.select(
        F.struct(*[docs[name] for name in docs.columns]).alias("row"),
        docs[id_col].alias("own_id"),
        gram_nodes(docs, like, text_col).alias("set"),
    )
    alone = rows.where("set.n = 0").select("row.*")
    # Each node that stays, with the id that stays; one row for each.
    staying = of_node.where("node = first_node").select(F.col("node").alias("stays"), "component_id")
    of_id = rows.where("set.n > 0").join(
        staying, (F.col("set.node") == F.col("stays")) & F.col("own_id").eqNullSafe(F.col("component_id"))
    )
    return of_id.dropDuplicates(["stays"]).select("row.*").unionByName(alone)


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Every document's set size and component, for 4-word shingles and 85 hundredths."""
    return link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), Similarity(4, 85, 100))
