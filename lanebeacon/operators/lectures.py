"""Who sat in which lecture: sightings in a booked room within the booked time.

The join is on a room and an interval. Time is cut into buckets, and on levels above into cells of one bucket, two,
four and so on. Each booking stands once, on the level on which it ends in the next cell or the one after that, in
the cell it begins in. Sightings are reduced to one row per client and spot (a room, level and cell): the last second in the
cell and the first in the two cells that follow. A client was there if the former is not before the booking or the
latter not after it. So a booking and a client meet in one spot and in one row, and pairs need not be made distinct,
nor shuffled, unless a name has several bookings.

A booking within one bucket is settled by the bucket's first and last second if it reaches an end of the bucket; only one
that lies strictly inside looks at the seconds, and only sightings of rooms and buckets that hold such a
booking keep theirs, each with the one before it, so that the first second within the booking is the only one to count.

Crowded spots are found by counting:
those that would make more than their share of all pairs are dealt into as many shares as
they need, so that no task has to pair up a crowded hour alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lanebeacon.functions.rooms import LECTURE_ROOMS, Rules, room_name, without_blanks
from lanebeacon.functions.time import HOUR, epoch_seconds

# Level 0 is for bookings within one bucket; on level n cells are 2 ** (n - 1) buckets wide. Ten thousand years of seconds
# need no more.
LEVELS = 40
# The level of single seconds within the buckets.
SECONDS = -1
SPOT = ["room", "level", "bucket"]
# A spot is crowded if it makes more pairs than one part in so many per task; that also bounds how many there are.
PARTS_PER_TASK = 8
# Shares of one part: many small ones spread more evenly over the tasks than few large ones.
SHARES_PER_PART = 4
# Pairs that no task needs help with.
FEW_PAIRS = 100_000
# Bits of the filter that says which rooms and buckets hold a booking within one bucket.
FILTER_BITS = 1 << 18


def booked_times(bookings: DataFrame, rules: Rules | None = LECTURE_ROOMS, *, tz: str = "UTC") -> DataFrame:
    """``name, room, start, end`` of the bookings in rooms of ``rules``, distinct and in epoch seconds.

    The other operators take them in place of the bookings, which they look at several times: written down, they spare
    each time what the bookings are made from. ``rules`` and ``tz`` were applied here and change them no more.
    """
    return _held(bookings, rules, tz)


def lecture_attendance(
    readings: DataFrame,
    meta: DataFrame,
    bookings: DataFrame,
    rules: Rules | None = LECTURE_ROOMS,
    *,
    tz: str = "UTC",
    bucket_seconds: int = HOUR,
    shares: tuple[int, int] | None = None,
) -> DataFrame:
    """Distinct (lecture name, client) pairs; both ends of a booking count as inside.

    ``rules`` reduces locations and booked rooms to the same room names, and what
    matches no rule drops out; ``rules=None`` compares the two texts as they are.
    ``tz`` is the zone the booking times are written in. Sightings and bookings are counted per room and bucket
    when the function is called, and crowded ones are dealt into shares of clients and of bookings, each
    pair of which is joined by itself; ``shares`` deals all of them into that many instead, without counting.
    ``bookings`` may also be ``booked_times`` of them.
    """
    return _attendance(readings.select("did", "cid", "ts"), meta, bookings, rules, tz, bucket_seconds, shares)


def lecture_connections(
    readings: DataFrame,
    meta: DataFrame,
    bookings: DataFrame,
    rules: Rules | None = LECTURE_ROOMS,
    *,
    tz: str = "UTC",
    bucket_seconds: int = HOUR,
    shares: tuple[int, int] | None = None,
) -> DataFrame:
    """Per lecture, the connections its attendees made anywhere and at any time.

    A client's connections are the distinct times it was seen. The readings are scanned and
    shuffled once, for both the attendance and the counts. The counts join the clients of a spot before those meet
    the bookings, so that each task adds up its pairs as it makes them.
    Sightings without a router, client or time are left out. ``bookings`` may also be ``booked_times`` of them.
    """
    # With these filters said here, neither branch adds one of its own, and both share one shuffle.
    whole = "did is not null and cid is not null and ts is not null"
    raw = readings.where(whole).select("did", "cid", "ts")
    # A filter on the number of copies, of which there always is one: without it Spark would leave out the step for the
    # counts alone, as those need none, and scan the readings once more.
    seen = raw.groupBy("did", "cid", "ts").agg(F.count(F.lit(1)).alias("copies")).where("copies > 0").drop("copies")
    per_client = seen.groupBy("cid").agg(F.count_distinct("ts").alias("connections"))
    attendance = _attendance(seen, meta, bookings, rules, tz, bucket_seconds, shares, raw, per_client)
    return attendance.groupBy("name").agg(F.sum("connections").alias("connections"))


def _attendance(
    readings: DataFrame,
    meta: DataFrame,
    bookings: DataFrame,
    rules: Rules | None,
    tz: str,
    width: int,
    shares: tuple[int, int] | None,
    raw: DataFrame | None = None,
    per_client: DataFrame | None = None,
) -> DataFrame:
    """``raw`` has the sightings as they are stored, if ``readings`` are not, for the count of crowded spots.

    The pairs have the columns of ``per_client``, which is joined by ``cid``.
    """
    held = _held(bookings, rules, tz)
    pieces = _booking_pieces(bookings, rules, tz, width)
    # Only rooms that are booked at all, with the levels of their bookings: other rooms are kept out of every step.
    # A hash of their spots to 64 bits leaves out most spots of rooms that have few bookings.
    booked = (
        _located(held, width)
        .groupBy("room")
        .agg(F.bit_or(_bit(F.greatest("level", F.lit(0)))).alias("levels"), F.bit_or(_mark()).alias("marks"))
    )
    rooms = _router_rooms(meta, rules).join(booked, "room")
    seen, stored = (rows.where("ts is not null").join(rooms, "did") for rows in (readings, readings if raw is None else raw))
    if shares is None:
        may_be = _may_be_crowded(readings if raw is None else raw, meta, bookings, rules)
        shares = _crowded(stored, pieces, width) if may_be else []
    clients = _clients_per_bucket(seen, width, _within_one_bucket(held, width), per_client)
    first, last, lo, hi = (F.col(name) for name in ("first", "last", "lo", "hi"))
    in_time = (
        F.when(F.col("level") == SECONDS, (first >= lo) & (first <= hi) & F.coalesce(last < lo, F.lit(True)))
        .when(F.col("level") == 0, (first <= hi) & (last >= lo))
        .otherwise(F.coalesce(last >= lo, F.lit(False)) | F.coalesce(first <= hi, F.lit(False)))
    )
    columns = ["name", "cid"] if per_client is None else ["name", *per_client.columns]
    once, several = (
        _meet(clients, pieces.where(which).drop("several"), shares).where(in_time).select(*columns)
        for which in (~F.col("several"), F.col("several"))
    )
    return once.unionByName(several.distinct())


def _router_rooms(meta: DataFrame, rules: Rules | None) -> DataFrame:
    location = F.col("location")
    room = location if rules is None else room_name(location, rules)
    return meta.select("did", room.alias("room")).where("room is not null").distinct()


def _clients_per_bucket(
    seen: DataFrame, width: int, wanted: bytes | None = None, per_client: DataFrame | None = None
) -> DataFrame:
    """One row per client and spot, ``room, level, bucket, cid, first, last``, and the columns of ``per_client``.

    On level 0 stand the first and last second in the bucket, above the first one in the two cells that follow and the last
    one in the cell itself, NULL for none. On the level of
    seconds each second is a row of its own, where the filter ``wanted`` lets its room and bucket pass, and ``last`` is the
    one before. Columns ``levels`` and ``marks`` have the bits of the levels and spots that a room needs; without them all are made.
    """
    # Naming a value for NULL, though ts is never NULL here, keeps the join from checking it on the raw
    # rows of one branch only; branches that differ could not share a scan.
    bucket = F.coalesce(_floor_div(F.col("ts"), width), F.lit(0).cast("bigint"))
    second = F.coalesce(F.col("ts").cast("bigint"), F.lit(0).cast("bigint"))
    spots = seen.select("room", *_needed(seen), bucket.alias("bucket"), "cid", second.alias("first"))
    several = spots if wanted is None else spots.where(_passes(wanted))
    before = F.lag("first").over(Window.partitionBy("room", "bucket", "cid").orderBy("first"))
    seconds = several.select("room", "bucket", "cid", "first").distinct().withColumn("last", before)
    finest = spots.groupBy("room", "bucket", "cid").agg(
        F.max("levels").alias("levels"), F.max("marks").alias("marks"), F.min("first").alias("first"), F.max("first").alias("last")
    )
    if per_client is not None:
        seconds, finest = seconds.join(per_client, "cid"), finest.join(per_client, "cid")
    more = [name for name in finest.columns if name not in ("room", "levels", "marks", "bucket", "cid", "first", "last")]
    # All cells of a client in a room are in one task, so that the levels above need no shuffle.
    together = finest.repartition(_tasks(seen), "room", "cid")
    each = together.select("room", "marks", "cid", *more, "bucket", "first", "last", F.explode(_set_bits(F.col("levels"))).alias("level"))
    none = F.lit(None).cast("bigint")
    cell = _cell(F.col("bucket"), F.col("level"))
    around = F.array(
        F.struct(cell.alias("bucket"), none.alias("first"), F.col("last").alias("last")),
        *[F.struct((cell - back).alias("bucket"), F.col("first").alias("first"), none.alias("last")) for back in (1, 2)],
    )
    itself = F.array(F.struct("bucket", "first", "last"))
    cells = each.select("room", "marks", "cid", *more, "level", F.inline(F.when(F.col("level") == 0, itself).otherwise(around)))
    merged = cells.where(_marked()).groupBy("room", "level", "bucket", "cid", *more).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.unionByName(seconds.withColumn("level", F.lit(SECONDS)))


def _tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bit(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level)


def _mark() -> Column:
    """One of 64 bits for a level and bucket."""
    return _bit(F.pmod(F.xxhash64("level", "bucket"), F.lit(64)).cast("int"))


def _marked() -> Column:
    return F.col("marks").bitwiseAND(_mark()) != 0


def _needed(seen: DataFrame) -> list[Column]:
    """The bits of the levels and of the spots that a room needs, all of them where ``seen`` has none."""
    every = {"levels": (1 << LEVELS) - 1, "marks": -1}
    return [F.col(name) if name in seen.columns else F.lit(bits).cast("bigint").alias(name) for name, bits in every.items()]


def _set_bits(levels: Column) -> Column:
    every = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    return F.filter(every, lambda level: levels.bitwiseAND(_bit(level)) != 0)


def _cell(bucket: Column, level: Column) -> Column:
    """Cell of a bucket on a level above 0; the shift rounds down also below zero."""
    return F.call_function("shiftright", bucket, level - 1)


def _floor_div(value: Column, by: Column | int) -> Column:
    by = by if isinstance(by, Column) else F.lit(by).cast("bigint")
    # The difference is a multiple, so the whole-number division is exact also below zero.
    return F.call_function("div", value - F.pmod(value, by), by)


def _are_times(bookings: DataFrame) -> bool:
    """Whether they are ``booked_times`` already."""
    return "start_ts" not in bookings.columns


def _booked_room(bookings: DataFrame, rules: Rules | None) -> Column:
    booked = F.col("room")
    return booked if rules is None or _are_times(bookings) else room_name(without_blanks(booked), rules)


def _held(bookings: DataFrame, rules: Rules | None, tz: str) -> DataFrame:
    """``name, room, start, end`` of the bookings, in epoch seconds.

    A booking stands once per room and lecturer and may stand in several files: its copies are merged.
    """
    if _are_times(bookings):
        return bookings.select("name", "room", "start", "end")
    return (
        bookings.select(
            "name",
            _booked_room(bookings, rules).alias("room"),
            epoch_seconds(F.col("start_ts"), tz).alias("start"),
            epoch_seconds(F.col("end_ts"), tz).alias("end"),
        )
        .where("room is not null and start <= end")
        .distinct()
    )


def _spot_bit() -> Column:
    """Bit of a room and finest bucket in the filter."""
    return F.pmod(F.xxhash64("room", "bucket"), F.lit(FILTER_BITS)).cast("int")


def _within_one_bucket(held: DataFrame, width: int) -> bytes:
    """A filter of fixed size for the rooms and buckets that a booking lies strictly inside of; others may pass too."""
    bucket = _floor_div(F.col("start"), width)
    inside = held.where((bucket == _floor_div(F.col("end"), width)) & (F.pmod("start", F.lit(width)) > 0) & (F.pmod("end", F.lit(width)) < width - 1))
    bit = inside.select("room", bucket.alias("bucket")).select(_spot_bit().alias("bit"))
    # One row per byte that has a bit, an eighth of the filter's bits at most.
    rows = bit.groupBy(F.shiftright("bit", 3).alias("byte")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("bit") % 8)).alias("bits")).collect()
    found = bytearray(FILTER_BITS // 8)
    for row in rows:
        found[row["byte"]] = row["bits"]
    return bytes(found)


def _passes(wanted: bytes) -> Column:
    """Whether the filter has the bit of a row's room and bucket; a constant if it has none."""
    if not any(wanted):
        return F.lit(False)
    bit = _spot_bit()
    byte = F.ascii(F.decode(F.substring(F.lit(bytearray(wanted)), F.shiftright(bit, 3) + 1, F.lit(1)), "ISO-8859-1"))
    return F.call_function("shiftright", byte, bit % 8).bitwiseAND(1) == 1


@dataclass(frozen=True)
class Crowd:
    """A spot that is dealt into shares of its clients and of its bookings."""

    room: str
    level: int
    bucket: int
    clients: int
    bookings: int


def _may_be_crowded(readings: DataFrame, meta: DataFrame, bookings: DataFrame, rules: Rules | None) -> bool:
    """Whether the most sightings of a room and the most bookings of one, copies included, make more than a few pairs.

    No spot has more pairs than its room, so otherwise none is crowded, and two numbers are enough to know it.
    """
    of_router = readings.where("ts is not null").groupBy("did").agg(F.count(F.lit(1)).alias("seen"))
    in_room = of_router.join(_router_rooms(meta, rules), "did").groupBy("room").agg(F.sum("seen").alias("seen"))
    seen = in_room.agg(F.max("seen")).first()[0] or 0
    # Where a room has that many sightings, one booking is enough: the bookings need not be read for it.
    if seen > FEW_PAIRS:
        return True
    rooms = bookings.select(_booked_room(bookings, rules).alias("room")).where("room is not null")
    held = rooms.groupBy("room").agg(F.count(F.lit(1)).alias("held")).agg(F.max("held")).first()[0] or 0
    return seen * held > FEW_PAIRS


def _crowded(seen: DataFrame, pieces: DataFrame, width: int) -> list[Crowd]:
    """Spots with more than their part of all pairs of sightings and pieces, and the shares they are dealt into.

    Sightings are merged to one count per room and bucket in each task. There are ``PARTS_PER_TASK`` parts for each task, so no
    more than that many spots can have more than a part, and only those are brought to the driver.
    """
    parts = PARTS_PER_TASK * _tasks(seen)
    found_in = seen.select("room", *_needed(seen), _floor_div(F.col("ts"), width).alias("bucket"))
    finest = found_in.groupBy("room", "bucket").agg(
        F.max("levels").alias("levels"), F.max("marks").alias("marks"), F.count(F.lit(1)).alias("clients")
    )
    # No spot has more pairs than its room.
    in_room = finest.groupBy("room").agg(F.sum("clients").cast("double").alias("in_room"))
    of_room = pieces.groupBy("room").agg(F.count(F.lit(1)).alias("of_room"))
    busy = in_room.join(of_room, "room").where(F.col("in_room") * F.col("of_room") > FEW_PAIRS).select("room")
    each = finest.join(busy, "room", "left_semi").withColumn("level", F.explode(_set_bits(F.col("levels"))))
    cell = _cell(F.col("bucket"), F.col("level"))
    spot = F.when(
        F.col("level") == 0, F.array(*[F.struct(F.lit(level).alias("level"), F.col("bucket")) for level in (0, SECONDS)])
    ).otherwise(F.array(*[F.struct(F.col("level"), (cell - back).alias("bucket")) for back in (0, 1, 2)]))
    there = each.select("room", "marks", "clients", F.inline(spot)).where(_marked()).groupBy(*SPOT).agg(F.sum("clients").alias("clients"))
    booked = pieces.groupBy(*SPOT).agg(F.count(F.lit(1)).alias("bookings"))
    pairs = F.col("clients").cast("double") * F.col("bookings")
    total = Observation()
    met = there.join(booked, SPOT).withColumn("pairs", pairs).observe(total, F.sum("pairs").alias("pairs"))
    most = met.orderBy(F.desc("pairs")).limit(parts).collect()
    if not most:
        return []
    part = max(total.get["pairs"] / parts, FEW_PAIRS)
    found = []
    for row in most:
        if row["pairs"] <= part:
            break
        # Shares in proportion to both sides, so that copying a side to the other's shares costs least.
        shares = SHARES_PER_PART * row["pairs"] / part
        clients = min(max(1.0, math.sqrt(shares * row["clients"] / row["bookings"])), shares, row["clients"])
        found.append(Crowd(row["room"], row["level"], row["bucket"], math.ceil(clients), math.ceil(min(shares / clients, row["bookings"]))))
    return found


def _booking_pieces(bookings: DataFrame, rules: Rules | None, tz: str, width: int) -> DataFrame:
    """The spot of each booking, ``name, room, level, bucket, lo, hi``, and whether its name has ``several``."""
    held = _located(_held(bookings, rules, tz), width).withColumn("key", F.xxhash64("name"))
    # Names that share a hash count as one, which costs time only: their pairs are made distinct.
    names = held.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("several"))
    # As an array's element a spot is no constant to the optimizer, even if all bookings have the same: the join keeps its
    # keys, and with them the partitioning asked for.
    spot = F.struct("level", "bucket", F.col("start").alias("lo"), F.col("end").alias("hi"))
    return held.join(names, "key").select("name", "room", "several", F.inline(F.array(spot)))


def _located(held: DataFrame, width: int) -> DataFrame:
    """Bookings with their level and the cell in which they begin.

    Over n > 0 buckets' borders a booking is on the level of the widest cells that n buckets fill: it ends one or two further.
    """
    start, end = F.col("start"), F.col("end")
    begin, borders = _floor_div(start, width), _floor_div(end, width) - _floor_div(start, width)
    inside = (F.pmod(start, F.lit(width)) > 0) & (F.pmod(end, F.lit(width)) < width - 1)
    level = F.when(borders > 0, F.length(F.bin(borders))).otherwise(F.when(inside, SECONDS).otherwise(0))
    located = held.withColumns({"begin": begin, "level": level})
    cell = F.when(F.col("level") > 0, _cell(F.col("begin"), F.col("level"))).otherwise(F.col("begin"))
    return located.withColumn("bucket", cell).drop("begin")


def _meet(clients: DataFrame, pieces: DataFrame, shares: tuple[int, int] | list[Crowd]) -> DataFrame:
    """Clients and pieces of the same room and bucket.

    Both are dealt into shares, all spots into the same ``shares`` or only those of a list, and every share of one meets
    every share of the other by itself. Neither side is broadcast: Spark's estimate does not see how many rows clients
    become. The partitioning is asked for by number, so adaptive execution does not merge the shares of a crowded spot again.
    """
    n = _tasks(clients)
    if isinstance(shares, list) and not shares:
        return pieces.repartition(n, *SPOT).hint("merge").join(clients.repartition(n, *SPOT), SPOT)
    if isinstance(shares, list):
        rows = [(c.room, c.level, c.bucket, c.clients, c.bookings) for c in shares]
        # Not more rows than ``_crowded`` brings to the driver.
        crowded = F.broadcast(clients.sparkSession.createDataFrame(rows, "room string, level int, bucket bigint, of_clients int, of_bookings int"))
        clients, pieces = (side.join(crowded, SPOT, "left").fillna(1, ["of_clients", "of_bookings"]) for side in (clients, pieces))
    else:
        of = {"of_clients": F.lit(shares[0]), "of_bookings": F.lit(shares[1])}
        clients, pieces = clients.withColumns(of), pieces.withColumns(of)

    def dealt(rows: DataFrame, key: str, own: tuple[str, str], copied: tuple[str, str]) -> DataFrame:
        share = F.coalesce(F.pmod(F.xxhash64(key), F.col(own[1])).cast("int"), F.lit(0))
        copies = F.explode(F.sequence(F.lit(0), F.col(copied[1]) - 1))
        return rows.withColumns({own[0]: share, copied[0]: copies}).drop("of_clients", "of_bookings")

    keys = [*SPOT, "client_share", "booking_share"]
    of_client, of_booking = ("client_share", "of_clients"), ("booking_share", "of_bookings")
    left = dealt(pieces, "name", of_booking, of_client).repartition(n, *keys)
    right = dealt(clients, "cid", of_client, of_booking).repartition(n, *keys)
    return left.hint("merge").join(right, keys)
