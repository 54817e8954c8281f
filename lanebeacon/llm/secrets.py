"""Secrets in texts: known shapes, and strings that look random. DataFrame functions only.

Known shapes are found by three patterns. Any other long run of code characters is a
candidate. Its encoding is inferred, and three tests ask whether its characters could
have been drawn evenly from that encoding's alphabet: chi-squared over the characters and
over their classes, runs above and below the alphabet's middle, and correlation of each
character with the next. The p-values are combined by Fisher's method.

Words and names fail the tests, so their p-values lie near 0, while those of random strings
are spread evenly. That tells how many of the candidates above a level are random: twice the
number above one half, in proportion. The level from which at most ``FALSE_SHARE`` of the
claims would be false is found for each band of lengths by itself, as short strings are
harder to tell. A string counts once however many texts hold it, as copies of one string say
nothing about others. A band with few random strings is pooled with the bands next to it. The
level is found from counts over all texts in hundredths of p, a bounded number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanebeacon.llm.common import table

# The three known shapes, and how long the part that counts must be.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
FALSE_SHARE = 0.05
# Claims below this p are never made.
LEAST_P = 0.01
# Lengths from 20, 28, 40, 56 and 80 characters on are judged apart.
BANDS = (20, 28, 40, 56, 80)
# A band with fewer different strings above one half takes in the bands next to it.
ENOUGH = 50

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The alphabets of encodings, the smallest first: (pattern of all its strings, characters in order).
ENCODINGS = (
    ("^[0-9]+$", _DIGITS),
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[a-z]+$", _LOWER),
    ("^[A-Z]+$", _UPPER),
    ("^[A-Z2-7]+$", _UPPER + "234567"),
    ("^[0-9a-z]+$", _DIGITS + _LOWER),
    ("^[0-9A-Z]+$", _DIGITS + _UPPER),
    ("^[A-Za-z]+$", _UPPER + _LOWER),
    ("^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
    ("^[0-9A-Za-z+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("", _UPPER + _LOWER + _DIGITS + "-_+/"),
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` refers to it in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _starts(lengths: Column) -> Column:
    """Sum of the lengths before each; sums of 256 at a time keep long arrays cheap."""
    zero = F.lit(0)

    def total(numbers: Column) -> Column:
        return F.aggregate(numbers, zero, lambda a, b: a + b)

    def placed(lengths: Column) -> Column:
        blocks = F.sequence(zero, F.floor((F.size(lengths) - 1) / 256).cast("int"))
        sums = F.transform(blocks, lambda b: total(F.slice(lengths, b * 256 + 1, 256)))

        def of_blocks(sums: Column) -> Column:
            def of_block(b: Column) -> Column:
                inside = F.slice(lengths, b * 256 + 1, 256)
                return _let(
                    F.struct(total(F.slice(sums, 1, b)).alias("before"), inside.alias("inside")),
                    lambda x: F.transform(x["inside"], lambda _, j: x["before"] + total(F.slice(x["inside"], 1, j))),
                )

            return F.flatten(F.transform(blocks, of_block))

        return _let(sums, of_blocks)

    return F.when(F.size(lengths) > 0, placed(lengths)).otherwise(F.slice(lengths, 1, 0))


def matches(text: Column, pattern: str, checked_group: int = 0) -> Column:
    """``start, end, value, checked`` of the leftmost non-overlapping matches, counted in code points.

    Between the pieces that ``split`` leaves stand the matches, so their lengths give the places.
    """
    parts = [
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.split(text, pattern, -1).alias("gaps"),
    ]
    if checked_group:
        parts.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(checked_group)).alias("checked"))

    def placed(x: Column) -> Column:
        lengths = F.zip_with(
            x["found"], F.slice(x["gaps"], 1, F.size(x["found"])), lambda m, gap: F.length(m) + F.length(gap)
        )
        ends = F.zip_with(_starts(lengths), lengths, lambda start, length: start + length)
        spans = F.zip_with(
            ends,
            x["found"],
            lambda end, m: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("value")),
        )
        return F.zip_with(
            spans, x["checked" if checked_group else "found"], lambda s, c: F.struct(s["start"], s["end"], s["value"], c.alias("checked"))
        )

    return _let(F.struct(*parts), placed)


def _kind(name: str, found: Column) -> Column:
    order = KINDS.index(name)
    return F.transform(found, lambda m: F.struct(m["start"], F.lit(order).alias("kind"), m["end"]))


_NO_SPANS = "cast(array() as array<struct<start: int, kind: int, end: int>>)"
_NO_CANDIDATES = "cast(array() as array<struct<start: int, end: int, band: int, key: bigint, p: double>>)"


def base_spans(text: Column) -> Column:
    """Spans of the three known shapes as ``start, kind, end``, in that order."""
    lowered = F.lower(text)
    worded = [F.contains(lowered, F.lit(word)) for word in ("passw", "secret", "token", "api")]
    # Looking for the words first spares most texts the pattern.
    assigned = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["checked"]) >= ASSIGN_LEAST)
    none = F.expr(_NO_SPANS)
    assign = F.when(worded[0] | worded[1] | worded[2] | worded[3], _kind("assign", assigned)).otherwise(none)
    access = F.when(F.contains(text, F.lit("AKIA")), _kind("access", matches(text, ACCESS))).otherwise(none)
    spans = F.concat(assign, access, _kind("hex", matches(text, HEX)))
    return F.sort_array(spans)


def _two_sided(z: Column) -> Column:
    """Chance of a normal value at least as far from 0, to seven digits (Abramowitz and Stegun 7.1.26)."""

    def tail(x: Column) -> Column:
        t = 1 / (1 + 0.3275911 * x)
        curve = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
        return F.greatest(curve * F.exp(-x * x), F.lit(1e-300))

    return _let(F.least(F.abs(z) / F.lit(2**0.5), F.lit(26.0)), tail)


def _cube_root_z(x2: Column, df: Column) -> Column:
    """A chi-squared value as a normal one (Wilson and Hilferty)."""
    spread = F.lit(2 / 9) / df
    return (F.pow(x2 / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)


def randomness(value: Column) -> Column:
    """Combined p-value of the test battery for a string of code characters."""
    alphabet = F.coalesce(*[F.when(F.rlike(value, F.lit(p)), F.lit(a)) for p, a in ENCODINGS[:-1]], F.lit(ENCODINGS[-1][1]))

    def of_codes(x: Column) -> Column:
        codes, size = x["codes"], F.length(x["alphabet"])
        n = F.size(codes).cast("double")

        def count(numbers: Column, test: Callable[[Column], Column]) -> Column:
            return F.size(F.filter(numbers, test)).cast("double")

        # Characters against an even spread; the variance is that of few draws.
        expected = n / size
        squares = F.aggregate(
            F.array_distinct(codes),
            F.lit(0.0),
            lambda sum_, code: sum_ + F.pow(count(codes, lambda c: c == code), F.lit(2.0)),
        )
        x2 = squares / expected - n
        even = (x2 - (size - 1)) / F.sqrt(2.0 * (size - 1) * (1 - 1 / n))
        # Classes of characters against their share of the alphabet.
        parts = [
            (F.length(F.regexp_replace(x["value"], f"[^{c}]", "")), F.length(F.regexp_replace(x["alphabet"], f"[^{c}]", "")))
            for c in ("0-9", "a-z", "A-Z")
        ]
        def class_part(seen, of_alphabet):
            mean = n * of_alphabet / size
            return F.when(of_alphabet > 0, F.pow(seen - mean, F.lit(2.0)) / mean).otherwise(F.lit(0.0))
        present = sum(((of_alphabet > 0).cast("int") for _, of_alphabet in parts), F.lit(0))
        class_x2 = sum((class_part(*part) for part in parts), F.lit(0.0))
        class_z = _cube_root_z(class_x2, F.greatest(present - 1, F.lit(1)).cast("double"))
        half = _two_sided(class_z) / 2
        in_classes = F.when(class_z > 0, half).otherwise(1 - half)
        # Runs above and below the middle.
        high = F.transform(codes, lambda c: c * 2 >= size)
        n1 = count(high, lambda h: h)
        n2 = n - n1
        changes = F.aggregate(
            F.zip_with(F.slice(high, 1, F.size(high) - 1), F.slice(high, 2, F.size(high)), lambda a, b: (a != b).cast("double")),
            F.lit(0.0),
            lambda a, b: a + b,
        )
        mean_runs = 2 * n1 * n2 / n + 1
        var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
        runs = F.when(var_runs > 0, (changes + 1 - mean_runs) / F.sqrt(F.greatest(var_runs, F.lit(1e-9)))).otherwise(F.sqrt(n))
        # Each character against the next.
        mean = F.aggregate(codes, F.lit(0.0), lambda a, c: a + c) / n
        variance = F.aggregate(codes, F.lit(0.0), lambda a, c: a + c * c) / n - mean * mean
        products = F.aggregate(
            F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes)), lambda a, b: (a * b).cast("double")),
            F.lit(0.0),
            lambda a, b: a + b,
        )
        first, last = F.get(codes, F.lit(0)), F.get(codes, F.size(codes) - 1)
        covariance = products - mean * (2 * n * mean - first - last) + (n - 1) * mean * mean
        serial = F.when(variance > 1e-9, covariance / (n * F.greatest(variance, F.lit(1e-9))) * F.sqrt(n)).otherwise(F.sqrt(n))
        logs = [F.ln(_two_sided(z)) for z in (even, runs, serial)]
        # An alphabet of one class has no test of its classes.
        several = present > 1
        half_statistic = -sum(logs, F.when(several, F.ln(F.greatest(in_classes, F.lit(1e-300)))).otherwise(F.lit(0.0)))

        def fisher(h: Column) -> Column:
            # Of Fisher's statistic, which has 2 degrees of freedom for each test, h is half.
            three = 1 + h + h * h / 2
            return F.exp(-h) * F.when(several, three + h * h * h / 6).otherwise(three)

        return _let(half_statistic, fisher)

    def coded(a: Column) -> Column:
        codes = F.transform(F.split(value, ""), lambda c: F.instr(a, c) - 1)
        return _let(F.struct(codes.alias("codes"), a.alias("alphabet"), value.alias("value")), of_codes)

    return _let(alphabet, coded)


def candidates(text: Column, base: Column) -> Column:
    """``start, end, band, key, p`` of candidate strings that touch no known shape.

    Strings of letters alone have bands of their own after the others, as long words look more random than names.
    """
    found = F.struct(matches(text, CANDIDATE).alias("runs"), base.alias("base"))
    long_runs = _let(
        found,
        lambda x: F.filter(
            x["runs"],
            lambda m: ~F.exists(x["base"], lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])),
        ),
    )

    def judged(m: Column) -> Column:
        n = m["end"] - m["start"]
        letters = F.when(F.rlike(m["value"], F.lit("^[A-Za-z]+$")), len(BANDS)).otherwise(0)
        band = sum(((n >= least).cast("int") for least in BANDS[1:]), letters)
        return F.struct(m["start"], m["end"], band.alias("band"), F.xxhash64(m["value"]).alias("key"), randomness(m["value"]).alias("p"))

    return F.transform(long_runs, judged)


def _scanned(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.withColumn("_base", base_spans(text))
    return found.withColumn("_candidates", candidates(text, F.col("_base")))


def claim_levels(docs: DataFrame, *, text_col: str = "text") -> list[float]:
    """The p from which candidates are claimed, one for each band of lengths, then one for each of strings of letters alone.

    Every text is scanned and every different string counted once, by its hash; 100 counts per
    band come back. A band takes in its neighbours, the nearest first, until there are ``ENOUGH``
    strings above one half, at last those of the other kind. If no band has any, nothing tells random strings from others and no
    claims are made (level 2).
    """
    each = _scanned(docs.select(text_col), text_col).select(F.inline("_candidates"))
    cell = F.least(F.floor(F.col("p") * 100), F.lit(99)).cast("int").alias("cell")
    cells = each.select("band", cell, "key").distinct().groupBy("band", "cell").count().collect()
    counts = [[0] * 100 for _ in range(2 * len(BANDS))]
    for row in cells:
        counts[row["band"]][row["cell"]] = row["count"]
    return [_level(_pooled(counts, band)) for band in range(len(counts))]


def _pooled(counts: list[list[int]], band: int) -> list[int]:
    first = band - band % len(BANDS)
    for reach in range(len(BANDS)):
        near = counts[max(band - reach, first) : min(band + reach + 1, first + len(BANDS))]
        pool = [sum(column) for column in zip(*near)]
        if sum(pool[50:]) >= ENOUGH:
            return pool
    return [sum(column) for column in zip(*counts)]


def _level(counts: list[int]) -> float:
    """The least p at which claims keep to ``FALSE_SHARE``, from counts in hundredths of p."""
    random_strings = 2 * sum(counts[50:])
    level = 2.0
    for cell in range(99, int(LEAST_P * 100) - 1, -1):
        claimed, true = sum(counts[cell:]), random_strings * (100 - cell) / 100
        if claimed and 1 - true / claimed <= FALSE_SHARE:
            level = cell / 100
    return level if random_strings else 2.0


def secret_spans(docs: DataFrame, *, text_col: str = "text", levels: list[float] | None = None) -> DataFrame:
    """``docs`` with ``secrets``: an array of ``start, kind, end`` in that order.

    Places count code points, the end is exclusive; ``kind`` is the place in ``KINDS``. Spans of
    known shapes may overlap one another; random strings overlap none of them. NULL and empty
    texts have no spans. Rows, and columns of any names but ``secrets``, stay as they are.
    """
    levels = claim_levels(docs, text_col=text_col) if levels is None else levels
    row = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("_row"), docs[text_col].alias("_text"))
    bounds = F.array(*[F.lit(float(level)) for level in levels])
    claimed = F.filter("_candidates", lambda c: c["p"] >= F.get(bounds, c["band"]))
    spans = F.sort_array(F.concat(F.col("_base"), _kind("random", claimed)))
    return _scanned(row, "_text").select("_row.*", spans.alias("secrets"))


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every stretch that spans cover replaced by ``mask``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        before = F.substr(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        fresh = F.concat(state["out"], before, F.lit(mask))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(span["start"] >= state["at"], fresh).otherwise(state["out"]).alias("out"),
        )

    rest = F.aggregate(spans, start, step, lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(name) for name in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    """Every document's secrets: counts, digest of the known shapes, and all spans."""
    found = secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def of(kind: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("secrets")).alias("spans"),
    )
