"""URL filter: rules first, a ratio of character language models for the rest. DataFrame functions only.

URLs that a rule accepts or rejects train two Markov models over characters, of an order that
grows with the logarithm of the table, ``ORDER`` at least. Each model backs off by Witten-Bell smoothing: a context lends its lower order as much
weight as it has different continuations, so rare contexts lean on shorter ones and frequent
ones stand alone. A URL's score is the difference of its log-likelihoods divided by its length; the
threshold is the one that parts accepted from rejected URLs best on a fifth of them that the models have not seen.

Characters are code points as they stand in the URL. The model grows with the table, so it is
joined by a shuffle on the gram; only the grams that make up a thousandth of all or more, a
thousand at most, are joined by broadcast, as one task would have to take each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanebeacon.llm.common import ascii_lower, stored, table

# (verdict, host, start of the path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
ORDER = 3
# Contexts are one character longer for every so many times the characters.
GROWTH = 8
# All code points; "^" and "$" also mark the beginning and end.
ALPHABET = range(0x110000)
COMMON = 1000
BLOCK = 256
HELD_OUT = 5
STEP = 0.005
# A URL is crowded if it has more than one in so many rows.
CROWDED = 1000


def url_host(url: Column) -> Column:
    """Lower-case text between the first ``://`` and the next ``/``, ``?`` or ``#``; empty without ``://``."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    rest = _after_scheme(url)
    return F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    place = F.instr(url, "://")
    return F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name (``host`` + start of path) and verdict of the longest rule that fits, else NULL."""
    longest = sorted(rules, key=lambda rule: -len(rule[1] + rule[2]))

    def first_fitting(value) -> Column:
        cases = [F.when(_fits(host, path, rule), F.lit(value(rule))) for rule in longest]
        return F.coalesce(*cases, F.lit(None).cast("string"))

    return first_fitting(lambda rule: rule[1] + rule[2]), first_fitting(lambda rule: rule[0])


def _fits(host: Column, path: Column, rule) -> Column:
    _, rule_host, start = rule
    of_host = (host == rule_host) | F.endswith(host, F.lit("." + rule_host))
    return of_host & F.startswith(path, F.lit(start))


def _order(characters: int) -> int:
    """Length of the longest contexts that a table of so many characters supports."""
    order = ORDER
    while GROWTH ** (order + 1) <= characters:
        order += 1
    return order


def _spelled(text: Column, order: int) -> Column:
    """A text with marks for its beginning and end."""
    return F.concat(F.lit("^" * order), text, F.lit("$"))


def _grams(spelled: Column, order: int) -> Column:
    """All stretches of ``order + 1`` characters; blocks keep long texts cheap."""
    blocks = F.transform(
        F.sequence(F.lit(1), F.length(spelled) - order, F.lit(BLOCK)), lambda i: F.substr(spelled, i, F.lit(BLOCK + order))
    )
    return F.flatten(
        F.transform(
            blocks,
            lambda block: F.transform(
                F.sequence(F.lit(1), F.length(block) - order), lambda i: F.substr(block, i, F.lit(order + 1))
            ),
        )
    )


def char_model(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, ratio``: log-odds of a character after its context, from ``spelled, allowed, blocked``.

    ``allowed`` and ``blocked`` say how often a URL is a sample of either class. Every gram
    of ``urls`` is in the model, also those of URLs that are samples of none.
    """
    counts = (
        urls.select("allowed", "blocked", F.explode(_grams(F.col("spelled"), order)).alias("gram"))
        .groupBy("gram")
        .agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
    )
    counts = stored(counts, "url-grams")
    model = None
    for length in range(order + 1):
        at_order = (
            counts.withColumn("gram", F.right("gram", F.lit(length + 1)))
            .groupBy("gram")
            .agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
            .withColumn("context", F.left("gram", F.lit(length)))
        )
        # A context has at most one row for each character of the alphabet.
        same = Window.partitionBy("context")
        if model is None:
            at_order = at_order.withColumns({f"low_{c}": F.lit(1.0 / len(ALPHABET)) for c in ("allowed", "blocked")})
        else:
            lower = model.select(F.col("gram").alias("lower"), F.col("p_allowed").alias("low_allowed"), F.col("p_blocked").alias("low_blocked"))
            at_order = at_order.withColumn("lower", F.right("gram", F.lit(length))).join(lower, "lower")
        for c in ("allowed", "blocked"):
            kinds = F.sum((F.col(c) > 0).cast("int")).over(same)
            p = F.try_divide(F.col(c) + kinds * F.col(f"low_{c}"), F.sum(c).over(same) + kinds)
            at_order = at_order.withColumn(f"p_{c}", F.coalesce(p, f"low_{c}"))
        model = at_order.select("gram", "p_allowed", "p_blocked")
    return stored(model.select("gram", (F.ln("p_allowed") - F.ln("p_blocked")).alias("ratio")), "url-model")


def _scored(urls: DataFrame, model: DataFrame, order: int, characters: int) -> DataFrame:
    """``url_id, score``: mean log-odds per character of every URL."""
    each = urls.select("url_id", F.explode(_grams(F.col("spelled"), order)).alias("gram"))
    common = stored(each.groupBy("gram").count().where(F.col("count") * COMMON >= characters).select("gram"), "url-common")
    often = each.join(F.broadcast(model.join(F.broadcast(common), "gram")), "gram")
    seldom = each.join(F.broadcast(common), "gram", "left_anti").join(model, "gram")
    return often.unionByName(seldom).groupBy("url_id").agg(F.avg("ratio").alias("score"))


def _threshold(scores: DataFrame) -> float:
    """The score that parts both classes best, from ``score, allowed, blocked``; 0 if one is missing.

    Scores are gathered in steps of ``STEP``; their range is bounded by the smoothing.
    """
    steps = (
        scores.groupBy(F.floor(F.col("score") / STEP).alias("step"))
        .agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
    )
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    right = F.try_divide(F.coalesce(F.sum("blocked").over(below), F.lit(0)), F.sum("blocked").over(everything)) + (
        1 - F.try_divide(F.coalesce(F.sum("allowed").over(below), F.lit(0)), F.sum("allowed").over(everything))
    )
    # All thresholds above the step before part alike; the one next to 0 favours no class.
    before = F.lag("step").over(Window.orderBy("step"))
    level = F.least("step", F.greatest(before + 1, F.lit(0)))
    best = steps.select(right.alias("right"), level.alias("level")).where("right is not null").orderBy(F.desc("right"), F.abs("level")).first()
    return best["level"] * STEP if best else 0.0


def judge_urls(pages: DataFrame, rules=RULES, *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, score, verdict`` of every row of ``pages``.

    ``rule`` is NULL where none fits; then the models judge, ``allow`` from the threshold on; with a rule ``score`` is NULL.
    NULL URLs and URLs without ``://`` have an empty host and path and are judged by the
    models as well, which see the whole URL, its scheme, query and fragment too. Ids may be NULL or repeated. Without samples of a class its model is
    uniform and the threshold 0. An empty table gives no rows. Other columns are not looked at.
    """
    host, path = F.col("host"), F.col("path")
    rule, verdict = rule_of(host, path, rules)
    parted = pages.select(
        F.col(id_col).alias("page_id"),
        url_host(F.col(url_col)).alias("host"),
        url_path(F.col(url_col)).alias("path"),
        F.coalesce(F.col(url_col), F.lit("")).alias("text"),
    )
    parted = stored(parted.select("*", rule.alias("rule"), verdict.alias("ruled")), "url-parts")
    urls = parted.groupBy("text").agg(
        F.count_if(F.col("ruled") == "allow").alias("allowed"),
        F.count_if(F.col("ruled") == "block").alias("blocked"),
        F.count(F.lit(1)).alias("rows"),
    )
    # The id spares the grams the text. It is written down, so it stays the same.
    urls = stored(urls.withColumn("url_id", F.monotonically_increasing_id()), "urls")
    # Every character and the end has a gram.
    characters = urls.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    order = _order(characters)
    unseen = F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0
    spelled = urls.withColumn("spelled", _spelled(F.col("text"), order))
    seen = spelled.select(
        "spelled",
        F.when(unseen, 0).otherwise(F.col("allowed")).cast("bigint").alias("allowed"),
        F.when(unseen, 0).otherwise(F.col("blocked")).cast("bigint").alias("blocked"),
    )
    scores = stored(_scored(spelled, char_model(seen, order), order, characters).join(urls, "url_id"), "url-scores")
    threshold = _threshold(scores.where(unseen))
    judged = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    # Rows without a rule need a score. URLs with more than a part of all rows are no more than there are parts.
    total = scores.agg(F.sum("rows")).first()[0] or 0
    crowded = scores.where(F.col("rows") * CROWDED > total).select("text", "score")
    alone = parted.where("ruled is null")
    hot = alone.join(F.broadcast(crowded), "text")
    others = alone.join(F.broadcast(crowded.select("text")), "text", "left_anti").join(scores.select("text", "score"), "text", "left")
    ruled = parted.where("ruled is not null").withColumn("score", F.lit(None).cast("double"))
    each = hot.unionByName(others).unionByName(ruled)
    return each.select("page_id", "host", "path", "rule", "score", F.coalesce("ruled", judged).alias("verdict"))


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")
