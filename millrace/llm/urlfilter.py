"""URL filter: rules first, then the ratio of two character language models. DataFrame functions only.

URLs that a rule accepts and those that a rule rejects each train a Markov model of variable
order, up to ``ORDER`` characters of context, with Witten-Bell smoothing: each order adds
to its counts the estimate of the next shorter one, as heavy as it has different
continuations. Counts are taken over all ruled URLs, and every gram counted is kept, at any
size of the input. The gains are worked out once for each distinct gram of the URLs to score and
written, so the planner knows their size and shuffles or broadcasts them.

A URL's score is the log-likelihood difference divided by its length. The verdict's threshold
is calibrated on all ruled URLs: the score, of steps of ``STEP``, at which the two classes'
error rates add up to the least; of equal ones that nearest to 0.

The modelled string is host and path, with A-Z lowered and every digit as 0. Defined results: a null url, and one
without ``://``, has an empty host and path, no rule, and is blocked. Without ruled URLs of
both kinds the threshold is 0 and every score 0, so the rest is allowed. Repeated rows are
judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.lineage import materialise

ORDER = 4
STEP = 0.01
CLIP = 8.0  # scores beyond it count as it in the calibration
ALPHABET = 256  # characters that the model of order 0 shares its rest among
START = "^"

# The rules as given, (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def lowered(text: Column) -> Column:
    """A-Z lowered and nothing else."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def host_of(url: Column) -> Column:
    return lowered(F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of_host, of_path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(of_path)
        rule = F.when(fits, of_host + of_path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _model_text(host: Column, path: Column) -> Column:
    return F.translate(lowered(F.concat(host, path)), "123456789", "000000000")


def _characters(rows: DataFrame) -> DataFrame:
    """A row per character, with the ``ORDER`` characters before it: gram."""
    own = F.split(F.concat(F.lit(START * ORDER), F.col("text")), "")
    chars = rows.select("row", "verdict", own.alias("own"), F.size(own).alias("n"))
    at = F.explode(F.sequence(F.lit(ORDER + 1), F.col("n")))
    chars = chars.where(F.col("n") > ORDER).select("row", "verdict", "own", at.alias("at"))
    gram = F.array_join(F.slice("own", F.col("at") - ORDER, ORDER + 1), "")
    return chars.select("row", "verdict", gram.alias("gram"))


def _tail(gram: Column, n: int) -> Column:
    """The last ``n`` characters of a gram of ORDER + 1."""
    return F.substring(gram, ORDER + 2 - n, n)


def train(rows: DataFrame) -> list[DataFrame]:
    """Per order the written table (gram, gain) of the ruled (row, text, verdict): the gram's log-likelihood ratio."""
    counted = _characters(rows.where("verdict IS NOT NULL")).groupBy("gram").agg(
        F.count_if(F.col("verdict") == "allow").alias("good"), F.count_if(F.col("verdict") == "block").alias("bad")
    )
    grams = materialise(counted, "grams")
    total = grams.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not total["good"] or not total["bad"]:
        return []
    levels = []
    shorter = None
    for order in range(ORDER + 1):
        level = grams.select(_tail(F.col("gram"), order + 1).alias("gram"), "good", "bad")
        level = level.groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        level = materialise(level.withColumn("context", F.expr(f"substring(gram, 1, {order})")), "level")
        of_context = level.groupBy("context").agg(
            F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
            F.count_if(F.col("good") > 0).alias("t_good"), F.count_if(F.col("bad") > 0).alias("t_bad"),
        )
        level = level.join(of_context, "context")
        if shorter is None:
            level = level.withColumns({"p_good": F.lit(1.0 / ALPHABET), "p_bad": F.lit(1.0 / ALPHABET)})
        else:
            level = level.join(shorter.withColumnRenamed("gram", "tail"), F.expr("substring(gram, 2)") == F.col("tail"))
        smoothed = {}
        for kind in ("good", "bad"):
            n, t, p = F.col(f"n_{kind}"), F.col(f"t_{kind}"), F.col(f"p_{kind}")
            smoothed[f"p_{kind}"] = F.when(n == 0, p).otherwise((F.col(kind) + t * p) / (n + t))
        level = level.withColumns(smoothed)
        shorter = materialise(level.select("gram", "p_good", "p_bad"), "estimates")
        levels.append(shorter.select("gram", (F.log("p_good") - F.log("p_bad")).alias("gain")))
    return levels


def score(rows: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(row, score) of (row, text, verdict): the mean gain of its characters, each by the longest gram known."""
    chars = _characters(rows).select("row", "gram")
    asked = materialise(chars.select("gram").distinct(), "asked")
    for n, level in enumerate(levels):
        own = level.select(F.col("gram").alias(f"gram{n}"), F.col("gain").alias(f"gain{n}"))
        asked = asked.join(own, _tail(F.col("gram"), n + 1) == F.col(f"gram{n}"), "left")
    gain = F.coalesce(*[F.col(f"gain{n}") for n in reversed(range(len(levels)))], F.lit(0.0))
    gains = materialise(asked.select("gram", gain.alias("gain")), "gains")
    return chars.join(gains, "gram").groupBy("row").agg((F.sum("gain") / F.count("*")).alias("score"))


def calibrated(scored: DataFrame) -> float:
    """The threshold of least summed error rates over (score, verdict); allowed is what reaches it."""
    steps = round(CLIP / STEP)
    cell = F.greatest(F.lit(-steps), F.least(F.lit(steps), F.floor(F.col("score") / STEP).cast("int")))
    counts = scored.where("verdict IS NOT NULL").groupBy(cell.alias("cell")).agg(
        F.count_if(F.col("verdict") == "allow").alias("good"), F.count_if(F.col("verdict") == "block").alias("bad")
    )  # at most 2 * CLIP / STEP + 1 rows
    below = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wrong = F.coalesce(F.sum("good").over(below), F.lit(0)) / F.sum("good").over(every)
    right = F.coalesce(F.sum("bad").over(below), F.lit(0)) / F.sum("bad").over(every)
    # a threshold may lie in the gap below its cell, too, where it parts the ruled URLs alike
    lowest = F.coalesce(F.lag("cell").over(Window.orderBy("cell")) + 1, F.lit(-steps))
    nearest = F.greatest(lowest, F.least(F.lit(0), F.col("cell"))).alias("cell")
    best = counts.select(nearest, F.round(wrong - right, 12).alias("loss")).orderBy("loss", F.abs("cell"), "cell").first()
    return best["cell"] * STEP if best and best["loss"] is not None else 0.0


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """Per row of (page_id, url): page_id, host, path, rule, verdict and the model's score."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), _model_text(F.col("host"), F.col("path")).alias("text"))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "urls")
    levels = train(rows)
    if levels:
        scores = materialise(score(rows, levels), "scores")
        rows = rows.join(scores, "row", "left")
        threshold = calibrated(rows.select("score", "verdict"))
    else:
        rows, threshold = rows.withColumn("score", F.when(F.length("text") > 0, 0.0)), 0.0
    own = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "score")
