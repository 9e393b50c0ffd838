"""URL verdicts: rules on host and path first, then a character language-model ratio.

Two smoothed variable-order Markov models give a character's probability after up to four
characters before it, one for accepted and one for rejected URLs: at each order the counts are mixed
with the next shorter order by the number of different continuations (Witten-Bell). A URL's score is
the sum of its characters' log-likelihood differences divided by their number. The threshold has the
least balanced error on a tenth of the labelled URLs that the counts leave out.

The models read the whole URL as it stands, scheme, query and fragment included; host and path serve the rules.
Counts cover all other labelled URLs. Differences are computed once per distinct run of five
characters, as whole millionths, so sums do not depend on their order; they are broadcast up to a measured size.

A URL without ``://`` has an empty host and path, so no rule fits, and is judged by its characters like any
other. Null or empty URL: with no characters to judge the verdict is allow. A very long URL is rows of five
characters like any other. Repeated URLs get one score. If no URL is labelled, the threshold is 0
and all scores are 0: allow. Empty table: no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from membertide.llm.common import Scratch, small

ORDER = 4
UNIFORM = 1 / 256
HELD_OUT = 10
#: Bins of the scores for the calibration: thousandths up to this many either way.
BINS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCK),
    Rule("org", "/fr/", ALLOW),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or null."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def grams(value: Column, order: int = ORDER) -> Column:
    """Each character and the end, with the ``order`` characters before it."""
    padded = F.concat(F.lit("\x02" * order), value, F.lit("\x03"))
    return F.regexp_extract_all(padded, F.lit(rf"(?s)(?=(.{{{order + 1}}}))"), F.lit(1))


def weights(counts: DataFrame, scratch: Scratch, order: int = ORDER) -> DataFrame:
    """(gram, weight): log-likelihood difference in millionths, from counts (gram, good, bad)."""
    levels = [counts]
    for k in range(order - 1, -1, -1):
        shorter = levels[0].groupBy(F.substring("gram", 2, k + 1).alias("gram")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        levels.insert(0, scratch.table(shorter, f"grams{k}"))
    # the shortest level has a row per character
    total = levels[0].agg(*[F.sum(c).alias(f"n_{c}") for c in ("good", "bad")], *[F.sum((F.col(c) > 0).cast("bigint")).alias(f"t_{c}") for c in ("good", "bad")])
    chance = {c: F.lit(UNIFORM) for c in ("good", "bad")}
    level = levels[0].crossJoin(F.broadcast(total))  # one row
    for k in range(order + 1):
        if k:
            shorter = level.select(F.col("gram").alias("end"), F.col("p_good").alias("q_good"), F.col("p_bad").alias("q_bad"))
            before = F.substring("gram", 1, k)
            tally = levels[k].groupBy(before.alias("before")).agg(
                *[F.sum(c).alias(f"n_{c}") for c in ("good", "bad")], *[F.sum((F.col(c) > 0).cast("bigint")).alias(f"t_{c}") for c in ("good", "bad")]
            )
            level = levels[k].withColumns({"before": before, "end": F.substring("gram", 2, k)}).join(tally, "before").join(shorter, "end")
            chance = {c: F.col(f"q_{c}") for c in ("good", "bad")}
        for c in ("good", "bad"):
            n, t = F.col(f"n_{c}"), F.col(f"t_{c}")
            level = level.withColumn(f"p_{c}", F.when(n > 0, (F.col(c) + t * chance[c]) / (n + t)).otherwise(chance[c]))
        level = level.select("gram", "p_good", "p_bad")
    return level.select("gram", F.round((F.log("p_good") - F.log("p_bad")) * 1e6).cast("bigint").alias("weight"))


def threshold(scored: DataFrame) -> int:
    """In thousandths; from (score, label) of held-out URLs, by bins of a bounded number."""
    bins = scored.groupBy(F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("score") * 1000))).cast("int").alias("bin"))
    tally = bins.agg(F.sum((F.col("label") == ALLOW).cast("bigint")), F.sum((F.col("label") == BLOCK).cast("bigint"))).collect()
    good, bad = sum(r[1] for r in tally), sum(r[2] for r in tally)
    if not good or not bad:
        return 0
    best, at, missed, caught = None, 0, 0, 0
    for edge, g, b in sorted(tuple(r) for r in tally):
        error = missed / good + (bad - caught) / bad
        if best is None or error < best:
            best, at = error, edge
        missed, caught = missed + g, caught + b
    return at


def judge(pages: DataFrame, scratch: Scratch, rules: tuple[Rule, ...] = RULES, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page."""
    host, path = host_and_path(F.col(url))
    pages = pages.select(F.col(page_id).alias("page_id"), F.coalesce(url, F.lit("")).alias("value"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    pages = pages.withColumns({"rule": name, "label": verdict})
    distinct = pages.filter("value <> ''").select("value", "label").distinct()
    distinct = distinct.withColumns({"key": F.xxhash64("value"), "held": F.pmod(F.xxhash64(F.lit(7), "value"), F.lit(HELD_OUT)) == 0})
    distinct = scratch.table(distinct, "urls")
    exploded = distinct.select("key", "label", "held", F.explode(grams(F.col("value"))).alias("gram"))
    counted = F.when(F.col("held"), None).otherwise(F.col("label"))
    counts = exploded.groupBy("gram").agg(
        *[F.sum((F.coalesce(counted, F.lit("")) == v).cast("bigint")).alias(c) for c, v in (("good", ALLOW), ("bad", BLOCK))]
    )
    weighted = small(scratch.table(weights(scratch.table(counts, "counts"), scratch), "weights"), 40)
    scores = exploded.select("key", "gram").join(weighted, "gram").groupBy("key").agg((F.sum("weight") / F.count("*") / 1e6).alias("score"))
    scores = scratch.table(distinct.join(scores, "key").select("value", "label", "held", "score"), "scores")
    least = threshold(scores.filter("held AND label IS NOT NULL"))
    judged = pages.join(scores.select("value", "score"), "value", "left")
    method = F.when(F.col("score").isNull() | (F.col("score") * 1000 >= least), ALLOW).otherwise(BLOCK)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("label", method).alias("verdict"), "score")
