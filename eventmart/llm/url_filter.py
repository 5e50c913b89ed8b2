"""URL filters: rules by host and path, and a ratio of character models where no rule fits.

Addresses (host and path) that a rule allows train one model, those that a rule blocks the other. Both are variable-order Markov
models of code points with Witten-Bell smoothing: an n-gram's share is interpolated with that of its shorter context, down
to the alphabet, so the longest context that was seen decides. An address scores the mean over its letters, its end included,
of log(accepted / rejected), in whole millionths so that sums don't depend on their order. A quarter of the addresses with a rule is
held out; the score that separates these with the least balanced error is the threshold (0 if a kind has none).

All of it is DataFrame operations. Addresses are scored once however many rows have them. Windows of letters are
counted by text before anything is joined, and levels are joined by context and by suffix: both shared by no more rows than the
alphabet has letters. Where rows meet scores, keys with more than a thousandth of the rows (so fewer than a thousand) are
broadcast, the others shuffled.

Null urls and those without ``://`` have an empty host and path, and no rule; they are scored by their end alone. Texts may be of
any length: a window costs what its few letters cost. Scores equal to the threshold are accepted. Repeated rows are each
returned; addresses train once. Without any rule's address all is allowed. Empty tables give empty results. Of the pages,
``page_id`` and ``url`` are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import join_by_frequency, lower_ascii, stored

ALLOW, BLOCK = "allow", "block"
#: The rules of the query.
RULES = (
    (ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/"),
)

#: Letters of context.
ORDER = 4
#: Addresses whose md5 begins with a smaller hex digit are held out.
HELD_OUT_BELOW = "4"
#: Scores are whole millionths; the threshold lies between two bins of this many.
UNIT, BIN = 1_000_000, 1_000

_START, _END = "\x02", "\x03"
_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def address(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of a url; empty where there is none."""
    known = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(known, _ADDRESS, 1)), F.regexp_extract(known, _ADDRESS, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule ``host/path`` that fits the host or a domain above it and the start of the path; else null."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        on, start = rule.split("/", 1)
        fits = ((host == on) | host.endswith(f".{on}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _verdict(rule: Column, rules: Sequence[tuple[str, str]]) -> Column:
    verdict = F.lit(None).cast("string")
    for said, text in rules:
        verdict = F.when(rule == text, F.lit(said)).otherwise(verdict)
    return verdict


def _windows(text: Column, order: int) -> Column:
    """Every letter of a text, and its end, behind the ``order`` letters before it."""
    letters = F.concat(F.array_repeat(F.lit(_START), order), F.split(text, ""), F.array(F.lit(_END)))
    # One letter is never empty; splitting an empty text gives one that is.
    letters = F.filter(letters, lambda letter: letter != "")
    return F.transform(
        F.array(letters),
        lambda all_: F.transform(
            F.sequence(F.lit(1), F.size(all_) - order), lambda i: F.array_join(F.slice(all_, i, order + 1), "")
        ),
    )[0]


def learn(addresses: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """Two stored tables of counts: n-grams (gram, accepted, rejected), and their contexts with the number of letters
    that follow and of different ones. ``addresses`` has text and accepted (boolean)."""
    windows = (
        addresses.select("accepted", F.explode(_windows(F.col("text"), order)).alias("window"))
        .groupBy("window").agg(
            F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected")
        )
    )
    sizes = F.sequence(F.lit(1), F.lit(order + 1))
    grams = (
        stored(windows, "url-windows").withColumn("size", F.explode(sizes))
        .groupBy(F.substring("window", order + 2 - F.col("size"), F.col("size")).alias("gram"))
        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    )
    grams = stored(grams, "url-grams")
    before = F.substring("gram", F.lit(1), F.char_length("gram") - 1)
    contexts = grams.groupBy(before.alias("context")).agg(
        F.sum("accepted").alias("accepted_n"), F.count_if(F.col("accepted") > 0).alias("accepted_kinds"),
        F.sum("rejected").alias("rejected_n"), F.count_if(F.col("rejected") > 0).alias("rejected_kinds"),
    )
    return grams, stored(contexts, "url-contexts")


def _share(kind: str) -> Column:
    """Witten-Bell: an n-gram's own share and that of its shorter context, weighted by how many letters are new."""
    n, kinds = F.coalesce(f"{kind}_n", F.lit(0)), F.coalesce(f"{kind}_kinds", F.lit(0))
    counted = F.coalesce(kind, F.lit(0))
    return F.when(n == 0, F.col(f"{kind}_shorter")).otherwise((counted + kinds * F.col(f"{kind}_shorter")) / (n + kinds))


def score_windows(windows: DataFrame, grams: DataFrame, contexts: DataFrame, order: int = ORDER) -> DataFrame:
    """Of distinct windows: window, ratio (millionths of log(accepted / rejected) of its last letter)."""
    letters = grams.where(F.char_length("gram") == 1).count() + 1  # one stands for all that was never seen
    level = None
    for size in range(1, order + 2):
        wanted = windows.select(F.substring("window", order + 2 - size, size).alias("gram"))
        wanted = wanted.distinct() if size <= order else wanted
        if level is None:
            wanted = wanted.withColumns({f"{kind}_shorter": F.lit(1.0 / letters) for kind in ("accepted", "rejected")})
        else:
            shorter = level.select(
                F.col("gram").alias("suffix"), F.col("accepted_share").alias("accepted_shorter"),
                F.col("rejected_share").alias("rejected_shorter"),
            )
            wanted = wanted.withColumn("suffix", F.substring("gram", 2, size - 1)).join(shorter, "suffix").drop("suffix")
        level = (
            wanted.withColumn("context", F.substring("gram", 1, size - 1))
            .join(contexts, "context", "left")
            .join(grams, "gram", "left")
            .select("gram", _share("accepted").alias("accepted_share"), _share("rejected").alias("rejected_share"))
        )
    ratio = F.round((F.ln("accepted_share") - F.ln("rejected_share")) * UNIT).cast("long")
    return level.select(F.col("gram").alias("window"), ratio.alias("ratio"))


def score(addresses: DataFrame, grams: DataFrame, contexts: DataFrame, order: int = ORDER) -> DataFrame:
    """Of stored addresses (id, text): id and score, the mean ratio of its letters."""
    placed = addresses.select("id", F.explode(_windows(F.col("text"), order)).alias("window"))
    windows = stored(placed.groupBy("window").agg(F.count(F.lit(1)).alias("uses")), "url-wanted")
    ratios = score_windows(windows.select("window"), grams, contexts, order).join(windows, "window")
    together = join_by_frequency(placed, stored(ratios, "url-ratios"), "window", "uses")
    return together.groupBy("id").agg((F.sum("ratio") / F.count(F.lit(1))).alias("score"))


def threshold(scored: DataFrame) -> float:
    """The score from which addresses are accepted, by the balanced error on (score, accepted).

    What comes to the driver is one row per bin, of which there are no more than scores can differ by.
    """
    bins = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(
        F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected")
    ).orderBy("bin").collect()
    accepted, rejected = sum(b["accepted"] for b in bins), sum(b["rejected"] for b in bins)
    if not accepted or not rejected:
        return 0.0
    below, best, before = [0, 0], None, bins[0]["bin"]
    for b in bins:
        error = below[0] / accepted + (rejected - below[1]) / rejected
        if best is None or error < best[0]:
            best = error, (before + b["bin"] + 1) / 2 if before < b["bin"] else float(b["bin"])
        below = [below[0] + b["accepted"], below[1] + b["rejected"]]
        before = b["bin"]
    return best[1] * BIN


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """Of every page: page_id, host, path, rule and verdict."""
    host, path = address(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    pages = stored(pages.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules)), "url-pages")

    text = F.concat("host", "path")
    # Numbers are stored with their rows, so that a repeated task can't give others.
    known = stored(
        pages.groupBy("host", "path", "rule").agg(F.count(F.lit(1)).alias("pages")).select(
            F.monotonically_increasing_id().alias("id"), "host", "path", "pages", text.alias("text"),
            (_verdict(F.col("rule"), rules) == ALLOW).alias("accepted"),
            (F.substring(F.md5(text), 1, 1) < HELD_OUT_BELOW).alias("held_out"),
        ),
        "url-addresses",
    )
    grams, contexts = learn(known.where("accepted IS NOT NULL AND NOT held_out"), order)
    unseen = known.where("accepted IS NULL OR held_out")
    scored = stored(score(unseen, grams, contexts, order).join(known, "id"), "url-scores")
    least = threshold(scored.where("accepted IS NOT NULL"))

    verdicts = scored.where("accepted IS NULL").select(
        "host", "path", "pages", F.when(F.col("score") >= least, ALLOW).otherwise(BLOCK).alias("verdict")
    )
    columns = ["page_id", "host", "path", "rule", "verdict"]
    ruled = pages.where("rule IS NOT NULL").withColumn("verdict", _verdict(F.col("rule"), rules)).select(columns)
    judged = join_by_frequency(pages.where("rule IS NULL"), verdicts, ["host", "path"], "pages")
    return ruled.unionByName(judged.select(columns))
