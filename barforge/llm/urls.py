"""Judge URLs by rules, and where none fits by two character language models.

A rule names a host and the beginning of a path; it fits the host and all its
subdomains, and the longest fitting rule wins. All other URLs are judged by the
ratio of two smoothed Markov models of variable order over the characters of host
and path, one learnt from accepted URLs and one from rejected ones: each order
gives up as much weight to the next lower one as its context has shown different
characters (Witten and Bell), and contexts that were never seen are skipped. The
log-likelihood difference is divided by the length, and the threshold is the value
that errs least, both classes weighing the same, on hosts kept back from learning.

Rejected URLs are those a blocking rule fits, or whose host holds a rejected word;
accepted are all others. Counts are gathered over all URLs as characters in context
and summed before they are shuffled. Models are tables; they are broadcast below a
counted number of rows only.

A null URL or one without "://" has an empty host and path and is judged as such;
repeated rows are judged alike. Where no URL of a class was kept back, the threshold
is 0; equal scores are allowed.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from barforge.functions.storage import stored
from barforge.llm.words import LOWER, UPPER

# Hosts with one of these are examples of what is not wanted.
REJECTED_WORDS = ("adult", "ads-", "bets", "casino", "pills", "porn", "poker", "spam", "viagra", "xxx")
START, END = "\x02", "\x03"
UNIFORM = 1 / 256  # below the lowest order, each character is as likely
BROADCAST_ROWS = 500_000


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased."""
    rest = _after_scheme(url)
    for mark in "/?#":
        rest = F.substring_index(rest, mark, 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    rest = _after_scheme(url)
    rest = F.substring(rest, F.length(host_of(url)) + 1, F.length(rest))
    for mark in "?#":
        rest = F.substring_index(rest, mark, 1)
    return rest


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest of ``rules`` (host and beginning of the path) that fits, or null."""
    def fits(rule: str) -> Column:
        name, slash, rest = rule.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)

    ordered = sorted(rules, key=lambda r: (-len(r), r))
    return F.coalesce(*(F.when(fits(r), F.lit(r)) for r in ordered), F.lit(None).cast("string"))


def _checked(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """A row for each character of each URL and for its end, with the ``order`` before it.

    The text is cut into characters and these are joined side by side, so a URL costs its
    length; the rows carry its key in its place.
    """
    padded = F.split(F.concat(F.lit(START * order), F.col("chars"), F.lit(END)), "")
    places = F.length("chars") + 1
    grams = F.slice(padded, F.lit(1), places)
    for i in range(2, order + 2):
        grams = F.zip_with(grams, F.slice(padded, F.lit(i), places), lambda before, char: F.concat(before, char))
    return urls.withColumn("gram", F.explode(grams)).drop("chars")


def _key(chars: Column) -> Column:
    return F.unhex(F.sha2(chars, 256))


def gram_scores(counted: DataFrame, order: int) -> DataFrame:
    """(gram, gain): log of the accepted over the rejected model's probability of a
    gram's last character, for all grams of ``counted`` (gram, accepted, rejected)."""
    lengths = F.explode(F.sequence(F.lit(1), F.lit(order + 1)))
    seen = stored(
        counted.where("accepted + rejected > 0").select("gram", "accepted", "rejected", lengths.alias("k"))
        .groupBy(F.expr("right(gram, k)").alias("suffix"))
        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "suffixes")
    contexts = stored(seen.groupBy(F.expr("left(suffix, length(suffix) - 1)").alias("context")).agg(
        *(f(kind).alias(f"{kind}_{name}") for kind in ("accepted", "rejected") for name, f in (
            ("all", F.sum), ("kinds", lambda k: F.sum((F.col(k) > 0).cast("bigint")))))), "contexts")
    steps = (
        counted.select("gram", lengths.alias("k"))
        .withColumn("suffix", F.expr("right(gram, k)")).withColumn("context", F.expr("left(suffix, k - 1)"))
        .join(_checked(seen), "suffix", "left").join(_checked(contexts), "context", "left").na.fill(0)
    )

    def log_likely(kind: str) -> Column:
        return F.log(F.expr(f"""aggregate(steps, cast({UNIFORM!r} as double), (p, s) ->
            if(s.{kind}_all = 0, p, (s.{kind} + s.{kind}_kinds * p) / (s.{kind}_all + s.{kind}_kinds)))"""))

    ladder = F.array_sort(F.collect_list(F.struct(
        "k", "accepted", "accepted_all", "accepted_kinds", "rejected", "rejected_all", "rejected_kinds")))
    return steps.groupBy("gram").agg(ladder.alias("steps")).select(
        "gram", (log_likely("accepted") - log_likely("rejected")).alias("gain"))


def best_threshold(kept: DataFrame, bins: int = 2000, span: float = 10.0) -> float:
    """The score at or above which to allow: least errors over ``kept`` (score, accepted,
    rejected counts), each class weighing the same; the middle one of equally good ones."""
    at = F.floor((F.least(F.greatest("score", F.lit(-span)), F.lit(span)) + span) * (bins / (2 * span)))
    counted = kept.groupBy(at.alias("bin")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).collect()
    counts = {r["bin"]: (r.a, r.r) for r in counted}  # a row per bin at most
    all_a, all_r = (sum(c[i] for c in counts.values()) for i in (0, 1))
    if not all_a or not all_r:
        return 0.0
    lost, errors = 0.0, []
    kept_out = all_r
    for b in range(bins + 2):
        errors.append(lost / all_a + kept_out / all_r)
        a, r = counts.get(b, (0, 0))
        lost, kept_out = lost + a, kept_out - r
    least = min(errors)
    good = [b for b, e in enumerate(errors) if e <= least + 1e-12]
    return good[len(good) // 2] * (2 * span / bins) - span


def judge_urls(pages: DataFrame, block: Sequence[str], allow: Sequence[str], *, url: str = "url", order: int = 4,
               rejected_words: Sequence[str] = REJECTED_WORDS, keep_back: int = 5, seed: int = 3) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict, which replace columns so named."""
    names = ("host", "path", "rule", "score", "verdict")
    kept = [c for c in pages.columns if c not in names]
    host, path = F.col("host"), F.col("path")
    chars = F.concat(host, F.translate(path, UPPER, LOWER))
    marked = (
        pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
        .withColumn("rule", rule_for(host, path, [*block, *allow])).withColumn("__chars", chars)
    )
    blocked = F.coalesce(F.col("rule").isin(list(block)), F.lit(False)) if block else F.lit(False)
    unwanted = F.lit(False)
    for word in rejected_words:
        unwanted = unwanted | host.contains(word)
    rejected = blocked | unwanted
    # Of an MD5, so that any engine keeps the same hosts back.
    digest = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "host")), 1, 8)
    back = F.conv(digest, 16, 10).cast("bigint") % keep_back == 0

    def number(test: Column) -> Column:
        return F.sum(test.cast("bigint"))

    urls = stored(marked.groupBy(F.col("__chars").alias("chars")).agg(
        number(~rejected & ~back).alias("accepted"), number(rejected & ~back).alias("rejected"),
        number(~rejected & back).alias("back_accepted"), number(rejected & back).alias("back_rejected"))
        .withColumn("key", _key(F.col("chars"))), "urls")
    # Distinct URLs are few bytes and many grams: they are dealt out before they are cut up.
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grams = _grams(urls.repartition(tasks, "key"), order)
    counted = stored(grams.groupBy("gram").agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "grams")
    gains = stored(gram_scores(counted, order), "gains")
    scored = stored(
        grams.join(_checked(gains), "gram").groupBy("key")
        .agg(F.avg("gain").alias("score"), F.first("back_accepted").alias("accepted"),
             F.first("back_rejected").alias("rejected")), "scores")
    threshold = best_threshold(scored)
    own = scored.select(F.col("key").alias("__key"), "score")
    by_rule = F.when(blocked, "block").when(F.col("rule").isNotNull(), "allow")
    by_score = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return marked.withColumn("__key", _key(F.col("__chars"))).join(own, "__key").withColumn("verdict", F.coalesce(by_rule, by_score)).select(*kept, *names)
